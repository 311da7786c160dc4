"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landgauge.llm.ann import op6_ann
from landgauge.llm.chat_tree import op3_chat_tree
from landgauge.llm.fingerprints import op1_fingerprints
from landgauge.llm.mixing import op2_mixing
from landgauge.llm.packing import op7_packing
from landgauge.llm.quality import op5_quality
from landgauge.llm.secret_scan import op8_secret_scan
from landgauge.llm.simhash import op9_simhash
from landgauge.llm.token_counts import op4_token_counts
from landgauge.llm.url_filter import OP10_SQL, op10_url_filter

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_fingerprints, op2_mixing, op3_chat_tree, op4_token_counts, op5_quality, op6_ann, op7_packing, op8_secret_scan, op9_simhash, op10_url_filter,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {"op10_url_filter": OP10_SQL}
