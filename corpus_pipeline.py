"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of their input, whatever their names; null ids,
sources and languages are kept as they are, and an empty table gives an empty
result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgauge.llm.common import materialize, table
from landgauge.llm.mixing import mixed
from landgauge.llm.packing import pack
from landgauge.llm.quality import fit, scored
from landgauge.llm.secret_scan import masked
from landgauge.llm.simhash import keep_first

#: No SQL can express the stages; tests compare them with brute force.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts have no words and are scored by the bias alone; very
    long texts are scored whole; a score of 0.5 (a tie) stays; repeated rows
    stay or go together.
    """
    weights = fit(docs, table(spark, sf_dir, "labels"))
    score = "_" * max(map(len, docs.columns)) + "score"  # longer than any other name
    return scored(docs, weights, docs.columns, score).where(f"{score} >= 0.5").drop(score)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a Jaccard index of at least 0.8.

    SimHash fingerprints are compared bit-sliced and joined by star
    contraction, as in op9, at a radius wide enough for that index; an exact
    check on whole sets follows.
    Null and empty texts, and those that differ in ASCII case and white space
    only, are copies; very long texts are compared whole; the smallest id
    stays, rows without one last, ties by a hash of the text; of repeated rows
    one stays.  Unlike texts that share an id all stay.
    """
    return keep_first(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked, and ``n_chars`` follows the text.

    Null texts stay null; very long ones are searched whole; no row goes, and
    repeated rows stay repeated.
    """
    return masked(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it.

    Null and empty texts are never taken; a null source is a source of its
    own; repeated rows are rows of their own; choices follow from the rows, so
    reruns agree.
    """
    return mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document and their places in sequences.

    A null text is its end token alone; very long texts are cut into pieces;
    null ids stay null; repeated rows are packed once each.
    """
    return pack(docs)


STAGES = [("quality", good), ("near_duplicates", unlike), ("secrets", without_secrets), ("mixing", mix), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
