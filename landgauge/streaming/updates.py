"""New dataset versions trigger batch plans: a file stream of version marks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "dataset string, version string, path string"


def watch(spark: SparkSession, folder: str, checkpoint: str, plans: dict[str, Callable[[SparkSession, str, str], None]]) -> StreamingQuery:
    """Run the plan of each dataset whose new version has appeared in ``folder``.

    Takes what is there and stops; marks seen before are not taken again.
    Plans write to paths that the version names, so repeating one does no
    harm.  Marks are a few rows a batch.
    """

    def run(batch: DataFrame, _: int) -> None:
        for r in batch.dropDuplicates(["dataset", "version"]).orderBy("dataset", "version").collect():
            if r["dataset"] in plans:
                plans[r["dataset"]](batch.sparkSession, r["version"], r["path"])

    marks = spark.readStream.schema(SCHEMA).json(folder)
    return marks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
