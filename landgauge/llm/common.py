"""Helpers shared by the operators: table access and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    On a single machine (a local master) that names none, a temporary folder
    takes its place, which goes with the process; a cluster must name one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="landgauge-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage: write to the shared folder and read it back.

    Losing an executor afterwards costs nothing, as no shuffle file of the
    plan above is needed again.  What is written is in a folder named after
    the application; :func:`clear` removes it, once no result is to be read.
    """
    spark = df.sparkSession
    path = f"{_own_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Remove all that this application has materialized; DataFrames that read it are of no more use."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_key(df: DataFrame, first: str, second: str) -> tuple[Column, Column]:
    """128 bits, as two longs, that tell whether two rows are the same in all columns."""
    value = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in df.schema]
    # Hashes skip nulls, so where they stand is hashed as well.
    null = [F.col(f"`{n}`").isNull() for n in df.columns]
    return F.xxhash64(F.lit(0), *value, *null).alias(first), F.xxhash64(F.lit(1), *value, *null).alias(second)


def text_of(column: str = "text") -> Column:
    """Null texts count as empty ones."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hex16(column: Column) -> Column:
    """A signed long as 16 lowercase hex digits of its two's complement."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
