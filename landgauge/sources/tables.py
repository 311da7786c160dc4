"""Reading and writing tables: explicit schemas, idempotent sinks, version marks."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def csvs(spark: SparkSession, paths: dict[str, str], schema: T.StructType | str, tag: str) -> DataFrame:
    """Several CSV files of one schema, each tagged, as one table."""
    out = None
    for name, path in paths.items():
        part = spark.read.csv(path, header=True, schema=schema).withColumn(tag, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def features(spark: SparkSession, path: str, properties: str = "id string") -> DataFrame:
    """The features of GeoJSON files: properties, and the geometry as JSON text."""
    schema = f"type string, features array<struct<id: string, properties: struct<{', '.join(p.strip().replace(' ', ': ', 1) for p in properties.split(','))}>, geometry: string>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return rows.select(F.col("f.id").alias("feature_id"), "f.properties.*", F.col("f.geometry").alias("geometry"))


def write_features(df: DataFrame, path: str) -> None:
    """Features as JSON lines: properties and geometry (JSON text)."""
    props = [c for c in df.columns if c != "geometry"]
    text = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*props)), F.lit(',"geometry":'), F.coalesce("geometry", F.lit("null")), F.lit("}"))
    df.select(text.alias("value")).write.mode("overwrite").text(path)


def write_collection(df: DataFrame, path: str) -> None:
    """One GeoJSON FeatureCollection: for the few features of a check, as one file is written in one place."""
    props = [c for c in df.columns if c != "geometry"]
    rows = df.select(F.to_json(F.struct(*props), {"ignoreNullFields": "false"}).alias("p"), F.coalesce("geometry", F.lit("null")).alias("g")).toLocalIterator()
    body = ",".join(f'{{"type":"Feature","properties":{r["p"]},"geometry":{r["g"]}}}' for r in rows)
    write_text(df.sparkSession, path, f'{{"type":"FeatureCollection","features":[{body}]}}')


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of any store that Spark reads; None if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """Write a small file aside, then put it in its place."""
    jvm = spark._jvm
    new, p = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp"), jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(body.encode()))
    finally:
        stream.close()
    if not fs.rename(new, p):
        fs.delete(p, False)
        fs.rename(new, p)


def sql(spark: SparkSession, text: str, tables: dict[str, DataFrame]) -> DataFrame:
    """SQL text over given tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_once(df: Callable[[], DataFrame], spark: SparkSession, path: str, overwrite: bool = False, partition_by: list[str] | None = None) -> bool:
    """Write unless a finished result is there; tells whether it wrote.

    ``df`` is only called when needed.  A result is finished when Spark has
    marked it so: a run that died half way is done again.
    """
    if not overwrite and exists(spark, f"{path}/_SUCCESS"):
        return False
    writer = df().write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return True


def bucketed(df: DataFrame, table: str, buckets: int, keys: list[str]) -> None:
    """A table whose joins on ``keys`` need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def by_tile(df: DataFrame, path: str, partitions: int, tile: tuple = ("tile_y", "tile_x")) -> None:
    """Pixels in the order of their tiles, so that windows skip row groups."""
    df.repartitionByRange(partitions, *tile).sortWithinPartitions(*tile).write.mode("overwrite").parquet(path)


def write_cube(df: Callable[[], DataFrame], spark: SparkSession, path: str, partitions: int, overwrite: bool = False, tile: tuple = ("tile_y", "tile_x")) -> bool:
    """A derived layer, written once and in the order of its tiles; tells whether it wrote."""
    if not overwrite and exists(spark, f"{path}/_SUCCESS"):
        return False
    by_tile(df(), path, partitions, tile)
    return True


def mark_latest(spark: SparkSession, folder: str, version: str) -> None:
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/latest")


class Latest:
    """The version that a folder's mark names, looked up at most once an hour."""

    def __init__(self, spark: SparkSession, folder: str, fallback: str | None = None, seconds: float = 3600.0, clock: Callable[[], float] = time.monotonic):
        self.spark, self.folder, self.fallback, self.seconds, self.clock = spark, folder, fallback, seconds, clock
        self.found: tuple[float, str] | None = None

    def version(self) -> str:
        if self.found is None or self.clock() - self.found[0] >= self.seconds:
            row = self.spark.read.text(f"{self.folder}/latest").first() if exists(self.spark, f"{self.folder}/latest") else None
            if row is None and self.fallback is None:
                raise LookupError(f"no latest version in {self.folder}")
            self.found = (self.clock(), row[0].strip() if row else self.fallback)
        return self.found[1]
