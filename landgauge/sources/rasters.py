"""Raster layers as pixel tables.

Tiles come as raw little-endian arrays described by a manifest (one JSON line
a tile: path, rows, cols, x0, y0, resolution, dtype, nodata).  They are read
with ``binaryFile`` and decoded a batch at a time; there is no codec here for
compressed raster formats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "path string, rows int, cols int, x0 double, y0 double, resolution double, dtype string, nodata double"


def tiles(spark: SparkSession, manifest: str) -> DataFrame:
    """x, y, value of every pixel that holds data, of the tiles in a manifest."""
    listed = spark.read.schema(MANIFEST).json(manifest)
    folder = manifest.rsplit("/", 1)[0]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("path"), "content")
    return files.join(listed, "path").mapInPandas(decode, "x double, y double, value double")


def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pixels of each tile: x ascending, y descending, missing ones left out."""
    for b in batches:
        for t in b.itertuples():
            v = np.frombuffer(t.content, np.dtype(t.dtype).newbyteorder("<")).astype(np.float64)
            ok = ~np.isnan(v) if pd.isna(t.nodata) else (v != t.nodata) & ~np.isnan(v)
            at = np.flatnonzero(ok)
            yield pd.DataFrame({"x": t.x0 + (at % t.cols) * t.resolution, "y": t.y0 - (at // t.cols) * t.resolution, "value": v[at]})


def ingest(spark: SparkSession, manifest: str, path: str, kind: str, overwrite: bool = False) -> bool:
    """Tiles to a Parquet pixel table, once."""
    from landgauge.sources.tables import write_once

    return write_once(lambda: tiles(spark, manifest).withColumn("value", F.col("value").cast(kind)), spark, path, overwrite)
