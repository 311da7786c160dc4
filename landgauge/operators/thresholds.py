"""Canopy thresholds: accumulation, its inverse, and the carbon rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landgauge.functions import codes


def counts_as_forest(threshold: Column | int, canopy: str = "canopy_cover", mangrove: str = "mangrove_stock_2000", gain: str = "tree_cover_gain_from_height") -> Column:
    """Canopy reaches the threshold, or there is mangrove, or height gain."""
    return F.coalesce(F.col(canopy) >= threshold, F.lit(False)) | F.coalesce(F.col(mangrove) == 1, F.lit(False)) | F.coalesce(F.col(gain) > 0, F.lit(False))


def accumulate(df: DataFrame, keys: list[str], measures: list[str], canopy: str = "canopy_cover", thresholds: tuple = codes.CARBON_THRESHOLDS) -> DataFrame:
    """Sums over the rows that count at each threshold, which replaces the canopy.

    Each row is read once and sent to the thresholds it passes.
    """
    passed = F.filter(F.array(*map(F.lit, thresholds)), lambda t: counts_as_forest(t, canopy))
    rows = df.withColumn("__t", F.explode(passed)).drop(canopy).withColumnRenamed("__t", canopy)
    return rows.groupBy(*keys, canopy).agg(*(F.sum(m).alias(m) for m in measures))


def unaccumulate(df: DataFrame, keys: list[str], measure: str, canopy: str = "canopy_cover", thresholds: tuple = codes.CARBON_THRESHOLDS) -> DataFrame:
    """Take the next threshold's sum off each, so that ``canopy >= t`` sums give it back.

    Rows at other canopies stay as they are.  A group that lacks a threshold
    counts as 0 there, but gets no new row.
    """
    w = Window.partitionBy(*keys)
    at = {t: F.coalesce(F.max(F.when(F.col(canopy) == t, F.col(measure))).over(w), F.lit(0.0)) for t in thresholds[1:]}
    value = F.col(measure)
    for t, after in zip(thresholds, thresholds[1:], strict=False):
        value = F.when(F.col(canopy) == t, F.col(measure) - at[after]).otherwise(value)
    return df.withColumn(measure, value)


def loss_table(df: DataFrame, context: list[str], admin: list[str], carbon: str, areas: list[str], canopy: str = "canopy_cover") -> DataFrame:
    """Areas by canopy class, with carbon by threshold, for one row a key.

    One aggregation: each row gives its areas to its own canopy, and its
    carbon to every threshold that it passes; classes below the first
    threshold carry no carbon.
    """
    own = F.struct(F.col(canopy).alias("c"), *(F.col(a).alias(a) for a in areas), F.lit(0.0).alias(carbon))
    passed = F.filter(F.array(*map(F.lit, codes.CARBON_THRESHOLDS)), lambda t: counts_as_forest(t, canopy))
    extra = F.transform(passed, lambda t: F.struct(t.alias("c"), *(F.lit(0.0).alias(a) for a in areas), F.col(carbon).alias(carbon)))
    keys = [k for k in (*context, *admin) if k != canopy]
    rows = df.select(*keys, F.explode(F.concat(F.array(own), extra)).alias("e")).select(*keys, F.col("e.c").alias(canopy), *(f"e.{m}" for m in (*areas, carbon)))
    return rows.groupBy(*context, *admin).agg(*(F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in (*areas, carbon)))
