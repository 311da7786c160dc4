"""Pivots, unpivots and the spreading of snapshots over years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.functions import codes


def pivot_dense(df: DataFrame, keys: list[str], layer: str, value: str, columns: list, fill: float | None = 0.0) -> DataFrame:
    """One column for each of the given layers, whether or not the data has it.

    Conditional sums rather than a pivot: one aggregation, and no job to find
    the values.
    """
    out = df.groupBy(*keys).agg(*(F.sum(F.when(F.col(layer) == c, F.col(value))).alias(str(c)) for c in columns))
    return out if fill is None else out.fillna(fill, subset=[str(c) for c in columns])


def unpivot_known(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Long form without the nulls."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def melt_years(df: DataFrame, keys: list[str]) -> DataFrame:
    """Columns like ``<year>_<variable>`` or ``<variable>_<year>`` to a row a year.

    Names are split at their first underscore; the part that is a number is
    the year.
    """
    wide = [c for c in df.columns if c not in keys]
    year = {c: next((p for p in c.split("_", 1) if p.isdigit()), None) for c in wide}
    if bad := [c for c, y in year.items() if y is None]:
        raise ValueError(f"no year in the names {bad}")
    other = {c: next((p for p in c.split("_", 1) if p != year[c]), "value") for c in wide}
    variables = sorted(set(other.values()))
    years = sorted({int(y) for y in year.values()})
    have = {(int(year[c]), other[c]): c for c in wide}
    rows = F.array(*(F.struct(F.lit(y).alias("year"), *((F.col(have[y, v]) if (y, v) in have else F.lit(None)).cast("double").alias(v) for v in variables)) for y in years))
    out = df.withColumn("__row", F.explode(rows)).select(*keys, "__row.*")
    return out.where(F.coalesce(*variables).isNotNull())


def spread_years(df: DataFrame, years: tuple = codes.INVENTORY_YEARS, name: str = "year") -> DataFrame:
    """A snapshot repeated for each year."""
    return df.withColumn(name, F.explode(F.array(*map(F.lit, years))))


def spread_blocks(df: DataFrame, block: str, blocks: dict = codes.INVENTORY_BLOCKS, name: str = "year") -> DataFrame:
    """A block's row repeated for each of its years; a block that is not listed keeps one row, without a year."""
    years = None
    for end, own in blocks.items():
        a = F.array(*map(F.lit, own))
        years = F.when(F.col(block) == end, a) if years is None else years.when(F.col(block) == end, a)
    return df.withColumn(name, F.explode_outer(years)).drop(block)
