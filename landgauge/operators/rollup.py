"""Roll-up along the administrative hierarchy, and grouped sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.functions.expressions import area_id, missing

ADMIN = ("country", "region", "subregion")


def with_country(df: DataFrame, iso: DataFrame, code: str = "country") -> DataFrame:
    """Numeric country codes to alpha-3; rows without a match go."""
    names = iso.select(F.col("code").alias("__code"), F.col("alpha3").alias("__alpha3"))
    return df.join(names, F.col(code) == F.col("__code")).withColumn(code, F.col("__alpha3")).drop("__code", "__alpha3")


def admin_rollup(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Sums for countries, regions and subregions: aoi_id, aoi_type, keys, measures.

    One pass of grouping sets over one partial aggregation.  Code 0 is "no
    such unit": such rows count above, but make no unit of their own level.
    """
    c, r, s = ADMIN
    base = df.groupBy(*ADMIN, *keys).agg(*(F.sum(missing(m)).alias(m) for m in measures)).where(F.col(c).isNotNull())
    sets = [[F.col(x) for x in (*ADMIN[:n], *keys)] for n in (1, 2, 3)]
    out = base.groupingSets(sets, *ADMIN, *keys).agg(*(F.sum(m).alias(m) for m in measures), F.grouping(r).alias("__r"), F.grouping(s).alias("__s"))
    out = out.where(((F.col("__r") == 1) | (F.col(r) != 0)) & ((F.col("__s") == 1) | (F.col(s) != 0)))
    name = F.when(F.col("__r") == 1, area_id(c)).when(F.col("__s") == 1, area_id(c, r)).otherwise(area_id(c, r, s))
    return out.select(name.alias("aoi_id"), F.lit("admin").alias("aoi_type"), *keys, *measures)


def zonal(df: DataFrame, keys: list[str], measures: dict[str, Column | str], func: str = "sum", expected: dict[str, list] | None = None) -> DataFrame:
    """Grouped sums or counts of non-missing measures.

    Rows with a null key, or one outside the ``expected`` values of its
    column, take no part, and groups whose measures are all missing give no
    row.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
        if expected and k in expected:
            df = df.where(F.col(k).isin(*expected[k]))
    agg = {"sum": F.sum, "count": F.count, "max": F.max}[func]
    out = df.groupBy(*keys).agg(*(agg(missing(m)).alias(n) for n, m in measures.items()))
    return out.where(F.coalesce(*measures).isNotNull()) if func != "count" else out


def dense(df: DataFrame, keys: dict[str, list], fill: dict[str, float]) -> DataFrame:
    """A row for every combination of the expected key values, filled where there was none.

    The scaffold has as many rows as the fixed class lists span.
    """
    frame = df.sparkSession.range(1).select(F.lit(0).alias("__one"))
    for k, values in keys.items():
        frame = frame.withColumn(k, F.explode(F.array(*(F.lit(v).cast(df.schema[k].dataType) for v in values))))
    return frame.drop("__one").join(df, list(keys), "left").fillna(fill)


def positive(df: DataFrame, measure: str = "area_ha") -> DataFrame:
    """Groups without area go."""
    return df.where(F.col(measure) > 0)
