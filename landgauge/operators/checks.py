"""Validation: results against independent sources and against rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.functions.expressions import percent_difference, relative_difference


class CheckFailed(ValueError):
    pass


def compare_outer(ours: DataFrame, theirs: DataFrame, keys: list[str], measure: str, relative: float, absolute: float) -> DataFrame:
    """Both sides by key, with presence, differences and a flag.

    Flagged: missing on one side, or apart by more than ``relative`` and more
    than ``absolute``.
    """
    a = ours.select(*keys, F.col(measure).alias("ours"), F.lit(True).alias("__a"))
    b = theirs.select(*keys, F.col(measure).alias("theirs"), F.lit(True).alias("__b"))
    out = a.join(b, keys, "full_outer")
    presence = F.when(F.col("__b").isNull(), "left_only").when(F.col("__a").isNull(), "right_only").otherwise("both")
    out = out.withColumn("presence", presence).withColumn("abs_diff", F.abs(F.col("ours") - F.col("theirs"))).withColumn("rel_diff", relative_difference("ours", "theirs"))
    flagged = (F.col("presence") != "both") | ((F.col("rel_diff") > relative) & (F.col("abs_diff") > absolute))
    return out.withColumn("flagged", F.coalesce(flagged, F.lit(True))).drop("__a", "__b")


def worst(compared: DataFrame, n: int = 40, ties: list[str] | None = None) -> DataFrame:
    """The flagged rows that differ most, those without a difference first."""
    return compared.where("flagged").orderBy(F.desc_nulls_first("abs_diff"), *(ties or [])).limit(n)


def any_flag(compared: DataFrame, key: str) -> DataFrame:
    return compared.groupBy(key).agg(F.bool_or("flagged").alias("flagged"))


def within(features: DataFrame, results: DataFrame, expected: str, measure: str, limit: float, key: str = "aoi_id") -> DataFrame:
    """Features with our total, the relative difference and ``passed``.

    Results are aggregated once for all features; a feature without any has a
    total of 0.
    """
    totals = results.groupBy(key).agg(F.sum(measure).alias("total"))
    out = features.join(totals, key, "left").fillna({"total": 0.0})
    out = out.withColumn("difference", relative_difference("total", expected))
    return out.withColumn("passed", F.col("difference") < limit)


def all_passed(checked: DataFrame) -> bool:
    return bool(checked.agg(F.coalesce(F.bool_and("passed"), F.lit(True))).first()[0])


def require(checked: DataFrame, what: str) -> None:
    if not all_passed(checked):
        raise CheckFailed(what)


def missing_dates(wanted: DataFrame, present: DataFrame, column: str) -> DataFrame:
    """Dates of a validation source that a result lacks."""
    return wanted.select(column).distinct().join(present.select(column).distinct(), column, "left_anti")


def pixel_counts(new: DataFrame, old: DataFrame, condition: Column, limit: float = 5.0) -> DataFrame:
    """Pixels of two inputs, their difference in percent and whether it is under ``limit``."""
    a = new.agg(F.count_if(condition).alias("new_count"))
    b = old.agg(F.count_if(condition).alias("old_count"))
    out = a.crossJoin(b)  # one row each
    return out.withColumn("percent", percent_difference("new_count", "old_count")).withColumn("passed", F.coalesce(F.col("percent") < limit, F.lit(False)))


def qc_totals(pixels: DataFrame, area: str, classes: dict[str, str]) -> DataFrame:
    """Masked area by class, for several class columns in one pass: layer, class, total."""
    pairs = F.array(*(F.struct(F.lit(n).alias("layer"), F.col(c).cast("string").alias("class")) for n, c in classes.items()))
    rows = pixels.select(F.col(area).alias("__area"), F.inline(pairs)).where(F.col("class").isNotNull())
    return rows.groupBy("layer", "class").agg(F.sum("__area").alias("total"))


def distinct_by(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """How many values each column has for a key."""
    return df.groupBy(key).agg(*(F.count_distinct(c).alias(c) for c in columns))


def varying(df: DataFrame, key: str, column: str) -> DataFrame:
    """The rows of keys for which a column has more than one value, with their number."""
    several = df.groupBy(key).agg(F.count_distinct(column).alias("values")).where("values > 1")
    return df.join(several, key)


def some_features(features: DataFrame, start: int = 0, limit: int = 20, key: str = "feature_id") -> DataFrame:
    """The features from the ``start``-th up to the ``limit``-th, in the order of their key."""
    return features.orderBy(key).offset(start).limit(max(0, limit - start))


@dataclass
class TableRule:
    """What a result table must be like.  ``check`` lists what it is not."""

    columns: dict[str, str]
    unique: list[str] = field(default_factory=list)
    accepted: dict[str, list] = field(default_factory=dict)
    conditions: dict[str, Column] = field(default_factory=dict)
    nullable: set[str] = field(default_factory=set)

    def check(self, df: DataFrame) -> list[str]:
        wrong = []
        if df.columns != list(self.columns):
            return [f"columns are {df.columns}"]
        wrong += [f"{c} is {t}" for c, t in df.dtypes if t != self.columns[c]]
        counts = {f"nulls in {c}": F.count_if(F.col(c).isNull()) for c in self.columns if c not in self.nullable}
        counts |= {f"unknown values in {c}": F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*v)) for c, v in self.accepted.items()}
        counts |= {n: F.count_if(~F.coalesce(c, F.lit(True))) for n, c in self.conditions.items()}
        if counts:
            row = df.agg(*(e.alias(n) for n, e in counts.items())).first().asDict()
            wrong += [f"{n} rows: {m}" for m, n in row.items() if n]
        if self.unique and df.groupBy(*self.unique).count().where("count > 1").limit(1).count():
            wrong.append(f"{self.unique} is not unique")
        return wrong
