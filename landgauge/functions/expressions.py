"""Column expressions: decoding, labelling and derived measures.

All are built-in expressions, so they stay within code generation and, where
the input allows, reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from landgauge.functions import codes


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map(labels: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))


def label(code: Column | str, labels: dict, default: str | None = None, strict: bool = False) -> Column:
    """The label of a code; on a miss null, ``default``, or an error if ``strict``.

    A null code is no miss: it gives null, or the default.
    """
    code = as_column(code)
    found = _map(labels)[code.cast("int")]
    if strict:
        return F.when(code.isNull(), F.lit(None)).otherwise(F.coalesce(found, F.raise_error(F.concat(F.lit("no label for code "), code.cast("string")))))
    return found if default is None else F.coalesce(found, F.lit(default))


def code_of(value, labels: dict):
    """The code of a label: the inverse look-up, on the driver, for filter literals."""
    for code, text in labels.items():
        if text == value:
            return code
    raise ValueError(f"no code for {value!r}")


def missing(measure: Column | str) -> Column:
    """NaN marks a missing measure in raster layers; nulls do here."""
    return F.nanvl(as_column(measure).cast("double"), F.lit(None).cast("double"))


def confidence_code(encoded: Column | str) -> Column:
    return F.floor(as_column(encoded).cast("long") / codes.CONFIDENCE_FACTOR).cast("int")


def day_code(encoded: Column | str) -> Column:
    return (as_column(encoded).cast("long") % codes.CONFIDENCE_FACTOR).cast("int")


def epoch_date(day: Column | str, epoch: str = codes.DISTURBANCE_EPOCH) -> Column:
    return F.date_add(F.lit(epoch).cast("date"), as_column(day).cast("int"))


def date_text(date: Column | str) -> Column:
    return F.date_format(as_column(date), "yyyy-MM-dd")


def canopy_percent(code: Column | str) -> Column:
    return label(code, codes.CANOPY_PERCENT)


def canopy_code(percent: int) -> int:
    return code_of(percent, codes.CANOPY_PERCENT)


def natural_flag(code: Column | str) -> Column:
    c = as_column(code)
    return F.when((c > 1) & (c < 12), "natural").otherwise("non-natural")


def natural_forest_code(code: Column | str) -> Column:
    c = as_column(code)
    return F.when(c.isin(*codes.NATURAL_FOREST_CLASSES), 1).when(c.isin(*codes.PLANTED_FOREST_CLASSES), 2).otherwise(0)


def vegetation_code(land_state: Column | str) -> Column:
    """Category of a land state; states that are not listed, and nulls, are excluded (0)."""
    c = as_column(land_state)
    out = None
    for category, states in codes.LAND_STATES.items():
        if category:
            out = F.when(c.isin(*states), category) if out is None else out.when(c.isin(*states), category)
    return out.otherwise(0)


def vegetation_rule(detailed: Column | str, broad: Column | str) -> Column:
    """Category by class names, for tables that carry those."""
    d, b = as_column(detailed), as_column(broad)
    return F.when(d == "tree_loss", 1).when(d == "tree_gain", 2).when(d.startswith("tree_tree"), 3).when(b.isin("crop", "short_veg"), 4).otherwise(0)


def transition(start: Column | str, end: Column | str, classes: int = len(codes.LAND_COVER)) -> Column:
    """One code for a pair of classes, from 0 on."""
    return as_column(start) * classes + as_column(end)


def transition_parts(code: Column | str, classes: int = len(codes.LAND_COVER)) -> tuple[Column, Column]:
    """Start and end class of a transition code."""
    c = as_column(code)
    return F.floor(c / classes).cast("int"), F.pmod(c, F.lit(classes)).cast("int")


def flag(condition: Column) -> Column:
    """1 where a condition holds, else 0, null conditions included."""
    return F.when(condition, 1).otherwise(0)


def absolute(rate: Column | str, area: Column | str, divisor: float = 1.0) -> Column:
    """A rate for an area unit made absolute; missing rates and areas count as 0."""
    product = F.coalesce(missing(rate), F.lit(0.0)) * F.coalesce(missing(area), F.lit(0.0))
    return product / divisor if divisor != 1.0 else product


def masked(measure: Column | str, condition: Column, other: float | None = 0.0) -> Column:
    return F.when(condition, as_column(measure)).otherwise(F.lit(other).cast("double"))


def carbon_if_valid(carbon: Column | str, canopy: int | None) -> Column:
    """The carbon model holds from 30 percent canopy on; below, the measure is null."""
    return F.lit(None).cast("double") if canopy is not None and canopy < 30 else as_column(carbon)


def area_id(*parts: Column | str) -> Column:
    """``BRA.1.12``; null if any part is, unlike concat_ws, which would skip it."""
    out = as_column(parts[0]).cast("string")
    for p in parts[1:]:
        out = F.concat(out, F.lit("."), as_column(p).cast("string"))
    return out


def area_level(aoi_id: Column | str) -> Column:
    return F.size(F.split(as_column(aoi_id), r"\.")) - 1


def area_part(aoi_id: Column | str, level: int) -> Column:
    return F.get(F.split(as_column(aoi_id), r"\."), F.lit(level))


def without_suffix(gid: Column | str) -> Column:
    return F.substring_index(as_column(gid), "_", 1)


def relative_difference(a: Column | str, b: Column | str, zero: float | None = 0.0) -> Column:
    """|a - b| over the mean of |a| and |b|; ``zero`` where both are 0."""
    a, b = as_column(a), as_column(b)
    mean = (F.abs(a) + F.abs(b)) / 2
    return F.when(mean == 0, F.lit(zero).cast("double")).otherwise(F.abs(a - b) / mean)


def percent_difference(new: Column | str, old: Column | str) -> Column:
    new, old = as_column(new), as_column(old)
    return F.when(old == 0, F.when(new == 0, 0.0).otherwise(F.lit(None).cast("double"))).otherwise(F.abs(new - old) / old * 100)


def periods(start: int, end: int, step: int = 5) -> list[str]:
    return [f"{y}-{y + step}" for y in range(start, end, step)]
