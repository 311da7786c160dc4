"""Validation of result tables before they are published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.functions import codes
from landgauge.operators import checks
from landgauge.plans.batch import decode_alerts

ALERT_COLUMNS = {"country": "string", "region": "int", "subregion": "int", "dist_alert_date": "date", "dist_alert_confidence": "string", "area_ha": "float"}
ALERT_CLASSES = {"driver": list(codes.DISTURBANCE_DRIVERS.values()), "land_cover": list(codes.LAND_COVER.values()), "grasslands": ["grasslands", "non-grasslands"], "natural_land_class": [*codes.NATURAL_LANDS.values(), "Unclassified"]}


def alert_rule(latest: str, class_column: str | None = None) -> checks.TableRule:
    """Layout of a disturbance table whose version date is ``latest``."""
    columns = dict(ALERT_COLUMNS)
    if class_column:
        columns = dict(list(columns.items())[:3]) | {class_column: "string"} | dict(list(columns.items())[3:])
    accepted = {"dist_alert_confidence": list(codes.CONFIDENCE_DISTURBANCE.values())}
    if class_column:
        accepted[class_column] = ALERT_CLASSES[class_column]
    return checks.TableRule(columns, [c for c in columns if c != "area_ha"], accepted, {"date after the version": F.col("dist_alert_date") <= F.lit(latest).cast("date"), "negative area": F.col("area_ha") >= 0, "negative unit": (F.col("region") >= 0) & (F.col("subregion") >= 0)})


def alerts(table: DataFrame, pixels: DataFrame, country: str, latest: str, class_column: str | None = None, limit: float = 0.02, spot_days: DataFrame | None = None) -> list[str]:
    """What is wrong with a disturbance table, against an independent sum over one unit's raw pixels.

    ``pixels`` carry date_conf and area_ha of the unit ``country``; areas by
    confidence must agree within ``limit``, and the dates of ``spot_days``
    (dist_alert_date) must be there.
    """
    wrong = alert_rule(latest, class_column).check(table)
    if any(w.startswith("columns") for w in wrong):
        return wrong
    own = table.where(F.col("country") == country)
    raw = decode_alerts(pixels).where("alert_day > 0").withColumn("name", F.when(F.col("confidence") == 2, "low").when(F.col("confidence") == 3, "high"))
    sums = raw.where("name IS NOT NULL").groupBy(F.col("name").alias("dist_alert_confidence")).agg(F.sum("area_ha").alias("expected"))
    checked = checks.within(sums, own, "expected", "area_ha", limit, "dist_alert_confidence")
    wrong += [f"{r['dist_alert_confidence']} confidence: {r['total']} ha, expected {r['expected']}" for r in checked.where("NOT passed").collect()]
    if spot_days is not None and (n := checks.missing_dates(spot_days, own, "dist_alert_date").count()):
        wrong.append(f"{n} dates are missing")
    return wrong


def loss(features: DataFrame, results: DataFrame, limit: float = 0.01) -> DataFrame:
    """Features whose loss differs from an external source by ``limit`` or more fail; any failure raises."""
    checked = checks.within(features, results, "expected", "area_ha", limit)
    checks.require(checked, "tree cover loss differs from its reference")
    return checked


def carbon(features: DataFrame, results: DataFrame, measure: str = "carbon_gross_emissions_Mg_CO2e", limit: float = 0.02) -> DataFrame:
    """As for loss, but the outcome is only told."""
    return checks.within(features, results, "expected", measure, limit)


def new_input(new: DataFrame, old: DataFrame, encoded: str = "date_conf", limit: float = 5.0) -> DataFrame:
    """Alert pixels of a new input against the one before, in percent."""
    return checks.pixel_counts(new, old, F.col(encoded) > 0, limit)


def inventory(ours: DataFrame, theirs: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Flagged where apart by over 2 % and 1,000, or missing on a side."""
    return checks.compare_outer(ours, theirs, keys, measure, 0.02, 1000.0)
