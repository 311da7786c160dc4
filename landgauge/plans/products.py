"""The products: one function each, from a request to a DataFrame.

``tables`` maps names to DataFrames: result tables of the batch plans for
administrative areas, and ``pixels`` (clipped, with aoi_id and aoi_type, and
the layers as codes) for all others.
"""

from __future__ import annotations

import bisect
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgauge.functions import codes
from landgauge.functions.expressions import carbon_if_valid, date_text, epoch_date, label, natural_flag, periods
from landgauge.operators.reshape import spread_blocks, spread_years
from landgauge.operators.rollup import positive, zonal
from landgauge.operators.thresholds import counts_as_forest
from landgauge.plans import requests as rq
from landgauge.plans.query import Filter, ZonalQuery, answer

Tables = dict[str, DataFrame]
AREA = ["aoi_id", "aoi_type"]


def _admin(request: rq.Request) -> bool:
    return request.area.type == "admin"


def _own(table: DataFrame, request: rq.Request) -> DataFrame:
    """The request's areas of a result table; aoi_type is added where the table lacks it."""
    out = table.where(F.col("aoi_id").isin(*request.area.ids))
    return out if "aoi_type" in out.columns else out.withColumn("aoi_type", F.lit("admin"))


def loss_query(r: rq.TreeCoverLoss) -> ZonalQuery:
    filters = [Filter("loss_year", ">=", int(r.start_year)), Filter("loss_year", "<=", int(r.end_year))]
    if r.canopy_cover is not None:
        filters.append(Filter("canopy", ">=", r.canopy_cover))
    if r.forest_filter in ("primary_forest", "intact_forest"):
        filters.append(Filter(r.forest_filter.split("_")[0], "=", 1))
    by = ["loss_driver" if "driver" in r.intersections else "loss_year"]
    if r.forest_filter == "natural_forest":
        by.append("natural_forest")
    measures = ["area", "carbon", *(["fire_area"] if "fire" in r.intersections else [])]
    return ZonalQuery(tuple(measures), "sum", tuple(by), tuple(filters))


def tree_cover_loss(r: rq.TreeCoverLoss, tables: Tables) -> DataFrame:
    out = answer(loss_query(r), r.area.type, list(r.area.ids), tables.get("tree_cover_loss"), lambda: tables["pixels"])
    out = out.withColumn("carbon_emissions_MgCO2e", carbon_if_valid("carbon_emissions_MgCO2e", r.canopy_cover))
    if "fire" in r.intersections:
        out = out.withColumn("tree_cover_loss_from_non_fires_area_ha", F.col("area_ha") - F.col("tree_cover_loss_from_fires_area_ha"))
    return out


def tree_cover(r: rq.TreeCover, tables: Tables) -> DataFrame:
    filters = [Filter("canopy", ">=", r.canopy_cover)] + [Filter("primary", "=", 1)] * (r.forest_filter == "primary_forest")
    query = ZonalQuery(("area",), filters=tuple(filters))
    return answer(query, r.area.type, list(r.area.ids), tables.get("tree_cover"), lambda: tables["pixels"])


def tree_cover_gain(r: rq.TreeCoverGain, tables: Tables) -> DataFrame:
    query = ZonalQuery(("area",), group_by=("gain_period",), filters=(Filter("gain_period", "in", periods(int(r.start_year), int(r.end_year))),))
    return answer(query, r.area.type, list(r.area.ids), tables.get("tree_cover_gain"), lambda: tables["pixels"])


def carbon_flux(r: rq.CarbonFlux, tables: Tables) -> DataFrame:
    """Stored sums at the threshold; over pixels, gross emissions count canopy alone."""
    names = {f"carbon_{n}_Mg_CO2e": f"carbon_{n}" for n in ("net_flux", "gross_removals", "gross_emissions")}
    if _admin(r):
        return _own(tables["carbon_flux"], r).where(F.col("tree_cover_density") == r.canopy_cover).select(*AREA, *names)
    p = tables["pixels"]
    code = {v: k for k, v in codes.CANOPY_PERCENT.items()}[r.canopy_cover]
    forest, canopy = counts_as_forest(code), F.col("canopy_cover") >= code
    return zonal(p, AREA, {n: F.when(canopy if "emissions" in c else forest, F.col(c)) for n, c in names.items()})


def day_bounds(start: str, end: str) -> tuple[date, date]:
    """First and last date whose text (YYYY-MM-DD) lies between two texts; dates compare as texts do."""
    days = range(date(1000, 1, 1).toordinal(), date.max.toordinal() + 1)
    text = lambda o: date.fromordinal(o).isoformat()
    first, after = bisect.bisect_left(days, start, key=text), bisect.bisect_right(days, end, key=text)
    return date.fromordinal(days[min(first, len(days) - 1)]), date.fromordinal(days[max(after, 1) - 1])


def _days_after(day: date, epoch: str) -> int:
    return (day - date.fromisoformat(epoch)).days


_ALERT_CLASS = {"driver": "driver", "natural_lands": "natural_land_class", "grasslands": "grasslands", "land_cover": "land_cover"}


def disturbance_alerts(r: rq.DisturbanceAlerts, tables: Tables) -> DataFrame:
    """Areas by day and confidence, and by one class if asked.

    All administrative areas of a request are answered in one job: each level
    joins its own ids.
    """
    kind = next(iter(r.intersections), None)
    by = [_ALERT_CLASS[kind]] if kind else []
    first, last = day_bounds(r.start_date, r.end_date)
    if _admin(r):
        # Dates are filtered as stored, so that the scan can skip by them, and become texts last.
        table = tables["dist_alerts" + (f"_{kind}" if kind else "")].where(F.col("dist_alert_date").between(F.lit(first), F.lit(last)))
        out, levels = None, ("country", "region", "subregion")
        for level in range(3):
            ids = r.area.at_level(level)
            if not ids:
                continue
            own = levels[: level + 1]
            rows = table.sparkSession.createDataFrame([(*i, ".".join(map(str, i))) for i in ids], ", ".join(["country string", "region int", "subregion int"][: level + 1] + ["aoi_id string"]))
            part = table.join(rows, list(own)).groupBy(*own, *by, "dist_alert_date", "dist_alert_confidence", "aoi_id").agg(F.sum("area_ha").cast("float").alias("area_ha"))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        out = out.withColumns({"aoi_type": F.lit("admin"), "dist_alert_date": date_text("dist_alert_date")})
    else:
        p = tables["pixels"].where(F.col("dist_alert_date").between(*(_days_after(d, codes.DISTURBANCE_EPOCH) for d in (first, last))))
        labels = {"driver": lambda c: label(c, codes.DISTURBANCE_DRIVERS), "natural_lands": natural_flag, "grasslands": lambda c: F.when(c == codes.NATURAL_GRASSLAND, "grasslands").otherwise("non-grasslands"), "land_cover": lambda c: label(c, codes.LAND_COVER)}
        expected = {"dist_alert_confidence": list(codes.CONFIDENCE_DISTURBANCE)}
        if kind in ("driver", "land_cover"):
            expected[by[0]] = list(codes.DISTURBANCE_DRIVERS if kind == "driver" else codes.LAND_COVER)
        out = zonal(p, [*AREA, *by, "dist_alert_date", "dist_alert_confidence"], {"area_ha": "area_ha"}, expected=expected)
        out = out.withColumns({"dist_alert_date": date_text(epoch_date("dist_alert_date")), "dist_alert_confidence": label("dist_alert_confidence", codes.CONFIDENCE_DISTURBANCE)} | {c: labels[kind](F.col(c)) for c in by})
        out = positive(out.groupBy(*AREA, *by, "dist_alert_date", "dist_alert_confidence").agg(F.sum("area_ha").alias("area_ha")))
    return out.orderBy("aoi_id", *by, "dist_alert_date", "dist_alert_confidence")


def integrated_alerts(r: rq.IntegratedAlerts, tables: Tables) -> DataFrame:
    keys = ["alert_date", "alert_confidence"]
    first, last = (date(*map(int, d.split("-"))) for d in (r.start_date, r.end_date))
    if _admin(r):
        out = _own(tables["integrated_alerts"], r).where(F.col("alert_date").between(F.lit(first), F.lit(last)))
    else:
        days = F.col("alert_date").between(*(_days_after(d, codes.INTEGRATED_EPOCH) for d in (first, last)))
        rows = zonal(tables["pixels"].where(days), [*AREA, *keys], {"area_ha": F.col("area_m2") / 10_000}, expected={"alert_confidence": list(codes.CONFIDENCE)})
        out = rows.withColumns({"alert_date": epoch_date("alert_date", codes.INTEGRATED_EPOCH), "alert_confidence": label("alert_confidence", codes.CONFIDENCE)})
        out = positive(out)
    return out.withColumn("alert_date", date_text("alert_date")).select(*AREA, *keys, "area_ha").orderBy("aoi_id", *keys)


def grasslands(r: rq.Grasslands, tables: Tables) -> DataFrame:
    years = F.col("year").between(int(r.start_year), int(r.end_year))
    if _admin(r):
        out = _own(tables["grasslands"], r).where(years)
    else:
        out = zonal(tables["pixels"].where(years & (F.col("grasslands") == codes.NATURAL_GRASSLAND)), [*AREA, "year"], {"area_ha": "area_ha"})
    return out.select(*AREA, "year", "area_ha").orderBy("aoi_id", "year")


def natural_lands(r: rq.NaturalLands, tables: Tables) -> DataFrame:
    if _admin(r):
        return _own(tables["natural_lands"], r).select(*AREA, "natural_lands_class", "area_ha")
    out = zonal(tables["pixels"], [*AREA, "natural_lands_class"], {"area_ha": "area_ha"})
    named = out.withColumn("natural_lands_class", label("natural_lands_class", codes.NATURAL_LANDS, default="Unclassified"))
    return positive(named.groupBy(*AREA, "natural_lands_class").agg(F.sum("area_ha").alias("area_ha")))


def land_cover_change(r: rq.LandCoverChange, tables: Tables) -> DataFrame:
    keys = ["land_cover_class_start", "land_cover_class_end"]
    if _admin(r):
        out = _own(tables["land_cover_change"], r)
    else:
        out = zonal(tables["pixels"], [*AREA, *keys], {"area_ha": "area_ha"}, expected={k: list(codes.LAND_COVER) for k in keys})
        out = out.withColumns({k: label(k, codes.LAND_COVER) for k in keys})
    return positive(out.where(F.col(keys[0]) != F.col(keys[1]))).select(*AREA, *keys, "area_ha")


def land_cover_composition(r: rq.LandCoverComposition, tables: Tables) -> DataFrame:
    if _admin(r):
        out = _own(tables["land_cover_composition"], r)
    else:
        out = zonal(tables["pixels"], [*AREA, "land_cover_class"], {"area_ha": "area_ha"}, expected={"land_cover_class": list(codes.LAND_COVER)})
        out = out.withColumn("land_cover_class", label("land_cover_class", codes.LAND_COVER))
    return positive(out).select(*AREA, "land_cover_class", "area_ha")


def land_inventory(r: rq.LandInventory, tables: Tables) -> dict[str, DataFrame]:
    """Four tables; snapshots and blocks are spread over their years."""
    return {
        "vegetation": _own(tables["inventory_vegetation"], r),
        "agriculture": spread_years(_own(tables["inventory_agriculture"], r)),
        "mineral_soil": spread_years(_own(tables["inventory_mineral_soil"], r)),
        "organic_soil": spread_blocks(_own(tables["inventory_organic_soil"], r), "interval_end_year"),
    }


def emission_factors(r: rq.EmissionFactors, tables: Tables) -> DataFrame:
    out = _own(tables["emission_factors"], r)
    return out.where(F.col("gas_type").isin(*r.gas_types) & F.col("crop_type").isin(*r.crop_types) & F.col("year").between(int(r.start_year), int(r.end_year)))


PRODUCTS = {
    rq.TreeCoverLoss: tree_cover_loss,
    rq.TreeCover: tree_cover,
    rq.TreeCoverGain: tree_cover_gain,
    rq.CarbonFlux: carbon_flux,
    rq.DisturbanceAlerts: disturbance_alerts,
    rq.IntegratedAlerts: integrated_alerts,
    rq.Grasslands: grasslands,
    rq.NaturalLands: natural_lands,
    rq.LandCoverChange: land_cover_change,
    rq.LandCoverComposition: land_cover_composition,
    rq.LandInventory: land_inventory,
    rq.EmissionFactors: emission_factors,
}


def columns(df: DataFrame) -> dict[str, list]:
    """A result as lists by column, for the answer to a request.  Results are small by then."""
    rows = df.toPandas()
    return {c: [None if v is None or v != v else v for v in rows[c].tolist()] for c in rows.columns}
