"""All queries of the zonal engine by name, with the SQL they must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge import sample
from landgauge.functions import codes, geo
from landgauge.functions import expressions as ex
from landgauge.operators import align, checks, reshape, rollup, spatial, thresholds
from landgauge.plans import batch, products, service, validation
from landgauge.plans import requests as rq
from landgauge.sources import tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with SQL after the view of the test tables that it needs."""

    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            words = set(re.findall(r"\w+", sql))
            views = [v for n, v in (("px", sample.PIXELS_SQL), ("grid", sample.GRID_SQL)) if n in words]
            rest = sql.removeprefix("WITH ") if views else sql
            head = f"WITH {', '.join(views)}" + (", " if rest != sql else " ") if views else ""
            _SQL[f.__name__] = head + rest
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _labels(column: str, labels: dict, default: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + f" ELSE {default} END"


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of cents to cents, so that the order of summing shows nowhere."""
    return df.withColumns({n: F.round(n, 2) for n in names})


REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
SOME = rq.Area("protected_area", REGIONS)
_C, _FIRE = "carbon_emissions_MgCO2e", "tree_cover_loss_from_fires_area_ha"
_FOREST = "CASE WHEN natural_lands IN (2, 5, 8, 9) THEN 1 WHEN natural_lands IN (14, 17, 18) THEN 2 ELSE 0 END"
_CANOPY = _labels("canopy", codes.CANOPY_PERCENT).replace("'", "")


def _own(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"pixels": sample.clipped(spark, sf_dir)}


COUNTRIES = tuple(r[:3] for r in REGIONS)
ADMIN = rq.Area("admin", COUNTRIES)


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return sample.pixels(spark, sf_dir), sample.countries(spark, sf_dir)


def _edges_sql() -> str:
    return ", ".join(f"('{n}', {', '.join(f'{v}::DOUBLE' for v in e)})" for n, s in sample.SHAPES.items() for e in geo.edges(s))


_CROSSES = "(y1 > {y}) <> (y2 > {y}) AND {x} < (x2 - x1) * ({y} - y1) / (y2 - y1) + x1"


# Products over pixels.


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, loss + 2000 AS tree_cover_loss_year, sum(area_ha) AS area_ha, round(sum(carbon), 2) AS \"{_C}\" FROM px WHERE canopy >= 5 AND loss BETWEEN 16 AND 20 GROUP BY ALL")
def tcl_by_year(spark, sf_dir):
    return _rounded(products.tree_cover_loss(rq.TreeCoverLoss(SOME, "2016", "2020", 30), _own(spark, sf_dir)), _C)


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, {_labels('driver', codes.LOSS_DRIVERS)} AS tree_cover_loss_driver, sum(area_ha) AS area_ha, round(sum(carbon), 2) AS \"{_C}\" FROM px WHERE canopy >= 5 AND loss BETWEEN 15 AND 21 GROUP BY ALL")
def tcl_by_driver(spark, sf_dir):
    return _rounded(products.tree_cover_loss(rq.TreeCoverLoss(SOME, "2015", "2021", 30, None, ("driver",)), _own(spark, sf_dir)), _C)


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, loss + 2000 AS tree_cover_loss_year, sum(area_ha) AS area_ha, CAST(NULL AS DOUBLE) AS \"{_C}\", sum(CASE WHEN fire > 0 THEN area_ha ELSE 0 END) AS {_FIRE}, sum(CASE WHEN fire > 0 THEN 0 ELSE area_ha END) AS tree_cover_loss_from_non_fires_area_ha FROM px WHERE canopy >= 3 AND intact_code = 1 AND loss BETWEEN 15 AND 21 GROUP BY ALL")
def tcl_fires(spark, sf_dir):
    return products.tree_cover_loss(rq.TreeCoverLoss(SOME, "2015", "2021", 20, "intact_forest", ("fire",)), _own(spark, sf_dir))


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, loss + 2000 AS tree_cover_loss_year, {_labels(_FOREST, codes.NATURAL_FORESTS)} AS natural_forests_class, sum(area_ha) AS area_ha, round(sum(carbon), 2) AS \"{_C}\" FROM px WHERE loss = 21 GROUP BY ALL")
def tcl_natural_forest(spark, sf_dir):
    return _rounded(products.tree_cover_loss(rq.TreeCoverLoss(SOME, "2021", "2021", None, "natural_forest"), _own(spark, sf_dir)), _C)


@query("SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, sum(area_ha) AS area_ha FROM px WHERE canopy >= 5 GROUP BY ALL")
def tree_cover_sum(spark, sf_dir):
    return products.tree_cover(rq.TreeCover(SOME, 30), _own(spark, sf_dir))


@query("SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, sum(area_ha) AS area_ha FROM px WHERE canopy >= 2 AND primary_code = 1 GROUP BY ALL")
def tree_cover_primary(spark, sf_dir):
    return products.tree_cover(rq.TreeCover(SOME, 15, "primary_forest"), _own(spark, sf_dir))


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, {_labels('period', codes.GAIN_PERIODS)} AS tree_cover_gain_period, sum(area_ha) AS area_ha FROM px WHERE period IN (2, 3, 4) GROUP BY ALL")
def tcg_periods(spark, sf_dir):
    return products.tree_cover_gain(rq.TreeCoverGain(SOME, "2005", "2020"), _own(spark, sf_dir))


@query("SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, round(sum(CASE WHEN canopy >= 6 OR mangrove = 1 OR gain > 0 THEN carbon END), 2) AS \"carbon_net_flux_Mg_CO2e\", sum(CASE WHEN canopy >= 6 OR mangrove = 1 OR gain > 0 THEN -area_ha END) AS \"carbon_gross_removals_Mg_CO2e\", round(sum(CASE WHEN canopy >= 6 THEN carbon END), 2) AS \"carbon_gross_emissions_Mg_CO2e\" FROM px GROUP BY ALL")
def carbon_flux_pixels(spark, sf_dir):
    return _rounded(products.carbon_flux(rq.CarbonFlux(SOME, 50), _own(spark, sf_dir)), "carbon_net_flux_Mg_CO2e", "carbon_gross_emissions_Mg_CO2e")


def _alert_sql(name: str | None = None, text: str = "", where: str = "true") -> str:
    extra = f", {text} AS {name}" if name else ""
    return f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type{extra}, strftime(DATE '2020-12-31' + alert_day, '%Y-%m-%d') AS dist_alert_date, CASE confidence WHEN 2 THEN 'low' ELSE 'high' END AS dist_alert_confidence, sum(area_ha) AS area_ha FROM px WHERE confidence IN (2, 3) AND {where} AND strftime(DATE '2020-12-31' + alert_day, '%Y-%m-%d') BETWEEN '2022' AND '2024-06-30' GROUP BY ALL"


def _alerts(spark, sf_dir, *kind):
    return products.disturbance_alerts(rq.DisturbanceAlerts(SOME, "2022", "2024-06-30", kind), _own(spark, sf_dir))


@query(_alert_sql())
def dist_pixels(spark, sf_dir):
    return _alerts(spark, sf_dir)


@query(_alert_sql("driver", _labels("driver", codes.DISTURBANCE_DRIVERS), "driver BETWEEN 1 AND 5"))
def dist_by_driver(spark, sf_dir):
    return _alerts(spark, sf_dir, "driver")


@query(_alert_sql("natural_land_class", "CASE WHEN natural_lands > 1 AND natural_lands < 12 THEN 'natural' ELSE 'non-natural' END"))
def dist_by_natural_lands(spark, sf_dir):
    return _alerts(spark, sf_dir, "natural_lands")


@query(_alert_sql("grasslands", "CASE WHEN grassland_code = 2 THEN 'grasslands' ELSE 'non-grasslands' END"))
def dist_by_grasslands(spark, sf_dir):
    return _alerts(spark, sf_dir, "grasslands")


@query(_alert_sql("land_cover", _labels("land_cover_end", codes.LAND_COVER)))
def dist_by_land_cover(spark, sf_dir):
    return _alerts(spark, sf_dir, "land_cover")


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, strftime(DATE '2014-12-31' + alert_day, '%Y-%m-%d') AS alert_date, {_labels('confidence', codes.CONFIDENCE)} AS alert_confidence, sum(area_m2 / 10000) AS area_ha FROM px WHERE DATE '2014-12-31' + alert_day BETWEEN DATE '2016-02-01' AND DATE '2018-12-31' GROUP BY ALL")
def integrated_pixels(spark, sf_dir):
    return products.integrated_alerts(rq.IntegratedAlerts(SOME, "2016-02-01", "2018-12-31"), _own(spark, sf_dir))


@query("SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, ship_year AS year, sum(area_ha) AS area_ha FROM px WHERE grassland_code = 2 AND ship_year BETWEEN 2000 AND 2001 GROUP BY ALL")
def grassland_by_year(spark, sf_dir):
    return products.grasslands(rq.Grasslands(SOME, "2000", "2001"), _own(spark, sf_dir))


@query("SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, " + _labels("natural_lands", codes.NATURAL_LANDS, "'Unclassified'") + " AS natural_lands_class, sum(area_ha) AS area_ha FROM px GROUP BY ALL")
def natural_lands_pixels(spark, sf_dir):
    return products.natural_lands(rq.NaturalLands(SOME), _own(spark, sf_dir))


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, {_labels('land_cover_start', codes.LAND_COVER)} AS land_cover_class_start, {_labels('land_cover_end', codes.LAND_COVER)} AS land_cover_class_end, sum(area_ha) AS area_ha FROM px WHERE land_cover_start <> land_cover_end GROUP BY ALL")
def lc_transition(spark, sf_dir):
    return products.land_cover_change(rq.LandCoverChange(SOME), _own(spark, sf_dir))


@query(f"SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, {_labels('land_cover_end', codes.LAND_COVER)} AS land_cover_class, sum(area_ha) AS area_ha FROM px GROUP BY ALL")
def lc_composition(spark, sf_dir):
    return products.land_cover_composition(rq.LandCoverComposition(SOME), _own(spark, sf_dir))


# Batch tables and the products answered from them.


def _rollup_sql(rows: str, keys: list[str], measures: dict[str, str]) -> str:
    """Roll-up of ``rows`` (SQL giving country, region, subregion, keys, measures)."""
    names = "".join(f"{k}, " for k in keys)
    sums = ", ".join(f'{e} AS "{n}"' for n, e in measures.items())
    level = lambda i, where: f"SELECT {i} AS aoi_id, 'admin' AS aoi_type, {names}{sums} FROM base WHERE {where} GROUP BY ALL"
    return f"WITH base AS ({rows}) {level('country', 'true')} UNION ALL {level(chr(39).join(('country || ', '.', ' || region')), 'region <> 0')} UNION ALL {level(chr(39).join(('country || ', '.', ' || region || ', '.', ' || subregion')), 'region <> 0 AND subregion <> 0')}"


_ADMIN = "iso AS country, region, subregion"


@query(_rollup_sql(f"SELECT {_ADMIN}, confidence, area_ha, carbon FROM px", ["confidence"], {"area_ha": "sum(area_ha)", "carbon": "round(sum(carbon), 2)"}))
def gadm_rollup(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return _rounded(rollup.admin_rollup(rollup.with_country(px, iso), ["confidence"], ["area_ha", "carbon"]), "carbon")


def _loss_table(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.loss(px.withColumnsRenamed({"intact_code": "intact", "primary_code": "primary"}), iso)


_LOSS_KEYS = "loss + 2000 AS tree_cover_loss_year, intact_code = 1 AS is_intact_forest, " + _labels("driver", codes.LOSS_DRIVERS_STORED) + " AS tree_cover_loss_driver, primary_code = 1 AS is_primary_forest, " + _labels(_FOREST, codes.NATURAL_FORESTS_STORED) + " AS natural_forests_class"
_LOSS_ROWS = f"""SELECT {_ADMIN}, {_LOSS_KEYS}, canopy_cover, area_ha, fire_area, carbon FROM (
  SELECT *, {_CANOPY} AS canopy_cover, 0.0 AS carbon, CASE WHEN fire > 0 THEN area_ha ELSE 0 END AS fire_area FROM (SELECT * EXCLUDE (carbon) FROM px)
  UNION ALL BY NAME
  SELECT p.* EXCLUDE (area_ha, carbon), t AS canopy_cover, 0.0 AS area_ha, 0.0 AS fire_area,
         CASE WHEN ({_CANOPY} >= 75 OR mangrove = 1 OR gain > 0 OR {_CANOPY} >= t) AND t = 75 THEN carbon WHEN NOT (mangrove = 1 OR gain > 0) AND {_CANOPY} >= t AND {_CANOPY} < n THEN carbon ELSE 0.0 END AS carbon
  FROM px p, (VALUES (30, 50), (50, 75), (75, 999)) v(t, n) WHERE {_CANOPY} >= t OR mangrove = 1 OR gain > 0
)"""


@query(_rollup_sql(_LOSS_ROWS, batch.LOSS_CONTEXT, {"area_ha": "sum(area_ha)", _C: "round(sum(carbon), 2)", _FIRE: "sum(fire_area)"}))
def tcl_table(spark, sf_dir):
    """The loss table whose carbon, summed from a threshold on, is that of the threshold."""
    out = _loss_table(spark, sf_dir)
    return _rounded(out, _C).withColumn(_C, F.col(_C) + 0.0)


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, loss + 2000 AS tree_cover_loss_year, sum(CASE WHEN canopy >= 6 THEN area_ha ELSE 0 END) AS area_ha, round(sum(carbon), 2) AS \"{_C}\" FROM px WHERE (canopy >= 6 OR mangrove = 1 OR gain > 0) AND loss BETWEEN 16 AND 20 GROUP BY ALL")
def tcl_admin(spark, sf_dir):
    """Answered from the loss table: carbon at 50 percent counts mangroves and height gain."""
    out = products.tree_cover_loss(rq.TreeCoverLoss(ADMIN, "2016", "2020", 50), {"tree_cover_loss": _loss_table(spark, sf_dir)})
    return _rounded(out, _C)


@query(_rollup_sql(f"SELECT {_ADMIN}, t AS tree_cover_density, carbon, area_ha FROM px, (VALUES (30), (50), (75)) v(t) WHERE {_CANOPY} >= t OR mangrove = 1 OR gain > 0", ["tree_cover_density"], {"carbon_net_flux_Mg_CO2e": "round(sum(carbon), 2)", "carbon_gross_removals_Mg_CO2e": "sum(-area_ha)", "carbon_gross_emissions_Mg_CO2e": "round(sum(carbon) * 2, 2)"}))
def carbon_thresholds(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    out = batch.carbon_flux(px.withColumns({"carbon_net_flux": F.col("carbon"), "carbon_gross_removals": -F.col("area_ha"), "carbon_gross_emissions": F.col("carbon") * 2}), iso)
    return _rounded(out, "carbon_net_flux_Mg_CO2e", "carbon_gross_emissions_Mg_CO2e")


@query(f"WITH a AS (SELECT iso AS country, t, round(sum(carbon), 2) AS v FROM px, (VALUES (30), (50), (75)) x(t) WHERE {_CANOPY} >= t OR mangrove = 1 OR gain > 0 GROUP BY ALL) SELECT country, t AS canopy_cover, round(v - coalesce(lead(v) OVER (PARTITION BY country ORDER BY t), 0), 2) AS carbon FROM a")
def carbon_unaccumulate(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    px = rollup.with_country(px, iso).withColumns({"canopy_cover": ex.canopy_percent("canopy"), "mangrove_stock_2000": F.col("mangrove"), "tree_cover_gain_from_height": F.col("gain")})
    return _rounded(thresholds.unaccumulate(thresholds.accumulate(px, ["country"], ["carbon"]), ["country"], "carbon"), "carbon").select("country", "canopy_cover", "carbon")


_DIST = "strftime(DATE '2020-12-31' + alert_day, '%Y-%m-%d') AS dist_alert_date, CASE confidence WHEN 2 THEN 'low' ELSE 'high' END AS dist_alert_confidence, CAST(sum(area_ha) AS FLOAT) AS area_ha FROM px WHERE confidence IN (2, 3) AND alert_day BETWEEN 731 AND 3287"


def _disturbance(spark, sf_dir, kind=None):
    px, iso = _tables(spark, sf_dir)
    return batch.disturbance(px.withColumns({"grasslands": F.col("grassland_code"), "land_cover": F.col("land_cover_end")}), iso, kind).withColumn("dist_alert_date", ex.date_text("dist_alert_date"))


@query(f"SELECT {_ADMIN}, {_DIST} GROUP BY ALL")
def dist_table(spark, sf_dir):
    return _disturbance(spark, sf_dir)


@query(f"SELECT {_ADMIN}, {_labels('driver', codes.DISTURBANCE_DRIVERS)} AS driver, {_DIST} AND driver BETWEEN 1 AND 5 GROUP BY ALL")
def dist_table_driver(spark, sf_dir):
    return _disturbance(spark, sf_dir, "driver")


@query(f"SELECT {_ADMIN}, CASE WHEN grassland_code = 2 THEN 'grasslands' ELSE 'non-grasslands' END AS grasslands, {_DIST} GROUP BY ALL")
def dist_table_grasslands(spark, sf_dir):
    return _disturbance(spark, sf_dir, "grasslands")


@query(f"SELECT {_ADMIN}, {_labels('land_cover_end', codes.LAND_COVER)} AS land_cover, {_DIST} GROUP BY ALL")
def dist_table_land_cover(spark, sf_dir):
    return _disturbance(spark, sf_dir, "land_cover")


@query("SELECT " + _ADMIN + ", " + _labels("natural_lands", codes.NATURAL_LANDS, "'Unclassified'") + f" AS natural_land_class, {_DIST} GROUP BY ALL")
def dist_table_natural_lands(spark, sf_dir):
    return _disturbance(spark, sf_dir, "natural_lands")


def _dist_admin(spark, sf_dir, ids):
    px, iso = _tables(spark, sf_dir)
    return products.disturbance_alerts(rq.DisturbanceAlerts(rq.Area("admin", tuple(ids)), "2023-01-01", "2026"), {"dist_alerts": batch.disturbance(px, iso)})


def _dist_admin_sql(level: int) -> str:
    own = ["iso AS country", "region", "subregion"][: level + 1]
    name = " || '.' || ".join(["iso", "region", "subregion"][: level + 1])
    where = ["true", "region > 0", "region > 0 AND subregion IN (2, 3)"][level]
    return f"SELECT {', '.join(own)}, {_DIST} AND strftime(DATE '2020-12-31' + alert_day, '%Y-%m-%d') BETWEEN '2023-01-01' AND '2026' AND iso IN ('ASI', 'EUR', 'AME') AND {where} GROUP BY ALL".replace(" AS area_ha FROM", f" AS area_ha, {name} AS aoi_id, 'admin' AS aoi_type FROM")


@query(_dist_admin_sql(0))
def dist_admin0(spark, sf_dir):
    return _dist_admin(spark, sf_dir, ["ASI", "EUR", "AME"])


@query(_dist_admin_sql(1))
def dist_admin1(spark, sf_dir):
    return _dist_admin(spark, sf_dir, [f"{c}.{r}" for c in ("ASI", "EUR", "AME") for r in range(1, 25)])


@query(_dist_admin_sql(2))
def dist_admin2(spark, sf_dir):
    return _dist_admin(spark, sf_dir, [f"{c}.{r}.{q}" for c in ("ASI", "EUR", "AME") for r in range(1, 25) for q in (2, 3)])


@query(_rollup_sql(f"SELECT {_ADMIN}, strftime(DATE '2014-12-31' + alert_day, '%Y-%m-%d') AS alert_date, {_labels('confidence', codes.CONFIDENCE)} AS alert_confidence, area_m2 / 10000 AS a FROM px WHERE alert_day >= 2000", ["alert_date", "alert_confidence"], {"area_ha": "sum(a)"}))
def integrated_table(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.integrated(px, iso, 2000).withColumn("alert_date", ex.date_text("alert_date"))


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, strftime(DATE '2014-12-31' + alert_day, '%Y-%m-%d') AS alert_date, {_labels('confidence', codes.CONFIDENCE)} AS alert_confidence, sum(area_m2 / 10000) AS area_ha FROM px WHERE DATE '2014-12-31' + alert_day BETWEEN DATE '2019-01-01' AND DATE '2020-12-31' GROUP BY ALL")
def integrated_scan(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return products.integrated_alerts(rq.IntegratedAlerts(ADMIN, "2019-01-01", "2020-12-31"), {"integrated_alerts": batch.integrated(px, iso, 0).drop("aoi_type")})


@query(f"SELECT {_ADMIN}, ship_year AS year, sum(area_ha) AS area_ha FROM px WHERE grassland_code = 2 GROUP BY ALL")
def grasslands_table(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.grasslands(px.withColumnsRenamed({"grassland_code": "grasslands", "ship_year": "year"}), iso)


@query("SELECT " + _ADMIN + ", CASE WHEN natural_lands > 1 AND natural_lands < 12 THEN 'natural' ELSE 'non-natural' END AS natural_flag, " + _labels("natural_lands", codes.NATURAL_LANDS, "'unclassified'") + " AS natural_lands_class, sum(area_ha) AS area_ha FROM px GROUP BY iso, region, subregion, natural_lands, natural_flag, natural_lands_class")
def natural_lands_flag(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.natural_lands(px, iso)


_STATE = "CASE land_state WHEN 11100000 THEN 'tree_loss' WHEN 21100000 THEN 'tree_gain' WHEN 13200000 THEN 'trees_remaining_trees' ELSE 'non_trees_remaining_non_trees' END"
def _rates() -> dict:
    return {"gross_emissions_MgCO2e": F.col("driver").cast("double"), "gross_removals_MgCO2": -F.col("canopy").cast("double"), "net_flux_MgCO2e": (F.col("driver") - F.col("canopy")).cast("double")}

_AMOUNTS = {"gross_emissions_MgCO2e": "sum(area_ha * driver)", "gross_removals_MgCO2": "sum(-area_ha * canopy)", "net_flux_MgCO2e": "sum(area_ha * (driver - canopy))", "area_ha": "sum(area_ha)"}


@query(_rollup_sql(f"SELECT {_ADMIN}, {_STATE} AS land_state_class, ship_year AS year, area_ha, driver, canopy FROM px WHERE land_state <> 70000000", ["land_state_class", "year"], _AMOUNTS))
def ghg_vegetation(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.vegetation(px.withColumns(_rates() | {"year": F.col("ship_year")}), iso)


@query(_rollup_sql(f"SELECT {_ADMIN}, category, CASE category WHEN 'cropland' THEN area_ha ELSE area_ha * 2 END AS e FROM px, (VALUES ('cropland'), ('livestock')) c(category)", ["category"], {"gross_emissions_MgCO2e": "sum(e)"}))
def ghg_agriculture(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.agriculture(px.withColumns({"cropland": F.col("area_ha"), "livestock": F.col("area_ha") * 2}), iso)


@query(_rollup_sql(f"SELECT {_ADMIN}, area_ha, driver, canopy FROM px", [], _AMOUNTS))
def ghg_mineral_soil(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.mineral_soil(px.withColumns(_rates()), iso)


@query(_rollup_sql(f"SELECT {_ADMIN}, block AS interval_end_year, area_ha, driver, mangrove FROM px", ["interval_end_year"], {"gross_emissions_MgCO2e": "sum(area_ha * (driver + 1))", "area_ha": "sum(area_ha * mangrove)"}))
def ghg_organic_soil(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.organic_soil(px.withColumns({"burned": F.col("driver").cast("double"), "drained": F.lit(1.0), "organic": F.col("mangrove").cast("double"), "interval_end_year": F.col("block")}), iso)


@query("SELECT country_name AS aoi_id, 'admin' AS aoi_type, sum(area_ha) AS area_ha, y AS year FROM px, range(2016, 2025) r(y) GROUP BY ALL")
def ghg_explode_years(spark, sf_dir):
    px, _ = _tables(spark, sf_dir)
    return reshape.spread_years(rollup.zonal(px.withColumn("aoi_id", F.col("country_name")), ["aoi_id"], {"area_ha": "area_ha"}).withColumn("aoi_type", F.lit("admin"))).select("aoi_id", "aoi_type", "area_ha", F.col("year").cast("long").alias("year"))


@query("SELECT country_name AS aoi_id, sum(area_ha) AS area_ha, y AS year FROM px, range(2016, 2025) r(y) WHERE (block = 2020) = (y <= 2020) GROUP BY ALL")
def ghg_explode_blocks(spark, sf_dir):
    px, _ = _tables(spark, sf_dir)
    return reshape.spread_blocks(rollup.zonal(px.withColumn("aoi_id", F.col("country_name")), ["aoi_id", "block"], {"area_ha": "area_ha"}), "block").select("aoi_id", "area_ha", F.col("year").cast("long").alias("year"))


@query("SELECT country_name AS country, coalesce(sum(CASE WHEN driver = 1 THEN area_ha END), 0) AS \"1\", coalesce(sum(CASE WHEN driver = 2 THEN area_ha END), 0) AS \"2\", 0.0::DOUBLE AS \"99\" FROM px GROUP BY ALL")
def ghg_pivot_dense(spark, sf_dir):
    px, _ = _tables(spark, sf_dir)
    return reshape.pivot_dense(px, ["country_name"], "driver", "area_ha", [1, 2, 99]).withColumnRenamed("country_name", "country")


@query(_rollup_sql(f"SELECT {_ADMIN}, {_labels('land_cover_start', codes.LAND_COVER)} AS land_cover_class_start, {_labels('land_cover_end', codes.LAND_COVER)} AS land_cover_class_end, area_ha FROM px", ["land_cover_class_start", "land_cover_class_end"], {"area_ha": "sum(area_ha)"}))
def lc_change_table(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.land_cover_change(px, iso)


@query(_rollup_sql(f"SELECT {_ADMIN}, {_labels('land_cover_end', codes.LAND_COVER)} AS land_cover_class, area_ha FROM px", ["land_cover_class"], {"area_ha": "sum(area_ha)"}))
def lc_composition_table(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.land_cover_composition(px, iso)


@query(f"SELECT {_ADMIN}, confidence, count(CASE WHEN canopy > 2 THEN 1 END) AS count FROM px GROUP BY ALL")
def count_non_nan(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    return batch.pixel_counts(px.withColumn("v", F.when(F.col("canopy") > 2, F.lit(1.0)).otherwise(F.lit(float("nan")))), iso, ["confidence"], "v")


@query("SELECT split_part(gid, '_', 1) AS aoi_id, crop AS crop_type, gas_type, 'admin' AS aoi_type, y AS year, CASE y WHEN 2020 THEN e20 ELSE e21 END AS emissions, CASE y WHEN 2020 THEN p20 END AS production FROM (SELECT n_name || '_1' AS gid, p_type AS crop, 'CO2e' AS gas_type, CAST(count(*) AS DOUBLE) AS e20, CAST(sum(l_linenumber) AS DOUBLE) AS e21, sum(l_quantity) AS p20 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey GROUP BY ALL), (VALUES (2020), (2021)) v(y)")
def luc_melt_pivot(spark, sf_dir):
    t = {n: sample.read(spark, sf_dir, n) for n in ("lineitem", "supplier", "nation", "part")}
    rows = t["lineitem"].join(t["supplier"], F.expr("l_suppkey = s_suppkey")).join(t["nation"], F.expr("s_nationkey = n_nationkey")).join(t["part"], F.expr("l_partkey = p_partkey"))
    wide = rows.groupBy(F.expr("n_name || '_1'").alias("gid"), F.col("p_type").alias("crop"), F.lit("CO2e").alias("gas_type")).agg(F.count("*").cast("double").alias("2020_emissions"), F.sum("l_linenumber").cast("double").alias("emissions_2021"), F.sum("l_quantity").alias("production_2020"))
    return batch.emission_factors(wide)


# Administrative areas answered from roll-up tables.


def _rolled(spark, sf_dir, keys: dict, measures: dict | None = None) -> DataFrame:
    px, iso = _tables(spark, sf_dir)
    px = rollup.with_country(px.withColumns(keys | (measures or {})), iso)
    return rollup.admin_rollup(px, list(keys), ["area_ha", *(measures or {})])


@query("SELECT iso AS aoi_id, 'admin' AS aoi_type, sum(area_ha) AS area_ha FROM px WHERE canopy >= 5 AND primary_code = 1 GROUP BY ALL")
def tree_cover_admin(spark, sf_dir):
    table = _rolled(spark, sf_dir, {"canopy_cover": ex.canopy_percent("canopy"), "is_primary_forest": F.col("primary_code") == 1})
    return products.tree_cover(rq.TreeCover(ADMIN, 30, "primary_forest"), {"tree_cover": table})


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, {_labels('period', codes.GAIN_PERIODS)} AS tree_cover_gain_period, sum(area_ha) AS area_ha FROM px WHERE period IN (2, 3) GROUP BY ALL")
def tree_cover_gain_admin(spark, sf_dir):
    table = _rolled(spark, sf_dir, {"tree_cover_gain_period": ex.label("period", codes.GAIN_PERIODS)})
    return products.tree_cover_gain(rq.TreeCoverGain(ADMIN, "2005", "2015"), {"tree_cover_gain": table})


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, round(sum(carbon), 2) AS \"carbon_net_flux_Mg_CO2e\", sum(-area_ha) AS \"carbon_gross_removals_Mg_CO2e\", round(sum(carbon) * 2, 2) AS \"carbon_gross_emissions_Mg_CO2e\" FROM px WHERE {_CANOPY} >= 50 OR mangrove = 1 OR gain > 0 GROUP BY ALL")
def carbon_flux_admin(spark, sf_dir):
    return products.carbon_flux(rq.CarbonFlux(ADMIN, 50), {"carbon_flux": carbon_thresholds(spark, sf_dir)})


@query("SELECT iso AS aoi_id, 'admin' AS aoi_type, ship_year AS year, sum(area_ha) AS area_ha FROM px WHERE grassland_code = 2 AND ship_year BETWEEN 2000 AND 2001 GROUP BY ALL")
def grasslands_admin(spark, sf_dir):
    table = rollup.admin_rollup(grasslands_table(spark, sf_dir), ["year"], ["area_ha"])
    return products.grasslands(rq.Grasslands(ADMIN, "2000", "2001"), {"grasslands": table})


@query("SELECT iso AS aoi_id, 'admin' AS aoi_type, " + _labels("natural_lands", codes.NATURAL_LANDS, "'unclassified'") + " AS natural_lands_class, sum(area_ha) AS area_ha FROM px GROUP BY ALL")
def natural_lands_admin(spark, sf_dir):
    table = rollup.admin_rollup(natural_lands_flag(spark, sf_dir), ["natural_lands_class"], ["area_ha"])
    return products.natural_lands(rq.NaturalLands(ADMIN), {"natural_lands": table})


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, {_labels('land_cover_start', codes.LAND_COVER)} AS land_cover_class_start, {_labels('land_cover_end', codes.LAND_COVER)} AS land_cover_class_end, sum(area_ha) AS area_ha FROM px WHERE land_cover_start <> land_cover_end GROUP BY ALL")
def lc_change_admin(spark, sf_dir):
    return products.land_cover_change(rq.LandCoverChange(ADMIN), {"land_cover_change": lc_change_table(spark, sf_dir)})


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, {_labels('land_cover_end', codes.LAND_COVER)} AS land_cover_class, sum(area_ha) AS area_ha FROM px GROUP BY ALL")
def lc_composition_admin(spark, sf_dir):
    return products.land_cover_composition(rq.LandCoverComposition(ADMIN), {"land_cover_composition": lc_composition_table(spark, sf_dir)})


def _inventory(spark, sf_dir, part: str) -> DataFrame:
    tables_ = {"inventory_vegetation": ghg_vegetation, "inventory_agriculture": ghg_agriculture, "inventory_mineral_soil": ghg_mineral_soil, "inventory_organic_soil": ghg_organic_soil}
    out = products.land_inventory(rq.LandInventory(ADMIN), {n: f(spark, sf_dir) for n, f in tables_.items()})[part]
    return out.withColumn("year", F.col("year").cast("long"))


_SUMS = ", ".join(f'{e} AS "{n}"' for n, e in _AMOUNTS.items())


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, {_STATE} AS land_state_class, CAST(ship_year AS BIGINT) AS year, {_SUMS} FROM px WHERE land_state <> 70000000 GROUP BY ALL")
def inventory_vegetation(spark, sf_dir):
    return _inventory(spark, sf_dir, "vegetation")


@query("SELECT iso AS aoi_id, 'admin' AS aoi_type, category, sum(CASE category WHEN 'cropland' THEN area_ha ELSE area_ha * 2 END) AS \"gross_emissions_MgCO2e\", y AS year FROM px, (VALUES ('cropland'), ('livestock')) c(category), range(2016, 2025) r(y) GROUP BY ALL")
def inventory_agriculture(spark, sf_dir):
    return _inventory(spark, sf_dir, "agriculture")


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, {_SUMS}, y AS year FROM px, range(2016, 2025) r(y) GROUP BY ALL")
def inventory_mineral_soil(spark, sf_dir):
    return _inventory(spark, sf_dir, "mineral_soil")


@query("SELECT iso AS aoi_id, 'admin' AS aoi_type, sum(area_ha * (driver + 1)) AS \"gross_emissions_MgCO2e\", sum(area_ha * mangrove) AS area_ha, y AS year FROM px, range(2016, 2025) r(y) WHERE (block = 2020) = (y <= 2020) GROUP BY ALL")
def inventory_organic_soil(spark, sf_dir):
    return _inventory(spark, sf_dir, "organic_soil")


@query("WITH s AS (SELECT substr(r_name, 1, 3) AS aoi_id, p_size % 3 AS crop, p_size % 2 AS gas, CAST(count(*) AS DOUBLE) AS e20, CAST(sum(l_linenumber) AS DOUBLE) AS e21, CAST(sum(l_quantity) AS DOUBLE) AS e22 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY ALL) SELECT aoi_id, 'admin' AS aoi_type, CASE crop WHEN 1 THEN 'Maize' WHEN 2 THEN 'Rice' END AS crop_type, 'CH4' AS gas_type, y AS year, CASE y WHEN 2021 THEN e21 ELSE e22 END AS emissions FROM s, (VALUES (2021), (2022)) v(y) WHERE crop IN (1, 2) AND gas = 1")
def emission_factors_admin(spark, sf_dir):
    t = {n: sample.read(spark, sf_dir, n) for n in ("lineitem", "supplier", "nation", "region", "part")}
    rows = t["lineitem"].join(t["supplier"], F.expr("l_suppkey = s_suppkey")).join(t["nation"], F.expr("s_nationkey = n_nationkey")).join(t["region"], F.expr("n_regionkey = r_regionkey")).join(t["part"], F.expr("l_partkey = p_partkey"))
    keys = [F.expr("substr(r_name, 1, 3) || '_1'").alias("gid"), F.expr("string(p_size % 3)").alias("crop"), F.when(F.col("p_size") % 2 == 1, "CH4").otherwise("CO2").alias("gas_type")]
    wide = rows.groupBy(*keys).agg(F.count("*").cast("double").alias("2020_emissions"), F.sum("l_linenumber").cast("double").alias("2021_emissions"), F.sum("l_quantity").cast("double").alias("2022_emissions"))
    crops = spark.createDataFrame([("1", "Maize"), ("2", "Rice")], "crop string, crop_type string")
    request = rq.EmissionFactors(ADMIN, ("CH4",), ("Maize", "Rice", "Wheat"), "2021", "2024")
    return products.emission_factors(request, {"emission_factors": batch.emission_factors(wide, crops)})


# Features of a request, clipped.


def _features_sql(columns: str, where: str) -> str:
    hit = _CROSSES.format(x="x", y="y")
    return f"WITH e(aoi_id, x1, y1, x2, y2) AS (VALUES {_edges_sql()}), hit AS (SELECT aoi_id, x, y FROM (SELECT DISTINCT lon AS x, lat AS y FROM px) d, e WHERE {hit} GROUP BY ALL HAVING count(*) % 2 = 1) SELECT aoi_id, 'feature_collection' AS aoi_type, {columns} FROM px JOIN hit ON lon = x AND lat = y WHERE {where} GROUP BY ALL"


def _of_features(spark, sf_dir, request: rq.Request) -> dict[str, DataFrame]:
    grid = align.Grid(sample.X0, sample.Y0, sample.RESOLUTION)
    return service.pixel_sources(sample.placed(spark, sf_dir), grid, sample.EXTENT, {}, 0.001)(request)


FEATURES = rq.Area("feature_collection", features=sample.FEATURES)


@query(_features_sql(f'loss + 2000 AS tree_cover_loss_year, sum(area_ha) AS area_ha, round(sum(carbon), 2) AS "{_C}"', "canopy >= 5 AND loss BETWEEN 12 AND 20"))
def tcl_polygon(spark, sf_dir):
    request = rq.TreeCoverLoss(FEATURES, "2012", "2020", 30)
    return _rounded(products.tree_cover_loss(request, _of_features(spark, sf_dir, request)), _C)


@query(_features_sql("strftime(DATE '2020-12-31' + alert_day, '%Y-%m-%d') AS dist_alert_date, CASE confidence WHEN 2 THEN 'low' ELSE 'high' END AS dist_alert_confidence, sum(area_ha) AS area_ha", "confidence IN (2, 3) AND strftime(DATE '2020-12-31' + alert_day, '%Y-%m-%d') BETWEEN '2022' AND '2024-06-30'"))
def dist_polygon(spark, sf_dir):
    request = rq.DisturbanceAlerts(FEATURES, "2022", "2024-06-30")
    return products.disturbance_alerts(request, _of_features(spark, sf_dir, request))


@query(_features_sql(_labels("land_cover_end", codes.LAND_COVER) + " AS land_cover_class, sum(area_ha) AS area_ha", "true"))
def lc_polygon(spark, sf_dir):
    request = rq.LandCoverComposition(FEATURES)
    return products.land_cover_composition(request, _of_features(spark, sf_dir, request))


# Operators by themselves.


@query(f"SELECT country_name AS aoi_id, alert_day, confidence, strftime(DATE '2020-12-31' + alert_day, '%Y-%m-%d') AS dist_date, strftime(DATE '2014-12-31' + alert_day, '%Y-%m-%d') AS integrated_date, {_labels('confidence', codes.CONFIDENCE_DISTURBANCE)} AS confidence_label, count(*) AS n FROM px GROUP BY ALL")
def decode_date_conf(spark, sf_dir):
    raw = sample.pixels(spark, sf_dir).select(F.col("country_name").alias("aoi_id"), (F.col("confidence") * 10_000 + F.col("alert_day")).alias("date_conf"))
    rows = batch.decode_alerts(raw).groupBy("aoi_id", "alert_day", "confidence").agg(F.count("*").alias("n"))
    return rows.withColumns({"dist_date": ex.date_text(ex.epoch_date("alert_day")), "integrated_date": ex.date_text(ex.epoch_date("alert_day", codes.INTEGRATED_EPOCH)), "confidence_label": ex.label("confidence", codes.CONFIDENCE_DISTURBANCE)})


@query("SELECT country_name AS aoi_id, 'protected_area' AS aoi_type, count(area_ha) AS area_ha FROM px WHERE loss >= 15 AND loss <= 21 AND loss <> 18 AND loss > 14 AND loss < 22 AND intact_code = 0 AND canopy IN (5, 6) GROUP BY ALL")
def filter_ops_all(spark, sf_dir):
    from landgauge.plans.query import Filter, ZonalQuery

    ops = (Filter("loss_year", ">=", "2015"), Filter("loss_year", "<=", "2021"), Filter("loss_year", "!=", 2018), Filter("loss_year", ">", 2014), Filter("loss_year", "<", 2022), Filter("intact", "=", False), Filter("canopy", "in", [30, 50]))
    return ZonalQuery(("area",), "count", (), ops).over_pixels(sample.clipped(spark, sf_dir))


@query("SELECT a.\"row\", a.col, a.value AS base, b.value AS other FROM grid a LEFT JOIN (SELECT * FROM grid WHERE event_type = 'click') b ON a.\"row\" = b.\"row\" AND a.col = b.col")
def align_nearest(spark, sf_dir):
    return _aligned(spark, sf_dir, None)


@query("SELECT a.\"row\", a.col, a.value AS base, coalesce(b.value, 0) AS other FROM grid a LEFT JOIN (SELECT * FROM grid WHERE event_type = 'click') b ON a.\"row\" = b.\"row\" AND a.col = b.col")
def align_fill0(spark, sf_dir):
    return _aligned(spark, sf_dir, {"other": 0.0})


def _aligned(spark, sf_dir, fill):
    g = align.Grid(sample.X0, sample.Y0, sample.RESOLUTION)
    base = align.snap(sample.grid(spark, sf_dir), g).select("row", "col", F.col("value").alias("base"))
    other = align.snap(sample.grid(spark, sf_dir, 1e-6).where("event_type = 'click'"), g).select("row", "col", "value")
    return align.align(base, {"other": other}, fill)


def _off_grid(spark, sf_dir, jitter: float, tolerance: float) -> DataFrame:
    g = align.Grid(sample.X0, sample.Y0, sample.RESOLUTION, tolerance)
    base = align.snap(sample.grid(spark, sf_dir), g).select("row", "col", F.col("value").alias("base"))
    return align.align(base, {"other": align.snap(sample.grid(spark, sf_dir, jitter), g).select("row", "col", "value")})


@query("SELECT \"row\", col, value AS base, value AS other FROM grid")
def align_wide(spark, sf_dir):
    """Coordinates off by less than 1e-4 still meet."""
    return _off_grid(spark, sf_dir, 5e-5, 1e-4)


@query("SELECT \"row\", col, value AS base, CAST(NULL AS DOUBLE) AS other FROM grid")
def align_too_far(spark, sf_dir):
    """Coordinates off by more than 1e-5 meet nothing at that tolerance."""
    return _off_grid(spark, sf_dir, 5e-5, 1e-5)


@query("SELECT a.\"row\", a.col, a.value AS base, b.value AS other FROM grid a LEFT JOIN (SELECT * FROM grid WHERE \"row\" < 5) b ON a.\"row\" = b.\"row\" AND a.col = b.col WHERE a.\"row\" < 9")
def align_overwrite(spark, sf_dir):
    """A layer whose coordinates say otherwise is taken by position, as far as the reference reaches."""
    base = align.snap(sample.grid(spark, sf_dir), align.Grid(sample.X0, sample.Y0, sample.RESOLUTION)).where("row < 9").select("row", "col", F.col("value").alias("base"))
    off = 0.4 * sample.RESOLUTION
    layer = align.overwrite(sample.grid(spark, sf_dir, off), align.Grid(sample.X0 + off, sample.Y0 - off, sample.RESOLUTION), (5, sample.WIDTH))
    return align.align(base, {"other": layer.select("row", "col", "value")})


@query("SELECT a.\"row\", a.col, a.value AS base, b.value AS clicks FROM grid a LEFT JOIN (SELECT * FROM grid WHERE event_type = 'click') b ON a.\"row\" = b.\"row\" AND a.col = b.col")
def align_exact(spark, sf_dir):
    cells = sample.grid(spark, sf_dir).withColumnsRenamed({"grid_row": "row", "grid_col": "col"})
    return align.exact(cells.select("row", "col", F.col("value").alias("base")), cells.where("event_type = 'click'").select("row", "col", F.col("value").alias("clicks")))


@query("SELECT a.\"row\", a.col, a.value AS base, a.value + 1 AS one, CASE WHEN a.value > 5 THEN a.value * 2 END AS two, coalesce(CASE WHEN a.value < 3 THEN a.value END, 0) AS three FROM grid a")
def align_cube(spark, sf_dir):
    """Several layers in one cube."""
    cells = sample.grid(spark, sf_dir).withColumnsRenamed({"grid_row": "row", "grid_col": "col"})
    layer = lambda e, where="true": cells.where(where).select("row", "col", F.expr(e).alias("value"))
    return align.align(cells.select("row", "col", F.col("value").alias("base")), {"one": layer("value + 1"), "two": layer("value * 2", "value > 5"), "three": layer("value", "value < 3")}, {"three": 0.0})


@query("WITH c AS (SELECT \"row\" // 4 AS r, col // 4 AS k, sum(value) AS v FROM grid GROUP BY ALL), l AS (SELECT \"row\" // 10 AS r, col // 10 AS k, sum(value) AS v FROM grid GROUP BY ALL) SELECT g.\"row\", g.col, c.v * 2.5 / 1000 AS \"cropland_Mg\", l.v / 100 / 1000 AS \"livestock_Mg\" FROM grid g JOIN c ON g.\"row\" // 4 = c.r AND g.col // 4 = c.k JOIN l ON g.\"row\" // 10 = l.r AND g.col // 10 = l.k")
def gridded_agriculture(spark, sf_dir):
    fine = sample.grid(spark, sf_dir).select(F.col("grid_row").alias("row"), F.col("grid_col").alias("col"), F.lit(2.5).alias("area"))
    coarse = lambda n: sample.grid(spark, sf_dir).groupBy(*(c.alias(x) for c, x in zip(align.parent_cell("grid_row", "grid_col", n), ("row", "col"), strict=True))).agg(F.sum("value").alias("value"))
    return batch.gridded_agriculture(fine, coarse(4), coarse(10), 4, 10)


@query("SELECT iso AS country, land_cover_start * 9 + land_cover_end AS code, (land_cover_start * 9 + land_cover_end) // 9 AS first, (land_cover_start * 9 + land_cover_end) % 9 AS last, sum(area_ha) AS area_ha FROM px GROUP BY ALL")
def transition_codes(spark, sf_dir):
    px, iso = _tables(spark, sf_dir)
    rows = rollup.zonal(rollup.with_country(px, iso).withColumn("code", ex.transition("land_cover_start", "land_cover_end", 9)), ["country", "code"], {"area_ha": "area_ha"})
    first, last = ex.transition_parts("code", 9)
    return rows.withColumns({"first": first, "last": last})


_DETAILED = "CASE driver WHEN 1 THEN 'tree_loss' WHEN 2 THEN 'tree_gain' WHEN 3 THEN 'tree_tree_a' WHEN 4 THEN 'crop_b' ELSE 'water' END"
_BROAD = "CASE driver WHEN 4 THEN 'crop' WHEN 5 THEN 'short_veg' ELSE 'other' END"


@query("SELECT CASE driver WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4 WHEN 5 THEN 4 ELSE 0 END AS class, sum(area_ha) AS area_ha FROM px GROUP BY ALL")
def vegetation_rule(spark, sf_dir):
    px = sample.pixels(spark, sf_dir).select("area_ha", F.expr(_DETAILED).alias("detailed"), F.expr(_BROAD).alias("broad"))
    return rollup.zonal(px.withColumn("class", ex.vegetation_rule("detailed", "broad")), ["class"], {"area_ha": "area_ha"})


@query("SELECT country_name, max(carbon) AS carbon, max(area_ha) AS area_ha FROM px GROUP BY ALL")
def max_by_group(spark, sf_dir):
    return rollup.zonal(sample.pixels(spark, sf_dir), ["country_name"], {"carbon": "carbon", "area_ha": "area_ha"}, "max")


@query("SELECT country_name, t AS threshold, CASE t WHEN '30' THEN a ELSE b END AS area_ha FROM (SELECT country_name, sum(CASE WHEN canopy >= 5 THEN area_ha END) AS a, sum(CASE WHEN canopy > 7 THEN area_ha END) AS b FROM px GROUP BY ALL), (VALUES ('30'), ('50')) v(t) WHERE CASE t WHEN '30' THEN a ELSE b END IS NOT NULL")
def unpivot_known(spark, sf_dir):
    wide = sample.pixels(spark, sf_dir).groupBy("country_name").agg(F.sum(F.when(F.col("canopy") >= 5, F.col("area_ha"))).alias("30"), F.sum(F.when(F.col("canopy") > 7, F.col("area_ha"))).alias("50"))
    return reshape.unpivot_known(wide, ["country_name"], ["30", "50"], "threshold", "area_ha")


@query(f"SELECT iso AS aoi_id, 'admin' AS aoi_type, loss + 2000 AS tree_cover_loss_year, sum(CASE WHEN canopy >= 6 THEN area_ha ELSE 0 END) AS area_ha, round(sum(carbon), 2) AS \"{_C}\" FROM px WHERE (canopy >= 6 OR mangrove = 1 OR gain > 0) AND loss BETWEEN 16 AND 20 AND iso IN ('ASI', 'EUR') GROUP BY ALL")
def zonal_sql_text(spark, sf_dir):
    """A zonal query rendered to SQL text, run over a table by name."""
    text = products.loss_query(rq.TreeCoverLoss(ADMIN, "2016", "2020", 50)).sql(["ASI", "EUR"])
    return _rounded(tables.sql(spark, text, {"data_source": _loss_table(spark, sf_dir)}), _C)


@query("SELECT country_name, count(DISTINCT region) AS region, count(DISTINCT driver) AS driver FROM px GROUP BY ALL")
def qc_nunique(spark, sf_dir):
    return checks.distinct_by(sample.pixels(spark, sf_dir), "country_name", ["region", "driver"])


@query("SELECT subregion, region, country_name, n AS \"values\" FROM (SELECT DISTINCT subregion, region, country_name FROM px) JOIN (SELECT subregion, count(DISTINCT country_name) AS n FROM px GROUP BY ALL HAVING count(DISTINCT country_name) > 1) USING (subregion)")
def qc_varying(spark, sf_dir):
    units = sample.pixels(spark, sf_dir).select("subregion", "region", "country_name").distinct()
    return checks.varying(units, "subregion", "country_name")


@query("SELECT feature_id, total FROM (SELECT *, row_number() OVER (ORDER BY feature_id) AS k FROM (SELECT n_name AS feature_id, round(sum(s_acctbal), 2) AS total FROM nation JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL)) WHERE k > 3 AND k <= 12")
def qc_feature_slice(spark, sf_dir):
    rows = sample.read(spark, sf_dir, "nation").join(sample.read(spark, sf_dir, "supplier"), F.expr("s_nationkey = n_nationkey"))
    return checks.some_features(rows.groupBy(F.col("n_name").alias("feature_id")).agg(F.round(F.sum("s_acctbal"), 2).alias("total")), 3, 12)


@query("WITH t AS (SELECT iso AS aoi_id, round(sum(carbon) * 2, 2) AS total FROM px WHERE " + _CANOPY + " >= 30 OR mangrove = 1 OR gain > 0 GROUP BY ALL), e AS (SELECT iso AS aoi_id, CASE iso WHEN 'ASI' THEN 1000.0::DOUBLE ELSE 2 * 1.0::DOUBLE END AS expected FROM px GROUP BY ALL) SELECT aoi_id, expected, total, abs(total - expected) / ((total + expected) / 2) AS difference, abs(total - expected) / ((total + expected) / 2) < 0.02 AS passed FROM e JOIN t USING (aoi_id)")
def qc_carbon(spark, sf_dir):
    """Carbon against an external source, one total a feature."""
    own = carbon_thresholds(spark, sf_dir).where("tree_cover_density = 30 AND length(aoi_id) = 3")
    expected = spark.createDataFrame([(c, 1000.0 if c == "ASI" else 2.0) for c in COUNTRIES], "aoi_id string, expected double")
    return validation.carbon(expected, own)


@query("SELECT a.\"row\", a.col, y.year, a.value * y.year AS flux FROM grid a, (VALUES (2020), (2021)) y(year)")
def align_years(spark, sf_dir):
    cells = sample.grid(spark, sf_dir).select(F.col("grid_row").alias("row"), F.col("grid_col").alias("col"), "value")
    years = reshape.spread_years(cells.select("row", "col"), (2020, 2021))
    return align.over_years(cells, years).select("row", "col", "year", (F.col("value") * F.col("year")).alias("flux"))


def _coarse(spark, sf_dir):
    r, c = align.parent_cell("grid_row", "grid_col", 4)
    return sample.grid(spark, sf_dir).groupBy(r.alias("row"), c.alias("col")).agg(F.sum("value").alias("total"))


_COARSE_SQL = "WITH c AS (SELECT \"row\" // 4 AS r, col // 4 AS k, sum(value) AS total FROM grid GROUP BY ALL) SELECT g.\"row\", g.col, c.total{} AS total FROM grid g JOIN c ON g.\"row\" // 4 = c.r AND g.col // 4 = c.k"


@query(_COARSE_SQL.format(""))
def downscale_rate(spark, sf_dir):
    fine = sample.grid(spark, sf_dir).select(F.col("grid_row").alias("row"), F.col("grid_col").alias("col"))
    return align.resample(fine, _coarse(spark, sf_dir), 4, "total")


@query(_COARSE_SQL.format(" / 16"))
def downscale_total(spark, sf_dir):
    fine = sample.grid(spark, sf_dir).select(F.col("grid_row").alias("row"), F.col("grid_col").alias("col"))
    return align.downscale(fine, _coarse(spark, sf_dir), 4, "total")


@query("SELECT event_type, count(*) AS n, sum(value) AS total FROM grid WHERE x BETWEEN 105.0041 AND 105.0162 AND y BETWEEN 47.9841 AND 47.9972 GROUP BY ALL")
def clip_bbox(spark, sf_dir):
    return spatial.window(sample.grid(spark, sf_dir), (105.0041, 47.9841, 105.0162, 47.9972)).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query(f"WITH e(aoi_id, x1, y1, x2, y2) AS (VALUES {_edges_sql()}), hit AS (SELECT aoi_id, \"row\", col, value, count(*) AS n FROM grid, e WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY ALL) SELECT aoi_id, 'feature_collection' AS aoi_type, count(*) AS n, sum(value) AS total FROM hit WHERE n % 2 = 1 GROUP BY ALL")
def clip_polygon(spark, sf_dir):
    area = spatial.areas(spark, sample.SHAPES)
    return spatial.clip(sample.grid(spark, sf_dir), area, 0.001).groupBy("aoi_id", "aoi_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


_SIDES = [f"(x2 - x1) * (({y}) - y1) - (y2 - y1) * (({x}) - x1)" for x in ("tx * 0.001::DOUBLE", "tx * 0.001::DOUBLE + 0.001::DOUBLE") for y in ("ty * 0.001::DOUBLE", "ty * 0.001::DOUBLE + 0.001::DOUBLE")]


@query(f"""WITH e(aoi_id, x1, y1, x2, y2) AS (VALUES {_edges_sql()}),
b AS (SELECT aoi_id, CAST(floor(least(min(x1), min(x2)) / 0.001::DOUBLE) AS BIGINT) AS a, CAST(floor(greatest(max(x1), max(x2)) / 0.001::DOUBLE) AS BIGINT) AS c,
      CAST(floor(least(min(y1), min(y2)) / 0.001::DOUBLE) AS BIGINT) AS l, CAST(floor(greatest(max(y1), max(y2)) / 0.001::DOUBLE) AS BIGINT) AS h FROM e GROUP BY ALL),
rws AS (SELECT aoi_id, a, c, unnest(range(l, h + 1)) AS ty FROM b), t AS (SELECT aoi_id, unnest(range(a, c + 1)) AS tx, ty FROM rws),
j AS (SELECT t.*, greatest(x1, x2) >= tx * 0.001::DOUBLE AND least(x1, x2) <= tx * 0.001::DOUBLE + 0.001::DOUBLE AND greatest(y1, y2) >= ty * 0.001::DOUBLE AND least(y1, y2) <= ty * 0.001::DOUBLE + 0.001::DOUBLE
      AND least({", ".join(_SIDES)}) <= 0 AND greatest({", ".join(_SIDES)}) >= 0 AS touched,
      {_CROSSES.format(x="((tx + 0.5::DOUBLE) * 0.001::DOUBLE)", y="((ty + 0.5::DOUBLE) * 0.001::DOUBLE)")} AS crossed FROM t JOIN e USING (aoi_id)),
k AS (SELECT aoi_id, tx, ty, NOT bool_or(touched) AS whole FROM j GROUP BY ALL HAVING bool_or(touched) OR sum(CASE WHEN crossed THEN 1 ELSE 0 END) % 2 = 1)
SELECT aoi_id, whole, count(DISTINCT (tx, ty)) AS tiles, count(*) AS cells FROM grid JOIN k ON floor(x / 0.001::DOUBLE) = tx AND floor(y / 0.001::DOUBLE) = ty GROUP BY ALL""")
def tile_prune(spark, sf_dir):
    """Tiles of each area that hold cells, whole or cut by an edge, and the cells that read them."""
    tiles = spatial.classify_tiles(spatial.areas(spark, sample.SHAPES), 0.001)
    cells = spatial.with_tile(sample.grid(spark, sf_dir), 0.001).join(tiles.drop("edges"), ["tile_x", "tile_y"])
    return cells.groupBy("aoi_id", "whole").agg(F.count_distinct("tile_x", "tile_y").alias("tiles"), F.count("*").alias("cells"))


_AUTHALIC = "((1 - {e2}) / 2 * (sin(radians({lat})) / (1 - {e2} * sin(radians({lat})) * sin(radians({lat}))) + ln((1 + sqrt({e2}) * sin(radians({lat}))) / (1 - sqrt({e2}) * sin(radians({lat})))) / 2 / sqrt({e2})))"
_ZONE = " - ".join(_AUTHALIC.format(e2=f"{geo.ECCENTRICITY2}::DOUBLE", lat=lat) for lat in ("(s_suppkey % 120 - 59.5::DOUBLE)", "(s_suppkey % 120 - 60::DOUBLE)"))


@query(f"SELECT s_suppkey, round({geo.RADIUS}::DOUBLE * {geo.RADIUS}::DOUBLE * radians(0.5::DOUBLE) * ({_ZONE}) / 10000, 3) AS area_ha FROM supplier")
def geodesic_areas(spark, sf_dir):
    """Half-degree cells between two parallels, whose area has a closed form."""
    corner = "{0} + (s_suppkey % {1} - {2})"
    x, y = corner.format("0D", 300, 150), corner.format("0D", 120, 60)
    ring = ", ".join(f"array({x} + {a}D, {y} + {b}D)" for a, b in ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5), (0, 0)))
    rows = sample.read(spark, sf_dir, "supplier").selectExpr("s_suppkey", f"to_json(named_struct('type', 'Polygon', 'coordinates', array(array({ring})))) AS geometry")
    return rows.select("s_suppkey", F.round(geo.geodesic_area(F.col("geometry")), 3).alias("area_ha"))


@query("SELECT d AS driver, coalesce(sum(area_ha), 0) AS area_ha FROM (VALUES (0), (1), (2), (3), (4), (5)) v(d) LEFT JOIN (SELECT * FROM px WHERE region = 3) p ON p.driver = d GROUP BY ALL")
def expected_groups_dense(spark, sf_dir):
    own = rollup.zonal(sample.pixels(spark, sf_dir).where("region = 3"), ["driver"], {"area_ha": "area_ha"}, expected={"driver": [0, 1, 2, 3, 4, 5]})
    return rollup.dense(own, {"driver": [0, 1, 2, 3, 4, 5]}, {"area_ha": 0.0})


@query("SELECT driver, sum(CASE WHEN driver > 3 THEN area_ha END) AS a, sum(CASE WHEN driver > 5 THEN area_ha END) AS b FROM px WHERE driver > 3 GROUP BY ALL")
def drop_all_null(spark, sf_dir):
    return rollup.zonal(sample.pixels(spark, sf_dir), ["driver"], {"a": F.when(F.col("driver") > 3, F.col("area_ha")).otherwise(float("nan")), "b": F.when(F.col("driver") > 5, F.col("area_ha"))})


def _both_sides(spark, sf_dir):
    px = sample.pixels(spark, sf_dir)
    ours = rollup.zonal(px.where("driver <> 7"), ["country_name", "driver"], {"area_ha": "area_ha"})
    theirs = rollup.zonal(px.where("driver <> 1"), ["country_name", "driver"], {"area_ha": F.col("area_ha") * F.when(F.col("driver") == 2, 1.5).otherwise(1.0)})
    return checks.compare_outer(ours, theirs, ["country_name", "driver"], "area_ha", 0.02, 1000.0)


_QC = "WITH a AS (SELECT country_name, driver, sum(area_ha) AS ours FROM px WHERE driver <> 7 GROUP BY ALL), b AS (SELECT country_name, driver, sum(area_ha * CASE WHEN driver = 2 THEN 1.5 ELSE 1 END) AS theirs FROM px WHERE driver <> 1 GROUP BY ALL), q AS (SELECT country_name, driver, ours, theirs, CASE WHEN theirs IS NULL THEN 'left_only' WHEN ours IS NULL THEN 'right_only' ELSE 'both' END AS presence, abs(ours - theirs) AS abs_diff, CASE WHEN ours = 0 AND theirs = 0 THEN 0 ELSE abs(ours - theirs) / ((abs(ours) + abs(theirs)) / 2) END AS rel_diff FROM a FULL JOIN b USING (country_name, driver)), f AS (SELECT *, presence <> 'both' OR (rel_diff > 0.02 AND abs_diff > 1000) AS flagged FROM q) "


@query(_QC + "SELECT * FROM f")
def qc_outer_flag(spark, sf_dir):
    return _both_sides(spark, sf_dir)


@query(_QC + "SELECT country_name, bool_or(flagged) AS flagged FROM f GROUP BY ALL")
def qc_any_flag(spark, sf_dir):
    return checks.any_flag(_both_sides(spark, sf_dir), "country_name")


@query(_QC + "SELECT country_name, driver, presence, abs_diff FROM f WHERE flagged ORDER BY abs_diff DESC NULLS FIRST, country_name, driver LIMIT 8")
def topk_flagged(spark, sf_dir):
    return checks.worst(_both_sides(spark, sf_dir), 8, ["country_name", "driver"]).select("country_name", "driver", "presence", "abs_diff")


@query("WITH t AS (SELECT country_name AS aoi_id, sum(area_ha) AS total FROM px GROUP BY ALL), e AS (SELECT country_name AS aoi_id, sum(CASE WHEN country_name = 'ASIA' THEN area_ha * 2 ELSE area_ha END) AS expected FROM px GROUP BY ALL) SELECT aoi_id, expected, total, abs(total - expected) / ((total + expected) / 2) AS difference, abs(total - expected) / ((total + expected) / 2) < 0.01 AS passed FROM e JOIN t USING (aoi_id)")
def qc_symdiff(spark, sf_dir):
    px = sample.pixels(spark, sf_dir).withColumn("aoi_id", F.col("country_name"))
    features = px.groupBy("aoi_id").agg(F.sum(F.when(F.col("aoi_id") == "ASIA", F.col("area_ha") * 2).otherwise(F.col("area_ha"))).alias("expected"))
    return checks.within(features, px, "expected", "area_ha", 0.01)


@query("SELECT DISTINCT alert_day FROM px WHERE country_name = 'ASIA' AND alert_day NOT IN (SELECT alert_day FROM px WHERE region = 2)")
def anti_dates(spark, sf_dir):
    px = sample.pixels(spark, sf_dir)
    return checks.missing_dates(px.where("country_name = 'ASIA'"), px.where("region = 2"), "alert_day")


@query("SELECT count(CASE WHEN confidence = 3 THEN 1 END) AS new_count, count(CASE WHEN confidence = 3 AND driver <> 7 THEN 1 END) AS old_count, CAST(abs(count(CASE WHEN confidence = 3 THEN 1 END) - count(CASE WHEN confidence = 3 AND driver <> 7 THEN 1 END)) AS DOUBLE) / count(CASE WHEN confidence = 3 AND driver <> 7 THEN 1 END) * 100 AS percent, CAST(abs(count(CASE WHEN confidence = 3 THEN 1 END) - count(CASE WHEN confidence = 3 AND driver <> 7 THEN 1 END)) AS DOUBLE) / count(CASE WHEN confidence = 3 AND driver <> 7 THEN 1 END) * 100 < 5 AS passed FROM px")
def qc_pixel_counts(spark, sf_dir):
    px = sample.pixels(spark, sf_dir)
    return checks.pixel_counts(px, px.where("driver <> 7"), F.col("confidence") == 3)


@query("SELECT 'natural' AS layer, CAST(natural_lands AS VARCHAR) AS class, sum(area_ha) AS total FROM px GROUP BY ALL UNION ALL SELECT 'driver', CAST(driver AS VARCHAR), sum(area_ha) FROM px GROUP BY ALL")
def qc_class_totals(spark, sf_dir):
    return checks.qc_totals(sample.pixels(spark, sf_dir), "area_ha", {"natural": "natural_lands", "driver": "driver"})


@query("SELECT country_name AS aoi_id, 'admin' AS aoi_type, sum(area_ha) / 10000 AS area_ha FROM px GROUP BY ALL")
def normalise_units(spark, sf_dir):
    old = sample.pixels(spark, sf_dir).groupBy("country_name").agg(F.sum("area_ha").alias("value"))
    return batch.normalised(old, {"country_name": "aoi_id", "value": "area_ha"}, "value", 10_000.0, "admin").select("aoi_id", "aoi_type", "area_ha")
