"""The test tables seen as land layers: pixels, a grid, and areas.

Each line item is a pixel; supplier, nation and region are its administrative
units, the other columns stand for layers.  ``PIXELS_SQL`` is the same view
for SQL engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a pixel as SQL that Spark and others read alike.
COLUMNS = {
    "country_name": "r_name",
    "iso": "substr(r_name, 1, 3)",
    "lon": "CAST(105.0 AS DOUBLE) + (l_orderkey % 100) * CAST(0.00025 AS DOUBLE)",
    "lat": "CAST(48.0 AS DOUBLE) - (l_partkey % 100) * CAST(0.00025 AS DOUBLE)",
    "country": "CAST(r_regionkey + 1 AS INT)",
    "region": "CAST(n_nationkey AS INT)",
    "subregion": "CAST(s_suppkey % 7 AS INT)",
    "area_ha": "l_quantity",
    "area_m2": "l_quantity * 10000",
    "carbon": "l_extendedprice",
    "confidence": "CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 4 END",
    "ship_year": "CAST(year(l_shipdate) AS INT)",
    "loss": "CAST(year(l_shipdate) - 1980 AS INT)",
    "driver": "CAST(l_linenumber AS INT)",
    "primary_code": "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END",
    "intact_code": "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 0 END",
    "mangrove": "CASE WHEN l_partkey % 11 = 0 THEN 1 ELSE 0 END",
    "gain": "CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END",
    "fire": "CASE WHEN l_discount > 0.05 THEN 21 ELSE 0 END",
    "canopy": "CAST(p_size % 8 AS INT)",
    "period": "CAST(p_size % 5 AS INT)",
    "natural_lands": "CAST(p_size % 23 AS INT)",
    "land_cover_start": "CAST(l_linenumber % 9 AS INT)",
    "land_cover_end": "CAST(p_size % 9 AS INT)",
    "grassland_code": "CAST(l_linenumber % 4 AS INT)",
    "land_state": "CASE p_size % 5 WHEN 0 THEN 11100000 WHEN 1 THEN 21100000 WHEN 2 THEN 13200000 WHEN 3 THEN 51000000 ELSE 70000000 END",
    "block": "CASE WHEN l_linenumber < 4 THEN 2020 ELSE 2024 END",
}
_JOINED = "lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey"
PIXELS_SQL = "px AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in COLUMNS.items()) + ", CAST(date_diff('day', DATE '1994-12-31', CAST(l_shipdate AS DATE)) AS INT) AS alert_day FROM " + _JOINED + ")"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a line item; the dimension tables are small enough for Spark to broadcast by their size."""
    t = {n: read(spark, sf_dir, n) for n in ("lineitem", "supplier", "nation", "region", "part")}
    rows = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    return rows.selectExpr(*(f"{e} AS {n}" for n, e in COLUMNS.items()), "CAST(datediff(l_shipdate, DATE '1994-12-31') AS INT) AS alert_day")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "region").selectExpr("CAST(r_regionkey + 1 AS INT) AS code", "substr(r_name, 1, 3) AS alpha3")


def clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels with an area each, as a clip gives them, and layers under their result names."""
    return pixels(spark, sf_dir).selectExpr(
        "country_name AS aoi_id", "'protected_area' AS aoi_type", "lon AS x", "lat AS y", "area_ha", "area_m2", "loss AS tree_cover_loss_year", "canopy AS canopy_cover", "primary_code AS is_primary_forest", "intact_code AS is_intact_forest",
        "driver AS tree_cover_loss_driver", "carbon AS carbon_emissions_MgCO2e", "CASE WHEN fire > 0 THEN area_ha ELSE 0D END AS tree_cover_loss_from_fires_area_ha",
        "CASE WHEN natural_lands IN (2, 5, 8, 9) THEN 1 WHEN natural_lands IN (14, 17, 18) THEN 2 ELSE 0 END AS natural_forests_class", "period AS tree_cover_gain_period", "mangrove AS mangrove_stock_2000", "gain AS tree_cover_gain_from_height",
        "carbon AS carbon_net_flux", "-area_ha AS carbon_gross_removals", "carbon AS carbon_gross_emissions", "alert_day AS dist_alert_date", "confidence AS dist_alert_confidence", "alert_day AS alert_date", "confidence AS alert_confidence",
        "driver", "natural_lands AS natural_land_class", "natural_lands AS natural_lands_class", "grassland_code AS grasslands", "land_cover_end AS land_cover", "land_cover_start AS land_cover_class_start", "land_cover_end AS land_cover_class_end", "land_cover_end AS land_cover_class", "ship_year AS year",
    )


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels with coordinates and layers under their result names, not yet clipped to areas."""
    return clipped(spark, sf_dir).drop("aoi_id", "aoi_type")


#: Events on a grid 100 cells wide, at 0.00025 degrees, from (105, 48) down.
X0, Y0, RESOLUTION, WIDTH = 105.0, 48.0, 0.00025, 100


def grid(spark: SparkSession, sf_dir: str, jitter: float = 0.0) -> DataFrame:
    """x, y, row, col and value of each cell; coordinates may be a little off."""
    return read(spark, sf_dir, "events").selectExpr(
        f"{X0}D + (event_id % {WIDTH}) * {RESOLUTION}D + {jitter}D AS x", f"{Y0}D - (event_id div {WIDTH}) * {RESOLUTION}D - {jitter}D AS y",
        f"CAST(event_id div {WIDTH} AS INT) AS grid_row", f"CAST(event_id % {WIDTH} AS INT) AS grid_col", "CAST(event_id % 10 AS DOUBLE) AS value", "event_type",
    )


GRID_SQL = f"""grid AS (SELECT CAST(event_id // {WIDTH} AS INT) AS "row", CAST(event_id % {WIDTH} AS INT) AS col, {X0}::DOUBLE + (event_id % {WIDTH}) * {RESOLUTION}::DOUBLE AS x,
  {Y0}::DOUBLE - (event_id // {WIDTH}) * {RESOLUTION}::DOUBLE AS y, CAST(event_id % 10 AS DOUBLE) AS value, event_type FROM events)"""

#: A diamond with a hole, in degrees, and a small square.
SHAPES = {
    "diamond": {"type": "Polygon", "coordinates": [[[105.0101, 47.9999], [105.0203, 47.9871], [105.0101, 47.9753], [105.0003, 47.9871], [105.0101, 47.9999]], [[105.0081, 47.9893], [105.0121, 47.9893], [105.0121, 47.9853], [105.0081, 47.9853], [105.0081, 47.9893]]]},
    "square": {"type": "Polygon", "coordinates": [[[105.0151, 47.9991], [105.0233, 47.9991], [105.0233, 47.9951], [105.0151, 47.9951], [105.0151, 47.9991]]]},
}
#: The shapes as features of a request, and the box of the data.
FEATURES = {"type": "FeatureCollection", "features": [{"type": "Feature", "id": n, "properties": {}, "geometry": s} for n, s in SHAPES.items()]}
EXTENT = (X0, Y0 - 99 * RESOLUTION, X0 + 99 * RESOLUTION, Y0)
