import datetime

import pytest
from pyspark.sql import functions as F

from landgauge.plans import batch, products
from landgauge.plans import requests as rq
from landgauge.plans.query import Filter, ZonalQuery, answer

CUSTOM = rq.Area("feature_collection", features={"type": "FeatureCollection", "features": [{"id": "a"}]})


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def forest(spark):
    """Ten by ten pixels: left half canopy code 1, right 5; top loss in 2021, bottom in 2005."""
    px = spark.range(100).selectExpr("int(id % 10) AS x", "int(id div 10) AS r")
    return px.selectExpr(
        "'a' AS aoi_id", "'feature_collection' AS aoi_type", "5000.0D AS area_ha", "IF(x < 5, 1, 5) AS canopy_cover", "IF(r < 5, 21, 5) AS tree_cover_loss_year", "IF(r < 5, 1.5D, 0.5D) AS carbon_emissions_MgCO2e",
        "IF(r < 3, 1, 0) AS is_intact_forest", "0 AS is_primary_forest", "IF(r < 3, 5000.0D, 0.0D) AS tree_cover_loss_from_fires_area_ha", "CASE WHEN x < 3 THEN 0 WHEN x < 7 THEN 1 ELSE 2 END AS natural_forests_class", "3 AS tree_cover_loss_driver",
    )


def test_loss_by_year(forest):
    out = products.tree_cover_loss(rq.TreeCoverLoss(CUSTOM, "2010", "2022", 30), {"pixels": forest})
    assert rows(out, "tree_cover_loss_year", "area_ha", "carbon_emissions_MgCO2e") == [(2021, 125000.0, 37.5)]


def test_loss_in_intact_forest_and_by_fire(forest):
    out = products.tree_cover_loss(rq.TreeCoverLoss(CUSTOM, "2010", "2022", None, "intact_forest"), {"pixels": forest})
    assert rows(out, "area_ha", "carbon_emissions_MgCO2e") == [(150000.0, 45.0)]
    out = products.tree_cover_loss(rq.TreeCoverLoss(CUSTOM, "2010", "2022", 30, None, ("fire",)), {"pixels": forest})
    assert rows(out, "tree_cover_loss_from_fires_area_ha", "tree_cover_loss_from_non_fires_area_ha") == [(75000.0, 50000.0)]


def test_loss_in_natural_forest_and_by_driver(forest):
    out = products.tree_cover_loss(rq.TreeCoverLoss(CUSTOM, "2021", "2022", None, "natural_forest"), {"pixels": forest})
    assert rows(out, "natural_forests_class", "area_ha") == [("Natural Forest", 100000.0), ("Non-Natural Forest", 75000.0), ("Unknown", 75000.0)]
    out = products.tree_cover_loss(rq.TreeCoverLoss(CUSTOM, "2001", "2022", 20, None, ("driver",)), {"pixels": forest})
    assert rows(out, "tree_cover_loss_driver", "area_ha", "carbon_emissions_MgCO2e") == [("Shifting cultivation", 250000.0, None)]


def test_admin_loss_comes_from_the_table(spark, forest):
    table = spark.createDataFrame([("BRA.1", "admin", 2020, 30, 10.0, 1.0), ("BRA.1", "admin", 2023, 50, 100.0, 2.0), ("BRA.2", "admin", 2023, 50, 7.0, 2.0), ("BRA.1", "admin", 2023, 20, 9.0, 2.0)], "aoi_id string, aoi_type string, tree_cover_loss_year int, canopy_cover int, area_ha double, carbon_emissions_MgCO2e double")
    out = products.tree_cover_loss(rq.TreeCoverLoss(rq.Area("admin", ("BRA.1",)), "2020", "2023", 30), {"tree_cover_loss": table})
    assert rows(out, "tree_cover_loss_year", "area_ha") == [(2020, 10.0), (2023, 100.0)]


def test_roll_up_is_chosen_only_where_it_can_answer(spark, forest):
    table = spark.createDataFrame([("BRA", "admin", 30, 1.0)], "aoi_id string, aoi_type string, canopy_cover int, area_ha double")
    q = ZonalQuery(("area",), filters=(Filter("canopy", ">=", 30),))
    assert answer(q, "admin", ["BRA"], table, lambda: pytest.fail("pixels")).count() == 1
    q = ZonalQuery(("area",), filters=(Filter("canopy", ">=", 30), Filter("intact", "=", 1)))
    assert answer(q, "admin", ["BRA"], table, lambda: forest).count() == 1


def test_sql_text():
    q = ZonalQuery(("area", "carbon"), "sum", ("loss_year",), (Filter("loss_year", ">=", "2020"), Filter("gain_period", "in", ["2000-2005"])))
    assert q.sql(["BRA", "ID'N"]) == (
        "SELECT aoi_id, aoi_type, tree_cover_loss_year, SUM(area_ha) AS area_ha, SUM(carbon_emissions_MgCO2e) AS carbon_emissions_MgCO2e FROM data_source "
        "WHERE tree_cover_loss_year >= 2020 AND tree_cover_gain_period in ('2000-2005') AND aoi_id IN ('BRA', 'ID''N') GROUP BY aoi_id, aoi_type, tree_cover_loss_year"
    )
    with pytest.raises(ValueError):
        Filter("canopy", "like", 1)
    with pytest.raises(ValueError):
        Filter("canopy", "in", 1)


def test_filters_are_pushed_to_the_scan(spark, tmp_path):
    spark.createDataFrame([("BRA", "admin", 30, 1.0)], "aoi_id string, aoi_type string, canopy_cover int, area_ha double").write.parquet(str(tmp_path / "t"))
    plan = ZonalQuery(("area",), filters=(Filter("canopy", ">=", 30),)).over_table(spark.read.parquet(str(tmp_path / "t")), ["BRA", "IDN"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(canopy_cover,30)" in plan and "In(aoi_id, [BRA,IDN])" in plan


@pytest.mark.parametrize(
    "make",
    [
        lambda: rq.Area("admin", ()),
        lambda: rq.Area("admin", ("BRA.1.2.3",)),
        lambda: rq.Area("admin", ("br",)),
        lambda: rq.Area("protected_area", tuple(map(str, range(51)))),
        lambda: rq.Area("somewhere", ("1",)),
        lambda: rq.Area("feature_collection", features={"type": "FeatureCollection", "features": [{"id": "a"}, {"id": "a"}]}),
        lambda: rq.Area("feature_collection", features={"type": "FeatureCollection", "features": [{"properties": {}}]}),
        lambda: rq.TreeCoverLoss(CUSTOM, "2000", "2020", 30),
        lambda: rq.TreeCoverLoss(CUSTOM, "2021", "2020", 30),
        lambda: rq.TreeCoverLoss(CUSTOM, "2020", "2021"),
        lambda: rq.TreeCoverLoss(CUSTOM, "2020", "2021", None, "natural_forest"),
        lambda: rq.TreeCoverLoss(CUSTOM, "2021", "2021", 30, "natural_forest"),
        lambda: rq.TreeCoverLoss(rq.Area("admin", ("BRA",)), "2021", "2021", None, "natural_forest"),
        lambda: rq.TreeCoverGain(CUSTOM, "2001", "2010"),
        lambda: rq.CarbonFlux(CUSTOM, 20),
        lambda: rq.DisturbanceAlerts(CUSTOM, "2024-01-01", "2023-01-01"),
        lambda: rq.IntegratedAlerts(CUSTOM, "2024", "2024-02-01"),
        lambda: rq.LandInventory(CUSTOM),
        lambda: rq.EmissionFactors(rq.Area("admin", ("BRA",)), ("CO3",), ("Tea",)),
    ],
)
def test_invalid_requests(make):
    with pytest.raises(rq.InvalidRequest):
        make()


def test_thumbprints():
    a, b = (rq.TreeCover(CUSTOM, 30), rq.TreeCover(CUSTOM, 50))
    assert a.thumbprint() == rq.TreeCover(CUSTOM, 30).thumbprint() != b.thumbprint()
    assert a.thumbprint({"v": 1}) != a.thumbprint({"v": 2})


ISO = [(12, "DZA"), (4, "AFG")]


@pytest.fixture(scope="module")
def iso(spark):
    return spark.createDataFrame(ISO, "code int, alpha3 string")


def test_disturbance_table(spark, iso):
    px = spark.createDataFrame([(12, 7, 124, 3, 750, 750.0), (12, 7, 124, 2, 731, 750.0), (12, 7, 124, 2, 731, 750.0), (12, 7, 125, 3, 800, 750.0), (999, 1, 1, 3, 800, 1.0), (12, 7, 125, 1, 800, 1.0), (12, 7, 125, 3, 730, 1.0)], "country int, region int, subregion int, confidence int, alert_day int, area_ha double")
    assert rows(batch.disturbance(px, iso)) == sorted([("DZA", 7, 124, datetime.date(2023, 1, 1), "low", 1500.0), ("DZA", 7, 124, datetime.date(2023, 1, 20), "high", 750.0), ("DZA", 7, 125, datetime.date(2023, 3, 11), "high", 750.0)], key=str)


def test_carbon_flux_table(spark, iso):
    px = spark.createDataFrame([(4, 1, 1, 5, 0, 0, 1.0, -5.0, 10.0), (4, 1, 1, 6, 1, 0, -1.0, -10.0, 20.0), (4, 1, 1, 7, 0, 1, -2.0, -15.0, 30.0), (4, 1, 1, 0, 0, 0, 2.0, -20.0, 40.0)], "country int, region int, subregion int, canopy int, mangrove int, gain int, carbon_net_flux double, carbon_gross_removals double, carbon_gross_emissions double")
    out = batch.carbon_flux(px, iso).where("aoi_id = 'AFG'")
    assert rows(out, "tree_cover_density", "carbon_net_flux_Mg_CO2e", "carbon_gross_removals_Mg_CO2e", "carbon_gross_emissions_Mg_CO2e") == [(30, -2.0, -30.0, 60.0), (50, -3.0, -25.0, 50.0), (75, -3.0, -25.0, 50.0)]


def test_inventory_tables(spark, iso):
    px = spark.createDataFrame([(4, 1, 1, 11100000), (4, 1, 1, 21100000), (4, 1, 1, 13200000), (4, 1, 0, 70000000)], "country int, region int, subregion int, land_state int").withColumns({"gross_emissions_MgCO2e": F.lit(10.0), "gross_removals_MgCO2": F.lit(-4.0), "net_flux_MgCO2e": F.lit(6.0), "area_ha": F.lit(2.0), "year": F.lit(2020)})
    out = batch.vegetation(px, iso)
    assert rows(out.where("aoi_id = 'AFG'"), "land_state_class", "gross_emissions_MgCO2e", "gross_removals_MgCO2", "net_flux_MgCO2e", "area_ha") == [("tree_gain", 20.0, -8.0, 12.0, 2.0), ("tree_loss", 20.0, -8.0, 12.0, 2.0), ("trees_remaining_trees", 20.0, -8.0, 12.0, 2.0)]
    organic = px.withColumns({"burned": F.lit(7.0), "drained": F.lit(float("nan")), "organic": F.when(F.col("subregion") == 1, 1.0).otherwise(0.0), "interval_end_year": F.lit(2020)})
    assert rows(batch.organic_soil(organic, iso).where("aoi_id = 'AFG'"), "gross_emissions_MgCO2e", "area_ha") == [(56.0, 6.0)]
    agri = spark.createDataFrame([(4, 1, 1, 10.0, 5.0), (4, 1, 1, 20.0, 0.0), (4, 1, 0, 30.0, 15.0), (None, 1, 0, 9.0, 9.0)], "country int, region int, subregion int, cropland double, livestock double")
    assert rows(batch.agriculture(agri, iso).where("aoi_id = 'AFG'"), "category", "gross_emissions_MgCO2e") == [("cropland", 60.0), ("livestock", 20.0)]


def test_land_inventory_is_spread_over_years(spark):
    area = rq.Area("admin", ("BRA",))
    one = spark.createDataFrame([("BRA", 1.0)], "aoi_id string, v double")
    organic = spark.createDataFrame([("BRA", 2020, 1.0), ("BRA", 2024, 2.0)], "aoi_id string, interval_end_year int, v double")
    out = products.land_inventory(rq.LandInventory(area), {"inventory_vegetation": one, "inventory_agriculture": one, "inventory_mineral_soil": one, "inventory_organic_soil": organic})
    assert [d.count() for d in out.values()] == [1, 9, 9, 9]


def test_string_dates_compare_as_texts(spark):
    table = spark.createDataFrame([("BRA", 1, 1, datetime.date(2024, 8, 1), "low", 1.0)], "country string, region int, subregion int, dist_alert_date date, dist_alert_confidence string, area_ha double")
    ask = lambda a, b: products.disturbance_alerts(rq.DisturbanceAlerts(rq.Area("admin", ("BRA", "BRA.1", "BRA.1.1")), a, b), {"dist_alerts": table})
    assert rows(ask("2024", "2025"), "aoi_id", "dist_alert_date", "area_ha") == [("BRA", "2024-08-01", 1.0), ("BRA.1", "2024-08-01", 1.0), ("BRA.1.1", "2024-08-01", 1.0)]
    assert ask("2023", "2024").count() == 0
