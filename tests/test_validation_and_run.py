import datetime

import pytest

from landgauge.operators import checks
from landgauge.plans import run, validation
from landgauge.sources import tables


@pytest.fixture(scope="module")
def alerts(spark):
    d = datetime.date(2023, 1, 1)
    return spark.createDataFrame([("BRA", 1, 1, d, "low", 3.0), ("BRA", 1, 2, d, "high", 5.0)], "country string, region int, subregion int, dist_alert_date date, dist_alert_confidence string, area_ha float")


def test_alert_validation(spark, alerts):
    px = spark.createDataFrame([(20731, 1.5), (20731, 1.5), (30731, 5.0), (0, 9.0)], "date_conf int, area_ha double")
    days = alerts.select("dist_alert_date")
    assert validation.alerts(alerts, px, "BRA", "2024-01-01", spot_days=days) == []
    wrong = validation.alerts(alerts, px.limit(1), "BRA", "2022-01-01", spot_days=days.selectExpr("dist_alert_date + 1 AS dist_alert_date"))
    assert any("date after" in w for w in wrong) and any("low confidence" in w for w in wrong) and any("1 dates" in w for w in wrong)
    assert validation.alerts(alerts.drop("region"), px, "BRA", "2024-01-01")[0].startswith("columns")


def test_other_validations(spark):
    features = spark.createDataFrame([("a", 100.0)], "aoi_id string, expected double")
    results = spark.createDataFrame([("a", 100.5)], "aoi_id string, area_ha double")
    assert validation.loss(features, results).first().passed
    with pytest.raises(checks.CheckFailed):
        validation.loss(features, results, 0.001)
    assert not validation.carbon(features, results, "area_ha", 0.001).first().passed
    new, old = spark.range(1, 105).selectExpr("id AS date_conf"), spark.range(1, 101).selectExpr("id AS date_conf")
    row = validation.new_input(new, old).first()
    assert (row.percent, row.passed) == (4.0, True)
    assert validation.inventory(results, features.withColumnRenamed("expected", "area_ha"), ["aoi_id"], "area_ha").first().flagged is False


def test_command_line(spark, tmp_path):
    spark.createDataFrame([(12, 1, 1, 2, 5.0, 0.0, 2020), (12, 1, 1, 2, 7.0, 9.0, 2020)], "country int, region int, subregion int, grasslands int, area_ha double, x double, year int").selectExpr("*", "x AS y").write.parquet(str(tmp_path / "px"))
    (tmp_path / "iso.csv").write_text("code,alpha3\n12,DZA\n")
    args = ["--plan", "grasslands", "--pixels", str(tmp_path / "px"), "--iso", str(tmp_path / "iso.csv"), "--out", str(tmp_path / "out")]
    path = run.run(spark, run.parse(args))
    assert spark.read.parquet(path).first().area_ha == 12.0 and tables.Latest(spark, str(tmp_path / "out" / "grasslands")).version() == "v1"
    run.run(spark, run.parse([*args, "--bbox=-1,-1,1,1"]))
    assert spark.read.parquet(path).first().area_ha == 12.0
    run.run(spark, run.parse([*args, "--bbox=-1,-1,1,1", "--overwrite"]))
    assert spark.read.parquet(path).first().area_ha == 5.0
    for bad in (["--plan", "disturbance", *args[2:]], [*args, "--bbox=1,2"]):
        with pytest.raises(SystemExit):
            run.parse(bad)
