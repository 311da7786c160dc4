import json
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from landgauge.operators import align, spatial
from landgauge.operators.spatial import AreaTooSmall
from landgauge.plans import batch
from landgauge.plans import requests as rq
from landgauge.plans import service as sv
from landgauge.sources import rasters, tables
from landgauge.streaming import updates

AREA = rq.Area("feature_collection", features={"type": "FeatureCollection", "features": [{"id": "a", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]})


@pytest.fixture
def pixels(spark):
    return spark.createDataFrame([("a", "feature_collection", 5, 7.0)], "aoi_id string, aoi_type string, canopy_cover int, area_ha double")


def test_a_job_from_start_to_poll(pixels, tmp_path):
    calls = []
    s = sv.Service(lambda r: calls.append(r) or {"pixels": pixels}, sv.Results(tmp_path))
    key = s.create(rq.TreeCover(AREA, 30), wait=True)
    assert s.create(rq.TreeCover(AREA, 30), wait=True) == key and len(calls) == 1
    status, headers, body = s.poll(key)
    assert (status, headers, body["status"]) == (200, {}, "saved")
    assert body["result"] == {"aoi_id": ["a"], "aoi_type": ["feature_collection"], "area_ha": [7.0]}
    assert s.poll("none")[0] == 404
    assert len(list(tmp_path.glob("*.features.json"))) == 1


def test_failures_are_told(pixels, tmp_path):
    def small(_):
        raise AreaTooSmall("a")

    s = sv.Service(small, sv.Results(tmp_path / "1"))
    assert "too small" in s.poll(s.create(rq.TreeCover(AREA), wait=True))[2]["message"]
    s = sv.Service(lambda _: time.sleep(3), sv.Results(tmp_path / "2"), limit=0.1)
    assert "too long" in s.poll(s.create(rq.TreeCover(AREA), wait=True))[2]["message"]
    # The job that ran past its time is cancelled.
    context = pixels.sparkSession.sparkContext
    endless = pixels.sparkSession.range(10**13).selectExpr("string(id % 2) AS aoi_id", "'feature_collection' AS aoi_type", "5 AS canopy_cover", "double(id) AS area_ha")
    s = sv.Service(lambda _: {"pixels": endless}, sv.Results(tmp_path / "4"), limit=3)
    assert "too long" in s.poll(s.create(rq.TreeCover(AREA), wait=True))[2]["message"]
    until = time.time() + 20
    while context.statusTracker().getActiveJobsIds() and time.time() < until:
        time.sleep(0.2)
    assert not context.statusTracker().getActiveJobsIds()
    results = sv.Results(tmp_path / "3")
    results.note("k", sv.PENDING, {"_secret": 1, "x": 2})
    assert sv.Service(small, results).poll("k")[1:] == ({"Retry-After": "1"}, {"status": "pending", "message": None, "metadata": {"x": 2}, "result": None})


def test_features_of_a_request_reach_the_pixels(spark, tmp_path):
    px = spark.range(16).selectExpr("0.1D + (id % 4) * 0.2D AS x", "0.65D - (id div 4) * 0.2D AS y", "5 AS canopy_cover", "2.0D AS area_ha")
    grid = align.Grid(0.1, 0.65, 0.2)
    s = sv.Service(sv.pixel_sources(px, grid, (0.1, 0.05, 0.7, 0.65), {}), sv.Results(tmp_path))
    assert s.poll(s.create(rq.TreeCover(AREA, 30), wait=True))[2]["result"] == {"aoi_id": ["a"], "aoi_type": ["feature_collection"], "area_ha": [2.0 * sum(0.1 + 0.2 * x > 0.05 + 0.2 * y for x in range(4) for y in range(4))]}
    tiny = rq.Area("feature_collection", features={"type": "FeatureCollection", "features": [{"id": "t", "geometry": {"type": "Polygon", "coordinates": [[[0.15, 0.15], [0.2, 0.15], [0.2, 0.2], [0.15, 0.15]]]}}]})
    assert "too small" in s.poll(s.create(rq.TreeCover(tiny, 30), wait=True))[2]["message"]


def test_layouts_save_shuffles_and_row_groups(spark, tmp_path):
    cells = spark.range(4000).selectExpr("int(id div 100) AS row", "int(id % 100) AS col", "double(id) AS value")
    for name in ("layer_a", "layer_b"):
        tables.bucketed(cells.withColumnRenamed("value", name), name, 4, ["row", "col"])
    joined = spark.table("layer_a").hint("merge").join(spark.table("layer_b"), ["row", "col"])
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 4000
    px = spatial.with_tile(cells.selectExpr("col + 0.5D AS x", "row + 0.5D AS y", "value"), 10.0)
    tables.by_tile(px, str(tmp_path / "tiles"), 4)
    own = spark.read.parquet(str(tmp_path / "tiles"))
    near = spatial.window(own, (0.0, 0.0, 9.9, 9.9))
    assert "PushedFilters: [IsNotNull(x), IsNotNull(y), GreaterThanOrEqual(x" in near._jdf.queryExecution().executedPlan().toString()
    # Tiles of one row of tiles stand in as few files as can hold them.
    files = own.select("tile_y", F.input_file_name().alias("f")).distinct().groupBy("tile_y").count()
    assert max(r["count"] for r in files.collect()) <= 2


def test_a_derived_cube_is_written_once_by_tile(spark, tmp_path):
    fine = spark.range(64).selectExpr("int(id div 8) AS row", "int(id % 8) AS col", "2.0D AS area")
    coarse = lambda n, v: spark.range((8 // n) ** 2).selectExpr(f"int(id div {8 // n}) AS row", f"int(id % {8 // n}) AS col", f"double({v}) AS value")
    calls = []

    def make():
        calls.append(1)
        cells = batch.gridded_agriculture(fine, coarse(4, 500), coarse(2, 400), 4, 2)
        return cells.withColumns({"tile_y": F.floor(F.col("row") / 4), "tile_x": F.floor(F.col("col") / 4)})

    path = str(tmp_path / "cube")
    assert tables.write_cube(make, spark, path, 2) and not tables.write_cube(make, spark, path, 2) and len(calls) == 1
    out = spark.read.parquet(path)
    # 500 kg by area unit over 2 units; 400 kg shared by 4 cells.
    assert {(r.cropland_Mg, r.livestock_Mg) for r in out.collect()} == {(1.0, 0.1)} and out.count() == 64


def test_feature_collections(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5, '{"type":"Point","coordinates":[1,2]}'), ("b", None, None)], "feature_id string, v double, geometry string")
    tables.write_collection(df, str(tmp_path / "c.geojson"))
    found = json.loads((tmp_path / "c.geojson").read_text())
    assert found["type"] == "FeatureCollection" and [f["properties"] for f in found["features"]] == [{"feature_id": "a", "v": 1.5}, {"feature_id": "b", "v": None}]
    assert found["features"][0]["geometry"] == {"type": "Point", "coordinates": [1, 2]} and found["features"][1]["geometry"] is None
    assert tables.features(spark, str(tmp_path / "c.geojson"), "feature_id string").count() == 2
    assert tables.read_text(spark, str(tmp_path / "none")) is None


def test_routing_and_roles():
    handle = sv.chain((lambda r: r.area.type == "admin", lambda r: "table"), (lambda r: True, lambda r: "pixels"))
    assert handle(rq.NaturalLands(rq.Area("admin", ("BRA",)))) == "table" and handle(rq.NaturalLands(AREA)) == "pixels"
    assert sv.pool_for(AREA.features) == "interactive" and sv.pool_for(AREA.features, 1.0) == "large"
    assert sv.overlay({"a": {"u": 1, "v": 2}}, {"staging": {"a": {"u": 3}}}, "staging") == {"a": {"u": 3, "v": 2}}
    now, asked = [0.0], []
    roles = sv.Roles(lambda t: asked.append(t) or ("ADMIN" if t == "good" else None), most=2, clock=lambda: now[0])
    roles.require("good"), roles.require("good")
    for _ in range(2):
        with pytest.raises(PermissionError):
            roles.require("bad")
    assert asked == ["good", "bad"]
    now[0] = 121
    roles.require("good")
    assert asked == ["good", "bad", "good"]


def test_write_once_and_versions(spark, tmp_path):
    path, calls = str(tmp_path / "t"), []
    make = lambda: calls.append(1) or spark.range(3)
    assert tables.write_once(make, spark, path) and not tables.write_once(make, spark, path) and tables.write_once(make, spark, path, overwrite=True)
    assert len(calls) == 2 and spark.read.parquet(path).count() == 3
    with pytest.raises(LookupError):
        tables.Latest(spark, str(tmp_path)).version()
    assert tables.Latest(spark, str(tmp_path), "v0").version() == "v0"
    now = [0.0]
    tables.mark_latest(spark, str(tmp_path), "v20240101")
    latest = tables.Latest(spark, str(tmp_path), clock=lambda: now[0])
    assert latest.version() == "v20240101"
    tables.mark_latest(spark, str(tmp_path), "v20240201")
    assert latest.version() == "v20240101"
    now[0] = 3601
    assert latest.version() == "v20240201"


def test_text_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\nx,1\n")
    (tmp_path / "b.csv").write_text("k,v\ny,2\n")
    out = tables.csvs(spark, {"CO2": str(tmp_path / "a.csv"), "CH4": str(tmp_path / "b.csv")}, "k string, v double", "gas")
    assert sorted(map(tuple, out.collect())) == [("x", 1.0, "CO2"), ("y", 2.0, "CH4")]
    (tmp_path / "f.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "id": "1", "properties": {"gid": "BRA.1"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    out = tables.features(spark, str(tmp_path / "f.geojson"), "gid string")
    row = out.first()
    assert (row.feature_id, row.gid, json.loads(row.geometry)["coordinates"]) == ("1", "BRA.1", [1, 2])
    tables.write_features(out, str(tmp_path / "out"))
    assert json.loads(spark.read.text(str(tmp_path / "out")).first()[0])["properties"] == {"feature_id": "1", "gid": "BRA.1"}
    assert tables.sql(spark, "SELECT count(*) AS n FROM data_source", {"data_source": out}).first().n == 1


def test_raster_tiles(spark, tmp_path):
    np.array([[1, 0], [3, 4]], "<u2").tofile(tmp_path / "t.bin")
    (tmp_path / "tiles.json").write_text(json.dumps({"path": "t.bin", "rows": 2, "cols": 2, "x0": 10.0, "y0": 5.0, "resolution": 0.5, "dtype": "u2", "nodata": 0.0}))
    assert sorted(map(tuple, rasters.tiles(spark, str(tmp_path / "tiles.json")).collect())) == [(10.0, 4.5, 3.0), (10.0, 5.0, 1.0), (10.5, 4.5, 4.0)]
    assert rasters.ingest(spark, str(tmp_path / "tiles.json"), str(tmp_path / "px"), "int")
    assert spark.read.parquet(str(tmp_path / "px")).agg(F.sum("value")).first()[0] == 8


def test_new_versions_run_their_plans_once(spark, tmp_path):
    marks, seen = tmp_path / "marks", []
    marks.mkdir()
    (marks / "1.json").write_text(json.dumps({"dataset": "loss", "version": "v1", "path": "p"}))
    plans = {"loss": lambda s, v, p: seen.append(v)}
    for _ in range(2):
        updates.watch(spark, str(marks), str(tmp_path / "state"), plans).awaitTermination(60)
    (marks / "2.json").write_text(json.dumps({"dataset": "loss", "version": "v2", "path": "p"}) + "\n" + json.dumps({"dataset": "other", "version": "v9", "path": "p"}))
    updates.watch(spark, str(marks), str(tmp_path / "state"), plans).awaitTermination(60)
    assert seen == ["v1", "v2"]
