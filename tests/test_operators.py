import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landgauge.operators import align, checks, reshape, rollup, spatial, thresholds


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=str)


def test_align_with_jitter_and_fill(spark):
    g = align.Grid(105.0, 48.0, 0.00025)
    base = align.snap(spark.createDataFrame([(105.0, 48.0, 1.0), (105.00025, 48.0, 2.0), (105.0001, 48.0, 9.0)], "x double, y double, a double"), g)
    other = align.snap(spark.createDataFrame([(105.000251, 47.999999, 5.0)], "x double, y double, value double"), g)
    assert rows(align.align(base, {"b": other}), "row", "col", "a", "b") == [(0, 0, 1.0, None), (0, 1, 2.0, 5.0)]
    assert rows(align.align(base, {"b": other}, {"b": 0.0}), "col", "b") == [(0, 0.0), (1, 5.0)]


def test_downscale_keeps_the_mass(spark):
    fine = spark.range(16).selectExpr("int(id div 4) AS row", "int(id % 4) AS col")
    coarse = spark.createDataFrame([(r, c, 400.0) for r in (0, 1) for c in (0, 1)], "row int, col int, value double")
    out = align.downscale(fine, coarse, 2)
    assert {r.value for r in out.collect()} == {100.0} and out.agg(F.sum("value")).first()[0] == 1600.0
    assert {r.value for r in align.resample(fine, coarse, 2).collect()} == {400.0}


def test_rollup_levels_and_zero_codes(spark):
    df = spark.createDataFrame([("BRA", 7, 124, "a", 2.5), ("BRA", 7, 124, "a", 2.5), ("BRA", 7, 125, "a", 2.5), ("BRA", 0, 0, "a", 2.5), ("BRA", 0, 3, "a", 1.0)], "country string, region int, subregion int, k string, area_ha double")
    assert rows(rollup.admin_rollup(df, ["k"], ["area_ha"])) == [("BRA", "admin", "a", 11.0), ("BRA.7", "admin", "a", 7.5), ("BRA.7.124", "admin", "a", 5.0), ("BRA.7.125", "admin", "a", 2.5)]
    assert rollup.admin_rollup(df.limit(0), ["k"], ["area_ha"]).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(1, 3), st.integers(1, 3), st.integers(0, 100)), min_size=1, max_size=30))
def test_rollup_conserves(spark, data):
    df = spark.createDataFrame([(c, r, s, float(v)) for c, r, s, v in data], "country string, region int, subregion int, v double")
    out = rollup.admin_rollup(df, [], ["v"]).withColumn("level", F.size(F.split("aoi_id", r"\.")))
    assert {r[1] for r in out.groupBy("level").agg(F.sum("v")).collect()} == {float(sum(d[3] for d in data))}


def test_zonal_drops_what_is_not_expected_or_missing(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 9, 5.0), ("a", None, 7.0), ("b", 1, float("nan")), ("b", 2, None)], "z string, k int, v double")
    assert rows(rollup.zonal(df, ["z", "k"], {"v": "v"}, expected={"k": [1, 2]})) == [("a", 1, 1.0)]
    assert rows(rollup.zonal(df, ["z"], {"v": "v"}, "count")) == [("a", 3), ("b", 0)]
    assert rows(rollup.dense(rollup.zonal(df, ["k"], {"v": "v"}), {"k": [1, 2, 9]}, {"v": 0.0})) == [(1, 1.0), (2, 0.0), (9, 5.0)]


def test_countries_without_a_name_go(spark):
    df = spark.createDataFrame([(12, 1), (999, 2)], "country int, v int")
    iso = spark.createDataFrame([(12, "DZA")], "code int, alpha3 string")
    assert rows(rollup.with_country(df, iso)) == [("DZA", 1)]


def test_reshape(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", 3.0)], "k string, layer string, v double")
    assert rows(reshape.pivot_dense(df, ["k"], "layer", "v", ["x", "y", "z"])) == [("a", 1.0, 2.0, 0.0), ("b", 3.0, 0.0, 0.0)]
    wide = spark.createDataFrame([("g", 1.0, None, 3.0)], "k string, `2020_e` double, `2021_e` double, `2020_p` double")
    assert rows(reshape.melt_years(wide, ["k"]), "k", "year", "e", "p") == [("g", 2020, 1.0, 3.0)]
    with pytest.raises(ValueError, match="no year"):
        reshape.melt_years(wide.withColumnRenamed("2020_p", "p"), ["k"])
    assert reshape.spread_years(wide).count() == 9
    blocks = spark.createDataFrame([(2020, 1.0), (2024, 2.0), (1999, 3.0)], "interval_end_year int, v double")
    assert rows(reshape.spread_blocks(blocks, "interval_end_year"), "year") == sorted([(y,) for y in range(2016, 2025)] + [(None,)], key=str)
    assert rows(reshape.unpivot_known(wide, ["k"], ["2020_e", "2021_e"], "n", "v")) == [("g", "2020_e", 1.0)]


def test_unaccumulate_undoes_accumulate(spark):
    df = spark.createDataFrame([("a", 30, 0, 0, 1.0), ("a", 50, 0, 0, 2.0), ("a", 75, 0, 0, 4.0), ("a", 10, 1, 0, 8.0), ("a", 0, 0, 0, 16.0), ("b", 30, 0, 0, 3.0)], "k string, canopy_cover int, mangrove_stock_2000 int, tree_cover_gain_from_height int, v double")
    acc = thresholds.accumulate(df, ["k"], ["v"])
    assert rows(acc, "k", "canopy_cover", "v") == [("a", 30, 15.0), ("a", 50, 14.0), ("a", 75, 12.0), ("b", 30, 3.0)]
    un = thresholds.unaccumulate(acc, ["k"], "v")
    assert rows(un, "k", "canopy_cover", "v") == [("a", 30, 1.0), ("a", 50, 2.0), ("a", 75, 12.0), ("b", 30, 3.0)]
    for t in (30, 50, 75):
        assert un.where(f"k = 'a' AND canopy_cover >= {t}").agg(F.sum("v")).first()[0] == acc.where(f"k = 'a' AND canopy_cover = {t}").first().v


DIAMOND = {"type": "Polygon", "coordinates": [[[6, 3], [9, 6], [6, 9], [3, 6], [6, 3]]]}


def test_clip_agrees_with_a_direct_test_at_any_tile_size(spark):
    px = spark.range(144).selectExpr("id % 12 + 0.5D AS x", "id div 12 + 0.5D AS y", "1.0D AS v")
    area = spatial.areas(spark, {"d": DIAMOND, "far": {"type": "Polygon", "coordinates": [[[50, 50], [51, 50], [51, 51], [50, 50]]]}})
    want = {(x + 0.5, y + 0.5) for x in range(12) for y in range(12) if abs(x + 0.5 - 6) + abs(y + 0.5 - 6) < 3}
    for size in (0.7, 2.0, 100.0):
        got = spatial.clip(px, area, size)
        on_edge = {(r.x, r.y) for r in got.collect()} ^ want
        assert all(abs(abs(x - 6) + abs(y - 6) - 3) < 1e-9 for x, y in on_edge)


TINY = {"type": "Polygon", "coordinates": [[[1.1, 1.1], [1.2, 1.1], [1.2, 1.2], [1.1, 1.1]]]}


def test_areas_without_a_pixel_centre(spark):
    grid, extent = align.Grid(0.5, 11.5, 1.0), (0.5, 0.5, 11.5, 11.5)
    far = {"type": "Polygon", "coordinates": [[[50, 50], [50.1, 50], [50.1, 50.1], [50, 50]]]}
    spatial.require_pixels({"d": DIAMOND, "far": far}, grid, extent)
    with pytest.raises(spatial.AreaTooSmall, match="in t$"):
        spatial.require_pixels({"d": DIAMOND, "t": TINY}, grid, extent)
    sliver = {"type": "Polygon", "coordinates": [[[0.6, 0.1], [0.9, 0.1], [0.9, 11.9], [0.6, 11.9], [0.6, 0.1]]]}
    ring = {"type": "Polygon", "coordinates": [[[1, 1], [3, 1], [3, 3], [1, 3], [1, 1]], [[1.2, 1.2], [2.8, 1.2], [2.8, 2.8], [1.2, 2.8], [1.2, 1.2]]]}
    assert spatial.too_small({"s": sliver, "r": ring, "d": DIAMOND}, grid, extent) == ["r", "s"]


def test_features_keep_their_own_geometries(spark):
    px = spark.range(144).selectExpr("id % 12 + 0.5D AS x", "11.5D - id div 12 AS y", "1.0D AS v")
    square = lambda a: {"type": "Polygon", "coordinates": [[[a, a], [a + 2, a], [a + 2, a + 2], [a, a + 2], [a, a]]]}
    features = {"type": "FeatureCollection", "features": [{"id": "z", "geometry": square(0)}, {"properties": {"id": 7}, "geometry": square(6)}]}
    out = spatial.of_features(px, features, align.Grid(0.5, 11.5, 1.0), (0.5, 0.5, 11.5, 11.5), 2.0)
    assert {(r.aoi_id, r.x, r.y) for r in out.collect()} == {("z", a, b) for a in (0.5, 1.5) for b in (0.5, 1.5)} | {("7", a, b) for a in (6.5, 7.5) for b in (6.5, 7.5)}


def test_tiles_carry_the_edges_near_them_only(spark):
    import math

    n = 400
    ring = [[50 + 40 * math.cos(2 * math.pi * i / n), 50 + 40 * math.sin(2 * math.pi * i / n)] for i in range(n)]
    area = spatial.areas(spark, {"c": {"type": "Polygon", "coordinates": [[*ring, ring[0]]]}})
    most = spatial.classify_tiles(area, 2.0).agg(F.max(F.size("edges"))).first()[0]
    assert most < n / 8
    px = spark.range(10_000).selectExpr("id % 100 + 0.5D AS x", "id div 100 + 0.5D AS y")
    from landgauge.functions import geo

    direct = px.join(area.select("edges")).where(geo.inside(F.col("x"), F.col("y"), F.col("edges"))).count()
    assert spatial.clip(px, area, 2.0).count() == direct


def test_layers_by_position(spark):
    layer = spark.createDataFrame([(7.0, 3.0, 1.0), (8.0, 3.0, 2.0), (7.0, 2.0, 3.0)], "x double, y double, value double")
    out = align.overwrite(layer, align.Grid(7.0, 3.0, 1.0), (1, 5))
    assert rows(out, "row", "col", "value") == [(0, 0, 1.0), (0, 1, 2.0)]


def test_clip_never_joins_by_nested_loop(spark):
    px = spark.range(144).selectExpr("id % 12 + 0.5D AS x", "id div 12 + 0.5D AS y")
    plan = spatial.clip(px, spatial.areas(spark, {"d": DIAMOND}), 2.0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_checks(spark):
    ours = spark.createDataFrame([("a", 100.0), ("b", 5000.0), ("c", 1.0)], "k string, v double")
    theirs = spark.createDataFrame([("a", 100.0), ("b", 9000.0), ("d", 1.0)], "k string, v double")
    out = checks.compare_outer(ours, theirs, ["k"], "v", 0.02, 1000.0)
    assert rows(out, "k", "presence", "flagged") == [("a", "both", False), ("b", "both", True), ("c", "left_only", True), ("d", "right_only", True)]
    assert [r.k for r in checks.worst(out, 2, ["k"]).collect()] == ["c", "d"]
    features = spark.createDataFrame([("a", 300.0), ("z", 0.0)], "aoi_id string, expected double")
    good = spark.createDataFrame([("a", 100.0), ("a", 200.0)], "aoi_id string, v double")
    assert checks.all_passed(checks.within(features, good, "expected", "v", 0.01))
    bad = checks.within(features, good.limit(1), "expected", "v", 0.01)
    with pytest.raises(checks.CheckFailed):
        checks.require(bad, "totals differ")
    assert checks.all_passed(bad.limit(0))


def test_table_rules(spark):
    day = datetime.date(2023, 1, 1)
    df = spark.createDataFrame([("BRA", day, "low", 1.0), ("BRA", day, "low", -1.0), ("BRA", None, "odd", 1.0)], "country string, d date, c string, a double")
    rule = checks.TableRule({"country": "string", "d": "date", "c": "string", "a": "double"}, ["country", "d"], {"c": ["low", "high"]}, {"negative area": F.col("a") >= 0})
    wrong = rule.check(df)
    assert any("nulls in d" in w for w in wrong) and any("unknown values in c" in w for w in wrong) and any("negative area" in w for w in wrong) and any("not unique" in w for w in wrong)
    assert rule.check(df.limit(1)) == []
    assert rule.check(df.drop("a")) == [f"columns are {['country', 'd', 'c']}"]
