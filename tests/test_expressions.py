import datetime
import json
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landgauge.functions import codes, geo
from landgauge.functions import expressions as ex


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first().asDict()


def test_alert_decoding(spark):
    rows = spark.createDataFrame([(23456,), (15789,), (30001,), (40000,)], "v int").select(ex.confidence_code("v").alias("c"), ex.day_code("v").alias("d")).collect()
    assert [(r.c, r.d) for r in rows] == [(2, 3456), (1, 5789), (3, 1), (4, 0)]


def test_epochs(spark):
    r = one(spark, a=ex.epoch_date(F.lit(731)), b=ex.epoch_date(F.lit(1095), codes.INTEGRATED_EPOCH), c=ex.epoch_date(F.lit(2923), codes.INTEGRATED_EPOCH), t=ex.date_text(ex.epoch_date(F.lit(1))))
    assert r == {"a": datetime.date(2023, 1, 1), "b": datetime.date(2017, 12, 30), "c": datetime.date(2023, 1, 1), "t": "2021-01-01"}


def test_labels_on_a_miss(spark):
    r = one(spark, a=ex.label(F.lit(99), codes.NATURAL_LANDS), b=ex.label(F.lit(99), codes.NATURAL_LANDS, "Unclassified"), c=ex.label(F.lit(2), codes.NATURAL_LANDS, strict=True), d=ex.label(F.lit(None).cast("int"), codes.NATURAL_LANDS, strict=True))
    assert r == {"a": None, "b": "Unclassified", "c": "Natural forests", "d": None}
    with pytest.raises(Exception, match="no label for code 99"):
        one(spark, a=ex.label(F.lit(99), codes.NATURAL_LANDS, strict=True))


def test_thresholds_both_ways():
    assert [ex.canopy_code(p) for p in (0, 10, 15, 20, 25, 30, 50, 75)] == list(range(8))
    with pytest.raises(ValueError):
        ex.canopy_code(40)


def test_land_states(spark):
    r = one(spark, a=ex.vegetation_code(F.lit(11100000)), b=ex.vegetation_code(F.lit(21100000)), c=ex.vegetation_code(F.lit(13200000)), d=ex.vegetation_code(F.lit(51000000)), e=ex.vegetation_code(F.lit(70000000)), f=ex.vegetation_code(F.lit(None).cast("int")), g=ex.vegetation_code(F.lit(5)))
    assert list(r.values()) == [1, 2, 3, 4, 0, 0, 0]
    assert sum(map(len, codes.LAND_STATES.values())) == len({x for v in codes.LAND_STATES.values() for x in v}) == 95


def test_class_rule(spark):
    rows = spark.createDataFrame([("tree_loss", "x"), ("tree_gain", "x"), ("tree_tree_a", "x"), ("x", "crop"), ("x", "short_veg"), (None, None), ("x", "y")], "d string, b string")
    assert [r[0] for r in rows.select(ex.vegetation_rule("d", "b")).collect()] == [1, 2, 3, 4, 4, 0, 0]


def test_area_ids(spark):
    r = one(spark, a=ex.area_id(F.lit("BRA"), F.lit(1), F.lit(12)), b=ex.area_id(F.lit("BRA"), F.lit(None), F.lit(12)), c=ex.area_level(F.lit("BRA.1")), d=ex.area_part(F.lit("BRA.1"), 1), e=ex.area_part(F.lit("BRA.1"), 2), f=ex.without_suffix(F.lit("BRA.1_2")))
    assert r == {"a": "BRA.1.12", "b": None, "c": 1, "d": "1", "e": None, "f": "BRA.1"}


def test_differences(spark):
    r = one(spark, a=ex.relative_difference(F.lit(0.0), F.lit(0.0)), b=ex.relative_difference(F.lit(1.0), F.lit(3.0)), c=ex.percent_difference(F.lit(105.0), F.lit(100.0)))
    assert r == {"a": 0.0, "b": 1.0, "c": 5.0}


def test_missing_is_null_and_rates_become_absolute(spark):
    r = one(spark, a=ex.missing(F.lit(float("nan"))), b=ex.absolute(F.lit(float("nan")), F.lit(2.0)), c=ex.absolute(F.lit(10.0), F.lit(2.0), 1000.0), d=ex.carbon_if_valid(F.lit(1.0), 25), e=ex.carbon_if_valid(F.lit(1.0), 30))
    assert r == {"a": None, "b": 0.0, "c": 0.02, "d": None, "e": 1.0}


def test_periods():
    assert ex.periods(2000, 2015) == ["2000-2005", "2005-2010", "2010-2015"]


def test_geodesic_area_of_one_degree_at_the_equator():
    cell = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]}
    assert geo.geodesic_area_ha(cell) == pytest.approx(1_230_877, rel=1e-3)
    hole = {"type": "Polygon", "coordinates": [*cell["coordinates"], [[0.25, 0.25], [0.25, 0.75], [0.75, 0.75], [0.75, 0.25], [0.25, 0.25]]]}
    assert geo.geodesic_area_ha(hole) == pytest.approx(0.75 * geo.geodesic_area_ha(cell), rel=1e-3)


@settings(max_examples=50, deadline=None)
@given(st.floats(-170, 160), st.floats(-80, 70), st.floats(0.1, 5), st.floats(0.1, 5))
def test_geodesic_area_adds_up(x, y, w, h):
    box = lambda a, b, c, d: {"type": "Polygon", "coordinates": [[[a, b], [c, b], [c, d], [a, d], [a, b]]]}
    whole = geo.geodesic_area_ha(box(x, y, x + w, y + h))
    parts = geo.geodesic_area_ha(box(x, y, x + w / 2, y + h)) + geo.geodesic_area_ha(box(x + w / 2, y, x + w, y + h))
    assert whole == pytest.approx(parts, rel=1e-4)


def test_transitions_and_well_known_binary(spark):
    df = spark.createDataFrame([(3, 8), (0, 0), (8, 1)], "a int, b int").withColumn("code", ex.transition("a", "b", 9))
    first, last = ex.transition_parts("code", 9)
    assert all((r.a, r.b) == (r.f, r.l) for r in df.select("a", "b", first.alias("f"), last.alias("l")).collect())
    ring = [[0.0, 0.0], [2.0, 0.0], [2.0, 1.0], [0.0, 0.0]]
    flat = lambda order, dims: bytes([order == "<"]) + struct.pack(order + "III", 3 + (1000 if dims == 3 else 0), 1, 4) + b"".join(struct.pack(f"{order}{dims}d", *p, *[9.0] * (dims - 2)) for p in ring)
    want = {"type": "Polygon", "coordinates": [ring]}
    assert geo.parse(flat("<", 2).hex()) == geo.parse(flat(">", 3).hex()) == geo.parse(json.dumps(want)) == want
    many = bytes([1]) + struct.pack("<II", 6, 2) + flat("<", 2) + flat(">", 2)
    assert geo.parse(many.hex()) == {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}
    with pytest.raises(ValueError, match="no area"):
        geo.parse((bytes([1]) + struct.pack("<I2d", 1, 0, 0)).hex())
