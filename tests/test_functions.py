from __future__ import annotations

import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronogeo.functions import ewkb as W
from chronogeo.functions import geometry as G
from chronogeo.functions import text as X
from chronogeo.functions.years import parse_years_range, parse_years_strict
from tests.conftest import rows

LABELS = [
    # label, strict, range
    ("Today", (2000, 40000), (2000, 40000)),
    ("today", (2000, 40000), (2000, 40000)),
    ("1818: a", (1818, 1818), (1818, 1818)),
    ("1943-45: b", (1943, 1945), (1943, 1945)),
    ("1867-1913", (1867, 1867), (1867, 1913)),
    ("1943-5: c", (1943, 5), (1943, 1943)),
    ("1694:dis.22", (1694, 1694), (1694, 1694)),
    ("1550", (1550, 1550), (1550, 1550)),
    ("no year", (2000, 40000), (2000, 40000)),
    ("1838-41: Censo Stabile, Mappe Austriache - rettifica", (1838, 1841), (1838, 1841)),
    ("x-1: 1900", (1900, 1900), (1900, 1900)),
    ("1838-: x", (1838, 1838), (1838, 1838)),
    ("1800-1812: x", (1800, 1812), (1800, 1812)),
]


def test_years_from_labels(spark):
    df = spark.createDataFrame([(label,) for label, _, _ in LABELS], "label string")
    out = df.select("label", parse_years_strict(F.col("label")).alias("s"), parse_years_range(F.col("label")).alias("r")).collect()
    got = {r["label"]: (tuple(r["s"]), tuple(r["r"])) for r in out}
    assert got == {label: (s, r) for label, s, r in LABELS}


def test_text_functions(spark):
    df = spark.createDataFrame([
        ("Bunker 3",), ("Casa dell'ortolano 5",), ("123",), ("",), (None,), ("  a   b\t c ",), ("X_BLDG_13.2.1",)], "t string")
    out = rows(df.select("t", X.sanitize_label(F.col("t")), X.slug(F.col("t")), X.base_identifier(F.col("t"))))
    got = {r[0]: r[1:] for r in out}
    assert got["Bunker 3"][0] == "Bunker"
    assert got["Casa dell'ortolano 5"][0] == "Casa dell'ortolano"
    assert got["123"][0] == got[""][0] == got[None][0] == "Unknown"
    assert got["  a   b\t c "][0] == "a b c"
    assert got["X_BLDG_13.2.1"][2] == "X_BLDG_13"
    assert got["Bunker 3"][1] == "bunker_3"


def test_stable_uuid_is_stable_and_distinct(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("b", "a"), ("ab", "")], "x string, y string")
    once = [r[0] for r in df.select(X.stable_uuid(F.col("x"), F.col("y"))).collect()]
    again = [r[0] for r in df.select(X.stable_uuid(F.col("x"), F.col("y"))).collect()]
    assert once == again and len(set(once)) == 4
    assert all(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", u) for u in once)


def test_str_after_and_language(spark):
    df = spark.createDataFrame([("0§A", "it"), ("none", "it-CH"), ("a§b§c", "ita")], "t string, lang string")
    assert rows(df.select(X.str_after(F.col("t"), "§"), X.lang_matches(F.col("lang"), "it"))) == [("", True), ("A", True), ("b§c", False)]


# ---------------------------------------------------------------- geometry

SQUARES = "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((2 2,3 2,3 3,2 3,2 2)))"
HOLE = "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,1 2,2 2,2 1,1 1))"


def _geoms(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, w string").withColumn("g", G.parse_wkt(F.col("w")))


def test_area_and_centroid(spark):
    clockwise = "POLYGON((0 0,0 4,4 4,4 0,0 0))"
    df = _geoms(spark, SQUARES, HOLE, clockwise, "SRID=3857;POLYGON ((10 10, 12 10, 12 12, 10 12))", "MULTIPOLYGON EMPTY")
    out = [r["m"] for r in df.select("i", G.measures(F.col("g")).alias("m")).orderBy("i").collect()]
    assert [m["area"] for m in out] == [2.0, 15.0, 16.0, 4.0, 0.0]
    assert (out[0]["cx"], out[0]["cy"]) == (1.5, 1.5)
    assert out[1]["cx"] == pytest.approx((2 * 16 - 1.5) / 15)
    assert out[4]["cx"] is None


def _shoelace(ring):
    n = len(ring)
    return abs(sum(ring[i][0] * ring[(i + 1) % n][1] - ring[(i + 1) % n][0] * ring[i][1] for i in range(n))) / 2


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**6))
def test_area_does_not_depend_on_the_first_vertex(spark, seed):
    rnd = random.Random(seed)
    texts, areas = [], []
    for _ in range(5):
        n = rnd.randint(3, 9)
        angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(round(1e6 + 50 * math.cos(a), 3), round(5e6 + 50 * math.sin(a), 3)) for a in angles]
        k = rnd.randrange(n)
        for r in (ring, ring[k:] + ring[:k], ring[::-1]):
            texts.append("POLYGON((" + ",".join(f"{x} {y}" for x, y in r + r[:1]) + "))")
            areas.append(_shoelace([(x - 1e6, y - 5e6) for x, y in ring]))
    got = [r["a"] for r in _geoms(spark, *texts).select("i", G.area(F.col("g")).alias("a")).orderBy("i").collect()]
    assert got == pytest.approx(areas, abs=1e-4)


def test_wkt_round_trip(spark):
    texts = ["MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((2 2,3 2,3 3,2 3,2 2)))",
             "MULTIPOLYGON(((1369976.37 5685579.3808039,-0.5 0.000001,7 8,1369976.37 5685579.3808039),(1 1,2 2,1 2,1 1)))", "MULTIPOLYGON EMPTY"]
    got = [r["w"] for r in _geoms(spark, *texts).select("i", G.to_wkt(F.col("g")).alias("w")).orderBy("i").collect()]
    assert got == texts


def test_ewkb_round_trip(spark):
    # a unit square in little-endian EWKB with SRID 3857, put together by hand
    import struct
    ring = struct.pack("<I", 5) + b"".join(struct.pack("<dd", *p) for p in [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])
    blob = struct.pack("<BII", 1, 0x20000006, 3857) + struct.pack("<I", 1) + struct.pack("<BII", 1, 3, 1) + ring
    df = spark.createDataFrame([(blob.hex().upper(),), (None,)], "h string")
    out = df.select("h", G.to_wkt(W.decode_ewkb(F.col("h"))).alias("w"), W.ewkb_srid(F.col("h")).alias("s"),
                    W.encode_ewkb(W.decode_ewkb(F.col("h")), F.lit(3857)).alias("back"))
    assert rows(out) == [(None, None, None, None), (blob.hex().upper(), "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)))", 3857, blob.hex().upper())]


def test_ring_repair(spark):
    df = _geoms(spark, "POLYGON((0 0,1 0,1 0,1 1,0 1))", "POLYGON((0 0,1 0,1 1,0 1,0 0),(0 0,1 0,0 0))", "POLYGON((0 0,1 0,0 0))")
    out = df.select("i", G.to_wkt(G.repair_rings(F.col("g"))).alias("w"), G.ring_report(F.col("g")).alias("r")).orderBy("i").collect()
    assert [r["w"] for r in out] == ["MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)))"] * 2 + ["MULTIPOLYGON EMPTY"]
    assert [tuple(r["r"]) for r in out] == [(1, 1, 1, 0), (2, 0, 0, 1), (1, 0, 0, 1)]


def test_envelope_and_status(spark):
    box = (0.0, 0.0, 4.0, 4.0)
    df = _geoms(spark, "POLYGON((0 0,4 0,4 4,0 4,0 0))", "POLYGON((3 3,5 3,5 5,3 3))")
    assert [r[0] for r in df.orderBy("i").select(G.within_envelope(F.col("g"), box)).collect()] == [True, False]
    ext = spark.createDataFrame([(-2.0, 0.0, -1.0, 1.0), (5.0, 0.0, 6.0, 1.0), (0.0, -3.0, 1.0, -1.0), (0.0, 5.0, 1.0, 6.0), (1.0, 1.0, 9.0, 9.0)], "a double, b double, c double, d double")
    got = [r[0] for r in ext.select(G.bbox_status(F.col("a"), F.col("b"), F.col("c"), F.col("d"), box)).collect()]
    assert got == ["OUTSIDE (too far west)", "OUTSIDE (too far east)", "OUTSIDE (too far south)", "OUTSIDE (too far north)", "INSIDE"]


def test_projections(spark):
    df = spark.createDataFrame([(12.335, 45.43), (15.0, 45.0), (9.0, 60.0), (21.0, 0.5)], "x double, y double").select(F.struct("x", "y").alias("p"))
    out = df.select("p", G.project_point(F.col("p"), 4326, 32633).alias("u"), G.project_point(F.col("p"), 4326, 3857).alias("m"))
    out = out.select("*", G.project_point(F.col("u"), 32633, 4326).alias("b"), G.project_point(F.col("m"), 3857, 32633).alias("u2")).collect()
    for r in out:
        assert r["b"]["x"] == pytest.approx(r["p"]["x"], abs=1e-9) and r["b"]["y"] == pytest.approx(r["p"]["y"], abs=1e-9)
        assert r["u2"]["x"] == pytest.approx(r["u"]["x"], abs=1e-3) and r["u2"]["y"] == pytest.approx(r["u"]["y"], abs=1e-3)
    # on the central meridian the grid is the meridian arc, scaled
    assert out[1]["u"]["x"] == pytest.approx(500000.0) and out[1]["u"]["y"] == pytest.approx(4982950.400, abs=1e-2)
    assert out[1]["m"]["x"] == pytest.approx(1669792.362, abs=1e-3)
    with pytest.raises(ValueError):
        G.project_point(F.col("p"), 4326, 2154)
