"""Cases in which rows used to get lost or changed without a word."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chronogeo.functions import geometry as G
from chronogeo.operators import features as FE
from chronogeo.operators import geo
from chronogeo.operators import graph as R
from chronogeo.plans import archive, reports
from chronogeo.sources import readers
from chronogeo.streaming import propagate as K
from tests.conftest import rows


def test_deep_chains_and_cycles(spark):
    links = spark.createDataFrame([(f"n{i}", f"n{i - 1}") for i in range(1, 40)], "s string, o string")
    assert R.closure(links).count() == 40 * 41 // 2
    assert R.closure(links, acyclic=True).count() == 40 * 41 // 2
    ring = links.unionByName(spark.createDataFrame([("n0", "n39")], "s string, o string"))
    assert R.closure(ring).count() == 1600
    with pytest.raises(ValueError, match="cycle"):
        R.closure(ring, acyclic=True)
    few = links.limit(12)
    labels = spark.createDataFrame([(f"n{i}", f"l{i}") for i in range(13)], "s string, label string")
    roots = spark.createDataFrame([("n0", "l0")], "s string, path string")
    assert archive.extend_paths(roots, few, labels).count() == 13


def test_triples_are_compared_whole(spark):
    one = {c: None for c in R.TRIPLE_COLUMNS} | {"s": "a", "p": "p", "o": "x"}
    schema = ", ".join(f"{c} string" for c in R.TRIPLE_COLUMNS)
    make = lambda *ts: spark.createDataFrame([tuple({**one, **t}[c] for c in R.TRIPLE_COLUMNS) for t in ts], schema)
    iri, literal, other = {"o_type": "iri"}, {"o_type": "literal"}, {"o_type": "iri", "g": "g1"}
    assert R.add_triples(make(iri), make(literal, iri)).count() == 2
    assert rows(R.delete_triples(make(iri, literal, other), make(iri)), "o_type", "g") == [("iri", "g1"), ("literal", None)]


def test_unlisted_sources_come_last(spark):
    layers = spark.createDataFrame(
        [("A", "t", "i1", "Old", True), ("A", "t", "i1", "Today", True), ("A", "t", "i2", "Old", True)],
        "site string, kind string, identifier string, source string, present boolean")
    none = spark.createDataFrame([], "identifier string, source string")
    assert rows(FE.publish_sources(layers, none, mode="first", order=["Today"]).table) == [("i1", "Today"), ("i2", "Old")]


def test_layers_with_other_ids_and_number_flags(spark, tmp_path):
    spark.createDataFrame([("b1", "POINT", 1, 0)], "BW_ID string, geometry string, `1900` int, `2000` int").write.parquet(str(tmp_path / "qgis_AA_buildings"))
    spark.createDataFrame([("c1", "POINT", True)], "identifier string, geometry string, `1800` boolean").write.parquet(str(tmp_path / "qgis_BB_buildings"))
    assert rows(readers.read_layers(spark, str(tmp_path)), "identifier", "source") == [("c1", "1800")]
    got = rows(readers.read_layers(spark, str(tmp_path), sources=["1900", "2000"]), "identifier", "srid", "source", "present")
    assert got == [("b1", 3857, "1900", True), ("b1", 3857, "2000", False), ("c1", 3857, "1800", True)]


def test_broken_text_and_foreign_systems(spark):
    df = spark.createDataFrame([
        (1, "POINT(1 2)", 3857), (2, "POLYGON((0 0, 1 0, 2 x, 0 0))", 3857), (3, "GARBAGE", 3857), (4, "POLYGON((0 0, 1, 2 2, 0 0))", 3857),
        (5, "SRID=3857;MULTIPOLYGON (((0 0, 1e1 0, -.5 2.5, 0 0)))", 3857), (6, "MULTIPOLYGON EMPTY", 3857),
        (7, "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))", 25832)], "id int, geometry string, srid int")
    parsed = {r["id"]: r["g"] for r in df.select("id", G.parse_wkt(F.col("geometry")).alias("g")).collect()}
    assert [i for i, g in parsed.items() if g is None] == [1, 2, 3, 4]
    assert parsed[6] == [] and (parsed[5][0][0][2]["x"], parsed[5][0][0][1]["x"]) == (-0.5, 10.0)
    moved = geo.retarget(df, 4326)
    assert rows(moved.filter("id in (3, 7)"), "id", "geometry", "srid") == [(3, "GARBAGE", 3857), (7, "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))", 25832)]
    assert dict(rows(geo.check_typed(df.filter("id in (5, 7)")), "id", "problem")) == {7: "srid"}
    number = spark.sql("select explode(array(0.0012345678901234567D, 1e-17D, 1.5D, 12345678.25D, 3D)) as v")
    assert rows(number, G.number_text(F.col("v"))) == [("0.00000000000000001",), ("0.0012345678901234567",), ("1.5",), ("12345678.25",), ("3",)]


def test_no_prefixes_and_wild_ones(spark):
    ids = spark.createDataFrame([("AxxxB1",), ("AB",), ("C",)], "identifier string")
    assert reports.with_prefix(ids, spark.createDataFrame([], "prefix string")).count() == 0
    assert rows(reports.with_prefix(ids, spark.createDataFrame([("A%B",)], "prefix string"), "like"), "identifier") == [("AB",), ("AxxxB1",)]


def test_two_streams_and_equal_numbers(spark, tmp_path):
    schema = "site string, kind string, seq long, op string, identifier string, name string, geometry string, flags map<string,boolean>"
    edit = lambda i, seq, name, source: ("A", "buildings", seq, "I", i, name, "G", {source: True})
    one = spark.createDataFrame([edit("i1", 1, "b", "S2"), edit("i1", 1, "a", "S1")], schema)
    root = str(tmp_path / "root")
    K.propagate_batch(one, 0, root, buckets=2, query="first")
    K.propagate_batch(spark.createDataFrame([edit("i2", 1, "c", "S3")], schema), 0, root, buckets=2, query="second")
    K.propagate_batch(one.withColumn("identifier", F.lit("i3")), 0, root, buckets=2, query="second")  # a replay
    features, links = K.read_tables(spark, root)
    assert rows(features, "identifier", "name") == [("i1", "a"), ("i2", "c")]
    assert rows(links, "identifier", "source") == [("i1", "S1"), ("i2", "S3")]


def test_wired_operations_and_first_sources_in_a_batch(spark, tmp_path):
    schema = "site string, kind string, seq long, op string, identifier string, name string, geometry string, flags map<string,boolean>"
    flags = {"S1": True, "S2": True, "S3": False}
    edits = spark.createDataFrame([
        ("A", "buildings", 1, "I", "i1", "a", "G", flags), ("A", "buildings", 2, "U", "i1", "a", "H", flags),
        ("A", "islands", 3, "I", "i2", "b", "G", flags), (None, "buildings", 4, "I", "i3", "c", "G", flags),
        ("A", "buildings", 5, "I", "i4", "d", "G", {"S3": False}), ("A", "buildings", 6, "I", "i5", "e", "G", None)], schema)
    registry = spark.createDataFrame([("A", "buildings", "insert"), ("A", "islands", "update")], "site string, kind string, op string")
    root = str(tmp_path / "root")
    K.propagate_batch(edits, 0, root, buckets=2, query="q", mode="first", order=["S3", "S2"], registry=registry)
    features, links = K.read_tables(spark, root)
    assert rows(features, "identifier", "geometry") == [("i1", "G"), ("i4", "G"), ("i5", "G")]
    assert rows(links, "identifier", "source") == [("i1", "S2")]
    outcomes = K.apply_changes(features.limit(0), links.limit(0), edits, registry=registry)[2]
    assert rows(outcomes.filter("outcome = 'unwired'"), "identifier", "op") == [("i1", "U"), ("i2", "I"), ("i3", "I")]
    with pytest.raises(ValueError, match="order"):
        K.propagate_batch(edits, 1, root, buckets=2, query="q", mode="first")
