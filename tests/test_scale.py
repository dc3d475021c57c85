"""Plans that keep their size: what is broadcast, what is shuffled, what is done vertex by vertex."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from chronogeo.functions import geometry as G
from chronogeo.operators import intervals
from chronogeo.operators import properties as PR
from chronogeo.schema import TRIPLES
from chronogeo.session import cut, prepare
from chronogeo.sources.readers import read_triples
from chronogeo.sources.writers import write_triples
from tests.conftest import rows


def _plan(df) -> str:
    return df._jdf.queryExecution().toString()


# F1
def test_points_are_sent_and_not_the_cut_up_intervals(spark, tmp_path, monkeypatch):
    spark.range(1000).select("id", F.lit(0).alias("a"), F.lit(None).cast("int").alias("b")).write.parquet(str(tmp_path / "df"))
    df, points = spark.read.parquet(str(tmp_path / "df")), spark.range(30).select(F.col("id").cast("int").alias("p"))
    found = intervals.at_points(df, points, "a", "b", "p")
    assert found.count() == 30_000
    assert "rightHint=(strategy=broadcast)" in _plan(found)
    monkeypatch.setattr(intervals, "FEW_MARKS", 0)
    many = intervals.at_points(df, points, "a", "b", "p")
    assert "SortMergeJoin" in _plan(many) and rows(many) == rows(found)


# F3, F8
@pytest.mark.parametrize("src,dst", [(a, b) for a in G.SRIDS for b in G.SRIDS if a != b])
def test_whole_geometries_are_projected_like_points(spark, src, dst):
    lonlat = [(12.3, 45.4), (15.0, 0.0), (9.1, -33.0), (-70.0, 61.0), (18.0, None), (None, 4.0)]
    flat = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(lonlat)], "i int, x double, y double")
    flat = flat.select("i", G.project_point(F.struct("x", "y"), 4326, src).alias("p"))
    shapes = flat.select("i", F.array(F.array(F.array("p", "p"), F.array("p").cast("array<struct<x:double,y:double>>")), F.array()).alias("g"), "p", F.lit(src).alias("srid"))
    shapes = shapes.unionByName(shapes.select((F.col("i") + 10).alias("i"), F.lit(None).cast(G.GEOMETRY_TYPE).alias("g"), "p", "srid"))
    out = shapes.select("i", "p", G.project_point(F.col("p"), src, dst).alias("want"), G.transform(F.col("g"), src, dst).alias("a"), G.transform_by_srid(F.col("g"), F.col("srid"), dst).alias("b"))
    assert "ArrowEvalPython" in _plan(out)
    for r in out.collect():
        for got in (r["a"], r["b"]):
            if r["i"] >= 10:
                assert got is None
                continue
            assert [len(part) for part in got] == [2, 0] and [len(ring) for ring in got[0]] == [2, 1]
            for p in got[0][0] + got[0][1]:
                for here, want in zip(p, r["want"], strict=True):
                    assert here is None if want is None else here == pytest.approx(want, rel=1e-12, abs=1e-7)


def test_rows_of_mixed_systems_and_unknown_ones(spark):
    point = F.array(F.array(F.array(F.struct(F.lit(12.0).alias("x"), F.lit(45.0).alias("y")))))
    df = spark.createDataFrame([(None,), (0,), (3857,), (4326,), (2154,)], "srid int").select("srid", point.alias("g"))
    got = {r["srid"]: r["m"] for r in df.select("srid", G.transform_by_srid(F.col("g"), F.col("srid"), 3857).alias("m")).collect()}
    assert got[2154] is None and got[4326][0][0][0]["x"] == pytest.approx(1335833.889519)
    assert all(tuple(got[s][0][0][0]) == (12.0, 45.0) for s in (None, 0, 3857))


# F2, F4, F7, F14, F21
def test_a_property_table_keeps_one_list_per_node(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(PR, "cut", lambda df: counted.append(df.columns) or cut(df))
    data = [("g", "a", p, o, "iri", None, None) for p in ("p", "q") for o in ("2", "1", "1")] + [("g", "b", "p", str(i), "iri", None, None) for i in range(7)]
    g = spark.createDataFrame(data, TRIPLES)
    table = PR.property_table(g, ["p", "q", "r"], 5)
    assert counted == [["_h"], ["s"]]  # texts are counted for the few nodes that can be hubs only
    plan = _plan(table.rows).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("collect_set") == 1
    assert [(r["s"], [[v["o"] for v in r[c]] for c in ("v0", "v1", "v2")]) for r in table.rows.collect()] == [("a", [["1", "2"], ["1", "2"], []])]
    assert rows(table.hubs.select("s", "o")) == [("b", str(i)) for i in range(7)]
    del counted[:]
    assert PR.property_table(g, ["p", "q"]).hubs.isEmpty() and counted == [["_h"]]


def test_compressed_files_do_not_pass_for_small_tables(spark, tmp_path):
    big = spark.range(400_000).select(F.col("id").alias("k"), F.concat(F.lit("http://x/" + "y" * 60), F.col("id") % 50).alias("v"))
    big.write.parquet(str(tmp_path / "t"))
    left, right = (prepare(spark).read.parquet(str(tmp_path / "t")) for _ in range(2))
    assert "strategy=broadcast" not in _plan(left.join(right, "k")) and "BroadcastHashJoin" not in _plan(left.join(right, "k")).split("== Physical Plan ==")[1]


def test_a_graph_in_order_is_written_where_it_is(spark, tmp_path):
    parts = [spark.range(20).select(F.lit(None).cast("string").alias("g"), F.col("id").cast("string").alias("s"), F.lit(p).alias("p"), F.lit("o").alias("o"),
                                    F.lit("iri").alias("o_type"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("dtype")) for p in ("x:p", "x:q")]
    g = parts[0].unionByName(parts[1])
    write_triples(g, str(tmp_path / "a"))
    write_triples(g, str(tmp_path / "b"), sorted_out=True)
    assert rows(read_triples(spark, str(tmp_path / "b"))) == rows(read_triples(spark, str(tmp_path / "a")))


def test_a_graph_is_written_in_one_stage(spark, tmp_path):
    ends = [spark.range(300).select(F.lit(None).cast("string").alias("g"), F.col("id").cast("string").alias("s"), F.concat(F.lit("x:p"), F.col("id") % k).alias("p"),
                                    F.lit("o").alias("o"), F.lit("iri").alias("o_type"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("dtype")) for k in (3, 100)]
    sc = spark.sparkContext
    for i, g in enumerate(ends):
        sc.setJobGroup(f"written {i}", "")
        write_triples(g, str(tmp_path / str(i)))
        jobs = sc.statusTracker().getJobIdsForGroup(f"written {i}")
        sc.setLocalProperty("spark.jobGroup.id", None)
        assert sum(len(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs) == 1
        assert rows(read_triples(spark, str(tmp_path / str(i))).select(*g.columns)) == rows(g)
