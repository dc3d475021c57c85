"""Whole batches of geometries give what the expressions give."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronogeo.functions import batches as B
from chronogeo.functions import geometry as G
from chronogeo.operators import geo
from chronogeo.session import spread

TEXTS = [
    "MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0),(1 1,1 2,2 2,2 1,1 1),(3 3,3 3.5,3.5 3.5,3 3)),((-9.25 9,10 9,1E1 10,-9.25 9)))",
    "MULTIPOLYGON (((0 0,0 3,3 3,3 0)))", "MULTIPOLYGON(((0.1 0.2,7.3 0.1,5.5 9.9)),((0.1 0.2,1 1,2 0)))", "MULTIPOLYGON(((0 0,2 1,2 -1,0 0,-2 1,-2 -1,0 0)))",
    "MULTIPOLYGON(((1 1)))", "MULTIPOLYGON EMPTY", "multipolygon(((0 0, 1 0, 1 1)))", "POLYGON((0 0,1 0,1 1),(2 2,3 3,3 2))", "SRID=3857;MULTIPOLYGON(((0 0,+1 0,1 .5)))",
    "MULTIPOLYGON(((0 0,1e400 0,1 1)))", "MULTIPOLYGON(((0 0,1,2 2)))", "POINT(1 2)", "", None,
]


def _frame(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, w string").coalesce(1)


# F9, F12, F13, F15, F16, F20
def test_batches_agree_with_expressions(spark):
    df = _frame(spark).select("i", G.parse_wkt(F.col("w")).alias("g"), G.let(F.col("w"), G._parsed).alias("want"))
    k = F.col("i")
    holed = F.when(k == 1, F.transform("g", lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.when(q["x"] > 0, q))))).when(k == 2, F.concat("g", F.array(F.lit(None)))).otherwise(F.col("g"))
    df = df.unionByName(df.select((k + 100).alias("i"), holed.alias("g"), holed.alias("want")))
    hashed = lambda shape: F.xxhash64(shape)
    out = df.select("i", "g", "want", G.measures(F.col("g")).alias("m"), G._measured(F.col("want")).alias("m2"),
                    hashed(G._batched(B.canonical, G.GEOMETRY_TYPE, G.GEOMETRY_TYPE, F.col("g"), G.canonical)).alias("c"), hashed(G.canonical(F.col("want"))).alias("c2"))
    for r in out.collect():
        assert repr((r["g"], r["m"], r["c"])) == repr((r["want"], r["m2"], r["c2"])), r["i"]


def test_plain_rows_are_done_in_batches(spark):
    shapes = _frame(spark).select("i", G.let(F.col("w"), G._parsed).alias("g"), "w").toArrow()
    geoms, texts = shapes["g"].combine_chunks(), shapes["w"].combine_chunks()
    for done, rows in ((B.parse(texts), {0, 1, 2, 3, 4, 9}), (B.measures(geoms), {0, 1, 2, 3, 4, 6, 7, 8}), (B.canonical(geoms), {0, 1, 3, 4, 6, 7, 8})):
        assert {i for i, v in enumerate(done.is_valid().to_pylist()) if v} == rows


def test_a_layer_in_another_system_is_repaired_and_compared(spark):
    here = "MULTIPOLYGON(((111319.49079327357 0,222638.98158654713 0,222638.98158654713 111325.14286638486,111319.49079327357 0)))"
    layer = spark.createDataFrame([("L", "a", 4326, "MULTIPOLYGON(((1 0,2 0,2 0,2 1)))"), ("L", "b", 4326, "MULTIPOLYGON(((3 0,2 0,2 1,3 0)))")],
                                  "layer string, identifier string, srid int, geometry string")
    got = geo.geometry_diff(layer, spark.createDataFrame([("a", here), ("b", here)], "identifier string, geometry string"))
    assert {r["identifier"]: r["significant"] for r in got.filter("identifier = 'b' or shift > 1e-6").collect()} == {"b": True}


def test_a_file_of_one_row_group_is_dealt_to_many_tasks(spark, tmp_path):
    spark.range(900).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spread(spark.read.parquet(str(tmp_path / "t")), 100)
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert df.rdd.getNumPartitions() == 9 and sum(r["count"] for r in sizes) == 900 and max(r["count"] for r in sizes) <= 110
