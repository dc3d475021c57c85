"""Keyed state of edits, walks and labels of hierarchies, segments of intervals, layout by place, one form of a shape."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from checks.stream_checks import feed_of
from chronogeo import schema
from chronogeo.functions import ewkb as W
from chronogeo.functions import geometry as G
from chronogeo.operators import features as FE
from chronogeo.operators import geo, hierarchy, intervals, spatial
from chronogeo.operators import graph as R
from chronogeo.plans import archive, publish
from chronogeo.session import settings
from chronogeo.streaming import stateful
from tests.conftest import rows
from tests.test_plans import _changes, _random_edits, _replay

# ---------------------------------------------------------------- keyed state


def _fed(spark, folder, batches):
    for batch in batches:
        _changes(spark, batch).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema.CHANGES).option("maxFilesPerTrigger", 1).parquet(folder)


def _now(spark, log, features, links):
    f, l = stateful.tables(spark, log, features, links)
    return {r["identifier"]: (r["name"], r["geometry"]) for r in f.collect()}, {tuple(r) for r in l.select("identifier", "source").collect()}


@pytest.mark.parametrize("cascade", [False, True])
def test_late_edits_and_restarts_equal_a_replay(spark, tmp_path, cascade):
    data = _random_edits(150, 11)
    late = random.Random(2).sample(data, len(data))  # no order at all
    start = {"k1": ("old", "g-old"), "hot": ("old", "g-old"), "still": ("s", "g")}
    features = spark.createDataFrame([(k, "Island", 0, n, g) for k, (n, g) in start.items()], schema.FEATURES)
    links = spark.createDataFrame([("k1", "Today"), ("hot", "x"), ("gone", "y")], schema.FEATURE_SOURCES)
    before = {("k1", "Today"), ("hot", "x"), ("gone", "y")}
    feed, log, ckpt = str(tmp_path / "feed"), str(tmp_path / "log"), str(tmp_path / "ckpt")
    assert _now(spark, log, features, links) == (start, before)  # nothing yet
    stream = _fed(spark, feed, [late[:80], late[80:100]])
    stateful.start(stream, features, links, log, ckpt, cascade).awaitTermination()
    assert _now(spark, log, features, links) == _replay(start, before, late[:100], cascade)[:2]
    rows_before = stateful.latest(spark, log).count()
    stateful.start(stream, features, links, log, ckpt, cascade).awaitTermination()  # nothing new
    assert stateful.latest(spark, log).count() == rows_before
    stateful.start(_fed(spark, feed, [late[100:]]), features, links, log, ckpt, cascade).awaitTermination()
    want = _replay(start, before, data, cascade)
    assert _now(spark, log, features, links) == want[:2]
    done = {r["identifier"]: r["applied"] for r in stateful.latest(spark, log).collect()}
    assert done == {k: sum(v == "applied" for (i, _), v in want[2].items() if i == k) for k in done}


def test_first_source_wiring_and_a_bounded_state(spark, tmp_path):
    rnd = random.Random(4)
    empty = spark.createDataFrame([], schema.FEATURES), spark.createDataFrame([], schema.FEATURE_SOURCES)
    rows_ = [("A" if rnd.random() < 0.7 else "B", rnd.choice("IUD"), i, f"k{rnd.randrange(3)}", f"g{i}") for i in range(60)]
    wide = spark.createDataFrame([(s, "buildings", n, op, k, "n", g, {"S1": True, "S2": True}) for s, op, n, k, g in rows_],
                                 "site string, kind string, seq long, op string, identifier string, name string, geometry string, flags map<string,boolean>")
    registry = spark.createDataFrame([("A", "buildings", o) for o in ("insert", "update", "delete")], "site string, kind string, op string")
    for i in range(3):
        wide.filter(F.col("seq").between(20 * i, 20 * i + 19)).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    stream = spark.readStream.schema(wide.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    log = str(tmp_path / "log")
    stateful.start(stream, *empty, log, str(tmp_path / "c"), mode="first", order=["S2"], registry=registry, keep=3).awaitTermination()
    data = [(op, n, k, "n", g, {"S2": True}) for s, op, n, k, g in rows_ if s == "A"]
    assert _now(spark, log, *empty) == _replay({}, set(), data)[:2]
    wide.filter("seq = 0").withColumn("site", F.lit("A")).withColumn("identifier", F.lit("k0")).write.mode("append").parquet(str(tmp_path / "feed"))
    stateful.start(stream, *empty, log, str(tmp_path / "c"), mode="first", order=["S2"], registry=registry, keep=3).awaitTermination()
    assert dict(rows(stateful.latest(spark, log), "identifier", "late"))["k0"] == 1  # older than what is kept apart
    assert _now(spark, log, *empty) == _replay({}, set(), data)[:2]
    with pytest.raises(ValueError, match="order"):
        stateful.start(stream, *empty, log, str(tmp_path / "c"), mode="first")


class _Held:
    """A list or value of the state that counts how often it is called."""

    def __init__(self, calls):
        self.calls, self.rows = calls, []

    def get(self):
        self.calls.append("get")
        return iter(self.rows) if isinstance(self.rows, list) else self.rows

    def appendValue(self, row):
        self.calls.append("append")
        self.rows = [*self.rows, row]

    def update(self, row):
        self.calls.append("update")
        self.rows = row


class _Handle:
    def __init__(self):
        self.calls = []

    def getListState(self, name, schema):
        return _Held(self.calls)

    def getValueState(self, name, schema):
        held = _Held(self.calls)
        held.rows = None
        return held


def test_calls_to_the_state_do_not_grow_with_the_edits():
    handle, p = _Handle(), stateful.EditProcessor()
    p.init(handle)
    made = lambda seqs: [Row(seq=n, op="IU"[n > 0], t="Island", z=0, name=f"n{n}", geometry=f"g{n}", links=["b", "a"]) for n in seqs]
    (last,) = p.handleInputRows(("k",), iter(made(range(0, 500, 2))), None)
    few = len(handle.calls)
    assert few <= 4 and (last.applied, last.geometry, last.links) == (250, "g498", ["a", "b"])
    twice = [Row(**{**r.asDict(), "geometry": "a"}) for r in made([499])]  # of two edits with a number the smaller one counts
    (last,) = p.handleInputRows(("k",), iter(made(range(1, 500, 2)) + twice + made(range(500))), None)
    assert len(handle.calls) <= 2 * few and (last.version, last.applied, last.geometry) == (2, 500, "a")
    (last,) = p.handleInputRows(("k",), iter(made([500])), None)
    assert (last.version, last.applied, last.geometry) == (3, 501, "g500")


def test_a_feed_is_written_by_many_tasks(spark):
    edits = spark.range(4000).select(F.col("id").alias("seq"), F.lit("x").alias("identifier"))
    for rows_, files in ((250_000, 1), (300, 4)):
        feed, n = feed_of(spark, edits, rows=rows_)
        assert n == files and len(spark.read.parquet(feed).inputFiles()) == 4 * files
        assert rows(spark.read.parquet(feed), "seq", "identifier") == rows(edits)


# ---------------------------------------------------------------- hierarchies

def _brute_up(edges):
    up = defaultdict(set)
    for s, o in edges:
        up[s].add(o)
    out = {}
    for s in {x for e in edges for x in e}:
        depth, frontier = {s: 0}, [s]
        while frontier:
            more = []
            for x in frontier:
                for y in sorted(up[x]):
                    if y not in depth:
                        depth[y] = depth[x] + 1
                        more.append(y)
            frontier = more
        out[s] = depth
    return out


GRAPHS = {
    "forest": [(f"n{i}", f"n{i // 3}") for i in range(1, 40)] + [(f"m{i}", f"m{i - 1}") for i in range(1, 20)],
    "dag": [("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("a", "r"), ("e", "d"), ("e", "a"), ("x", "r")],
    "cycle": [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "d"), ("f", "g")]}


@pytest.mark.parametrize("name", GRAPHS)
def test_walks_make_the_pairs_that_are_asked_for(spark, name):
    edges = GRAPHS[name]
    links = spark.createDataFrame([*edges, edges[0], ("z", None)], "s string, o string")
    asked = ["e", "d"] if name != "forest" else ["n39", "n5", "m19"]
    items = spark.createDataFrame([(x,) for x in [*asked, "alone", asked[0], None]], "s string")
    up = _brute_up(edges) | {"alone": {"alone": 0}}
    pairs = hierarchy.ancestors_of(links, items)
    want = {(s, o): d for s in [*asked, "alone"] for o, d in up[s].items()}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(want) and {(s, o): d for s, o, d in got} == want
    counts = {(r["s"], r["o"]): r["n"] for r in hierarchy.way_counts(pairs, links).collect()}
    assert counts == {(s, o): sum(o in up[m] for m in up[s]) for s, o in want}


def test_a_forest_needs_no_pairs_of_the_middle(spark, monkeypatch):
    links = spark.createDataFrame(GRAPHS["forest"], "s string, o string")
    pairs = R.closure(links)
    monkeypatch.setattr(hierarchy, "ancestors_of", lambda *_: pytest.fail("walked"))
    assert hierarchy.way_counts(pairs, links).count() == pairs.count()


def test_order_labels(spark):
    edges = GRAPHS["forest"] + [(f"q{i:02d}", "hub") for i in range(60)]
    label = {r["node"]: (r["enter"], r["exit"], r["depth"]) for r in hierarchy.order_labels(spark.createDataFrame(edges, "s string, o string")).collect()}
    up = _brute_up(edges)
    assert set(label) == set(up) and sorted(x for a, b, _ in label.values() for x in (a, b)) == list(range(2 * len(up)))
    for s in up:
        assert label[s][2] == len(up[s]) - 1
        for o in up:
            assert (label[o][0] <= label[s][0] and label[s][1] <= label[o][1]) == (o in up[s])
    siblings = sorted((x for x in label if x.startswith("q")), key=lambda x: label[x][0])
    assert siblings == sorted(siblings)
    for bad in ("dag", "cycle"):
        with pytest.raises(ValueError):
            hierarchy.order_labels(spark.createDataFrame(GRAPHS[bad], "s string, o string"))
    assert hierarchy.order_labels(spark.createDataFrame([], "s string, o string")).count() == 0


def test_paths_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    made = []
    real = hierarchy.cut
    monkeypatch.setattr(hierarchy, "cut", lambda df: made.append(1) or real(df))
    links = spark.createDataFrame([(f"c{i}", f"c{i - 1}") for i in range(1, 1001)] + [("x", "y"), ("y", "x"), ("u", "nowhere")], "s string, o string")
    labels = spark.createDataFrame([(f"c{i}", str(i)) for i in range(1, 1001)] + [("c1", "one"), ("x", "x"), ("y", "y"), ("u", "u")], "s string, label string")
    roots = spark.createDataFrame([("c0", "0"), ("c990", "near")], "s string, path string")
    out = Counter(tuple(r) for r in archive.extend_paths(roots, links, labels).filter("s IN ('c3', 'c992', 'c990', 'x', 'u', 'c989')").select("s", "path").collect())
    long = [", ".join(["0", one, *map(str, range(2, 990))]) for one in ("1", "one")]
    assert out == Counter([("c3", "0, 1, 2, 3"), ("c3", "0, one, 2, 3"), ("c992", "near, 991, 992"), ("c990", "near"), *[("c989", x) for x in long]])
    assert len(made) <= 13


def test_item_paths_of_several_parents(spark):
    links = spark.createDataFrame(GRAPHS["dag"], "s string, o string")
    labels = spark.createDataFrame([(x, x.upper()) for x in "abcderx"], "node string, label string")
    items = spark.createDataFrame([("e",), ("x",)], "s string")
    assert rows(archive.item_paths(links, labels, items)) == rows(archive.item_paths(links, labels).filter("s IN ('e', 'x')"))


# ---------------------------------------------------------------- intervals and windows

def test_intervals_meet_points(spark):
    rnd = random.Random(3)
    spans = [(i, a, None if rnd.random() < 0.2 else a + rnd.randrange(-3, 400)) for i in range(200) for a in [rnd.randrange(-50, 500)]] + [(900, None, 5)]
    points = sorted(rnd.sample(range(0, 450), 60))
    df = spark.createDataFrame(spans, "id int, a int, b int")
    pts = spark.createDataFrame([(p,) for p in [*points, points[0], None]], "p int")
    for closed in (False, True):
        out = Counter(tuple(r) for r in intervals.at_points(df, pts, "a", "b", "p", closed).select("id", "p").collect())
        assert out == Counter((i, p) for i, a, b in spans if a is not None for p in points if a <= p and (b is None or (p <= b if closed else p < b)))
    plan = intervals.at_points(df, pts, "a", "b", "p")
    assert plan.columns == ["id", "a", "b", "p"] and "NestedLoop" not in plan._jdf.queryExecution().toString()
    assert intervals.at_points(df, pts.limit(0), "a", "b", "p").count() == 0
    days = spark.sql("SELECT 1 AS id, DATE'2020-01-30' AS bob, DATE'2020-03-01' AS eoe UNION ALL SELECT 2, DATE'1960-01-01', NULL")
    asked = spark.sql("SELECT explode(array(DATE'1960-01-01', DATE'2020-01-30', DATE'2020-02-29', DATE'2020-03-01')) AS date")
    assert rows(FE.as_of_dates(days, asked), "id", F.col("date").cast("string")) == sorted(
        [(1, "2020-01-30"), (1, "2020-02-29"), (2, "1960-01-01"), (2, "2020-01-30"), (2, "2020-02-29"), (2, "2020-03-01")])


def test_many_windows_and_pruned_files(spark, tmp_path):
    rnd = random.Random(8)
    boxes = [(i, x, y, x + rnd.random() * 3, y + rnd.random() * 3) for i in range(400) for x, y in [(rnd.uniform(-100, 100), rnd.uniform(-100, 100))]]
    df = spark.createDataFrame([*boxes, (999, None, None, None, None)], "id int, min_x double, min_y double, max_x double, max_y double")
    wins = [(f"w{i}", x, y, x + s, y + s * rnd.random()) for i in range(300) for x, y, s in [(rnd.uniform(-110, 100), rnd.uniform(-110, 100), rnd.choice([0.0, 1.0, 5.0, 64.0, 300.0]))]]
    wins.append(("whole", -200.0, -200.0, 200.0, 200.0))
    windows = spark.createDataFrame(wins, "window string, x0 double, y0 double, x1 double, y1 double")
    out = Counter(tuple(r) for r in spatial.join_windows(df, windows, geom=None).select("window", "id").collect())
    assert out == Counter((w, i) for w, x0, y0, x1, y1 in wins for i, a, b, c, d in boxes if a >= x0 and c <= x1 and b >= y0 and d <= y1)
    assert spatial.join_windows(df, windows.limit(0), geom=None).count() == 0
    square = lambda x, y: F.array(F.array(F.array(*[F.struct((x + a).alias("x"), (y + b).alias("y")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 0))])))
    grid = spark.range(64 * 64).select("id", square((F.col("id") % 64).cast("double"), F.floor(F.col("id") / 64).cast("double")).alias("geom"))
    with_files = str(tmp_path / "grid")
    spatial.write_by_place(grid, with_files, 1.0)
    found = spatial.read_window(spark, with_files, (10, 10, 14, 14))
    assert found.count() == 16
    with settings(spark, {"spark.sql.maxMetadataStringLength": "2000"}):
        plan = spatial.read_window(spark, with_files, (10, 10, 14, 14))._jdf.queryExecution().executedPlan().toString()
    assert all(f"{op}({c}," in plan for op, c in (("GreaterThanOrEqual", "min_x"), ("LessThanOrEqual", "max_x"), ("GreaterThanOrEqual", "min_y"), ("LessThanOrEqual", "max_y")))
    spread = spark.read.parquet(with_files).groupBy(F.input_file_name().alias("f")).agg((F.max("max_x") - F.min("min_x")).alias("w"), (F.max("max_y") - F.min("min_y")).alias("h"), F.count("*").alias("n"))
    assert all(r["w"] * r["h"] < 6 * r["n"] + 200 for r in spread.collect())  # a file is a patch, not a strip of the whole
    cells = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int").orderBy(spatial.z_order(F.col("x"), F.col("y"), 1.0))
    assert [tuple(r) for r in cells.collect()][:8] == [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (3, 0), (2, 1), (3, 1)]


# ---------------------------------------------------------------- shapes

def test_one_form_of_a_shape(spark):
    same = ["MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0),(1 1,1 2,2 2,2 1,1 1)),((9 9,10 9,10 10,9 9)))",
            "MULTIPOLYGON(((10 10,10 9,9 9,10 10)),((4 4,4 0,0 0,0 4,4 4),(2 2,2 1,1 1,1 2,2 2)))",
            "MULTIPOLYGON(((9 9,10 9,10 10)),((4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2)))"]
    other = ["MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0)),((9 9,10 9,10 10,9 9)))", "MULTIPOLYGON(((0 0,4 4,4 0,0 4,0 0)))", "MULTIPOLYGON EMPTY"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(same + other)], "i int, w string")
    got = dict(rows(df, "i", G.geometry_digest(G.parse_wkt(F.col("w")))))
    assert len({got[i] for i in range(3)}) == 1 and len(set(got.values())) == 4
    pinched = spark.createDataFrame([("MULTIPOLYGON(((0 0,2 1,2 -1,0 0,-2 1,-2 -1,0 0)))",), ("MULTIPOLYGON(((0 0,-2 1,-2 -1,0 0,2 1,2 -1,0 0)))",)], "w string")
    assert pinched.select(G.geometry_digest(G.parse_wkt(F.col("w"))).alias("d")).distinct().count() == 1  # the first vertex comes twice
    layer = spark.createDataFrame([("L", "a", 3857, same[0])], "layer string, identifier string, srid int, geometry string")
    assert geo.geometry_diff(layer, spark.createDataFrame([("a", same[1])], "identifier string, geometry string")).count() == 0
    assert geo.geometry_diff(layer, spark.createDataFrame([("a", other[0])], "identifier string, geometry string")).count() == 1


def test_the_plan_of_a_difference_stays_short(spark):
    text = F.concat(*[F.lit("MULTIPOLYGON(((0 0,1 0,1 "), F.col("id").cast("string"), F.lit(",0 0)))")])
    layer = spark.range(3).select(F.lit("L").alias("layer"), F.col("id").alias("identifier"), F.lit(3857).alias("srid"), text.alias("geometry"))
    diff = geo.geometry_diff(layer, layer.select("identifier", "geometry"))
    assert len(diff._jdf.queryExecution().optimizedPlan().toString()) < 60_000


def test_batches_without_system_or_geometry(spark):
    df = spark.range(12).select("id", F.when(F.col("id") % 3 == 0, F.from_json(F.lit("[]"), G.GEOMETRY_TYPE)).alias("g"), F.lit(None).cast("int").alias("srid"))
    for batch in (df, df.filter("id % 3 = 0"), df.filter("id % 3 = 1")):
        out = batch.select("id", W.encode_ewkb(F.col("g"), F.col("srid")).alias("h"))
        assert dict(rows(out.select("id", G.to_wkt(W.decode_ewkb(F.col("h"))).alias("w")))) == {
            r["id"]: "MULTIPOLYGON EMPTY" if r["id"] % 3 == 0 else None for r in batch.collect()}


def test_counts_are_observed_while_writing(spark, tmp_path):
    layers = spark.createDataFrame([("A", "buildings", "i1", "a", 3857, None, "S1", True), ("A", "buildings", "i2", "b", 3857, None, "Today", True)], schema.LAYER_LONG)
    state = publish.State(spark.createDataFrame([("i1", "Buildings", 1, "a", None)], schema.FEATURES), spark.createDataFrame([], schema.FEATURE_SOURCES),
                          schema.source_years_seed(spark))
    stored, counts = publish.commit(publish.update_state(layers, state), str(tmp_path / "p"))
    seeds = len(schema.SOURCE_YEAR_ROWS)
    assert rows(counts) == [("feature_sources", 2, 2), ("features", 2, 1), ("source_years", seeds + 1, 1)]
    assert stored.features.count() == 2 and stored.source_years.count() == seeds + 1
