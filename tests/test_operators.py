from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronogeo import schema
from chronogeo.operators import features as M
from chronogeo.operators import geo
from chronogeo.operators import graph as R
from chronogeo.operators import periods as P
from chronogeo.operators import phases as H
from chronogeo.operators import skew
from chronogeo.plans import buildings as B
from chronogeo.plans import diagnosis as D
from chronogeo.plans import export as E
from chronogeo.plans import publish as U
from chronogeo.plans import reports as RP
from chronogeo.plans.publish import State
from chronogeo.schema import VOCAB as V
from chronogeo.sources import readers, snapshots, writers
from tests.conftest import rows

SQUARE = "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)))"


# ---------------------------------------------------------------- periods

def test_export_site_unions_and_flags(spark):
    a = spark.createDataFrame([(1, "G1", "A", "1982"), (1, "G1", "A", "1982"), (2, "G2", None, "1982")], "id int, geom string, bw_id string, Date string")
    b = spark.createDataFrame([(3, "G1", "A", "2019", 1.5)], "id long, geometry string, BW_ID string, Date string, Height double")
    config = E.SiteExport("s", "islands", {"1982": "1982", "2019": "2019"}, {"geom": "geometry", "bw_id": "BW_ID"})
    out = E.export_site([a, b], config, E.CONTRACT)
    assert out.columns == ["identifier", "geometry", "1982", "2019"]
    got = rows(out)
    assert [r for r in got if r[0] == "A"] == [("A", "G1", 0, 1), ("A", "G1", 1, 0)]
    (filled,) = [r for r in got if r[0] != "A"]
    assert len(filled[0]) == 36 and filled[1:] == ("G2", 1, 0)
    assert got == rows(E.export_site([a, b], config, E.CONTRACT))
    layer = E.import_layer(out, {"Today": ["2019"], "1982: Ortofoto": ["1982", "1981"], "1694:dis.22": ["1694"]})
    assert [r for r in rows(layer) if r[0] == "A"] == [("A", "G1", True, True, False)]
    assert E.unmapped_periods(out, {"Today": ["2019"]}) == ["1982"]


def test_long_and_wide_round_trip(spark):
    wide = spark.createDataFrame([("a", True, False, None), ("b", False, False, True)], "identifier string, Today boolean, `1982: Ortofoto` boolean, `1694:dis.22` boolean")
    assert P.source_columns(wide) == ["Today", "1982: Ortofoto", "1694:dis.22"]
    long = P.to_long(wide, ["identifier"])
    assert long.count() == 6 and long.filter("present is null").count() == 0
    assert rows(P.to_wide(long, ["identifier"], P.source_columns(wide))) == [("a", True, False, False), ("b", False, False, True)]
    assert rows(P.latest_source(wide, ["1694:dis.22", "Today"]), "identifier", "source") == [("a", "Today"), ("b", "1694:dis.22")]


def test_sequence_ids_are_dense_with_a_hot_order_value(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    out = P.assign_sequence_ids(df, "SS_BLDG_", 58, ["k"], partitions=6)
    got = sorted((int(r["identifier"][8:]), r["k"]) for r in out.collect())
    assert [n for n, _ in got] == list(range(58, 3058))
    assert [k for _, k in got] == sorted(k for _, k in got)


# ---------------------------------------------------------------- phases

def _layer(spark, data):
    """data: identifier, name, {source: present}."""
    flat = [("s", "buildings", i, n, 3857, SQUARE, s, p) for i, n, flags in data for s, p in flags.items()]
    return spark.createDataFrame(flat, schema.LAYER_LONG)


def test_three_phases_of_one_building(spark):
    years = spark.createDataFrame([("1831", 1831, 1831), ("1838", 1838, 1841), ("1982", 1982, 1982), ("Today", 2000, 40000)], schema.SOURCE_YEARS)
    layer = _layer(spark, [
        ("X_BLDG_13", "Casa", {"1831": True, "1838": True, "1982": False}), ("X_BLDG_13.1", None, {"1982": True}), ("X_BLDG_13.2", "z", {"Today": True}),
        ("X_BLDG_9", None, {"unknown": True, "1982": False})])
    heads, phases = B.building_phases(layer, years)
    assert rows(phases, "identifier", "bob", "eoe") == [("X_BLDG_13", 1831, 1981), ("X_BLDG_13.1", 1982, 1999), ("X_BLDG_13.2", 2000, None)]
    assert rows(heads) == [("X_BLDG_13", "Casa", 3, 0), ("X_BLDG_9", None, 0, 1)]
    triples = B.building_triples(heads.withColumn("island", F.lit("x:isle")), phases)
    # 8 per building, 8 per phase, 1 per closed phase
    assert triples.count() == 16 + 24 + 2 == triples.distinct().count()
    ends = triples.filter(F.col("p") == V.c("P82b_end_of_the_end"))
    assert rows(ends, "o", "dtype") == [("1981-12-31", V.xsd_date), ("1999-12-31", V.xsd_date)]
    assert rows(triples.filter((F.col("p") == V.label) & F.col("o").isin("Casa", "Unknown")), "o") == [("Casa",), ("Unknown",)]


def _brute_intervals(phases):
    out = {}
    for base in {p[0] for p in phases}:
        run = sorted((p for p in phases if p[0] == base), key=lambda p: (p[2], p[1]))
        for i, p in enumerate(run):
            out[p[1]] = run[i + 1][2] - 1 if i + 1 < len(run) else None
    return out


def test_intervals_with_equal_years_and_a_hot_building(spark):
    data = [("hot", f"hot.{i:04d}", 1500 + i % 40) for i in range(600)] + [(f"b{i // 3}", f"b{i // 3}.{i}", 1600 + i % 2) for i in range(900)]
    df = spark.createDataFrame(data, "base_id string, identifier string, bob int").withColumn("name", F.lit("n"))
    got = {r["identifier"]: r["eoe"] for r in H.phase_intervals(df).collect()}
    assert got == _brute_intervals(data)
    assert H.phase_intervals(df).filter("inverted").count() == sum(1 for b, i, y in data if got[i] is not None and got[i] < y)


def test_chunked_look_back_equals_plain_order(spark):
    data = [("hot" if i % 3 == 0 else f"k{i % 7}", i, i * 11 % 97 if i % 5 else None) for i in range(1200)]
    df = spark.createDataFrame(data, "k string, seq long, v long")
    prev, last = {}, {}
    want_prev, want_last = {}, {}
    for k, seq, v in data:
        want_prev[seq] = prev.get(k)
        prev[k] = v
        last[k] = v if v is not None else last.get(k)
        want_last[seq] = last[k]
    assert {r["seq"]: r["p"] for r in skew.previous_in_group(df, "k", "seq", "v", "p", chunks=9).collect()} == want_prev
    assert {r["seq"]: r["p"] for r in skew.last_before(df, "k", "seq", "v", "p", chunks=9).collect()} == want_last
    assert {r["seq"]: r["p"] for r in skew.previous_in_group(df, "k", "seq", "v", "p", limits=[]).collect()} == want_prev


# ---------------------------------------------------------------- publish, diagnose, repair

def _drifted(spark):
    layer = _layer(spark, [
        ("X_BLDG_1", "a", {"Today": True, "1982: Ortofoto": True}), ("X_BLDG_2", "b", {"Today": False, "1694:dis.22": True}), ("X_BLDG 3", None, {"Today": True})])
    features = spark.createDataFrame([("X_BLDG_1", "Buildings", 1, "a", SQUARE), ("X_BLDG_9", "Buildings", 1, "gone", SQUARE)], schema.FEATURES)
    links = spark.createDataFrame([("X_BLDG_1", "Today"), ("X_BLDG_8", "Today")], schema.FEATURE_SOURCES)
    registry = spark.createDataFrame([("s", "buildings", "insert")], "site string, kind string, op string")
    return layer, State(features, links, schema.source_years_seed(spark)), registry


def test_publish_modes_and_idempotence(spark):
    layer, state, _ = _drifted(spark)
    once = U.update_state(layer, state)
    assert rows(once.state.features, "identifier") == [("X_BLDG 3",), ("X_BLDG_1",), ("X_BLDG_2",), ("X_BLDG_9",)]
    assert rows(once.state.feature_sources) == [
        ("X_BLDG 3", "Today"), ("X_BLDG_1", "1982: Ortofoto"), ("X_BLDG_1", "Today"), ("X_BLDG_2", "1694:dis.22"), ("X_BLDG_8", "Today")]
    assert rows(once.source_years, "source", "start", "end") == [("1694:dis.22", 1694, 1694)]
    twice = U.update_state(layer, once.state)
    for a, b in zip(once.state, twice.state):
        assert rows(a) == rows(b)
    first = M.publish_sources(layer, state.feature_sources, "first", schema.SOURCE_ORDER + ["1694:dis.22"])
    assert rows(first.delta) == [("X_BLDG 3", "Today", "inserted"), ("X_BLDG_2", "1694:dis.22", "inserted")]


def test_duplicate_identifier_gets_one_winner(spark):
    layer = spark.createDataFrame([("s", "islands", "A", "n", 3857, "G2", "Today", True), ("s", "islands", "A", "n", 3857, "G1", "Today", True)], schema.LAYER_LONG)
    empty = spark.createDataFrame([], schema.FEATURES)
    assert rows(M.publish_features(layer, empty, dst_srid=None).table) == [("A", "Island", 0, "n", "G1")]
    assert rows(M.check_keys(layer, ["identifier"])) == [("A", 2, "duplicate key")]


def test_diagnosis_before_and_after_repair(spark):
    layer, state, registry = _drifted(spark)
    rdf = spark.createDataFrame([("X_BLDG_1", "B1"), ("X_BLDG 7", "B2")], "identifier string, building string")
    found = D.diagnose(layer, state, registry, rdf, ["odd"])
    assert rows(found, "category", "item") == sorted([
        ("missing_from_production", "X_BLDG 3"), ("missing_from_production", "X_BLDG_2"), ("orphaned_in_production", "X_BLDG_9"),
        ("orphaned_feature_sources", "X_BLDG_8"), ("source_name_mismatches", "1694:dis.22"), ("missing_triggers", "update"),
        ("missing_triggers", "delete"), ("rdf_mismatches", "X_BLDG 7"), ("table_structure_issues", "odd")])
    totals = {r["category"]: r["n"] for r in D.issue_totals(found).collect()}
    assert totals["missing_from_production"] == 1 and totals["missing_triggers"] == 1 and totals[None] == 7
    fixed, wired, log = D.repair(layer, state, registry, drop_orphans=True)
    assert D.diagnose(layer, fixed, wired).count() == 0
    assert log.filter("step = 'orphaned features'").count() == 1
    _, _, again = D.repair(layer, fixed, wired, drop_orphans=True)
    assert again.count() == 0


def test_repair_moves_geometry_on_request(spark):
    layer, state, registry = _drifted(spark)
    moved = layer.withColumn("geometry", F.lit("MULTIPOLYGON(((5 5,6 5,6 6,5 5)))"))
    fixed, _, log = D.repair(moved, state, registry, update_geometry=True)
    assert rows(log.filter("step = 'geometry'"), "item") == [("X_BLDG_1",)]
    assert rows(fixed.features.filter("identifier = 'X_BLDG_1'"), "geometry") == [("MULTIPOLYGON(((5 5,6 5,6 6,5 5)))",)]


def test_null_keys_do_not_poison_anti_joins(spark):
    target = spark.createDataFrame([("a",), (None,)], "k string")
    incoming = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    change = M.insert_missing(target, incoming, ["k"])
    assert rows(change.table) == [(None,), ("a",), ("b",)]
    assert rows(M.delete_orphans(incoming, target, "k").table) == [("a",)]


def test_mutations_report_what_they_did(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2), ("c", None)], "k string, v int")
    up = M.update_from(t, spark.createDataFrame([("a", 1), ("b", None), ("x", 9)], "k string, v int"), ["k"], ["v"])
    assert rows(up.table) == [("a", 1), ("b", None), ("c", None)]
    assert rows(up.delta) == [("a", "unchanged"), ("b", "updated")]
    gone = M.delete_keys(t, spark.createDataFrame([("a",), ("z",)], "k string"), ["k"])
    assert rows(gone.table, "k") == [("b",), ("c",)] and rows(gone.delta) == [("a", "deleted"), ("z", "missing")]
    layers = [spark.createDataFrame([(x,)], "identifier string") for x in "ab"]
    kept = M.delete_unlisted(t.withColumnRenamed("k", "identifier"), layers)
    assert rows(kept.table, "identifier") == [("a",), ("b",)]


def test_three_store_report(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "identifier string")
    rdf = spark.createDataFrame([("a", "B1"), ("a", "B2"), ("d", "B3"), ("e", "B4")], "identifier string, building string")
    out = RP.mismatch_kinds(RP.identifier_mismatches(ids("a", "b", "d"), ids("a", "c"), rdf))
    assert rows(out, "identifier", "building", "problem") == [
        ("b", None, "missing from production"), ("c", None, "extra in production"), ("d", "B3", "rdf only, in layer"), ("e", "B4", "rdf only")]
    prefixes = spark.createDataFrame([("SSP_BLDG",), ("SSC",)], "prefix string")
    found = ids("SSP_BLDG_1", "SSPXBLDG_2", "SSC_1", "OTHER")
    assert rows(RP.production_counts(found, prefixes, "startswith")) == [("SSC", 1), ("SSP_BLDG", 1)]
    assert rows(RP.production_counts(found, prefixes, "like")) == [("SSC", 1), ("SSP_BLDG", 2)]


# ---------------------------------------------------------------- geometry tables

def test_geometry_difference_limits(spark):
    def moved(dx, grow=0.0):
        return f"MULTIPOLYGON((({dx} 0,{100 + dx + grow} 0,{100 + dx + grow} 1,{dx} 1,{dx} 0)))"
    cases = {"same": moved(0), "0.05": moved(0.05), "0.2": moved(0.2), "area": moved(0, 2.5)}
    layer = spark.createDataFrame([("L", k, 3857, moved(0)) for k in cases], "layer string, identifier string, srid int, geometry string")
    feats = spark.createDataFrame(list(cases.items()), "identifier string, geometry string")
    diff = geo.geometry_diff(layer, feats)
    assert rows(diff, "identifier", "significant") == [("0.05", False), ("0.2", True), ("area", True)]
    assert rows(geo.diff_summary(diff)) == [(None, 3, 2, 1), ("L", 3, 2, 1)]


def test_srid_audit_and_slice(spark):
    df = spark.createDataFrame([("a", 3857), ("a", 3857), ("b", 0), ("b", 3857), ("c", 32633)], "layer string, srid int")
    declared = spark.createDataFrame([(x, 3857) for x in "abc"], "layer string, declared int")
    assert rows(geo.srid_audit(df, "layer", declared), "layer", "total", "verdict") == [("a", 2, "ok"), ("b", 2, "unset"), ("c", 1, "mismatch")]
    spans = spark.createDataFrame([("in", "1400-01-01", None, SQUARE), ("ended", "1400-01-01", "1500-01-01", SQUARE), ("later", "1501-01-01", None, SQUARE),
                                   ("far", "1400-01-01", None, "POLYGON((9 9,10 9,10 10,9 9))")], "identifier string, bob string, eoe string, geometry string")
    spans = geo.with_geometry(spans.withColumn("bob", F.col("bob").cast("date")).withColumn("eoe", F.col("eoe").cast("date")))
    assert rows(geo.temporal_spatial_slice(spans, (0, 0, 2, 2), "1500-01-01")) == [("in", SQUARE)]


# ---------------------------------------------------------------- graph basics

def _brute_closure(edges):
    nodes = {x for e in edges for x in e}
    out = {}
    for s in nodes:
        depth, front = 0, {s}
        seen = {s: 0}
        while front:
            depth += 1
            front = {o for a, o in edges if a in front} - set(seen)
            seen.update({o: depth for o in front})
        out.update({(s, o): d for o, d in seen.items()})
    return out


def test_closure_of_trees_dags_and_cycles(spark):
    cases = {
        "tree": [(f"n{i}", f"n{i // 2}") for i in range(1, 40)],
        "chain": [(f"c{i}", f"c{i + 1}") for i in range(13)],
        "dag": [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("a", "e")],
        "cycle": [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a")],
    }
    for name, edges in cases.items():
        df = spark.createDataFrame(edges, "s string, o string")
        want = _brute_closure(set(edges))
        assert {(r["s"], r["o"]): r["depth"] for r in R.closure(df).collect()} == want, name
        if name != "cycle":
            assert {(r["s"], r["o"]): r["depth"] for r in R.closure(df, acyclic=True).collect()} == want, name


def test_construct_skips_unbound_and_add_is_a_set_union(spark):
    b = spark.createDataFrame([("a", "x", None), ("a", "x", None), ("b", None, "it")], "s string, o string, lang string")
    t = R.construct(b, [R.term(F.col("s"), "p", F.col("o"), "literal", F.col("lang")), R.term(F.col("s"), "q", F.lit("c"))])
    assert rows(t, "s", "p", "o") == [("a", "p", "x"), ("a", "q", "c"), ("b", "q", "c")]
    assert R.add_triples(t, t).count() == 3
    assert rows(R.delete_triples(t, t.filter("p = 'q'"), ["q"]), "s", "p") == [("a", "p")]
    links = R.construct(spark.createDataFrame([("i", "n"), ("n", "z"), ("k", "l")], "s string, o string"), [R.term(F.col("s"), "p", F.col("o"))])
    assert rows(R.delete_nodes(links, spark.createDataFrame([("n",)], "node string")), "s") == [("k",)]


# ---------------------------------------------------------------- storage

def test_nquads_round_trip(spark, tmp_path):
    lines = spark.createDataFrame([
        ('<a> <p> <b> .',), ('<a> <p> "say \\"hi\\"\\nthere \\\\n" .',), ('<a> <p> "ciao"@it <g> .',), ("# comment",), ("",),
        ('_:x <p> "2001-01-01"^^<http://www.w3.org/2001/XMLSchema#date> .',), ("<a> <p> .",), ('<a> <p> "' + "x\\\"y " * 20000 + '" .',)], "value string")
    t = readers.parse_nquads(lines)
    small = t.filter(F.length("o") < 100)
    assert rows(small, "g", "s", "o", "o_type", "lang", "dtype") == rows(spark.createDataFrame([
        (None, "a", "b", "iri", None, None), (None, "a", 'say "hi"\nthere \\n', "literal", None, None), ("g", "a", "ciao", "literal", "it", None),
        (None, "_:x", "2001-01-01", "literal", None, "http://www.w3.org/2001/XMLSchema#date")], "g string, s string, o string, o_type string, lang string, dtype string"))
    assert t.count() == 5
    writers.write_nquads(t, str(tmp_path / "nq"))
    assert rows(readers.read_nquads(spark, str(tmp_path / "nq"))) == rows(t)
    writers.write_triples(t, str(tmp_path / "t"))
    assert rows(readers.read_triples(spark, str(tmp_path / "t"))) == rows(t)


def test_layer_folders_and_tab_files(spark, tmp_path):
    a = spark.createDataFrame([("A1", True, None, SQUARE)], "identifier string, Today boolean, `1694:dis.22` boolean, geometry string")
    b = spark.createDataFrame([("B1", False, "name", SQUARE)], "identifier string, Today boolean, name string, geometry string")
    a.write.parquet(str(tmp_path / "layers/qgis_north_open_spaces"))
    b.write.parquet(str(tmp_path / "layers/qgis_north_buildings"))
    long = readers.read_layers(spark, str(tmp_path / "layers"))
    assert rows(long, "site", "kind", "identifier", "source", "present") == [("north", "buildings", "B1", "Today", False), ("north", "openspaces", "A1", "Today", True)]
    assert readers.read_layers(spark, str(tmp_path / "layers"), sites=["south"]).count() == 0
    writers.write_layer_tsv(a, str(tmp_path / "tsv"))
    assert rows(readers.read_layer_tsv(spark, str(tmp_path / "tsv"))) == [("A1", True, None, SQUARE)]  # an empty flag is not 0
    union = readers.union_layers({("n", "buildings"): b, ("n", "islands"): a})
    assert union.count() == 3
    seed = readers.seed_layer_row(spark, "n", "islands", "A0", "SRID=32633;POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))", {"Today": True, "1982: Ortofoto": False})
    assert rows(seed, "srid", "geometry", "source", "present") == [(32633, SQUARE, "1982: Ortofoto", False), (32633, SQUARE, "Today", True)]
    assert D.structure_issues({"ok": a, "bad": a.drop("identifier")}) == ["bad"]


def test_snapshots_and_sinks(spark, tmp_path):
    root = str(tmp_path / "snap")
    one = spark.createDataFrame([("a", "inserted")], "k string, outcome string")
    v1 = snapshots.commit_snapshot(one, root)
    v2 = snapshots.commit_snapshot(one.union(one), root, batch_id=4)
    assert (v1, v2) == (1, 2)
    assert snapshots.read_snapshot(spark, root).count() == 2 and snapshots.read_snapshot(spark, root, 1).count() == 1
    assert snapshots.current_state(spark, root).batches == {None: 4}
    writers.write_outcomes(one, str(tmp_path / "out"))
    assert (tmp_path / "out" / "outcome=inserted").is_dir()
    assert rows(writers.materialise(one, "chronogeo_probe")) == [("a", "inserted")]
    assert "chronogeo_probe" in readers.list_layers(spark, "chronogeo_*")
    assert rows(P.table_columns({"t": one}), "column", "type") == [("k", "string"), ("outcome", "string")]
