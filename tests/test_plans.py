from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - fills the registry
from checks import registry
from checks.run import compare
from chronogeo import schema
from chronogeo.operators import graph as R
from chronogeo.plans import archive as A
from chronogeo.plans import buildings as B
from chronogeo.plans import provenance as PV
from chronogeo.plans import terms as S
from chronogeo.schema import VOCAB as V
from chronogeo.session import cut
from chronogeo.sources import snapshots
from chronogeo.streaming import propagate as K
from tests.conftest import rows

APP, TYPE, LABEL, P1 = V.c("E41_Appellation"), V.c("P2_has_type"), V.label, V.c("P1_is_identified_by")


def graph(spark, *facts):
    """facts: (s, p, o) for IRIs, (s, p, o, lang) for literals."""
    data = [(None, f[0], f[1], f[2], "literal" if len(f) > 3 else "iri", f[3] if len(f) > 3 else None, None) for f in facts]
    return cut(spark.createDataFrame(data, schema.TRIPLES))


def app(item, tail, kind, label, lang=None, typed=True):
    node = f"{item}/{tail}"
    out = [(item, P1, node), (node, TYPE, V.kind(kind)), (node, LABEL, label, lang)]
    return out + ([(node, V.rdf_type, APP)] if typed else [])


# ---------------------------------------------------------------- search terms

def test_event_terms_by_language(spark):
    ev = V.onto("Event")
    g = graph(
        spark, ("e1", V.rdf_type, ev), ("e1", LABEL, "Festa", "it"), ("e1", LABEL, "Feast", "en"), ("e1", LABEL, "Fest", "de"),
        ("e1", TYPE, "t1"), ("t1", V.c("P71i_is_listed_in"), V.event_types), ("t1", LABEL, "rito", "it"),
        ("e2", V.rdf_type, ev), ("e2", TYPE, "t1"), ("e3", V.rdf_type, ev), ("e4", V.rdf_type, ev), *app("e4", "st", "search_term", "old"),
        ("e5", V.rdf_type, ev), ("e5", LABEL, "plain", None))
    assert rows(S.search_terms(g, "event"), "item", "label", "lang") == [
        ("e1", "Feast", "en"), ("e1", "Festa rito", "it"), ("e2", " rito", "it"), ("e3", None, None), ("e5", "plain", "")]
    t = S.term_triples(S.search_terms(g, "event"))
    # a term without a language has no label triple, the rest of its node is there
    assert t.filter(F.col("s").startswith("e3/")).count() == 2


def test_person_terms_multiply_and_dates_follow_births(spark):
    p = V.onto("Person")

    def life(item, link, cls, year):
        n = f"{item}/{cls}"
        return [(item, V.c(link), n), (n, V.rdf_type, V.c(cls)), (n, V.c("P4_has_time-span"), n + "/s"), (n + "/s", V.c("P170i_time_is_defined_by"), n + "/p"),
                (n + "/p", V.rdf_type, V.c("E61_Time-Primitive")), (n + "/p", TYPE, V.kind("time_primitive_year")), (n + "/p", LABEL, year, None)]

    people = [
        ("a", V.rdf_type, p), *app("a", "g", "given_name", "Ann"), *app("a", "f", "family_name", "Bo"), *app("a", "x", "alias", "Al1"), *app("a", "y", "alias", "Al2"),
        *life("a", "P98i_was_born", "E67_Birth", "1900"), *life("a", "P100i_died_in", "E69_Death", "1950"),
        ("b", V.rdf_type, p), *app("b", "g", "given_name", "Cy"), *life("b", "P100i_died_in", "E69_Death", "1960")]
    g = graph(spark, *people)
    assert rows(S.person_terms(g), "item", "label") == [("a", "Al1 (Bo, Ann) Al1 1900 - 1950"), ("a", "Al2 (Bo, Ann) Al1 1900 - 1950"), ("b", "Cy")]
    assert rows(S.person_terms(g, include_death_only=True).filter("item = 'b'"), "label") == [("Cy  - 1960",)]
    no_birth = graph(spark, *[f for f in people if "P98i" not in f[1]])
    assert rows(S.person_terms(no_birth).filter("item = 'b'"), "label") == [("Cy",)]  # what others are like changes nothing
    assert rows(S.person_terms(no_birth, include_death_only=True).filter("item = 'b'"), "label") == [("Cy  - 1960",)]


def test_terms_are_idempotent_and_clean_up(spark):
    g = graph(spark, ("g1", V.rdf_type, V.onto("Group")), *app("g1", "n", "appellation", "Monks", typed=False), ("g2", V.rdf_type, V.onto("Group")))
    terms = S.search_terms(g, "group")
    assert rows(terms, "item", "label") == [("g1", "Monks"), ("g2", "")]
    full = cut(R.add_triples(g, S.term_triples(terms)))
    assert S.open_items(full, "group").count() == 0 and full.count() == g.count() + 8
    assert rows(S.clean_search_terms(full, "group"), "s", "p", "o") == rows(g, "s", "p", "o")
    left, report = S.clean_term_nodes(full, "group")
    assert rows(left, "s", "p", "o") == rows(g, "s", "p", "o") and rows(report) == [("g1", 1, 4), ("g2", 1, 4)]
    assert S.clean_search_terms(full, "person").count() == full.count()


def test_primary_source_path_stops_after_seven_parents(spark):
    src = V.onto("Source_Primary")
    chain = [(f"n{i}", V.c("P46i_forms_part_of"), f"n{i + 1}") for i in range(9)]
    names = [(f"n{i}", LABEL, f"L{i}", "it") for i in range(10) if i != 3]
    g = graph(
        spark, ("s", V.rdf_type, src), *app("s", "t1", "attributed_title", "Map"), *app("s", "t2", "attributed_title", "Mappa"),
        ("s", V.c("P53_has_former_or_current_location"), "s/loc"), ("s/loc", V.c("P53_has_former_or_current_location"), "n0"), *chain, *names,
        ("untitled", V.rdf_type, src))
    path = "L7, L6, L5, L4, L2, L1, L0"
    assert rows(S.primary_source_terms(g), "label") == [(f"Map {path}",), (f"Mappa {path}",)]


def test_secondary_source_separators(spark):
    c = V.onto("Source_Secondary")
    def book(i, authors=(), typ=None, date=None):
        out = [(i, V.rdf_type, c), *app(i, "t", "title", f"T{i}", typed=False)]
        for a in authors:
            w = f"{i}/w{a}"
            out += [(i, V.c("P129i_is_subject_of"), w), (w, V.rdf_type, V.c("E33_Linguistic_Object")), (w, V.c("P94i_was_created_by"), w + "/c"),
                    (w + "/c", V.rdf_type, V.c("E65_Creation")), (w + "/c", V.c("P14_carried_out_by"), a), (a, V.rdf_type, V.c("E39_Actor")), (a, LABEL, a, None)]
        if typ:
            out += [(i, V.onto("has_broader"), f"{i}/b"), (f"{i}/b", V.onto("has_broader_typology"), f"{i}/ty"), (f"{i}/ty", LABEL, typ, None)]
        if date:
            out += [(i, V.frbroo + "R24i_was_created_through", f"{i}/p"), (f"{i}/p", V.rdf_type, V.frbroo + "F30_Publication_Event"), (f"{i}/p", V.c("P4_has_time-span"), f"{i}/s"),
                    (f"{i}/s", V.rdf_type, V.c("E52_Time-Span")), (f"{i}/s", V.c("P82a_begin_of_the_begin"), date, None)]
        return out
    g = graph(spark, *book("1"), *book("2", ["B", "A"]), *book("3", [], "Atlas"), *book("4", ["A"], "Atlas", "1900"), *book("5", [], None, "1901"))
    assert rows(S.secondary_source_terms(g), "item", "label") == [
        ("1", "T1"), ("2", "A, T2 A, B"), ("3", "T3 Atlas"), ("4", "A, T4, 1900 A Atlas 1900"), ("5", "T5, 1901 1901")]


# ---------------------------------------------------------------- archive

def _archive(*nodes):
    out = []
    for n in nodes:
        out += [(n, V.rdf_type, V.c("E78_Collection")), (n, V.c("P71i_is_listed_in"), V.archives_vocab)]
    return out


def test_archive_paths_with_two_parents_and_a_cycle(spark):
    up = V.c("P46i_forms_part_of")
    g = graph(
        spark, *_archive("r/root", "r/a", "r/b", "r/c", "r/x", "r/y"), ("r/root", LABEL, "Root en", "en"), ("r/root", LABEL, "Radice", "it"),
        ("r/a", up, "r/root"), *app("r/a", "acr", "acronym", "AA"), ("r/a", LABEL, "Lungo", "it"), ("r/b", up, "r/root"), ("r/b", LABEL, "Bi", "it-IT"),
        ("r/c", up, "r/a"), ("r/c", up, "r/b"), ("r/x", up, "r/y"), ("r/y", up, "r/x"))
    got = A.archive_paths(g)
    assert rows(got) == [("r/a", "Radice, AA"), ("r/b", "Radice, Bi"), ("r/c", "Radice, AA, c"), ("r/c", "Radice, Bi, c"), ("r/root", "Radice")]
    full = cut(R.add_triples(g, A.path_triples(got)))
    assert A.archive_paths(full).count() == 0


def test_full_path_orders_from_the_root(spark):
    up = V.c("P46i_forms_part_of")
    g = graph(
        spark, ("leaf", up, "mid"), ("mid", up, "top"), ("leaf", LABEL, "foglio", "it"), ("mid", LABEL, "serie", "it"), ("top", LABEL, "Archivio", "it"),
        *app("top", "acr", "acronym", "ASV"), ("m", LABEL, "busta", "it"), ("m", LABEL, "box", "en"), ("mt", LABEL, "12", None))
    items = spark.createDataFrame([("leaf", "m", "mt")], "s string, medium string, medium_title string")
    assert rows(A.full_path(g, items)) == [("leaf", "ASV, serie, foglio, busta 12")]


# ---------------------------------------------------------------- provenance

def test_records_and_events(spark):
    src = V.onto("Source_Primary")
    facts = [(None, s, V.rdf_type, src, "iri", None, None) for s in ("s1", "s2")]
    for e, at, who in (("e1", "2024-01-02", "u1"), ("e2", "2024-01-01", "u1"), ("e3", "2024-01-01", "u2")):
        gname = "s1/container/context"
        facts += [(gname, e, V.rdf_type, V.prov + "Entity", "iri", None, None), (gname, e, V.prov + "generatedAtTime", at, "literal", None, None),
                  (gname, e, V.prov + "wasAttributedTo", who, "iri", None, None)]
    g = cut(spark.createDataFrame(facts, schema.TRIPLES))
    records = PV.form_records(g)
    assert rows(records) == [("s1", "s1/entity_form_record")]
    assert PV.modification_events(g).count() == 0
    g = cut(R.add_triples(g, PV.record_triples(records)))
    assert PV.form_records(g).count() == 0
    mods, made = PV.modification_events(g), PV.creation_events(g)
    assert rows(mods, "entity", "actor", "at") == [("e1", "u1", "2024-01-02"), ("e2", "u1", "2024-01-01"), ("e3", "u2", "2024-01-01")]
    assert rows(made, "actor", "at") == [("u1", "2024-01-01"), ("u2", "2024-01-01")]
    g = cut(R.add_triples(g, PV.event_triples(mods, "modification").unionByName(PV.event_triples(made, "creation"))))
    assert PV.modification_events(g).count() == 0 and PV.creation_events(g).count() == 0
    assert [r["at"] for r in PV.verify_events(g).collect()] == ["2024-01-02"] + ["2024-01-01"] * 4


def test_existing_buildings_are_skipped(spark):
    layer = spark.createDataFrame([("s", "buildings", i, "n", 3857, "G", "Today", True) for i in ("A_1", "A_2.1", "A_2")], schema.LAYER_LONG)
    g = graph(spark, ("i", V.rdf_type, V.onto("Island")), ("i", LABEL, "s", None), ("b", P1, "b/id"), ("b/id", V.value, "A_1", None))
    years = schema.source_years_seed(spark)
    outcomes, new = B.create_buildings(layer, years, g)
    assert rows(outcomes, "base_id", "outcome") == [("A_1", "skipped"), ("A_2", "inserted")]
    assert new.count() == 8 + 16 + 1
    again, none = B.create_buildings(layer, years, cut(R.add_triples(g, new)))
    assert rows(again, "outcome") == [("skipped",), ("skipped",)] and none.count() == 0
    lost, _ = B.create_buildings(layer, years, graph(spark, ("b", P1, "b/id")))
    assert rows(lost, "outcome") == [("error",), ("error",)]
    dry, _ = B.create_buildings(layer, years, g, dry_run=True)
    assert rows(dry, "outcome") == [("inserted",), ("inserted",)]


# ---------------------------------------------------------------- change propagation

def _changes(spark, data):
    return spark.createDataFrame([(o, n, "islands", k, name, geom, flags) for o, n, k, name, geom, flags in data], schema.CHANGES)


def _replay(start, links, data, cascade=False):
    feats, links, out = dict(start), set(links), {}
    for op, seq, k, name, geom, flags in sorted(data, key=lambda r: r[1]):
        if op == "I":
            out[(k, seq)] = "rejected" if k in feats else "applied"
            if k not in feats:
                feats[k] = (name, geom)
                links |= {(k, s) for s, on in (flags or {}).items() if on}
        elif op == "U":
            out[(k, seq)] = "applied" if k in feats else "noop"
            if k in feats:
                feats[k] = (feats[k][0], geom)
        else:
            out[(k, seq)] = "applied" if k in feats else "noop"
            feats.pop(k, None)
            if cascade:
                links = {x for x in links if x[0] != k}
    return feats, links, out


def _random_edits(n, seed):
    import random
    rnd = random.Random(seed)
    return [(rnd.choice("IIUUD"), i, "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(12)}", f"n{i}", f"g{i}", {"Today": rnd.random() < 0.5, "1982": rnd.random() < 0.5}) for i in range(n)]


@pytest.mark.parametrize("cascade", [False, True])
def test_folded_edits_equal_a_replay(spark, cascade):
    data = _random_edits(300, 7)
    start = {"k1": ("old", "g-old"), "hot": ("old", "g-old")}
    feats = spark.createDataFrame([(k, "Island", 0, n, g) for k, (n, g) in start.items()], schema.FEATURES)
    links = spark.createDataFrame([("k1", "Today"), ("hot", "x")], schema.FEATURE_SOURCES)
    want = _replay(start, {("k1", "Today"), ("hot", "x")}, data, cascade)
    f, l, o = K.apply_changes(feats, links, _changes(spark, data), cascade)
    assert {r["identifier"]: (r["name"], r["geometry"]) for r in f.collect()} == want[0]
    assert {tuple(r) for r in l.collect()} == want[1]
    assert {(r["identifier"], r["seq"]): r["outcome"] for r in o.collect()} == want[2]


def test_stream_equals_batch_and_repeated_batches_do_nothing(spark, tmp_path):
    data = _random_edits(120, 3)
    feats, links = spark.createDataFrame([], schema.FEATURES), spark.createDataFrame([], schema.FEATURE_SOURCES)
    root, feed = str(tmp_path / "tables"), str(tmp_path / "feed")
    K.init_tables(feats, links, root, buckets=4)
    for part in (data[:60], data[60:]):
        _changes(spark, part).coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(schema.CHANGES).option("maxFilesPerTrigger", 1).parquet(feed)
    K.start_propagation(stream, root, str(tmp_path / "ckpt"), buckets=4).awaitTermination()
    want = _replay({}, set(), data)

    def state():
        f, l = K.read_tables(spark, root)
        return {r["identifier"]: (r["name"], r["geometry"]) for r in f.collect()}, {(r["identifier"], r["source"]) for r in l.collect()}

    assert state() == want[:2]
    version = snapshots.current_state(spark, root).version
    K.propagate_batch(_changes(spark, data[60:]), 1, root, buckets=4, query=str(tmp_path / "ckpt"))
    assert snapshots.current_state(spark, root).version == version and state() == want[:2]


# ---------------------------------------------------------------- against SQL

@pytest.mark.parametrize("name", [
    "presence_flags", "fill_identifier", "parse_years_before_colon", "publish_sources_first", "phase_intervals", "sync_diagnosis",
    "polygon_measures", "mercator", "best_labels", "creation_events", "layer_folders"])
def test_queries_match_sql(spark, name):
    assert compare(spark, "/root/testdata/sf0.001", name, registry.QUERIES[name], registry.ORACLE[name]).startswith("ok")


def test_every_query_has_sql():
    from checks import registry
    import __spark_entry__ as entry

    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLE) <= set(entry.oracle_sql())
