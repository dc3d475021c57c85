"""Search terms kept up to date, property tables, tables in buckets of a key, nodes reached."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from chronogeo.operators import features as M
from chronogeo.operators import graph as R
from chronogeo.operators import properties as PR
from chronogeo.plans import stars
from chronogeo.plans import terms as S
from chronogeo.plans import upkeep as K
from chronogeo.schema import TRIPLES
from chronogeo.schema import VOCAB as V
from chronogeo.sources import writers
from tests.conftest import rows


def _graph(spark, triples):
    return spark.createDataFrame([(None, s, p, o, t, lang, None) for s, p, o, t, lang in triples], TRIPLES)


def _iri(s, p, o):
    return (s, p, o, "iri", None)


def _text(s, p, o, lang=None):
    return (s, p, o, "literal", lang)


def _set(df):
    return {tuple(r) for r in df.select(*R.TRIPLE_COLUMNS).collect()}


# ---------------------------------------------------------------- nodes reached

def test_reached_walks_cycles_and_starts_nowhere_from_null(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("c", None), (None, "z")], "s string, o string")
    start = spark.createDataFrame([("a",), ("a",), (None,), ("q",)], "node string")
    assert rows(R.reached(links, start)) == [("a",), ("b",), ("c",), ("q",)]
    assert rows(R.reached(links, start.limit(0))) == []
    assert rows(R.reached(links.limit(0), start)) == [("a",), ("q",)]


# ---------------------------------------------------------------- upkeep

def _events(rng, n):
    """Events with types, islands and years; some parts are missing, some are shared."""
    out = set()
    for t in ("t0", "t1", "t2"):
        out |= {_iri(t, V.c("P71i_is_listed_in"), V.event_types), _text(t, V.label, f"kind {t}", rng.choice(["it", "en"]))}
    for i in ("i0", "i1"):
        out |= {_iri(i, V.c("P1_is_identified_by"), i + "/n"), _iri(i + "/n", V.rdf_type, V.c("E41_Appellation")),
                _iri(i + "/n", V.c("P2_has_type"), V.kind("appellation")), _text(i + "/n", V.label, f"island {i}")}
    for k in range(n):
        e = f"e{k}"
        out.add(_iri(e, V.rdf_type, V.onto("Event")))
        if rng.random() < 0.8:
            out.add(_text(e, V.label, f"event {k}", rng.choice(["it", "en", None, "", "de"])))
        if rng.random() < 0.7:
            out.add(_iri(e, V.c("P2_has_type"), rng.choice(["t0", "t1", "t2"])))
        if rng.random() < 0.7:
            out.add(_iri(e, V.onto("has_island"), rng.choice(["i0", "i1"])))
        if rng.random() < 0.5:
            out |= {_iri(e, V.c("P4_has_time-span"), e + "/s"), _iri(e + "/s", V.c("P170i_time_is_defined_by"), e + "/y"),
                    _iri(e + "/y", V.rdf_type, V.c("E61_Time-Primitive")), _text(e + "/y", V.label, str(1900 + k)),
                    _iri(e + "/y", V.c("P2_has_type"), V.kind("time_primitive_year"))}
        if rng.random() < 0.1:
            out |= {_iri(e, V.c("P1_is_identified_by"), e + "/h"), _iri(e + "/h", V.rdf_type, V.c("E41_Appellation")),
                    _iri(e + "/h", V.c("P2_has_type"), V.kind("search_term")), _text(e + "/h", V.label, "by hand")}
    return sorted(out, key=str)


def _all_anew(before, after):
    """A run over all items: terms derived before or after the edit go, then every open item gets its own."""
    old = K.derived_terms(before).unionByName(K.derived_terms(after)).distinct()
    bare = R.delete_triples(after.withColumn("lang", F.nullif("lang", F.lit(""))), S.term_triples(old))
    return _set(bare) | _set(S.term_triples(S.search_terms(bare, "event")).withColumn("lang", F.nullif("lang", F.lit(""))))


def test_upkeep_equals_a_run_over_all_items(spark):
    rng = random.Random(1)
    base = _events(rng, 25)
    g = R.add_triples(_graph(spark, base), S.term_triples(S.search_terms(_graph(spark, base), "event")))
    stored = [tuple(r) for r in g.collect()]
    before = spark.createDataFrame(stored, TRIPLES)
    gone = rng.sample([t for t in stored if t[1] not in ("t0", "t1", "t2")], 8)
    others = _events(random.Random(11), 25)
    new = [(None, s, p, o, t, lang, None) for s, p, o, t, lang in rng.sample(others, 8)]
    new += [(None, "e99", V.rdf_type, V.onto("Event"), "iri", None, None), (None, "e99", V.label, "new one", "literal", "it", None)]
    inserted, deleted = spark.createDataFrame(new + new[:2], TRIPLES), spark.createDataFrame(gone, TRIPLES)
    up, after = K.refresh_terms(before, inserted, deleted, "event"), K.edit(before, inserted, deleted)
    assert _set(up.apply(after)) == _all_anew(before, after)
    touched = {s for _, s, *_ in new + gone}
    assert {r.node for r in up.looked_at.collect()} >= {s for s in touched if s in {t[1] for t in stored if t[2] == V.rdf_type and t[3] == V.onto("Event")}}


def test_upkeep_looks_only_at_items_that_lead_to_an_edit(spark):
    e = [_iri(f"e{k}", V.rdf_type, V.onto("Event")) for k in range(6)] + [_text(f"e{k}", V.label, f"l{k}", "it") for k in range(6)]
    e += [_iri(f"e{k}", V.onto("has_island"), f"i{k % 3}") for k in range(6)]
    e += [_iri(f"i{k}", V.c("P1_is_identified_by"), f"i{k}/n") for k in range(3)]
    before = _graph(spark, e)
    none = before.limit(0)
    up = K.refresh_terms(before, _graph(spark, [_text("i1/n", V.label, "x")]), none, "event")
    assert rows(up.looked_at) == [("e1",), ("e4",)]
    up = K.refresh_terms(before, none, none, "event")
    assert rows(up.looked_at) == [] and up.added.isEmpty() and up.removed.isEmpty()
    up = K.refresh_terms(none, before, none, "event")  # an empty graph: all items are new
    assert rows(up.looked_at) == [(f"e{k}",) for k in range(6)] and up.removed.isEmpty()


def test_edits_are_made_on_triples_of_touched_nodes_alone(spark, monkeypatch):
    graph = _graph(spark, _events(random.Random(5), 40)).cache()
    sizes, edit = [], K.edit

    def spied(triples, inserted, deleted):
        sizes.append(triples.count())
        return edit(triples, inserted, deleted)

    monkeypatch.setattr(K, "edit", spied)
    up = K.refresh_terms(graph, _graph(spark, [_text("e1", V.label, "other", "it")]), _graph(spark, []), "event")
    assert rows(up.looked_at) == [("e1",)]
    assert sizes and max(sizes) < graph.count() / 4


def test_triples_are_compared_by_their_hash_first(spark):
    """With NULL and '' apart, copies kept, and only asked predicates compared."""
    g = _graph(spark, [_text("a", "p", "1"), _text("a", "p", "1"), _text("a", "p", "1", ""), _text("b", "q", "2"), _iri("b", "q", "2")])
    gone = R.delete_triples(g, _graph(spark, [_text("a", "p", "1", ""), _iri("b", "q", "2")]))
    assert rows(gone, "s", "o_type", "lang") == [("a", "literal", None), ("a", "literal", None), ("b", "literal", None)]
    more = R.add_triples(g, _graph(spark, [_text("a", "p", "1"), _text("a", "p", "3"), _text("a", "p", "3")]), ["p"])
    assert more.count() == g.count() + 1
    assert "xxhash64" in gone._jdf.queryExecution().optimizedPlan().toString()


def _compared(monkeypatch):
    """Predicates of the triples that are joined with those to delete."""
    seen, delete = set(), R.delete_triples

    def spied(triples, *a):
        seen.update(r.p for r in triples.select("p").distinct().collect())
        return delete(triples, *a)

    monkeypatch.setattr(R, "delete_triples", spied)
    return seen


def test_edits_pass_other_predicates_as_they_lie(spark, monkeypatch):
    """As joins on whole triples give them, with copies, NULL and re-inserted triples."""
    g = _graph(spark, [_text("a", "p", "1"), _text("a", "p", "1"), _text("a", "q", "1"), _text("b", "q", "2", ""), _text("c", None, "3"),
                       _iri("d", "r", "e"), _text("f", "s", "x"), _text("f", "s", "x")])
    gone = _graph(spark, [_text("a", "p", "1"), _text("b", "q", "2"), _iri("d", "r", "e"), _text("n", "r", "n")])
    new = _graph(spark, [_iri("d", "r", "e"), _text("f", "s", "x"), _text("f", "s", "y"), _text("f", "s", "y"), _text("a", "z", None)])
    for extra in ([], [_text("c", None, "3")]):
        gone_ = gone.unionByName(_graph(spark, extra))
        wanted = rows(R.add_triples(R.delete_triples(g, gone_), new))
        for stored in (False, True):
            assert rows(K.edit(g, new, gone_, stored)) == wanted
    assert rows(K.edit(g, new.limit(0), gone.limit(0))) == rows(g)
    seen = _compared(monkeypatch)
    K.edit(g, new.filter("p = 'z'"), gone, stored=False)
    assert seen == {"p", "q", "r"}


def test_terms_are_put_in_among_triples_of_terms_alone(spark, monkeypatch):
    g = _graph(spark, [_iri("e", V.rdf_type, V.onto("Event")), _text("e", V.label, "new", "it"), _text("e", "other", "/search_term/")])
    gone = S.term_triples(S.search_terms(_graph(spark, [_iri("e", V.rdf_type, V.onto("Event")), _text("e", V.label, "old", "it")]), "event"))
    new = S.term_triples(S.search_terms(g, "event"))
    up = K.Upkeep(gone, new, g.limit(0), K.term_predicates())
    seen = _compared(monkeypatch)
    done = up.apply(g.unionByName(gone))
    assert seen == set(K.term_predicates())
    assert _set(done) == _set(g.unionByName(new)) == _set(up.apply(g.unionByName(gone), stored=True))
    assert rows(K.derived_terms(done), "label", "lang") == [("new", "it")]


def test_absent_rows(spark):
    g = _graph(spark, [_text("a", "p", "1"), _text("a", "p", "2", ""), _text(None, "p", None)])
    new = _graph(spark, [_text("a", "p", "1"), _text("a", "p", "2"), _text("b", "p", "1"), _text(None, "p", None)])
    assert rows(K.absent(new, g), "s", "o") == [("a", "2"), ("b", "1")]
    assert rows(K.absent(new, g.limit(0))) == rows(new)


# ---------------------------------------------------------------- frequent keys

def test_frequent_keys_are_looked_up(spark):
    links = spark.createDataFrame([(k, "hot") for k in range(20)] + [(20, "x"), (21, "x"), (22, None), (23, "none")], "item int, who string")
    facts = spark.createDataFrame([("hot", "h"), ("x", "y"), ("x", "z"), (None, "n"), ("unused", "u")], "who string, v string")
    for many in (1, 5, 100):
        assert rows(R.join_frequent(links, facts, "who", many), "item", "v") == rows(links.join(facts, "who"), "item", "v")
    assert rows(R.join_frequent(links.limit(0), facts, "who")) == []
    plan = R.join_frequent(links.filter("who = 'hot'"), facts, "who", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1  # all keys are frequent: one small table is left


def test_book_terms_with_frequent_keys(spark, monkeypatch):
    """One author list from all works, dates of typed events alone, as before with every key looked up."""
    lo, cr = V.c("E33_Linguistic_Object"), V.c("E65_Creation")
    t = [_iri("a1", V.rdf_type, V.c("E39_Actor")), _text("a1", V.label, "Zoe"), _text("a2", V.label, "Ann"), _text("pl", V.label, "Rome"),
         _iri("s", V.c("P1_is_identified_by"), "s/t"), _iri("s/t", V.c("P2_has_type"), V.kind("title")), _text("s/t", V.label, "Series"),
         _iri("s", V.onto("has_broader_typology"), "ty"), _text("ty", V.label, "Typ")]
    for b in ("b1", "b2", "b3"):
        t += [_iri(b, V.rdf_type, V.onto("Source_Secondary")), _iri(b, V.onto("has_broader"), "s"),
              _iri(b, V.c("P129i_is_subject_of"), b + "/w"), _iri(b + "/w", V.c("P94i_was_created_by"), b + "/c"),
              _iri(b + "/c", V.c("P14_carried_out_by"), "a1"), _iri(b + "/c", V.c("P14_carried_out_by"), "a2"), _iri(b + "/w", V.rdf_type, lo),
              _iri(b, V.frbroo + "R24i_was_created_through", b + "/p"), _iri(b + "/p", V.c("P7_took_place_at"), "pl"),
              _iri(b + "/p", V.c("P4_has_time-span"), b + "/s"), _text(b + "/s", V.c("P82a_begin_of_the_begin"), "1900")]
    t += [_iri("b1/c", V.rdf_type, cr), _iri("b2/c", V.rdf_type, cr), _iri("b2/p", V.rdf_type, V.frbroo + "F30_Publication_Event"),
          _iri("b2/s", V.rdf_type, V.c("E52_Time-Span"))]
    wanted = [("b1", "Ann, , Series, Rome, 1900 Zoe Typ"), ("b2", "Ann, , Series, Rome, 1900 Zoe Typ 1900"), ("b3", "Ann, , Series, Rome, 1900 Typ")]
    g = _graph(spark, t)
    assert rows(S.search_terms(g, "secondary_source"), "item", "label") == wanted
    assert rows(S.search_terms(PR.property_table(g, stars.term_predicates(), most=1), "secondary_source"), "item", "label") == wanted
    monkeypatch.setattr(R.join_frequent, "__defaults__", (1,))
    assert rows(S.search_terms(g, "secondary_source"), "item", "label") == wanted


# ---------------------------------------------------------------- property tables

def _random_triples(rng, n):
    nodes, preds = [f"n{i}" for i in range(8)], ["p", "q", "r"]
    out = [_iri(rng.choice(nodes), rng.choice(preds), f"o{rng.randrange(6)}") for _ in range(n)]
    return list(dict.fromkeys(out)) + [_text("n0", "p", "t", "it"), _text("n0", "p", "t", "en")]


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_star_equals_joins(spark, tmp_path, most):
    g = _graph(spark, _random_triples(random.Random(most), 45))
    odd = _graph(spark, [_iri(None, "p", "o1"), _iri("n1", "p", None), _iri("n1", None, "o1")])
    table = PR.property_table(g.unionByName(g.limit(5)).unionByName(odd), ["p", "q", "r"], most)
    PR.write_properties(table, str(tmp_path / "t"))
    table = PR.read_properties(spark, str(tmp_path / "t"))
    want = {"a": "p", "b": "q"}
    assert rows(PR.star(table, want)) == rows(R.pattern(g, want))
    assert rows(PR.star(table, want, "node", {"b"}), "node", "a", "b") == rows(R.pattern(g, want, "node", {"b"}), "node", "a", "b")
    typed = R.pattern(g, {"a": "p"}).join(R.instances(g, "r", ["o1", "o2"]), "s", "left_semi")
    assert rows(PR.star(table, {"a": "p"}, where={"r": ["o1", "o2"]})) == rows(typed)
    bare = R.pattern(g, {"a": "p"}).join(R.edges(g, "q").select("s"), "s", "left_anti")
    assert rows(PR.star(table, {"a": "p"}, absent=["q"])) == rows(bare)
    assert rows(PR.labels_of(table, "p")) == rows(R.literals(g, "p"))


def test_star_names_may_clash_and_unknown_predicates_are_refused(spark):
    g = _graph(spark, [_iri("a", "p", "b"), _iri("a", "q", "c")])
    table = PR.property_table(g, ["p", "q"])
    assert rows(PR.star(table, {"v1": "p", "v0": "q"}), "s", "v1", "v0") == [("a", "b", "c")]
    with pytest.raises(ValueError, match="not in the property table"):
        PR.star(table, {"x": "z"})
    assert rows(PR.star(PR.property_table(g.limit(0), ["p"]), {"a": "p"})) == []


# ---------------------------------------------------------------- tables in buckets

def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keyed_tables_are_joined_as_they_lie(spark, tmp_path):
    old = spark.range(2000).select(F.col("id").cast("string").alias("identifier"), F.lit("old").alias("name"))
    rows_ = spark.range(1500, 2500).select(F.col("id").cast("string").alias("identifier"), F.lit("new").alias("name"))
    name = f"keyed_{uuid.uuid4().hex}"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = writers.write_keyed(old, name, "identifier", 8, str(tmp_path / "t"))
        links = writers.write_keyed(rows_, name + "_links", "identifier", 8, str(tmp_path / "l"))
        kept = M.delete_orphans(links, target, "identifier")
        assert "Exchange" not in _plan(kept.table) and kept.table.count() == 500
        change = M.insert_missing(target, rows_, ["identifier"])
        plan = _plan(change.parts[1])
        assert change.table.count() == 2500
        assert plan.count("Exchange hashpartitioning") == 1, plan  # the incoming rows alone
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP TABLE IF EXISTS {name}_links")


# ---------------------------------------------------------------- search terms from a property table

@pytest.mark.parametrize("most", [1, 1000])
def test_terms_of_a_property_table_equal_those_of_triples(spark, tmp_path, most):
    """Odd graphs: nodes without kind, class or label, repeated triples, several names, languages, years and types."""
    rng = random.Random(most)
    pick = lambda name, n: f"x:{name}/{rng.randrange(n)}"
    triples = [_iri("x:type/0", V.c("P71i_is_listed_in"), V.event_types), _iri("x:type/1", V.c("P71i_is_listed_in"), V.event_types)]
    for i in range(12):
        triples += [_iri(f"x:item/{i}", V.rdf_type, V.onto(S.CLASSES[k])) for k in ("event", "group", "person", "secondary_source", "primary_source") if rng.random() < .6]
        triples += [_text(f"x:item/{i}", V.label, f"l{i}", lang) for lang in (None, "it", "en", "de") if rng.random() < .4]
    for i in range(30):
        triples += [_iri(pick("item", 12), V.c("P1_is_identified_by"), f"x:name/{i}"), _text(f"x:name/{i}", V.label, f"n{i % 7}")][: rng.choice([1, 2, 2])]
        triples += [_iri(f"x:name/{i}", V.c("P2_has_type"), V.kind(rng.choice([*S.NAME_KINDS, "patronymic", "title", "attributed_title", "acronym"])))] * rng.choice([0, 1, 2])
        triples += [_iri(f"x:name/{i}", V.rdf_type, V.c("E41_Appellation"))] * rng.choice([0, 1])
        triples += [_iri(pick("item", 12), V.c(p), pick("ev", 8)) for p in ("P98i_was_born", "P100i_died_in", "P95i_was_formed_by", "P108i_was_produced_by") if rng.random() < .4]
        triples += [_iri(pick("item", 12), V.onto(rng.choice(["has_island", "has_broader"])), pick("item", 12)), _iri(pick("item", 12), V.c("P2_has_type"), pick("type", 3)),
                    _iri(pick("item", 12), V.c("P53_has_former_or_current_location"), pick("item", 12)), _iri(pick("item", 12), V.c("P4_has_time-span"), pick("span", 6))]
    for i in range(8):
        triples += [_iri(f"x:ev/{i}", V.rdf_type, V.c(cls)) for cls in ("E67_Birth", "E69_Death", "E66_Formation", "E12_Production") if rng.random() < .7]
        triples += [_iri(f"x:ev/{i}", V.c("P4_has_time-span"), pick("span", 6)), _iri(pick("span", 6), V.c("P170i_time_is_defined_by"), pick("prim", 5))]
    for i in range(5):
        triples += [_iri(f"x:prim/{i}", V.rdf_type, V.c("E61_Time-Primitive")), _iri(f"x:prim/{i}", V.c("P2_has_type"), V.kind("time_primitive_year")), _text(f"x:prim/{i}", V.label, str(1900 + i))][rng.choice([0, 0, 1]):]
        triples += [_text(f"x:type/{i}", V.label, f"t{i}", lang) for lang in ("it", "en")]
    done = [_iri("x:item/0", V.c("P1_is_identified_by"), "x:done"), _iri("x:done", V.c("P2_has_type"), V.kind("search_term")), _iri("x:done", V.rdf_type, V.c("E41_Appellation"))]
    g = _graph(spark, triples + done)
    PR.write_properties(PR.property_table(g, stars.term_predicates(), most), str(tmp_path / "p"))
    table = PR.read_properties(spark, str(tmp_path / "p"))
    assert table.has_hubs == (most == 1)
    for kind in S.CLASSES:
        want = rows(S.search_terms(g, kind).select("item", "node", "label", "lang"))
        assert rows(S.search_terms(table, kind).select("item", "node", "label", "lang")) == want
        assert want and not any(r[0] == "x:item/0" for r in want) or kind == "primary_source"
    if most > 1:
        joins = [S.group_terms(x)._jdf.queryExecution().optimizedPlan().toString().count("Join ") for x in (g, table)]
        assert 3 * joins[1] <= 2 * joins[0], joins


def test_a_table_without_a_needed_predicate_is_refused(spark):
    table = PR.property_table(_graph(spark, [_iri("x:a", V.rdf_type, V.onto("Group"))]), [V.rdf_type])
    with pytest.raises(ValueError):
        S.search_terms(table, "group")
