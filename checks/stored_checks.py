"""Queries for stored forms: search terms kept up to date, property tables, tables in buckets of their key."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import views as v
from checks.graph_checks import _BOOK, _EV, _named
from checks.registry import ORACLE, check
from checks.stream_checks import _folder
from checks.views import c, table, with_views
from chronogeo.operators import features as M
from chronogeo.operators import properties as PR
from chronogeo.plans import stars
from chronogeo.plans import terms as S
from chronogeo.plans import upkeep as K
from chronogeo.schema import VOCAB as V
from chronogeo.sources import writers

# ---------------------------------------------------------------- upkeep of search terms


def event_term_triples(spark, sf):
    return S.term_triples(S.search_terms(v.stored(spark, sf, v.event_graph), "event"))


def book_term_triples(spark, sf):
    return S.term_triples(S.search_terms(v.stored(spark, sf, v.book_graph), "secondary_source"))


def events_with_terms(spark, sf):
    """Both parts are stored, so the graph is not written a second time with its terms."""
    return v.stored(spark, sf, v.event_graph).unionByName(v.stored(spark, sf, event_term_triples))


def books_with_terms(spark, sf):
    return v.stored(spark, sf, v.book_graph).unionByName(v.stored(spark, sf, book_term_triples))


def _event_edit(spark, sf):
    """Some labels and a type get other names, some events lose their class, others a term made by hand."""
    e = table(spark, sf, "events")
    item = v.txt("x:event/", c("event_id"))
    renamed, closed, known = e.filter("value >= 60 AND value < 70"), e.filter("value > 95"), e.filter("value >= 30 AND value < 31")
    kind = e.filter("event_type = 'error'").select("event_type").distinct()
    iri = v.txt("x:etype/", c("event_type"))
    gone = [v._t(renamed, item, V.label, c("event_type"), True, "it"), v._t(closed, item, V.rdf_type, F.lit(V.onto("Event"))),
            v._t(kind, iri, V.label, v.txt("tipo ", c("event_type")), True, "it")]
    new = [v._t(renamed, item, V.label, v.txt("n-", c("event_type")), True, "it"), v._t(kind, iri, V.label, F.lit("guasto"), True, "it")]
    return v._all(new + v._app(known, item, "hand", ["search_term"], F.lit("by hand"))), v._all(gone)


def _current_terms(up, before, new, gone):
    """Derived terms of the edited graph; it and the graph with current terms are stored where they differ from the graph before."""
    return K.derived_terms(up.apply(K.edit(before, new, gone), stored=True))


_EV_AFTER = (_EV.replace("'it' AS lang, event_type AS label", "'it' AS lang, CASE WHEN value >= 60 AND value < 70 THEN 'n-' ELSE '' END || event_type AS label")
             .replace("unnest(['tipo ', 'type ']) || event_type AS typ",
                      "unnest([CASE WHEN event_type = 'error' THEN 'guasto' ELSE 'tipo ' || event_type END, 'type ' || event_type]) AS typ")
             .replace("WHERE event_type <> 'purchase'", "WHERE event_type <> 'purchase' AND value <= 95 AND NOT (value >= 30 AND value < 31)"))


@check(_named(_EV_AFTER, "lang"))
def upkeep_event_terms(spark, sf):
    """All derived terms of the edited graph, of which only those of touched events were derived anew."""
    before = events_with_terms(spark, sf)
    new, gone = _event_edit(spark, sf)
    return _current_terms(K.refresh_terms(before, new, gone, "event"), before, new, gone)


@check("SELECT 'x:event/' || event_id AS node FROM events WHERE (value >= 60 AND value < 70) OR value > 95 OR (value >= 30 AND value < 31) OR (event_type = 'error' AND value < 80)")
def upkeep_looked_at(spark, sf):
    """Events that were touched: edited themselves, or of the type that has another name."""
    return K.refresh_terms(events_with_terms(spark, sf), *_event_edit(spark, sf), "event").looked_at


_BOOK_AFTER = _BOOK.replace("s_name FROM lineitem", "CASE WHEN s_acctbal < 0 THEN 'New ' ELSE '' END || s_name AS s_name FROM lineitem")


@check(_named(_BOOK_AFTER))
def upkeep_book_terms(spark, sf):
    """Suppliers in debt get another name, which reaches the books they wrote over work and creation."""
    before = books_with_terms(spark, sf)
    s = table(spark, sf, "supplier").filter("s_acctbal < 0")
    item = v.txt("x:sup/", c("s_suppkey"))
    new, gone = v._t(s, item, V.label, v.txt("New ", c("s_name")), True), v._t(s, item, V.label, c("s_name"), True)
    return _current_terms(K.refresh_terms(before, new, gone, "secondary_source"), before, new, gone)


# ---------------------------------------------------------------- property tables

_BOOK_PREDICATES = [V.rdf_type, V.label, V.onto("has_broader"), V.onto("has_broader_typology"), V.frbroo + "R24i_was_created_through",
                    V.c("P1_is_identified_by"), V.c("P4_has_time-span"), V.c("P7_took_place_at"), V.c("P01i_is_domain_of")]


def _book_properties(spark, sf, most=PR.MOST_VALUES):
    path = _folder(spark)
    PR.write_properties(PR.property_table(v.stored(spark, sf, v.book_graph), _BOOK_PREDICATES, most), path)
    return PR.read_properties(spark, path)


@check("""SELECT 'x:book/' || o_orderkey AS book, 'x:book/' || o_orderkey || '/title' AS title, CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'x:series/' || o_orderstatus END AS series,
 CASE WHEN o_orderpriority <> '5-LOW' THEN 'x:book/' || o_orderkey || '/pub' END AS event FROM orders""")
def property_star(spark, sf):
    """Books with their title, series and publication, from one row each."""
    return PR.star(_book_properties(spark, sf), {"title": V.c("P1_is_identified_by"), "series": V.onto("has_broader"), "event": V.frbroo + "R24i_was_created_through"},
                   "book", {"series", "event"}, where={V.rdf_type: [V.onto("Source_Secondary")]})


@check("""SELECT 'x:book/' || o_orderkey || '/pub' AS event, 'x:place/' || o_orderstatus AS place, 'x:book/' || o_orderkey || '/pub/' || t AS part
 FROM orders, (VALUES ('cur'), ('publisher')) k(t) WHERE o_orderpriority <> '5-LOW' AND o_orderstatus = 'P' AND t = 'publisher'""")
def property_absent(spark, sf):
    """Publications without a time span: place and every part."""
    return PR.star(_book_properties(spark, sf), {"place": V.c("P7_took_place_at"), "part": V.c("P01i_is_domain_of")}, "event",
                   where={V.rdf_type: [V.frbroo + "F30_Publication_Event"]}, absent=[V.c("P4_has_time-span")])


@check("""SELECT 'x:nation/' || n_nationkey AS nation, n_name AS label, 'x:cust/' || c_custkey AS customer FROM nation JOIN customer ON c_nationkey = n_nationkey
 UNION ALL SELECT 'x:nation/' || n_nationkey, n_name, 'x:sup/' || s_suppkey FROM nation JOIN supplier ON s_nationkey = n_nationkey""")
def property_hubs(spark, sf):
    """Nations list their customers and suppliers; those with over fifty stay triples."""
    n, cu, s = (table(spark, sf, t) for t in ("nation", "customer", "supplier"))
    lists = "x:lists"
    g = v._all([v._t(n, v.txt("x:nation/", c("n_nationkey")), V.label, c("n_name"), True),
                v._t(cu, v.txt("x:nation/", c("c_nationkey")), lists, v.txt("x:cust/", c("c_custkey"))),
                v._t(s, v.txt("x:nation/", c("s_nationkey")), lists, v.txt("x:sup/", c("s_suppkey")))])
    return PR.star(PR.property_table(g, [V.label, lists], most=50), {"label": V.label, "customer": lists}, "nation")


# ---------------------------------------------------------------- search terms from a property table


def _star_terms(spark, sf, view, kind, most=PR.MOST_VALUES):
    """The property table is stored first, as a user keeps it."""
    path = _folder(spark)
    PR.write_properties(PR.property_table(v.stored(spark, sf, view), stars.term_predicates(), most), path)
    return S.search_terms(PR.read_properties(spark, path), kind).select("item", "node", "label", "lang")


@check(ORACLE["search_terms_event"])
def star_terms_event(spark, sf):
    return _star_terms(spark, sf, v.event_graph, "event")


@check(ORACLE["search_terms_group"])
def star_terms_group(spark, sf):
    return _star_terms(spark, sf, v.group_graph, "group")


@check(ORACLE["search_terms_person"])
def star_terms_person(spark, sf):
    return _star_terms(spark, sf, v.person_graph, "person")


@check(ORACLE["search_terms_primary_source"])
def star_terms_primary_source(spark, sf):
    return _star_terms(spark, sf, v.source_graph, "primary_source")


@check(ORACLE["search_terms_secondary_source"])
def star_terms_secondary_source(spark, sf):
    return _star_terms(spark, sf, v.book_graph, "secondary_source")


@check(ORACLE["search_terms_person"])
def star_terms_hubs(spark, sf):
    """With one value per predicate allowed in a row, every person with two names stays triples."""
    return _star_terms(spark, sf, v.person_graph, "person", most=1)


# ---------------------------------------------------------------- tables in buckets

def _keyed(spark, df, key):
    name = f"keyed_{uuid.uuid4().hex}"
    return writers.write_keyed(df, name, key, 8, _folder(spark))


@check("""SELECT c_custkey AS k, c_mktsegment AS a FROM customer WHERE c_acctbal >= 0 UNION ALL
 SELECT o_custkey, min(o_orderpriority) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""")
def insert_into_keyed(spark, sf):
    """insert_ignore on a stored table in buckets of its key."""
    target = table(spark, sf, "customer").filter("c_acctbal >= 0").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("a"))
    rows = table(spark, sf, "orders").select(c("o_custkey").alias("k"), c("o_orderpriority").alias("a"))
    return M.insert_missing(_keyed(spark, target, "k"), rows, ["k"]).table


@check(with_views("published", "published_sources") + """ SELECT identifier, source, 'deleted' AS outcome FROM published_sources WHERE identifier NOT IN (SELECT identifier FROM published)
 UNION ALL SELECT identifier, source, 'kept' FROM published_sources WHERE identifier IN (SELECT identifier FROM published)""")
def orphans_of_keyed(spark, sf):
    """Features and their links, both in buckets of the identifier: neither is shuffled to find the orphans."""
    features = _keyed(spark, v.published(spark, sf), "identifier")
    links = _keyed(spark, v.published_sources(spark, sf), "identifier")
    done = M.delete_orphans(links, features, "identifier")
    return done.delta.select("identifier", "source", "outcome").unionByName(done.table.select("identifier", "source").withColumn("outcome", F.lit("kept")))
