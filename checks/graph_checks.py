"""Search terms, archive paths, provenance and triple operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import check
from checks.views import c, table, with_views
from chronogeo.operators import graph as G
from chronogeo.plans import archive as A
from chronogeo.plans import provenance as PV
from chronogeo.plans import terms as S
from chronogeo.schema import VOCAB as V

_TRIPLE = ["g", "s", "p", "o", "o_type", "lang", "dtype"]


def _uuid(*key: str) -> str:
    """SQL of the stable id of a row key."""
    text = " || chr(31) || ".join(f"coalesce({k}, chr(0))" for k in key)
    return rf"regexp_replace(sha256({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}}).*$', '\1-\2-\3-\4-\5')"


def _template(rows: str, *triples: tuple[str, str, str] | tuple[str, str, str, str]) -> str:
    """SQL of the triples made of each row: (subject, predicate, object[, language of a literal])."""
    parts = [f"SELECT CAST(NULL AS VARCHAR) AS g, {t[0]} AS s, '{t[1]}' AS p, {t[2]} AS o, '{'literal' if len(t) > 3 else 'iri'}' AS o_type, "
             f"CAST({t[3] if len(t) > 3 else 'NULL'} AS VARCHAR) AS lang, CAST(NULL AS VARCHAR) AS dtype FROM rows_" for t in triples]
    return f"WITH rows_ AS ({rows}) SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE o IS NOT NULL"


def _named(sql: str, lang: str = "CAST(NULL AS VARCHAR)") -> str:
    """Search terms with the node and language of each."""
    return f"SELECT item, item || '/search_term/' || {_uuid('item', 'label', lang)} AS node, label, {lang} AS lang FROM ({sql})"


def _difference(before, after):
    """What an edit of the graph took out and what it put in."""
    rows = [a.select(_TRIPLE).exceptAll(b.select(_TRIPLE)).withColumn("change", F.lit(x))
            for a, b, x in ((before, after, "removed"), (after, before, "added"))]
    return rows[0].unionByName(rows[1])


# ---------------------------------------------------------------- search terms

_EV = """WITH l AS (SELECT event_id, 'it' AS lang, event_type AS label FROM events WHERE value >= 20 UNION ALL SELECT event_id, 'en', 'e-' || event_type FROM events WHERE value >= 50),
 t AS (SELECT event_id, unnest(['it', 'en']) AS lang, unnest(['tipo ', 'type ']) || event_type AS typ FROM events WHERE value < 80),
 r AS (SELECT e.*, coalesce(l.lang, t.lang) AS lang, l.label, t.typ FROM events e LEFT JOIN l ON l.event_id = e.event_id
  LEFT JOIN t ON t.event_id = e.event_id AND (l.lang IS NULL OR l.lang = t.lang) WHERE event_type <> 'purchase')
 SELECT DISTINCT 'x:event/' || event_id AS item, CASE WHEN lang IS NOT NULL THEN coalesce(label, '') || ' Isola ' || user_id || coalesce(' ' || typ, '')
  || CASE WHEN event_type <> 'error' THEN ' ' || year(ts) ELSE '' END END AS label, lang FROM r"""


@check(_named(_EV, "lang"))
def search_terms_event(spark, sf):
    return S.search_terms(v.stored(spark, sf, v.event_graph), "event").select("item", "node", "label", "lang")


@check(_named("""SELECT 'x:group/' || s_suppkey AS item, s_name || CASE WHEN s_acctbal < 0 THEN 'A' || s_suppkey || ' (' || CASE WHEN s_nationkey < 5 THEN 'Fam' || s_nationkey || ', ' ELSE '' END || ')'
 ELSE CASE WHEN s_nationkey < 5 THEN 'Fam' || s_nationkey || ', ' ELSE '' END END || ' ' || (1900 + s_nationkey) || CASE WHEN s_acctbal > 5000 THEN ' ' || (1950 + s_nationkey) ELSE '' END AS label FROM supplier"""))
def search_terms_group(spark, sf):
    return S.search_terms(v.stored(spark, sf, v.group_graph), "group").select("item", "node", "label", "lang")


def _person_sql(dates: str) -> str:
    return f"""WITH g AS (SELECT c_custkey, c_name AS given FROM customer UNION ALL SELECT c_custkey, 'G2-' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
 p AS (SELECT *, c_mktsegment || ', ' || given AS full_name, CASE WHEN c_acctbal < 0 THEN 'Al' || c_custkey END AS al, {dates} AS dates
  FROM customer JOIN g USING (c_custkey) JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'HOUSEHOLD')
 SELECT 'x:person/' || c_custkey AS item, coalesce(al || ' (' || full_name || ')', full_name) || coalesce(' ' || al, '') || ' di ' || n_name || coalesce(' ' || dates, '') AS label FROM p"""


_PERSON = _named(_person_sql("CASE WHEN c_mktsegment <> 'MACHINERY' THEN (1900 + c_nationkey) || CASE WHEN c_acctbal > 5000 THEN ' - ' || (1960 + c_nationkey) ELSE '' END END"))


@check(_PERSON)
def search_terms_person(spark, sf):
    return S.search_terms(v.stored(spark, sf, v.person_graph), "person").select("item", "node", "label", "lang")


@check(_person_sql("""CASE WHEN c_mktsegment <> 'MACHINERY' THEN (1900 + c_nationkey) || CASE WHEN c_acctbal > 5000 THEN ' - ' || (1960 + c_nationkey) ELSE '' END
 WHEN c_acctbal > 5000 THEN ' - ' || (1960 + c_nationkey) END"""))
def search_terms_person_all_dates(spark, sf):
    """Deaths without a birth count too."""
    return S.person_terms(v.stored(spark, sf, v.person_graph), include_death_only=True).select("item", "label")


_NODE_LABEL = "CASE WHEN p_size = 1 THEN 'AC' || k WHEN p_type <> 'ECONOMY' THEN 'N' || k ELSE 'E' || k END"
_CHAIN = with_views("tree", recursive=True) + f""", named AS (SELECT k, parent, {_NODE_LABEL} AS label FROM tree),
 up AS (SELECT k, k AS at, label AS path, 0 AS d FROM named
  UNION ALL SELECT up.k, q.k, q.label || ', ' || up.path, d + 1 FROM up JOIN named me ON me.k = up.at JOIN named q ON q.k = me.parent WHERE up.at > 0 AND d < {{depth}}),
 path AS (SELECT k, max_by(path, d) AS path FROM up GROUP BY k)"""


@check(_named(_CHAIN.format(depth=7) + """, src AS (SELECT p_partkey AS k, p_name AS title, p_size, p_brand FROM part UNION SELECT p_partkey, p_brand, p_size, p_brand FROM part WHERE p_size > 45),
 loc AS (SELECT k, CASE WHEN p_size = 7 THEN '' WHEN p_size > 5 THEN ' ' || path WHEN p_size < 9 THEN ' Bib ' || p_brand ELSE '' END AS whr, title, p_size, p_brand FROM src JOIN path USING (k)),
 alt AS (SELECT * FROM loc UNION ALL SELECT k, '', title, p_size, p_brand FROM loc WHERE p_size > 30)
 SELECT DISTINCT 'x:source/' || k AS item, title || whr || CASE WHEN p_size > 20 THEN ' Isola ' || p_brand ELSE '' END || CASE WHEN p_size > 10 THEN ' ' || (1500 + p_size) ELSE '' END AS label FROM alt"""))
def search_terms_primary_source(spark, sf):
    return S.search_terms(v.stored(spark, sf, v.source_graph), "primary_source").select("item", "node", "label", "lang")


_BOOK = """WITH w AS (SELECT DISTINCT l_orderkey AS k, s_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'A'),
 au AS (SELECT k, min(s_name) AS first, string_agg(s_name, ', ' ORDER BY s_name) AS authors FROM w GROUP BY k),
 b AS (SELECT *, o_orderpriority <> '5-LOW' AS ev, o_orderpriority IN ('1-URGENT', '5-LOW') AS br FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN au ON k = o_orderkey),
 x AS (SELECT o_orderkey, coalesce(first || ', ', '') || 'Order ' || o_orderkey || CASE WHEN br THEN ', Series ' || o_orderstatus ELSE '' END
  || CASE WHEN ev AND o_orderstatus = 'F' THEN ', a cura di ' || c_name ELSE '' END || CASE WHEN ev THEN ', Place ' || o_orderstatus || ', ' || o_orderpriority ELSE '' END
  || CASE WHEN ev AND o_orderstatus <> 'P' THEN ', ' || CAST(o_orderdate AS DATE) ELSE '' END AS cit, authors,
  CASE WHEN br AND o_orderstatus <> 'O' THEN 'Typ ' || o_orderstatus END AS typ, CASE WHEN ev AND o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d FROM b)
 SELECT 'x:book/' || o_orderkey AS item, cit || coalesce(' ' || authors, '') || coalesce(' ' || typ, '') || coalesce(' ' || d, '') AS label FROM x"""


@check(_named(_BOOK))
def search_terms_secondary_source(spark, sf):
    return S.search_terms(v.stored(spark, sf, v.book_graph), "secondary_source").select("item", "node", "label", "lang")


@check("""SELECT 'group' AS kind, count(*) AS items, count(*) AS terms FROM supplier UNION ALL
 SELECT 'person', count(*), CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END) AS BIGINT) FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'""")
def search_term_summary(spark, sf):
    """Summary of a run over a graph with groups and persons."""
    return S.run_all(v.stored(spark, sf, v.group_graph).unionByName(v.stored(spark, sf, v.person_graph)))[1]


@check(_template(_PERSON, ("item", V.c("P1_is_identified_by"), "node"), ("node", V.rdf_type, f"'{V.c('E41_Appellation')}'"),
                 ("node", V.c("P2_has_type"), f"'{V.kind('search_term')}'"), ("node", V.label, "label", "lang")))
def search_term_triples(spark, sf):
    return S.term_triples(S.search_terms(v.stored(spark, sf, v.person_graph), "person"))


@check("SELECT count(*) AS open_items FROM customer WHERE false")
def search_terms_idempotent(spark, sf):
    """Once the terms are in the graph, no person is left without one."""
    g = v.stored(spark, sf, v.person_graph)
    g = G.add_triples(g, S.term_triples(S.search_terms(g, "person")))
    return S.open_items(g, "person").agg(F.count("*").alias("open_items"))


_OLD_TERMS = "SELECT *, 'removed' AS change FROM (" + _template(
    "SELECT 'x:person/' || c_custkey AS item, 'x:person/' || c_custkey || '/old' AS node, 'old ' || c_custkey AS label FROM customer WHERE c_mktsegment = 'HOUSEHOLD'",
    ("item", V.c("P1_is_identified_by"), "node"), ("node", V.rdf_type, f"'{V.c('E41_Appellation')}'"),
    ("node", V.c("P2_has_type"), f"'{V.kind('search_term')}'"), ("node", V.label, "label", "NULL")) + ")"


@check(_OLD_TERMS)
def clean_search_terms(spark, sf):
    g = v.stored(spark, sf, v.person_graph)
    return _difference(g, S.clean_search_terms(g, "person"))


@check(_OLD_TERMS)
def clean_term_nodes(spark, sf):
    g = v.stored(spark, sf, v.person_graph)
    return _difference(g, S.clean_term_nodes(g, "person")[0])


@check("SELECT 'x:person/' || c_custkey AS item, CAST(1 AS BIGINT) AS terms, CAST(4 AS BIGINT) AS triples FROM customer WHERE c_mktsegment = 'HOUSEHOLD'")
def clean_term_report(spark, sf):
    return S.clean_term_nodes(v.stored(spark, sf, v.person_graph), "person")[1]


# ---------------------------------------------------------------- hierarchy

_ANC = with_views("tree", recursive=True) + """, up AS (SELECT k AS s, k AS o, 0 AS depth FROM tree
 UNION ALL SELECT s, parent, depth + 1 FROM up JOIN tree ON tree.k = up.o WHERE up.o > 0)"""


def _links(spark, sf):
    return G.edges(v.stored(spark, sf, v.archive_graph), V.c("P46i_forms_part_of"))


@check(_ANC + " SELECT 'x:arch/' || s AS s, 'x:arch/' || o AS o, depth FROM up")
def ancestor_closure(spark, sf):
    return G.closure(_links(spark, sf))


@check(_ANC + " SELECT 'x:arch/' || s AS s, 'x:arch/' || o AS o, CAST(depth + 1 AS BIGINT) AS n FROM up")
def ancestor_counts(spark, sf):
    return G.ancestor_counts(G.closure(_links(spark, sf), acyclic=True).select("s", "o"))


@check(_CHAIN.format(depth=7) + " SELECT 'x:arch/' || k AS node, path FROM path")
def ancestor_chain(spark, sf):
    g = v.stored(spark, sf, v.archive_graph)
    nodes = A.archive_subjects(g).withColumnRenamed("s", "node")
    return G.ancestor_chain(nodes, _links(spark, sf), G.preferred_labels(g))


@check(with_views("tree") + f" SELECT 'x:arch/' || k AS node, {_NODE_LABEL} AS label FROM tree")
def preferred_labels(spark, sf):
    g = v.stored(spark, sf, v.archive_graph)
    return G.preferred_labels(g).filter(F.startswith(c("node"), F.lit("x:arch/")) & ~c("node").endswith("/acr"))


@check(with_views("tree") + " SELECT 'x:arch/' || k AS s, CASE WHEN p_size = 1 THEN 'AC' || k WHEN p_type <> 'ECONOMY' THEN 'N' || k ELSE 'E' || k END AS label FROM tree")
def best_labels(spark, sf):
    g = v.stored(spark, sf, v.archive_graph)
    return G.best_labels(g, A.archive_subjects(g))


@check(with_views("tree") + f" SELECT 'x:arch/' || k AS s, {_NODE_LABEL} AS path FROM tree WHERE k = 0")
def seed_paths(spark, sf):
    return A.seed_paths(v.stored(spark, sf, v.archive_graph))


@check(_CHAIN.format(depth=100) + " SELECT 'x:arch/' || k AS s, path FROM path")
def archive_paths(spark, sf):
    return A.archive_paths(v.stored(spark, sf, v.archive_graph))


@check(_template(_CHAIN.format(depth=100) + " SELECT 'x:arch/' || k AS s, 'x:arch/' || k || '/path' AS node, path FROM path",
                 ("s", V.c("P1_is_identified_by"), "node"), ("node", V.rdf_type, f"'{V.c('E41_Appellation')}'"),
                 ("node", V.c("P2_has_type"), f"'{V.kind('path')}'"), ("node", V.label, "path", "NULL")))
def archive_path_triples(spark, sf):
    return A.path_triples(A.archive_paths(v.stored(spark, sf, v.archive_graph)))


@check(with_views("tree") + f""", named AS (SELECT k, parent, {_NODE_LABEL} AS label FROM tree)
 SELECT 'x:arch/' || a.k AS s, b.label || ', ' || a.label AS path FROM named a JOIN named b ON b.k = a.parent WHERE a.k > 0""")
def populate_one_level(spark, sf):
    """One propagation step from labels taken as parent paths, for every subject with a parent."""
    g = v.stored(spark, sf, v.archive_graph)
    labels = A.path_labels(g, A.archive_subjects(g))
    return A.populate_paths(labels.withColumnRenamed("label", "path"), _links(spark, sf), labels)


_PATHS = _ANC + """, lab AS (SELECT k AS o, CASE WHEN p_size = 1 THEN 'AC' || k ELSE 'N' || k END AS label FROM tree WHERE p_type <> 'ECONOMY' OR p_size = 1
 UNION SELECT k, 'E' || k FROM tree WHERE p_type <> 'PROMO' AND p_size <> 1),
 pth AS (SELECT s, string_agg(label, ', ' ORDER BY depth DESC, label) AS item_label FROM up JOIN lab USING (o) GROUP BY s)"""


@check(_PATHS + " SELECT 'x:arch/' || s AS s, item_label FROM pth")
def item_paths(spark, sf):
    g = v.stored(spark, sf, v.archive_graph)
    return A.item_paths(_links(spark, sf), A.class_labels(g), acyclic=True)


@check(_PATHS + """ SELECT 'x:arch/' || p_partkey AS s, item_label || ', ' || CASE p_type WHEN 'PROMO' THEN 'promo.' WHEN 'SMALL' THEN 'small.' ELSE 'supporto ' || p_type END
 || ' ' || p_name AS full_path FROM part JOIN pth ON s = p_partkey""")
def full_path(spark, sf):
    items = table(spark, sf, "part").select(
        v.txt("x:arch/", c("p_partkey")).alias("s"), v.txt("x:medium/", c("p_type")).alias("medium"), v.txt("x:source/", c("p_partkey"), "/medium_title").alias("medium_title"))
    return A.full_path(v.stored(spark, sf, v.source_graph), items)


@check("""SELECT 'x:source/' || p_partkey AS subject, 'x:source/' || p_partkey || '/' || t AS appellation, CASE t WHEN 'title' THEN p_name ELSE p_brand END AS label,
 CASE WHEN p_size <> 7 THEN 'x:source/' || p_partkey || '/loc' END AS location, CASE WHEN p_size > 30 THEN 'x:medium/' || p_type END AS medium, CAST(NULL AS VARCHAR) AS medium_name
 FROM part, (VALUES ('title'), ('title2')) k(t) WHERE t = 'title' OR p_size > 45""")
def list_sources(spark, sf):
    return A.list_sources(v.stored(spark, sf, v.source_graph))


@check("""SELECT 'x:source/' || p_partkey AS subject, CASE WHEN p_size > 30 AND p_type IN ('PROMO', 'SMALL') THEN 'x:medium/' || p_type END AS carrier_type,
 CASE WHEN p_size > 30 AND p_type IN ('PROMO', 'SMALL') THEN 'x:medium/' || p_type || '/abbr' END AS abbreviation,
 CASE WHEN p_size > 30 AND p_type IN ('PROMO', 'SMALL') THEN lower(p_type) || '.' END AS type_label FROM part""")
def carrier_abbreviation(spark, sf):
    subjects = table(spark, sf, "part").select(v.txt("x:source/", c("p_partkey")).alias("subject"))
    return A.carrier_abbreviation(v.stored(spark, sf, v.source_graph), subjects)


# ---------------------------------------------------------------- provenance

_AT = "strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN extract(microseconds FROM ts) % 1000000 = 0 THEN '' ELSE '.' || rtrim(lpad(CAST(extract(microseconds FROM ts) % 1000000 AS VARCHAR), 6, '0'), '0') END"
_PROV = f"""WITH e AS (SELECT *, {_AT} AS at_text, 'x:source/' || user_id AS subject FROM events JOIN part ON p_partkey = user_id)"""


@check(_PROV + " SELECT DISTINCT subject, subject || '/entity_form_record' AS record FROM e WHERE p_size >= 25")
def form_records(spark, sf):
    return PV.form_records(v.stored(spark, sf, v.prov_graph))


_RECORD = V.record_types + "entity_form_record"


@check(_template(_PROV + " SELECT DISTINCT subject, subject || '/entity_form_record' AS record FROM e WHERE p_size >= 25",
                 ("subject", V.c("P129i_is_subject_of"), "record"), ("record", V.rdf_type, f"'{V.crmdig}D1_Digital_Machine'"),
                 ("record", V.rdf_type, f"'{V.crmdig}D1_Digital_Object'"), ("record", V.c("P2_has_type"), f"'{_RECORD}'"),
                 ("record", V.c("P129_is_about"), "subject")))
def form_record_triples(spark, sf):
    return PV.record_triples(PV.form_records(v.stored(spark, sf, v.prov_graph)))


_MODIFIED = _PROV + """ SELECT subject, subject || '/entity_form_record' AS record, 'x:prov/' || event_id AS entity, 'x:actor/' || event_type AS actor, at_text AS at FROM e a WHERE p_size < 25
 AND NOT EXISTS (SELECT 1 FROM e b WHERE b.value > 90 AND b.user_id = a.user_id AND b.event_type = a.event_type AND b.ts = a.ts)"""


@check(_MODIFIED)
def modification_events(spark, sf):
    return PV.modification_events(v.stored(spark, sf, v.prov_graph))


_CREATED = _PROV + """, m AS (SELECT subject, min(ts) AS ts FROM e GROUP BY subject) SELECT subject, subject || '/entity_form_record' AS record, 'x:prov/' || event_id AS entity,
 'x:actor/' || event_type AS actor, at_text AS at FROM e JOIN m USING (subject, ts) WHERE p_size < 25 AND p_size >= 5"""


@check(_CREATED)
def creation_events(spark, sf):
    return PV.creation_events(v.stored(spark, sf, v.prov_graph))


@check("WITH e AS (SELECT 'x:source/' || user_id AS subject, event_id, ts FROM events), m AS (SELECT subject, min(CAST(ts AS DATE)) AS day FROM e GROUP BY subject) SELECT e.subject, event_id, CAST(day AS VARCHAR) AS day FROM e JOIN m ON m.subject = e.subject AND CAST(ts AS DATE) = day")
def earliest_with_ties(spark, sf):
    """All events on a subject's first day."""
    rows = table(spark, sf, "events").select(
        v.txt("x:source/", c("user_id")).alias("subject"), "event_id", c("ts").cast("date").cast("string").alias("day"))
    return PV.earliest(rows, "subject", "day")


def _event_triples(events: str, tail: str) -> str:
    named = f"SELECT *, record || '/entity_formRecord_{tail}/' || {_uuid('entity', 'actor', 'e_.at')} AS ev FROM ({events}) e_"
    spans = f"SELECT *, ev || '/at_some_time_within/' || {_uuid('ev')} AS span FROM ({named})"
    return _template(spans, ("record", V.crmdig + "L11i_was_output_of", "ev"), ("ev", V.rdf_type, f"'{V.crmdig}D7_Digital_Machine_Event'"),
                     ("ev", V.c("P2_has_type"), f"'{_RECORD}_{tail}'"), ("ev", V.c("P14_carried_out_by"), "actor"),
                     ("ev", V.c("P4_has_time-span"), "span"), ("ev", V.crmdig + "L11_had_output", "record"),
                     ("span", V.rdf_type, f"'{V.c('E52_Time-Span')}'"), ("span", V.c("P82_at_some_time_within"), "rows_.at", "NULL"))


@check(_event_triples(_MODIFIED, "modification"))
def modification_triples(spark, sf):
    return PV.event_triples(PV.modification_events(v.stored(spark, sf, v.prov_graph)), "modification")


@check(_event_triples(_CREATED, "creation"))
def creation_triples(spark, sf):
    return PV.event_triples(PV.creation_events(v.stored(spark, sf, v.prov_graph)), "creation")


@check(_PROV + f""" SELECT subject, subject || '/entity_form_record' AS record, '{V.record_types}entity_form_record_modification' AS ev_type, 'x:actor/' || event_type AS actor, at_text AS at
 FROM e WHERE p_size < 25 AND value > 90""")
def verify_events(spark, sf):
    return PV.verify_events(v.stored(spark, sf, v.prov_graph))


# ---------------------------------------------------------------- triple operators

@check("""SELECT 'x:place/' || o_orderstatus AS s, 'Place ' || o_orderstatus AS label, CAST(NULL AS VARCHAR) AS typology FROM (SELECT DISTINCT o_orderstatus FROM orders)
 UNION ALL SELECT 'x:series/' || o_orderstatus || '/title', 'Series ' || o_orderstatus, NULL FROM (SELECT DISTINCT o_orderstatus FROM orders)
 UNION ALL SELECT 'x:typ/' || o_orderstatus, 'Typ ' || o_orderstatus, NULL FROM (SELECT DISTINCT o_orderstatus FROM orders)
 UNION ALL SELECT 'x:cust/' || c_custkey, c_name, NULL FROM customer UNION ALL SELECT 'x:sup/' || s_suppkey, s_name, NULL FROM supplier
 UNION ALL SELECT 'x:prio/' || o_orderpriority, o_orderpriority, NULL FROM (SELECT DISTINCT o_orderpriority FROM orders)
 UNION ALL SELECT 'x:book/' || o_orderkey || '/title', 'Order ' || o_orderkey, NULL FROM orders""")
def star_pattern(spark, sf):
    """Every labelled node, with a typology where it has one."""
    return G.pattern(v.stored(spark, sf, v.book_graph), {"label": V.label, "typology": V.onto("has_broader_typology")}, "s", {"typology"})


@check("""SELECT 'N' || n_nationkey AS s, 'x:in' AS p, 'R' || n_regionkey AS o FROM nation UNION SELECT 'C' || c_custkey, 'x:of', 'N' || c_nationkey FROM customer
 UNION SELECT 'S' || s_suppkey, 'x:of', 'N' || s_nationkey FROM supplier WHERE s_acctbal >= 0""")
def construct_and_add(spark, sf):
    """Template rows; those with an unbound object are left out, known triples are not doubled."""
    n, cu, s = (table(spark, sf, t) for t in ("nation", "customer", "supplier"))
    old = G.construct(cu, [G.term(v.txt("C", c("c_custkey")), "x:of", v.txt("N", c("c_nationkey")))])
    new = G.construct(cu.join(n, c("c_nationkey") == c("n_nationkey")), [
        G.term(v.txt("C", c("c_custkey")), "x:of", v.txt("N", c("c_nationkey"))),
        G.term(v.txt("N", c("n_nationkey")), "x:in", v.txt("R", c("n_regionkey")))])
    only = G.construct(n, [G.term(v.txt("N", c("n_nationkey")), "x:in", v.txt("R", c("n_regionkey")))])
    sup = G.construct(s, [G.term(v.txt("S", c("s_suppkey")), "x:of", F.when(c("s_acctbal") >= 0, v.txt("N", c("s_nationkey"))))])
    return G.add_triples(G.add_triples(G.add_triples(old, new), only), sup).select("s", "p", "o")


@check("""SELECT 'C' || c_custkey AS s, 'N' || c_nationkey AS o FROM customer WHERE c_acctbal >= 0""")
def delete_triples(spark, sf):
    cu = table(spark, sf, "customer")
    t = [G.term(v.txt("C", c("c_custkey")), "x:of", v.txt("N", c("c_nationkey")))]
    return G.delete_triples(G.construct(cu, t), G.construct(cu.filter("c_acctbal < 0"), t), ["x:of"]).select("s", "o")


@check("""SELECT 'C' || c_custkey AS s, 'N' || c_nationkey AS o FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)
 UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation WHERE n_regionkey <> 1""")
def delete_nodes(spark, sf):
    cu, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    g = G.construct(cu, [G.term(v.txt("C", c("c_custkey")), "x:of", v.txt("N", c("c_nationkey")))]).unionByName(
        G.construct(n, [G.term(v.txt("N", c("n_nationkey")), "x:in", v.txt("R", c("n_regionkey")))]))
    gone = n.filter("n_regionkey = 1").select(v.txt("N", c("n_nationkey")).alias("node"))
    return G.delete_nodes(g, gone).select("s", "o")
