"""Publishing, repair, diagnosis and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import check
from checks.views import RANGE_END, RANGE_START, YEARS, c, table, with_views
from chronogeo.operators import features as M
from chronogeo.operators import phases as PH
from chronogeo.plans import buildings as B
from chronogeo.plans import diagnosis as D
from chronogeo.plans import publish as U
from chronogeo.plans import reports as R
from chronogeo.plans.publish import State
from chronogeo.schema import VOCAB, site_prefixes

_RECT = """'MULTIPOLYGON(((' || x || ' ' || y || ',' || (x + 2) || ' ' || y || ',' || (x + 2) || ' ' || (y + 3) || ',' || x || ' ' || (y + 3) || ',' || x || ' ' || y || ')))'"""
_KIND_T = "CASE kind WHEN 'buildings' THEN 'Buildings' WHEN 'islands' THEN 'Island' WHEN 'openspaces' THEN 'Open Space' ELSE 'Water way' END"
_KIND_Z = "CASE kind WHEN 'islands' THEN 0 WHEN 'waterways' THEN -1 ELSE 1 END"


def _state(spark, sf) -> State:
    return State(v.published(spark, sf), v.published_sources(spark, sf), v.source_years(spark, sf))


@check(with_views("layer", "published") + f""" SELECT identifier, 'Buildings' AS t, 1 AS z, 'old' AS name, 'G0' AS geometry FROM published UNION ALL
 SELECT DISTINCT identifier, {_KIND_T}, {_KIND_Z}, name, {_RECT} FROM layer l WHERE NOT EXISTS (SELECT 1 FROM published p WHERE p.identifier = l.identifier)""")
def publish_features(spark, sf):
    return M.publish_features(v.layer(spark, sf), v.published(spark, sf)).table


@check(with_views("layer", "published_sources") + """ SELECT identifier, source FROM published_sources UNION
 SELECT identifier, source FROM layer WHERE present""")
def publish_sources_all(spark, sf):
    return M.publish_sources(v.plain_layer(spark, sf), v.published_sources(spark, sf)).table


_ORDER = ["Today"] + [f"{y}: {s}" for y in reversed(YEARS) for s in "FO"] + [f"{y}-{str(int(y) + 1)[2:]}: b" for y in reversed(YEARS)] + [
    f"{y}-{int(y) + 1}" for y in reversed(YEARS)] + [f"{y}:dis.7" for y in reversed(YEARS)] + ["no year"]
_RANKS = ", ".join(f"({i}, '{s}')" for i, s in enumerate(_ORDER))


@check(with_views("layer", "published_sources") + f""", ranks AS (SELECT * FROM (VALUES {_RANKS}) r(n, source)),
 first AS (SELECT identifier, source, row_number() OVER (PARTITION BY identifier ORDER BY n) AS k FROM layer JOIN ranks USING (source)
  WHERE present AND identifier NOT IN (SELECT identifier FROM published_sources))
 SELECT identifier, source FROM published_sources UNION ALL SELECT identifier, source FROM first WHERE k = 1""")
def publish_sources_first(spark, sf):
    return M.publish_sources(v.plain_layer(spark, sf), v.published_sources(spark, sf), "first", _ORDER).table


_LONG_SPAN = "source, {s} AS start_year, {e} AS end_year".format(s=RANGE_START.format(c="source"), e=RANGE_END.format(c="source"))


@check(with_views("layer", "source_years") + f""" SELECT source, start_y AS start_year, end_y AS end_year FROM source_years UNION ALL
 SELECT {_LONG_SPAN} FROM (SELECT DISTINCT source FROM layer WHERE source NOT IN (SELECT source FROM source_years))""")
def register_sources(spark, sf):
    out = M.register_sources(v.plain_layer(spark, sf), v.source_years(spark, sf)).table
    return out.select("source", c("start").alias("start_year"), c("end").alias("end_year"))


@check(with_views("layer", "published", "published_sources", "source_years") + """,
 f AS (SELECT identifier, bool_or(identifier IN (SELECT identifier FROM published)) AS k FROM layer GROUP BY identifier),
 l AS (SELECT DISTINCT identifier, source, (identifier, source) IN (SELECT (identifier, source) FROM published_sources) AS k FROM layer WHERE present)
 SELECT 'features' AS target, CASE WHEN k THEN 'exists' ELSE 'inserted' END AS outcome, count(*) AS n FROM f GROUP BY ALL
 UNION ALL SELECT 'feature_sources', CASE WHEN k THEN 'exists' ELSE 'inserted' END, count(*) FROM l GROUP BY ALL
 UNION ALL SELECT 'source_years', 'inserted', count(DISTINCT source) FROM layer WHERE source NOT IN (SELECT source FROM source_years) HAVING count(*) > 0""")
def update_preview(spark, sf):
    """What publishing all layers would do, without doing it."""
    return U.preview(U.update_state(v.layer(spark, sf), _state(spark, sf), dst_srid=None))


@check("""SELECT c_custkey AS k, c_mktsegment AS a FROM customer WHERE c_acctbal >= 0 UNION ALL
 SELECT o_custkey, min(o_orderpriority) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY o_custkey""")
def insert_ignore(spark, sf):
    target = table(spark, sf, "customer").filter("c_acctbal >= 0").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("a"))
    rows = table(spark, sf, "orders").select(c("o_custkey").alias("k"), c("o_orderpriority").alias("a"))
    return M.insert_missing(target, rows, ["k"]).table


@check("""WITH n AS (SELECT o_custkey AS k, min(o_orderdate) AS d FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
 SELECT c_custkey AS k, c_mktsegment AS a, CASE WHEN n.k IS NULL THEN DATE '1900-01-01' ELSE CAST(d AS DATE) END AS day FROM customer LEFT JOIN n ON n.k = c_custkey""")
def update_from(spark, sf):
    target = table(spark, sf, "customer").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("a"), F.lit("1900-01-01").cast("date").alias("day"))
    rows = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(c("o_custkey").alias("k"), c("o_orderdate").cast("date").alias("day"))
    return M.update_from(target, rows, ["k"], ["day"]).table


@check("""SELECT o_custkey AS k, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) THEN 'deleted' ELSE 'missing' END AS outcome
 FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def delete_keys_report(spark, sf):
    target = table(spark, sf, "customer").filter("c_acctbal >= 0").select(c("c_custkey").alias("k"), "c_name")
    bad = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(c("o_custkey").alias("k"))
    return M.delete_keys(target, bad, ["k"]).delta


@check("""SELECT c_custkey AS k, c_name FROM customer WHERE c_acctbal >= 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""")
def delete_keys(spark, sf):
    target = table(spark, sf, "customer").filter("c_acctbal >= 0").select(c("c_custkey").alias("k"), "c_name")
    bad = table(spark, sf, "orders").filter("o_totalprice > 300000").select(c("o_custkey").alias("k"))
    return M.delete_keys(target, bad, ["k"]).table


@check(with_views("published", "published_sources") + " SELECT identifier, source FROM published_sources WHERE identifier IN (SELECT identifier FROM published)")
def delete_orphan_sources(spark, sf):
    return M.delete_orphans(v.published_sources(spark, sf), v.published(spark, sf), "identifier").table


@check(with_views("published", "layer") + " SELECT identifier FROM published WHERE identifier IN (SELECT identifier FROM layer)")
def delete_unlisted(spark, sf):
    lay = v.plain_layer(spark, sf)
    layers = [lay.filter(c("kind") == k) for k in ("buildings", "islands", "openspaces", "waterways")]
    return M.delete_unlisted(v.published(spark, sf), layers).table.select("identifier")


@check("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n, 'duplicate key' AS problem FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return M.check_keys(table(spark, sf, "lineitem").select("l_orderkey", c("l_linenumber").cast("long").alias("l_linenumber")), ["l_orderkey", "l_linenumber"])


@check(with_views("poly") + " SELECT identifier, bob, eoe FROM poly WHERE bob <= DATE '1998-06-01' AND (eoe IS NULL OR eoe > DATE '1998-06-01')")
def as_of_slice(spark, sf):
    return M.as_of(v.polygons(spark, sf), "1998-06-01").select("identifier", "bob", "eoe")


@check(with_views("layer", "source_years") + """ SELECT DISTINCT identifier FROM layer JOIN source_years USING (source)
 WHERE present AND 1998 BETWEEN start_y AND end_y""")
def features_in_year(spark, sf):
    links = M.true_sources(v.plain_layer(spark, sf)).select("identifier", "source")
    return M.features_in_year(links, v.source_years(spark, sf), 1998)


@check(with_views("layer", "source_years") + """, ys AS (SELECT DISTINCT CAST(year(l_shipdate) AS INT) AS year FROM lineitem)
 SELECT DISTINCT year, identifier FROM layer JOIN source_years USING (source) JOIN ys ON year BETWEEN start_y AND end_y WHERE present""")
def features_by_year(spark, sf):
    links = M.true_sources(v.plain_layer(spark, sf)).select("identifier", "source")
    years = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year")).distinct()
    return M.features_by_year(links, v.source_years(spark, sf), years)


# ---------------------------------------------------------------- phases

_PH = with_views("layer", "source_years") + """, ph AS (SELECT identifier, split_part(identifier, '.', 1) AS base_id, min(name) AS name,
  min(CASE WHEN present THEN least(start_y, end_y) END) AS bob, max(CASE WHEN present THEN greatest(start_y, end_y) END) AS latest,
  count(*) FILTER (WHERE present AND start_y IS NULL) AS unknown_sources
  FROM layer LEFT JOIN source_years USING (source) GROUP BY identifier)"""
_IV = _PH + """, iv AS (SELECT base_id, identifier, name, bob, lead(bob) OVER (PARTITION BY base_id ORDER BY bob, identifier) - 1 AS eoe FROM ph WHERE bob IS NOT NULL)"""


def _phases(spark, sf):
    return PH.phase_years(v.plain_layer(spark, sf), v.source_years(spark, sf))


@check(_PH + " SELECT identifier, base_id, name, bob, latest, unknown_sources FROM ph")
def phase_years(spark, sf):
    return _phases(spark, sf)


@check(_IV + " SELECT base_id, identifier, name, bob, eoe, eoe < bob AS inverted FROM iv")
def phase_intervals(spark, sf):
    return B.building_phases(v.plain_layer(spark, sf), v.source_years(spark, sf))[1]


@check(_PH + """ SELECT base_id, min_by(name, identifier) AS name, count(bob) AS n_phases, CAST(sum(unknown_sources) AS BIGINT) AS unknown_sources
 FROM ph GROUP BY base_id""")
def buildings(spark, sf):
    return PH.buildings(_phases(spark, sf))


@check(_IV + """, b AS (SELECT DISTINCT base_id FROM ph), t AS (
 SELECT 'type' AS k, 4 * count(*) AS n FROM b UNION ALL SELECT 'x', 0) SELECT p, count(*) AS n FROM (
 SELECT unnest(['type', 'type', 'type', 'label', 'P53', 'P196i', 'value', 'P1']) AS p FROM b
 UNION ALL SELECT unnest(['P166i', 'type', 'P4', 'P138i', 'type', 'P82a', 'P2', 'label']) FROM iv
 UNION ALL SELECT 'P82b' FROM iv WHERE eoe IS NOT NULL) GROUP BY p""")
def building_triples(spark, sf):
    """Triples per predicate of all dated buildings."""
    heads, phases = B.building_phases(v.plain_layer(spark, sf), v.source_years(spark, sf))
    t = B.building_triples(heads.withColumn("island", F.lit("x:isle/1")), phases)
    short = F.when(c("p") == VOCAB.rdf_type, "type").otherwise(F.regexp_extract("p", r"[/#](P\d+[a-z]?|label|value)(?:_[^/]*)?$", 1))
    return t.groupBy(short.alias("p")).agg(F.count("*").alias("n"))


@check(_IV + """ SELECT identifier, bob || '-01-01' AS begin_day, eoe || '-12-31' AS end_day FROM iv""")
def building_timespans(spark, sf):
    """Begin and end days read back from the triples through the pattern presence -> representation and time span."""
    heads, phases = B.building_phases(v.plain_layer(spark, sf), v.source_years(spark, sf))
    t = B.building_triples(heads.withColumn("island", F.lit("x:isle/1")), phases)
    from chronogeo.operators import graph as G
    shape = G.edges(t, VOCAB.c("P138i_has_representation"), "presence", "shape").join(G.edges(t, VOCAB.label, "shape", "identifier"), "shape")
    span = G.pattern(t, {"begin_day": VOCAB.c("P82a_begin_of_the_begin"), "end_day": VOCAB.c("P82b_end_of_the_end")}, "span", {"end_day"})
    return shape.join(G.edges(t, VOCAB.c("P4_has_time-span"), "presence", "span"), "presence").join(span, "span").select("identifier", "begin_day", "end_day")


@check(_PH + """ SELECT base_id, count(bob) AS n_phases, CASE WHEN base_id IN (SELECT 'C_BLDG_' || c_custkey FROM customer WHERE c_nationkey < 5)
 THEN 'skipped' ELSE 'inserted' END AS outcome FROM ph GROUP BY base_id""")
def create_buildings(spark, sf):
    """Outcome per building: skipped when its identifier is in the graph already."""
    lay = v.plain_layer(spark, sf)
    old = table(spark, sf, "customer").filter("c_nationkey < 5")
    b, n = v.txt("x:b/", c("c_custkey")), v.txt("x:b/", c("c_custkey"), "/id")
    sites = table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("site")).distinct()
    isle = v.txt("x:isle/", c("site"))
    graph = v._all([
        v._t(old, b, VOCAB.c("P1_is_identified_by"), n), v._t(old, n, VOCAB.value, v.txt("C_BLDG_", c("c_custkey")), True),
        v._t(sites, isle, VOCAB.rdf_type, F.lit(VOCAB.onto("Island"))), v._t(sites, isle, VOCAB.label, c("site"), True)])
    outcomes, _ = B.create_buildings(lay, v.source_years(spark, sf), graph)
    return outcomes.select("base_id", "n_phases", "outcome")


# ---------------------------------------------------------------- diagnosis

@check(with_views("layer", "published") + """ SELECT DISTINCT site || '_' || kind AS "table", identifier FROM layer WHERE identifier NOT IN (SELECT identifier FROM published)""")
def missing_in_production(spark, sf):
    return D.missing_in_production(v.plain_layer(spark, sf), v.published(spark, sf))


@check(with_views("layer", "published") + " SELECT identifier FROM published EXCEPT SELECT identifier FROM layer")
def orphans_in_production(spark, sf):
    return D.orphans(v.published(spark, sf), v.plain_layer(spark, sf))


@check(with_views("published", "published_sources") + " SELECT identifier FROM published_sources EXCEPT SELECT identifier FROM published")
def orphan_sources(spark, sf):
    return D.orphans(v.published_sources(spark, sf), v.published(spark, sf))


@check(with_views("layer", "source_years") + """ SELECT source, 'not registered' AS problem FROM (SELECT source FROM layer EXCEPT SELECT source FROM source_years)
 UNION ALL SELECT source, 'not used' FROM (SELECT source FROM source_years EXCEPT SELECT source FROM layer)""")
def source_consistency(spark, sf):
    return D.source_consistency(v.plain_layer(spark, sf), v.source_years(spark, sf))


_COVER = """SELECT site, kind, op FROM (SELECT DISTINCT site, kind FROM layer), (VALUES ('insert'), ('update'), ('delete')) o(op)
 EXCEPT SELECT site, kind, op FROM registry"""


@check(with_views("registry") + " " + _COVER)
def coverage_audit(spark, sf):
    return D.coverage_audit(v.plain_layer(spark, sf), v.registry(spark, sf))


@check(with_views("registry") + " SELECT site, kind, op FROM registry UNION ALL (" + _COVER + ")")
def complete_registry(spark, sf):
    return D.complete_registry(v.plain_layer(spark, sf), v.registry(spark, sf)).table


def _rdf(spark, sf):
    """Labels the graph uses: ids of orders, without a suffix where finished, and suppliers with a typo; used by their nation."""
    own = table(spark, sf, "orders").join(table(spark, sf, "customer"), c("o_custkey") == c("c_custkey"))
    digit = F.substring("o_orderpriority", 1, 1)
    suffix = F.when(c("o_orderstatus").eqNullSafe("F") | (digit == "1"), "").otherwise(F.concat(F.lit("."), digit))
    a = own.select(v.txt("C_BLDG_", c("o_custkey"), suffix).alias("identifier"), v.txt("B", c("c_nationkey")).alias("building"))
    b = table(spark, sf, "supplier").select(v.txt("SUP ", c("s_suppkey")).alias("identifier"), v.txt("B", c("s_nationkey")).alias("building"))
    return a.unionByName(b).distinct()


_RDF = """, rdf AS (SELECT DISTINCT 'C_BLDG_' || o_custkey || CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' THEN '' ELSE '.' || left(o_orderpriority, 1) END AS identifier,
  'B' || c_nationkey AS building FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL
 SELECT 'SUP ' || s_suppkey, 'B' || s_nationkey FROM supplier)"""
_ISSUES = with_views("layer", "published", "published_sources", "source_years", "registry") + _RDF + """, issues AS (
 SELECT DISTINCT 'missing_from_production' AS category, site || '_' || kind AS "table", identifier AS item, CAST(NULL AS VARCHAR) AS detail FROM layer
  WHERE identifier NOT IN (SELECT identifier FROM published)
 UNION ALL SELECT 'orphaned_in_production', NULL, identifier, NULL FROM (SELECT identifier FROM published EXCEPT SELECT identifier FROM layer)
 UNION ALL SELECT 'orphaned_feature_sources', NULL, identifier, NULL FROM (SELECT identifier FROM published_sources EXCEPT SELECT identifier FROM published)
 UNION ALL SELECT DISTINCT 'source_name_mismatches', site || '_' || kind, source, 'source is not registered' FROM layer WHERE source NOT IN (SELECT source FROM source_years)
 UNION ALL SELECT 'missing_triggers', site || '_' || kind, op, NULL FROM (""" + _COVER + """)
 UNION ALL SELECT 'rdf_mismatches', regexp_extract(identifier, '^([A-Za-z]+_[A-Za-z]+)', 1), identifier, NULL FROM (SELECT identifier FROM rdf EXCEPT SELECT identifier FROM published))"""


def _issues(spark, sf):
    return D.diagnose(v.plain_layer(spark, sf), _state(spark, sf), v.registry(spark, sf), _rdf(spark, sf))


@check(_ISSUES + " SELECT * FROM issues")
def sync_diagnosis(spark, sf):
    return _issues(spark, sf)


@check(_ISSUES + """, u AS (SELECT DISTINCT category, CASE WHEN category IN ('orphaned_in_production', 'orphaned_feature_sources', 'source_name_mismatches')
  THEN coalesce("table", '') || '|' || item ELSE "table" END AS unit FROM issues)
 SELECT category, count(*) AS n FROM u GROUP BY ROLLUP (category)""")
def issue_totals(spark, sf):
    return D.issue_totals(_issues(spark, sf))


@check(with_views("layer", "published", "published_sources", "source_years", "registry") + """, acts AS (
 SELECT 'registry' AS step, site || '_' || kind || '_' || op AS item, 'inserted' AS outcome FROM (""" + _COVER + """)
 UNION ALL SELECT 'orphaned features', identifier, 'deleted' FROM (SELECT identifier FROM published EXCEPT SELECT identifier FROM layer)
 UNION ALL SELECT 'features', identifier, 'inserted' FROM (SELECT identifier FROM layer EXCEPT SELECT identifier FROM published)
 UNION ALL SELECT 'source years', source, 'inserted' FROM (SELECT source FROM layer EXCEPT SELECT source FROM source_years)
 UNION ALL SELECT 'feature sources', identifier || ' | ' || source, 'inserted' FROM (SELECT identifier, source FROM layer WHERE present EXCEPT SELECT identifier, source FROM published_sources)
 UNION ALL SELECT 'orphaned sources', identifier || ' | ' || source, 'deleted' FROM published_sources WHERE identifier NOT IN (SELECT identifier FROM layer))
 SELECT * FROM acts""")
def sync_repair_actions(spark, sf):
    """Every change a repair makes, as a dry run."""
    return D.repair(v.layer(spark, sf), _state(spark, sf), v.registry(spark, sf), drop_orphans=True, dst_srid=None)[2]


@check(with_views("layer") + " SELECT count(*) FILTER (WHERE identifier IS NULL) AS n FROM layer")
def diagnosis_after_repair(spark, sf):
    """A repaired state has no findings left."""
    lay = v.plain_layer(spark, sf).withColumn("srid", F.lit(3857)).withColumn("geometry", F.lit("G"))
    state, reg, _ = D.repair(lay, _state(spark, sf), v.registry(spark, sf), drop_orphans=True, dst_srid=None)
    return D.diagnose(lay, state, reg).agg(F.count("*").alias("n"))


_MIS = with_views("layer", "published") + _RDF + """, ids AS (SELECT identifier FROM layer UNION SELECT identifier FROM published UNION SELECT identifier FROM rdf),
 m AS (SELECT identifier, identifier IN (SELECT identifier FROM layer) AS in_layer, identifier IN (SELECT identifier FROM published) AS in_production,
  identifier IN (SELECT identifier FROM rdf) AS in_rdf, building FROM ids LEFT JOIN rdf USING (identifier))"""


@check(_MIS + " SELECT * FROM m")
def identifier_mismatches(spark, sf):
    return R.identifier_mismatches(v.plain_layer(spark, sf), v.published(spark, sf), _rdf(spark, sf))


@check(_MIS + """ SELECT * FROM (SELECT *, CASE WHEN in_rdf AND NOT in_production THEN CASE WHEN in_layer THEN 'rdf only, in layer' ELSE 'rdf only' END
 WHEN in_layer AND NOT in_production THEN 'missing from production' WHEN in_production AND NOT in_layer THEN 'extra in production' END AS problem FROM m)
 WHERE problem IS NOT NULL""")
def mismatch_kinds(spark, sf):
    return R.mismatch_kinds(R.identifier_mismatches(v.plain_layer(spark, sf), v.published(spark, sf), _rdf(spark, sf)))


@check(with_views("layer") + """, ids AS (SELECT DISTINCT site, identifier FROM layer), k AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY identifier) AS r FROM ids)
 SELECT site, count(*) AS n, string_agg(identifier, ', ' ORDER BY identifier) FILTER (WHERE r <= 5) AS sample FROM k GROUP BY site""")
def layer_counts(spark, sf):
    return R.layer_counts(v.plain_layer(spark, sf))


@check("""SELECT n_name AS prefix, count(*) AS n FROM (SELECT 'NATION_' || c_nationkey || '_' || c_custkey AS identifier FROM customer)
 JOIN nation ON starts_with(identifier, n_name || '_') OR starts_with(identifier, n_name) GROUP BY n_name""")
def production_counts(spark, sf):
    ids = table(spark, sf, "customer").select(v.txt("NATION_", c("c_nationkey"), "_", c("c_custkey")).alias("identifier"))
    return R.production_counts(ids, table(spark, sf, "nation").select(c("n_name").alias("prefix")))


@check("""SELECT n_name AS prefix, count(*) AS n FROM (SELECT CASE WHEN c_acctbal < 0 THEN 'NATION-' ELSE 'NATION_' END || c_nationkey || '_' || c_custkey AS identifier FROM customer)
 JOIN nation ON identifier LIKE n_name || '%' GROUP BY n_name""")
def production_counts_like(spark, sf):
    """The pattern meaning of `_` also counts ids that write another sign there."""
    ids = table(spark, sf, "customer").select(v.txt(F.when(c("c_acctbal") < 0, "NATION-").otherwise("NATION_"), c("c_nationkey"), "_", c("c_custkey")).alias("identifier"))
    return R.production_counts(ids, table(spark, sf, "nation").select(c("n_name").alias("prefix")), how="like")


@check("""SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS kinds FROM orders GROUP BY o_custkey""")
def ordered_list(spark, sf):
    """Distinct values of a small domain as one ordered text."""
    return table(spark, sf, "orders").select("o_custkey", "o_orderpriority").distinct().groupBy("o_custkey").agg(
        F.expr("listagg(o_orderpriority, ', ') WITHIN GROUP (ORDER BY o_orderpriority)").alias("kinds"))


_PREFIXES = ", ".join(f"('{s}', '{p}')" for s, p in __import__("chronogeo.schema", fromlist=["x"]).SITE_PREFIXES.items())


@check(f"""WITH pre AS (SELECT * FROM (VALUES {_PREFIXES}) t(site, prefix)), ids AS (SELECT DISTINCT CASE WHEN c_nationkey < 10 THEN 'sansecondo' ELSE 'lido' END AS site,
 CASE WHEN c_acctbal < 0 THEN 'SSC_BLDG ' ELSE 'SSC_BLDG_' END || c_custkey AS identifier FROM customer)
 SELECT site, identifier, CASE WHEN contains(identifier, ' ') THEN 'blank in identifier' WHEN NOT starts_with(identifier, prefix || '_') THEN 'wrong prefix' END AS problem
 FROM ids JOIN pre USING (site) WHERE contains(identifier, ' ') OR NOT starts_with(identifier, prefix || '_')""")
def identifier_format(spark, sf):
    ids = table(spark, sf, "customer").select(
        F.when(c("c_nationkey") < 10, "sansecondo").otherwise("lido").alias("site"),
        v.txt(F.when(c("c_acctbal") < 0, "SSC_BLDG ").otherwise("SSC_BLDG_"), c("c_custkey")).alias("identifier"))
    return R.identifier_format(ids, site_prefixes(spark))
