"""Queries for keyed state, walks and labels of hierarchies, many dates and windows at once, one form of a shape, and branches
that need odd rows: metadata of layers, empty geometries, missing keys and labels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from checks.feature_checks import _IV, _KIND_T, _KIND_Z, _PH, _RECT, _state
from checks.geo_checks import _IN, _WKT, BOX
from checks.graph_checks import _ANC, _NODE_LABEL, _PATHS, _links, _uuid
from checks.registry import ORACLE, check
from checks.stream_checks import _LINKS, _REPLAY, _folder, feed_of
from checks.views import RANGE_END, RANGE_START, c, table, with_views
from chronogeo import schema
from chronogeo.functions import ewkb as W
from chronogeo.functions import geometry as G
from chronogeo.operators import features as M
from chronogeo.operators import geo, hierarchy, skew, spatial
from chronogeo.operators import periods as P
from chronogeo.plans import archive as A
from chronogeo.plans import buildings as B
from chronogeo.plans import diagnosis as D
from chronogeo.plans import publish as U
from chronogeo.plans import reports as R
from chronogeo.plans import terms as S
from chronogeo.schema import VOCAB as V
from chronogeo.sources import readers, writers
from chronogeo.streaming import stateful

# ---------------------------------------------------------------- keyed state


def _stateful(spark, sf):
    """Edits in four files by number, which arrive in another order: every slice but one is late or has late ones behind it."""
    log = _folder(spark)
    edits = v.edits(spark, sf)
    feed, files = feed_of(spark, edits, order=lambda i: (i % 2 == 0, i))
    stream = spark.readStream.schema(edits.schema).option("maxFilesPerTrigger", files).parquet(feed)
    features, sources = v.edit_features(spark, sf), v.edit_sources(spark, sf)
    stateful.start(stream, features, sources, log, _folder(spark)).awaitTermination()
    return stateful.tables(spark, log, features, sources)


@check(_REPLAY + " SELECT identifier, t, z, name, geometry FROM fin")
def stateful_features(spark, sf):
    return _stateful(spark, sf)[0]


@check(_REPLAY + _LINKS + " SELECT identifier, source FROM new_links UNION SELECT identifier, 'Today' FROM edit_features")
def stateful_sources(spark, sf):
    return _stateful(spark, sf)[1]


# ---------------------------------------------------------------- hierarchies

@check(with_views("tree", recursive=True) + """, up AS (SELECT k, ['x:arch/' || k] AS path FROM tree WHERE k = 0
 UNION ALL SELECT t.k, list_append(up.path, 'x:arch/' || t.k) FROM tree t JOIN up ON t.parent = up.k WHERE t.k > 0),
 ranked AS (SELECT path, len(path) - 1 AS depth, row_number() OVER (ORDER BY path) - 1 AS r FROM up),
 below AS (SELECT node, count(*) AS n FROM (SELECT unnest(path) AS node FROM up) GROUP BY node)
 SELECT node, 2 * r - depth AS enter, 2 * r - depth + 2 * n - 1 AS exit, CAST(depth AS INT) AS depth FROM ranked JOIN below ON node = path[len(path)]""")
def order_labels(spark, sf):
    """Entry and exit numbers of the whole archive tree."""
    return hierarchy.order_labels(_links(spark, sf))


@check(_ANC + """, n AS (SELECT o, count(*) AS below FROM up GROUP BY o) SELECT 'x:arch/' || o AS node, below FROM n""")
def nodes_below(spark, sf):
    """How many nodes are below each one, itself included: a difference of its two numbers, no pairs."""
    return hierarchy.order_labels(_links(spark, sf)).select("node", F.expr("(exit - enter + 1) div 2").alias("below"))


@check(_ANC + " SELECT 'x:arch/' || s AS s, 'x:arch/' || o AS o, depth FROM up JOIN part ON p_partkey = s WHERE p_type = 'PROMO'")
def ancestors_of_asked(spark, sf):
    """Promoted parts walk up; the rest of the tree is not touched."""
    asked = table(spark, sf, "part").filter("p_type = 'PROMO'").select(v.txt("x:arch/", c("p_partkey")).alias("s"))
    return hierarchy.ancestors_of(_links(spark, sf), asked)


@check(_ANC + " SELECT 'x:arch/' || s AS s, 'x:arch/' || o AS o, CAST(depth + 1 AS BIGINT) AS n FROM up")
def way_counts(spark, sf):
    from chronogeo.operators import graph
    links = _links(spark, sf)
    return hierarchy.way_counts(graph.closure(links, acyclic=True), links)


@check(_PATHS + " SELECT 'x:arch/' || s AS s, item_label FROM pth JOIN part ON p_partkey = s WHERE p_size < 10")
def item_paths_asked(spark, sf):
    asked = table(spark, sf, "part").filter("p_size < 10").select(v.txt("x:arch/", c("p_partkey")).alias("s"))
    return A.item_paths(_links(spark, sf), A.class_labels(v.stored(spark, sf, v.archive_graph)), asked)


@check("""WITH p AS (SELECT p_partkey AS k, p_partkey // 1000 AS block, 'N' || p_partkey AS label FROM part),
 t AS (SELECT k, string_agg(label, ', ') OVER (PARTITION BY block ORDER BY k) AS path FROM p) SELECT 'x:c/' || k AS s, md5(path) AS path, CAST(length(path) AS INT) AS n FROM t""")
def chain_paths(spark, sf):
    """Chains of a thousand nodes, each below the one before it."""
    p = table(spark, sf, "part").select(c("p_partkey").cast("long").alias("k"))
    rows = p.withColumn("first", F.min("k").over(Window.partitionBy(F.expr("k div 1000"))))
    node, label = v.txt("x:c/", c("k")), v.txt("N", c("k"))
    roots = rows.filter("k = first").select(node.alias("s"), label.alias("path"))
    links = rows.filter("k > first").select(node.alias("s"), v.txt("x:c/", c("k") - 1).alias("o"))
    out = A.extend_paths(roots, links, rows.select(node.alias("s"), label.alias("label")))
    return out.select("s", F.md5("path").alias("path"), F.length("path").alias("n"))


@check(with_views("tree") + " SELECT 'x:arch/' || k AS s, CASE WHEN p_size < 25 THEN " + _NODE_LABEL + " ELSE CAST(k AS VARCHAR) END AS label FROM tree")
def path_labels_tail(spark, sf):
    """Large parts have lost their labels: the last part of the IRI stands for them."""
    g = v.stored(spark, sf, v.archive_graph)
    bare = table(spark, sf, "part").filter("p_size >= 25").select(v.txt("x:arch/", c("p_partkey")).alias("s"))
    rest = g.filter(c("p") != V.label).unionByName(g.filter(c("p") == V.label).join(bare, "s", "left_anti").select(*g.columns))
    return A.path_labels(rest, A.archive_subjects(rest))


_KINDS = ["event", "group", "person", "primary_source", "secondary_source"]


@check(" UNION ALL ".join(f"SELECT '{k}' AS kind, count(DISTINCT item) AS items, count(*) AS terms FROM ({ORACLE['search_terms_' + k]})" for k in _KINDS))
def search_term_summary_all(spark, sf):
    """Summary of a run over a graph with all five kinds."""
    views = (v.event_graph, v.group_graph, v.person_graph, v.source_graph, v.book_graph)
    return S.run_all(v._all([v.stored(spark, sf, g) for g in views]))[1]


# ---------------------------------------------------------------- many dates, many windows, one form

_MONTHS = "SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem"


@check(with_views("poly") + f""" SELECT date, layer, count(*) AS n, CAST(sum(identifier) AS BIGINT) AS ids FROM poly JOIN ({_MONTHS}) ON bob <= date AND (eoe IS NULL OR eoe > date) GROUP BY ALL""")
def as_of_dates(spark, sf):
    """What is valid on the first of every month."""
    months = table(spark, sf, "lineitem").select(F.trunc("l_shipdate", "month").cast("date").alias("date")).distinct()
    found = M.as_of_dates(v.polygons(spark, sf).select("identifier", "layer", "bob", "eoe"), months)
    return found.groupBy("date", "layer").agg(F.count("*").alias("n"), F.sum("identifier").alias("ids"))


@check(with_views("poly_m") + """, w AS (SELECT c_custkey AS window, c_custkey - 10 AS x0, c_custkey * 10 AS y0, c_custkey + 30 + c_nationkey * 8 AS x1, c_custkey * 10 + 900 AS y1 FROM customer)
 SELECT "window", count(*) AS n, CAST(sum(identifier) AS BIGINT) AS ids FROM w JOIN poly_m ON min_x >= x0 AND max_x <= x1 AND min_y >= y0 AND max_y <= y1 GROUP BY ALL""")
def windows_by_cell(spark, sf):
    """One window per customer over all polygons."""
    cu = table(spark, sf, "customer")
    x, y = c("c_custkey"), c("c_custkey") * 10
    windows = cu.select(x.alias("window"), (x - 10).cast("double").alias("x0"), y.cast("double").alias("y0"),
                        (x + 30 + c("c_nationkey") * 8).cast("double").alias("x1"), (y + 900).cast("double").alias("y1"))
    found = spatial.join_windows(v.shapes(spark, sf).select("identifier", "geom"), windows)
    return found.groupBy("window").agg(F.count("*").alias("n"), F.sum("identifier").alias("ids"))


@check(with_views("poly_m") + f" SELECT identifier FROM poly_m WHERE {_IN}")
def window_of_stored_layer(spark, sf):
    """A layer stored along the curve; one window of it."""
    path = _folder(spark)
    spatial.write_by_place(v.shapes(spark, sf).select("identifier", "geom"), path, 64.0)
    return spatial.read_window(spark, path, BOX).select("identifier")


@check(with_views("poly") + " SELECT identifier, true AS turned, false AS moved FROM poly")
def geometry_digest(spark, sf):
    """Rings that begin elsewhere, run the other way and are listed backwards are the same shape; a moved one is not."""
    turn = lambda r: F.concat(F.slice(r, 3, 3), F.slice(r, 2, 2))  # noqa: E731 - closed boxes of five vertices
    turned = F.reverse(F.transform(c("geom"), lambda p: F.transform(p, lambda r: F.reverse(turn(r)))))
    moved = F.transform(c("geom"), lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.struct((q["x"] + 1).alias("x"), q["y"].alias("y")))))
    rows = v.shapes(spark, sf).select("identifier", G.geometry_digest(c("geom")).alias("d"), G.geometry_digest(turned).alias("t"), G.geometry_digest(moved).alias("m"))
    return rows.select("identifier", (c("d") == c("t")).alias("turned"), (c("d") == c("m")).alias("moved"))


@check(with_views("poly") + f""" SELECT identifier, CASE identifier % 4 WHEN 1 THEN NULL WHEN 2 THEN 'MULTIPOLYGON EMPTY' ELSE {_WKT} END AS wkt,
 CASE WHEN identifier % 4 = 1 THEN NULL WHEN identifier % 8 >= 4 THEN 0 ELSE srid END AS srid FROM poly""")
def ewkb_odd_rows(spark, sf):
    """No system, no geometry, an empty one; and a part of the rows in batches of nothing else."""
    k = c("identifier")
    geom = F.when(k % 4 == 1, None).when(k % 4 == 2, F.from_json(F.lit("[]"), G.GEOMETRY_TYPE)).otherwise(c("geom"))
    srid = F.when(k % 8 >= 4, F.when(k % 16 >= 8, 0)).otherwise(c("srid"))
    rows = v.shapes(spark, sf).select("identifier", geom.alias("geom"), srid.cast("int").alias("srid")).repartition(16, k % 16)
    out = rows.select("identifier", W.encode_ewkb(c("geom"), c("srid")).alias("hex"))
    return out.select("identifier", G.to_wkt(W.decode_ewkb(c("hex"))).alias("wkt"), W.ewkb_srid(c("hex")).alias("srid"))


# ---------------------------------------------------------------- layers and tables

@check("""SELECT 'C_' || c_custkey AS identifier, c_name AS name, f AS source, CASE f WHEN 'Today' THEN c_acctbal < 0 ELSE c_nationkey % 2 = 1 END AS present
 FROM customer, (VALUES ('Today'), ('1982: Ortofoto')) x(f)""")
def layer_metadata(spark, sf):
    """A layer with ids, floors and names: its two flags, one of them numbers, and nothing else are sources."""
    wide = table(spark, sf, "customer").select(
        v.txt("C_", c("c_custkey")).alias("identifier"), c("c_custkey").cast("long").alias("id"), (c("c_nationkey") % 4).cast("int").alias("floors"), F.lit("G").alias("geometry"),
        c("c_name").alias("name"), (c("c_acctbal") < 0).alias("Today"), (c("c_nationkey") % 2).cast("int").alias("1982: Ortofoto"))
    path = _folder(spark)
    wide.write.parquet(f"{path}/qgis_south_buildings")
    return readers.read_layers(spark, path, sources=schema.SOURCE_ORDER).select("identifier", "name", "source", "present")


@check("""SELECT 'C_' || c_custkey AS identifier, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_nationkey % 3 > 0 THEN c_nationkey % 3 = 1 END AS y1982,
 c_acctbal < 0 AS y2019, CASE WHEN c_nationkey % 3 = 0 AND c_nationkey > 9 THEN 1 ELSE 0 END AS bad FROM customer""")
def layer_tab_metadata(spark, sf):
    """A tab file with ids and names; empty flags stay apart from 0, and texts that are no flag are counted."""
    path, n = _folder(spark), c("c_nationkey")
    rows = table(spark, sf, "customer").select(
        v.txt("C_", c("c_custkey")).alias("identifier"), c("c_custkey").alias("id"), c("c_name").alias("name"),
        F.when(n % 3 > 0, (n % 3 == 1).cast("int").cast("string")).when(n > 9, "maybe").alias("y1982"), (c("c_acctbal") < 0).alias("y2019"))
    writers.write_layer_tsv(rows, path)
    return readers.read_layer_tsv(spark, path, unreadable="bad")


@check("""SELECT 'x' || c_custkey AS k, 'old' AS a FROM customer WHERE c_nationkey < 5 UNION ALL
 SELECT 'x' || c_custkey, 'new' FROM customer WHERE c_nationkey >= 5 AND c_acctbal >= 0""")
def insert_without_key(spark, sf):
    """Rows without a key are not inserted, and known ones stay."""
    cu = table(spark, sf, "customer")
    old = cu.filter("c_nationkey < 5").select(v.txt("x", c("c_custkey")).alias("k"), F.lit("old").alias("a"))
    rows = cu.select(F.when(c("c_acctbal") >= 0, v.txt("x", c("c_custkey"))).alias("k"), F.lit("new").alias("a"))
    return M.insert_missing(old, rows, ["k"]).table


_SCHEMAS = "SELECT '{t}' AS \"table\", CAST(row_number() OVER () AS INT) AS ordinal, column_name AS \"column\", replace(replace(lower(column_type), 'varchar', 'string'), 'integer', 'int') AS type FROM (DESCRIBE {t})"


@check(" UNION ALL ".join(_SCHEMAS.format(t=t) for t in ("nation", "customer", "documents", "labels")))
def layer_columns(spark, sf):
    return P.table_columns({t: table(spark, sf, t) for t in ("nation", "customer", "documents", "labels")})


@check(with_views("layer") + ", seed(source, s, e) AS (VALUES " + ", ".join(f"('{s}', {a}, {b})" for s, a, b in schema.SOURCE_YEAR_ROWS) + f""")
 SELECT source, s AS start_year, e AS end_year FROM seed UNION ALL SELECT source, {RANGE_START.format(c="source")}, {RANGE_END.format(c="source")}
 FROM (SELECT DISTINCT source FROM layer WHERE source NOT IN (SELECT source FROM seed))""")
def register_over_seed(spark, sf):
    """The first rows of the dimension, and every source of the layers that they lack."""
    out = M.register_sources(v.plain_layer(spark, sf), schema.source_years_seed(spark)).table
    return out.select("source", c("start").alias("start_year"), c("end").alias("end_year"))


@check("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey AS DOUBLE) END AS width, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS bad FROM orders""")
def contract_unreadable(spark, sf):
    """Numbers kept as text: those that are none are NULL, and counted."""
    text = F.when(c("o_orderkey") % 3 == 0, v.txt("ca. ", c("o_custkey"))).otherwise(c("o_custkey").cast("string"))
    rows = table(spark, sf, "orders").select(c("o_orderkey").alias("id"), text.alias("width"))
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("width", T.DoubleType())])
    return P.apply_contract(rows, contract, unreadable="bad")


# ---------------------------------------------------------------- publishing, repair, reports

_FEATURES = f"""SELECT identifier, 'Buildings' AS t, 1 AS z, 'old' AS name, 'G0' AS geometry FROM published UNION ALL
 SELECT DISTINCT identifier, {_KIND_T}, {_KIND_Z}, name, {_RECT} FROM layer l WHERE NOT EXISTS (SELECT 1 FROM published p WHERE p.identifier = l.identifier)"""
_YEARS_AFTER = f"""SELECT source, start_y, end_y FROM source_years UNION ALL SELECT source, {RANGE_START.format(c="source")}, {RANGE_END.format(c="source")}
 FROM (SELECT DISTINCT source FROM layer WHERE source NOT IN (SELECT source FROM source_years))"""
_ALL_VIEWS = with_views("layer", "published", "published_sources", "source_years")


def _update(spark, sf):
    return U.update_state(v.layer(spark, sf), _state(spark, sf), dst_srid=None)


@check(_ALL_VIEWS + f""" SELECT 'feature' AS target, identifier AS key, t || ' ' || z || ' ' || name || ' ' || geometry AS value FROM ({_FEATURES})
 UNION ALL SELECT 'link', identifier, source FROM (SELECT identifier, source FROM published_sources UNION SELECT identifier, source FROM layer WHERE present)
 UNION ALL SELECT 'source', source, start_y || ' ' || end_y FROM ({_YEARS_AFTER})""")
def published_state(spark, sf):
    """All three tables after publishing all layers."""
    state = _update(spark, sf).state
    row = lambda df, target, key, *value: df.select(F.lit(target).alias("target"), F.col(key).alias("key"), F.concat_ws(" ", *value).alias("value"))
    return (row(state.features, "feature", "identifier", "t", "z", "name", "geometry").unionByName(row(state.feature_sources, "link", "identifier", "source"))
            .unionByName(row(state.source_years, "source", "source", "start", "end")))


@check(_ALL_VIEWS + f""" SELECT 'features' AS target, count(*) AS rows, count(*) FILTER (WHERE name <> 'old') AS inserted FROM ({_FEATURES})
 UNION ALL SELECT 'feature_sources', (SELECT count(*) FROM (SELECT identifier, source FROM published_sources UNION SELECT identifier, source FROM layer WHERE present)),
  (SELECT count(*) FROM (SELECT identifier, source FROM layer WHERE present EXCEPT SELECT identifier, source FROM published_sources))
 UNION ALL SELECT 'source_years', (SELECT count(*) FROM ({_YEARS_AFTER})), (SELECT count(DISTINCT source) FROM layer WHERE source NOT IN (SELECT source FROM source_years))""")
def commit_counts(spark, sf):
    """Rows and new rows of the three tables, counted while they are written."""
    return U.commit(_update(spark, sf), _folder(spark))[1]


@check(with_views("poly_m") + """ SELECT 'B_' || identifier AS identifier, CASE WHEN identifier % 7 = 0 THEN NULL ELSE round(CAST(area AS DOUBLE), 2) END AS area FROM poly_m""")
def repaired_geometry(spark, sf):
    """Published shapes are out of date; the repair takes those of the layers, which come in three systems and an unknown one."""
    from checks.edge_checks import _mixed
    rows = _mixed(spark, sf).select(F.lit("x").alias("site"), F.lit("buildings").alias("kind"), "identifier", c("identifier").alias("name"), "srid", "geometry",
                                    F.lit("Today").alias("source"), F.lit(True).alias("present"))
    old = rows.select("identifier", F.lit("Buildings").alias("t"), F.lit(1).alias("z"), "name", F.lit("MULTIPOLYGON(((0 0,1 0,1 1,0 0)))").alias("geometry"))
    state = U.State(old, rows.select("identifier", "source"), schema.source_years_seed(spark))
    registry = rows.select("site", "kind").distinct().withColumn("op", F.lit("insert"))
    fixed = D.repair(rows, state, registry, update_geometry=True)[0].features
    return geo.with_measures(fixed.withColumn("geom", G.parse_wkt(c("geometry")))).select("identifier", (F.round("area", 2) + 0.0).alias("area"))


@check(ORACLE["mismatch_kinds"].replace("SELECT * FROM (SELECT *, CASE WHEN in_rdf", "SELECT *, row_number() OVER (ORDER BY identifier, building) AS place FROM (SELECT *, CASE WHEN in_rdf"))
def mismatch_list(spark, sf):
    """The list of mismatches in order."""
    from checks.feature_checks import _rdf
    found = R.mismatch_kinds(R.identifier_mismatches(v.plain_layer(spark, sf), v.published(spark, sf), _rdf(spark, sf)))
    return R.ordered(found.withColumn("_last", c("building").isNull()), ["identifier", "_last", "building"]).drop("_last")


def _iri(kind: str, *key: str) -> str:
    literal = f"'{kind}'"
    return f"'{V.base}{kind}/' || {_uuid(literal, *key)}"


def _building_rows(heads: str, phases: str) -> str:
    """SQL of the triples of buildings (base_id, island) and phases (base_id, identifier, bob, eoe)."""
    iri = lambda x: f"'{x}'"
    of_building = [("b", V.rdf_type, iri(V.onto("Building")), "iri"), ("b", V.label, "'House'", "literal"), ("b", V.c("P53_has_former_or_current_location"), "island", "iri"),
                   ("b", V.c("P196i_is_defined_by"), "ch", "iri"), ("i", V.rdf_type, iri(V.c("E42_Identifier")), "iri"), ("i", V.value, "base_id", "literal"),
                   ("b", V.c("P1_is_identified_by"), "i", "iri"), ("ch", V.rdf_type, iri(V.c("E92_Spacetime_Volume")), "iri")]
    of_phase = [("ch", V.c("P166i_had_presence"), "pr", "iri"), ("pr", V.rdf_type, iri(V.c("E93_Presence")), "iri"), ("pr", V.c("P4_has_time-span"), "ti", "iri"),
                ("pr", V.c("P138i_has_representation"), "re", "iri"), ("ti", V.rdf_type, iri(V.c("E52_Time-Span")), "iri"),
                ("ti", V.c("P82a_begin_of_the_begin"), "bob || '-01-01'", "date"), ("ti", V.c("P82b_end_of_the_end"), "eoe || '-12-31'", "date"),
                ("re", V.c("P2_has_type"), iri(V.onto("2d_representation")), "iri"), ("re", V.label, "identifier", "literal")]
    rows = [f"SELECT {s} AS s, '{p}' AS p, {o} AS o, '{'iri' if k == 'iri' else 'literal'}' AS o_type, "
            f"CAST({iri(V.xsd_date) if k == 'date' else 'NULL'} AS VARCHAR) AS dtype FROM {t}"
            for t, some in (("bu", of_building), ("st", of_phase)) for s, p, o, k in some]
    literal = "'identifier'"
    return f""", bu0 AS (SELECT *, {_iri('builtwork', 'base_id')} AS b, {_iri('physical_changes', 'base_id')} AS ch FROM ({heads})),
 bu AS (SELECT *, b || '/identifier/' || {_uuid(literal, 'base_id')} AS i FROM bu0),
 st0 AS (SELECT *, {_iri('physical_changes', 'base_id')} AS ch, {_iri('presence', 'base_id', 'identifier')} AS pr, {_iri('timespan', 'base_id', 'identifier')} AS ti FROM ({phases})),
 st AS (SELECT *, pr || '/2drepresentation/' || {_uuid("'2drepresentation'", 'base_id', 'identifier')} AS re FROM st0)
 SELECT * FROM ({' UNION ALL '.join(rows)}) WHERE o IS NOT NULL"""


@check(_IV + _building_rows("SELECT DISTINCT base_id, 'x:isle/1' AS island FROM ph", "SELECT base_id, identifier, bob, eoe FROM iv"))
def building_triples_whole(spark, sf):
    heads, phases = B.building_phases(v.plain_layer(spark, sf), v.source_years(spark, sf))
    return B.building_triples(heads.withColumn("island", F.lit("x:isle/1")), phases).select("s", "p", "o", "o_type", "dtype")


_NEW = "base_id NOT IN (SELECT 'C_BLDG_' || c_custkey FROM customer WHERE c_nationkey < 5)"


@check(_IV + _building_rows(f"SELECT DISTINCT base_id, 'x:isle/' || lower(c_mktsegment) AS island FROM ph JOIN customer ON base_id = 'C_BLDG_' || c_custkey WHERE {_NEW}",
                            f"SELECT base_id, identifier, bob, eoe FROM iv WHERE {_NEW}"))
def created_building_triples(spark, sf):
    """The triples of the buildings that the graph lacks, each on the island of its site."""
    lay = v.plain_layer(spark, sf)
    old = table(spark, sf, "customer").filter("c_nationkey < 5")
    b, n = v.txt("x:b/", c("c_custkey")), v.txt("x:b/", c("c_custkey"), "/id")
    sites = table(spark, sf, "customer").select(F.lower("c_mktsegment").alias("site")).distinct()
    isle = v.txt("x:isle/", c("site"))
    graph = v._all([v._t(old, b, V.c("P1_is_identified_by"), n), v._t(old, n, V.value, v.txt("C_BLDG_", c("c_custkey")), True),
                    v._t(sites, isle, V.rdf_type, F.lit(V.onto("Island"))), v._t(sites, isle, V.label, c("site"), True)])
    return B.create_buildings(lay, v.source_years(spark, sf), graph)[1].select("s", "p", "o", "o_type", "dtype")
