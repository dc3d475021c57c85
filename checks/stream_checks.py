"""Change propagation and storage round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import check
from checks.views import c, table, with_views
from chronogeo.functions import geometry as G
from chronogeo.operators import skew
from chronogeo.schema import VOCAB
from chronogeo.session import scratch_root
from chronogeo.sources import readers, snapshots, writers
from chronogeo.streaming import propagate as K


def _folder(spark) -> str:
    return f"{scratch_root(spark)}/checks/{uuid.uuid4().hex}"


# the state before and after each edit, replayed in order by plain windows
_STEPS = """, turns AS (SELECT *, last_value(CASE WHEN op <> 'U' THEN op END IGNORE NULLS) OVER
  (PARTITION BY identifier ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM edits),
 o AS (SELECT *, coalesce(prev = 'I', identifier IN (SELECT identifier FROM edit_features)) AS alive FROM turns),
 outc AS (SELECT identifier, seq, op, name, geometry, value, event_type, CASE WHEN op = 'I' THEN CASE WHEN alive THEN 'rejected' ELSE 'applied' END WHEN alive THEN 'applied' ELSE 'noop' END AS outcome FROM o),
 done AS (SELECT identifier, max(seq) FILTER (WHERE op IN ('I', 'D') AND outcome = 'applied') AS last_turn,
  max_by(op, seq) FILTER (WHERE op IN ('I', 'D') AND outcome = 'applied') AS last_op, max_by(name, seq) FILTER (WHERE op = 'I' AND outcome = 'applied') AS new_name,
  max_by(event_type, seq) FILTER (WHERE op = 'I' AND outcome = 'applied') AS new_kind FROM outc GROUP BY identifier),
 geo AS (SELECT identifier, max_by(geometry, seq) FILTER (WHERE op IN ('I', 'U') AND outcome = 'applied') AS g FROM outc GROUP BY identifier),
 fin AS (SELECT coalesce(e.identifier, d.identifier) AS identifier,
  CASE WHEN last_op = 'I' THEN CASE WHEN new_kind = 'signup' THEN 'Buildings' ELSE 'Island' END ELSE 'Buildings' END AS t,
  CASE WHEN last_op = 'I' AND new_kind <> 'signup' THEN 0 ELSE 1 END AS z,
  CASE WHEN last_op = 'I' THEN new_name ELSE e.name END AS name, coalesce(geo.g, 'g-old') AS geometry
  FROM edit_features e FULL JOIN done d ON d.identifier = e.identifier LEFT JOIN geo ON geo.identifier = coalesce(e.identifier, d.identifier)
  WHERE coalesce(last_op, CASE WHEN e.identifier IS NOT NULL THEN 'I' ELSE 'D' END) <> 'D')"""
_REPLAY = with_views("edits", "edit_features") + _STEPS
_WIRED = "CASE op WHEN 'D' THEN site <> 'S0' WHEN 'U' THEN site <> 'S1' ELSE site <> 'S2' OR event_type = 'signup' END"
_REPLAY_WIRED = with_views("edits", "edit_features") + f""", placed AS (SELECT *, 'S' || CAST(substr(identifier, 3) AS BIGINT) % 3 AS site FROM edits),
 wired AS (SELECT * FROM placed WHERE {_WIRED}), unwired AS (SELECT * FROM placed WHERE NOT {_WIRED})""" + _STEPS.replace("FROM edits)", "FROM wired)", 1)
_LINKS = """, new_links AS (SELECT DISTINCT identifier, unnest(CASE WHEN value >= 50 AND value < 100 THEN ['Today', '1982: Ortofoto'] WHEN value >= 50 THEN ['Today'] ELSE ['1982: Ortofoto'] END) AS source
 FROM outc WHERE op = 'I' AND outcome = 'applied')"""


@check(_REPLAY + " SELECT identifier, seq, op, outcome FROM outc")
def change_outcomes(spark, sf):
    return K.change_outcomes(v.edits(spark, sf), v.edit_features(spark, sf))


@check(_REPLAY + " SELECT identifier, t, z, name, geometry FROM fin")
def apply_changes_features(spark, sf):
    return K.apply_changes(v.edit_features(spark, sf), v.edit_sources(spark, sf), v.edits(spark, sf))[0]


@check(_REPLAY + _LINKS + " SELECT identifier, source FROM new_links UNION SELECT identifier, 'Today' FROM edit_features")
def apply_changes_sources(spark, sf):
    return K.apply_changes(v.edit_features(spark, sf), v.edit_sources(spark, sf), v.edits(spark, sf))[1]


@check(_REPLAY + """, new_links AS (SELECT DISTINCT identifier, CASE WHEN value < 100 THEN '1982: Ortofoto' ELSE 'Today' END AS source
 FROM outc WHERE op = 'I' AND outcome = 'applied') SELECT identifier, source FROM new_links UNION SELECT identifier, 'Today' FROM edit_features""")
def apply_changes_first(spark, sf):
    """One link per insert; only one of the two sources is in the order."""
    return K.apply_changes(v.edit_features(spark, sf), v.edit_sources(spark, sf), v.edits(spark, sf), mode="first", order=["1982: Ortofoto"])[1]


def _wiring(spark, sf):
    """Edits with a site, and a registry that lacks one operation for each site."""
    edits = v.edits(spark, sf).withColumn("site", v.txt("S", F.pmod(F.substring("identifier", 3, 20).cast("long"), F.lit(3))))
    ops = F.explode(F.array(*[F.lit(o) for o in K.OPS]))
    registry = edits.select("site", "kind").distinct().select("site", "kind", ops.alias("op"))
    return edits, registry.filter(~(((c("op") == "delete") & (c("site") == "S0")) | ((c("op") == "update") & (c("site") == "S1"))
                                    | ((c("op") == "insert") & (c("site") == "S2") & (c("kind") == "islands"))))


@check(_REPLAY_WIRED + " SELECT identifier, t, z, name, geometry FROM fin")
def apply_changes_wired(spark, sf):
    edits, registry = _wiring(spark, sf)
    return K.apply_changes(v.edit_features(spark, sf), v.edit_sources(spark, sf), edits, registry=registry)[0]


@check(_REPLAY_WIRED + " SELECT identifier, seq, op, outcome FROM outc UNION ALL SELECT identifier, seq, op, 'unwired' FROM unwired")
def change_outcomes_wired(spark, sf):
    edits, registry = _wiring(spark, sf)
    return K.apply_changes(v.edit_features(spark, sf), v.edit_sources(spark, sf), edits, registry=registry)[2]


def feed_of(spark, edits, order=None, rows=250_000):
    """(feed, files): edits as a file feed of four slices by number, each written as `files` files of about `rows` rows.

    `order` sorts the numbers of the slices. A micro-batch of `files` files is a slice.
    """
    feed = _folder(spark)
    limits = skew.order_limits(edits, "seq", 4)
    slices = edits.withColumn("slice", skew.chunk_of(c("seq"), limits))
    files = 1 + edits.count() // (rows * (len(limits) + 1))
    for i in sorted(range(len(limits) + 1), key=order):
        one = slices.filter(c("slice") == i).drop("slice")
        (one.coalesce(1) if files == 1 else one.repartition(files, "seq")).write.mode("append").parquet(feed)
    return feed, files


def _streamed(spark, sf):
    """Edits written as a file feed in four ordered slices, propagated one micro-batch per slice."""
    root = _folder(spark)
    edits = v.edits(spark, sf)
    K.init_tables(v.edit_features(spark, sf), v.edit_sources(spark, sf), root, buckets=8)
    feed, files = feed_of(spark, edits)
    stream = spark.readStream.schema(edits.schema).option("maxFilesPerTrigger", files).parquet(feed)
    query = K.start_propagation(stream, root, _folder(spark), buckets=8)
    query.awaitTermination()
    return K.read_tables(spark, root)


@check(_REPLAY + " SELECT identifier, t, z, name, geometry FROM fin")
def apply_changes_stream(spark, sf):
    return _streamed(spark, sf)[0].drop("bucket")


@check(_REPLAY + _LINKS + " SELECT identifier, source FROM new_links UNION SELECT identifier, 'Today' FROM edit_features")
def apply_changes_stream_sources(spark, sf):
    return _streamed(spark, sf)[1].drop("bucket")


@check(with_views("layer") + """ SELECT DISTINCT '000_test_create_id_' || site || '_' || kind AS identifier, true AS after_insert, true AS after_update, false AS after_delete FROM layer""")
def change_roundtrip(spark, sf):
    return K.change_roundtrip(v.plain_layer(spark, sf), v.edit_features(spark, sf), v.edit_sources(spark, sf))


@check("SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events")
def previous_in_group(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "value")
    return skew.previous_in_group(rows, "user_id", "event_id", "value", "previous").select("event_id", "previous")


@check("""SELECT event_id, last_value(CASE WHEN value >= 50 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM events""")
def last_state(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", F.when(c("value") >= 50, c("event_type")).alias("mark"))
    return skew.last_before(rows, "user_id", "event_id", "mark", "state").select("event_id", "state")


# ---------------------------------------------------------------- storage

@check("""SELECT 'C_' || c_custkey AS identifier, c_acctbal < 0 AS y1982, c_nationkey < 9 AS y2019, c_mktsegment AS geometry FROM customer""")
def layer_tab_file(spark, sf):
    path = _folder(spark)
    rows = table(spark, sf, "customer").select(
        v.txt("C_", c("c_custkey")).alias("identifier"), (c("c_acctbal") < 0).alias("y1982"), (c("c_nationkey") < 9).alias("y2019"), c("c_mktsegment").alias("geometry"))
    writers.write_layer_tsv(rows, path)
    return readers.read_layer_tsv(spark, path)


@check("""SELECT 'x:doc/' || doc_id AS s, text AS o, lang FROM documents UNION ALL SELECT 'x:doc/' || doc_id, 'x:src/' || source, NULL FROM documents""")
def quads_roundtrip(spark, sf):
    """Whole texts as tagged literals, written as lines and read back."""
    d = table(spark, sf, "documents")
    s = v.txt("x:doc/", c("doc_id"))
    from chronogeo.operators.graph import TRIPLE_COLUMNS, term
    rows = d.select(F.inline(F.array(
        term(s, VOCAB.label, c("text"), "literal", c("lang")), term(s, "x:from", v.txt("x:src/", c("source")), g=F.lit("x:g")))))
    path = _folder(spark)
    writers.write_nquads(rows.select(*TRIPLE_COLUMNS), path)
    return readers.read_nquads(spark, path).select("s", "o", "lang")


@check("SELECT 'x:src/' || source AS o, count(*) AS n FROM documents GROUP BY source")
def triples_by_predicate(spark, sf):
    """Triples stored by predicate: the pattern reads one folder."""
    d = table(spark, sf, "documents")
    s = v.txt("x:doc/", c("doc_id"))
    rows = v._all([v._t(d, s, "x:text", c("text"), True), v._t(d, s, "x:from", v.txt("x:src/", c("source")))])
    path = _folder(spark)
    writers.write_triples(rows, path)
    return readers.read_triples(spark, path).filter(c("p") == "x:from").groupBy("o").agg(F.count("*").alias("n"))


@check("""SELECT c_custkey AS k, c_mktsegment AS a FROM customer WHERE c_acctbal >= 0""")
def snapshot_versions(spark, sf):
    """The first of two versions, read back by number."""
    root = _folder(spark)
    rows = table(spark, sf, "customer").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("a"), "c_acctbal")
    first = snapshots.commit_snapshot(rows.filter("c_acctbal >= 0").drop("c_acctbal"), root)
    snapshots.commit_snapshot(rows.drop("c_acctbal"), root)
    return snapshots.read_snapshot(spark, root, first)


@check(with_views("layer", "source_years") + """ SELECT category, item FROM (
 SELECT 'not registered' AS category, source AS item FROM (SELECT source FROM layer EXCEPT SELECT source FROM source_years)
 UNION ALL SELECT 'not used', source FROM (SELECT source FROM source_years EXCEPT SELECT source FROM layer))""")
def issue_report_file(spark, sf):
    from chronogeo.plans import diagnosis as D
    found = D.source_consistency(v.plain_layer(spark, sf), v.source_years(spark, sf)).select(c("problem").alias("category"), c("source").alias("item"))
    path = _folder(spark)
    writers.write_issue_report(found, path)
    return spark.read.schema("item string, category string").json(path).select("category", "item")


@check(with_views("layer") + """ SELECT 'north' AS site, kind, identifier, flag AS source, bool_or(source = label AND present) AS present
 FROM layer JOIN (VALUES ('buildings', '1694:dis.22', '1995: F'), ('islands', '1982: Ortofoto', '1995: O'), ('openspaces', '1838: Cens', '1995-1996'),
  ('waterways', '1900: IGM', '1995:dis.7'), ('buildings', 'Today', 'Today'), ('islands', 'Today', 'Today'), ('openspaces', 'Today', 'Today'), ('waterways', 'Today', 'Today'))
  x(k, flag, label) ON k = kind GROUP BY ALL""")
def layer_folders(spark, sf):
    """Layers with different flag columns, one folder each, read in one scan; site and kind come from the path."""
    from chronogeo.operators import periods as P
    root = _folder(spark)
    lay = v.plain_layer(spark, sf)
    for kind, flag, match in (("buildings", "1694:dis.22", "1995: F"), ("islands", "1982: Ortofoto", "1995: O"),
                              ("openspaces", "1838: Cens", "1995-1996"), ("waterways", "1900: IGM", "1995:dis.7")):
        wide = P.to_wide(lay.filter(c("kind") == kind), ["identifier"], ["Today", match])
        wide.withColumnRenamed(match, flag).withColumn("geometry", F.lit("G")).write.parquet(f"{root}/qgis_north_{kind}")
    return readers.read_layers(spark, root).select("site", "kind", "identifier", "source", "present")
