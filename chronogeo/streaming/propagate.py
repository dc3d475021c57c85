"""Layer edits -> published tables, in batch and as a stream.

Edits are rows (op I/U/D, seq, kind, identifier, name, geometry, flags, srid).
Rules: an insert publishes a feature and one link per true flag, unless the
identifier exists; an update moves the geometry of an existing feature; a
delete removes the feature (its links only with `cascade`). With
`mode="first"` an insert publishes one link, the first true flag in `order`.
With a `registry` of (site, kind, op) only wired operations are propagated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chronogeo.functions import geometry as G
from chronogeo.operators.features import kind_value, place_in
from chronogeo.operators.skew import last_before, order_limits, previous_in_group
from chronogeo.schema import FEATURE_SOURCES, FEATURES
from chronogeo.sources import snapshots as S

FEATURE_COLUMNS = [f.name for f in FEATURES]
OPS = {"insert": "I", "update": "U", "delete": "D"}


def _in_registry(changes: DataFrame, registry: DataFrame, how: str) -> DataFrame:
    code = F.create_map(*[F.lit(x) for pair in OPS.items() for x in pair])
    wired = registry.select("site", "kind", code[F.col("op")].alias("op"))
    return changes.join(wired, ["site", "kind", "op"], how).select(*changes.columns)


def wired_edits(changes: DataFrame, registry: DataFrame) -> DataFrame:
    """Edits whose (site, kind, op) the registry holds; edits without a site or kind are not wired."""
    return _in_registry(changes, registry, "left_semi")


def unwired_edits(changes: DataFrame, registry: DataFrame) -> DataFrame:
    """The valid edits that the registry leaves out."""
    return _in_registry(changes.filter(F.col("identifier").isNotNull() & F.col("op").isin(*OPS.values())), registry, "left_anti")


def _prepared(changes: DataFrame, dst_srid: int | None) -> DataFrame:
    """Valid, distinct edits with published attributes."""
    geometry = F.col("geometry")
    if dst_srid is not None and "srid" in changes.columns:
        geometry = G.to_wkt(G.transform_by_srid(G.parse_wkt(geometry), F.col("srid"), dst_srid))
    return distinct_edits(changes).select(
        "identifier", "seq", "op",
        kind_value(F.col("kind"), "t").alias("t"), kind_value(F.col("kind"), "z").alias("z"),
        "name", geometry.alias("geometry"), "flags",
    )


def distinct_edits(changes: DataFrame) -> DataFrame:
    """One valid edit per (identifier, seq): of different ones the smallest row, wherever they are read."""
    valid = changes.filter(F.col("identifier").isNotNull() & F.col("op").isin("I", "U", "D"))
    rest = [f for f in valid.schema if f.name not in ("identifier", "seq")]
    order = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in rest]
    return valid.groupBy("identifier", "seq").agg(
        F.min_by(F.struct(*[f.name for f in rest]), F.struct(*order)).alias("_edit")).select("identifier", "seq", "_edit.*")


def fold_changes(changes: DataFrame, features: DataFrame, dst_srid: int | None = None) -> DataFrame:
    """Final row per edited identifier, `alive` false when it ends deleted.

    The order of edits is folded with combinable aggregates instead of a window:
    the last delete, the first insert behind it, and the last update behind that.
    So one identifier with a third of all edits is combined before the shuffle.
    """
    rows = _prepared(changes, dst_srid)
    existing = features.select("identifier", F.struct("t", "z", "name", "geometry").alias("_old"))
    row = F.struct("t", "z", "name", "geometry")
    first = rows.groupBy("identifier").agg(
        F.max(F.when(F.col("op") == "D", F.col("seq"))).alias("_last_d"),
        F.max_by(F.struct("seq", "geometry"), F.when(F.col("op") == "U", F.col("seq"))).alias("_last_u"),
    ).join(existing, "identifier", "left")
    inserts = rows.filter("op = 'I'").join(first.select("identifier", "_last_d"), "identifier")
    created = inserts.filter(F.col("_last_d").isNull() | (F.col("seq") > F.col("_last_d"))).groupBy("identifier").agg(
        F.min("seq").alias("_made"), F.min_by(row, "seq").alias("_new"))
    all_ = first.join(created, "identifier", "left")
    stays = F.col("_old").isNotNull() & F.col("_last_d").isNull()
    base = F.when(stays, F.col("_old")).otherwise(F.col("_new"))
    since = F.when(stays, F.lit(None).cast("long")).otherwise(F.col("_made"))
    moved = (F.col("_last_u.seq") > since) | (stays & F.col("_last_u").isNotNull())
    return all_.withColumn("_base", base).select(
        "identifier", F.col("_base.t").alias("t"), F.col("_base.z").alias("z"), F.col("_base.name").alias("name"),
        F.when(F.coalesce(moved, F.lit(False)), F.col("_last_u.geometry")).otherwise(F.col("_base.geometry")).alias("geometry"),
        F.col("_base").isNotNull().alias("alive"))


def turn_outcomes(changes: DataFrame, features: DataFrame, limits: list | None = None) -> DataFrame:
    """(identifier, seq, op, outcome) of inserts and deletes: applied, rejected or noop.

    Whether an identifier exists at an edit is decided by the insert or delete
    before it; that look-back is chunked, so no identifier is replayed in one task.
    """
    rows = _prepared(changes, None).select("identifier", "seq", "op").filter("op <> 'U'")
    turns = previous_in_group(rows, "identifier", "seq", "op", "_prev", limits=limits)
    known = features.select("identifier", F.lit(True).alias("_known"))
    before = F.coalesce(F.col("_prev") == "I", F.col("_known"), F.lit(False))
    outcome = (
        F.when(F.col("op") == "I", F.when(before, "rejected").otherwise("applied"))
        .otherwise(F.when(before, "applied").otherwise("noop")))
    return turns.join(known, "identifier", "left").select("identifier", "seq", "op", outcome.alias("outcome"))


def update_outcomes(changes: DataFrame, features: DataFrame, limits: list | None = None) -> DataFrame:
    """The same for updates: applied when the identifier exists at that point, else noop."""
    rows = _prepared(changes, None).select("identifier", "seq", "op")
    turned = rows.withColumn("_turn", F.when(F.col("op") != "U", F.struct("seq", "op")))
    state = last_before(turned, "identifier", "seq", "_turn", "_state", limits=limits).filter("op = 'U'")
    known = features.select("identifier", F.lit(True).alias("_known"))
    alive = F.coalesce(F.col("_state.op") == "I", F.col("_known"), F.lit(False))
    return state.join(known, "identifier", "left").select(
        "identifier", "seq", "op", F.when(alive, "applied").otherwise("noop").alias("outcome"))


def change_outcomes(changes: DataFrame, features: DataFrame, limits: list | None = None) -> DataFrame:
    """(identifier, seq, op, outcome) of every edit."""
    limits = order_limits(changes, "seq") if limits is None else limits
    return turn_outcomes(changes, features, limits).unionByName(update_outcomes(changes, features, limits))


def _last_deletes(changes: DataFrame) -> DataFrame:
    return changes.filter("op = 'D'").groupBy("identifier").agg(F.max("seq").alias("_last_d"))


def accepted_links(changes: DataFrame, outcomes: DataFrame, cascade: bool = False, mode: str = "all",
                   order: list[str] | None = None) -> DataFrame:
    """(identifier, source) of the true flags of accepted inserts; with `cascade` only of those still alive.

    With `first`, each insert gives one link: its first true flag in `order`, flags that are not listed last and by name.
    """
    if mode not in ("all", "first") or (mode == "first") != bool(order):
        raise ValueError("mode is 'all', or 'first' with an order of sources")
    accepted = outcomes.filter("op = 'I' and outcome = 'applied'").select("identifier", "seq")
    if cascade:
        accepted = accepted.join(_last_deletes(changes), "identifier", "left").filter(
            F.col("_last_d").isNull() | (F.col("seq") > F.col("_last_d"))).drop("_last_d")
    inserts = distinct_edits(changes).filter("op = 'I'").select("identifier", "seq", "flags").join(accepted, ["identifier", "seq"], "left_semi")
    true = F.map_keys(F.map_filter("flags", lambda _, present: present))
    if mode == "first":
        ranked = F.transform(true, lambda s: F.struct(place_in(order, s).alias("place"), s.alias("source")))
        links = inserts.select("identifier", F.array_min(ranked)["source"].alias("source")).filter("source IS NOT NULL")
    else:
        links = inserts.select("identifier", F.explode(true).alias("source"))
    return links.distinct()


def apply_changes(features: DataFrame, feature_sources: DataFrame, changes: DataFrame, cascade: bool = False,
                  dst_srid: int | None = None, mode: str = "all", order: list[str] | None = None,
                  registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features, feature_sources, outcomes) after a batch of edits.

    Edits that a `registry` leaves out change nothing and have the outcome `unwired`.
    """
    unwired = None
    if registry is not None:
        unwired = unwired_edits(changes, registry).select("identifier", "seq", "op", F.lit("unwired").alias("outcome"))
        changes = wired_edits(changes, registry)
    final = fold_changes(changes, features, dst_srid)
    untouched = features.join(final.select("identifier"), "identifier", "left_anti")
    new_features = untouched.select(*FEATURE_COLUMNS).unionByName(final.filter("alive").select(*FEATURE_COLUMNS))
    limits = order_limits(changes, "seq")
    links = accepted_links(changes, turn_outcomes(changes, features, limits), cascade, mode, order)
    kept = feature_sources.select("identifier", "source")
    if cascade:
        kept = kept.join(_last_deletes(changes).select("identifier"), "identifier", "left_anti")
    new_sources = kept.unionByName(links.join(kept, ["identifier", "source"], "left_anti"))
    outcomes = change_outcomes(changes, features, limits)
    return new_features, new_sources, outcomes if unwired is None else outcomes.unionByName(unwired)


# ---------------------------------------------------------------- stream

def init_tables(features: DataFrame, feature_sources: DataFrame, root: str, buckets: int = 64) -> None:
    """Write the starting tables in hash buckets of the identifier."""
    tables = {
        "features": features.select(*FEATURE_COLUMNS).withColumn("bucket", S.bucket_of("identifier", buckets)),
        "feature_sources": feature_sources.select("identifier", "source").withColumn("bucket", S.bucket_of("identifier", buckets)),
    }
    S.commit_buckets(tables, root, list(range(buckets)))


def read_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    now = S.current_state(spark, root)
    return (S.read_buckets(spark, now, "features", FEATURES), S.read_buckets(spark, now, "feature_sources", FEATURE_SOURCES))


def propagate_batch(changes: DataFrame, batch_id: int, root: str, buckets: int = 64, cascade: bool = False,
                    dst_srid: int | None = None, query: str | None = None, mode: str = "all",
                    order: list[str] | None = None, registry: DataFrame | None = None) -> None:
    """Apply one micro-batch to the buckets it touches.

    A batch that the log already has from the same `query` does nothing, so a
    replay is safe and a second stream on the same root is not mistaken for one.
    """
    spark = changes.sparkSession
    now = S.current_state(spark, root)
    if batch_id <= now.batches.get(query, -1):
        return
    bucket = S.bucket_of("identifier", buckets)
    changes = changes.filter("identifier is not null").persist()
    try:
        # at most `buckets` numbers reach the driver
        touched = sorted(r["b"] for r in changes.select(bucket.alias("b")).distinct().collect())
        features = S.read_buckets(spark, now, "features", FEATURES, touched)
        links = S.read_buckets(spark, now, "feature_sources", FEATURE_SOURCES, touched)
        new_features, new_links, _ = apply_changes(features, links, changes, cascade, dst_srid, mode, order, registry)
        S.commit_buckets({"features": new_features.withColumn("bucket", bucket),
                          "feature_sources": new_links.withColumn("bucket", bucket)}, root, touched, batch_id, now.version, query)
    finally:
        changes.unpersist()


def start_propagation(changes: DataFrame, root: str, checkpoint: str, buckets: int = 64, cascade: bool = False,
                      dst_srid: int | None = None, available_now: bool = True, mode: str = "all",
                      order: list[str] | None = None, registry: DataFrame | None = None) -> StreamingQuery:
    """Run the propagation on a stream of edits. One query serves all layers; its checkpoint folder names it in the log.

    A `registry` read from files is read again by every micro-batch, as of the files it had at the start.
    """
    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: propagate_batch(df, batch_id, root, buckets, cascade, dst_srid, checkpoint, mode, order, registry))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def probe_changes(layers: DataFrame) -> DataFrame:
    """Insert, update and delete of one probe row per layer, to check the wiring."""
    square = "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((2 2,3 2,3 3,2 3,2 2)))"
    moved = "MULTIPOLYGON(((0 0,2 0,2 2,0 2,0 0)))"
    steps = [("I", 1, square), ("U", 2, moved), ("D", 3, None)]
    rows = F.array(*[
        F.struct(F.lit(o).alias("op"), F.lit(n).cast("long").alias("seq"), F.lit(g).cast("string").alias("geometry"))
        for o, n, g in steps])
    empty = F.create_map(F.lit("Today"), F.lit(True))
    return layers.select("site", "kind").distinct().select("site", "kind", F.inline(rows)).select(
        "op", "seq", "kind", F.concat(F.lit("000_test_create_id_"), "site", F.lit("_"), "kind").alias("identifier"),
        F.lit("probe").alias("name"), "geometry", empty.alias("flags"))


def change_roundtrip(layers: DataFrame, features: DataFrame, feature_sources: DataFrame) -> DataFrame:
    """(identifier, after_insert, after_update, after_delete): what the probes leave at each step."""
    probes = probe_changes(layers)
    out = probes.select("identifier").distinct()
    # the probes touch their own few rows only
    features, feature_sources = (t.join(out, "identifier", "left_semi") for t in (features, feature_sources))
    for upto, name, check in ((1, "after_insert", None), (2, "after_update", "MULTIPOLYGON(((0 0,2 0,2 2,0 2,0 0)))"), (3, "after_delete", None)):
        feats, _, _ = apply_changes(features, feature_sources, probes.filter(F.col("seq") <= upto))
        hit = F.lit(True) if check is None else F.col("geometry") == check
        out = out.join(feats.select("identifier", hit.alias(name)), "identifier", "left")
    return out.select("identifier", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("after_insert", "after_update", "after_delete")])
