"""Drift between layers, published tables and the graph: find it, then repair it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.operators import features as M
from chronogeo.operators import graph as R
from chronogeo.operators import periods as P
from chronogeo.plans.publish import State, update_state
from chronogeo.schema import VOCAB, Vocabulary
from chronogeo.session import cut

EXPECTED_OPS = ["insert", "update", "delete"]
ID_CATEGORIES = ["orphaned_in_production", "orphaned_feature_sources"]


def _issue(df: DataFrame, category: str, table: Column | None, item: Column, detail: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        F.lit(category).alias("category"), (none if table is None else table).alias("table"),
        item.alias("item"), (none if detail is None else detail).alias("detail"))


def layer_name() -> Column:
    return F.concat_ws("_", "site", "kind")


def missing_in_production(layers: DataFrame, features: DataFrame) -> DataFrame:
    """(table, identifier) of layer ids that are not published."""
    ids = layers.select(layer_name().alias("table"), "identifier").filter("identifier is not null").distinct()
    return ids.join(features.select("identifier"), "identifier", "left_anti")


def orphans(left: DataFrame, right: DataFrame, key: str = "identifier") -> DataFrame:
    """Distinct keys of `left` that `right` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def source_consistency(layers: DataFrame, source_years: DataFrame) -> DataFrame:
    """(source, problem): used but not registered, or registered but not used."""
    used = layers.select("source").filter("source is not null").distinct()
    return used.join(source_years.select("source"), "source", "left_anti").withColumn("problem", F.lit("not registered")).unionByName(
        source_years.select("source").join(used, "source", "left_anti").withColumn("problem", F.lit("not used")))


def coverage_audit(layers: DataFrame, registry: DataFrame) -> DataFrame:
    """(site, kind, op) expected for a layer but not wired."""
    expected = layers.select("site", "kind").distinct().select(
        "site", "kind", F.explode(F.array(*[F.lit(o) for o in EXPECTED_OPS])).alias("op"))
    return expected.join(registry.select("site", "kind", "op"), ["site", "kind", "op"], "left_anti")


def complete_registry(layers: DataFrame, registry: DataFrame) -> M.Change:
    gaps = coverage_audit(layers, registry)
    return M.Change(registry.select("site", "kind", "op").unionByName(gaps), gaps.withColumn("outcome", F.lit("inserted")))


def representation_labels(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(identifier, building) of the 2D representations in the graph; building is its label."""
    shapes = R.instances(triples, vocab.c("P2_has_type"), vocab.onto("2d_representation"), "shape")
    labels = R.literals(triples, vocab.label, "shape", "identifier").select("shape", "identifier").join(shapes, "shape", "left_semi")
    owner = (
        R.edges(triples, vocab.c("P196i_is_defined_by"), "building", "changes")
        .join(R.edges(triples, vocab.c("P166i_had_presence"), "changes", "presence"), "changes")
        .join(R.edges(triples, vocab.c("P138i_has_representation"), "presence", "shape"), "presence")
        .join(R.literals(triples, vocab.label, "building", "label"), "building")
        .select("shape", F.col("label").alias("building"))
    )
    return labels.join(owner, "shape", "left").select("identifier", "building").distinct()


def structure_issues(layers: dict[str, DataFrame]) -> list[str]:
    """Names of layers without an identifier column; reads schemas only."""
    return sorted(name for name, df in layers.items() if P.resolve_id_column(df) is None)


def layer_keys(layers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored distinct (site, kind, identifier) and (site, kind, source): the checks read these, not the layers."""
    return (cut(layers.select("site", "kind", "identifier").distinct()), cut(layers.select("site", "kind", "source").distinct()))


def diagnose(layers: DataFrame, state: State, registry: DataFrame, rdf: DataFrame | None = None,
             broken_layers: list[str] | None = None) -> DataFrame:
    """(category, table, item, detail): one row per finding, all layers in one job.

    `rdf` is (identifier, building); `broken_layers` are layers without an id
    column, which were left out of `layers`.
    """
    ids, flags = layer_keys(layers)
    absent = missing_in_production(ids, state.features)
    names = flags.select(layer_name().alias("table"), "source").filter("source is not null").distinct().join(
        state.source_years.select("source"), "source", "left_anti")
    gaps = coverage_audit(flags, registry)
    found = [
        _issue(absent, "missing_from_production", F.col("table"), F.col("identifier")),
        _issue(orphans(state.features, ids), "orphaned_in_production", None, F.col("identifier")),
        _issue(orphans(state.feature_sources, state.features), "orphaned_feature_sources", None, F.col("identifier")),
        _issue(names, "source_name_mismatches", F.col("table"), F.col("source"), F.lit("source is not registered")),
        _issue(gaps, "missing_triggers", layer_name(), F.col("op")),
    ]
    if rdf is not None:
        lost = orphans(rdf.filter("identifier is not null"), state.features)
        prefix = F.regexp_extract(F.col("identifier"), r"^([A-Za-z]+_[A-Za-z]+)", 1)
        found.append(_issue(lost, "rdf_mismatches", prefix, F.col("identifier")))
    if broken_layers:
        spark = layers.sparkSession
        rows = spark.createDataFrame([(n,) for n in broken_layers], "`table` string")
        found.append(_issue(rows, "table_structure_issues", F.col("table"), F.col("table"), F.lit("no identifier column")))
    return reduce(lambda a, b: a.unionByName(b), found)


def issue_totals(issues: DataFrame) -> DataFrame:
    """(category, n) and the overall total (category NULL).

    Orphans count per identifier, source names per column, the grouped
    categories once per table.
    """
    per_item = F.col("category").isin(ID_CATEGORIES + ["source_name_mismatches"])
    unit = F.when(per_item, F.concat_ws("\u001f", F.coalesce("table", F.lit("")), "item")).otherwise(F.col("table"))
    units = issues.select("category", unit.alias("unit")).distinct()
    return units.rollup("category").agg(F.count("*").alias("n"))


def repair(layers: DataFrame, state: State, registry: DataFrame, parse: str = "range",
           drop_orphans: bool = False, update_geometry: bool = False, dst_srid: int | None = 3857):
    """(new state, new registry, actions): what a diagnosis finds, put right.

    Orphaned features go only on request, and geometries are compared only on
    request, as edits in the published table may be wanted. `actions` lists each
    change with its step, so a dry run reads it and commits nothing.
    """
    actions = []

    def note(step: str, delta: DataFrame, item: Column) -> None:
        actions.append(delta.select(F.lit(step).alias("step"), item.alias("item"), F.col("outcome")))

    ids, flags = layer_keys(layers)
    wired = complete_registry(flags, registry)
    note("registry", wired.delta, F.concat_ws("_", "site", "kind", "op"))
    feats = state.features
    if drop_orphans:
        gone = orphans(feats, ids)
        kept = M.delete_keys(feats, gone, ["identifier"])
        note("orphaned features", kept.delta, F.col("identifier"))
        feats = kept.table
    update = update_state(layers, State(feats, state.feature_sources, state.source_years), parse=parse, dst_srid=dst_srid)
    for step, delta, key in (("features", update.features, "identifier"), ("source years", update.source_years, "source")):
        note(step, delta.filter("outcome = 'inserted'"), F.col(key))
    note("feature sources", update.feature_sources.filter("outcome = 'inserted'"), F.concat_ws(" | ", "identifier", "source"))
    feats = update.state.features
    if update_geometry:
        moved = M.publish_features(layers, feats.limit(0), dst_srid=dst_srid).table
        changed = M.update_from(feats, moved, ["identifier"], ["geometry"])
        note("geometry", changed.delta.filter("outcome = 'updated'"), F.col("identifier"))
        feats = changed.table
    clean = M.delete_orphans(update.state.feature_sources, feats, "identifier")
    note("orphaned sources", clean.delta, F.concat_ws(" | ", "identifier", "source"))
    log = reduce(lambda a, b: a.unionByName(b), actions)
    return State(feats, clean.table, update.state.source_years), wired.table, log
