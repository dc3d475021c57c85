"""Dated buildings as triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.functions import text as X
from chronogeo.operators import graph as R
from chronogeo.operators import phases as P
from chronogeo.schema import VOCAB, Vocabulary
from chronogeo.session import cut


def building_phases(layer: DataFrame, source_years: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(buildings, phases) of a long layer.

    The dated identifiers are stored: three aggregates read them, the layer is read once.
    """
    dated = cut(P.phase_years(layer, source_years))
    return P.buildings(dated), P.phase_intervals(dated)


def island_iris(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(site, island): one island node per label."""
    islands = R.instances(triples, vocab.rdf_type, vocab.onto("Island"), "island")
    labels = R.literals(triples, vocab.label, "island", "site").select("island", "site")
    return R.one_of(labels.join(islands, "island", "left_semi"), "site", "island", "island")


def existing_buildings(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Distinct base ids some node is identified by."""
    values = R.literals(triples, vocab.value, "node", "base_id").select("node", "base_id")
    links = R.edges(triples, vocab.c("P1_is_identified_by"), "item", "node").select("node").distinct()
    return values.join(links, "node", "left_semi").select("base_id").distinct()


def plan_buildings(buildings: DataFrame, existing: DataFrame, dry_run: bool = False) -> DataFrame:
    """Every building with an outcome: error, skipped (already there) or inserted.

    A dry run takes all valid buildings as new. `island` may be NULL only there.
    """
    known = existing.select("base_id").distinct().withColumn("_known", F.lit(True))
    rows = buildings.join(known, "base_id", "left") if not dry_run else buildings.withColumn("_known", F.lit(None).cast("boolean"))
    bad = F.coalesce(F.trim("base_id"), F.lit("")) == ""
    if not dry_run:
        bad = bad | F.col("island").isNull()
    outcome = F.when(bad, "error").when(F.col("_known"), "skipped").otherwise("inserted")
    return rows.withColumn("outcome", outcome).drop("_known")


def building_triples(buildings: DataFrame, phases: DataFrame, vocab: Vocabulary = VOCAB, graph: str | None = None) -> DataFrame:
    """8 + 8 triples per phase, one more for each closed phase.

    Ids derive from the base id and the phase identifier, so buildings and
    phases are expanded separately and no phases are gathered per building.
    """
    g = F.lit(graph).cast("string") if graph else None

    def iri(kind: str, *key):
        return F.concat(F.lit(f"{vocab.base}{kind}/"), X.stable_uuid(F.lit(kind), *key))

    def row(s: str, p: str, o, o_type="iri", dtype=None):
        return R.term(F.col(s), p, o if not isinstance(o, str) else F.col(o), o_type, None, dtype, g)

    base, key = F.col("base_id"), F.col("identifier")
    # ids are bound once per row; the templates only refer to them
    heads = buildings.select("base_id", "name", "island", iri("builtwork", base).alias("_b"), iri("physical_changes", base).alias("_c"))
    heads = heads.withColumn("_i", F.concat("_b", F.lit("/identifier/"), X.stable_uuid(F.lit("identifier"), base)))
    per_building = R.construct(heads, [
        row("_b", vocab.rdf_type, F.lit(vocab.onto("Building"))),
        row("_b", vocab.label, X.sanitize_label(F.col("name")), "literal"),
        row("_b", vocab.c("P53_has_former_or_current_location"), "island"),
        row("_b", vocab.c("P196i_is_defined_by"), "_c"),
        row("_i", vocab.rdf_type, F.lit(vocab.c("E42_Identifier"))),
        row("_i", vocab.value, "base_id", "literal"),
        row("_b", vocab.c("P1_is_identified_by"), "_i"),
        row("_c", vocab.rdf_type, F.lit(vocab.c("E92_Spacetime_Volume"))),
    ], unique=True)
    steps = phases.join(buildings.select("base_id"), "base_id", "left_semi").select(
        "identifier", "bob", "eoe", iri("physical_changes", base).alias("_c"),
        iri("presence", base, key).alias("_p"), iri("timespan", base, key).alias("_t"),
        X.stable_uuid(F.lit("2drepresentation"), base, key).alias("_u"))
    steps = steps.withColumn("_r", F.concat("_p", F.lit("/2drepresentation/"), "_u"))
    per_phase = R.construct(steps, [
        row("_c", vocab.c("P166i_had_presence"), "_p"),
        row("_p", vocab.rdf_type, F.lit(vocab.c("E93_Presence"))),
        row("_p", vocab.c("P4_has_time-span"), "_t"),
        row("_p", vocab.c("P138i_has_representation"), "_r"),
        row("_t", vocab.rdf_type, F.lit(vocab.c("E52_Time-Span"))),
        row("_t", vocab.c("P82a_begin_of_the_begin"), X.phase_begin(F.col("bob")), "literal", vocab.xsd_date),
        row("_t", vocab.c("P82b_end_of_the_end"), X.phase_end(F.col("eoe")), "literal", vocab.xsd_date),
        row("_r", vocab.c("P2_has_type"), F.lit(vocab.onto("2d_representation"))),
        row("_r", vocab.label, "identifier", "literal"),
    ], unique=True)
    return per_building.unionByName(per_phase)


def create_buildings(layer: DataFrame, source_years: DataFrame, triples: DataFrame, vocab: Vocabulary = VOCAB,
                     graph: str | None = None, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(outcomes, new triples) for all sites of a long layer at once."""
    heads, phases = building_phases(layer, source_years)
    sites = layer.select(X.base_identifier(F.col("identifier")).alias("base_id"), "site").groupBy("base_id").agg(F.min("site").alias("site"))
    heads = heads.join(sites, "base_id").join(island_iris(triples, vocab), "site", "left")
    outcomes = plan_buildings(heads, existing_buildings(triples, vocab), dry_run)
    chosen = outcomes.filter(F.col("outcome") == "inserted")
    return outcomes, building_triples(chosen, phases, vocab, graph)
