"""Layers -> features, feature sources and source years."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from chronogeo.operators import features as M


class State(NamedTuple):
    """The three published tables."""

    features: DataFrame
    feature_sources: DataFrame
    source_years: DataFrame


class Update(NamedTuple):
    state: State
    features: DataFrame
    feature_sources: DataFrame
    source_years: DataFrame
    parts: dict[str, tuple[DataFrame, DataFrame]] | None = None


def update_state(layers: DataFrame, state: State, site: str | None = None, parse: str = "range", mode: str = "all",
                 order: list[str] | None = None, kind_order: list[str] | None = None,
                 dst_srid: int | None = 3857) -> Update:
    """Publish all layers (or one site) in one go; the deltas serve as a preview."""
    if site is not None:
        layers = layers.filter(F.col("site") == site)
    feats = M.publish_features(layers, state.features, dst_srid=dst_srid)
    years = M.register_sources(layers, state.source_years, parse)
    links = M.publish_sources(layers, state.feature_sources, mode, order, kind_order)
    return Update(State(feats.table, links.table, years.table), feats.delta, links.delta, years.delta,
                  {"features": feats.parts, "feature_sources": links.parts, "source_years": years.parts})


def preview(update: Update) -> DataFrame:
    """(target, outcome, n) of an update that is not committed."""
    parts = [
        d.groupBy("outcome").agg(F.count("*").alias("n")).select(F.lit(t).alias("target"), "outcome", "n")
        for t, d in (("features", update.features), ("feature_sources", update.feature_sources),
                     ("source_years", update.source_years))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def commit(update: Update, folder: str) -> tuple[State, DataFrame]:
    """Write the three tables under `folder`; (the stored state, (target, rows, inserted)).

    The counts are observed while the rows are written, so there is one job per table and none for the report.
    """
    spark = update.state.features.sparkSession
    stored, counts = {}, []
    for target, (before, fresh) in update.parts.items():
        seen = Observation()
        rows = before.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
        rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if("_new").alias("inserted")).drop("_new").write.parquet(f"{folder}/{target}")
        counts.append((target, seen.get["rows"], seen.get["inserted"]))
        stored[target] = spark.read.schema(before.schema).parquet(f"{folder}/{target}")
    return State(**stored), spark.createDataFrame(counts, "target string, rows long, inserted long")
