"""Source flags -> dated building phases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronogeo.functions.text import base_identifier


def phase_years(layer: DataFrame, source_years: DataFrame) -> DataFrame:
    """Per identifier: first and last year of its active, known sources.

    Undated identifiers stay with NULL years; `unknown_sources` counts active
    sources the dimension does not list.
    """
    dim = source_years.select(
        "source", F.least("start", "end").alias("_lo"), F.greatest("start", "end").alias("_hi"), F.lit(True).alias("_known"))
    on = F.col("present")
    return (
        layer.select("identifier", "name", "source", "present")
        .join(dim, "source", "left")
        .groupBy("identifier")
        .agg(
            F.min("name").alias("name"),
            F.min(F.when(on, F.col("_lo"))).alias("bob"),
            F.max(F.when(on, F.col("_hi"))).alias("latest"),
            F.count_if(on & F.col("_known").isNull()).alias("unknown_sources"),
        )
        .withColumn("base_id", base_identifier(F.col("identifier")))
    )


def phase_intervals(phases: DataFrame) -> DataFrame:
    """Order the dated phases of a building by begin year; each ends the year before the next.

    A building may hold any share of all phases, so there is no window over its
    rows. The distinct begin years of a building are few (they come from the
    source dimension): the window runs over those, and rows are matched back on
    (building, year). Phases of one building and year end at `bob - 1`, except
    the last identifier among them.
    """
    dated = phases.filter(F.col("bob").isNotNull())
    years = dated.groupBy("base_id", "bob").agg(F.max("identifier").alias("_last_id"))
    years = years.withColumn("_next", F.lead("bob").over(Window.partitionBy("base_id").orderBy("bob")))
    return (
        dated.join(years, ["base_id", "bob"])
        .withColumn("eoe", F.when(F.col("identifier") < F.col("_last_id"), F.col("bob")).otherwise(F.col("_next")) - 1)
        .select("base_id", "identifier", "name", "bob", "eoe", (F.col("eoe") < F.col("bob")).alias("inverted"))
    )


def buildings(phases: DataFrame) -> DataFrame:
    """One row per building, also without any dated phase; named after its first row."""
    return phases.groupBy("base_id").agg(
        F.min_by("name", "identifier").alias("name"),
        F.count("bob").alias("n_phases"),
        F.sum("unknown_sources").alias("unknown_sources"),
    )
