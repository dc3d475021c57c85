"""Read-only checks across layers, published features and the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronogeo.operators import geo
from chronogeo.operators import periods as P


def identifier_mismatches(layer: DataFrame, features: DataFrame, rdf: DataFrame) -> DataFrame:
    """(identifier, in_layer, in_production, in_rdf, building): one row per id and building that uses it.

    Three key sets are tagged, stacked and OR-ed per id, so one shuffle replaces
    a chain of outer joins. Users of a label stay rows, however many they are.
    """
    def tagged(df: DataFrame, n: int) -> DataFrame:
        return df.select("identifier", *[F.lit(i == n).alias(c) for i, c in enumerate(["in_layer", "in_production", "in_rdf"])])

    flags = (
        tagged(layer, 0).unionByName(tagged(features, 1)).unionByName(tagged(rdf, 2))
        .filter("identifier is not null").groupBy("identifier")
        .agg(*[F.bool_or(c).alias(c) for c in ("in_layer", "in_production", "in_rdf")])
    )
    return flags.join(rdf.select("identifier", "building").distinct(), "identifier", "left")


def ordered(df: DataFrame, by: list[str], place: str = "place") -> DataFrame:
    """`df` with the place of each row from 1 in the order of `by`, so that a list stays ordered wherever it is stored."""
    return P.assign_sequence_ids(df, "", 1, by, place).withColumn(place, F.col(place).cast("long"))


def mismatch_kinds(mismatches: DataFrame) -> DataFrame:
    """Rows that disagree, with the kind of disagreement."""
    kind = (
        F.when(F.col("in_rdf") & ~F.col("in_production"), F.when(F.col("in_layer"), "rdf only, in layer").otherwise("rdf only"))
        .when(F.col("in_layer") & ~F.col("in_production"), "missing from production")
        .when(F.col("in_production") & ~F.col("in_layer"), "extra in production"))
    return mismatches.withColumn("problem", kind).filter(F.col("problem").isNotNull())


def with_prefix(df: DataFrame, prefixes: DataFrame, how: str = "startswith", key: str = "identifier") -> DataFrame:
    """Join ids with prefixes; `like` keeps the pattern meaning of `_`, `startswith` does not.

    Matching is an equality on the characters before the first wildcard, one
    branch per prefix shape, instead of comparing every id with every prefix.
    """
    wild = F.regexp_instr("prefix", F.lit("[_%]"))
    head = F.when((F.lit(how) == "like") & (wild > 0), wild - 1).otherwise(F.length("prefix"))
    shapes = prefixes.select(F.length("prefix").alias("n"), head.alias("h")).distinct().collect()
    if not shapes:
        return df.withColumn("prefix", F.lit(None).cast("string")).limit(0)
    pairs = F.array(*[F.struct(F.lit(r["n"]).alias("n"), F.lit(r["h"]).alias("h")) for r in shapes])
    ids = df.withColumn("_shape", F.explode(pairs)).withColumn("_head", F.substring(F.col(key), F.lit(1), F.col("_shape.h")))
    keyed = prefixes.select("prefix", F.struct(F.length("prefix").alias("n"), head.alias("h")).alias("_shape")).withColumn(
        "_head", F.substring("prefix", F.lit(1), F.col("_shape.h")))
    out = ids.join(keyed, ["_shape", "_head"])
    if how == "like":
        out = out.filter(F.expr(f"`{key}` like concat(prefix, '%')"))
    return out.drop("_shape", "_head")


def production_counts(features: DataFrame, prefixes: DataFrame, how: str = "startswith") -> DataFrame:
    """(prefix, n) of published ids."""
    return with_prefix(features.select("identifier"), prefixes, how).groupBy("prefix").agg(F.count("*").alias("n"))


def first_per_group(df: DataFrame, by: str, key: str, k: int = 5) -> DataFrame:
    """First k distinct keys per group, in order; each task keeps k per group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(key))
    return df.select(by, key).distinct().withColumn("rank", rank).filter(F.col("rank") <= k)


def layer_counts(layers: DataFrame, by: str = "site", k: int = 5) -> DataFrame:
    """(by, n, sample): ids per layer and the first k of them."""
    ids = layers.select(by, "identifier").filter("identifier is not null").distinct()
    sizes = ids.groupBy(by).agg(F.count("*").alias("n"))
    sample = first_per_group(ids, by, "identifier", k).groupBy(by).agg(
        F.array_join(F.array_sort(F.collect_list("identifier")), ", ").alias("sample"))
    return sizes.join(sample, by)


def identifier_format(layers: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(site, identifier, problem): blanks inside an id, or another prefix than the site's."""
    rows = layers.select("site", "identifier").filter("identifier is not null").distinct().join(prefixes, "site", "left")
    wrong = F.col("prefix").isNotNull() & ~F.startswith(F.col("identifier"), F.concat("prefix", F.lit("_")))
    problem = F.when(F.col("identifier").contains(" "), "blank in identifier").when(wrong, "wrong prefix")
    return rows.select("site", "identifier", problem.alias("problem")).filter("problem is not null")


def geometry_difference_report(layer: DataFrame, features: DataFrame, **limits) -> tuple[DataFrame, DataFrame]:
    """(differing pairs, totals per layer and overall)."""
    diff = geo.geometry_diff(layer, features, **limits)
    return diff, geo.diff_summary(diff)
