"""Publishing and repairing the feature tables.

Tables are immutable snapshots, so a mutation returns `Change(table, delta)`:
the new table and what happened to each key. Both are lazy, a dry run simply
reads `delta` and commits nothing.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.functions import geometry as G
from chronogeo.functions.years import PARSERS
from chronogeo.operators.intervals import at_points
from chronogeo.schema import KIND_ROWS


class Change(NamedTuple):
    """`parts`: the rows that were there and the new ones, where a change only adds rows."""

    table: DataFrame
    delta: DataFrame
    parts: tuple[DataFrame, DataFrame] | None = None


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One deterministic row per key: the smallest remaining columns win."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def _all_set(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def insert_missing(target: DataFrame, incoming: DataFrame, keys: list[str]) -> Change:
    """Insert rows whose key is not there yet; existing keys stay as they are."""
    incoming = incoming.filter(_all_set(keys)).select(*target.columns)
    fresh = one_per_key(incoming.join(target.select(*keys), keys, "left_anti"), keys)
    known = incoming.join(target.select(*keys), keys, "left_semi").select(*keys).distinct()
    delta = fresh.select(*keys, F.lit("inserted").alias("outcome")).unionByName(
        known.select(*keys, F.lit("exists").alias("outcome")))
    return Change(target.unionByName(fresh), delta, (target, fresh))


def update_from(target: DataFrame, incoming: DataFrame, keys: list[str], cols: list[str]) -> Change:
    """Copy `cols` from matching rows; rows without a match stay."""
    new = one_per_key(incoming.select(*keys, *cols), keys).select(
        *keys, *[F.col(c).alias("_new_" + c) for c in cols], F.lit(True).alias("_hit"))
    joined = target.join(new, keys, "left")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col("_new_" + c)) for c in cols])
    table = joined.select(*[
        F.when(F.col("_hit"), F.col("_new_" + c)).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in target.columns])
    delta = joined.filter("_hit").select(
        *keys, F.when(differs, "updated").otherwise("unchanged").alias("outcome"))
    return Change(table, delta)


def delete_keys(target: DataFrame, keys_df: DataFrame, keys: list[str]) -> Change:
    """Delete the listed keys and report which of them existed."""
    listed = keys_df.select(*keys).distinct()
    here = target.select(*keys).distinct().withColumn("_hit", F.lit(True))
    delta = listed.join(here, keys, "left").select(
        *keys, F.when(F.col("_hit"), "deleted").otherwise("missing").alias("outcome"))
    return Change(target.join(listed, keys, "left_anti"), delta)


def delete_orphans(child: DataFrame, parent: DataFrame, key: str) -> Change:
    """Child rows whose key has no parent."""
    parents = parent.select(key).distinct()
    gone = child.join(parents, key, "left_anti")
    return Change(child.join(parents, key, "left_semi"), gone.withColumn("outcome", F.lit("deleted")))


def delete_unlisted(target: DataFrame, layers: list[DataFrame], key: str = "identifier") -> Change:
    """Keep only keys found in at least one layer (union, not one layer after the other)."""
    listed = reduce(lambda a, b: a.unionByName(b), [l.select(key) for l in layers]).distinct()
    return delete_orphans(target, listed, key)


def check_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break uniqueness or NOT NULL, with their row count."""
    null_key = ~_all_set(keys)
    return (
        df.groupBy(*keys).agg(F.count("*").alias("n"))
        .filter(null_key | (F.col("n") > 1))
        .withColumn("problem", F.when(null_key, "null key").otherwise("duplicate key"))
    )


# ---------------------------------------------------------------- publish

def kind_value(kind: Column, field: str, rows=None) -> Column:
    """Display type (`t`) or draw level (`z`) of a kind, looked up in a literal map."""
    at = {"t": 1, "z": 2}[field]
    pairs = [F.lit(v) for row in (rows or KIND_ROWS) for v in (row[0], row[at])]
    return F.element_at(F.create_map(*pairs), kind)


def publish_features(layers: DataFrame, features: DataFrame, kind_rows=None, dst_srid: int | None = 3857) -> Change:
    """Add layer rows whose identifier is not published yet.

    The anti join comes first, so only new rows are projected. With
    `dst_srid=None` geometries are copied as they are.
    """
    rows = layers.select("kind", "identifier", "name", "srid", "geometry").filter(F.col("identifier").isNotNull())
    fresh = rows.join(features.select("identifier"), "identifier", "left_anti")
    fresh = fresh.select(
        "identifier",
        kind_value(F.col("kind"), "t", kind_rows).alias("t"),
        kind_value(F.col("kind"), "z", kind_rows).alias("z"),
        "name", "srid", "geometry",
    )
    fresh = one_per_key(fresh, ["identifier"])
    geometry = F.col("geometry")
    if dst_srid is not None:
        geometry = G.to_wkt(G.transform_by_srid(G.parse_wkt(geometry), F.col("srid"), dst_srid))
    fresh = fresh.select("identifier", "t", "z", "name", geometry.alias("geometry"))
    known = rows.join(features.select("identifier"), "identifier", "left_semi").select("identifier").distinct()
    delta = fresh.select("identifier", F.lit("inserted").alias("outcome")).unionByName(
        known.withColumn("outcome", F.lit("exists")))
    return Change(features.unionByName(fresh), delta, (features, fresh))


def true_sources(layers: DataFrame) -> DataFrame:
    return layers.filter(F.col("present") & F.col("identifier").isNotNull())


def publish_sources(layers: DataFrame, feature_sources: DataFrame, mode: str = "all",
                    order: list[str] | None = None, kind_order: list[str] | None = None) -> Change:
    """Feature-source links for the true flags of a long layer.

    `all` adds every missing (identifier, source). `first` adds one link to
    identifiers that have none: the first true source in `order`, layers of
    earlier kinds first.
    """
    links = true_sources(layers)
    if mode == "all":
        return insert_missing(feature_sources, links, ["identifier", "source"])
    if mode != "first" or not order:
        raise ValueError("mode is 'all', or 'first' with an order of sources")
    kind_rank = F.lit(0)
    if kind_order:
        kind_rank = place_in(kind_order, F.col("kind"))
    rank = place_in(order, F.col("source"))
    fresh = (
        links.join(feature_sources.select("identifier"), "identifier", "left_anti")
        .groupBy("identifier")
        .agg(F.min(F.struct(kind_rank.alias("k"), rank.alias("r"), F.col("source"))).alias("first"))
        .select("identifier", "first.source")
    )
    return Change(feature_sources.unionByName(fresh), fresh.withColumn("outcome", F.lit("inserted")), (feature_sources, fresh))


def place_in(order: list[str], value: Column) -> Column:
    """Place of a value in the list; values that are not listed come last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), value)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def register_sources(layers: DataFrame, source_years: DataFrame, parse: str = "range") -> Change:
    """Add every source column that the dimension lacks, true anywhere or not."""
    span = PARSERS[parse](F.col("source"))
    fresh = (
        layers.select("source").filter(F.col("source").isNotNull()).distinct()
        .join(source_years.select("source"), "source", "left_anti")
        .withColumn("_span", span)
        .select("source", F.col("_span.start").alias("start"), F.col("_span.end").alias("end"))
    )
    return Change(source_years.unionByName(fresh), fresh.withColumn("outcome", F.lit("inserted")), (source_years, fresh))


# ---------------------------------------------------------------- slices

def as_of(df: DataFrame, date: str, begin: str = "bob", end: str = "eoe") -> DataFrame:
    """Rows valid on `date`: begin <= date < end, an open end is NULL."""
    day = F.lit(date).cast(df.schema[begin].dataType)
    return df.filter((F.col(begin) <= day) & (F.col(end).isNull() | (F.col(end) > day)))


def features_in_year(feature_sources: DataFrame, source_years: DataFrame, year: int) -> DataFrame:
    """Identifiers with a source whose span covers `year`."""
    active = source_years.filter(F.lit(year).between(F.col("start"), F.col("end"))).select("source")
    return feature_sources.join(active, "source", "left_semi").select("identifier").distinct()


def as_of_dates(df: DataFrame, dates: DataFrame, begin: str = "bob", end: str = "eoe", date: str = "date") -> DataFrame:
    """Rows valid on each of many dates, with the date: begin <= date < end, an open end is NULL. See `intervals`."""
    return at_points(df, dates, begin, end, date)


def features_by_year(feature_sources: DataFrame, source_years: DataFrame, years: DataFrame) -> DataFrame:
    """(year, identifier) for many years: the spans of the small dimension meet the years, both joins are equalities."""
    active = at_points(source_years.select("source", "start", "end"), years, "start", "end", "year", closed=True)
    return feature_sources.join(active.select("source", "year"), "source").select("year", "identifier").distinct()
