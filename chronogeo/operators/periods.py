"""Yearly tables -> presence flags -> long layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronogeo.functions.text import any_true, first_true, stable_uuid
from chronogeo.schema import ID_COLUMNS, META_COLUMNS
from chronogeo.session import cut


def named(name: str) -> Column:
    """Column by its literal name; source names hold dots, colons and commas."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---------------------------------------------------------------- discovery

def source_columns(df: DataFrame, exclude=None) -> list[str]:
    """Boolean columns, or every column outside `exclude` when that is given."""
    if exclude is None:
        return [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]
    return [c for c in df.columns if c not in set(exclude)]


def resolve_id_column(df: DataFrame, candidates=ID_COLUMNS) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def table_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, ordinal, column, type) of several tables; reads schemas only."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, c, d) for t, df in tables.items() for i, (c, d) in enumerate(df.dtypes, 1)]
    return spark.createDataFrame(rows, "`table` string, ordinal int, column string, type string")


# ---------------------------------------------------------------- union of periods

def apply_contract(df: DataFrame, contract: T.StructType, aliases: dict[str, str] | None = None, unreadable: str | None = None) -> DataFrame:
    """Rename drifted columns, then cast to the contract; absent columns become NULL.

    So do values that cannot be read as the type; `unreadable` names a column that counts them per row.
    """
    df = df.withColumnsRenamed(aliases or {})
    have = [f for f in contract if f.name in df.columns]
    out = [(named(f.name).try_cast(f.dataType) if f in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in contract]
    if unreadable:
        lost = [(named(f.name).isNotNull() & named(f.name).try_cast(f.dataType).isNull()).cast("int") for f in have]
        out.append(reduce(lambda a, b: a + b, lost, F.lit(0)).alias(unreadable))
    return df.select(*out)


def tag_period(df: DataFrame, period: str, column: str = "period") -> DataFrame:
    return df.withColumn(column, F.lit(period))


def union_periods(tables: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Rows of all tables, each distinct row once."""
    picked = [t.select(*[named(c) for c in columns]) for t in tables] if columns else tables
    return reduce(lambda a, b: a.unionByName(b), picked).distinct()


def merge_kinds(tables: list[DataFrame], id_col: str = "identifier", geometry: str = "geometry") -> DataFrame:
    """Distinct (identifier, geometry) over tables of any kind and period."""
    return union_periods([t.select(named(id_col).alias("identifier"), named(geometry).alias("geometry")) for t in tables])


def drop_pairs(df: DataFrame, corrections: DataFrame, on: list[str]) -> DataFrame:
    """Remove rows listed in a corrections table."""
    return df.join(corrections.select(*on).distinct(), on, "left_anti")


# ---------------------------------------------------------------- flags

def fill_identifier(df: DataFrame, id_col: str, key_cols: list[str], out: str = "identifier") -> DataFrame:
    """NULL ids get a stable uuid of the row key."""
    return df.withColumn(out, F.coalesce(named(id_col), stable_uuid(*[named(c) for c in key_cols])))


def presence_flags(df: DataFrame, period_col: str, flags: dict[str, str], keep: list[str]) -> DataFrame:
    """One 0/1 column per flag: 1 where the period equals the flag's match value."""
    ones = [F.when(named(period_col) == F.lit(v), 1).otherwise(0).alias(name) for name, v in flags.items()]
    return df.select(*[named(c) for c in keep], *ones).distinct()


def relabel_flags(df: DataFrame, mapping: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """Source label <- OR of year flags; 0/1 and boolean flags, NULL and absent flags count as false."""
    have = set(df.columns)
    labels = [
        any_true([named(y).cast("boolean") for y in years if y in have] or [F.lit(False)]).alias(label)
        for label, years in mapping.items()
    ]
    return df.select(*[named(c) for c in keep], *labels)


def fill_missing_flags(df: DataFrame, labels: list[str]) -> DataFrame:
    """Every label exists and is never NULL."""
    have = set(df.columns)
    rest = [named(c) for c in df.columns if c not in labels]
    return df.select(*rest, *[
        (F.coalesce(named(c), F.lit(False)) if c in have else F.lit(False)).alias(c) for c in labels])


def collapse_flags(df: DataFrame, keys: list[str], labels: list[str] | None = None) -> DataFrame:
    """OR of every flag per key; combined before the shuffle."""
    labels = labels or source_columns(df)
    return df.groupBy(*[named(k) for k in keys]).agg(
        *[F.bool_or(F.coalesce(named(c), F.lit(False))).alias(c) for c in labels])


def latest_source(df: DataFrame, ordered_labels: list[str], out: str = "source") -> DataFrame:
    return df.withColumn(out, first_true([(c, named(c)) for c in ordered_labels if c in df.columns]))


# ---------------------------------------------------------------- long and wide

def to_long(df: DataFrame, id_cols: list[str], sources: list[str] | None = None) -> DataFrame:
    """(ids, source, present) with one row per flag; NULL flags read as false."""
    sources = sources if sources is not None else source_columns(df)
    flags = df.select(
        *[named(c) for c in id_cols],
        *[F.coalesce(named(c).cast("boolean"), F.lit(False)).alias(c) for c in sources])
    return flags.unpivot([named(c) for c in id_cols], [named(c) for c in sources], "source", "present")


def to_wide(df: DataFrame, id_cols: list[str], sources: list[str]) -> DataFrame:
    """Inverse of `to_long` for a known list of sources."""
    return df.groupBy(*[named(c) for c in id_cols]).agg(*[
        F.coalesce(F.bool_or(F.when(F.col("source") == F.lit(s), F.col("present"))), F.lit(False)).alias(s)
        for s in sources])


# ---------------------------------------------------------------- sequences

def assign_sequence_ids(df: DataFrame, prefix: str, start: int, order: list[str], out: str = "identifier",
                        partitions: int | None = None) -> DataFrame:
    """prefix || start, start+1, ... in the given order, without a single-partition window.

    Rows are range-partitioned once; a hash of the whole row breaks ties, so a hot
    order value is spread over partitions. Local positions are written out with
    the rows, and only one row per partition is summed up to offsets.
    """
    keys = [named(c) for c in order] + [F.xxhash64(*[named(c) for c in df.columns])]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    stored = cut(ranged.sortWithinPartitions(*keys).withColumn("_pos", F.monotonically_increasing_id()))
    part, local = F.shiftright("_pos", 33), F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = stored.groupBy(part.alias("_part")).agg((F.max(local) + 1).alias("_n")).orderBy("_part").collect()
    offset, pairs = start, []
    for row in sizes:
        pairs.append((row["_part"], offset))
        offset += row["_n"]
    # one row per partition: bounded by the partition count, not by the data
    offsets = df.sparkSession.createDataFrame(pairs, "_part long, _offset long")
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.concat(F.lit(prefix), (F.col("_offset") + local).cast("string")))
        .drop("_part", "_offset", "_pos")
    )
