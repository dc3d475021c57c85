"""Versioned parquet snapshots with a commit log.

A table root holds `data/<version>/` folders and `commits/`, a log of JSON rows.
Data is written first and becomes visible with its commit row, so a failed or
repeated write changes nothing. Tables with a `bucket` column are rewritten only
in the buckets a change touches: the log names the current version per bucket.
One writer per root at a time.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMMIT = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("bucket", T.IntegerType()),
    T.StructField("path", T.StringType()),
    T.StructField("query", T.StringType()),
])


def bucket_of(column: str, buckets: int):
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def commits(spark: SparkSession, root: str) -> DataFrame:
    """Commit log; empty when the table does not exist yet."""
    try:
        return spark.read.schema(_COMMIT).json(f"{root}/commits")
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], _COMMIT)


class BucketState(NamedTuple):
    """Latest version, last batch of every stream query and the current data folder of every bucket."""

    version: int
    batches: dict[str | None, int]
    paths: dict[int, str]


def current_state(spark: SparkSession, root: str) -> BucketState:
    """As many rows of the log reach the driver as there are buckets, times queries."""
    rows = commits(spark, root).groupBy("bucket", "query").agg(
        F.max("version").alias("version"), F.max("batch_id").alias("batch_id"), F.max_by("path", "version").alias("path")).collect()
    rows.sort(key=lambda r: r["version"])
    batches: dict[str | None, int] = {}
    for r in rows:
        if r["batch_id"] is not None:
            batches[r["query"]] = max(r["batch_id"], batches.get(r["query"], r["batch_id"]))
    return BucketState(
        max((r["version"] for r in rows), default=0), batches,
        {r["bucket"]: r["path"] for r in rows if r["bucket"] is not None and r["bucket"] >= 0})


def _log(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, _COMMIT).coalesce(1).write.mode("append").json(f"{root}/commits")


def commit_snapshot(df: DataFrame, root: str, batch_id: int | None = None) -> int:
    """Write a whole table as the next version."""
    spark = df.sparkSession
    version = (commits(spark, root).agg(F.max("version")).first()[0] or 0) + 1
    path = f"{root}/data/{version}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _log(spark, root, [(version, batch_id, None, path, None)])
    return version


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Latest or a given version of a whole-table snapshot."""
    log = commits(spark, root).filter(F.col("bucket").isNull())
    if version is not None:
        log = log.filter(F.col("version") == version)
    row = log.orderBy(F.col("version").desc()).first()
    if row is None:
        raise ValueError(f"no such snapshot under {root}")
    return spark.read.parquet(row["path"])


def commit_buckets(tables: dict[str, DataFrame], root: str, touched: list[int], batch_id: int | None = None,
                   version: int | None = None, query: str | None = None) -> int:
    """Rewrite the touched buckets of several tables under one commit.

    Each table has a `bucket` column. `version` is the one the caller read. A
    commit that touches nothing is logged too, so its batch id is known. Batch
    ids count within one `query`.
    """
    spark = next(iter(tables.values())).sparkSession
    version = (current_state(spark, root).version if version is None else version) + 1
    base = f"{root}/data/{version}-{uuid.uuid4().hex}"
    for name, df in tables.items():
        df.repartition("bucket").write.partitionBy("bucket").parquet(f"{base}/{name}")
    _log(spark, root, [(version, batch_id, b, base, query) for b in touched or [-1]])
    return version


def read_buckets(spark: SparkSession, state: BucketState, name: str, schema: T.StructType, only: list[int] | None = None) -> DataFrame:
    """Current rows of one bucketed table, with its `bucket` column; other folders are pruned."""
    full = T.StructType(list(schema) + [T.StructField("bucket", T.IntegerType())])
    by_path: dict[str, list[int]] = {}
    for bucket, path in state.paths.items():
        if only is None or bucket in only:
            by_path.setdefault(path, []).append(bucket)
    parts = [
        spark.read.schema(full).parquet(f"{path}/{name}").filter(F.col("bucket").isin(buckets))
        for path, buckets in sorted(by_path.items())]
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else spark.createDataFrame([], full)
