"""Order-dependent operators that survive a hot group.

A window over one key runs in one task. Here every group is first cut into
chunks along its order; chunk limits are quantiles of the whole table, so no
(key, chunk) cell holds much more than 1/chunks of all rows, even if one key
holds a third of them. Any limits give the same result, they only balance work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_limits(df: DataFrame, column: str, chunks: int = 64) -> list[float]:
    """At most `chunks - 1` quantiles of a numeric column, computed with a bounded sketch."""
    probs = [i / chunks for i in range(1, chunks)]
    row = df.agg(F.percentile_approx(F.col(column), probs, 1000).alias("q")).first()
    return sorted(set(row["q"] or []))


def chunk_of(column: Column, limits: list) -> Column:
    """Number of limits at or below the value."""
    if not limits:
        return F.lit(0)
    return F.size(F.filter(F.expr(f"array({', '.join(str(v) for v in limits)})"), lambda v: v <= column))


def previous_in_group(df: DataFrame, key: str, order: str, value: str, out: str, chunks: int = 64,
                      limits: list | None = None) -> DataFrame:
    """`value` of the row before, per `key` in `order`; NULL on the first row. `order` is unique per key."""
    limits = order_limits(df, order, chunks) if limits is None else limits
    cells = df.withColumn("_chunk", chunk_of(F.col(order), limits))
    inner = Window.partitionBy(key, "_chunk").orderBy(order)
    cells = cells.withColumn(out, F.lag(value).over(inner)).withColumn("_first", F.row_number().over(inner) == 1)
    # the last value of each cell, shifted to the key's next cell: at most `chunks` rows per key
    lasts = cells.groupBy(key, "_chunk").agg(F.max_by(value, order).alias("_last"))
    lasts = lasts.withColumn("_carry", F.lag("_last").over(Window.partitionBy(key).orderBy("_chunk")))
    lasts = lasts.select(F.col(key).alias("_k"), F.col("_chunk").alias("_c"), "_carry")
    joined = cells.join(lasts, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_chunk") == F.col("_c")), "left")
    return joined.withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out))).drop(
        "_chunk", "_first", "_k", "_c", "_carry")


def last_before(df: DataFrame, key: str, order: str, value: str, out: str, chunks: int = 64,
                limits: list | None = None) -> DataFrame:
    """Last non-NULL `value` at or before each row, per `key`, with chunked windows."""
    limits = order_limits(df, order, chunks) if limits is None else limits
    cells = df.withColumn("_chunk", chunk_of(F.col(order), limits))
    inner = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn(out, F.last(value, ignorenulls=True).over(inner))
    ends = cells.groupBy(key, "_chunk").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
    outer = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_carry", F.last("_end", ignorenulls=True).over(outer)).drop("_end")
    return cells.join(ends, [key, "_chunk"]).withColumn(out, F.coalesce(out, "_carry")).drop("_chunk", "_carry")
