"""Rows with an interval joined with many points at once, as an equality of segments.

The points are numbered along their range. An interval is cut into the largest segments of a power of two that it covers
(two of each size at most); a point lies in one segment of each size. Each covered point meets exactly one segment of the
interval, so the join makes as many rows as there are matches, and no interval is unrolled day by day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.session import cut

FEW_MARKS = 200_000  # segments of all points that are sent to every task; more are shuffled
_SEGMENTS = "array<struct<k:int,seg:bigint>>"


def segments(begin: Column, end: Column, levels: int) -> Column:
    """Segments (k, seg) of size 2^k that together are begin <= x < end, for numbers below 2^levels."""
    start = F.struct(begin.cast("long").alias("a"), end.cast("long").alias("b"), F.array().cast(_SEGMENTS).alias("out"))

    def half(x: Column) -> Column:
        return F.shiftright(x, 1)

    def grow(acc: Column, k: Column) -> Column:
        a, b = acc["a"], acc["b"]
        left = (a < b) & (a.bitwiseAND(1) == 1)
        a2 = F.when(left, a + 1).otherwise(a)
        right = (a2 < b) & (b.bitwiseAND(1) == 1)
        b2 = F.when(right, b - 1).otherwise(b)
        new = F.filter(F.array(F.when(left, F.struct(k.alias("k"), a.alias("seg"))), F.when(right, F.struct(k.alias("k"), b2.alias("seg")))), lambda x: x.isNotNull())
        return F.struct(half(a2).cast("long").alias("a"), half(b2).cast("long").alias("b"), F.concat(acc["out"], new.cast(_SEGMENTS)).alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, grow, lambda acc: acc["out"])


def _number(value: Column, kind: str) -> Column:
    return F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") if kind in ("date", "timestamp") else value.cast("long")


def at_points(df: DataFrame, points: DataFrame, begin: str, end: str, point: str, closed: bool = False) -> DataFrame:
    """`df` with the column `point`: one row for each distinct point with begin <= point < end (<= with `closed`).

    A NULL end is open, a NULL begin covers nothing. Points are days or whole numbers; NULL points are ignored.
    """
    kind = points.schema[point].dataType.typeName()
    asked = points.select(F.col(point).alias("_point")).filter("_point IS NOT NULL").distinct().withColumn("_n", _number(F.col("_point"), kind))
    asked = cut(asked)
    low, high, n = asked.agg(F.min("_n"), F.max("_n"), F.count("*")).first()
    if low is None:
        return df.withColumn(point, F.lit(None).cast(points.schema[point].dataType)).limit(0)
    levels = (high - low + 1).bit_length()
    first = F.greatest(_number(F.col(begin), kind) - low, F.lit(0))
    last = F.least(F.coalesce(_number(F.col(end), kind) + int(closed) - low, F.lit(high - low + 1)), F.lit(high - low + 1))
    rows = df.filter(F.col(begin).isNotNull()).withColumn("_s", F.explode(segments(first, last, levels)))
    marks = asked.select("_point", F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(
        k.alias("k"), F.call_function("shiftright", F.col("_n") - low, k).cast("long").alias("seg")))).alias("_s"))
    # the size of the intervals is known from before they are cut up, so the side to send is not left to an estimate
    rows, marks = (rows, F.broadcast(marks)) if n * (levels + 1) <= FEW_MARKS else (rows.hint("merge"), marks)
    return rows.join(marks, "_s").drop("_s").withColumnRenamed("_point", point)
