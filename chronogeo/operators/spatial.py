"""Layout and joins by place: files along a space-filling curve, and many windows at once over grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogeo.functions import geometry as G

BITS = 24  # of a cell number on either axis
FINEST, COARSEST = -20, 60  # cells have sides of 2^FINEST to 2^COARSEST units


def _spread_bits(value: Column) -> Column:
    """Every bit of a number moved to twice its place."""
    def step(shift: int, mask: int):
        return lambda v: v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))

    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        value = G.let(value, step(shift, mask))
    return value


def z_order(x: Column, y: Column, side: float) -> Column:
    """Place of the cell of a point along the curve; cells beyond 2^(BITS - 1) steps from the origin count as the last ones."""
    half = 1 << (BITS - 1)
    cell = lambda v: F.least(F.greatest(F.floor(v / side) + half, F.lit(0)), F.lit(2 * half - 1)).cast("long")
    return _spread_bits(cell(x)).bitwiseOR(F.shiftleft(_spread_bits(cell(y)), 1))


def with_box(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Add min_x, min_y, max_x and max_y."""
    return df.withColumn("_b", G.bounds(F.col(geom))).select("*", *[F.col(f"_b.{c}").alias(c) for c in ("min_x", "min_y", "max_x", "max_y")]).drop("_b")


def write_by_place(df: DataFrame, path: str, side: float, geom: str = "geom") -> None:
    """Parquet with box columns, sorted along the curve: neighbours share row groups, so a window reads few of them."""
    rows = with_box(df, geom).withColumn("_z", z_order(F.col("min_x"), F.col("min_y"), side))
    rows.repartitionByRange("_z").sortWithinPartitions("_z").drop("_z").write.parquet(path)


def read_window(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose box lies in the closed window; the four comparisons reach the scan."""
    x0, y0, x1, y1 = (float(v) for v in box)
    return spark.read.parquet(path).filter((F.col("min_x") >= x0) & (F.col("max_x") <= x1) & (F.col("min_y") >= y0) & (F.col("max_y") <= y1))


def join_windows(df: DataFrame, windows: DataFrame, geom: str | None = "geom") -> DataFrame:
    """Pairs of rows of `df` and windows (window, x0, y0, x1, y1) that hold all their vertices.

    A window picks the cell size that is not smaller than itself, so it touches two cells on either axis, three at most. A
    row is put in the one cell of its lower left corner, once for each size in use. The join is an equality of cells, and
    each pair meets once. Rows without vertices are in no window; `geom=None`: the box columns are there already.
    """
    rows = with_box(df, geom) if geom else df
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(2.0**FINEST))
    level = F.least(F.ceil(F.log2(extent)), F.lit(COARSEST)).cast("int")
    cover = windows.filter((F.col("x1") >= F.col("x0")) & (F.col("y1") >= F.col("y0"))).withColumn("_k", level)
    sizes = sorted(r["_k"] for r in cover.select("_k").distinct().collect())  # eighty at most
    if not sizes:
        return rows.limit(0).join(windows.limit(0))
    side = F.pow(F.lit(2.0), F.col("_k"))
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / side), F.floor(F.col(hi) / side)))
    cover = cover.withColumn("_cx", cells("x0", "x1")).withColumn("_cy", cells("y0", "y1"))
    placed = (rows.filter("min_x IS NOT NULL").withColumn("_k", F.explode(F.array(*[F.lit(k) for k in sizes])))
              .withColumn("_cx", F.floor(F.col("min_x") / side)).withColumn("_cy", F.floor(F.col("min_y") / side)))
    inside = (F.col("min_x") >= F.col("x0")) & (F.col("max_x") <= F.col("x1")) & (F.col("min_y") >= F.col("y0")) & (F.col("max_y") <= F.col("y1"))
    return placed.join(cover, ["_k", "_cx", "_cy"]).filter(inside).drop("_k", "_cx", "_cy")
