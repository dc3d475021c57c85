"""Geometry operators on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.functions import geometry as G
from chronogeo.operators.features import as_of
from chronogeo.session import cut


def with_geometry(df: DataFrame, wkt: str = "geometry", out: str = "geom") -> DataFrame:
    return df.withColumn(out, G.parse_wkt(F.col(wkt)))


def vertices(df: DataFrame, id_cols: list[str], geom: str = "geom") -> DataFrame:
    """(ids, part, ring, seq, x, y), one row per vertex."""
    parts = df.select(*id_cols, F.posexplode(geom).alias("part", "_rings"))
    rings = parts.select(*id_cols, "part", F.posexplode("_rings").alias("ring", "_points"))
    pts = rings.select(*id_cols, "part", "ring", F.posexplode("_points").alias("seq", "_p"))
    return pts.select(*id_cols, "part", "ring", "seq", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))


def with_measures(df: DataFrame, geom: str = "geom", prefix: str = "") -> DataFrame:
    """Add area and centroid columns."""
    return (
        df.withColumn("_m", G.measures(F.col(geom)))
        .withColumn(prefix + "area", F.col("_m.area"))
        .withColumn(prefix + "cx", F.col("_m.cx"))
        .withColumn(prefix + "cy", F.col("_m.cy"))
        .drop("_m")
    )


def extent(df: DataFrame, by: list[str], geom: str = "geom") -> DataFrame:
    """Bounding box and row count per group; boxes are made per row and combined before the shuffle."""
    rows = df.select(*by, G.bounds(F.col(geom)).alias("_b"))
    return rows.groupBy(*by).agg(
        F.min("_b.min_x").alias("min_x"), F.min("_b.min_y").alias("min_y"),
        F.max("_b.max_x").alias("max_x"), F.max("_b.max_y").alias("max_y"),
        F.count("*").alias("n"))


def bbox_check_layers(df: DataFrame, by: list[str], box, geom: str = "geom") -> DataFrame:
    """Extent per layer and where it lies relative to `box`."""
    ext = extent(df, by, geom)
    return ext.withColumn("bbox_status", G.bbox_status(
        F.col("min_x"), F.col("min_y"), F.col("max_x"), F.col("max_y"), box))


def bbox_check_production(df: DataFrame, by: list[str], box, geom: str = "geom") -> DataFrame:
    """Rows inside and outside `box` per group, with the real extent."""
    rows = df.select(*by, G.bounds(F.col(geom)).alias("_b"), G.within_envelope(F.col(geom), box).alias("_in"))
    return rows.groupBy(*by).agg(
        F.count("*").alias("total"),
        F.count_if("_in").alias("in_bbox"),
        (F.count("*") - F.count_if("_in")).alias("outside_bbox"),
        F.min("_b.min_x").alias("min_x"), F.min("_b.min_y").alias("min_y"),
        F.max("_b.max_x").alias("max_x"), F.max("_b.max_y").alias("max_y"))


def srid_audit(df: DataFrame, layer: str, declared: DataFrame | None = None, srid: str = "srid") -> DataFrame:
    """SRIDs found per layer against the declared one: unset (0), mismatch or ok.

    Distinct (layer, srid) pairs are counted first; only those few reach the list.
    """
    pairs = df.groupBy(layer, srid).agg(F.count("*").alias("_n"))
    found = pairs.groupBy(layer).agg(
        F.sum("_n").alias("total"),
        F.count_distinct(srid).alias("distinct_srids"),
        F.array_join(F.array_sort(F.collect_set(F.col(srid).cast("string"))), ", ").alias("srid_values"),
        F.max(F.when(F.col(srid) == 0, 1).otherwise(0)).alias("_unset"))
    if declared is None:
        return found.drop("_unset")
    verdict = (
        F.when(F.col("_unset") == 1, "unset")
        .when(F.col("srid_values") != F.col("declared").cast("string"), "mismatch")
        .otherwise("ok"))
    return found.join(declared.select(layer, "declared"), layer, "left").withColumn("verdict", verdict).drop("_unset")


def set_srid(df: DataFrame, srid: int) -> DataFrame:
    """Change the label only; coordinates stay."""
    return df.withColumn("srid", F.lit(srid))


def retarget(df: DataFrame, srid: int, wkt: str = "geometry") -> DataFrame:
    """Copy of a layer in another system: coordinates projected, label set.

    Rows of an unknown system or with unreadable text stay as they are, label
    included, so `check_typed` reports them.
    """
    moved = G.to_wkt(G.transform_by_srid(G.parse_wkt(F.col(wkt)), F.col("srid"), srid))
    done = moved.isNotNull() | F.col(wkt).isNull()
    return df.withColumns({wkt: F.when(done, moved).otherwise(F.col(wkt)),
                           "srid": F.when(done, F.lit(srid)).otherwise(F.col("srid"))})


def check_typed(df: DataFrame, srid: int = 3857, wkt: str = "geometry") -> DataFrame:
    """Rows that do not fit a MULTIPOLYGON column of one system."""
    kind = F.upper(F.regexp_extract(F.col(wkt), r"(?i)^\s*(?:SRID=\d+\s*;)?\s*([a-z]+)", 1))
    problem = F.when(kind != "MULTIPOLYGON", "type").when(F.col("srid") != srid, "srid").when(
        F.col(wkt).isNotNull() & G.parse_wkt(F.col(wkt)).isNull(), "text")
    return df.withColumn("problem", problem).filter(F.col("problem").isNotNull())


def temporal_spatial_slice(df: DataFrame, box, date: str, id_col: str = "identifier", geom: str = "geom",
                           begin: str = "bob", end: str = "eoe") -> DataFrame:
    """Distinct (identifier, wkt) inside `box` and valid on `date`; the cheap date test comes first."""
    rows = as_of(df, date, begin, end).filter(G.within_envelope(F.col(geom), box))
    return rows.select(F.col(id_col), G.to_wkt(F.col(geom)).alias("wkt")).distinct()


def geometry_diff(layer: DataFrame, features: DataFrame, srid: int = 3857,
                  max_shift: float = 0.1, max_area: float = 1.0) -> DataFrame:
    """Pairs whose coordinates differ, with centroid shift, area change and a significance flag.

    The comparison uses the repaired and projected layer geometry; the measures
    use the projected geometry as drawn. Shapes are the same if their digests are
    (`geometry_digest`). Digests and measures are made row by row before the
    join, which moves these few numbers and no vertex. The texts are parsed once,
    into stored tables: else the plan of a text that is still to be made would
    be repeated wherever its geometry is used.
    """
    a = cut(layer.select("layer", "identifier", "srid", G.parse_wkt(F.col("geometry")).alias("_raw")))
    a = a.select(
        "layer", "identifier", "srid",
        G.transform_by_srid(F.col("_raw"), F.col("srid"), srid).alias("_a"),
        G.transform_by_srid(G.repair_rings(F.col("_raw")), F.col("srid"), srid).alias("_fixed"))
    a = with_measures(a, "_a", "layer_").withColumn("_da", G.geometry_digest(F.col("_fixed"))).drop("_a", "_fixed")
    b = cut(features.select("identifier", G.parse_wkt(F.col("geometry")).alias("_b")))
    b = with_measures(b, "_b", "prod_").withColumn("_db", G.geometry_digest(F.col("_b"))).drop("_b")
    pairs = a.join(b, "identifier").filter(F.col("_da") != F.col("_db"))
    shift = G.distance(F.col("layer_cx"), F.col("layer_cy"), F.col("prod_cx"), F.col("prod_cy"))
    return pairs.select(
        "layer", "identifier", "srid",
        shift.alias("shift"), "layer_area", "prod_area",
        F.abs(F.col("layer_area") - F.col("prod_area")).alias("area_diff"),
    ).withColumn("significant", F.coalesce((F.col("shift") > max_shift) | (F.col("area_diff") > max_area), F.lit(False)))


def diff_summary(diff: DataFrame) -> DataFrame:
    """Differences per layer and overall (layer NULL)."""
    return diff.rollup("layer").agg(
        F.count("*").alias("total"),
        F.count_if("significant").alias("significant"),
        F.count_if(~F.col("significant")).alias("precision_only"))


def largest_shifts(diff: DataFrame, k: int = 10) -> DataFrame:
    return diff.orderBy(F.col("shift").desc(), "identifier").limit(k)
