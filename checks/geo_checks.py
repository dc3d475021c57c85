"""Geometry queries; the comparison uses closed formulas for boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import check
from checks.views import c, table, with_views
from chronogeo.functions import ewkb as W
from chronogeo.functions import geometry as G
from chronogeo.operators import geo
from chronogeo.plans import reports as R

BOX = (200.0, 1000.0, 900.0, 9000.0)
_IN = "min_x >= 200 AND max_x <= 900 AND min_y >= 1000 AND max_y <= 9000"
_RING = "'(' || {x} || ' ' || {y} || ',' || ({x} + {w}) || ' ' || {y} || ',' || ({x} + {w}) || ' ' || ({y} + {h}) || ',' || {x} || ' ' || ({y} + {h}) || ',' || {x} || ' ' || {y} || ')'"
_OUT, _HOLE, _FAR = _RING.format(x="x", y="y", w="6", h="h"), _RING.format(x="(x + 1)", y="(y + 1)", w="1", h="2"), _RING.format(x="(x + 100)", y="y", w="2", h="2")
_WKT = f"""CASE st WHEN 'F' THEN 'MULTIPOLYGON((' || {_OUT} || '))' WHEN 'O' THEN 'MULTIPOLYGON((' || {_OUT} || ',' || {_HOLE} || '))'
 ELSE 'MULTIPOLYGON((' || {_OUT} || '),(' || {_FAR} || '))' END"""


def _r(col: str, n: int = 4):
    return F.round(c(col), n).alias(col)


@check(with_views("poly_m") + " SELECT identifier, round(CAST(area AS DOUBLE), 4) AS area, round(mx / area, 4) AS cx, round(my / area, 4) AS cy FROM poly_m")
def polygon_measures(spark, sf):
    return geo.with_measures(v.shapes(spark, sf)).select("identifier", _r("area"), _r("cx"), _r("cy"))


@check(with_views("poly") + f" SELECT identifier, {_WKT} AS wkt FROM poly")
def wkt_roundtrip(spark, sf):
    return v.shapes(spark, sf).select("identifier", G.to_wkt(c("geom")).alias("wkt"))


@check(with_views("poly") + f" SELECT identifier, {_WKT} AS wkt, srid FROM poly")
def ewkb_roundtrip(spark, sf):
    rows = v.shapes(spark, sf).select("identifier", W.encode_ewkb(c("geom"), c("srid")).alias("hex"))
    return rows.select("identifier", G.to_wkt(W.decode_ewkb(c("hex"))).alias("wkt"), W.ewkb_srid(c("hex")).alias("srid"))


@check(with_views("poly") + f""" SELECT identifier, sha256({_WKT}) AS key FROM poly""")
def geometry_key(spark, sf):
    return v.shapes(spark, sf).select("identifier", G.geometry_key(c("geom")).alias("key"))


@check(with_views("poly") + """ SELECT st, part, ring, count(*) AS n, CAST(sum(vx) AS DOUBLE) AS sx, CAST(sum(vy) AS DOUBLE) AS sy FROM (
 SELECT st, 0 AS part, 0 AS ring, unnest([x, x + 6, x + 6, x, x]) AS vx, unnest([y, y, y + h, y + h, y]) AS vy FROM poly
 UNION ALL SELECT st, 0, 1, unnest([x + 1, x + 2, x + 2, x + 1, x + 1]), unnest([y + 1, y + 1, y + 3, y + 3, y + 1]) FROM poly WHERE st = 'O'
 UNION ALL SELECT st, 1, 0, unnest([x + 100, x + 102, x + 102, x + 100, x + 100]), unnest([y, y, y + 2, y + 2, y]) FROM poly WHERE st = 'P') GROUP BY ALL""")
def vertex_table(spark, sf):
    rows = v.shapes(spark, sf).withColumn("st", F.when(F.size("geom") == 2, "P").when(F.size(F.get("geom", F.lit(0))) == 2, "O").otherwise("F"))
    return geo.vertices(rows, ["st"]).groupBy("st", "part", "ring").agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))


_EXT = """min(min_x) AS min_x, min(min_y) AS min_y, max(max_x) AS max_x, max(max_y) AS max_y"""
_EXTD = "CAST(min_x AS DOUBLE) AS min_x, CAST(min_y AS DOUBLE) AS min_y, CAST(max_x AS DOUBLE) AS max_x, CAST(max_y AS DOUBLE) AS max_y"


@check(with_views("poly_m") + f" SELECT layer, {_EXTD}, n FROM (SELECT layer, {_EXT}, count(*) AS n FROM poly_m GROUP BY layer)")
def layer_extent(spark, sf):
    return geo.extent(v.shapes(spark, sf), ["layer"])


@check(with_views("poly_m") + f""" SELECT k, {_EXTD}, n, CASE WHEN max_x < 200 THEN 'OUTSIDE (too far west)' WHEN min_x > 900 THEN 'OUTSIDE (too far east)'
 WHEN max_y < 1000 THEN 'OUTSIDE (too far south)' WHEN min_y > 9000 THEN 'OUTSIDE (too far north)' ELSE 'INSIDE' END AS bbox_status
 FROM (SELECT x AS k, {_EXT}, count(*) AS n FROM poly_m GROUP BY x)""")
def bbox_status(spark, sf):
    rows = v.shapes(spark, sf).join(table(spark, sf, "orders").select(c("o_orderkey").alias("identifier"), c("o_custkey").alias("k")), "identifier")
    return geo.bbox_check_layers(rows, ["k"], BOX)


@check(with_views("poly_m") + f""" SELECT layer, count(*) AS total, count(*) FILTER (WHERE {_IN}) AS in_bbox, count(*) FILTER (WHERE NOT ({_IN})) AS outside_bbox,
 CAST(min(min_x) AS DOUBLE) AS min_x, CAST(min(min_y) AS DOUBLE) AS min_y, CAST(max(max_x) AS DOUBLE) AS max_x, CAST(max(max_y) AS DOUBLE) AS max_y FROM poly_m GROUP BY layer""")
def bbox_production(spark, sf):
    return geo.bbox_check_production(v.shapes(spark, sf), ["layer"], BOX)


@check(with_views("poly_m") + f" SELECT identifier FROM poly_m WHERE {_IN}")
def within_envelope(spark, sf):
    return v.shapes(spark, sf).filter(G.within_envelope(c("geom"), BOX)).select("identifier")


@check(with_views("poly", "poly_m") + f""" SELECT DISTINCT identifier, {_WKT} AS wkt FROM poly_m WHERE {_IN} AND bob <= DATE '1998-01-01' AND (eoe IS NULL OR eoe > DATE '1998-01-01')""")
def temporal_spatial_slice(spark, sf):
    return geo.temporal_spatial_slice(v.shapes(spark, sf), BOX, "1998-01-01")


@check(with_views("poly") + """, d AS (SELECT layer, CASE WHEN layer = '1-URGENT' THEN 4326 ELSE 3857 END AS declared, count(*) AS total, count(DISTINCT srid) AS distinct_srids,
 string_agg(DISTINCT CAST(srid AS VARCHAR), ', ' ORDER BY CAST(srid AS VARCHAR)) AS srid_values, bool_or(srid = 0) AS unset FROM
 (SELECT layer, CASE WHEN layer = '5-LOW' AND st = 'F' THEN 0 WHEN layer = '3-MEDIUM' THEN 3857 ELSE srid END AS srid FROM poly) GROUP BY layer)
 SELECT layer, declared, CAST(total AS BIGINT) AS total, distinct_srids, srid_values, CASE WHEN unset THEN 'unset' WHEN srid_values <> CAST(declared AS VARCHAR) THEN 'mismatch' ELSE 'ok' END AS verdict FROM d""")
def srid_audit(spark, sf):
    rows = v.polygons(spark, sf).withColumn("srid", F.when(
        (c("layer") == "5-LOW") & (F.size(F.split("geometry", r"\(")) == 4) & (c("srid") == 3857) & c("eoe").isNotNull(), 0)
        .when(c("layer") == "3-MEDIUM", 3857).otherwise(c("srid")))
    declared = rows.select("layer").distinct().withColumn("declared", F.when(c("layer") == "1-URGENT", 4326).otherwise(3857))
    return geo.srid_audit(rows, "layer", declared)


@check(with_views("poly") + " SELECT identifier, srid, 'srid' AS problem FROM poly WHERE srid <> 3857")
def typed_column_check(spark, sf):
    return geo.check_typed(v.polygons(spark, sf)).select("identifier", "srid", "problem")


_R = "6378137.0"


@check(with_views("poly_m") + f""" SELECT identifier, round(radians(x / 100.0) * {_R}, 3) + 0.0 AS mx, round(ln(tan(pi() / 4 + radians((y % 8000) / 100.0) / 2)) * {_R}, 3) + 0.0 AS my,
 round(x / 100.0, 6) AS lon, round((y % 8000) / 100.0, 6) AS lat FROM poly_m""")
def mercator(spark, sf):
    rows = table(spark, sf, "orders").select(c("o_orderkey").alias("identifier"), F.struct(
        (c("o_custkey") / 100).alias("x"), (c("o_orderkey") % 8000 / 100).alias("y")).alias("p"))
    rows = rows.withColumn("m", G.project_point(c("p"), 4326, 3857)).withColumn("b", G.project_point(c("m"), 3857, 4326))
    return rows.select("identifier", (F.round("m.x", 3) + 0.0).alias("mx"), (F.round("m.y", 3) + 0.0).alias("my"), F.round("b.x", 6).alias("lon"), F.round("b.y", 6).alias("lat"))


# the first four orders of the Krüger series, written out for the comparison
_N = "0.0016792203863837047"
_UTM = f"""WITH p AS (SELECT o_orderkey AS identifier, 9.0 + (o_custkey % 1200) / 100.0 AS lon, 30.0 + (o_orderkey % 4000) / 100.0 AS lat FROM orders),
 a AS (SELECT *, {_N} AS n, radians(lon - 15.0) AS lam, sin(radians(lat)) AS sp, 2 * sqrt({_N}) / (1 + {_N}) AS e FROM p),
 b AS (SELECT *, sinh(atanh(sp) - e * atanh(e * sp)) AS t FROM a),
 d AS (SELECT *, atan2(t, cos(lam)) AS xi, asinh(sin(lam) / sqrt(t * t + cos(lam) * cos(lam))) AS eta,
  n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180 AS a1, 13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440 AS a2,
  61 * n ** 3 / 240 - 103 * n ** 4 / 140 AS a3, 49561 * n ** 4 / 161280 AS a4,
  0.9996 * 6378137.0 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64) AS r FROM b)
 SELECT identifier, round(500000 + r * (eta + a1 * cos(2 * xi) * sinh(2 * eta) + a2 * cos(4 * xi) * sinh(4 * eta) + a3 * cos(6 * xi) * sinh(6 * eta) + a4 * cos(8 * xi) * sinh(8 * eta)), 2) AS e,
  round(r * (xi + a1 * sin(2 * xi) * cosh(2 * eta) + a2 * sin(4 * xi) * cosh(4 * eta) + a3 * sin(6 * xi) * cosh(6 * eta) + a4 * sin(8 * xi) * cosh(8 * eta)), 2) AS n,
  round(lon, 7) AS lon, round(lat, 7) AS lat FROM d"""


@check(_UTM)
def utm_zone_33(spark, sf):
    rows = table(spark, sf, "orders").select(c("o_orderkey").alias("identifier"), F.struct(
        (9.0 + c("o_custkey") % 1200 / 100).alias("x"), (30.0 + c("o_orderkey") % 4000 / 100).alias("y")).alias("p"))
    rows = rows.withColumn("u", G.project_point(c("p"), 4326, 32633)).withColumn("b", G.project_point(c("u"), 32633, 4326))
    return rows.select("identifier", F.round("u.x", 2).alias("e"), F.round("u.y", 2).alias("n"), F.round("b.x", 7).alias("lon"), F.round("b.y", 7).alias("lat"))


@check(with_views("poly") + f" SELECT identifier, 3857 AS srid, {_WKT} AS geometry FROM poly")
def retarget_layer(spark, sf):
    """To zone 33 and back, rounded to the drawing grid."""
    there = geo.retarget(geo.set_srid(v.polygons(spark, sf), 3857), 32633)
    back = there.select("identifier", "srid", G.transform(G.parse_wkt(c("geometry")), 32633, 3857).alias("g"))
    snapped = F.transform(c("g"), lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.struct(
        F.round(q["x"], 3).alias("x"), F.round(q["y"], 3).alias("y")))))
    return back.select("identifier", F.lit(3857).alias("srid"), G.to_wkt(snapped).alias("geometry"))


@check(with_views("poly") + """ SELECT identifier, CASE WHEN st = 'F' THEN 1 ELSE 0 END AS open_rings, CASE WHEN st = 'O' THEN 1 ELSE 0 END AS repeated_points, CASE WHEN st = 'P' THEN 1 ELSE 0 END AS short_rings,
 CAST(6 * h AS DOUBLE) AS area, true AS closed FROM poly""")
def ring_repair(spark, sf):
    """Boxes left open, with a doubled corner, or followed by a sliver; all repaired to the plain box."""
    g = v.shapes(spark, sf).join(table(spark, sf, "orders").select(c("o_orderkey").alias("identifier"), c("o_orderstatus").alias("st")), "identifier")
    ring = F.get(F.get("geom", F.lit(0)), F.lit(0))
    sliver = F.slice(ring, 1, 2)
    broken = (
        F.when(c("st") == "F", F.array(F.array(F.slice(ring, 1, 4))))
        .when(c("st") == "O", F.array(F.array(F.concat(F.slice(ring, 1, 2), F.slice(ring, 2, 4)))))
        .otherwise(F.array(F.array(ring, F.concat(sliver, F.slice(ring, 1, 1))))))
    rows = g.select("identifier", broken.alias("bad")).withColumn("r", G.ring_report(c("bad"))).withColumn("fixed", G.repair_rings(c("bad")))
    shell = F.get(F.get("fixed", F.lit(0)), F.lit(0))
    return rows.select("identifier", "r.open_rings", "r.repeated_points", "r.short_rings", G.area(c("fixed")).alias("area"),
                       (F.get(shell, F.lit(0)) == F.get(shell, F.lit(4))).alias("closed"))


def _moved(spark, sf):
    """Published copies: as drawn, shifted by 0.05 or 0.5, or grown."""
    g = v.shapes(spark, sf)
    dx = F.when(c("layer") == "1-URGENT", 0.0).when(c("layer") == "2-HIGH", 0.05).when(c("layer") == "3-MEDIUM", 0.5).otherwise(0.0)
    grow = F.when(c("layer") == "4-NOT SPECIFIED", 1.5).otherwise(1.0)
    x0 = F.get(F.get(F.get("geom", F.lit(0)), F.lit(0)), F.lit(0))["x"]
    moved = F.transform(c("geom"), lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.struct(
        (x0 + (q["x"] - x0) * grow + dx).alias("x"), q["y"].alias("y")))))
    return g.select("identifier", G.to_wkt(moved).alias("geometry"))


_DIFF = with_views("poly_m") + """, d AS (SELECT layer, identifier, CASE layer WHEN '2-HIGH' THEN 0.05 WHEN '3-MEDIUM' THEN 0.5 ELSE (mx / area - x) * 0.5 END AS shift,
 CASE WHEN layer = '4-NOT SPECIFIED' THEN area * 0.5 ELSE 0.0 END AS area_diff FROM poly_m WHERE layer IN ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))"""


@check(_DIFF + " SELECT layer, identifier, round(shift, 4) AS shift, round(CAST(area_diff AS DOUBLE), 4) AS area_diff, shift > 0.1 OR area_diff > 1 AS significant FROM d")
def geometry_difference(spark, sf):
    diff = geo.geometry_diff(geo.set_srid(v.polygons(spark, sf), 3857), _moved(spark, sf))
    return diff.select("layer", "identifier", _r("shift"), _r("area_diff"), "significant")


@check(_DIFF + """ SELECT layer, count(*) AS total, count(*) FILTER (WHERE shift > 0.1 OR area_diff > 1) AS significant,
 count(*) FILTER (WHERE NOT (shift > 0.1 OR area_diff > 1)) AS precision_only FROM d GROUP BY ROLLUP (layer)""")
def geometry_difference_totals(spark, sf):
    return R.geometry_difference_report(geo.set_srid(v.polygons(spark, sf), 3857), _moved(spark, sf))[1]


@check(_DIFF + " SELECT identifier, round(shift, 4) AS shift FROM d ORDER BY round(shift, 6) DESC, identifier LIMIT 10")
def largest_shifts(spark, sf):
    diff = geo.geometry_diff(geo.set_srid(v.polygons(spark, sf), 3857), _moved(spark, sf))
    return geo.largest_shifts(diff.withColumn("shift", F.round("shift", 6))).select("identifier", _r("shift"))
