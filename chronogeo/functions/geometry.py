"""Polygon geometry as nested array columns.

A geometry is `parts -> rings -> points`: array<array<array<struct<x,y>>>>.
Ring 0 of a part is its shell, the others are holes. Everything here is a
row-local expression: measuring or projecting a table of any size needs no
shuffle. Only projections of whole geometries use Python workers.
"""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from chronogeo.functions import batches, projection
from chronogeo.functions.constants import ALPHA as _ALPHA
from chronogeo.functions.constants import BETA as _BETA
from chronogeo.functions.constants import E as _E
from chronogeo.functions.constants import RADIUS as _RADIUS
from chronogeo.functions.constants import UTM33_LON0, UTM_EASTING, UTM_K0, WGS84_A

GEOMETRY_TYPE = "array<array<array<struct<x:double,y:double>>>>"
MEASURES_TYPE = "struct<area:double,cx:double,cy:double>"


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row or element and hand it to `body`; the plan holds it once, too."""
    return F.transform(F.array(value), body)[0]


_let = let


def _batched(work, out: str, kind: str, value: Column, plainly) -> Column:
    """`work` on whole Arrow batches; `plainly` computes the rows that it leaves, which come back as they were.

    `value` stands in the plan once. Marked so that Spark does not run it once more in every filter that it derives from a join.
    """
    def batch(items: pa.Array) -> pa.Array:
        return batches.split(items, work)

    both = F.arrow_udf(batch, f"struct<done:{out},left:{kind}>").asNondeterministic()(value)
    return let(both, lambda b: F.coalesce(b["done"], plainly(b["left"])))


# ---------------------------------------------------------------- text in / out

def wkt_srid(wkt: Column) -> Column:
    """SRID of an EWKT prefix, 0 when there is none."""
    return F.coalesce(F.regexp_extract(wkt, r"(?i)^\s*SRID=(\d+)\s*;", 1).try_cast("int"), F.lit(0))


# A vertex of less than two numbers, or a text between separators that is no number. No groups: long texts are scanned once.
_BROKEN = r"[(,]\s*+[^\s,()]*+\s*+[,)]|\.\d*+\.|[-+][-+]|\d[-+]|[eE](?![-+\d])"


def parse_wkt(wkt: Column) -> Column:
    """POLYGON / MULTIPOLYGON text, with or without an SRID prefix.

    White space is normalised once per text; after that every split is on one
    plain character, which needs no pattern per vertex. Text of another type or
    with anything but numbers in it is NULL. Whole batches of plain texts are
    read at once, only the others one by one.
    """
    return _batched(batches.parse, GEOMETRY_TYPE, "string", wkt, _parsed)


def _parsed(wkt: Column) -> Column:
    body = F.regexp_replace(F.regexp_replace(wkt, r"^[^(]*\(+\s*", ""), r"\s*\)+\s*$", "")
    body = F.regexp_replace(F.regexp_replace(body, r"\s*([(),])\s*", "$1"), r"\s+", " ")
    marked = F.replace(F.replace(body, F.lit(")),(("), F.lit("|")), F.lit("),("), F.lit(";"))

    def point(text: Column) -> Column:
        xy = F.split(text, " ")
        return F.struct(
            F.get(xy, F.lit(0)).try_cast("double").alias("x"),
            F.get(xy, F.lit(1)).try_cast("double").alias("y"),
        )

    parts = F.transform(F.split(marked, r"\|"), lambda part: F.transform(
        F.split(part, ";"), lambda ring: F.transform(F.split(ring, ","), point)))
    head = r"(?is)^\s*(SRID=\d+\s*;)?\s*(MULTI)?POLYGON\s*"
    return F.when(wkt.rlike(head + r"\([-+0-9.eE,()\s]+$") & ~wkt.rlike(_BROKEN), parts).when(wkt.rlike(head + r"EMPTY\s*$"), F.from_json(F.lit("[]"), GEOMETRY_TYPE))


def number_text(value: Column) -> Column:
    """Shortest plain decimal text that is read as the same number: no exponent, no trailing zeros.

    Exact up to 37 decimals below a thousandth and for anything under 10^20.
    """
    whole = (F.abs(value) < 1e15) & (value == F.floor(value))
    short = value.cast("string")
    digits = (F.when(~short.contains("E"), short)
              .when(F.abs(value) < 1, short.cast("decimal(38,37)").cast("string"))
              .otherwise(short.cast("decimal(38,15)").cast("string")))
    return F.when(whole, value.cast("long").cast("string")).otherwise(F.rtrim(F.rtrim(digits, F.lit("0")), F.lit(".")))


def to_wkt(geom: Column) -> Column:
    """MULTIPOLYGON text."""

    def ring(points: Column) -> Column:
        xy = F.transform(points, lambda p: F.concat_ws(" ", number_text(p["x"]), number_text(p["y"])))
        return F.concat(F.lit("("), F.array_join(xy, ","), F.lit(")"))

    def part(rings: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(rings, ring), ","), F.lit(")"))

    def text(parts: Column) -> Column:
        return F.concat(F.lit("MULTIPOLYGON("), F.array_join(F.transform(parts, part), ","), F.lit(")"))

    return let(geom, lambda g: F.when(F.size(g) == 0, F.lit("MULTIPOLYGON EMPTY")).otherwise(text(g)))


def _least_rotation(ring: Column) -> Column:
    """The closed ring that begins at its smallest vertex; of several such beginnings the smallest ring."""
    least = F.array_min(ring)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(ring), F.lit(1))), lambda i: F.get(ring, i - 1) == least)
    turned = F.array_min(F.transform(starts, lambda i: F.concat(F.slice(ring, i, F.size(ring)), F.slice(ring, F.lit(1), i - 1))))
    return let(turned, lambda r: F.concat(r, F.slice(r, F.lit(1), F.lit(1))))


def _canonical_ring(ring: Column, hole: Column) -> Column:
    opened = F.when((F.size(ring) > 1) & (F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1)), F.slice(ring, F.lit(1), F.size(ring) - 1)).otherwise(ring)

    def turned(points: Column) -> Column:
        against = _ring_turn(points) * F.when(hole, -1.0).otherwise(1.0) < 0
        return let(F.when(against, F.reverse(points)).otherwise(points), lambda r: F.when(F.size(r) == 0, r).otherwise(_least_rotation(r)))

    return let(opened, turned)


def _ring_turn(ring: Column) -> Column:
    """Twice the signed area, taken from the first vertex."""
    def around(origin: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("a"))
        return F.aggregate(ring, start, lambda acc, p: F.struct(
            (p["x"] - origin["x"]).alias("x"), (p["y"] - origin["y"]).alias("y"),
            (acc["a"] + acc["x"] * (p["y"] - origin["y"]) - (p["x"] - origin["x"]) * acc["y"]).alias("a")), lambda acc: acc["a"])

    return let(F.get(ring, F.lit(0)), around)


def canonical(geom: Column) -> Column:
    """The same shape in one form: shells counter-clockwise and holes clockwise, every ring closed and begun at its
    smallest vertex, holes and parts in order. Where a ring begins, which way it runs and how parts are listed is lost."""
    def part(rings: Column) -> Column:
        holes = F.sort_array(F.transform(F.slice(rings, F.lit(2), F.size(rings)), lambda r: _canonical_ring(r, F.lit(True))))
        return F.concat(F.transform(F.slice(rings, F.lit(1), F.lit(1)), lambda r: _canonical_ring(r, F.lit(False))), holes)

    return F.sort_array(F.transform(geom, part))


def geometry_digest(geom: Column) -> Column:
    """128 bits of the canonical form as hex, to be stored with a row: equal shapes have equal digests. NULL stays NULL.

    Two hashes of the coordinates with different seeds; no number is written as text.
    """
    def digest(shape: Column) -> Column:
        return F.when(shape.isNotNull(), F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), shape)), 16, "0") for seed in (1, 0x9E3779B9)]))

    return let(_batched(batches.canonical, GEOMETRY_TYPE, GEOMETRY_TYPE, geom, canonical), digest)


def geometry_key(geom: Column) -> Column:
    """Hash of the ordered vertices; equal keys mean equal coordinates."""
    return F.sha2(to_wkt(geom), 256)


# ---------------------------------------------------------------- measures

def _moments(a: Column, mx: Column, my: Column) -> Column:
    return F.struct(a.alias("a"), mx.alias("mx"), my.alias("my"))


def _ring_moments(ring: Column, hole: Column) -> Column:
    """Twice the area and the first moments of one ring, positive for a shell and negative for a hole.

    One pass over the points, which are taken relative to the first one: that
    keeps large coordinates exact and gives the closing edge no weight, so open
    rings measure like closed ones.
    """
    zero = F.lit(0.0)
    start = F.struct(zero.alias("x"), zero.alias("y"), zero.alias("a"), zero.alias("mx"), zero.alias("my"))

    def around(origin: Column) -> Column:
        def add(acc: Column, p: Column) -> Column:
            x, y = p["x"] - origin["x"], p["y"] - origin["y"]
            cross = acc["x"] * y - x * acc["y"]
            return F.struct(
                x.alias("x"), y.alias("y"), (acc["a"] + cross).alias("a"),
                (acc["mx"] + (acc["x"] + x) * cross).alias("mx"), (acc["my"] + (acc["y"] + y) * cross).alias("my"))

        def signed(m: Column) -> Column:
            w = F.signum(m["a"]) * F.when(hole, -1.0).otherwise(1.0)
            return _moments(w * m["a"], w * (m["mx"] + 3 * origin["x"] * m["a"]), w * (m["my"] + 3 * origin["y"] * m["a"]))

        return F.aggregate(ring, start, add, signed)

    return _let(F.get(ring, F.lit(0)), around)


def measures(geom: Column) -> Column:
    """struct<area, cx, cy>: shells count positive, holes negative, whatever their direction.

    Select it once under a name and read its fields, so it is evaluated once per row.
    Whole batches are measured at once, odd rows (NULL, empty lists) one by one.
    """
    return _batched(batches.measures, MEASURES_TYPE, GEOMETRY_TYPE, geom, _measured)


def _measured(geom: Column) -> Column:
    rings = F.flatten(F.transform(geom, lambda part: F.transform(part, lambda ring, i: _ring_moments(ring, i > 0))))
    three = lambda acc: F.nullif(acc["a"] * 3, F.lit(0.0))
    return F.aggregate(
        rings, _moments(F.lit(0.0), F.lit(0.0), F.lit(0.0)),
        lambda acc, m: _moments(acc["a"] + m["a"], acc["mx"] + m["mx"], acc["my"] + m["my"]),
        lambda acc: F.struct(
            (acc["a"] / 2).alias("area"), (acc["mx"] / three(acc)).alias("cx"), (acc["my"] / three(acc)).alias("cy")))


def area(geom: Column) -> Column:
    return measures(geom)["area"]


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.hypot(x1 - x2, y1 - y2)


def points(geom: Column) -> Column:
    return F.flatten(F.flatten(geom))


def bounds(geom: Column) -> Column:
    """struct<min_x, min_y, max_x, max_y> over all vertices of one geometry."""
    pts = points(geom)
    xs, ys = F.transform(pts, lambda p: p["x"]), F.transform(pts, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"),
        F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def within_envelope(geom: Column, box: tuple[float, float, float, float]) -> Column:
    """All vertices in the closed box, which is exact for areas inside an axis-aligned box."""
    x0, y0, x1, y1 = (F.lit(float(v)) for v in box)
    return (F.size(points(geom)) > 0) & F.forall(
        points(geom), lambda p: (p["x"] >= x0) & (p["x"] <= x1) & (p["y"] >= y0) & (p["y"] <= y1))


def bbox_status(min_x: Column, min_y: Column, max_x: Column, max_y: Column, box) -> Column:
    """Position of an extent relative to `box`; the four sides are tested in this order."""
    x0, y0, x1, y1 = (F.lit(float(v)) for v in box)
    return (
        F.when(max_x < x0, "OUTSIDE (too far west)")
        .when(min_x > x1, "OUTSIDE (too far east)")
        .when(max_y < y0, "OUTSIDE (too far south)")
        .when(min_y > y1, "OUTSIDE (too far north)")
        .otherwise("INSIDE")
    )


# ---------------------------------------------------------------- ring repair

def _repair_ring(ring: Column) -> Column:
    """Drop repeated neighbours, then close the ring.

    Neighbours are paired, as a function of a point that also reads its ring cannot be handed to a projection.
    """
    before = F.concat(F.slice(ring, F.lit(1), F.lit(1)), F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))))
    pairs = F.filter(F.zip_with(ring, before, lambda p, q: F.struct(p.alias("p"), q.alias("q"))), lambda z, i: (i == 0) | (z["p"] != z["q"]))
    kept = F.transform(pairs, lambda z: z["p"])
    return _let(kept, lambda k: F.when(
        (F.size(k) > 0) & (F.get(k, F.lit(0)) != F.get(k, F.size(k) - 1)),
        F.concat(k, F.slice(k, F.lit(1), F.lit(1)))).otherwise(k))


def repair_rings(geom: Column) -> Column:
    """Closed rings without repeated vertices; rings under 4 points go, and parts whose shell goes."""
    fixed = F.transform(geom, lambda part: F.transform(part, _repair_ring))
    with_shell = F.filter(fixed, lambda part: F.size(F.get(part, F.lit(0))) >= 4)
    return F.transform(with_shell, lambda part: F.filter(part, lambda r: F.size(r) >= 4))


def ring_report(geom: Column) -> Column:
    """struct<rings, open_rings, repeated_points, short_rings> before repair."""
    rings = F.flatten(geom)

    def count(items: Column) -> Column:
        return F.size(items)

    open_rings = F.filter(rings, lambda r: (F.size(r) > 0) & (F.get(r, F.lit(0)) != F.get(r, F.size(r) - 1)))
    repeats = F.aggregate(
        F.transform(rings, lambda r: F.size(F.filter(r, lambda p, i: (i > 0) & (p == F.get(r, i - 1))))),
        F.lit(0), lambda acc, n: acc + n)
    short = F.filter(rings, lambda r: F.size(_repair_ring(r)) < 4)
    return F.struct(
        count(rings).alias("rings"), count(open_rings).alias("open_rings"),
        repeats.alias("repeated_points"), count(short).alias("short_rings"))


# ---------------------------------------------------------------- projections

SRIDS = (3857, 4326, 32633)


def _xy(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _lonlat_to_mercator(p: Column) -> Column:
    return _xy(F.radians(p["x"]) * WGS84_A, F.log(F.tan(F.radians(p["y"]) / 2 + math.pi / 4)) * WGS84_A)


def _mercator_to_lonlat(p: Column) -> Column:
    return _xy(F.degrees(p["x"] / WGS84_A), F.degrees(F.atan(F.sinh(p["y"] / WGS84_A))))


def _atanh(v: Column) -> Column:
    return F.log((1 + v) / (1 - v)) / 2


def _asinh(v: Column) -> Column:
    return F.signum(v) * F.log(F.abs(v) + F.sqrt(v * v + 1))


def _series(coef: list[float], xi: Column, eta: Column, outer, inner) -> Column:
    terms = [c * outer(2 * k * xi) * inner(2 * k * eta) for k, c in enumerate(coef, 1)]
    return reduce(lambda a, b: a + b, terms)


def _lonlat_to_utm33(p: Column) -> Column:
    lam = F.radians(p["x"] - UTM33_LON0)
    sin_phi = F.sin(F.radians(p["y"]))
    tau = F.sinh(_atanh(sin_phi) - _E * _atanh(_E * sin_phi))

    def frame(tau: Column) -> Column:
        return _xy(F.atan2(tau, F.cos(lam)), _asinh(F.sin(lam) / F.sqrt(tau * tau + F.cos(lam) * F.cos(lam))))

    def grid(q: Column) -> Column:
        xi, eta = q["x"], q["y"]
        return _xy(
            UTM_EASTING + UTM_K0 * _RADIUS * (eta + _series(_ALPHA, xi, eta, F.cos, F.sinh)),
            UTM_K0 * _RADIUS * (xi + _series(_ALPHA, xi, eta, F.sin, F.cosh)))

    return _let(_let(tau, frame), grid)


def _utm33_to_lonlat(p: Column) -> Column:
    scaled = _xy(p["y"] / (UTM_K0 * _RADIUS), (p["x"] - UTM_EASTING) / (UTM_K0 * _RADIUS))

    def sphere(q: Column) -> Column:
        xi, eta = q["x"], q["y"]
        return _xy(xi - _series(_BETA, xi, eta, F.sin, F.cosh), eta - _series(_BETA, xi, eta, F.cos, F.sinh))

    def conformal(q: Column) -> Column:
        """x: conformal latitude's tangent, y: longitude in degrees."""
        return _xy(
            F.sin(q["x"]) / F.sqrt(F.sinh(q["y"]) * F.sinh(q["y"]) + F.cos(q["x"]) * F.cos(q["x"])),
            UTM33_LON0 + F.degrees(F.atan2(F.sinh(q["y"]), F.cos(q["x"]))))

    def newton(q: Column) -> Column:
        """One step from tan(conformal latitude) towards tan(latitude), kept beside the target."""
        t, goal = q["t"], q["goal"]
        sigma = F.sinh(_E * _atanh(_E * t / F.sqrt(1 + t * t)))
        here = t * F.sqrt(1 + sigma * sigma) - sigma * F.sqrt(1 + t * t)
        slope = (1 - _E**2) * F.sqrt(1 + here * here) * F.sqrt(1 + t * t) / (1 + (1 - _E**2) * t * t)
        return F.struct((t + (goal - here) / slope).alias("t"), goal.alias("goal"), q["lon"].alias("lon"))

    start = _let(_let(_let(scaled, sphere), conformal), lambda q: F.struct(
        q["x"].alias("t"), q["x"].alias("goal"), q["y"].alias("lon")))
    solved = F.aggregate(F.sequence(F.lit(1), F.lit(4)), start, lambda acc, _: newton(acc))
    return _let(solved, lambda q: _xy(q["lon"], F.degrees(F.atan(q["t"]))))


_TO_LONLAT = {3857: _mercator_to_lonlat, 32633: _utm33_to_lonlat}
_FROM_LONLAT = {3857: _lonlat_to_mercator, 32633: _lonlat_to_utm33}


def project_point(p: Column, src: int, dst: int) -> Column:
    if src not in SRIDS or dst not in SRIDS:
        raise ValueError(f"supported SRIDs are {SRIDS}")
    if src == dst:
        return p
    if src in _TO_LONLAT:
        p = _TO_LONLAT[src](p)
    return _let(p, _FROM_LONLAT[dst]) if dst in _FROM_LONLAT else p


def _projected(geom: Column, srid: Column, dst: int) -> Column:
    def project(geoms: pa.Array, srids: pa.Array) -> pa.Array:
        return projection.project(geoms, srids, dst)

    return F.arrow_udf(project, GEOMETRY_TYPE)(geom, srid.cast("int"))


def transform(geom: Column, src: int, dst: int) -> Column:
    """Project every vertex; unchanged when both systems are the same. Whole Arrow batches of vertices are projected at once."""
    if src not in SRIDS or dst not in SRIDS:
        raise ValueError(f"supported SRIDs are {SRIDS}")
    return geom if src == dst else _projected(geom, F.lit(src), dst)


def transform_by_srid(geom: Column, srid: Column, dst: int) -> Column:
    """Project rows of mixed systems; an unset SRID (NULL or 0) is taken as already in `dst`, an unknown one gives NULL.

    Only rows that are in another system are handed to the projection.
    """
    if dst not in SRIDS:
        raise ValueError(f"supported SRIDs are {SRIDS}")
    other = srid.isin([src for src in SRIDS if src != dst])
    return F.when(srid.isNull() | (srid == 0) | (srid == dst), geom).when(other, _projected(F.when(other, geom), srid, dst))
