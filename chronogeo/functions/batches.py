"""Whole Arrow batches of polygons read, measured and put in order with array arithmetic.

Each function serves plain rows, with the same bits as the expressions of `geometry`, and gives NULL for the rows that it
leaves to them: texts in any other writing, NULL or infinite coordinates, empty lists, shapes that only tie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from chronogeo.functions.projection import lengths, values

_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:[eE]-?[0-9]+)?"
_POINT = f"{_NUMBER} {_NUMBER}"
_RING = rf"\({_POINT}(?:,{_POINT})*\)"
_PART = rf"\({_RING}(?:,{_RING})*\)"
_PLAIN = rf"^MULTIPOLYGON ?\({_PART}(?:,{_PART})*\)$"
_IN_NUMBER = np.zeros(256, bool)
_IN_NUMBER[list(b"0123456789.eE-")] = True


def split(items: pa.Array, work) -> pa.Array:
    """struct<done, left>: what `work` made of the items, and the items that it left."""
    done = work(items)
    rest = np.flatnonzero(done.is_null().to_numpy(zero_copy_only=False) & items.is_valid().to_numpy(zero_copy_only=False))
    place = np.zeros(len(items), np.int64)
    place[rest] = rest
    none = np.ones(len(items), bool)
    none[rest] = False
    left = items.take(pa.array(place, mask=none)) if len(rest) else pa.nulls(len(items), items.type)
    return pa.StructArray.from_arrays([done, left], names=["done", "left"])


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)).astype("i4"))


def _nested(parts, rings, sizes, x, y, none) -> pa.Array:
    """Geometries of so many parts a row, rings a part and points a ring; NULL where `none`."""
    out = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
    out = pa.ListArray.from_arrays(_offsets(rings), pa.ListArray.from_arrays(_offsets(sizes), out))
    return pa.ListArray.from_arrays(_offsets(parts), out, mask=pa.array(none))


def parse(texts: pa.Array) -> pa.Array:
    """MULTIPOLYGON texts without white space or prefix; every end of a ring, part and row is found by its brackets."""
    plain = pc.fill_null(pc.match_substring_regex(texts, _PLAIN), False)
    none = ~plain.to_numpy(zero_copy_only=False)
    parts, kept = np.zeros(len(texts), np.int64), texts.filter(plain)
    if none.all():
        return _nested(parts, parts[:0], parts[:0], np.zeros(0), np.zeros(0), none)
    ends = np.frombuffer(kept.buffers()[1], "i4")[kept.offset:kept.offset + len(kept) + 1]
    data = np.frombuffer(kept.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    number, close = _IN_NUMBER[data], data == ord(")")
    before = lambda mask: np.append(False, mask[:-1])
    ring_end = close & before(number)
    part_end = close & before(ring_end)
    row_end = close & before(part_end)
    first = np.flatnonzero(number & ~before(number))
    last = np.flatnonzero(number & np.append(~number[1:], True))
    words = pa.StringArray.from_buffers(len(first), _offsets(last - first + 1).buffers()[1], pa.py_buffer(data[number].tobytes()))
    xy = words.cast(pa.float64()).to_numpy()
    sizes = np.diff(np.searchsorted(first, np.flatnonzero(ring_end)), prepend=0) // 2
    rings = np.diff(np.cumsum(ring_end)[part_end], prepend=0)
    parts[~none] = np.diff(np.cumsum(part_end)[row_end], prepend=0)
    return _nested(parts, rings, sizes, xy[::2], xy[1::2], none)


class _Shapes:
    """Lists of a batch as sizes and places; `odd` marks the rows that are left to the expressions."""

    def __init__(self, geoms: pa.Array):
        at, sizes, row = geoms, [], np.arange(len(geoms))
        self.odd = np.array(geoms.is_null().to_numpy(zero_copy_only=False))
        rows = []
        for _ in range(3):
            n = lengths(at)
            self.odd[row[n == 0]] = True
            sizes.append(n)
            row = np.repeat(row, n)
            rows.append(row)
            # where there are no items, an array from Spark may lack its buffers
            at = at.flatten() if n.any() else pa.array([], at.type.value_type)
            self.odd[row[at.is_null().to_numpy(zero_copy_only=False)]] = True
        (x, none_x), (y, none_y) = map(values, at.flatten())
        self.odd[row[none_x | none_y | ~np.isfinite(x) | ~np.isfinite(y)]] = True
        self.parts, self.rings, self.sizes = sizes
        self.row_of_part, self.row_of_ring = rows[0], rows[1]
        self.part_of_ring = np.repeat(np.arange(len(self.rings)), self.rings)
        self.hole = np.arange(len(self.sizes)) > _starts(self.rings)[self.part_of_ring]
        self.x, self.y, self.start = x, y, _starts(self.sizes)


def _around(x, y, start, sizes):
    """Ring and index of every point, sums of its place relative to the first one and the one before, both products of their cross product."""
    ring = np.repeat(np.arange(len(sizes)), sizes)
    at = np.repeat(start, sizes) + np.arange(len(ring)) - np.repeat(_starts(sizes), sizes)
    dx, dy = x[at] - x[start[ring]], y[at] - y[start[ring]]
    px, py = np.append(0.0, dx[:-1]), np.append(0.0, dy[:-1])
    head = at == start[ring]
    px[:len(ring)][head] = py[:len(ring)][head] = 0.0
    px, py = px[:len(ring)], py[:len(ring)]
    return ring, at, px + dx, py + dy, px * dy, dx * py


def _sum(of: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Sums per group, added one after the other as an aggregate does."""
    return np.bincount(of, weights, n).astype(np.float64)


@np.errstate(all="ignore")
def measures(geoms: pa.Array) -> pa.Array:
    """struct<area, cx, cy>."""
    s = _Shapes(geoms)
    n, start = len(s.sizes), np.minimum(s.start, max(len(s.x) - 1, 0))
    ring, _, sx, sy, plus, minus = _around(s.x, s.y, start, s.sizes)
    cross = plus - minus
    a, mx, my = _sum(ring, cross, n), _sum(ring, sx * cross, n), _sum(ring, sy * cross, n)
    ox, oy = (s.x[start], s.y[start]) if len(s.x) else (a, a)
    w = np.sign(a) * np.where(s.hole, -1.0, 1.0)
    a, mx, my = (_sum(s.row_of_ring, v, len(geoms)) for v in (w * a, w * (mx + 3 * ox * a), w * (my + 3 * oy * a)))
    odd = s.odd | ~np.isfinite(a) | ~np.isfinite(mx) | ~np.isfinite(my)
    flat = a * 3 == 0
    return pa.StructArray.from_arrays([pa.array(a / 2), pa.array(mx / (a * 3), mask=flat), pa.array(my / (a * 3), mask=flat)],
                                      names=["area", "cx", "cy"], mask=pa.array(odd))


def _order(group, rank, x, y):
    """Order by group, rank and first vertex, and the places that only tie with the one before them."""
    order = np.lexsort((y, x, rank, group))
    same = lambda v: v[order][1:] == v[order][:-1]
    return order, order[1:][same(group) & same(rank) & same(x) & same(y)]


@np.errstate(all="ignore")
def canonical(geoms: pa.Array) -> pa.Array:
    """The form of `geometry.canonical`; a ring whose smallest vertex comes twice and lists that tie are left out."""
    s = _Shapes(geoms)
    if not len(s.x) or s.odd.all():
        return pa.nulls(len(geoms), geoms.type)
    start = np.minimum(s.start, len(s.x) - 1)
    end = np.maximum(start + s.sizes - 1, start)
    closed = (s.sizes > 1) & (s.x[start] == s.x[end]) & (s.y[start] == s.y[end])
    size = s.sizes - closed
    ring, at, _, _, plus, minus = _around(s.x, s.y, start, size)
    back = _sum(np.repeat(ring, 2), np.column_stack((plus, -minus)).ravel(), len(size)) * np.where(s.hole, -1.0, 1.0) < 0
    by_place = np.lexsort((s.y[at], s.x[at], ring))  # the first of each ring is its smallest vertex
    first = _starts(size)
    least = at[by_place[np.minimum(first, len(ring) - 1)]]
    twice = (s.x[at] == s.x[least[ring]]) & (s.y[at] == s.y[least[ring]]) & (at != least[ring])
    odd = s.odd
    odd[s.row_of_ring[ring[twice]]] = True
    fx, fy = s.x[least], s.y[least]
    order, ties = _order(s.part_of_ring, s.hole, fx, fy)
    odd[s.row_of_ring[ties]] = True
    shell = np.minimum(_starts(s.rings), len(fx) - 1)
    part_order, ties = _order(s.row_of_part, np.zeros(len(s.rings), bool), fx[shell], fy[shell])
    odd[s.row_of_part[ties]] = True
    # rings of the parts in their new order
    rings = s.rings[part_order]
    moved = order[np.repeat(_starts(s.rings)[part_order] - _starts(rings), rings) + np.arange(len(order))]
    k, n = (least - start)[moved], size[moved]
    turn = np.where(back[moved], -1, 1)
    out = np.where(n > 0, n + 1, 0)
    j = np.arange(out.sum()) - np.repeat(_starts(out), out)
    rep = lambda v: np.repeat(v, out)
    take = rep(start[moved]) + (rep(k) + rep(turn) * j) % rep(n)
    return _nested(s.parts, rings, out, s.x[take], s.y[take], odd)
