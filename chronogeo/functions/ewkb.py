"""Hex EWKB <-> nested geometry arrays.

Spark has no expression that turns bytes into doubles, so these column functions
are the only Python workers of the package. They move whole Arrow batches: a
batch is one byte buffer, headers are read ring by ring, and all coordinates are
gathered or laid out at once.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from chronogeo.functions.geometry import GEOMETRY_TYPE

# Fixed values of the EWKB layout.
POLYGON, MULTIPOLYGON = 3, 6
SRID_FLAG, Z_FLAG, M_FLAG = 0x20000000, 0x80000000, 0x40000000

_HEX = np.frombuffer(b"".join(b"%02X" % i for i in range(256)), np.uint8).reshape(256, 2)


def _read_header(buf, at: int):
    order = "<" if buf[at] == 1 else ">"
    (code,) = struct.unpack_from(order + "I", buf, at + 1)
    at += 5
    srid = None
    if code & SRID_FLAG:
        (srid,) = struct.unpack_from(order + "I", buf, at)
        at += 4
    dims = 2 + bool(code & Z_FLAG) + bool(code & M_FLAG)
    return order, code & 0x0FFFFFFF, srid, dims, at


def _walk_polygon(buf, at: int, rings: list[tuple[int, int, int, bool]]):
    """Note (position, points, dimensions, little-endian) of every ring; number of rings and the position behind."""
    order, kind, _, dims, at = _read_header(buf, at)
    if kind != POLYGON:
        raise ValueError(f"EWKB geometry type {kind} is not a polygon")
    (n_rings,) = struct.unpack_from(order + "I", buf, at)
    at += 4
    for _ in range(n_rings):
        (n,) = struct.unpack_from(order + "I", buf, at)
        rings.append((at + 4, n, dims, order == "<"))
        at += 4 + n * dims * 8
    return n_rings, at


def _walk(buf, at: int, rings: list) -> list[int]:
    """Rings per part of the geometry at `at`."""
    order, kind, _, _, start = _read_header(buf, at)
    if kind == POLYGON:
        return [_walk_polygon(buf, at, rings)[0]]
    if kind != MULTIPOLYGON:
        raise ValueError(f"EWKB geometry type {kind} is not supported")
    (n_parts,) = struct.unpack_from(order + "I", buf, start)
    at, sizes = start + 4, []
    for _ in range(n_parts):
        n, at = _walk_polygon(buf, at, rings)
        sizes.append(n)
    return sizes


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0 to n-1 for each size n, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _coordinates(raw: np.ndarray, rings: list[tuple[int, int, int, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """(n, 2) coordinates of all rings, and the points of each."""
    at, n, dims, little = np.array(rings, np.int64).reshape(-1, 4).T
    place = np.repeat(at, n) + _steps(n) * np.repeat(dims * 8, n)
    xy = raw[place[:, None] + np.arange(16)].view("<f8")
    big = np.repeat(little == 0, n)
    xy[big] = xy[big].byteswap()
    return xy, n


def _offsets(sizes) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(np.asarray(sizes, np.int64))).astype("i4"))


def _decode(batch: pa.Array) -> pa.Array:
    texts = batch.drop_null().to_pylist()
    buf = bytes.fromhex("".join(texts))
    ends = np.cumsum([len(t) // 2 for t in texts], dtype=np.int64)
    rings: list = []
    shapes = [_walk(buf, at, rings) for at in [0, *ends[:-1].tolist()][:len(texts)]]
    xy, points = _coordinates(np.frombuffer(buf, np.uint8), rings)
    pts = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    level = pa.ListArray.from_arrays(_offsets(points), pts)
    level = pa.ListArray.from_arrays(_offsets([n for s in shapes for n in s]), level)
    none = batch.is_null().to_numpy(zero_copy_only=False)
    parts = np.zeros(len(batch), np.int64)
    parts[~none] = [len(s) for s in shapes]
    return pa.ListArray.from_arrays(_offsets(parts), level, mask=pa.array(none))


def _decode_srid(batch: pa.Array) -> pa.Array:
    heads = [None if v is None else bytes.fromhex(v[:18]) for v in batch.to_pylist()]
    return pa.array([None if h is None else _read_header(h, 0)[2] or 0 for h in heads], pa.int32())


def _lengths(lists: pa.Array) -> np.ndarray:
    if not len(lists):
        return np.zeros(0, np.int64)
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _items(lists: pa.Array) -> pa.Array:
    """The items of all lists. Where there are none, an array from Spark may lack its buffers, so it is not touched."""
    return lists.flatten() if _lengths(lists).any() else pa.array([], lists.type.value_type)


def _put(buf: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Write each little-endian value at its position."""
    values = np.ascontiguousarray(values)
    buf[at[:, None] + np.arange(values.dtype.itemsize)] = values.view(np.uint8).reshape(-1, values.dtype.itemsize)


def _before(sizes: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Bytes of the earlier items of the same owner; items of an owner stand together."""
    total = np.bincount(owner, sizes, owners).astype(np.int64)
    return np.cumsum(sizes) - sizes - (np.cumsum(total) - total)[owner]


def _encode(geoms: pa.Array, srids: pa.Array) -> pa.Array:
    """Little-endian multipolygons as upper-case hex."""
    parts = _items(geoms)
    rings = _items(parts)
    x, y = _items(rings).flatten()
    n_parts, n_rings, n_points = _lengths(geoms), _lengths(parts), _lengths(rings)
    row, part = np.repeat(np.arange(len(geoms)), n_parts), np.repeat(np.arange(len(parts)), n_rings)
    ring = np.repeat(np.arange(len(rings)), n_points)
    none = geoms.is_null().to_numpy(zero_copy_only=False)
    srid = srids.fill_null(0).to_numpy(zero_copy_only=False).astype("<u4")
    head = np.where(none, 0, 9 + 4 * (srid != 0))
    ring_bytes = 4 + 16 * n_points
    part_bytes = 9 + np.bincount(part, ring_bytes, len(parts)).astype(np.int64)
    row_bytes = head + np.bincount(row, part_bytes, len(geoms)).astype(np.int64)
    row_at = np.cumsum(row_bytes) - row_bytes
    part_at = row_at[row] + head[row] + _before(part_bytes, row, len(geoms))
    ring_at = part_at[part] + 9 + _before(ring_bytes, part, len(parts))
    buf = np.zeros(row_bytes.sum(), np.uint8)
    full, tagged = ~none, ~none & (srid != 0)
    buf[row_at[full]] = 1
    _put(buf, row_at[full] + 1, np.where(srid[full] != 0, MULTIPOLYGON | SRID_FLAG, MULTIPOLYGON).astype("<u4"))
    _put(buf, row_at[tagged] + 5, srid[tagged])
    _put(buf, (row_at + head)[full] - 4, n_parts[full].astype("<u4"))
    buf[part_at] = 1
    _put(buf, part_at + 1, np.full(len(parts), POLYGON, "<u4"))
    _put(buf, part_at + 5, n_rings.astype("<u4"))
    _put(buf, ring_at, n_points.astype("<u4"))
    point_at = ring_at[ring] + 4 + 16 * _steps(n_points)
    for k, values in enumerate((x, y)):
        _put(buf, point_at + 8 * k, values.to_numpy(zero_copy_only=False).astype("<f8"))
    text = pa.StringArray.from_buffers(len(geoms), _offsets(2 * row_bytes).buffers()[1], pa.py_buffer(_HEX[buf].tobytes()))
    return pc.if_else(pa.array(none), pa.scalar(None, pa.string()), text)


def decode_ewkb(hex_text: Column) -> Column:
    return F.arrow_udf(_decode, GEOMETRY_TYPE)(hex_text)


def ewkb_srid(hex_text: Column) -> Column:
    return F.arrow_udf(_decode_srid, "int")(hex_text)


def encode_ewkb(geom: Column, srid: Column) -> Column:
    return F.arrow_udf(_encode, "string")(geom, srid)
