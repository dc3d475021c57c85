"""Projections of all vertices of a batch of geometries at once.

The same formulas as `geometry.project_point`, over whole coordinate arrays: the series of the transverse Mercator
projection make hundreds of expressions per vertex, which are slow one by one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from chronogeo.functions import constants as K


def _lonlat_to_mercator(x, y, none_x, none_y):
    t = np.tan(np.radians(y) / 2 + math.pi / 4)
    return np.radians(x) * K.WGS84_A, _log(t) * K.WGS84_A, none_x, none_y | (t <= 0)


def _mercator_to_lonlat(x, y, none_x, none_y):
    return np.degrees(x / K.WGS84_A), np.degrees(np.arctan(np.sinh(y / K.WGS84_A))), none_x, none_y


def _log(v):
    """Numbers up to 0 have no logarithm; the caller marks them as NULL."""
    return np.log(np.where(v <= 0, 1.0, v))


def _atanh(v):
    return _log((1 + v) / (1 - v)) / 2


def _asinh(v):
    return np.sign(v) * np.log(np.abs(v) + np.sqrt(v * v + 1))


def _series(coef, xi, eta, outer, inner):
    return sum(c * outer(2 * k * xi) * inner(2 * k * eta) for k, c in enumerate(coef, 1))


def _lonlat_to_utm33(x, y, none_x, none_y):
    lam, sin_phi = np.radians(x - K.UTM33_LON0), np.sin(np.radians(y))
    none = none_x | none_y | (sin_phi <= -1)
    tau = np.sinh(_atanh(sin_phi) - K.E * _atanh(K.E * sin_phi))
    xi, eta = np.arctan2(tau, np.cos(lam)), _asinh(np.sin(lam) / np.sqrt(tau * tau + np.cos(lam) * np.cos(lam)))
    scale = K.UTM_K0 * K.RADIUS
    return (K.UTM_EASTING + scale * (eta + _series(K.ALPHA, xi, eta, np.cos, np.sinh)),
            scale * (xi + _series(K.ALPHA, xi, eta, np.sin, np.cosh)), none, none)


def _utm33_to_lonlat(x, y, none_x, none_y):
    scale = K.UTM_K0 * K.RADIUS
    xi, eta = y / scale, (x - K.UTM_EASTING) / scale
    xi, eta = xi - _series(K.BETA, xi, eta, np.sin, np.cosh), eta - _series(K.BETA, xi, eta, np.cos, np.sinh)
    goal = np.sin(xi) / np.sqrt(np.sinh(eta) * np.sinh(eta) + np.cos(xi) * np.cos(xi))
    t, e2 = goal, 1 - K.E**2
    for _ in range(4):  # Newton steps from tan(conformal latitude) to tan(latitude)
        sigma = np.sinh(K.E * _atanh(K.E * t / np.sqrt(1 + t * t)))
        here = t * np.sqrt(1 + sigma * sigma) - sigma * np.sqrt(1 + t * t)
        t = t + (goal - here) / (e2 * np.sqrt(1 + here * here) * np.sqrt(1 + t * t) / (1 + e2 * t * t))
    none = none_x | none_y
    return K.UTM33_LON0 + np.degrees(np.arctan2(np.sinh(eta), np.cos(xi))), np.degrees(np.arctan(t)), none, none


_TO_LONLAT = {3857: _mercator_to_lonlat, 32633: _utm33_to_lonlat}
_FROM_LONLAT = {3857: _lonlat_to_mercator, 32633: _lonlat_to_utm33}


def lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) if len(lists) else np.zeros(0, np.int64)


def values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    none = column.is_null().to_numpy(zero_copy_only=False)
    return np.where(none, 0.0, column.to_numpy(zero_copy_only=False)), none


def project(geoms: pa.Array, srids: pa.Array, dst: int) -> pa.Array:
    """Every geometry from its own system to `dst`; all lists and their NULLs stay as they are."""
    levels, at, row = [], geoms, np.arange(len(geoms))
    for _ in range(3):
        sizes = lengths(at)
        levels.append((sizes, at.is_null()))
        row = np.repeat(row, sizes)
        # where there are no items, an array from Spark may lack its buffers
        at = at.flatten() if sizes.any() else pa.array([], at.type.value_type)
    (x, none_x), (y, none_y) = map(values, at.flatten())
    system = srids.fill_null(0).to_numpy(zero_copy_only=False)[row]
    with np.errstate(all="ignore"):
        for src in np.unique(system).tolist():
            here = system == src
            if src == dst:
                continue
            part = (x[here], y[here], none_x[here], none_y[here])
            if src in _TO_LONLAT:
                part = _TO_LONLAT[src](*part)
            if dst in _FROM_LONLAT:
                part = _FROM_LONLAT[dst](*part)
            x[here], y[here], none_x[here], none_y[here] = part
    out = pa.StructArray.from_arrays([pa.array(x, mask=none_x), pa.array(y, mask=none_y)], names=["x", "y"])
    for sizes, none in reversed(levels):
        out = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype("i4")), out, mask=none)
    return out
