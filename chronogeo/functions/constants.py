"""Fixed values of the projections."""

from __future__ import annotations

import math

# WGS84 ellipsoid and the transverse Mercator zone 33N frame.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0, UTM_EASTING, UTM33_LON0 = 0.9996, 500000.0, 15.0

N = WGS84_F / (2 - WGS84_F)
E = math.sqrt(WGS84_F * (2 - WGS84_F))
RADIUS = WGS84_A / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)

# Krüger series in the third flattening n, orders 1..6.
ALPHA = [
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180 - 127 * N**5 / 288 + 7891 * N**6 / 37800,
    13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440 + 281 * N**5 / 630 - 1983433 * N**6 / 1935360,
    61 * N**3 / 240 - 103 * N**4 / 140 + 15061 * N**5 / 26880 + 167603 * N**6 / 181440,
    49561 * N**4 / 161280 - 179 * N**5 / 168 + 6601661 * N**6 / 7257600,
    34729 * N**5 / 80640 - 3418889 * N**6 / 1995840,
    212378941 * N**6 / 319334400,
]
BETA = [
    N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360 - 81 * N**5 / 512 + 96199 * N**6 / 604800,
    N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440 + 46 * N**5 / 105 - 1118711 * N**6 / 3870720,
    17 * N**3 / 480 - 37 * N**4 / 840 - 209 * N**5 / 4480 + 5569 * N**6 / 90720,
    4397 * N**4 / 161280 - 11 * N**5 / 504 - 830251 * N**6 / 7257600,
    4583 * N**5 / 161280 - 108847 * N**6 / 3991680,
    20648693 * N**6 / 638668800,
]
