"""Centroid clustering with Orchard's search for the nearest centroid.

Every centroid has a list of the others by distance. A vector walks the list of its present centroid; as soon as a closer
one turns up, the walk goes on with that one's list, and centroids met before are passed over. It ends where the list is
strictly beyond twice the distance to the present centroid: by the triangle inequality nothing closer, and no equally
close one with a smaller number, can follow. All vectors of a batch walk at once.

Vectors never move between tasks. A task sends one sum per centroid and component, so a vector that a third of all rows
repeat costs no more than any other, and the driver holds the k centroids only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.llm.tables import cut


def neighbours(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances between centroids, and for each the others from near to far."""
    gap = ((centres[:, None] - centres[None]) ** 2).sum(2)
    number = np.arange(len(centres))
    order = [np.lexsort((number, row))[:] for row in gap]
    return gap, np.array([own[own != i] for i, own in enumerate(order)]).reshape(len(centres), -1)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of each vector, the smaller number of equally near ones, and the squared distance."""
    gap, near = neighbours(centres)
    at, place = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    dist = ((x - centres[0]) ** 2).sum(1)
    seen = np.zeros((len(x), len(centres)), bool)
    seen[:, 0] = True
    live = np.arange(len(x))
    while True:
        live = live[place[live] < near.shape[1]]
        other = near[at[live], place[live]]
        go = gap[at[live], other] <= 4 * dist[live]
        live, other = live[go], other[go]
        if not len(live):
            return at, dist
        place[live] += 1
        new = ~seen[live, other]
        row, other = live[new], other[new]
        seen[row, other] = True
        d = ((x[row] - centres[other]) ** 2).sum(1)
        closer = (d < dist[row]) | ((d == dist[row]) & (other < at[row]))
        row = row[closer]
        at[row], dist[row], place[row] = other[closer], d[closer], 0


def _integer_batches(dims: int, scale: int):
    limit = int((2**60 // (4 * dims)) ** 0.5)  # four times a squared distance stays below 2**63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            whole = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(column), dims), False))
            values = whole.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)  # null: NaN
            keep = np.isfinite(values).all(1)
            x = np.floor(scale * values[keep])
            if x.size and np.abs(x).max() > limit:
                raise ValueError(f"components beyond {limit / scale:g} would leave the range of 64-bit distances")
            flat = pa.array(x.astype(np.int64).ravel())
            yield pa.RecordBatch.from_arrays(
                [whole.column(0).filter(pa.array(keep)), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dims, pa.int32()), flat)],
                names=["vec_id", "x"])

    return run


def integer_vectors(vectors: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, x): floor(scale * component) of the vectors with exactly `dims` components, none null or not finite."""
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(
        _integer_batches(dims, scale), "vec_id long, x array<long>")


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sum_batches(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(len(centres), np.int64), np.zeros_like(centres)
        for batch in batches:
            x = _rows(batch, centres.shape[1])
            at, _ = nearest(x, centres)
            count += np.bincount(at, minlength=len(centres))
            order = np.argsort(at, kind="stable")
            own, first = np.unique(at[order], return_index=True)
            if len(own):
                total[own] += np.add.reduceat(x[order], first)
        used = np.flatnonzero(count)
        bounds = pa.array(np.arange(len(used) + 1) * centres.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(count[used]), pa.ListArray.from_arrays(bounds, pa.array(total[used].ravel()))],
            names=["cluster", "n", "sums"])

    return run


def _assign_batches(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, dist = nearest(_rows(batch, centres.shape[1]), centres)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int32()), pa.array(dist)], names=["vec_id", "cluster", "distance"])

    return run


def _moved(stored: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Floors of the means of all vectors by nearest centroid; k * dims sums come to the driver."""
    parts = stored.mapInArrow(_sum_batches(centres), "cluster int, n long, sums array<long>")
    sums = (parts.select("cluster", "n", F.posexplode("sums").alias("i", "v")).groupBy("cluster", "i")
            .agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect())
    out = centres.copy()
    for r in sums:
        out[r["cluster"], r["i"]] = r["v"] // r["n"]
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, salt: str = "1:") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector.

    Vectors with another number of components, or with null or not finite ones, are left out. The rest become integers.
    The centroids start as the k vectors with the smallest sha256 of `salt` and id (a missing id: last; then by content);
    with fewer vectors there are fewer. Each round moves every centroid that has vectors to the exact floor of their mean;
    then all vectors are assigned once more. A repeated row counts and comes out as often as it went in. An empty table
    gives no rows; other columns are ignored. Components too large for 64-bit distances raise an error.
    """
    spark = vectors.sparkSession
    stored = cut(integer_vectors(vectors, dims, scale))
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    seeds = stored.select(key.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k).collect()
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not seeds:
        return stored.select("vec_id").crossJoin(F.broadcast(spark.createDataFrame([], schema))).select(
            "vec_id", "cluster", F.lit(0).cast("long").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")
    centres = np.array([r["x"] for r in seeds], np.int64)
    for _ in range(rounds):
        centres = _moved(stored, centres)
    assigned = cut(stored.select("vec_id", "x").mapInArrow(_assign_batches(centres), "vec_id long, cluster int, distance long"))
    own = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(c, s, sum(own.values()), hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest()) for c, s in own.items()]
    return assigned.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
