"""Best-fit packing in bulk-synchronous rounds.

A round sorts the pieces that are left and the gaps of the open sequences by size, from large to small, over ranges. In each
range a sweep gives every piece the smallest gap that holds it (its successor); what is left of that gap serves the same
sweep again while it is in the range. Pieces without a gap in their own range get those that larger ranges have left over,
nearest range first. Ranks decide who gets which: the k-th such gap takes as many as surely fit, after those that the gaps
before it took, so no two want the same place. Then gaps shrink, and the next round begins.

New sequences are opened by the largest pieces that found no gap and are longer than any gap that is left (or by any, once
hardly a piece finds one): as many as pieces of about this length need. Only counts per range and length come to the
driver. With few rows there is one range, and its sweep is the sequential algorithm.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.llm import arrays
from chronogeo.llm.byte_bpe import encoder
from chronogeo.llm.tables import BATCH_ROWS, cut, discard

RANGE = 100_000  # pieces and gaps in a range
MOST_RANGES = 5_000  # beyond it ranges get larger: a few numbers of each come to the driver
CHUNK = 1 << 19  # bytes of text that a task encodes together
FEW = 200  # if a round places less than this part of the pieces that it leaves, they all count as without a gap

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, unit long, inner int, unit_length int"
_EVENT = "part int, gap boolean, key long, size int, seq long, offset int, at int, n int"


def _piece_batches(path: str, size: int, end: int, small: int, with_ids: bool):
    """Pieces of whole texts. Those of up to `small` tokens are joined to units of up to twice that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, unit = encoder(path), TaskContext.get().partitionId() << 36
        for rows, data, offsets in arrays.chunks(batches, limit=CHUNK):
            raw = data.tobytes()
            found = coder.encode([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            n = len(found)
            total = np.array([len(x) + 1 for x in found], np.int64)
            ids = np.concatenate([x for own in found for x in (own, np.array([end], np.uint32))]).astype("<u4")
            first = np.cumsum(total) - total
            count = -(-total // size)
            doc = np.repeat(np.arange(n), count)
            piece = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            head = (total - (count - 1) * size)[doc]  # the first piece may be shorter
            start = np.where(piece == 0, 0, head + (piece - 1) * size)
            length = np.where(piece == 0, head, size)
            at = first[doc] + start
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            own, inner, whole = [], [], []
            room, lead = 0, 0  # of the unit that small pieces join
            for k, x in enumerate(length.tolist()):
                if x <= small and x <= room:
                    own.append(own[lead])
                    inner.append(2 * small - room)
                    whole.append(None)
                    whole[lead] += x
                    room -= x
                    continue
                own.append(unit)
                inner.append(0)
                whole.append(x)
                unit += 1
                if x <= small:
                    room, lead = 2 * small - x, k
            out = {"doc_id": rows.column(0).take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": start, "length": length,
                   "ids_crc32": pa.array(crc, pa.int64()), "unit": pa.array(own, pa.int64()), "inner": pa.array(inner, pa.int32()),
                   "unit_length": pa.array(whole, pa.int32())}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = 1024, end: int = 2, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, unit, inner, unit_length[, ids]): texts as ids plus `end`, cut from the back.

    Every piece but the first has `size` tokens. Null text counts as empty: one piece, the end id alone. `unit` is what is
    packed as one: a piece, or several small ones, then `inner` is the place in it and one of them knows its length.
    """
    if not 32 <= size <= 1 << 15:
        raise ValueError("size must be from 32 to 32768")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _piece_batches(tokenizer, size, end, size // 32, with_ids), _PIECE + ", ids array<int>" * with_ids)


def least_sequences(counts: np.ndarray, size: int) -> int:
    """Sequences that counts[i] pieces of length i need at least.

    The k-th dual feasible function counts a length as the share of `size` that k + 1 steps round it to; any set that fits
    counts as 1 at most, so the sum is a lower bound for each k.
    """
    length = np.arange(len(counts))
    best = -(-int((counts * length).sum()) // size)
    for k in range(1, 65):
        exact = (k + 1) * length % size == 0
        share = np.where(exact, k * length, (k + 1) * length // size * size)  # times k * size
        best = max(best, -(-int((counts * share).sum()) // (k * size)))
    return best


def _sweep_batches(size: int):
    """Sorted rows of one range (gap, key, size): largest first, gaps before pieces. Gives the rows of _EVENT.

    A piece with its sequence and offset has found a gap. Others have seq null and their rank in `at`. Gaps come with their
    room; `at` is the rank among those that smaller ranges may use, null if the room is below the range. Rows without a
    key hold the number `n` of such rows of one size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        rooms: dict[int, list[int]] = {}
        tally: Counter = Counter()
        mask, low, missed = 0, size, 0  # bit r: a gap with room r
        for batch in batches:
            out: list[tuple] = []
            for gap, key, x in zip(*(batch.column(i).to_pylist() for i in range(3))):
                low = x
                if gap:
                    rooms.setdefault(x, []).append(key)
                    mask |= 1 << x
                    continue
                above = mask >> x
                tally[False, x, bool(above)] += 1
                if not above:
                    out.append((part, False, key, x, None, None, missed, None))
                    missed += 1
                    continue
                room = x + (above & -above).bit_length() - 1
                own = rooms[room]
                seq = own.pop()
                if not own:
                    mask ^= 1 << room
                out.append((part, False, key, x, seq, size - room, None, None))
                if room > x:
                    rooms.setdefault(room - x, []).append(seq)
                    mask |= 1 << (room - x)
            yield _events(out)
        rank = 0
        for room in sorted(rooms, reverse=True):
            keys, usable = rooms[room], room >= low
            if keys:
                tally[True, room, not usable] = len(keys)
            for lo in range(0, len(keys), 10_000):
                some = keys[lo:lo + 10_000]
                yield _events([(part, True, key, room, None, None, rank + i if usable else None, None) for i, key in enumerate(some)])
                rank += len(some) * usable
        yield _events([(part, gap, None, x, None, None, None if done else 0, n) for (gap, x, done), n in tally.items()])

    return run


def _events(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["part", "gap", "key", "size", "seq", "offset", "at", "n"])


def _meet(missed: dict[int, list[int]], spare: dict[int, list[int]]) -> tuple[list[tuple], dict[int, int]]:
    """(part, lo, hi, gap_part, top, per): pieces lo .. hi - 1 without a gap of a range go to the gaps top, top - 1, .. of another.

    Each gap takes as many as fit by the least room and the greatest length. Ranges are numbered from large to small; given
    are the counts of pieces with the greatest length, and of gaps with the least room. Also the first piece of each range
    that stays without a gap.
    """
    stack: list[list[int]] = []
    rows, alone = [], {}
    for part in sorted({*missed, *spare}):
        lo, (n, longest) = 0, missed.get(part, (0, 1))
        while lo < n and stack:
            gap_part, left, room = stack[-1]
            per = room // longest
            units = min(left * per, n - lo)
            rows.append((part, lo, lo + units, gap_part, left - 1, per))
            lo += units
            stack[-1][1] -= -(-units // per)
            if not stack[-1][1]:
                stack.pop()
        if lo < n:
            alone[part] = lo
        if part in spare:
            stack.append([part, *spare[part]])
    return rows, alone


def _openings(counts: np.ndarray, room: int, placed: int, size: int) -> int:
    """How many of the largest pieces without a gap begin sequences; counts: these pieces by length.

    Those longer than any gap has `room` for must; if hardly any piece was placed, all count. Of lengths of which j fit
    into a sequence, any j do; so every j-th begins one. From four a sequence on, the lower bound decides.
    """
    left = np.flatnonzero(counts)
    if not len(left):
        return 0
    longest = int(left[-1])
    stuck = counts.copy()
    if placed * FEW >= counts.sum():
        stuck[:room + 1] = 0
    if not stuck.any():
        return 0
    j = size // longest
    if j < 4:
        return -(-int(stuck[size // (j + 1) + 1:].sum()) // j)
    return min(least_sequences(stuck, size), int(stuck.sum()))


def _round(units: DataFrame, gaps: DataFrame, rows: int, size: int) -> tuple[DataFrame, int, int]:
    """One round over (key, size): rows of pieces (seq: placed) and gaps as (gap, key, size, seq, offset), and how many are left."""
    spark = units.sparkSession
    events = gaps.select(F.lit(True).alias("gap"), "key", "size").unionByName(units.select(F.lit(False).alias("gap"), "key", "size"))
    order = [F.desc("size"), F.desc("gap"), F.asc("key")]
    n_ranges = min(math.ceil(rows / RANGE), MOST_RANGES)
    ranges = events.repartitionByRange(n_ranges, *order) if n_ranges > 1 else events.repartition(1)  # RANGE rows at most
    swept = cut(ranges.sortWithinPartitions(*order).mapInArrow(_sweep_batches(size), _EVENT))
    # Ranges are ordered by size, so there are about as many sums as ranges and lengths.
    table = sorted(swept.filter("key IS NULL").select("part", "gap", "size", F.col("at").isNull().alias("off"), "n").collect(), key=lambda r: (r["part"], -r["size"]))
    missed, spare = {}, {}  # how many, and the greatest length or the least room
    top, low = {}, {}  # the most room and the least length
    for r in table:
        if not r["off"]:
            mine, own = (spare, top) if r["gap"] else (missed, low)
            n, x = mine.get(r["part"], (0, r["size"]))
            mine[r["part"]] = [n + r["n"], r["size"] if r["gap"] else x]
            own[r["part"]] = top.get(r["part"], r["size"]) if r["gap"] else r["size"]
    ways, alone = _meet(missed, spare)
    # The most room that a gap has after this round, and the lengths of the pieces that found none.
    room = max([0, *(r["size"] for r in table if r["gap"] and r["off"]),
                *(top[w[3]] - low[w[0]] * (w[5] if (w[2] - w[1]) % w[5] == 0 else 1) for w in ways)])
    counts, skip = np.zeros(size + 1, np.int64), dict(alone)
    for r in table:
        if r["part"] in alone and not r["gap"] and not r["off"]:
            passed = min(skip[r["part"]], r["n"])
            skip[r["part"]] -= passed
            counts[r["size"]] += r["n"] - passed
    n = int(counts.sum())
    opened = _openings(counts, room, sum(r["n"] for r in table if not r["gap"]) - n, size)
    took = np.minimum(counts, np.maximum(opened - (n - np.cumsum(counts)), 0))  # the largest open
    shortest = int(np.append(np.flatnonzero(counts - took), size + 1)[0])

    def row(gap: bool, key, x, seq=None, offset=None):
        return F.struct(F.lit(gap).alias("gap"), F.col(key).alias("key"), x.cast("int").alias("size"),
                        F.lit(seq).cast("long").alias("seq"), F.lit(offset).cast("int").alias("offset"))

    def spread(df: DataFrame, *made) -> DataFrame:
        return df.select(F.explode(F.filter(F.array(*made), lambda r: r.isNotNull())).alias("r")).select("r.*")

    out = swept.filter("at IS NULL AND key IS NOT NULL").select("gap", "key", "size", "seq", "offset")
    rest = swept.filter("at IS NOT NULL AND key IS NOT NULL").select("part", "gap", "at", "key", "size")
    spares, without = rest.filter("gap"), rest.filter("NOT gap")
    if ways:  # a few rows per range
        way = F.broadcast(spark.createDataFrame(ways, "part int, lo int, hi int, gap_part int, top int, per int"))
        spots = (without.join(way, "part").filter("at >= lo AND at < hi")
                 .select(F.col("gap_part").alias("part"), F.expr("top - (at - lo) div per").cast("int").alias("at"),
                         F.struct(F.col("at").alias("rank"), F.col("key").alias("unit"), F.col("size").alias("need")).alias("taken"))
                 .groupBy("part", "at").agg(F.array_sort(F.collect_list("taken")).alias("taken")))  # what one gap takes
        out = out.unionByName(spares.join(spots, ["part", "at"], "left").select(F.explode(F.concat(
            F.array(row(True, "key", F.col("size") - F.aggregate(F.coalesce("taken.need", F.array().cast("array<int>")), F.lit(0), lambda a, x: a + x))),
            F.coalesce(F.transform("taken", lambda t, i: F.struct(
                F.lit(False).alias("gap"), t["unit"].alias("key"), t["need"].alias("size"), F.col("key").alias("seq"),
                (F.lit(size) - F.col("size") + F.aggregate(F.slice(F.col("taken.need"), F.lit(1), i), F.lit(0), lambda a, x: a + x)).cast("int").alias("offset"))),
                F.array().cast("array<struct<gap:boolean,key:bigint,size:int,seq:bigint,offset:int>>")))).alias("r")).select("r.*"))
    elif spare:
        out = out.unionByName(spread(spares, row(True, "key", F.col("size"))))
    if alone:
        base = np.cumsum([0, *(missed[part][0] - first for part, first in sorted(alone.items()))]).tolist()
        firsts = spark.createDataFrame([(part, first, b) for (part, first), b in zip(sorted(alone.items()), base)], "part int, first int, base long")
        opens = F.col("base") + F.col("at") - F.col("first") < opened
        out = out.unionByName(spread(
            without.join(F.broadcast(firsts), "part").filter("at >= first"),
            F.when(opens, row(False, "key", F.col("size"), F.col("key"), 0)).otherwise(row(False, "key", F.col("size"))),
            F.when(opens, row(True, "key", F.lit(size) - F.col("size")))))
    state = cut(out.filter(~F.col("gap") | (F.col("size") >= shortest)))
    discard(swept)
    return state, n - opened, opened + sum(r["n"] for r in table if r["gap"])


def lay_out(found: DataFrame, size: int = 1024) -> DataFrame:
    """(unit, sequence_id, offset) for the units of `found` (see pieces), which must be a stored table."""
    whole = found.filter("unit_length IS NOT NULL").select(F.col("unit").alias("key"), F.col("unit_length").alias("size"))
    units = whole.filter(F.col("size") < size)
    out = whole.filter(F.col("size") == size).select(F.col("key").alias("unit"), F.col("key").alias("sequence_id"), F.lit(0).alias("offset"))
    left, gaps, n_gaps = units.count(), units.limit(0), 0
    while left:
        state, left, n_gaps = _round(units, gaps, left + n_gaps, size)
        out = out.unionByName(state.filter("NOT gap AND seq IS NOT NULL").select(F.col("key").alias("unit"), F.col("seq").alias("sequence_id"), "offset"))
        units = state.filter("NOT gap AND seq IS NULL").select("key", "size")
        gaps = state.filter("gap").select("key", "size")
    return out


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end: int = 2, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset), one row per piece.

    Sequences have at most `size` tokens and offsets without gaps from 0. Only texts of more tokens are cut. Rows are packed
    by themselves, also if ids repeat or are null. Other columns are ignored; an empty table gives no rows.
    """
    found = cut(pieces(docs, tokenizer, size, end, with_ids), BATCH_ROWS)
    placed = lay_out(found, size)
    return found.join(placed, "unit").select(
        "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids, "sequence_id", (F.col("offset") + F.col("inner")).alias("offset"))
