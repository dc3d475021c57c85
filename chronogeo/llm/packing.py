"""Packing token sequences: cutting stock over a histogram of piece lengths, patterns dealt to ranked pieces.

Texts become ids and are cut at multiples of the sequence length, so all but the last piece of a document fill a
sequence. The lengths of the rest, counted in classes of a few tokens, are the histogram that the driver solves. A piece
then needs only its rank within its class to know its sequence; ranks come from counts per slice of a class, so even a
length that a third of all pieces has is numbered by many tasks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronogeo.llm import arrays, stock
from chronogeo.llm.tables import BATCH_ROWS, cut
from chronogeo.llm.tokens import encoder

STEP = 8  # tokens in a length class
SLICE = 100_000  # pieces ranked by one task


def _piece_batches(path: str, size: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for rows, data, offsets in arrays.chunks(batches):
            ids, bounds = coder.encode(data, offsets)
            n = rows.num_rows
            ids = np.insert(ids, bounds[1:], end).astype("<u4")
            first = bounds + np.arange(n + 1)
            total = np.diff(first)
            count = -(-total // size)
            doc = np.repeat(np.arange(n), count)
            start = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * size
            length = np.minimum(size, total[doc] - start)
            at = first[doc] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            out = {"doc_id": rows.column(0).take(pa.array(doc)), "start": start, "length": length,
                   "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": total[doc].astype(np.int64)}
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 1, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): the texts as ids plus `end`, cut every `size` tokens.

    Null text counts as empty: one piece with the end id alone. A row is cut by itself, also if ids repeat or are null.
    """
    if size > 1 << 14 or size % STEP:
        raise ValueError(f"size must be a multiple of {STEP} up to {1 << 14}")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _piece_batches(tokenizer, size, end, with_ids),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids)


def _ranked(found: DataFrame, n: int) -> DataFrame:
    """`found` with `class` and `rank` from 0 within the class."""
    slices = max(1, math.ceil(n / SLICE))
    dealt = (found.withColumn("class", F.ceil(F.col("length") / STEP).cast("int"))
             .withColumn("slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(slices)).cast("int")))
    before = Window.partitionBy("class").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (dealt.groupBy("class", "slice").agg(F.count("*").alias("k"))
             .withColumn("base", F.coalesce(F.sum("k").over(before), F.lit(0))).drop("k"))
    inside = Window.partitionBy("class", "slice").orderBy("doc_id", "start", "ids_crc32")
    return (dealt.withColumn("inside", F.row_number().over(inside) - 1).join(bases, ["class", "slice"])
            .withColumn("rank", F.col("base") + F.col("inside")).drop("slice", "inside", "base"))


def _slots(plan: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, rank after the last, first sequence, pieces of the class in a sequence)."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, pattern in plan:
        for size, per in pattern.items():
            first = taken.get(size, 0)
            taken[size] = first + times * per
            rows.append((size, first, first + times * per, sequence, per))
        sequence += times
    return rows


def lay_out(found: DataFrame, size: int = 2048) -> DataFrame:
    """`found` (see pieces) with sequence_id and offset: sequences of at most `size` tokens, offsets gapless from 0."""
    counts = {r["class"]: r["k"] for r in found.groupBy(F.ceil(F.col("length") / STEP).alias("class")).agg(F.count("*").alias("k")).collect()}
    demand = np.zeros(size // STEP, np.int64)  # at most 2048 classes come to the driver
    for k, n in counts.items():
        demand[k - 1] = n
    full, demand[-1] = int(demand[-1]), 0
    plan = ([(full, {len(demand): 1})] if full else []) + stock.plan(demand)
    slots = found.sparkSession.createDataFrame(_slots(plan), "class int, lo long, hi long, base long, per int")
    ranked = _ranked(found, sum(counts.values()))
    placed = (ranked.join(F.broadcast(slots), "class").filter("rank >= lo AND rank < hi")
              .withColumn("sequence_id", F.col("base") + F.expr("(rank - lo) div per")).drop("class", "rank", "lo", "hi", "base", "per"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 1, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id, offset), one row per piece.

    Every id of every document is in exactly one piece. Other columns are ignored; an empty table gives no rows.
    """
    return lay_out(cut(pieces(docs, tokenizer, size, end, with_ids), BATCH_ROWS), size)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing with ids: at most one sequence's pieces are gathered."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"))
