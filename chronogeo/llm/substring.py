"""Substring deduplication by recompression.

Two naming rounds on runs and pairs of symbols turn a text into higher symbols. A name is a hash of what it stands for,
so equal substrings get equal names in every task and no round needs a shuffle. With runs of two and two rounds of pairs
a symbol spans at most 8 words, and where it begins and what it is depends on at most 8 words at either side: any window
of 50 words holds whole symbols that every other occurrence of the window holds as well.

Each window picks the symbol with the smallest name among those it is sure of. Neighbouring windows that pick the same
one are a segment: one row instead of one per window. Spark then

1. keeps the segments whose symbol, named with its neighbourhood, is in two documents,
2. gives up every segment whose whole word sequence is in an earlier document,
3. verifies window by window only the first holders of segments that share a symbol but differ further out (the ends of
   repeats), and
4. removes the union of the windows found.

Every step is an aggregate with partial sums or a join on a hash, so frequent passages need no task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.llm import arrays
from chronogeo.llm.tables import BATCH_ROWS, cut, discard, with_key

ROUNDS = ("run", "pair", "pair")
SPAN = 8  # words in a symbol at most, and words at either side that decide on it
MIN_WORDS = 4 * SPAN  # below this a window could hold no symbol that is sure


def _merge(name: np.ndarray, at: np.ndarray, doc: np.ndarray, first: np.ndarray, round_no: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replace the chosen neighbours by one symbol each; first[i]: symbol i begins such a pair."""
    i = np.flatnonzero(first)
    name[i] = arrays.mix(name[i] * np.uint64(3) + arrays.mix(name[i + 1] + np.uint64(round_no)))
    keep = np.ones(len(name), bool)
    keep[i + 1] = False
    return name[keep], at[keep], doc[keep]


def recompress(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and first words of the symbols after all rounds."""
    name, at = names.copy(), np.arange(len(names))
    for k, kind in enumerate(ROUNDS):
        n = len(name)
        if n < 2:
            break
        first = np.zeros(n, bool)
        same = doc[:-1] == doc[1:]
        if kind == "run":  # runs of exactly two; longer ones stay single symbols, which bounds the span
            equal = np.zeros(n + 1, bool)
            equal[1:n] = (name[:-1] == name[1:]) & same
            first[:-1] = equal[1:n] & ~equal[:n - 1] & ~equal[2:]
        else:
            side = ((arrays.mix(name + np.uint64(0x1000 + k)) >> np.uint64(17)) & np.uint64(1)).astype(bool)
            first[:-1] = ~side[:-1] & side[1:] & same
        name, at, doc = _merge(name, at, doc, first, k)
    return name, at


def _window_minima(rank: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value, the last of equal ones, in each run of `width` values."""
    value, index, size = rank, np.arange(len(rank)), 1
    while size < width:
        step = min(size, width - size)
        a, b = value[:len(value) - step], value[step:]
        right = b <= a
        value, index = np.where(right, b, a), np.where(right, index[step:], index[:len(index) - step])
        size += step
    return index


def segments(w: arrays.Words, size: int) -> tuple[np.ndarray, ...]:
    """First word, number of windows, symbol name and content hash of each segment."""
    start = arrays.windows(w, size)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    name, at = recompress(w.hash, w.doc)
    rank = np.full(len(w.hash), np.iinfo(np.uint64).max, np.uint64)
    rank[at] = arrays.mix(name)
    symbol = _window_minima(rank, size - 3 * SPAN + 1)[start + SPAN]
    opens = np.ones(len(start), bool)
    opens[1:] = (symbol[1:] != symbol[:-1]) | (start[1:] != start[:-1] + 1)
    heads = np.flatnonzero(opens)
    n = np.diff(np.append(heads, len(start)))
    first, symbol = start[heads], symbol[heads]
    sums = arrays.prefix_sums(arrays.mix(w.hash))
    anchor = arrays.span_hash(sums, symbol - SPAN, symbol + 2 * SPAN)
    return first, n, anchor.view(np.int64), arrays.span_hash(sums, first, first + n - 1 + size).view(np.int64)


def _segment_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.chunks(batches):
            w = arrays.words(data, offsets)
            first, n, anchor, content = segments(w, size)
            if len(first):
                row = w.doc[first]
                yield pa.RecordBatch.from_pydict({
                    "ord": rows.column(0).take(pa.array(row)), "tkey": rows.column(1).take(pa.array(row)),
                    "anchor": anchor, "content": content,
                    "first": (first - w.first[row]).astype(np.int32), "n": n.astype(np.int32)})

    return run


def _window_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.chunks(batches):
            w = arrays.words(data, offsets)
            spans = rows.column(3)
            row = np.repeat(np.arange(rows.num_rows), spans.value_lengths().to_numpy(zero_copy_only=False))
            flat = spans.flatten()
            first, n = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            begin = np.cumsum(n) - n
            start = np.repeat(first - begin, n) + np.arange(n.sum())
            row = np.repeat(row, n)
            at = start + w.first[row]
            a = arrays.prefix_sums(arrays.mix(w.hash))
            b = arrays.prefix_sums(arrays.mix(w.hash ^ np.uint64(0x5851F42D4C957F2D)))
            for k in range(0, len(at), 200_000):
                part = slice(k, k + 200_000)
                yield pa.RecordBatch.from_pydict({
                    "ord": rows.column(0).take(pa.array(row[part])), "tkey": rows.column(1).take(pa.array(row[part])),
                    "first": start[part].astype(np.int32),
                    "wa": arrays.span_hash(a, at[part], at[part] + size).view(np.int64),
                    "wb": arrays.span_hash(b, at[part], at[part] + size).view(np.int64)})

    return run


def _remove_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.chunks(batches):
            spans = rows.column(2)
            lists, raw = spans.to_pylist() if spans.null_count < len(spans) else [None] * len(spans), data.tobytes()
            total, removed, kept = [], [], []
            for i, found in enumerate(lists):
                own = raw[offsets[i]:offsets[i + 1]].split()
                total.append(len(own))
                if found:
                    change = np.zeros(len(own) + 1, np.int64)
                    np.add.at(change, [s["first"] for s in found], 1)
                    np.add.at(change, [s["first"] + s["n"] - 1 + size for s in found], -1)
                    gone = np.cumsum(change)[:-1] > 0
                    own = [x for x, out in zip(own, gone.tolist()) if not out]
                removed.append(total[-1] - len(own))
                kept.append(b" ".join(own).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column(0), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
                "kept": pa.array(kept, pa.string())})

    return run


def repeated_spans(docs: DataFrame, size: int = 50) -> DataFrame:
    """(ord, tkey, spans): windows first .. first+n-1 of each span (first, n) of a document are also in an earlier one.

    Aggregates are written before they are joined, so that adaptive execution can split a join on a frequent passage, and
    every table goes after its last reader.
    """
    keyed = with_key(docs)
    every = cut(keyed.select("ord", "tkey", "text").mapInArrow(
        _segment_batches(size), "ord long, tkey long, anchor long, content long, first int, n int"), BATCH_ROWS)
    shared = cut(every.groupBy("anchor").agg(F.min("ord").alias("a"), F.max("ord").alias("b"))
                 .filter("a < b").select("anchor"))
    found = cut(every.join(shared, "anchor"))
    discard(every, shared)
    classes = cut(found.groupBy("anchor", "content").agg(F.min("ord").alias("lead"), F.max("ord").alias("last")))
    whole = (found.join(classes.filter("lead < last"), ["anchor", "content"]).filter("lead < ord")
             .select("ord", "tkey", "first", "n"))
    # A symbol with several contents: windows at its rim may repeat although the whole segment doesn't.
    rims = cut(classes.groupBy("anchor").agg(F.count("*").alias("k")).filter("k > 1").select("anchor"))
    several = cut(classes.join(rims, "anchor").select("anchor", "content", "lead"))
    leads = (found.join(several, ["anchor", "content"]).filter("lead = ord")
             .groupBy("ord", "tkey").agg(F.collect_set(F.struct("first", "n")).alias("spans")))
    single = cut(keyed.select("ord", "tkey", "text").join(leads, ["ord", "tkey"])
                 .dropDuplicates(["ord", "tkey"]).select("ord", "tkey", "text", "spans")
                 .mapInArrow(_window_batches(size), "ord long, tkey long, first int, wa long, wb long"), BATCH_ROWS)
    earliest = cut(single.groupBy("wa", "wb").agg(F.min("ord").alias("lead"), F.max("ord").alias("last")).filter("lead < last"))
    rim = (single.join(earliest, ["wa", "wb"]).filter("lead < ord")
           .select("ord", "tkey", "first", F.lit(1).alias("n")))
    spans = cut(whole.unionByName(rim).groupBy("ord", "tkey").agg(F.collect_set(F.struct("first", "n")).alias("spans")))
    discard(found, classes, rims, several, single, earliest)
    return spans


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each text without the words of windows that an earlier document has.

    `kept` are the other words joined by one space. Earlier: a smaller doc_id; a null id comes after all others.
    Null and empty texts and texts shorter than a window keep all their words. Rows with an equal id don't remove each
    other's words; a repeated row comes out as often as it went in. Other columns are ignored.
    """
    if size < MIN_WORDS:
        raise ValueError(f"a window needs {MIN_WORDS} words at least")
    return (with_key(docs).join(repeated_spans(docs, size), ["ord", "tkey"], "left").select("doc_id", "text", "spans")
            .mapInArrow(_remove_batches(size), "doc_id long, n_words long, n_removed long, kept string"))

