"""Ranked lexical search, term at a time with a limited number of accumulators.

Spark splits the documents; every task holds an inverted index of one block of them at a time and scores all items against
it. The terms of an item are taken from the rarest to the most frequent of the whole corpus. Each term adds its weight to
the accumulators of its documents and makes new ones, until the most that the remaining terms could add is less than the
k-th best partial score (or the k-th best score of the blocks before): from then on no new document can enter the result,
no accumulator is made, and the survivors are updated exactly. The best k of every task meet in a window per item.

The texts are read once per block of items. A block has at most `MOST_TERMS` distinct terms or one item, so what is sent to
the tasks has a bound; more items mean more passes, never fewer results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronogeo.llm import arrays
from chronogeo.llm.tables import BATCH_ROWS, LAST_ID, cut, order_of

MOST_TERMS = 500_000  # terms, counted per item, that are sent to the tasks together
BLOCK = 400_000  # postings that a task indexes together
TASKS = 1000  # whose best rows meet in one group at first

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes between terms: ASCII but letters and digits. Every byte of a longer character belongs to a term.
_GAP = np.zeros(256, bool)
_GAP[:128] = [not chr(i).isalnum() for i in range(128)]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def item_terms(items: DataFrame, name: str = "item_id") -> DataFrame:
    """(item_id, terms): distinct terms of each row that has some."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    return items.select(F.col(name).alias("item_id"), F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), 0)).alias("terms")).filter(F.size("terms") > 0)


def _blocks(items: DataFrame, most: int) -> list[DataFrame]:
    """The items dealt by hash into blocks of at most `most` terms, or of equal rows if one is larger by itself."""
    total, rows = items.agg(F.sum(F.size("terms")), F.count("*")).first()
    n = max(1, math.ceil(2 * (total or 0) / most))
    while n > 1:
        own = F.pmod(F.xxhash64("terms"), F.lit(n))
        if n >= 4 * rows or items.groupBy(own).agg(F.sum(F.size("terms")).alias("n")).agg(F.max("n")).first()[0] <= most:
            return [items.filter(own == i) for i in range(n)]
        n *= 2
    return [items]


def _count_batches(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary.value, pa.large_string())
        for rows, data, offsets in arrays.chunks(batches):
            start, end, doc, first = arrays.spans(data, offsets, _GAP)
            size = end - start
            bounds = np.append(0, np.cumsum(size))
            letters = _LOWER[data[np.repeat(start - bounds[:-1], size) + np.arange(bounds[-1])]]
            terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.append(letters, np.uint8(0))))
            at = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy().astype(np.int64)
            code, tf = np.unique((doc * len(known) + at)[at >= 0], return_counts=True)
            row = code // max(len(known), 1)
            lists = pa.array(np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "ord": rows.column(0), "n": np.diff(first).astype(np.int64),
                "terms": pa.ListArray.from_arrays(lists, pa.array((code % max(len(known), 1)).astype(np.int32))),
                "tfs": pa.ListArray.from_arrays(lists, pa.array(tf.astype(np.int64)))})

    return run


class Index:
    """Postings of a block of documents by term: documents, what each term adds to their scores, and the most it adds."""

    def __init__(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weight: np.ndarray, docs: int, tokens: int):
        m = 50 + (50 * n * docs) // tokens
        row = np.repeat(np.arange(len(n)), sizes)
        order = np.argsort(terms, kind="stable")
        self.row, term = row[order], terms[order]
        adds = weight[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[row]))
        self.adds = adds[order]
        self.first = np.searchsorted(term, np.arange(len(weight) + 1))
        self.most = np.zeros(len(weight), np.int64)
        filled = np.flatnonzero(np.diff(self.first))
        if len(filled):
            self.most[filled] = np.maximum.reduceat(self.adds, self.first[filled])
        self.scores = np.zeros(len(n), np.int64)

    def search(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores, above 0, that hold the k best and all equal to the last of them. terms: the rarest first.

        least: the k-th best score so far; rows that cannot reach it may be missing.
        """
        rest = np.append(np.cumsum(self.most[terms][::-1])[::-1], 0).tolist()
        scores, i = self.scores, 0
        scores[:] = 0
        while i < len(terms) and rest[i] and rest[i] >= least:
            here = slice(self.first[terms[i]], self.first[terms[i] + 1])
            scores[self.row[here]] += self.adds[here]
            i += 1
            if 0 < rest[i] < scores.max():  # only then can it be below the k-th best
                partial = scores[scores > 0]
                if len(partial) >= k:
                    least = max(least, int(np.partition(partial, -k)[-k]))
        found = np.flatnonzero(scores)
        for t in terms[i:].tolist() if len(found) else ():
            here = slice(self.first[t], self.first[t + 1])
            row = self.row[here]
            if len(row) > 8 * len(found):  # look the few survivors up in the long list
                at = np.minimum(np.searchsorted(row, found), len(row) - 1)
                hit = row[at] == found
                scores[found[hit]] += self.adds[here][at[hit]]
            else:
                hit = scores[row] > 0
                scores[row[hit]] += self.adds[here][hit]
        return found, scores[found]


def best(ord_: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ord_, -score))[:k]
    return ord_[order], score[order]


def _search_batches(query, weight, docs: int, tokens: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, terms = query.value
        none = np.zeros(0, np.int64)
        top = [(none, none)] * (len(first) - 1)
        held: list[pa.RecordBatch] = []
        size = 0

        def score_block() -> None:
            block = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            ord_, n = block["ord"].to_numpy(), block["n"].to_numpy()
            sizes = pc.list_value_length(block["terms"]).to_numpy()
            index = Index(n, sizes, pc.list_flatten(block["terms"]).to_numpy(), pc.list_flatten(block["tfs"]).to_numpy(), weight.value, docs, tokens)
            for i in range(len(top)):
                row, score = index.search(terms[first[i]:first[i + 1]], k, int(top[i][1][-1]) if len(top[i][1]) == k else 0)
                if len(row):
                    row, score = best(ord_[row], score, k)
                    top[i] = best(np.append(top[i][0], row), np.append(top[i][1], score), k)

        for batch in batches:
            for lo in range(0, batch.num_rows, 4000):
                held.append(batch.slice(lo, 4000))
                size += pc.sum(pc.list_value_length(held[-1].column(2))).as_py()
                if size >= BLOCK:
                    score_block()
                    size = 0
        if held:
            score_block()
        item = np.repeat(np.arange(len(top)), [len(t[0]) for t in top])
        yield pa.RecordBatch.from_pydict({
            "item": pa.array(item, pa.int32()), "ord": np.concatenate([none, *(t[0] for t in top)]), "score": np.concatenate([none, *(t[1] for t in top)])})

    return run


def _search_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    rows = items.collect()
    vocabulary = sorted({t for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    send = spark.sparkContext.broadcast
    text = F.col("text").cast("string")
    counted = cut(docs.select(order_of(F.col("doc_id")).alias("ord"), text.alias("text")).mapInArrow(
        _count_batches(send(vocabulary)), "ord long, n long, terms array<int>, tfs array<long>"), BATCH_ROWS)
    n_docs, tokens = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        df[r["term"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    own = [sorted((number[t] for t in r["terms"]), key=lambda t: (df[t], t)) for r in rows]
    query = (np.cumsum([0, *map(len, own)]), np.array([t for x in own for t in x], np.int64))
    found = counted.filter(F.size("terms") > 0).select("ord", "n", "terms", "tfs").mapInArrow(
        _search_batches(send(query), send(weight), n_docs, max(tokens, 1), k), "item int, ord long, score long")
    order = [F.desc("score"), F.asc("ord")]
    # Each task sends k rows an item at most; those of many tasks are cut to k before the last window.
    part = F.floor(F.spark_partition_id() / TASKS)
    halfway = (found.withColumn("part", part).withColumn("r", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
               .filter(F.col("r") <= k))
    ranked = (halfway.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k))
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
    return ranked.join(F.broadcast(names), "item").select(  # one row per item of the block
        "item_id", "rank", F.when(F.col("ord") < LAST_ID, F.col("ord")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, most_terms: int = MOST_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents that score highest above 0 for each item, equal ones by doc_id.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case; null text has none. Every row of
    `docs` is a document and every row of `items` an item, also where ids are repeated or null (a null doc_id comes last
    among equal scores); items without terms or matches give no row. Other columns are ignored.
    """
    out = None
    for block in _blocks(item_terms(items), most_terms):
        found = _search_block(docs, block, k)
        out = found if out is None else out.unionByName(found)
    return out
