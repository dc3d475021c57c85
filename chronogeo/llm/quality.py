"""Quality classifier: boosted trees over statistics of a text, scored in whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.llm import arrays, boosting
from chronogeo.llm.tables import BATCH_ROWS, cut

MOST_LABELS = 20_000  # labelled rows that a model is fitted on, those with the smallest hash of their id
ACCEPT = 0.7

_KINDS = 10
_KIND = np.full(256, 7, np.int64)  # other ASCII signs
_KIND[0x61:0x7B] = 0
_KIND[0x41:0x5B] = 1
_KIND[0x30:0x3A] = 2
_KIND[[0x20, 0x09, 0x0D]] = 3
_KIND[0x0A] = 4
_KIND[[0x2E, 0x2C]] = 5
_KIND[[0x21, 0x3F]] = 6
_KIND[:0x09] = 8
_KIND[0x0E:0x20] = 8
_KIND[0x80:] = 9
_LINE_END = np.zeros(256, bool)
_LINE_END[0x0A] = True


def _per_row(n: int, row: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(row, weight, n).astype(float)


def _repeats(n: int, row: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Share of items of a row that stand earlier in it."""
    seen = pd.Series(hashes ^ arrays.mix(row.astype(np.uint64))).duplicated().to_numpy()
    return _per_row(n, row[seen]) / np.maximum(_per_row(n, row), 1)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text; all are finite, and zero for an empty text."""
    n, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * _KINDS + _KIND[data], minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    w = arrays.words(data, offsets)
    count = _per_row(n, w.doc)
    words = np.maximum(count, 1)
    length = w.end - w.start
    first, last = _KIND[data[w.start]], _KIND[data[w.end - 1]]
    before = _KIND[data[np.maximum(w.end - 2, w.start)]]
    pair = w.doc[:-1] == w.doc[1:]
    lines = arrays.words(data, offsets, _LINE_END)
    n_lines = np.maximum(_per_row(n, lines.doc), 1)
    part = lambda chosen: _per_row(n, w.doc[chosen]) / words
    longest = np.zeros(n)
    np.maximum.at(longest, w.doc, length)
    return np.column_stack([
        kinds / np.maximum(size, 1)[:, None], np.log1p(size), np.log1p(count), _per_row(n, w.doc, length) / words, np.log1p(longest),
        part((first == 1) & (last == 1)), part(first == 1), part(last == 5), part(last == 6), part((last == 7) & (before == 7)),
        part((length == 1) & (last == 7)), part(first == 2), _repeats(n, w.doc, w.hash),
        _repeats(n, w.doc[:-1][pair], w.hash[:-1][pair] * np.uint64(3) + w.hash[1:][pair]),
        _repeats(n, lines.doc, lines.hash), np.log1p(n_lines), count / n_lines])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in arrays.chunks(batches):
        x = statistics(data, offsets)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([flat, rows.column(1)], names=["x", "y"])


def _score_batches(model: boosting.Trees, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.chunks(batches, column):
            score = pa.array(model.score(statistics(data, offsets)))
            yield pa.RecordBatch.from_arrays([*rows.columns, score], names=[*rows.schema.names, "score_"])

    return run


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS, **options) -> boosting.Trees:
    """A model from the texts of at most `most` labelled rows that are not held out.

    Rows with a null id or null quality are no labels; several labels of an id count by their mean, and of several texts
    the smallest counts. The bound is on rows
    that reach the driver: that many rows of some thirty numbers each.
    """
    chosen = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).filter(~held_out())
              .groupBy(F.col("doc_id").cast("long").alias("id_")).agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("y"))
              .orderBy(F.xxhash64("id_"), "id_").limit(most))
    rows = (docs.select(F.col("doc_id").cast("long").alias("id_"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), "id_").groupBy("id_").agg(F.min("text").alias("text"), F.first("y").alias("y"))
            .select("text", "y").mapInArrow(_feature_batches, "x array<double>, y int").toArrow())
    if not rows.num_rows:
        return boosting.constant(0.5)
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    order = np.lexsort(x.T)  # the same rows in any order give the same model
    return boosting.fit(x[order], rows.column("y").to_numpy()[order].astype(float), **options)


def _scored(docs: DataFrame, model: boosting.Trees) -> DataFrame:
    """The columns of `docs` as c0, c1, ... (so that no name clashes) and `score_`, lazy."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    at = names[docs.columns.index("text")]
    rows = rows.withColumn(at, F.col(at).cast("string"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", score_ double"
    return rows.mapInArrow(_score_batches(model, at), schema)


def classify(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per input row; other columns are ignored.

    Null text counts as empty, and an empty text is scored like any other. Null ids are not held out.
    """
    model = train(docs, labels)
    scored = cut(_scored(docs.select(F.col("doc_id").cast("long"), "text"), model).select("c0", "score_"), BATCH_ROWS)
    return scored.withColumnRenamed("c0", "doc_id").select("doc_id", held_out().alias("held_out"), F.col("score_").alias("score"), (F.col("score_") >= accept).cast("int").alias("predicted"))


def keep_accepted(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The rows of `docs` that the classifier accepts, with all their columns."""
    return cut(_scored(docs, train(docs, labels)).filter(F.col("score_") >= accept).drop("score_"), BATCH_ROWS).toDF(*docs.columns)
