"""Columns and tables the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogeo.session import cut, discard

__all__ = ["BATCH_ROWS", "LAST_ID", "cut", "discard", "order_of", "read", "with_key", "without"]

# Rows without an id are ordered after all others.
LAST_ID = (1 << 63) - 1
BATCH_ROWS = 500  # rows of long texts in an Arrow batch at most: both sides of a Python worker keep whole batches


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(LAST_ID))


def with_key(docs: DataFrame) -> DataFrame:
    """(doc_id, ord, tkey, text) and nothing else, so that other columns of the input cannot clash.

    (ord, tkey) tells rows apart: rows that share it have the same id and text and get the same results.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_of(F.col("doc_id")).alias("ord"),
                       F.xxhash64(text).alias("tkey"), text.alias("text"))


def without(items: Column, gone: Column) -> Column:
    """The strings of an array but for those at the places `gone` (from 0), in n log n steps.

    Items and places are sorted together; an item goes if its own place follows it.
    """
    both = F.sort_array(F.concat(
        F.transform(items, lambda t, i: F.struct(i.alias("i"), F.lit(0).alias("out"), t.alias("t"))),
        F.transform(gone, lambda i: F.struct(i.cast("int").alias("i"), F.lit(1).alias("out"), F.lit("").alias("t")))))
    stays = F.zip_with(both, F.slice(both, 2, F.size(both)), lambda a, b: F.when(
        (a["out"] == 0) & (b.isNull() | (b["out"] == 0)), a["t"]))
    return F.filter(stays, lambda t: t.isNotNull())
