"""Exact deduplication: groups by a 128-bit hash of the content, bytes compared inside the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.llm.tables import cut


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def mark_copies(docs: DataFrame, keep: str = "largest", hash_of=content_hash) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per input row.

    Null text counts as empty, and empty texts are copies of each other. The group's largest (or smallest) doc_id stays.
    A null doc_id stays only where the group has no other id. Rows that repeat the id that stays are all marked kept.
    Other columns are ignored.

    Least and greatest text of a hash group are equal exactly if all its texts are: so the bytes are compared in the same
    aggregate that counts the group, with partial results, and no group is gathered. Groups in which they differ are
    split by the text itself.
    """
    pick = {"largest": F.max, "smallest": F.min}[keep]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("hash", hash_of(F.col("text")))
    groups = cut(hashed.groupBy("hash").agg(
        pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.min("text").alias("low"), F.max("text").alias("high"))
        .select("hash", "keep_id", "group_size", F.sha2("low", 256).alias("text_sha256"), (F.col("low") != F.col("high")).alias("mixed")))
    result = _members(hashed.select("doc_id", "hash"), groups.filter("NOT mixed").drop("mixed"), ["hash"])
    mixed = groups.filter("mixed").select("hash")
    if mixed.isEmpty():
        return result
    colliding = hashed.join(mixed, "hash")
    exact = colliding.groupBy("hash", "text").agg(pick("doc_id").alias("keep_id"), F.count("*").alias("group_size"),
                                                  F.sha2(F.first("text"), 256).alias("text_sha256"))
    return result.unionByName(_members(colliding, exact, ["hash", "text"]))


def _members(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(groups, on).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
