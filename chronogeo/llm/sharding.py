"""Sharding by extendible hashing.

A directory indexed by the leading bits of a hash: a bucket over the byte limit, and only such a bucket, splits on its
next bit until all fit. The bits come from id and text, so a source or a group of copies spreads like everything else.
The directory is found on sums per prefix, never on rows: one aggregate over all rows counts bytes at a depth a few bits
finer than needed, and the sums of all shorter prefixes follow from those. What still is too large there goes on with
more bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.llm.tables import cut

BITS = 60  # of the hash that are used
SPARE = 4  # bits counted below the expected depth


def hash_bits(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of the MD5 of id and text as a number."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long")


def prefix(h: Column, depth: Column | int) -> Column:
    depth = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftright", h, (F.lit(BITS) - depth).cast("int"))


def directory(sizes: DataFrame, limit: int, expected: int) -> DataFrame:
    """(depth, prefix, bytes, rows) of the leaves for `sizes` (h, bytes, rows)."""
    leaves, rest, fine = None, sizes, min(BITS, expected + SPARE)
    top = 0
    while True:
        counted = cut(rest.groupBy(prefix(F.col("h"), fine).alias("p")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        levels = (counted.select("p", "bytes", "rows", F.explode(F.sequence(F.lit(top), F.lit(fine))).alias("depth"))
                  .withColumn("prefix", F.call_function("shiftright", F.col("p"), (F.lit(fine) - F.col("depth")).cast("int")))
                  .groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        levels = cut(levels.withColumn("fits", (F.col("bytes") <= limit) | (F.col("depth") == BITS) | (F.col("rows") == 1)))
        up = levels.select((F.col("depth") + 1).alias("depth"), F.col("fits").alias("above"), F.col("prefix").alias("parent"))
        found = (levels.withColumn("parent", F.call_function("shiftright", F.col("prefix"), F.lit(1)))
                 .join(up, ["depth", "parent"], "left")
                 .filter(F.col("fits") & ~F.coalesce("above", F.lit(False))).select("depth", "prefix", "bytes", "rows"))
        leaves = found if leaves is None else leaves.unionByName(found)
        over = levels.filter((F.col("depth") == fine) & ~F.col("fits")).select(F.col("prefix").alias("over"))
        if over.isEmpty():
            return leaves
        rest = rest.join(over, prefix(F.col("h"), fine) == F.col("over"), "left_semi")
        top, fine = fine + 1, min(BITS, fine + 2 * SPARE)


def assign_shards(docs: DataFrame, limit: int, with_hash: bool = False) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, part): the shard of each row.

    `shard` is the bucket's bits, empty for a single shard. A shard holds at most `limit` bytes of UTF-8, or one row that
    alone is larger. Null text has no bytes; a null id hashes as an empty one. Repeated rows (same id and text) have the
    same bits; where these alone exceed the limit they are dealt out to parts 0, 1, ... of their bucket, by count, and
    `part` is 0 everywhere else. Other columns are ignored. An empty table has no shards.
    """
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), hash_bits(F.col("doc_id"), F.col("text")).alias("h"),
                           F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"))
               .groupBy("doc_id", "h", "n_bytes").agg(F.count("*").alias("copies")))
    total = rows.agg(F.sum(F.col("n_bytes") * F.col("copies")).alias("b")).first()["b"] or 0
    expected = max(0, math.ceil(math.log2(total / limit))) if total > limit else 0
    sizes = rows.select("h", (F.col("n_bytes") * F.col("copies")).alias("bytes"), F.col("copies").alias("rows"))
    leaves = cut(directory(sizes, limit, expected))
    depths = [r["depth"] for r in leaves.select("depth").distinct().collect()]  # at most 61
    named = rows.withColumn("key", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), prefix(F.col("h"), d).alias("prefix")) for d in sorted(depths)]
        or [F.struct(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("prefix"))])))
    named = named.select("doc_id", "h", "n_bytes", "copies", "key.*").join(
        leaves.select("depth", "prefix", "bytes", "rows"), ["depth", "prefix"])
    bits = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("right(lpad(conv(prefix, 10, 2), depth, '0'), depth)"))
    per_part = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("n_bytes", F.lit(1))))
    crowded = (F.col("bytes") > limit) & (F.col("rows") > 1)
    one = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return (named.select("doc_id", "h", "n_bytes", bits.alias("shard"), F.col("depth").cast("int"), crowded.alias("crowded"),
                         per_part.alias("per_part"), one.alias("copy"))
            .select("doc_id", *["h"] * with_hash, "n_bytes", "shard", "depth",
                    F.when(F.col("crowded"), F.floor((F.col("copy") - 1) / F.col("per_part"))).otherwise(0).cast("long").alias("part")))


def write_shards(docs: DataFrame, limit: int, path: str) -> None:
    """Write the rows, with all their columns, to one folder per shard and part.

    Repeated rows that fill several parts are dealt round robin within each input split.
    """
    h = hash_bits(F.col("doc_id"), F.col("text"))
    named = (assign_shards(docs, limit, with_hash=True).groupBy("h", "shard").agg((F.max("part") + 1).alias("parts_"))
             .withColumnsRenamed({"h": "h_", "shard": "shard_"}))
    placed = docs.withColumn("h_", h).join(named, "h_").withColumn("part_", F.expr("pmod(monotonically_increasing_id(), parts_)"))
    placed.drop("h_", "parts_").write.partitionBy("shard_", "part_").mode("errorifexists").parquet(path)
