"""Token counts of flat files of ids that have no index: documents end at a separator id.

Files are cut into blocks; a task finds a block's separators with one comparison over its array. Where the first document
of a block begins is known only from earlier blocks: a running maximum of the last separator's place stitches them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronogeo.llm import arrays
from chronogeo.llm.tables import BATCH_ROWS
from chronogeo.llm.tokens import encoder
from chronogeo.session import settings

WIDTH = 2  # bytes of an id, little-endian
BLOCK = 1 << 20  # ids in a block


def _id_batches(path: str, separator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, specials=False)
        for _, data, offsets in arrays.chunks(batches):
            ids, bounds = coder.encode(data, offsets)
            if len(ids) and (ids.max() > 0xFFFF or (ids == separator).any()):
                raise ValueError("an id is the separator or needs more than two bytes")
            flat = pa.py_buffer(ids.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(
                pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * WIDTH).astype(np.int32).tobytes()), flat])], names=["ids"])

    return run


def write_token_files(docs: DataFrame, tokenizer: str, separator: int, path: str) -> None:
    """Flat files of two-byte ids under `path`, each document followed by the separator, and nothing else.

    Null text is an empty document. Special tokens' strings in a text are ordinary text. Spark's text writer writes the
    bytes as they are, the separator's two bytes as its line end, to any store that Spark can write to.
    """
    end = separator.to_bytes(WIDTH, "little").decode("latin-1")
    with settings(docs.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_id_batches(tokenizer, separator), "ids binary")
         .select(F.col("ids").cast("string").alias("value"))
         .write.option("encoding", "ISO-8859-1").option("lineSep", end).text(path))


def _separator_batches(separator: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, number, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if size % WIDTH:
                    raise ValueError(f"{file}: {size} bytes are not whole ids")
                ids = np.frombuffer(raw, "<u2")
                at = np.flatnonzero(ids == separator) + number * block
                open_end = number * block + len(ids) if (number + 1) * block * WIDTH >= size else None
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([file]), "block": pa.array([number], pa.int64()), "ends": pa.array([at.tolist()], pa.list_(pa.int64())),
                    "file_end": pa.array([open_end], pa.int64())})

    return run


def scan_blocks(spark: SparkSession, path: str, separator: int, block: int = BLOCK) -> DataFrame:
    """(file, block, ends, file_end): places of the separators in each block; file_end only in a file's last block."""
    files = spark.read.format("binaryFile").load(path)
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr(f"(length - 1) div {block * WIDTH}"))))
    blocks = files.select(F.col("path").alias("file"), F.col("length").alias("size"), numbers.alias("block"), "content").select(
        "file", "size", "block", F.substring(F.col("content"), (F.col("block") * block * WIDTH + 1).cast("int"), F.lit(block * WIDTH)).alias("raw"))
    return blocks.mapInArrow(_separator_batches(separator, block), "file string, block long, ends array<long>, file_end long")


def count_tokens(spark: SparkSession, path: str, separator: int, block: int = BLOCK) -> DataFrame:
    """(file, doc, start, n_tokens, closed): documents of each flat file in order, separators not counted.

    Ids after the last separator are a document that is not `closed`. An empty file has none; a file that does not hold
    whole ids is an error. `file` is the path. Files can have up to 2 GB each, the limit of Spark's binary source.
    """
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    stitched = scan_blocks(spark, path, separator, block).select(
        "file", "ends", "file_end",
        F.coalesce(F.max(F.array_max("ends")).over(earlier), F.lit(-1).cast("long")).alias("last"),
        F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).alias("before"))
    begins = F.concat(F.array(F.col("last") + 1), F.transform("ends", lambda e: e + 1))
    found = stitched.select("file", "before", F.posexplode(F.arrays_zip(begins.alias("start"), F.concat("ends", F.array("file_end")).alias("stop"))).alias("k", "d"), F.size("ends").alias("n"))
    return (found.select("file", (F.col("before") + F.col("k")).alias("doc"), F.col("d")["start"].alias("start"),
                         (F.col("d")["stop"] - F.col("d")["start"]).alias("n_tokens"), (F.col("k") < F.col("n")).alias("closed"))
            .filter(F.col("closed") | (F.col("n_tokens") > 0)))
