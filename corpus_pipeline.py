"""A training corpus from raw documents: quality filter, line dedup, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that it gets and returns a table that is written as Parquet and
read again as the docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogeo.llm import decontaminate, jaccard, line_dedup, packing, quality
from chronogeo.llm.queries import tokenizer
from chronogeo.llm.tables import cut, discard, read


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.keep_accepted(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without runs of lines that stand earlier; n_chars follows the text."""
    out = line_dedup.remove_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by n-gram similarity (five words, 0.8) the one with the smallest id.

    Texts without words are linked with nothing and stay. Rows that repeat the id that stays all stay, as do rows without
    an id.
    """
    groups = jaccard.link_components(docs, size=5, percent=80)
    gone = groups.filter("component_id < doc_id").select(F.col("doc_id").alias("id_")).distinct()
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = F.col(names[docs.columns.index("doc_id")]).cast("long")
    return docs.toDF(*names).join(gone, own == F.col("id_"), "left_anti").toDF(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which less than a twentieth of the words stand in benchmark windows."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

# A boosted classifier and a tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, sf_dir))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
