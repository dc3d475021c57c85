"""Writers: tab files, triples, outcomes and issue reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.operators import periods as P
from chronogeo.session import CLEAN_UP, settings


def write_layer_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab file with header and 0/1 flags; the geometry column is written as it is."""
    flags = set(P.source_columns(df))
    df.select(*[P.named(c).cast("int").alias(c) if c in flags else P.named(c) for c in df.columns]).write.mode(mode).option(
        "sep", "\t").option("header", "true").csv(path)


def write_triples(triples: DataFrame, path: str, mode: str = "errorifexists", sorted_out: bool = False) -> None:
    """Parquet partitioned by predicate.

    Rows are written where they are: neither shuffled nor sorted, a task keeps a file open for each of the first
    predicates it meets. Texts of a graph begin alike, so zstd makes the files about half as large.
    """
    with settings(triples.sparkSession, CLEAN_UP | {"spark.sql.maxConcurrentOutputFileWriters": "64"}):
        triples.write.mode(mode).option("compression", "zstd").option("parquet.block.size", 32 << 20).partitionBy("p").parquet(path)


def write_nquads(triples: DataFrame, path: str, mode: str = "errorifexists") -> None:
    def escaped(c):
        out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        for char, code in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            out = F.replace(out, F.lit(char), F.lit(code))
        return out

    def iri(c):
        return F.when(F.startswith(c, F.lit("_:")), c).otherwise(F.concat(F.lit("<"), c, F.lit(">")))

    tag = F.coalesce(
        F.concat(F.lit("@"), F.nullif("lang", F.lit(""))), F.concat(F.lit("^^<"), F.col("dtype"), F.lit(">")), F.lit(""))
    obj = F.when(F.col("o_type") == "literal", F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'), tag)).otherwise(iri(F.col("o")))
    line = F.concat_ws(" ", iri(F.col("s")), iri(F.col("p")), obj, iri(F.col("g")), F.lit("."))
    triples.select(line.alias("value")).write.mode(mode).text(path)


def write_outcomes(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder of JSON lines per outcome."""
    df.write.mode(mode).partitionBy("outcome").json(path)


def write_issue_report(issues: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder of JSON lines per category; no list of a category is gathered in one row."""
    issues.write.mode(mode).partitionBy("category").json(path)


def write_keyed(df: DataFrame, name: str, key: str = "identifier", buckets: int = 64, path: str | None = None,
                mode: str = "errorifexists") -> DataFrame:
    """Catalog table in buckets of a key, one file per bucket, sorted by it.

    Joins on the key read the stored side as it lies: neither shuffled nor, with one file per bucket, sorted. Tables that
    are joined with each other get the same number of buckets. Choose it so that a bucket fits an executor; it holds all
    rows of its keys, so the key should be (nearly) unique.
    """
    rows = df.repartition(buckets, key).sortWithinPartitions(key)
    out = rows.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    (out.option("path", path) if path else out).saveAsTable(name)
    return df.sparkSession.table(name)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Replace a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
