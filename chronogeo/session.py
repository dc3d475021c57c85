"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs are written for. Joins rely on adaptive skew
# splitting, also where the split costs one extra shuffle downstream. Files of
# triples hold the same long texts again and again and are many times larger in
# memory: sizes are taken accordingly, or a table of millions of rows would pass
# for a small one and be broadcast through the driver. Shuffles start with many
# partitions, of which small ones are joined, so that none grows with the input;
# a compressed MB of a graph is up to 25 MB in the memory of each join of a task.
# A join whose one side is small in every partition looks it up and sorts nothing.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "4m",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "8m",
    "spark.sql.sources.fileCompressionFactor": "20",
}


def build_session(app_name: str = "chronogeo", master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """Create or reuse a session with the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Only a local[...] session without that setting gets a temporary folder; on a
    cluster a machine-local folder would not outlive an executor, so it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = getattr(scratch_root, "_local", None)
    if root is None:
        root = tempfile.mkdtemp(prefix="chronogeo-")
        scratch_root._local = root
    return root


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings for what is run inside; afterwards all are as before."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# The shuffle files of a job that has written its table are of no more use.
CLEAN_UP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def cut(df: DataFrame, batch_rows: int | None = None, codec: str = "snappy") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Loops use this instead of a growing plan: the lineage ends in files that
    survive executor loss, columns stay prunable and Catalyst sees real sizes,
    so it only broadcasts what is known to be small. `batch_rows` limits the
    Arrow batches of Python workers in `df`; `codec` compresses, zstd better for
    texts that many joins will not read. See `discard`.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/chronogeo/{uuid.uuid4().hex}"
    small = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows)} if batch_rows else {}
    with settings(spark, CLEAN_UP | small):
        df.write.mode("errorifexists").option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables made by `cut`, when nothing will read them any more."""
    for table in tables:
        discard(*vars(table).get("cut_parts", []))  # tables that it is put together of
        path = vars(table).get("cut_to")
        jvm = getattr(table.sparkSession, "_jvm", None)
        if path and jvm:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """Tasks of at most about so many rows, and one per core at least, for row-wise work on files of few row groups.

    A file is read as splits of equal bytes, but a row group goes to one task whole, so splits say little about the tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)))
