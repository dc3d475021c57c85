"""Layer edits -> published features as keyed state of a stream.

The state of an identifier holds its edits by `seq`, what was published before, and no more. A micro-batch replays only the
identifiers it touches and appends one row for each to a log, so no table is rewritten however large it is. The edits that a
micro-batch brings to an identifier are one entry of its state, as each call to the state store has its price. Late edits are
put in their place by `seq`: a late delete takes back what came after it, as if it had come in time. Spark's checkpoint
makes state and log agree after a restart.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from chronogeo.functions import geometry as G
from chronogeo.operators.features import kind_value, place_in
from chronogeo.schema import FEATURES
from chronogeo.session import settings
from chronogeo.streaming.propagate import OPS, wired_edits

LOG = ("identifier string, version long, alive boolean, t string, z int, name string, geometry string, links array<string>, "
       "applied long, refused long, late long")
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
_ROW = ["t", "z", "name", "geometry"]


def replay(base: dict, edits: dict[int, list], cascade: bool) -> tuple[dict, int, int]:
    """(state after the edits in the order of their numbers, applied, refused). An edit is [op, t, z, name, geometry, links]."""
    alive, row, links = base["alive"], base["row"], set(base["links"])
    applied = 0
    for seq in sorted(edits):
        op, *new, sources = edits[seq]
        if op == "I" and not alive:
            alive, row, applied = True, new, applied + 1
            links |= set(sources)
        elif op == "U" and alive:
            row, applied = [*row[:3], new[3]], applied + 1
        elif op == "D" and alive:
            alive, row, applied = False, None, applied + 1
            if cascade:
                links = set()
    return base | {"alive": alive, "row": row, "links": sorted(links)}, applied, len(edits) - applied


def _merge(known: dict[int, list], edits: list) -> bool:
    """Whether `edits`, pairs (number, edit), change the `known` ones: there is one edit per number, the smallest as text."""
    changed = False
    for seq, edit in edits:
        if seq not in known or (edit != known[seq] and json.dumps(edit) < json.dumps(known[seq])):
            known[seq], changed = edit, True
    return changed


class EditProcessor(StatefulProcessor):
    """`keep`: how many of the latest edits of an identifier stay apart; older ones are folded into its base, and edits
    that come later still than these are counted as late and change nothing. None keeps all."""

    def __init__(self, cascade: bool = False, keep: int | None = None):
        self.cascade, self.keep = cascade, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.edits = handle.getListState("edits", "edits string")
        self.base = handle.getValueState("base", "base string")

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        r = initialState
        row = [r.t, r.z, r.name, r.geometry] if r.alive else None
        self.base.update((json.dumps({"alive": bool(r.alive), "row": row, "links": sorted(r.links or []), "floor": None, "version": 0, "late": 0}),))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.base.get()
        base = json.loads(held[0]) if held else {"alive": False, "row": None, "links": [], "floor": None, "version": 0, "late": 0}
        known: dict[int, list] = {}
        for entry in self.edits.get():
            _merge(known, json.loads(entry[0]))
        fresh = []
        for r in rows:
            if base["floor"] is not None and r.seq <= base["floor"]:
                base["late"] += 1
                continue
            edit = [r.seq, [r.op, r.t, r.z, r.name, r.geometry, sorted(r.links or [])]]
            if _merge(known, [edit]):
                fresh.append(edit)
        now, applied, refused = replay(base, known, self.cascade)
        base["version"] += 1
        if self.keep is not None and len(known) > 2 * self.keep:
            old = sorted(known)[: len(known) - self.keep]
            base = replay(base, {seq: known[seq] for seq in old}, self.cascade)[0] | {"floor": old[-1]}
            self.edits.put([(json.dumps([[seq, edit] for seq, edit in known.items() if seq > old[-1]]),)])
        elif fresh:
            self.edits.appendValue((json.dumps(fresh),))
        self.base.update((json.dumps(base),))
        t, z, name, geometry = now["row"] or [None] * 4
        yield Row(identifier=key[0], version=base["version"], alive=now["alive"], t=t, z=z, name=name, geometry=geometry,
                  links=now["links"], applied=applied, refused=refused, late=base["late"])

    def close(self) -> None:
        pass


def _links(mode: str, order: list[str] | None) -> Column:
    if mode not in ("all", "first") or (mode == "first") != bool(order):
        raise ValueError("mode is 'all', or 'first' with an order of sources")
    true = F.array_sort(F.map_keys(F.map_filter("flags", lambda _, present: present)))
    if mode == "first":
        first = F.array_min(F.transform(true, lambda s: F.struct(place_in(order, s).alias("place"), s.alias("source"))))["source"]
        true = F.when(first.isNotNull(), F.array(first))
    return F.coalesce(true, F.array().cast("array<string>"))


def published_before(features: DataFrame, feature_sources: DataFrame) -> DataFrame:
    """(identifier, alive, t, z, name, geometry, links); an object has as many links as it has sources."""
    links = feature_sources.groupBy(F.col("identifier").alias("_id")).agg(F.array_sort(F.collect_set("source")).alias("links"))
    rows = features.select("identifier", *_ROW).join(links, F.col("identifier") == F.col("_id"), "full")
    return rows.select(F.coalesce("identifier", "_id").alias("identifier"), F.col("identifier").isNotNull().alias("alive"), *_ROW,
                       F.coalesce("links", F.array().cast("array<string>")).alias("links"))


def start(changes: DataFrame, features: DataFrame, feature_sources: DataFrame, log: str, checkpoint: str, cascade: bool = False,
          dst_srid: int | None = None, mode: str = "all", order: list[str] | None = None, registry: DataFrame | None = None,
          keep: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Run the propagation of a stream of edits, from the tables as they are before it, into `log`.

    Same rules as `propagate.apply_changes`. Edits without an identifier or number, of another operation, or that a
    `registry` leaves out change nothing.
    """
    spark = changes.sparkSession
    if registry is not None:
        changes = wired_edits(changes, registry)
    geometry = F.col("geometry")
    if dst_srid is not None and "srid" in changes.columns:
        geometry = G.to_wkt(G.transform_by_srid(G.parse_wkt(geometry), F.col("srid"), dst_srid))
    edits = changes.filter(F.col("identifier").isNotNull() & F.col("seq").isNotNull() & F.col("op").isin(*OPS.values())).select(
        "identifier", F.col("seq").cast("long").alias("seq"), "op", kind_value(F.col("kind"), "t").alias("t"),
        kind_value(F.col("kind"), "z").alias("z"), "name", geometry.alias("geometry"), _links(mode, order).alias("links"))
    before = published_before(features, feature_sources)
    with settings(spark, ROCKSDB):
        out = edits.groupBy("identifier").transformWithState(
            EditProcessor(cascade, keep), LOG, "Append", "None", before.groupBy("identifier"))
        writer = out.writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest(spark: SparkSession, log: str) -> DataFrame:
    """The last row of each identifier in the log."""
    try:
        rows = spark.read.schema(LOG).parquet(log)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return spark.createDataFrame([], LOG)
    names = [f.name for f in rows.schema if f.name != "identifier"]
    return rows.groupBy("identifier").agg(F.max_by(F.struct(*names), "version").alias("r")).select("identifier", "r.*")


def tables(spark: SparkSession, log: str, features: DataFrame, feature_sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features, feature_sources) now: the tables before the stream, with the identifiers of the log replaced."""
    now, names = latest(spark, log), FEATURES.fieldNames()
    touched = now.select("identifier")
    return (features.select(*names).join(touched, "identifier", "left_anti").select(*names).unionByName(now.filter("alive").select(*names)),
            feature_sources.select("identifier", "source").join(touched, "identifier", "left_anti").unionByName(
                now.select("identifier", F.explode("links").alias("source"))))
