"""Hierarchies as links (s, o): o is above s. Walks from asked nodes, order labels, paths, in rounds that are written out."""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.operators.skew import previous_in_group
from chronogeo.session import cut, discard


def distinct_links(links: DataFrame) -> DataFrame:
    return links.select("s", "o").filter(F.col("s").isNotNull() & F.col("o").isNotNull()).distinct()


def has_several_parents(links: DataFrame) -> bool:
    return not links.groupBy("s").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def ancestors_of(links: DataFrame, items: DataFrame) -> DataFrame:
    """(s, o, depth): every asked s and each node above it, with the shortest distance; s itself at 0.

    All asked nodes walk up together, one step a round; a round joins only the pairs of the round before, and pairs that
    are known go no further. So as many pairs are made as are asked for, whatever the rest of the graph holds.
    """
    step = cut(distinct_links(links).select(F.col("s").alias("_at"), F.col("o").alias("_up")))
    frontier = cut(items.select("s").filter("s IS NOT NULL").distinct().select("s", F.col("s").alias("o"), F.lit(0).alias("depth")))
    seen = frontier
    for k in count(1):
        more = frontier.join(step, F.col("o") == F.col("_at")).select("s", F.col("_up").alias("o")).distinct()
        frontier = cut(more.join(seen.select("s", "o"), ["s", "o"], "left_anti").withColumn("depth", F.lit(k)))
        if frontier.isEmpty():
            discard(step, frontier)
            return seen
        seen = seen.unionByName(frontier)


def way_counts(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """(s, o, n): how many nodes are on the ways from s up to o, both included. pairs: (s, o, depth) with all above each s.

    With one way up this is the distance and one. Only where a node above has several parents, or is above itself, the
    pairs of the middle nodes are walked and counted.
    """
    pairs = cut(pairs)
    links = cut(distinct_links(links).join(pairs.select(F.col("o").alias("s")).distinct(), "s", "left_semi"))
    tops = pairs.join(links.select(F.col("s").alias("o")).distinct(), "o", "left_anti").select("s").distinct()
    asked = pairs.filter("depth = 0").select("s")
    if not has_several_parents(links) and asked.join(tops, "s", "left_anti").isEmpty():
        return pairs.select("s", "o", (F.col("depth") + 1).cast("long").alias("n"))
    middle = ancestors_of(links, pairs.select(F.col("o").alias("s")))
    return (pairs.select("s", F.col("o").alias("mid")).join(middle.select(F.col("s").alias("mid"), "o"), "mid")
            .groupBy("s", "o").agg(F.count("*").alias("n")))


# ---------------------------------------------------------------- order labels

def order_labels(links: DataFrame) -> DataFrame:
    """(node, enter, exit, depth) of a forest: its Euler tour as numbers.

    A node is above another exactly if its numbers enclose the other's (see `is_above`); its depth is 0 at a root. Siblings
    and roots follow by name. The tour is a list of one arc down and one arc up per node; each arc's place comes from
    pointer jumping: every round doubles the stretch that an arc has summed up, so a tour of n arcs takes log2(n) rounds
    however deep the forest is. A node with two parents and a cycle are errors.
    """
    edges = cut(distinct_links(links).select(F.col("s").alias("child"), F.col("o").alias("parent")))
    if has_several_parents(edges.select(F.col("child").alias("s"))):
        raise ValueError("a node has several parents")
    names = edges.select(F.col("child").alias("node")).unionByName(edges.select(F.col("parent").alias("node"))).distinct()
    nodes = cut(names.repartitionByRange("node").sortWithinPartitions("node").withColumn("id", F.monotonically_increasing_id()))
    total = 2 * nodes.count()
    above = nodes.select(F.col("node").alias("parent"), F.col("id").alias("pid"))
    ups = cut(nodes.join(edges, F.col("node") == F.col("child"), "left").join(above, "parent", "left")
              .select("id", F.coalesce("pid", F.lit(-1)).alias("p")))
    first = ups.groupBy(F.col("p").alias("id")).agg(F.min("id").alias("first"))
    after = previous_in_group(ups, "p", "id", "id", "before").filter("before IS NOT NULL").select(F.col("before").alias("id"), F.col("id").alias("next"))
    down, up = F.col("id") * 2, F.col("id") * 2 + 1
    arcs = ups.join(first, "id", "left").join(after, "id", "left").select(F.explode(F.array(
        _arc(down, F.coalesce(F.col("first") * 2, up), 1),
        _arc(up, F.coalesce(F.col("next") * 2, F.when(F.col("p") >= 0, F.col("p") * 2 + 1)), -1))).alias("r")).select("r.*")
    state = cut(arcs)
    for k in count():
        open_ = state.filter("next IS NOT NULL")
        if open_.isEmpty():
            break
        if 2**k > total:
            raise ValueError("the links have a cycle")
        far = state.select(F.col("arc").alias("next"), F.col("next").alias("_next"), F.col("n").alias("_n"), F.col("v").alias("_v"))
        jumped = open_.join(far, "next").select("arc", F.col("_next").alias("next"), (F.col("n") + F.col("_n")).alias("n"), (F.col("v") + F.col("_v")).alias("v"))
        before, state = state, cut(state.filter("next IS NULL").unionByName(jumped))
        discard(before)
    place = F.lit(total) - F.col("n")
    is_down = F.col("arc") % 2 == 0
    found = state.groupBy(F.floor(F.col("arc") / 2).alias("id")).agg(
        F.max(F.when(is_down, place)).alias("enter"), F.max(F.when(~is_down, place)).alias("exit"), F.max(F.when(is_down, -F.col("v"))).cast("int").alias("depth"))
    return nodes.join(found, "id").select("node", "enter", "exit", "depth")


def _arc(arc: Column, following: Column, value: int) -> Column:
    return F.struct(arc.alias("arc"), following.alias("next"), F.lit(1).cast("long").alias("n"), F.lit(value).cast("long").alias("v"))


def is_above(enter: Column, exit_: Column, other_enter: Column, other_exit: Column) -> Column:
    """The first node is above the second, or is the same."""
    return (enter <= other_enter) & (other_exit <= exit_)


# ---------------------------------------------------------------- paths

def paths_by_doubling(roots: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """(s, path) of all nodes below roots, which have paths: the path of the parent, then the own label.

    A node holds how far up it knows its way and the text of that stretch; a round joins it with the stretch of the node
    that it has reached, so a chain of n takes log2(n) rounds. Every node has one parent at most; several labels or several
    root paths give several paths. What hangs on no root, or on a cycle, gets none.
    """
    known = roots.select(F.col("s").alias("at")).distinct()
    rows = labels.select("s", "label").join(links, "s").join(roots.select("s").distinct(), "s", "left_anti")
    start = rows.select("s", F.col("o").alias("at"), F.concat(F.lit(", "), "label").alias("text"))
    state = cut(start.join(known.withColumn("done", F.lit(True)), "at", "left").select("s", "at", "text", F.coalesce("done", F.lit(False)).alias("done")))
    most = state.count()
    for k in count():
        open_ = state.filter("NOT done")
        if open_.isEmpty() or 2**k > 2 * most:
            break
        far = state.select(F.col("s").alias("at"), F.col("at").alias("_at"), F.col("text").alias("_text"), F.col("done").alias("_done"))
        jumped = open_.join(far, "at").select("s", F.col("_at").alias("at"), F.concat("_text", "text").alias("text"), F.col("_done").alias("done"))
        before, state = state, cut(state.filter("done").unionByName(jumped))
        discard(before)
    return state.filter("done").join(roots.select(F.col("s").alias("at"), "path"), "at").select("s", F.concat("path", "text").alias("path")).distinct()
