"""N-gram Jaccard join over prefix trees.

The n-grams of a text, as 64-bit hashes in ascending order, are a path-compressed binary trie: a subtree holds the hashes
with one bit prefix, and its digest names its content. Two sets that link differ in at most k = n(1-t)/t elements (n: the
smaller size, t: the similarity). At a depth with more than k subtrees one of them is equal in both, so all links are
found among sets that share a named subtree at the depth their size asks for.

1. Equal sets become one class, represented by its smallest id.
2. Linked sets agree in all their filled subtrees but k. A set with fewer names that any other set has is linked with
   nothing and leaves. Of a set that may leave out r names, some r + 1 hold one of a partner's: the rarest do, so names that
   many texts have by chance tie nothing. The others tie their sets to the smallest one (no pairs): candidate components.
3. The sets of a component are joined in one task over a trie of their n-grams (see trie.py), which walks shared beginnings
   once and leaves subtrees by the lengths that remain.
4. A component too large for a task is dealt into blocks by similarity, each set once. The links found unite sets to classes;
   only names that several classes have count in the next round. Near copies by the million are one class after a few
   rounds. What is still too large when a round finds no link, or after `ROUNDS`, is compared block by block.
5. All links found give the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.llm import arrays
from chronogeo.llm.components import components
from chronogeo.llm.tables import BATCH_ROWS, LAST_ID, cut, discard, with_key
from chronogeo.llm.trie import link_sets

BLOCK = 4_000_000  # n-grams that a task joins together, some 0.3 GB there
ROUNDS = 4  # in which a large component is dealt into blocks before it is compared block by block

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def most_different(n: np.ndarray, percent: int) -> np.ndarray:
    """Elements in which a set of n can differ from a linked one that is not smaller."""
    return n * (100 - percent) // percent


def depth_of(n: np.ndarray, percent: int) -> np.ndarray:
    """Bits so that the subtrees outnumber the differences by a fifth, so that few of them are empty."""
    return np.ceil(np.log2(most_different(n, percent) * 1.2 + 1)).astype(np.int64)


def gram_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all rows, ascending within a row, and where each row begins."""
    w = arrays.words(_LOWER[data], offsets)
    sums = arrays.prefix_sums(arrays.mix(w.hash))
    start = arrays.windows(w, size)
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < size))
    grams = np.concatenate([arrays.span_hash(sums, start, start + size), arrays.span_hash(sums, w.first[short], w.first[short + 1])])
    row = np.concatenate([w.doc[start], short])
    order = np.lexsort((grams, row))
    grams, row = grams[order], row[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return grams[new], np.searchsorted(row[new], np.arange(len(offsets)))


def _subtrees(grams: np.ndarray, first: np.ndarray, depth: np.ndarray, rows: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the subtrees of the chosen rows at their depths, the row of each, and how many are filled per row."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    chosen = rows[row]
    grams, row = grams[chosen], row[chosen]
    if not len(grams):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(n), np.int64)
    d = depth[row].astype(np.uint64)
    at = (grams >> np.uint64(1)) >> (np.uint64(63) - d)
    head = np.ones(len(grams), bool)
    head[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1])
    heads = np.flatnonzero(head)
    sums = np.append(np.uint64(0), np.cumsum(arrays.mix(grams), dtype=np.uint64))
    content = sums[np.append(heads[1:], len(grams))] - sums[heads]
    place = arrays.mix(at[heads] * np.uint64(64) + d[heads])
    names, owner = arrays.mix(content + place), row[heads]
    filled = np.bincount(owner, minlength=len(n))
    bounds, spots = np.searchsorted(owner, np.arange(len(n) + 1)), at[heads]
    for i in np.flatnonzero(rows & (filled <= most) & (n > 0)).tolist():  # so few are filled that only empty ones may agree
        empty = np.setdiff1d(np.arange(1 << int(depth[i]), dtype=np.uint64), spots[bounds[i]:bounds[i + 1]])
        names = np.append(names, arrays.mix(arrays.mix(empty * np.uint64(64) + np.uint64(depth[i])) ^ np.uint64(0xE1)))
        owner = np.append(owner, np.full(len(empty), i))
    return names, owner, filled


def _node_batches(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.chunks(batches):
            grams, first = gram_sets(data, offsets, size)
            n = np.diff(first)
            own = depth_of(n, percent)
            low = -(-n * percent // 100)  # the smallest partner
            other = depth_of(low, percent)
            some = n > 0
            a, a_row, a_filled = _subtrees(grams, first, own, some, most_different(n, percent))
            b, b_row, b_filled = _subtrees(grams, first, other, some & (other != own), most_different(n, percent))
            row = np.concatenate([a_row, b_row])
            order = np.argsort(row, kind="stable")
            lists = np.searchsorted(row[order], np.arange(len(n) + 1)).astype(np.int32)
            digest = []
            for salt in (0x11, 0x2357):
                sums = np.append(np.uint64(0), np.cumsum(arrays.mix(grams ^ np.uint64(salt)), dtype=np.uint64))
                digest.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
            # Empty subtrees don't count: a partner names its own only if it has as few filled ones.
            need = [np.maximum(k - most_different(n, percent), 1) for k in (a_filled, b_filled)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": rows.column(0), "ord": rows.column(1), "tkey": rows.column(2), "n": n.astype(np.int64), "da": digest[0], "db": digest[1],
                "nodes": pa.ListArray.from_arrays(pa.array(lists), pa.array(np.concatenate([a, b])[order].view(np.int64))),
                "n_own": np.bincount(a_row, minlength=len(n)).astype(np.int32), "need_own": need[0].astype(np.int32), "need_other": need[1].astype(np.int32)})

    return run


def _set_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in arrays.chunks(batches):
            grams, first = gram_sets(data, offsets, size)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(i) for i in range(rows.num_columns - 1)), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(grams.view(np.int64)))],
                names=[*rows.schema.names[:-1], "grams"])

    return run


def _link_batches(percent: int):
    """Sorted rows (part, i, j, ord, label, grams); the sets of one (part, i, j) are joined when the next begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ords, labels, sets = None, [], [], []

        def links() -> pa.RecordBatch:
            ids = np.array(ords, np.int64)
            _, first, own = np.unique(np.array(labels, np.int64), return_index=True, return_inverse=True)
            root = link_sets(sets, percent, first[own])
            moved = np.flatnonzero(root != first[own])
            return pa.RecordBatch.from_pydict({"a": ids[moved], "b": ids[root[moved]]})

        for batch in batches:
            grams = batch.column(5)
            flat, bounds = grams.values.to_numpy(zero_copy_only=False).view(np.uint64), grams.offsets.to_numpy()
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            for i, (own, ord_, label) in enumerate(zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist())):
                if own != key:
                    if len(sets) > 1:
                        yield links()
                    key, ords, labels, sets = own, [], [], []
                ords.append(ord_)
                labels.append(label)
                sets.append(flat[bounds[i]:bounds[i + 1]].copy())
        if len(sets) > 1:
            yield links()

    return run


def link_components(docs: DataFrame, size: int = 3, percent: int = 90, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per input row.

    A set holds the distinct n-grams of `size` words (A-Z in lower case, split at white space), for fewer words their
    whole sequence. Two documents link if 100 * intersection >= percent * union; component_id is the smallest doc_id that
    links lead to. Texts without words and null texts have an empty set and link with nothing. Rows with an equal id are one
    node of the graph; null ids are one node that comes after all others. Other columns are ignored. `percent` is 50 or more:
    below it a set's partners could need more than the two depths that are named.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    keyed = with_key(docs)
    tries = cut(keyed.mapInArrow(_node_batches(size, percent), "doc_id long, ord long, tkey long, n long, da long, db long, nodes array<long>, "
                                 "n_own int, need_own int, need_other int"), BATCH_ROWS)
    # One row per class of equal sets, combined before the shuffle; stored, so that the join of a frequent set can be split.
    same = ["nodes", "n_own", "need_own", "need_other"]
    classes = cut(tries.filter("n > 0").groupBy("n", "da", "db").agg(F.min("ord").alias("rep"), *[F.first(c).alias(c) for c in same]))
    member = cut(tries.select("doc_id", "ord", "n", "da", "db").join(classes.select("n", "da", "db", "rep"), ["n", "da", "db"], "left").drop("da", "db"))
    discard(tries)
    links = _links(keyed, classes, size, percent, block)
    # An id with several texts connects their classes.
    several = cut(member.groupBy("ord").agg(F.min("rep").alias("b"), F.max("rep").alias("hi")).filter("b < hi").select("ord", "b"))
    found = components(links.unionByName(member.join(several, "ord").select(F.col("rep").alias("a"), "b").distinct()))
    return (member.join(found.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep", "ord").alias("c"))
            .select("doc_id", "n_shingles", F.when(F.col("c") < LAST_ID, F.col("c")).alias("component_id")))


def _names(classes: DataFrame) -> DataFrame:
    """(ord, slot, need, node): names of the subtrees at a set's own depth and at that of its smallest partners."""
    slot = lambda k, need, names: F.struct(F.lit(k).cast("byte").alias("slot"), F.col(need).alias("need"), names.alias("nodes"))
    own = F.slice("nodes", F.lit(1), F.col("n_own"))
    other = F.slice("nodes", F.col("n_own") + 1, F.size("nodes") - F.col("n_own"))
    return (classes.select(F.col("rep").alias("ord"), F.explode(F.array(slot(0, "need_own", own), slot(1, "need_other", other))).alias("s"))
            .select("ord", "s.slot", "s.need", F.explode("s.nodes").alias("node")))


def _class(names: DataFrame):
    """The class of a row's set, at first the set itself."""
    return F.col("label" if "label" in names.columns else "ord")


def _shared(names: DataFrame) -> DataFrame:
    """(node, held, lead): names that sets of several classes have, how often, and the smallest of these sets."""
    return cut(names.groupBy("node").agg(F.min(_class(names)).alias("lo"), F.max(_class(names)).alias("hi"), F.count("*").alias("held"), F.min("ord").alias("lead"))
               .filter("lo < hi").select("node", "held", "lead"))


def _ties(names: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The names that may still prove a link between classes, the rarest of each set that must hold a proof, and their ties (a, b)."""
    for _ in range(2):  # the second time only sets that passed the first count as others
        shared = _shared(names)
        kept = cut(names.join(shared.select("node"), "node"))
        enough = cut(kept.groupBy("ord", "slot", "need").agg(F.count("*").alias("k")).filter("k >= need").drop("k"))
        discard(shared, names)
        names = cut(kept.join(enough, ["ord", "slot", "need"]))  # the same columns
        discard(kept, enough)
    shared = _shared(names)
    lists = (names.join(shared.select("node", "held"), "node").groupBy("ord", _class(names).alias("label"), "slot", "need")
             .agg(F.array_sort(F.collect_set(F.struct("held", "node"))).alias("l")))
    few = cut(lists.select("ord", "label", F.explode(F.slice("l", F.lit(1), F.greatest(F.size("l") - F.col("need") + 1, F.lit(0)))).alias("x"))
              .select("ord", "label", "x.node"))
    lead = _shared(few)
    ties = cut(few.join(lead, "node").filter("ord > lead").select(F.col("ord").alias("a"), F.col("lead").alias("b")).distinct())
    discard(shared, lead)
    return names, few, ties


def _sets(keyed: DataFrame, placed: DataFrame, size: int) -> DataFrame:
    """(ord, grams) of the sets of candidates."""
    # The same plan at every size: the candidates grow with the input, so they are never broadcast.
    texts = keyed.select("ord", "text").join(placed.select(F.col("ord").alias("own")).hint("merge"), F.col("ord") == F.col("own")).select("ord", "text")
    return cut(texts.mapInArrow(_set_batches(size), "ord long, grams array<long>"), BATCH_ROWS)


def _join(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """(a, b): new links among the sets of each (part, i, j). placed: (ord, label, part, pairs), pairs an array of (i, j)."""
    rows = sets.join(placed.withColumnRenamed("ord", "own").hint("merge"), F.col("ord") == F.col("own"))
    return cut(rows.select("part", F.explode("pairs").alias("p"), "ord", "label", "grams").select("part", "p.i", "p.j", "ord", "label", "grams")
               .repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "ord")
               .mapInArrow(_link_batches(percent), "a long, b long"), BATCH_ROWS)


def _pair(i, j):
    return F.struct(i.cast("long").alias("i"), j.cast("long").alias("j"))


def _dealt(large: DataFrame, few: DataFrame, block: int, turn: int) -> DataFrame:
    """(ord, label, part, pairs): sets with the same smallest name, by a hash of the turn, go to one block; an overfull block is split."""
    alike = few.groupBy("ord").agg(F.min(F.xxhash64("node", F.lit(turn))).alias("h"))
    k = F.greatest(F.lit(1), F.ceil(F.col("total") * 2 / block))
    placed = cut(large.join(alike, "ord").select("ord", "label", "part", "n", F.pmod("h", k).alias("i")))
    load = cut(placed.groupBy("part", "i").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") * 2 / block)).alias("blocks")))
    return placed.join(load, ["part", "i"]).select(
        "ord", "label", "part", F.array(_pair(F.col("i"), F.pmod(F.xxhash64("ord"), "blocks"))).alias("pairs"))


def _every_pair(large: DataFrame, block: int) -> DataFrame:
    """(ord, label, part, pairs): with k blocks a set goes to the k pairs that its block is in."""
    k = F.greatest(F.lit(1), F.ceil(F.col("total") * 2 / block)).cast("long")
    own = F.pmod(F.xxhash64("ord"), k)
    return large.select("ord", "label", "part", F.transform(F.sequence(F.lit(0).cast("long"), k - 1), lambda o: _pair(F.least(o, own), F.greatest(o, own))).alias("pairs"))


def _links(keyed: DataFrame, classes: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    """(a, b): links that connect what links connect, among one set of each class of equal sets. Most of `classes` goes."""
    counts = cut(classes.groupBy(F.col("rep").alias("own")).agg(F.sum("n").alias("n")))
    names, found, sets = _names(classes), [], None
    for turn in range(ROUNDS + 1):
        names, few, ties = _ties(names)
        if not turn:
            discard(classes)
        label = few.groupBy("ord").agg(F.min(_class(few)).alias("label"))
        near = components(ties)
        placed = cut(near.join(counts, near["node"] == counts["own"]).select("own", F.col("component").alias("part"), "n")
                     .join(label, F.col("own") == F.col("ord")).select("ord", "label", "part", "n"))
        if sets is None:
            sets = _sets(keyed, placed, size)
        totals = cut(placed.groupBy("part").agg(F.sum("n").alias("total")))
        sized = placed.join(totals, "part")
        found.append(_join(sets, sized.filter(F.col("total") <= block).select("ord", "label", "part", F.array(_pair(F.lit(0), F.lit(0))).alias("pairs")), percent))
        large = sized.filter(F.col("total") > block)
        if totals.filter(F.col("total") > block).isEmpty():
            break
        last = turn == ROUNDS
        if not last:
            found.append(_join(sets, _dealt(large, few, block, turn), percent))
            last = found[-1].isEmpty()
        if last:
            found.append(_join(sets, _every_pair(large, block), percent))
            break
        united = cut(components(reduce(DataFrame.unionByName, found)).select(F.col("node").alias("own"), "component"))
        still = cut(large.select(F.col("ord").alias("own")).join(united, "own", "left").select("own", F.coalesce("component", "own").alias("label")))
        before = names
        names = cut(names.drop("label").join(still, F.col("ord") == F.col("own")).drop("own"))
        discard(before, few, ties, placed, totals, united, still)
    discard(names, few)
    return reduce(DataFrame.unionByName, found)
