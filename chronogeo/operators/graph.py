"""Triple tables: patterns, templates, deletions and reachability.

A graph is a DataFrame (g, s, p, o, o_type, lang, dtype), best stored as parquet
partitioned by `p`, so every pattern below reads only its predicates.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.functions import text as X
from chronogeo.schema import VOCAB, Vocabulary
from chronogeo.session import cut, discard

TRIPLE_COLUMNS = ["g", "s", "p", "o", "o_type", "lang", "dtype"]
MANY_ROWS = 10_000  # of one key of a join: it is looked up in a small stored table


# ---------------------------------------------------------------- patterns

def edges(triples: DataFrame, p: str, s: str = "s", o: str = "o") -> DataFrame:
    """Subject and object of one predicate."""
    return triples.filter(F.col("p") == p).select(F.col("s").alias(s), F.col("o").alias(o))


def literals(triples: DataFrame, p: str, s: str = "s", value: str = "value") -> DataFrame:
    """(s, value, lang) of one predicate; untagged literals have lang ''."""
    return triples.filter(F.col("p") == p).select(
        F.col("s").alias(s), F.col("o").alias(value), F.coalesce(F.col("lang"), F.lit("")).alias("lang"))


def instances(triples: DataFrame, p: str, o: str | list[str], s: str = "s") -> DataFrame:
    """Distinct subjects with the given object."""
    values = [o] if isinstance(o, str) else o
    hit = F.col("o") == values[0] if len(values) == 1 else F.col("o").isin(values)
    return triples.filter((F.col("p") == p) & hit).select(F.col("s").alias(s)).distinct()


def one_of(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """One value per key: the smallest, so that reruns agree."""
    return df.groupBy(key).agg(F.min(value).alias(out))


def optional(df: DataFrame, prop: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join: keep rows without the property."""
    return df.join(prop, on, "left")


def missing(df: DataFrame, prop: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows without the property."""
    return df.join(prop, on, "left_anti")


def join_frequent(rows: DataFrame, facts: DataFrame, on: str, many: int = MANY_ROWS) -> DataFrame:
    """Inner join of rows whose keys can be very frequent, such as a place or a type, with facts of those keys.

    The texts of one frequent key compress so well that its partition passes for a small one and is not split. So keys are
    counted first, and the facts of those with over `many` rows are stored by themselves: a small table, which is sent to
    the rows. Facts of keys that are in no row are not joined.
    """
    keys = cut(rows.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_n")))
    most, least = keys.agg(F.max("_n"), F.min("_n")).first()
    rare = facts.join(keys.filter(F.col("_n") <= many).select(on), on, "left_semi")
    if most is None or most <= many:
        return rows.join(rare, on)
    frequent = cut(keys.filter(F.col("_n") > many).select(on))
    looked_up = rows.join(cut(facts.join(frequent, on, "left_semi")), on)
    return looked_up if least > many else looked_up.unionByName(rows.join(frequent, on, "left_anti").join(rare, on))


def pattern(triples: DataFrame, wanted: dict[str, str], subject: str = "s", optional_: set[str] | None = None) -> DataFrame:
    """Star pattern: one column per predicate, one row per combination of values."""
    names = [n for n in wanted if n not in (optional_ or set())] + [n for n in wanted if n in (optional_ or set())]
    out = edges(triples, wanted[names[0]], subject, names[0])
    for name in names[1:]:
        how = "left" if name in (optional_ or set()) else "inner"
        out = out.join(edges(triples, wanted[name], subject, name), subject, how)
    return out


def appellations(triples: DataFrame, kinds: list[str], vocab: Vocabulary = VOCAB, strict: bool = False) -> DataFrame:
    """(item, node, kind, label, lang) of the appellation nodes of the given kinds, in one set of joins.

    `strict` also asks for the appellation class on the node.
    """
    wanted = {vocab.kind(k): k for k in kinds}
    name = F.element_at(F.create_map(*[F.lit(v) for kv in wanted.items() for v in kv]), F.col("o"))
    nodes = triples.filter((F.col("p") == vocab.c("P2_has_type")) & F.col("o").isin(list(wanted))).select(
        F.col("s").alias("node"), name.alias("kind"))
    if strict:
        nodes = nodes.join(instances(triples, vocab.rdf_type, vocab.c("E41_Appellation"), "node"), "node", "left_semi")
    return (
        edges(triples, vocab.c("P1_is_identified_by"), "item", "node")
        .join(nodes, "node")
        .join(literals(triples, vocab.label, "node", "label"), "node")
        .select("item", "node", "kind", "label", "lang")
    )


def has_appellation(triples: DataFrame, kind: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Items with an appellation node of the kind, labelled or not."""
    nodes = instances(triples, vocab.c("P2_has_type"), vocab.kind(kind), "node").join(
        instances(triples, vocab.rdf_type, vocab.c("E41_Appellation"), "node"), "node", "left_semi")
    links = edges(triples, vocab.c("P1_is_identified_by"), "item", "node")
    return links.join(nodes, "node", "left_semi").select("item").distinct()


def preferred_labels(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(node, label): the acronym, else an Italian or untagged label, else an English one."""
    return preferred(appellations(triples, ["acronym"], vocab, strict=True), literals(triples, vocab.label, "node", "label"))


def preferred(acronyms: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) of first rank from (item, label) and (node, label, lang)."""
    lang = F.col("lang")
    acronyms = acronyms.select(F.col("item").alias("node"), F.lit(0).alias("rank"), "label")
    tagged = labels.select(
        "node", F.when(lang.isin("it", ""), 1).when(lang == "en", 2).alias("rank"), "label").filter("rank is not null")
    every = acronyms.unionByName(tagged)
    best = every.groupBy("node").agg(F.min("rank").alias("rank"))
    return every.join(best, ["node", "rank"]).select("node", "label").distinct()


def best_labels(triples: DataFrame, subjects: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(s, label): smallest of (rank, label); acronym 0, Italian 1, untagged or English 2."""
    acronyms = appellations(triples, ["acronym"], vocab, strict=True).select(
        F.col("item").alias("s"), F.lit(0).alias("rank"), "label")
    lang = F.col("lang")
    tagged = literals(triples, vocab.label, "s", "label").select(
        "s", F.when(lang == "it", 1).when(lang.isin("", "en"), 2).alias("rank"), "label").filter("rank is not null")
    return (
        acronyms.unionByName(tagged).join(subjects.select("s"), "s", "left_semi")
        .groupBy("s").agg(F.min(F.struct("rank", "label")).alias("best"))
        .select("s", "best.label")
    )


# ---------------------------------------------------------------- templates

def term(s: Column, p: str, o: Column, o_type: str = "iri", lang: Column | None = None, dtype: str | None = None,
         g: Column | None = None) -> Column:
    """One template row."""
    none = F.lit(None).cast("string")
    return F.struct(
        (none if g is None else g).alias("g"), s.alias("s"), F.lit(p).alias("p"), o.cast("string").alias("o"),
        F.lit(o_type).alias("o_type"), (none if lang is None else lang).alias("lang"),
        F.lit(dtype).cast("string").alias("dtype"))


def construct(bindings: DataFrame, template: list[Column], unique: bool = False) -> DataFrame:
    """Template rows of every binding; rows with an unbound subject or object are left out.

    `unique` says that no two bindings make the same triple, which saves the
    shuffle of a distinct. Minted IRIs are best bound as columns before.
    """
    rows = bindings.select(F.inline(F.array(*template)))
    rows = rows.filter(F.col("s").isNotNull() & F.col("o").isNotNull()).select(*TRIPLE_COLUMNS)
    return rows if unique else rows.distinct()


def _same_triple(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    """All columns are equal. Their hash is compared first: texts of a graph begin alike, which is slow to sort by."""
    near = F.xxhash64(*[a[c] for c in cols]) == F.xxhash64(*[b["_" + c] for c in cols])
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b["_" + c]) for c in cols], near)


def _renamed(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias("_" + c) for c in cols])


def add_triples(triples: DataFrame, new: DataFrame, predicates: list[str] | None = None) -> DataFrame:
    """Set union; only the new rows are compared with the graph.

    `predicates` are all that `new` has, if known: triples of others are not compared.
    """
    cols = list(TRIPLE_COLUMNS)
    fresh = new.select(*TRIPLE_COLUMNS).distinct()
    old = _renamed(triples.filter(F.col("p").isin(predicates)) if predicates else triples, cols)
    return triples.select(*TRIPLE_COLUMNS).unionByName(fresh.join(old, _same_triple(fresh, old, cols), "left_anti"))


def delete_triples(triples: DataFrame, rows: DataFrame, predicates: list[str] | None = None) -> DataFrame:
    """Graph without the listed triples, compared in all triple columns that `rows` has.

    Other predicates than `predicates` pass by without a join.
    """
    cols = [c for c in TRIPLE_COLUMNS if c in rows.columns]
    gone = _renamed(rows.select(*cols).distinct(), cols)
    touched = triples.filter(F.col("p").isin(predicates)) if predicates else triples
    kept = touched.join(gone, _same_triple(touched, gone, cols), "left_anti")
    return kept.unionByName(triples.filter(~F.col("p").isin(predicates))) if predicates else kept


def delete_nodes(triples: DataFrame, nodes: DataFrame) -> DataFrame:
    """Graph without the nodes: neither their properties nor links to them."""
    keys = nodes.select("node").distinct()
    kept = triples.join(keys, triples["s"] == keys["node"], "left_anti")
    links = F.when(F.col("o_type") == "iri", F.col("o"))
    return kept.withColumn("_to", links).join(keys.withColumnRenamed("node", "_to"), "_to", "left_anti").drop("_to")


# ---------------------------------------------------------------- reachability

def closure(links: DataFrame, acyclic: bool = False) -> DataFrame:
    """(s, o, depth): every node reachable from `s` and the shortest distance; `s` itself at 0.

    Distances double per round: pairs nearer than 2^k are joined with the links
    of exactly 2^k steps, so a chain of depth d takes about log2(d) rounds. Known
    pairs are dropped, and a round without new pairs ends the loop, also on
    cycles; `acyclic=True` saves that comparison and minimises once at the end, and
    raises when a distance shows that there is a cycle after all.
    Each round is written to the shared folder, so the plan does not grow.
    """
    jump = cut(links.select("s", "o").filter(F.col("o").isNotNull()).distinct())
    nodes = jump.select("s").unionByName(jump.select(F.col("o").alias("s"))).distinct()
    near = cut(nodes.select("s", F.col("s").alias("o"), F.lit(0).alias("depth")))
    most = nodes.count() if acyclic else None
    for k in count():
        if acyclic and 2**k > most and not jump.isEmpty():
            raise ValueError("acyclic=True, but the links have a cycle")
        step = jump.select(F.col("s").alias("o"), F.col("o").alias("_up"))
        far = near.join(step, "o").select("s", F.col("_up").alias("o"), (F.col("depth") + 2**k).cast("int").alias("depth"))
        if not acyclic:
            far = far.groupBy("s", "o").agg(F.min("depth").alias("depth")).join(near.select("s", "o"), ["s", "o"], "left_anti")
        far = cut(far)
        if far.isEmpty():
            break
        near = near.unionByName(far)
        jump = cut(jump.join(step.withColumnRenamed("o", "_mid"), F.col("o") == F.col("_mid")).select("s", F.col("_up").alias("o")).distinct())
    return near.groupBy("s", "o").agg(F.min("depth").alias("depth")) if acyclic else near


def ancestor_counts(pairs: DataFrame) -> DataFrame:
    """(s, o, n): number of nodes on the way from `s` up to `o`, both ends included, from pairs (s, o) alone.

    `hierarchy.way_counts` needs no join of the pairs with themselves where every node has one parent.

    Counts are combined before the shuffle; pairs meet on the middle node, where
    the side of the (few) ancestors of one node is the short one.
    """
    down = pairs.select(F.col("s"), F.col("o").alias("mid"))
    up = pairs.select(F.col("s").alias("mid"), "o")
    return down.join(up, "mid").groupBy("s", "o").agg(F.count("*").alias("n"))


def ancestor_chain(nodes: DataFrame, links: DataFrame, labels: DataFrame, levels: int = 7) -> DataFrame:
    """(node, path): labels of up to `levels` parents above each node, root first.

    Several parents or labels give several paths. Missing labels are skipped,
    the node's own label is blank when it has none.
    """
    # one stored table of (node, parent, parent's label) serves all levels
    named = links.join(labels.select(F.col("node").alias("o"), F.col("label").alias("_name")), "o", "left")
    step = cut(named.select(F.col("s").alias("_at"), F.col("o").alias("_up"), "_name").distinct())
    own = labels.select("node", F.col("label").alias("path"))
    out = nodes.select("node").distinct().join(own, "node", "left").withColumn("path", F.coalesce("path", F.lit("")))
    out = out.withColumn("_at", F.col("node"))
    # above a root the key is a value no node has; a shared NULL would pile finished rows on one task
    end = F.concat(F.lit("\u0000"), F.col("node"))
    for _ in range(levels):
        head = F.coalesce(F.concat(F.col("_name"), F.lit(", ")), F.lit(""))
        out = out.join(step, "_at", "left").select(
            "node", F.concat(head, F.col("path")).alias("path"), F.coalesce("_up", end).alias("_at"))
    return out.select("node", "path").distinct()


def reached(links: DataFrame, start: DataFrame) -> DataFrame:
    """Distinct `node`s met from the `node`s of `start` along links (s, o), these included; NULL starts nowhere.

    A round joins the links with the nodes of the round before alone and each node is passed once, so what is shuffled
    follows what is reached. The result is a table of `session.cut`.
    """
    frontier = cut(start.select("node").filter("node IS NOT NULL").distinct())
    seen, tables = frontier, [frontier]
    while not frontier.isEmpty():
        step = links.join(frontier, F.col("s") == F.col("node"), "left_semi").select(F.col("o").alias("node"))
        frontier = cut(step.filter("node IS NOT NULL").distinct().join(seen, "node", "left_anti"))
        tables.append(frontier)
        seen = seen.unionByName(frontier)
    out = cut(seen)
    discard(*tables)
    return out
