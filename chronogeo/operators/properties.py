"""Property table: the triples of a graph as one row per node, so that star patterns need no join.

A node with very many values of one predicate, such as a type that lists its members, would make one huge row. These nodes
stay triples: a star pattern over them is joined as in `graph.pattern`, over all others it only opens arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogeo.operators import graph as R
from chronogeo.schema import TRIPLES
from chronogeo.session import cut

MOST_VALUES = 1000  # of one predicate in a row of the table; nodes with more stay triples
VALUE_FIELDS = ["o", "o_type", "lang", "dtype", "g"]


@dataclass
class Properties:
    """`rows`: s and an array of values per predicate, named by `columns`; `hubs`: all triples of the other nodes.

    Patterns over a table that is known to have no hubs are without the joins for them.
    """

    rows: DataFrame
    hubs: DataFrame
    columns: dict[str, str]
    has_hubs: bool = True


def property_table(triples: DataFrame, predicates: list[str], most: int = MOST_VALUES) -> Properties:
    """One row per node that has at least one of the predicates; values are ordered and repeated triples come once.

    Nodes with more than `most` triples of one predicate are kept as triples, so no row grows without bound and nothing is
    lost. Triples without subject, predicate or object are in no pattern and left out.
    """
    if not predicates:
        raise ValueError("no predicates given")
    columns = {p: f"v{i}" for i, p in enumerate(dict.fromkeys(predicates))}
    used = triples.filter(F.col("p").isin(list(columns)) & F.col("s").isNotNull() & F.col("o").isNotNull())
    large = _large(used, most)
    if large is None:
        few, hubs = used, used.limit(0)
    else:
        few, hubs = used.join(large, "s", "left_anti"), used.join(large, "s", "left_semi")
    # one list of all values of a node, cut up by predicate afterwards: a list per predicate would be kept for every row
    number = F.element_at(F.create_map(*[F.lit(x) for i, p in enumerate(columns) for x in (p, i)]), F.col("p"))
    few = few.select("s", F.struct(number.alias("k"), *VALUE_FIELDS).alias("_v")).repartition("s")
    few = few.groupBy("s").agg(F.array_sort(F.collect_set("_v")).alias("_all"))
    rows = few.select("s", *[_values_of(i).alias(c) for i, c in enumerate(columns.values())])
    return Properties(rows, hubs.select(*R.TRIPLE_COLUMNS), columns)


def _values_of(number: int) -> Column:
    mine = F.filter("_all", lambda v: v["k"] == number)
    return F.transform(mine, lambda v: F.struct(*[v[f].alias(f) for f in VALUE_FIELDS]))


def _large(used: DataFrame, most: int) -> DataFrame | None:
    """Nodes with more than `most` triples of one predicate, None without any. Short hashes are counted first, so only
    the few triples of a hash that is met so often are counted by their texts."""
    key = F.xxhash64("s", "p")
    often = cut(used.groupBy(key.alias("_h")).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select("_h"))
    if often.isEmpty():
        return None
    pairs = used.select("s", "p", key.alias("_h")).join(often, "_h", "left_semi")
    return cut(pairs.groupBy("s", "p").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("s").distinct())


def write_properties(table: Properties, path: str, mode: str = "errorifexists") -> None:
    """Parquet: the rows under their column names, the hubs by predicate; the names are read from the field comments."""
    named = [F.col(c).alias(c, metadata={"predicate": p}) for p, c in table.columns.items()]
    table.rows.select("s", *named).write.mode(mode).parquet(f"{path}/rows")
    table.hubs.hint("rebalance", "p").write.mode(mode).partitionBy("p").parquet(f"{path}/hubs")


def read_properties(spark: SparkSession, path: str) -> Properties:
    rows = spark.read.parquet(f"{path}/rows")
    columns = {f.metadata["predicate"]: f.name for f in rows.schema.fields if "predicate" in f.metadata}
    hubs = spark.read.schema(TRIPLES).parquet(f"{path}/hubs").select(*TRIPLES.fieldNames())
    return Properties(rows, hubs, columns, has_hubs=not hubs.isEmpty())


def _opened(table: Properties, rows: DataFrame, p: str, name: str, optional: bool) -> DataFrame:
    explode = F.explode_outer if optional else F.explode
    value = F.transform(F.col(table.columns[p]), lambda v: v["o"])
    return rows.withColumn(name, explode(value))


def _having(table: Properties, wanted: list[str], where: dict[str, list[str]]) -> Column:
    hit = F.lit(True)
    for p in wanted:
        hit &= F.size(table.columns[p]) > 0
    for p, values in where.items():
        hit &= F.arrays_overlap(F.transform(table.columns[p], lambda v: v["o"]), F.array(*[F.lit(o) for o in values]))
    return hit


def star(table: Properties, wanted: dict[str, str], subject: str = "s", optional_: set[str] | None = None,
         where: dict[str, list[str]] | None = None, absent: list[str] | None = None) -> DataFrame:
    """Star pattern as in `graph.pattern`: one column per name, one row per combination of values.

    `where` asks for one of the given objects of a predicate and `absent` for no triple of it, both without a column.
    All predicates must be in the table. Nodes with any required predicate missing have no row.
    """
    optional_, where, absent = optional_ or set(), where or {}, absent or []
    unknown = {*wanted.values(), *where, *absent} - set(table.columns)
    if unknown:
        raise ValueError(f"not in the property table: {sorted(unknown)}")
    needed = [p for n, p in wanted.items() if n not in optional_]
    few = table.rows.filter(_having(table, needed, where))
    for p in absent:
        few = few.filter(F.size(table.columns[p]) == 0)
    # only the asked columns are opened, one after the other; names may be those of columns of the table
    inner = {n: f"_{i}" for i, n in enumerate(wanted)}
    for n, p in wanted.items():
        few = _opened(table, few, p, inner[n], n in optional_)
    few = few.select(F.col("s").alias(subject), *[F.col(inner[n]).alias(n) for n in wanted])

    if not table.has_hubs:
        return few
    hubs = table.hubs.distinct()
    many = hubs.select("s").distinct()
    for p, values in where.items():
        many = many.join(R.instances(hubs, p, values), "s", "left_semi")
    for p in absent:
        many = many.join(R.edges(hubs, p).select("s"), "s", "left_anti")
    for n, p in wanted.items():
        many = many.join(R.edges(hubs, p, "s", inner[n]), "s", "left" if n in optional_ else "inner")
    return few.unionByName(many.select(F.col("s").alias(subject), *[F.col(inner[n]).alias(n) for n in wanted]))


def labels_of(table: Properties, p: str) -> DataFrame:
    """(s, value, lang) of one predicate, as `graph.literals` gives them; untagged literals have lang ''."""
    v = F.col("v")
    few = table.rows.select("s", F.explode(table.columns[p]).alias("v")).select(
        "s", v["o"].alias("value"), F.coalesce(v["lang"], F.lit("")).alias("lang"))
    if not table.has_hubs:
        return few
    return few.unionByName(R.literals(table.hubs.distinct(), p))
