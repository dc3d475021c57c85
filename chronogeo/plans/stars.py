"""Parts of search terms read from a property table: a node's class, kind and label stand in one row, so only links are joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.operators.properties import Properties, labels_of, star
from chronogeo.schema import VOCAB, Vocabulary


def term_predicates(vocab: Vocabulary = VOCAB) -> list[str]:
    """What a property table must hold for the search terms of all kinds."""
    links = ["P1_is_identified_by", "P2_has_type", "P4_has_time-span", "P71i_is_listed_in", "P95i_was_formed_by", "P98i_was_born",
             "P99i_dissolved_by", "P100i_died_in", "P170i_time_is_defined_by", "P53_has_former_or_current_location", "P46i_forms_part_of",
             "P108i_was_produced_by", "P14.1_in_the_role_of", "P01i_is_domain_of", "P02_has_range", "P82a_begin_of_the_begin",
             "P7_took_place_at", "P129i_is_subject_of", "P94i_was_created_by", "P14_carried_out_by"]
    own = ["has_island", "has_broader", "has_broader_typology"]
    return [vocab.rdf_type, vocab.label, vocab.frbroo + "R24i_was_created_through", *[vocab.onto(p) for p in own], *[vocab.c(p) for p in links]]


def open_items(table: Properties, cls: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Nodes of the class without a search term."""
    terms = star(table, {}, "node", where={vocab.c("P2_has_type"): [vocab.kind("search_term")], vocab.rdf_type: [vocab.c("E41_Appellation")]})
    done = star(table, {"node": vocab.c("P1_is_identified_by")}, "item").join(terms, "node", "left_semi").select("item")
    return star(table, {}, "item", where={vocab.rdf_type: [cls]}).join(done, "item", "left_anti")


def names(table: Properties, kinds: list[str], vocab: Vocabulary = VOCAB, strict: bool = False) -> DataFrame:
    """(item, kind, label) of the appellations of the given kinds; `strict` also asks for their class."""
    wanted = {vocab.kind(k): k for k in kinds}
    where = {vocab.c("P2_has_type"): list(wanted)} | ({vocab.rdf_type: [vocab.c("E41_Appellation")]} if strict else {})
    kind = F.element_at(F.create_map(*[F.lit(v) for kv in wanted.items() for v in kv]), F.col("type"))
    nodes = star(table, {"type": vocab.c("P2_has_type"), "label": vocab.label}, "node", where=where).select("node", kind.alias("kind"), "label")
    nodes = nodes.filter("kind IS NOT NULL")
    return star(table, {"node": vocab.c("P1_is_identified_by")}, "item").join(nodes, "node").select("item", "kind", "label")


def years(table: Properties, link: str | None, out: str, vocab: Vocabulary = VOCAB, node_class: str | None = None) -> DataFrame:
    """(item, year label): item -> [node of a class ->] time span -> year primitive; three joins at most."""
    primitives = star(table, {out: vocab.label}, "primitive", where={
        vocab.rdf_type: [vocab.c("E61_Time-Primitive")], vocab.c("P2_has_type"): [vocab.kind("time_primitive_year")]})
    dated = star(table, {"primitive": vocab.c("P170i_time_is_defined_by")}, "span").join(primitives, "primitive").select("span", out)
    of_class = {vocab.rdf_type: [vocab.c(node_class)]} if node_class else {}
    events = star(table, {"span": vocab.c("P4_has_time-span")}, "event", where=of_class).join(dated, "span").select("event", out)
    if not node_class:
        return events.withColumnRenamed("event", "item")
    return star(table, {"event": link}, "item").join(events, "event").select("item", out)


def edges(table: Properties, p: str, s: str = "s", o: str = "o") -> DataFrame:
    return star(table, {o: p}, s)


def instances(table: Properties, p: str, o: str | list[str], s: str) -> DataFrame:
    """Nodes with one of the given objects."""
    return star(table, {}, s, where={p: [o] if isinstance(o, str) else o})


def literals(table: Properties, p: str, s: str, value: str) -> DataFrame:
    return labels_of(table, p).select(F.col("s").alias(s), F.col("value").alias(value), "lang")


def classed(table: Properties, p: str, s: str, o: str, cls: str, flag: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Subject and object of one predicate, and whether the subject is of the class, once per class of the subject."""
    rows = star(table, {o: p, flag: vocab.rdf_type}, s, {flag})
    return rows.withColumn(flag, F.coalesce(F.col(flag) == cls, F.lit(False)))
