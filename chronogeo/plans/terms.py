"""Search terms: one text per item that gathers names, places and years.

The graph is a table of triples or a property table that holds `stars.term_predicates`, which needs fewer joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.functions import text as X
from chronogeo.operators import graph as R
from chronogeo.operators.properties import Properties
from chronogeo.plans import stars
from chronogeo.schema import VOCAB, Vocabulary
from chronogeo.session import cut

CLASSES = {
    "event": "Event",
    "group": "Group",
    "person": "Person",
    "primary_source": "Source_Primary",
    "secondary_source": "Source_Secondary",
}


def _spaced(part: str) -> Column:
    return F.coalesce(F.concat(F.lit(" "), F.col(part)), F.lit(""))


Graph = DataFrame | Properties


def _reader(triples: Graph):
    """Edges, instances and literals of the graph."""
    return stars if isinstance(triples, Properties) else R


def open_items(triples: Graph, kind: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Items of the kind that have no search term yet."""
    if isinstance(triples, Properties):
        return stars.open_items(triples, vocab.onto(CLASSES[kind]), vocab)
    items = R.instances(triples, vocab.rdf_type, vocab.onto(CLASSES[kind]), "item")
    return R.missing(items, R.has_appellation(triples, "search_term", vocab), "item")


def _names(triples: Graph, kinds: list[str], vocab: Vocabulary, strict: bool = False) -> DataFrame:
    """(item, kind, label) of the appellations of the given kinds."""
    if isinstance(triples, Properties):
        return stars.names(triples, kinds, vocab, strict)
    return R.appellations(triples, kinds, vocab, strict).select("item", "kind", "label")


def _preferred(triples: Graph, vocab: Vocabulary) -> DataFrame:
    if isinstance(triples, Properties):
        return R.preferred(_names(triples, ["acronym"], vocab, strict=True), stars.literals(triples, vocab.label, "node", "label"))
    return R.preferred_labels(triples, vocab)


def _year_of(triples: Graph, link: str, out: str, vocab: Vocabulary, node_class: str | None = None) -> DataFrame:
    """(item, year label): item -> [node of a class ->] time span -> year primitive."""
    if isinstance(triples, Properties):
        return stars.years(triples, link, out, vocab, node_class)
    spans = R.edges(triples, vocab.c("P4_has_time-span"), "event", "span")
    if node_class:
        spans = spans.join(R.instances(triples, vocab.rdf_type, vocab.c(node_class), "event"), "event", "left_semi")
    years = (
        R.edges(triples, vocab.c("P170i_time_is_defined_by"), "span", "primitive")
        .join(R.instances(triples, vocab.rdf_type, vocab.c("E61_Time-Primitive"), "primitive"), "primitive", "left_semi")
        .join(R.instances(triples, vocab.c("P2_has_type"), vocab.kind("time_primitive_year"), "primitive"), "primitive", "left_semi")
        .join(R.literals(triples, vocab.label, "primitive", out), "primitive")
        .select("span", out)
    )
    dated = spans.join(years, "span").select("event", out)
    if not node_class:
        return dated.withColumnRenamed("event", "item")
    return R.edges(triples, link, "item", "event").join(dated, "event").select("item", out)


def _island(triples: Graph, out: str, vocab: Vocabulary, typed: bool) -> DataFrame:
    """One island name per item."""
    G = _reader(triples)
    if typed:
        names = _names(triples, ["appellation"], vocab, strict=True).select(F.col("item").alias("island"), "label")
    else:
        names = G.edges(triples, vocab.c("P1_is_identified_by"), "island", "node").join(
            G.literals(triples, vocab.label, "node", "label"), "node").select("island", "label")
    links = G.edges(triples, vocab.onto("has_island"), "item", "island")
    return R.one_of(links.join(R.one_of(names, "island", "label", "label"), "island"), "item", "label", out)


def event_terms(triples: Graph, vocab: Vocabulary = VOCAB) -> DataFrame:
    G = _reader(triples)
    langs = F.col("lang").isin("it", "en", "")
    labels = G.literals(triples, vocab.label, "item", "label").filter(langs)
    listed = G.instances(triples, vocab.c("P71i_is_listed_in"), vocab.event_types, "type")
    types = G.literals(triples, vocab.label, "type", "typology").filter(langs).join(listed, "type", "left_semi")
    typology = R.join_frequent(G.edges(triples, vocab.c("P2_has_type"), "item", "type"), types, "type").select(
        F.col("item").alias("_item"), F.col("lang").alias("_lang"), "typology").distinct()
    rows = R.optional(open_items(triples, "event", vocab), labels, "item")
    # an item without any label takes its language from the typology
    match = (F.col("item") == F.col("_item")) & (F.col("lang").isNull() | (F.col("lang") == F.col("_lang")))
    rows = rows.join(typology, match, "left").withColumn("lang", F.coalesce("lang", "_lang"))
    rows = R.optional(rows, _island(triples, "island", vocab, typed=True), "item")
    year = R.one_of(_year_of(triples, "", "year", vocab), "item", "year", "year")
    rows = R.optional(rows, year, "item")
    text = F.concat(F.coalesce("label", F.lit("")), _spaced("island"), _spaced("typology"), _spaced("year"))
    return rows.select("item", F.when(F.col("lang").isNotNull(), text).alias("label"), "lang").distinct()


NAME_KINDS = ["given_name", "family_name", "alias", "appellation"]


def _name(given: Column, family: Column, alias: Column, group: Column) -> Column:
    full = F.concat(F.coalesce(F.concat(family, F.lit(", ")), F.lit("")), F.coalesce(given, F.lit("")))
    person = F.coalesce(F.concat(alias, F.lit(" ("), full, F.lit(")")), full)
    return F.concat(F.coalesce(group, F.lit("")), person)


def group_terms(triples: Graph, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Any one name per group, so one of each part is enough: no combinations are made."""
    parts = _names(triples, NAME_KINDS, vocab).groupBy("item").agg(
        *[F.min(F.when(F.col("kind") == k, F.col("label"))).alias(k) for k in NAME_KINDS])
    name = _name(F.col("given_name"), F.col("family_name"), F.col("alias"), F.col("appellation"))
    rows = R.optional(open_items(triples, "group", vocab), parts, "item")
    for link, cls, out in [("P95i_was_formed_by", "E66_Formation", "formed"), ("P99i_dissolved_by", "E68_Dissolution", "dissolved")]:
        rows = R.optional(rows, R.one_of(_year_of(triples, vocab.c(link), out, vocab, cls), "item", out, out), "item")
    return rows.select("item", F.concat(name, _spaced("formed"), _spaced("dissolved")).alias("label"),
                       F.lit(None).cast("string").alias("lang"))


def person_terms(triples: Graph, vocab: Vocabulary = VOCAB, include_death_only: bool = False) -> DataFrame:
    """Every combination of a person's own name parts is a term of its own.

    Dates start from births; with `include_death_only` a death without a birth
    counts as well.
    """
    # read five times below, so it is stored once
    names = cut(_names(triples, NAME_KINDS + ["patronymic"], vocab).distinct())
    rows = open_items(triples, "person", vocab)
    for k in NAME_KINDS:
        rows = R.optional(rows, names.filter(F.col("kind") == k).select("item", F.col("label").alias(k)), "item")
    value = _name(F.col("given_name"), F.col("family_name"), F.col("alias"), F.col("appellation"))
    rows = rows.select("item", value.alias("value")).distinct()
    single = names.filter(F.col("kind").isin("alias", "patronymic")).groupBy("item").agg(
        F.min(F.when(F.col("kind") == "alias", F.col("label"))).alias("alias"),
        F.min(F.when(F.col("kind") == "patronymic", F.col("label"))).alias("patronymic"))
    rows = R.optional(rows, single, "item")

    births = cut(_year_of(triples, vocab.c("P98i_was_born"), "born", vocab, "E67_Birth").distinct())
    deaths = _year_of(triples, vocab.c("P100i_died_in"), "died", vocab, "E69_Death").distinct()
    dates = births.join(deaths, "item", "full" if include_death_only else "left")
    dates = dates.select("item", F.concat(
        F.coalesce("born", F.lit("")), F.coalesce(F.concat(F.lit(" - "), F.col("died")), F.lit(""))).alias("dates"))
    rows = R.optional(rows, dates.distinct(), "item")
    return rows.select(
        "item",
        F.concat(F.coalesce("value", F.lit("")), _spaced("alias"), _spaced("patronymic"), _spaced("dates")).alias("label"),
        F.lit(None).cast("string").alias("lang"),
    ).distinct()


def primary_source_terms(triples: Graph, vocab: Vocabulary = VOCAB, levels: int = 7) -> DataFrame:
    """One term per title and location; paths are built once per archive node, not per item."""
    G = _reader(triples)
    titles = _names(triples, ["attributed_title"], vocab).select("item", F.col("label").alias("title")).distinct()
    rows = open_items(triples, "primary_source", vocab).join(titles, "item")

    at = G.edges(triples, vocab.c("P53_has_former_or_current_location"), "item", "location")
    ref = G.edges(triples, vocab.c("P53_has_former_or_current_location"), "location", "node")
    up = G.edges(triples, vocab.c("P46i_forms_part_of"))
    # only objects that are themselves locations of something carry a reference
    locations = at.select("location").distinct()
    refs = ref.join(locations, "location", "left_semi")
    paths = R.ancestor_chain(refs.select("node"), up, _preferred(triples, vocab), levels)
    archival = refs.join(paths, "node").select("location", F.col("path").alias("archival")).distinct()
    bib = (
        G.edges(triples, vocab.c("P46i_forms_part_of"), "location", "bib").join(locations, "location", "left_semi")
        .join(G.literals(triples, vocab.label, "bib", "bib_label"), "bib").select("location", "bib_label").distinct()
    )
    where = R.optional(R.optional(at, archival, "location"), bib, "location").select(
        "item", F.coalesce("archival", "bib_label", F.lit("")).alias("loc_path")).distinct()
    rows = R.optional(rows, where, "item")
    rows = R.optional(rows, _island(triples, "island", vocab, typed=False), "item")

    made = G.edges(triples, vocab.c("P108i_was_produced_by"), "item", "event").join(
        G.instances(triples, vocab.rdf_type, vocab.c("E12_Production"), "event"), "event", "left_semi")
    year = (
        G.edges(triples, vocab.c("P170i_time_is_defined_by"), "span", "primitive")
        .join(G.instances(triples, vocab.c("P2_has_type"), vocab.kind("time_primitive_year"), "primitive"), "primitive", "left_semi")
        .join(G.literals(triples, vocab.label, "primitive", "year"), "primitive").select("span", "year"))
    year = made.join(G.edges(triples, vocab.c("P4_has_time-span"), "event", "span"), "event").join(year, "span")
    rows = R.optional(rows, R.one_of(year, "item", "year", "year"), "item")
    path = F.when(F.col("loc_path") != "", F.concat(F.lit(" "), F.col("loc_path"))).otherwise("")
    return rows.select(
        "item", F.concat("title", path, _spaced("island"), _spaced("year")).alias("label"),
        F.lit(None).cast("string").alias("lang")).distinct()


def _classed(triples: Graph, p: str, s: str, o: str, cls: str, flag: str, vocab: Vocabulary) -> DataFrame:
    """Subject and object of one predicate, and whether the subject is of the class; rows can come several times."""
    if isinstance(triples, Properties):
        return stars.classed(triples, p, s, o, cls, flag, vocab)
    of_class = R.instances(triples, vocab.rdf_type, cls, s).withColumn(flag, F.lit(True))
    return R.optional(R.edges(triples, p, s, o), of_class, s).withColumn(flag, F.coalesce(flag, F.lit(False)))


def _publication(triples: Graph, vocab: Vocabulary) -> DataFrame:
    """(item, curator, publisher, year, place) of one publication event per item; pub_date is the first date of all that
    are publication events with time spans by class."""
    G = _reader(triples)
    labels = R.one_of(G.literals(triples, vocab.label, "who", "label"), "who", "label", "v")
    roles = {vocab.kind("curator"): "curator", vocab.kind("publisher"): "publisher"}
    role_name = F.element_at(F.create_map(*[F.lit(v) for kv in roles.items() for v in kv]), F.col("o"))
    role = G.edges(triples, vocab.c("P14.1_in_the_role_of"), "part", "o").filter(F.col("o").isin(list(roles))).select(
        "part", role_name.alias("role"))
    who = R.join_frequent(G.edges(triples, vocab.c("P02_has_range"), "part", "who"), labels, "who").select("part", "v")
    actors = G.edges(triples, vocab.c("P01i_is_domain_of"), "event", "part").join(role, "part").join(who, "part")
    places = R.join_frequent(G.edges(triples, vocab.c("P7_took_place_at"), "event", "who"), labels, "who")
    dates = _classed(triples, vocab.c("P82a_begin_of_the_begin"), "span", "v", vocab.c("E52_Time-Span"), "_span", vocab)
    spans = _classed(triples, vocab.c("P4_has_time-span"), "event", "span", vocab.frbroo + "F30_Publication_Event", "_event", vocab).join(dates, "span")
    parts = ["curator", "publisher", "year", "place"]
    no = F.lit(False).alias("strict")
    per_event = reduce(lambda a, b: a.unionByName(b), [
        actors.select("event", "role", "v", no), places.select("event", F.lit("place").alias("role"), "v", no),
        spans.select("event", F.lit("year").alias("role"), "v", (F.col("_event") & F.col("_span")).alias("strict"))]).groupBy("event").agg(
        *[F.min(F.when(F.col("role") == p, F.col("v"))).alias(p) for p in parts], F.min(F.when(F.col("strict"), F.col("v"))).alias("pub_date"))
    events = G.edges(triples, vocab.frbroo + "R24i_was_created_through", "item", "event")
    chosen = R.optional(events, per_event, "event").groupBy("item").agg(
        F.min_by(F.struct(*parts), "event").alias("c"), F.min("pub_date").alias("pub_date"))
    return chosen.select("item", *[F.col("c")[p].alias(p) for p in parts], "pub_date")


def _authors(triples: Graph, vocab: Vocabulary) -> DataFrame:
    """(item, author, authors): the first of all who wrote a work of the item, and all if every node on the way has its class.

    The few names are joined first, so who has none is not carried along.
    """
    names = _classed(triples, vocab.label, "actor", "author", vocab.c("E39_Actor"), "_actor", vocab)
    made = R.join_frequent(
        _classed(triples, vocab.c("P14_carried_out_by"), "creation", "actor", vocab.c("E65_Creation"), "_creation", vocab), names, "actor")
    made = made.select("creation", "author", (F.col("_actor") & F.col("_creation")).alias("_made"))
    works = _classed(triples, vocab.c("P94i_was_created_by"), "work", "creation", vocab.c("E33_Linguistic_Object"), "_work", vocab)
    works = works.join(made, "creation").select("work", "author", (F.col("_made") & F.col("_work")).alias("strict"))
    wrote = _reader(triples).edges(triples, vocab.c("P129i_is_subject_of"), "item", "work").join(works, "work")
    every = F.array_join(F.array_sort(F.collect_set(F.when(F.col("strict"), F.col("author")))), ", ")
    return wrote.groupBy("item").agg(F.min("author").alias("author"), F.when(F.max("strict"), every).alias("authors"))


def secondary_source_terms(triples: Graph, vocab: Vocabulary = VOCAB) -> DataFrame:
    G = _reader(triples)
    titles = _names(triples, ["title"], vocab).select(F.col("item").alias("book"), "label")
    own = cut(R.one_of(titles, "book", "label", "title"))  # read of the items and of what is broader
    typed = R.join_frequent(
        G.edges(triples, vocab.onto("has_broader_typology"), "book", "type"),
        R.one_of(G.literals(triples, vocab.label, "type", "label"), "type", "label", "typology"), "type")
    none = F.lit(None).cast("string")
    of_book = own.select("book", F.col("title").alias("broader"), none.alias("typology")).unionByName(
        typed.select("book", none.alias("broader"), "typology")).groupBy("book").agg(
        F.min("broader").alias("broader"), F.min("typology").alias("typology"))
    above = R.join_frequent(G.edges(triples, vocab.onto("has_broader"), "item", "book"), of_book, "book").groupBy("item").agg(
        F.min("broader").alias("broader"), F.min("typology").alias("typology"))

    rows = open_items(triples, "secondary_source", vocab)
    for prop in (_publication(triples, vocab), _authors(triples, vocab), own.withColumnRenamed("book", "item"), above):
        rows = R.optional(rows, prop, "item")

    def part(name: str, before: str = ", ", after: str = "") -> Column:
        return F.coalesce(F.concat(F.lit(before), F.col(name), F.lit(after)), F.lit(""))

    citation = F.concat(part("author", "", ", "), part("title", ""), part("broader"), part("curator", ", a cura di "),
                        part("place"), part("publisher"), part("year"))
    tail = F.concat_ws(" ", "authors", "typology", "pub_date")
    some = F.coalesce("authors", "typology", "pub_date").isNotNull()
    return rows.select("item", F.concat(citation, F.when(some, F.concat(F.lit(" "), tail)).otherwise("")).alias("label"),
                       F.lit(None).cast("string").alias("lang"))


_MAKERS = {
    "event": event_terms,
    "group": group_terms,
    "person": person_terms,
    "primary_source": primary_source_terms,
    "secondary_source": secondary_source_terms,
}


def search_terms(triples: Graph, kind: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(item, node, label, lang) for items of a kind that have no term; node ids are stable."""
    rows = _MAKERS[kind](triples, vocab)
    return rows.withColumn("node", X.mint_iri(F.col("item"), "search_term", F.col("item"), F.col("label"), F.col("lang")))


def term_triples(terms: DataFrame, vocab: Vocabulary = VOCAB, unique: bool = False) -> DataFrame:
    """Link, class, type and label of each term; a term without text gets no label row.

    `unique`: every row has a node of its own, as in the terms of one kind.
    """
    item, node = F.col("item"), F.col("node")
    return R.construct(terms, [
        R.term(item, vocab.c("P1_is_identified_by"), node),
        R.term(node, vocab.rdf_type, F.lit(vocab.c("E41_Appellation"))),
        R.term(node, vocab.c("P2_has_type"), F.lit(vocab.kind("search_term"))),
        R.term(node, vocab.label, F.col("label"), "literal", F.col("lang")),
    ], unique)


def run_all(triples: Graph, vocab: Vocabulary = VOCAB) -> tuple[DataFrame, DataFrame]:
    """New term triples of all kinds and a (kind, items, terms) summary."""
    terms = [search_terms(triples, k, vocab).withColumn("kind", F.lit(k)) for k in CLASSES]
    every = reduce(lambda a, b: a.unionByName(b), terms)
    summary = every.groupBy("kind").agg(F.count_distinct("item").alias("items"), F.count("*").alias("terms"))
    return term_triples(every, vocab), summary


def term_nodes(triples: DataFrame, kind: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(item, node) search terms of one kind of item."""
    items = R.instances(triples, vocab.rdf_type, vocab.onto(CLASSES[kind]), "item")
    nodes = R.instances(triples, vocab.c("P2_has_type"), vocab.kind("search_term"), "node").join(
        R.instances(triples, vocab.rdf_type, vocab.c("E41_Appellation"), "node"), "node", "left_semi")
    links = R.edges(triples, vocab.c("P1_is_identified_by"), "item", "node")
    return links.join(nodes, "node", "left_semi").join(items, "item", "left_semi").distinct()


def clean_search_terms(triples: DataFrame, kind: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Remove link, class, type and labels of the labelled search terms of one kind of item."""
    terms = term_nodes(triples, kind, vocab).join(
        R.literals(triples, vocab.label, "node", "label"), "node").withColumn("lang", F.nullif("lang", F.lit("")))
    gone = term_triples(terms, vocab)
    # untagged labels may be stored with '' or NULL as language
    plain = triples.withColumn("lang", F.nullif("lang", F.lit("")))
    return R.delete_triples(plain, gone, [
        vocab.c("P1_is_identified_by"), vocab.rdf_type, vocab.c("P2_has_type"), vocab.label])


def clean_term_nodes(triples: DataFrame, kind: str, vocab: Vocabulary = VOCAB) -> tuple[DataFrame, DataFrame]:
    """Remove search-term nodes with all they hold; report terms and triples per item."""
    nodes = term_nodes(triples, kind, vocab)
    sizes = triples.join(nodes.select(F.col("node").alias("s")).distinct(), "s", "left_semi").groupBy(
        F.col("s").alias("node")).agg(F.count("*").alias("own"))
    report = R.optional(nodes, sizes, "node").groupBy("item").agg(
        F.count("*").alias("terms"), F.sum(F.coalesce("own", F.lit(0)) + 1).alias("triples"))
    return R.delete_nodes(triples, nodes), report
