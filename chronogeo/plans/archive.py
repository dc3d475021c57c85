"""Archive paths and source listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.functions import text as X
from chronogeo.operators import graph as R
from chronogeo.operators import hierarchy as H
from chronogeo.schema import VOCAB, Vocabulary
from chronogeo.session import cut


def archive_subjects(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Collections listed in the archives vocabulary."""
    listed = R.instances(triples, vocab.c("P71i_is_listed_in"), vocab.archives_vocab)
    return R.instances(triples, vocab.rdf_type, vocab.c("E78_Collection")).join(listed, "s", "left_semi")


def known_paths(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    return R.appellations(triples, ["path"], vocab, strict=True).select(F.col("item").alias("s"), F.col("label").alias("path"))


def seed_paths(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(s, path) of archive roots without a path: their best label."""
    roots = R.missing(archive_subjects(triples, vocab), R.edges(triples, vocab.c("P46i_forms_part_of")).select("s"), "s")
    pathed = R.has_appellation(triples, "path", vocab).withColumnRenamed("item", "s")
    return R.best_labels(triples, R.missing(roots, pathed, "s"), vocab).select("s", F.col("label").alias("path"))


def path_labels(triples: DataFrame, subjects: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(s, label): acronym, Italian, untagged or English, else the last part of the IRI."""
    acronyms = R.appellations(triples, ["acronym"], vocab, strict=True).select(
        F.col("item").alias("s"), F.lit(0).alias("rank"), "label")
    lang = F.col("lang")
    tagged = R.literals(triples, vocab.label, "s", "label").select(
        "s",
        F.when(X.lang_matches(lang, "it"), 1).when((lang == "") | X.lang_matches(lang, "en"), 2).alias("rank"),
        "label").filter("rank is not null")
    every = acronyms.unionByName(tagged).join(subjects.select("s"), "s", "left_semi")
    first = every.groupBy("s").agg(F.min("rank").alias("rank"))
    found = every.join(first, ["s", "rank"]).select("s", "label").distinct()
    return subjects.select("s").distinct().join(found, "s", "left").select(
        "s", F.coalesce("label", X.last_segment(F.col("s"))).alias("label"))


def populate_paths(paths: DataFrame, links: DataFrame, labels: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """One level: path of the parent, then the subject's own label, for subjects without a path."""
    step = links.select("s", F.col("o").alias("_parent"))
    above = paths.select(F.col("s").alias("_parent"), F.col("path").alias("_above"))
    rows = labels if done is None else R.missing(labels, done.select("s"), "s")
    return (
        rows.join(step, "s").join(above, "_parent")
        .select("s", F.concat("_above", F.lit(", "), "label").alias("path")).distinct()
    )


def extend_paths(roots: DataFrame, links: DataFrame, labels: DataFrame) -> DataFrame:
    """Roots and everything below them, each with the path of its parent and its own label.

    With one parent each, paths double per round (`hierarchy.paths_by_doubling`). Else they are populated level by level
    until nothing is added: only the last level is joined, and whoever has a parent on an earlier level got its path then.
    Nodes on a cycle are never reached from a root.
    """
    links, labels = cut(H.distinct_links(links)), cut(labels.select("s", "label").distinct())
    roots = cut(roots.select("s", "path"))
    if not H.has_several_parents(links):
        return roots.unionByName(H.paths_by_doubling(roots, links, labels))
    frontier = cut(roots.select("s", "path"))
    out = frontier
    while not frontier.isEmpty():
        frontier = cut(populate_paths(frontier, links, labels, out))
        out = out.unionByName(frontier)
    return out


def archive_paths(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(s, path) that are new: seeded roots and everything below paths old and new."""
    subjects = archive_subjects(triples, vocab)
    old = known_paths(triples, vocab)
    start = old.unionByName(seed_paths(triples, vocab))
    links = R.edges(triples, vocab.c("P46i_forms_part_of")).join(subjects, "s", "left_semi")
    full = extend_paths(start, links, path_labels(triples, subjects, vocab))
    pathed = R.has_appellation(triples, "path", vocab).withColumnRenamed("item", "s")
    return R.missing(full, pathed, "s")


def path_triples(paths: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    node = X.mint_iri(F.col("s"), "path")
    return R.construct(paths, [
        R.term(F.col("s"), vocab.c("P1_is_identified_by"), node),
        R.term(node, vocab.rdf_type, F.lit(vocab.c("E41_Appellation"))),
        R.term(node, vocab.c("P2_has_type"), F.lit(vocab.kind("path"))),
        R.term(node, vocab.label, F.col("path"), "literal"),
    ])


def item_paths(links: DataFrame, labels: DataFrame, items: DataFrame | None = None, acyclic: bool = False) -> DataFrame:
    """(s, item_label): distinct labels of an item and all nodes above it, the farthest first.

    The list of one item is as long as its chain of ancestors. With `items`, only these walk up; items that no link
    names have themselves alone.
    """
    counts = H.way_counts(R.closure(links, acyclic=acyclic) if items is None else H.ancestors_of(links, items), links)
    named = counts.join(labels.select(F.col("node").alias("o"), "label"), "o")
    # a label met twice counts once, at its farthest place
    far = named.groupBy("s", "label").agg(F.max("n").alias("n"))
    return far.groupBy("s").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("label")))), lambda x: x["label"]),
        ", ").alias("item_label"))


def class_labels(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(node, label) of labelled nodes, the acronym first."""
    own = R.literals(triples, vocab.label, "node", "own").select("node", "own").distinct()
    acronym = R.appellations(triples, ["acronym"], vocab, strict=True).select(F.col("item").alias("node"), F.col("label").alias("acr"))
    return own.join(acronym, "node", "left").select("node", F.coalesce("acr", "own").alias("label")).distinct()


def full_path(triples: DataFrame, items: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(s, full_path) for many (s, medium, medium_title): item path, medium name and medium title.

    The medium is named by its abbreviation, else its Italian label; without a
    medium label there is no path.
    """
    links = R.edges(triples, vocab.c("P46i_forms_part_of"))
    paths = item_paths(links, class_labels(triples, vocab), items)
    abbr = R.appellations(triples, ["abbreviation"], vocab, strict=True).select(F.col("item").alias("medium"), F.col("label").alias("abbr"))
    italian = R.literals(triples, vocab.label, "medium", "medium_label").filter(F.col("lang") == "it").select("medium", "medium_label")
    title = R.literals(triples, vocab.label, "medium_title", "title").select("medium_title", "title")
    rows = items.join(paths, "s").join(italian, "medium").join(abbr, "medium", "left").join(title, "medium_title", "left")
    return rows.select("s", F.concat("item_label", F.lit(", "), F.coalesce("abbr", "medium_label"), F.lit(" "), "title").alias("full_path"))


def list_sources(triples: DataFrame, subjects: DataFrame | None = None, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, appellation, label, location, medium, medium_name) of primary sources."""
    rows = R.instances(triples, vocab.rdf_type, vocab.onto("Source_Primary"), "subject")
    if subjects is not None:
        rows = rows.join(subjects.select("subject").distinct(), "subject", "left_semi")
    rows = rows.join(R.edges(triples, vocab.c("P1_is_identified_by"), "subject", "appellation"), "subject")
    at = R.edges(triples, vocab.c("P53_has_former_or_current_location"), "subject", "place")
    for out, kind in [("location", vocab.full_path), ("medium", vocab.kind("medium")), ("medium_name", vocab.kind("location_name"))]:
        typed = R.instances(triples, vocab.c("P2_has_type"), kind, "place")
        rows = R.optional(rows, at.join(typed, "place", "left_semi").select("subject", F.col("place").alias(out)), "subject")
    titles = R.appellations(triples, ["attributed_title"], vocab, strict=True).select(F.col("node").alias("appellation"), "label").distinct()
    return R.optional(rows, titles, "appellation").select(
        "subject", "appellation", "label", "location", "medium", "medium_name").distinct()


def carrier_abbreviation(triples: DataFrame, subjects: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, carrier_type, abbreviation, type_label), NULL where a subject has none."""
    carriers = R.edges(triples, vocab.c("P53_has_former_or_current_location"), "subject", "carrier_type").join(
        R.instances(triples, vocab.c("P2_has_type"), vocab.carrier_types, "carrier_type"), "carrier_type", "left_semi")
    names = R.appellations(triples, ["abbreviation"], vocab).select(
        F.col("item").alias("carrier_type"), F.col("node").alias("abbreviation"), F.col("label").alias("type_label"))
    return R.optional(subjects.select("subject").distinct(), carriers.join(names, "carrier_type"), "subject").select(
        "subject", "carrier_type", "abbreviation", "type_label").distinct()
