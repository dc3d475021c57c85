"""Form records and their creation and modification events, from provenance graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.functions import text as X
from chronogeo.operators import graph as R
from chronogeo.schema import VOCAB, Vocabulary

GRAPH_SUFFIX = "/container/context"
RECORD_SUFFIX = "entity_form_record"


def _subjects(triples: DataFrame, vocab: Vocabulary) -> DataFrame:
    return R.instances(triples, vocab.rdf_type, vocab.onto("Source_Primary"), "subject")


def _record_type(vocab: Vocabulary, tail: str = "") -> str:
    return vocab.record_types + "entity_form_record" + tail


def prov_entities(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, entity) of the provenance graphs; the subject is read off the graph name."""
    rows = triples.filter(
        (F.col("p") == vocab.rdf_type) & (F.col("o") == vocab.prov + "Entity") & F.col("g").endswith(GRAPH_SUFFIX))
    cut_at = F.length("g") - len(GRAPH_SUFFIX)
    return rows.select(F.substring(F.col("g"), F.lit(1), cut_at).alias("subject"), F.col("s").alias("entity")).distinct()


def _prov_values(triples: DataFrame, name: str, out: str, vocab: Vocabulary) -> DataFrame:
    rows = triples.filter((F.col("p") == vocab.prov + name) & F.col("g").endswith(GRAPH_SUFFIX))
    cut_at = F.length("g") - len(GRAPH_SUFFIX)
    return rows.select(F.substring(F.col("g"), F.lit(1), cut_at).alias("subject"), F.col("s").alias("entity"), F.col("o").alias(out))


def form_records(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, record) for subjects that have provenance but no record."""
    with_prov = prov_entities(triples, vocab).select("subject").distinct()
    typed = R.instances(triples, vocab.c("P2_has_type"), _record_type(vocab), "record")
    recorded = R.edges(triples, vocab.c("P129i_is_subject_of"), "subject", "record").join(typed, "record", "left_semi")
    rows = R.missing(_subjects(triples, vocab).join(with_prov, "subject", "left_semi"), recorded.select("subject"), "subject")
    return rows.withColumn("record", X.mint_iri(F.col("subject"), RECORD_SUFFIX))


def record_triples(records: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    s, r = F.col("subject"), F.col("record")
    return R.construct(records, [
        R.term(s, vocab.c("P129i_is_subject_of"), r),
        R.term(r, vocab.rdf_type, F.lit(vocab.crmdig + "D1_Digital_Machine")),
        R.term(r, vocab.rdf_type, F.lit(vocab.crmdig + "D1_Digital_Object")),
        R.term(r, vocab.c("P2_has_type"), F.lit(_record_type(vocab))),
        R.term(r, vocab.c("P129_is_about"), s),
    ])


def proper_records(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, record) of primary sources with a well-formed record under the expected IRI."""
    typed = R.instances(triples, vocab.c("P2_has_type"), _record_type(vocab), "record").join(
        R.instances(triples, vocab.rdf_type, vocab.crmdig + "D1_Digital_Object", "record"), "record", "left_semi")
    links = R.edges(triples, vocab.c("P129i_is_subject_of"), "subject", "record").filter(
        F.col("record") == X.mint_iri(F.col("subject"), RECORD_SUFFIX))
    return links.join(typed, "record", "left_semi").join(_subjects(triples, vocab), "subject", "left_semi").distinct()


def recorded_events(triples: DataFrame, tail: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(record, event) of one event type."""
    typed = R.instances(triples, vocab.c("P2_has_type"), _record_type(vocab, tail), "event")
    return R.edges(triples, vocab.crmdig + "L11i_was_output_of", "record", "event").join(typed, "event", "left_semi")


def modification_events(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, record, entity, actor, at): one event per provenance row not imported yet."""
    facts = (
        prov_entities(triples, vocab)
        .join(_prov_values(triples, "generatedAtTime", "at", vocab), ["subject", "entity"])
        .join(_prov_values(triples, "wasAttributedTo", "actor", vocab), ["subject", "entity"])
        .join(proper_records(triples, vocab), "subject")
    )
    old = (
        recorded_events(triples, "_modification", vocab)
        .join(R.edges(triples, vocab.c("P14_carried_out_by"), "event", "actor"), "event")
        .join(R.edges(triples, vocab.c("P4_has_time-span"), "event", "span"), "event")
        .join(R.edges(triples, vocab.c("P82_at_some_time_within"), "span", "at"), "span")
        .select("record", "actor", "at")
    )
    return R.missing(facts, old, ["record", "actor", "at"]).select("subject", "record", "entity", "actor", "at").distinct()


def earliest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """All rows at the smallest `at` of their key, ties kept.

    Minima are combined before the shuffle and matched on (key, at), which also
    spreads the rows of a hot key.
    """
    first = rows.groupBy(key).agg(F.min(at).alias(at))
    return rows.join(first, [key, at], "left_semi")


def creation_events(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, record, entity, actor, at): actors at the earliest time of subjects without a creation event."""
    times = prov_entities(triples, vocab).join(_prov_values(triples, "generatedAtTime", "at", vocab), ["subject", "entity"])
    open_ = R.missing(proper_records(triples, vocab), recorded_events(triples, "_creation", vocab).select("record"), "record")
    return (
        earliest(times, "subject", "at")
        .join(_prov_values(triples, "wasAttributedTo", "actor", vocab), ["subject", "entity"])
        .join(open_, "subject").select("subject", "record", "entity", "actor", "at").distinct()
    )


def event_triples(events: DataFrame, tail: str, vocab: Vocabulary = VOCAB) -> DataFrame:
    """Eight triples per event; `tail` is `modification` or `creation`."""
    event = X.mint_iri(F.col("record"), f"entity_formRecord_{tail}", F.col("entity"), F.col("actor"), F.col("at"))
    rows = events.withColumn("_ev", event)
    rows = rows.withColumn("_ts", X.mint_iri(F.col("_ev"), "at_some_time_within", F.col("_ev")))
    r, ev, ts = F.col("record"), F.col("_ev"), F.col("_ts")
    return R.construct(rows, [
        R.term(r, vocab.crmdig + "L11i_was_output_of", ev),
        R.term(ev, vocab.rdf_type, F.lit(vocab.crmdig + "D7_Digital_Machine_Event")),
        R.term(ev, vocab.c("P2_has_type"), F.lit(_record_type(vocab, "_" + tail))),
        R.term(ev, vocab.c("P14_carried_out_by"), F.col("actor")),
        R.term(ev, vocab.c("P4_has_time-span"), ts),
        R.term(ev, vocab.crmdig + "L11_had_output", r),
        R.term(ts, vocab.rdf_type, F.lit(vocab.c("E52_Time-Span"))),
        R.term(ts, vocab.c("P82_at_some_time_within"), F.col("at"), "literal"),
    ], unique=True)


def verify_events(triples: DataFrame, vocab: Vocabulary = VOCAB) -> DataFrame:
    """(subject, record, ev_type, actor, at), newest first per subject."""
    typed = R.instances(triples, vocab.c("P2_has_type"), _record_type(vocab), "record").join(
        R.instances(triples, vocab.rdf_type, vocab.crmdig + "D1_Digital_Object", "record"), "record", "left_semi")
    machine = R.instances(triples, vocab.rdf_type, vocab.crmdig + "D7_Digital_Machine_Event", "event")
    return (
        R.edges(triples, vocab.c("P129i_is_subject_of"), "subject", "record")
        .join(_subjects(triples, vocab), "subject", "left_semi").join(typed, "record", "left_semi")
        .join(R.edges(triples, vocab.crmdig + "L11i_was_output_of", "record", "event"), "record")
        .join(machine, "event", "left_semi")
        .join(R.edges(triples, vocab.c("P2_has_type"), "event", "ev_type"), "event")
        .join(R.edges(triples, vocab.c("P14_carried_out_by"), "event", "actor"), "event")
        .join(R.edges(triples, vocab.c("P4_has_time-span"), "event", "span"), "event")
        .join(R.edges(triples, vocab.c("P82_at_some_time_within"), "span", "at"), "span")
        .select("subject", "record", "ev_type", "actor", "at")
        .orderBy("subject", F.col("at").desc())
    )
