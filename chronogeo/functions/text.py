"""Small text and id column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(label: Column) -> Column:
    return F.lower(F.translate(label, " :-", "___"))


def sanitize_label(label: Column) -> Column:
    """Letters, apostrophes and single spaces; `Unknown` when nothing is left."""
    letters = F.regexp_replace(label, r"(?U)[^a-zA-Z'\s]", "")
    clean = F.trim(F.regexp_replace(letters, r"(?U)\s+", " "))
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("Unknown"))


def base_identifier(identifier: Column) -> Column:
    return F.substring_index(identifier, ".", 1)


def blank_to_date(text: Column) -> Column:
    """'' and unreadable dates become NULL."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("date")


def phase_begin(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-01-01"))


def phase_end(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-12-31"))


def concat_bound(first: Column, *rest: Column, sep: str = " ") -> Column:
    """`first` (blank when NULL), then each bound part with the separator in front."""
    parts = [F.coalesce(first, F.lit(""))]
    parts += [F.coalesce(F.concat(F.lit(sep), part), F.lit("")) for part in rest]
    return F.concat(*parts)


def str_after(text: Column, mark: str) -> Column:
    """Text behind the first `mark`, '' when it does not occur."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substring(text, at + len(mark), F.length(text))).otherwise(F.lit(""))


def last_segment(iri: Column) -> Column:
    return F.regexp_replace(iri, r"^.*/", "")


def lang_matches(lang: Column, wanted: str) -> Column:
    """Basic language range: the tag itself or a sub-tag of it, any case."""
    low = F.lower(lang)
    return (low == wanted) | low.startswith(wanted + "-")


def stable_uuid(*key: Column) -> Column:
    """UUID-shaped hash of the row key: the same row gets the same id on every attempt."""
    text = F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in key])
    h = F.sha2(text, 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, pos, length) for pos, length in cuts])


def mint_iri(base: Column, suffix: str, *key: Column) -> Column:
    """`base/suffix`, followed by a stable uuid of `key` when one is given."""
    parts = [base, F.lit("/" + suffix)]
    if key:
        parts += [F.lit("/"), stable_uuid(*key)]
    return F.concat(*parts)


def first_true(flags: list[tuple[str, Column]]) -> Column:
    """Name of the first true flag in the given order, NULL when all are false."""
    return F.coalesce(*[F.when(flag, F.lit(name)) for name, flag in flags])


def any_true(flags: list[Column]) -> Column:
    """NULL-safe OR."""
    return reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags])
