"""Source label -> (start, end) years, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronogeo.schema import OPEN_END, TODAY_START


def _run(text: Column, pattern: str, group: int = 1) -> Column:
    """First regex match as int, NULL when there is none."""
    return F.regexp_extract(text, pattern, group).try_cast("int")


def _span(start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))


def _same_century(start: Column, two_digits: Column) -> Column:
    return start - start % 100 + two_digits


def _default() -> Column:
    return _span(F.lit(TODAY_START), F.lit(OPEN_END))


def parse_years_strict(label: Column) -> Column:
    """Years written before the first colon; only there can a dash make a range."""
    head = F.trim(F.substring_index(label, ":", 1))
    pieces = F.split(head, "-")
    left, right = F.get(pieces, F.lit(0)), F.get(pieces, F.lit(1))
    start = _run(left, r"(\d{4})")
    digits = F.regexp_extract(right, r"(\d+)", 1)
    end = (
        F.when(_run(right, r"(\d{4})").isNotNull(), _run(right, r"(\d{4})"))
        .when(F.length(digits) == 2, _same_century(start, digits.try_cast("int")))
        .otherwise(F.coalesce(digits.try_cast("int"), start))
    )
    head_year, any_year = _run(head, r"(\d{4})"), _run(label, r"(\d{4})")
    colon, dash = label.contains(":"), head.contains("-")
    return (
        F.when(F.lower(label) == "today", _default())
        .when(colon & dash & start.isNotNull(), _span(start, end))
        .when(colon & ~dash & head_year.isNotNull(), _span(head_year, head_year))
        .when(any_year.isNotNull(), _span(any_year, any_year))
        .otherwise(_default())
    )


def parse_years_range(label: Column) -> Column:
    """A `YYYY-YY` or `YYYY-YYYY` range anywhere in the label wins over the first year."""
    pattern = r"(\d{4})-(\d{2,4})"
    start, tail = _run(label, pattern, 1), F.regexp_extract(label, pattern, 2)
    end = F.when(F.length(tail) == 2, _same_century(start, tail.try_cast("int"))).otherwise(tail.try_cast("int"))
    year = _run(label, r"(\d{4})")
    return (
        F.when(F.lower(label) == "today", _default())
        .when(start.isNotNull(), _span(start, end))
        .when(year.isNotNull(), _span(year, year))
        .otherwise(_default())
    )


PARSERS = {"strict": parse_years_strict, "range": parse_years_range}
