"""Yearly tables to editable layers."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronogeo.functions.text import any_true, blank_to_date
from chronogeo.operators import periods as P


@dataclass(frozen=True)
class SiteExport:
    """How the yearly tables of one site and kind become flags.

    `flags` maps flag name -> period value to match, `aliases` renames drifted
    columns, `mapping` maps a source label -> the year flags behind it.
    """

    site: str
    kind: str
    flags: dict[str, str]
    aliases: dict[str, str] = field(default_factory=dict)
    mapping: dict[str, list[str]] = field(default_factory=dict)


def _same(*years: str) -> dict[str, str]:
    return {y: y for y in years}


# Flags and labels of the known sites. A site without labels is exported only.
_NOW, _1982 = {"Today": ["2019"]}, {"1982: Ortofoto": ["1982"]}
_SECONDO = {
    **_NOW, **_1982, "1943-45: RAF": ["1945"], "1850: Direzione genio militare": ["1852", "1850"],
    "1838-41: Censo Stabile, Mappe Austriache - rettifica": ["1839"], "1789": ["1789"], "1697": ["1697"],
}
_SECONDO_FLAGS = _same("1500", "1697", "1717", "1789", "1839", "1850", "1852", "1945", "1982", "2019")
SITES = [
    SiteExport("madonnadelmonte", "buildings", _same("2019"), {}, _NOW),
    SiteExport("madonnadelmonte", "islands", _same("1982", "2019"), {}, {**_NOW, **_1982}),
    SiteExport("sanclemente", "buildings", _same("2019", "1982"), {"geom": "geometry"}, {**_NOW, **_1982}),
    SiteExport("sanclemente", "islands", _same("1982", "2019"), {"geom": "geometry"}, {**_NOW, **_1982}),
    SiteExport("sanclemente", "openspaces", _same("2019"), {"geom": "geometry"}, _NOW),
    SiteExport("sangiorgioinalga", "buildings", _same("2023"), {"bw_id": "BW_ID"}, {"Today": ["2023"]}),
    SiteExport(
        "sangiorgioinalga", "islands", {"2023": "2010-01-01", "1982": "1982-01-01", "1931": "1931-01-01", "1944": "1944-11-09"},
        {"bob": "Date"}, {"Today": ["2023"], **_1982, "1943-45: RAF": ["1944"], "1931": ["1931"]}),
    SiteExport("sansecondo", "buildings", _SECONDO_FLAGS, {}, _SECONDO),
    SiteExport("sansecondo", "islands", _SECONDO_FLAGS, {}, _SECONDO),
    SiteExport("sanservolo", "buildings", _same("2019"), {}, _NOW),
    SiteExport("santospirito", "buildings", _same("2019")),
    SiteExport("santospirito", "islands", _same("1982", "2019", "1841")),
]

CONTRACT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("geometry", T.StringType()),
    T.StructField("BW_ID", T.StringType()), T.StructField("Date", T.StringType()),
])


def export_site(tables: list[DataFrame], config: SiteExport, contract: T.StructType) -> DataFrame:
    """(identifier, 0/1 flags, geometry) of one site and kind.

    Union without duplicates, stable ids for rows without one, flags per period. Rows are duplicates when they agree in all
    columns of the contract, so it names every column in which rows of the site may differ; `CONTRACT` has the least.
    """
    same = [P.apply_contract(t, contract, config.aliases) for t in tables]
    rows = P.union_periods(same)
    rows = P.fill_identifier(rows, "BW_ID", rows.columns)
    return P.presence_flags(rows, "Date", config.flags, ["identifier", "geometry"])


def import_layer(exported: DataFrame, mapping: dict[str, list[str]], collapse: bool = True) -> DataFrame:
    """Year flags to source flags; rows of one identifier and geometry are OR-ed into one."""
    layer = P.relabel_flags(exported, mapping, ["identifier", "geometry"])
    return P.collapse_flags(layer, ["identifier", "geometry"], list(mapping)) if collapse else layer


def import_layers_long(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """All sites at once, long form: (site, kind, identifier, geometry, period) joined with (site, kind, period, source).

    One row per true flag; the mapping is small, one row per source.
    """
    keys = ["site", "kind", "period"]
    return rows.join(mapping.select(*keys, "source"), keys).select(
        "site", "kind", "identifier", "geometry", "source", F.lit(True).alias("present")).distinct()


def openspaces_legacy(tables: list[DataFrame]) -> DataFrame:
    """Open spaces with four date bounds; blank dates are NULL."""
    columns = ["id", "geometry", "BW_ID", "Date", "Start", "End"]
    rows = P.union_periods(tables, columns)
    return rows.select(
        F.col("BW_ID").alias("identifier"),
        F.lit(None).cast("date").alias("start_bob"),
        blank_to_date(F.col("Start")).alias("start_eob"),
        blank_to_date(F.col("End")).alias("end_boe"),
        F.lit(None).cast("date").alias("end_eoe"),
        "geometry",
        F.lit("Open Spaces").alias("t"),
        F.lit(2).alias("z"),
    ).distinct()


def flag_audit(layer: DataFrame) -> DataFrame:
    """(source, n_true) per flag column; n_true 0 marks a flag no row can set."""
    return P.to_long(layer, ["identifier"]).groupBy("source").agg(F.count_if("present").alias("n_true"))


def unmapped_periods(exported: DataFrame, mapping: dict[str, list[str]], keep: tuple[str, ...] = ("identifier", "geometry")) -> list[str]:
    """Year flags no source label uses."""
    used = {y for years in mapping.values() for y in years}
    return [c for c in exported.columns if c not in keep and c not in used]


def any_flag(df: DataFrame, years: list[str]) -> DataFrame:
    """Rows with at least one of the year flags set."""
    return df.filter(any_true([P.named(y).cast("boolean") for y in years]))
