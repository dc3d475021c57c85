"""Readers: yearly tables, layers, tab files and triples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronogeo.functions import geometry as G
from chronogeo.operators import periods as P
from chronogeo.schema import ID_COLUMNS, META_COLUMNS, TRIPLES

KIND_ALIASES = {"open_spaces": "openspaces", "openspaces": "openspaces", "buildings": "buildings",
                "islands": "islands", "waterways": "waterways", "water_ways": "waterways"}


def read_periods(spark: SparkSession, paths: dict[str, str], contract: T.StructType,
                 aliases: dict[str, str] | None = None, fmt: str = "parquet", **options) -> list[DataFrame]:
    """One table per period under one column contract, tagged with its period."""
    return [
        P.tag_period(P.apply_contract(spark.read.format(fmt).options(**options).load(path), contract, aliases), period)
        for period, path in paths.items()]


def split_layer_name(name: Column, prefix: str = "qgis_") -> tuple[Column, Column]:
    """(site, kind) of `<prefix><site>_<kind>`; both spellings of open spaces are one kind."""
    pattern = rf"^(?:{prefix})?_*(.+?)_({'|'.join(KIND_ALIASES)})$"
    kind = F.element_at(F.create_map(*[F.lit(v) for kv in KIND_ALIASES.items() for v in kv]), F.regexp_extract(name, pattern, 2))
    return F.regexp_extract(name, pattern, 1), kind


def list_layers(spark: SparkSession, pattern: str = "qgis_*") -> list[str]:
    """Catalog tables whose name fits the pattern."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def layer_to_long(df: DataFrame, site: str, kind: str, srid: int = 3857) -> DataFrame:
    """Wide layer -> long form; an unknown id column raises, metadata columns are optional."""
    id_col = P.resolve_id_column(df)
    if id_col is None:
        raise ValueError(f"layer {site}_{kind} has no identifier column")
    flags = P.source_columns(df) or [c for c in P.source_columns(df, exclude=(*META_COLUMNS, id_col, "srid"))]
    flat = df.select(
        P.named(id_col).alias("identifier"),
        (F.col("name") if "name" in df.columns else F.lit(None)).cast("string").alias("name"),
        (F.col("srid") if "srid" in df.columns else F.lit(srid)).cast("int").alias("srid"),
        F.col("geometry").cast("string").alias("geometry"), *[P.named(f) for f in flags])
    return P.to_long(flat, ["identifier", "name", "srid", "geometry"], flags).select(
        F.lit(site).alias("site"), F.lit(kind).alias("kind"), "identifier", "name", "srid", "geometry", "source", "present")


def seed_layer_row(spark: SparkSession, site: str, kind: str, identifier: str, wkt: str, flags: dict[str, bool],
                   name: str | None = None) -> DataFrame:
    """Starter row of a new layer in long form; the SRID comes from the text, 3857 without one."""
    rows = [(site, kind, identifier, name, wkt, s, p) for s, p in flags.items()]
    df = spark.createDataFrame(rows, "site string, kind string, identifier string, name string, geometry string, source string, present boolean")
    srid = F.coalesce(F.nullif(G.wkt_srid(F.col("geometry")), F.lit(0)), F.lit(3857))
    return df.select("site", "kind", "identifier", "name", srid.alias("srid"), G.to_wkt(G.parse_wkt(F.col("geometry"))).alias("geometry"), "source", "present")


def union_layers(layers: dict[tuple[str, str], DataFrame], srid: int = 3857) -> DataFrame:
    """Long form of many wide layers whose flag columns differ."""
    return reduce(lambda a, b: a.unionByName(b), [layer_to_long(df, s, k, srid) for (s, k), df in layers.items()])


def read_layers(spark: SparkSession, root: str, sites: list[str] | None = None, prefix: str = "qgis_", srid: int = 3857,
                sources: list[str] | None = None) -> DataFrame:
    """Long form of all parquet layers under `root`, one folder per layer.

    One scan with merged schemas; site and kind come from the file path. Flags a
    layer does not have are NULL there and are left out. The identifier is the
    first known id column that the row fills. Boolean columns are flags; a column
    of whole numbers is one only if `sources` lists it, and any but 0 is true
    there. Other columns are metadata of the layer. An unset srid is `srid`.
    """
    df = spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(root)
    ids = [c for c in ID_COLUMNS if c in df.columns]
    if not ids:
        raise ValueError(f"no identifier column under {root}")
    flags = [f.name for f in df.schema if f.name not in (*META_COLUMNS, *ids, "srid") and (
        isinstance(f.dataType, T.BooleanType) or isinstance(f.dataType, T.IntegralType) and f.name in (sources or ()))]
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    site, kind = split_layer_name(folder, prefix)
    have = set(df.columns)
    meta = {"name": "string", "srid": "int", "geometry": "string"}
    given = {c: (F.col(c) if c in have else F.lit(None)).cast(t) for c, t in meta.items()}
    given["srid"] = F.coalesce(given["srid"], F.lit(srid))
    rows = df.select(
        site.alias("site"), kind.alias("kind"), F.coalesce(*[P.named(c).cast("string") for c in ids]).alias("identifier"),
        *[v.alias(c) for c, v in given.items()], *[P.named(f).cast("boolean").alias(f) for f in flags])
    if sites is not None:
        rows = rows.filter(F.col("site").isin(sites))
    keys = ["site", "kind", "identifier", *meta]
    return rows.unpivot([F.col(c) for c in keys], [P.named(f) for f in flags], "source", "present").filter("present is not null")


# Columns of a layer file that are never flags.
FILE_COLUMNS = (*META_COLUMNS, *ID_COLUMNS, "id", "srid")


def read_layer_tsv(spark: SparkSession, path: str, flags: list[str] | None = None, unreadable: str | None = None) -> DataFrame:
    """Tab file with header: flags as booleans, all other columns as text.

    Without a list, every column is a flag that is no known metadata column. A flag is 1, t, true or yes, or 0, f, false or
    no; an empty one is NULL, and so is any other text. `unreadable` names a column that counts such texts per row.
    """
    raw = spark.read.option("sep", "\t").option("header", "true").option("maxCharsPerColumn", "-1").csv(path)
    chosen = [c for c in raw.columns if (c not in FILE_COLUMNS if flags is None else c in flags)]
    value = lambda c: F.lower(F.trim(P.named(c)))
    read = {c: F.when(value(c).isin("1", "t", "true", "yes"), True).when(value(c).isin("0", "f", "false", "no"), False) for c in chosen}
    out = [read[c].alias(c) if c in read else P.named(c) for c in raw.columns]
    if unreadable:
        bad = [F.coalesce(read[c].isNull() & (F.trim(P.named(c)) != ""), F.lit(False)).cast("int") for c in chosen]
        out.append(reduce(lambda a, b: a + b, bad, F.lit(0)).alias(unreadable))
    return raw.select(*out)


_HEAD = r"^\s*(<[^>]*>|_:\S+)\s+(<[^>]*>)\s+"
_TAIL = r"^(?:@([A-Za-z0-9-]+)|\^\^<([^>]*)>)?\s*(<[^>]*>|_:\S+)?\s*\.\s*$"
_NODE = r"^(<[^>]*>|_:\S+)\s*(<[^>]*>|_:\S+)?\s*\.\s*$"


def parse_nquads(lines: DataFrame, column: str = "value") -> DataFrame:
    """N-Triples or N-Quads lines to triples; blank lines and comment lines are skipped.

    A literal ends at the last quote of its line, so no pattern has to walk
    through the text, however long it is.
    """
    line = F.col(column)

    def iri(text: Column) -> Column:
        return F.regexp_replace(text, r"^<|>$", "")

    def blank(text: Column) -> Column:
        return F.nullif(text, F.lit(""))

    raw = lines.filter(line.rlike(_HEAD)).select(
        iri(F.regexp_extract(line, _HEAD, 1)).alias("s"),
        iri(F.regexp_extract(line, _HEAD, 2)).alias("p"),
        F.regexp_replace(line, _HEAD, "").alias("_rest"))
    rest = F.col("_rest")
    literal = F.startswith(rest, F.lit('"'))
    last = F.length(rest) - F.instr(F.reverse(rest), '"') + 1
    parts = raw.select(
        "s", "p", literal.alias("_lit"),
        F.when(literal, F.substring(rest, F.lit(2), last - 2)).alias("_text"),
        F.when(literal, F.substring(rest, last + 1, F.length(rest))).otherwise(rest).alias("_tail"))
    # a marker keeps escaped backslashes apart while the other escapes are read
    plain = F.replace(F.col("_text"), F.lit("\\\\"), F.lit("\u0001"))
    for code, char in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        plain = F.replace(plain, F.lit(code), F.lit(char))
    plain = F.replace(plain, F.lit("\u0001"), F.lit("\\"))
    lit, tail = F.col("_lit"), F.col("_tail")
    good = F.when(lit, tail.rlike(_TAIL)).otherwise(tail.rlike(_NODE))
    return parts.filter(good).select(
        blank(iri(F.when(lit, F.regexp_extract(tail, _TAIL, 3)).otherwise(F.regexp_extract(tail, _NODE, 2)))).alias("g"),
        "s", "p",
        F.when(lit, plain).otherwise(iri(F.regexp_extract(tail, _NODE, 1))).alias("o"),
        F.when(lit, "literal").otherwise("iri").alias("o_type"),
        F.when(lit, blank(F.regexp_extract(tail, _TAIL, 1))).alias("lang"),
        F.when(lit, blank(F.regexp_extract(tail, _TAIL, 2))).alias("dtype"))


def read_nquads(spark: SparkSession, path: str) -> DataFrame:
    return parse_nquads(spark.read.text(path))


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """Triples stored as parquet partitioned by `p`: a pattern reads only its predicates."""
    return spark.read.schema(TRIPLES).parquet(path).select(*TRIPLES.fieldNames())
