"""Periods, flags, labels and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from checks.registry import check
from checks.views import RANGE_END, RANGE_START, YEARS, c, table, with_views
from chronogeo.functions import text as X
from chronogeo.functions.years import parse_years_range, parse_years_strict
from chronogeo.operators import features as M
from chronogeo.operators import periods as P
from chronogeo.plans import export as E
from chronogeo.sources import readers

_FLAGS_SQL = ", ".join(f"CASE WHEN period = '{y}' THEN 1 ELSE 0 END AS y{y}" for y in YEARS)
_OR_SQL = ", ".join(f"bool_or(period = '{y}') AS y{y}" for y in YEARS)
_FLAGS = {f"y{y}": y for y in YEARS}

CONTRACT = T.StructType([
    T.StructField("identifier", T.StringType()), T.StructField("period", T.StringType()),
    T.StructField("geometry", T.StringType()), T.StructField("height", T.DoubleType())])


@check(with_views("periods") + " SELECT DISTINCT identifier, period, geometry FROM periods")
def union_periods(spark, sf):
    rows = v.periods(spark, sf)
    kinds = [rows.filter(c("flag") == f).select("identifier", "period", "geometry") for f in ("A", "N", "R")]
    return P.union_periods(kinds)


@check("""SELECT DISTINCT * FROM (
 SELECT 'O_' || o_custkey AS identifier, 'orders' AS period, o_orderstatus AS geometry, CAST(o_totalprice AS DOUBLE) AS height FROM orders
 UNION ALL SELECT 'P_' || p_partkey, 'parts', p_type, CAST(p_size AS DOUBLE) FROM part
 UNION ALL SELECT 'C_' || c_custkey, 'customers', c_mktsegment, NULL FROM customer)""")
def union_drifted(spark, sf):
    """Tables with other names, types and missing columns, under one contract."""
    tables = [
        table(spark, sf, "orders").select(v.txt("O_", c("o_custkey")).alias("BW_ID"), c("o_orderstatus").alias("geom"), c("o_totalprice").cast("string").alias("height")),
        table(spark, sf, "part").select(v.txt("P_", c("p_partkey")).alias("bw_id"), c("p_type").alias("geometry"), c("p_size").alias("height")),
        table(spark, sf, "customer").select(v.txt("C_", c("c_custkey")).alias("identifier"), c("c_mktsegment").alias("geometry")),
    ]
    aliases = [{"BW_ID": "identifier", "geom": "geometry"}, {"bw_id": "identifier"}, {}]
    return P.union_periods([
        P.tag_period(P.apply_contract(t, CONTRACT, a), n)
        for t, a, n in zip(tables, aliases, ("orders", "parts", "customers"))])


@check("""SELECT identifier, geometry FROM (SELECT 'S_' || s_suppkey AS identifier, 'N' || s_nationkey AS geometry FROM supplier
 UNION SELECT 'C_' || c_custkey, 'N' || c_nationkey FROM customer UNION SELECT 'S_' || l_suppkey, 'P' || l_partkey FROM lineitem)""")
def merge_kinds(spark, sf):
    s, cu, li = (table(spark, sf, t) for t in ("supplier", "customer", "lineitem"))
    return P.merge_kinds([
        s.select(v.txt("S_", c("s_suppkey")).alias("identifier"), v.txt("N", c("s_nationkey")).alias("geometry")),
        cu.select(v.txt("C_", c("c_custkey")).alias("identifier"), v.txt("N", c("c_nationkey")).alias("geometry")),
        li.select(v.txt("S_", c("l_suppkey")).alias("identifier"), v.txt("P", c("l_partkey")).alias("geometry")),
    ])


@check(with_views("periods") + f" SELECT DISTINCT identifier, geometry, {_FLAGS_SQL} FROM periods")
def presence_flags(spark, sf):
    return P.presence_flags(v.periods(spark, sf), "period", _FLAGS, ["identifier", "geometry"])


@check(with_views("periods") + f" SELECT identifier, geometry, {_OR_SQL} FROM periods GROUP BY identifier, geometry")
def collapse_flags(spark, sf):
    flags = v.periods(spark, sf).select("identifier", "geometry", *[(c("period") == y).alias(f"y{y}") for y in YEARS])
    return P.collapse_flags(flags, ["identifier", "geometry"])


def _object_flags(spark, sf):
    flags = v.periods(spark, sf).select("identifier", *[(c("period") == y).alias(f"y{y}") for y in YEARS])
    return P.collapse_flags(flags, ["identifier"])


_OBJ = f", obj AS (SELECT identifier, {_OR_SQL} FROM periods GROUP BY identifier)"


@check(with_views("periods") + _OBJ + " SELECT identifier, y2001 OR y2000 AS today, y1995 AS ortofoto, false AS never FROM obj")
def relabel_flags(spark, sf):
    mapping = {"today": ["y2001", "y2000"], "ortofoto": ["y1995"], "never": ["y1500"]}
    return P.relabel_flags(_object_flags(spark, sf), mapping, ["identifier"])


_NEWEST = " ".join(f"WHEN y{y} THEN 'y{y}'" for y in reversed(YEARS[4:]))


@check(with_views("periods") + _OBJ + f" SELECT identifier, CASE {_NEWEST} END AS source FROM obj")
def latest_source(spark, sf):
    order = [f"y{y}" for y in reversed(YEARS[4:])]
    return P.latest_source(_object_flags(spark, sf), order).select("identifier", "source")


@check(with_views("periods") + _OBJ + " SELECT identifier, y1995, false AS y1789 FROM obj")
def default_flags(spark, sf):
    return P.fill_missing_flags(_object_flags(spark, sf).select("identifier", "y1995"), ["y1995", "y1789"])


@check(with_views("periods") + _OBJ + " " + " UNION ALL ".join(
    f"SELECT identifier, 'y{y}' AS source, y{y} AS present FROM obj" for y in YEARS))
def flags_to_long(spark, sf):
    return P.to_long(_object_flags(spark, sf), ["identifier"])


@check(with_views("layer") + """ SELECT identifier, coalesce(bool_or(source = 'Today' AND present), false) AS today,
 coalesce(bool_or(source = '1995: O' AND present), false) AS y1995 FROM layer GROUP BY identifier""")
def long_to_wide(spark, sf):
    wide = P.to_wide(v.plain_layer(spark, sf), ["identifier"], ["Today", "1995: O"])
    return wide.select("identifier", c("Today").alias("today"), P.named("1995: O").alias("y1995"))


@check(with_views("periods") + _OBJ + " " + " UNION ALL ".join(
    f"SELECT 'y{y}' AS source, CAST(count(*) FILTER (WHERE y{y}) AS BIGINT) AS n_true FROM obj" for y in YEARS))
def flag_audit(spark, sf):
    return E.flag_audit(_object_flags(spark, sf))


@check("""SELECT DISTINCT coalesce(CASE WHEN c_acctbal >= 0 THEN 'C_' || c_custkey END,
 left(h, 8) || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32]) AS identifier, c_mktsegment AS geometry
 FROM (SELECT *, sha256(c_custkey || chr(31) || c_mktsegment) AS h FROM customer)""")
def fill_identifier(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", c("c_mktsegment").alias("geometry"), F.when(c("c_acctbal") >= 0, v.txt("C_", c("c_custkey"))).alias("BW_ID"))
    return P.fill_identifier(rows, "BW_ID", ["c_custkey", "geometry"]).select("identifier", "geometry").distinct()


@check("SELECT o_orderkey, 'SS_BLDG_' || (57 + row_number() OVER (ORDER BY o_orderdate, o_orderkey)) AS identifier FROM orders")
def sequence_ids(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return P.assign_sequence_ids(rows, "SS_BLDG_", 58, ["o_orderdate", "o_orderkey"], partitions=8).select("o_orderkey", "identifier")


@check(with_views("labels") + """ SELECT o_orderkey, label,
 CASE WHEN lower(label) = 'today' THEN 2000 WHEN regexp_matches(label, '[0-9]{4}') THEN CAST(regexp_extract(label, '([0-9]{4})', 1) AS INT) ELSE 2000 END AS start_year,
 CASE WHEN lower(label) = 'today' THEN 40000
  WHEN contains(label, ':') AND regexp_matches(split_part(label, ':', 1), '^[0-9]{4}-[0-9]{2}$')
   THEN CAST(left(label, 2) || regexp_extract(label, '-([0-9]{2})', 1) AS INT)
  WHEN contains(label, ':') AND regexp_matches(split_part(label, ':', 1), '^[0-9]{4}-[0-9]$') THEN CAST(regexp_extract(label, '-([0-9])', 1) AS INT)
  WHEN regexp_matches(label, '[0-9]{4}') THEN CAST(regexp_extract(label, '([0-9]{4})', 1) AS INT) ELSE 40000 END AS end_year FROM labels""")
def parse_years_before_colon(spark, sf):
    s = parse_years_strict(c("label"))
    return v.labels(spark, sf).withColumn("s", s).select("o_orderkey", "label", c("s.start").alias("start_year"), c("s.end").alias("end_year"))


@check(with_views("labels") + f" SELECT o_orderkey, label, {RANGE_START.format(c='label')} AS start_year, {RANGE_END.format(c='label')} AS end_year FROM labels")
def parse_years_anywhere(spark, sf):
    s = parse_years_range(c("label"))
    return v.labels(spark, sf).withColumn("s", s).select("o_orderkey", "label", c("s.start").alias("start_year"), c("s.end").alias("end_year"))


@check(with_views("labels") + " SELECT o_orderkey, lower(replace(replace(replace(label, ' ', '_'), ':', '_'), '-', '_')) AS slug FROM labels")
def slug(spark, sf):
    return v.labels(spark, sf).select("o_orderkey", X.slug(c("label")).alias("slug"))


@check("""SELECT doc_id, CASE WHEN t = '' THEN 'Unknown' ELSE t END AS clean FROM (
 SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^a-zA-Z''\\s\\p{Z}]', '', 'g'), '[\\s\\p{Z}]+', ' ', 'g')) AS t FROM documents)""")
def sanitize_label(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.sanitize_label(c("text")).alias("clean"))


@check(with_views("layer") + " SELECT DISTINCT identifier, split_part(identifier, '.', 1) AS base_id FROM layer")
def base_identifier(spark, sf):
    return v.plain_layer(spark, sf).select("identifier", X.base_identifier(c("identifier")).alias("base_id")).distinct()


@check("SELECT page_id, regexp_replace(url, '^.*/', '') AS tail, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages")
def iri_parts(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.last_segment(c("url")).alias("tail"), X.str_after(c("url"), "://").alias("rest"))


@check("""SELECT c_custkey, c_name || CASE WHEN c_acctbal < 0 THEN ' ' || c_mktsegment ELSE '' END || CASE WHEN c_nationkey > 10 THEN ' N' || c_nationkey ELSE '' END AS label
 FROM customer""")
def concat_bound(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.concat_bound(
        c("c_name"), F.when(c("c_acctbal") < 0, c("c_mktsegment")), F.when(c("c_nationkey") > 10, v.txt("N", c("c_nationkey")))).alias("label"))


@check("SELECT doc_id, lang FROM documents WHERE lang = 'it' OR lang = 'en' OR lang LIKE 'en-%'")
def language_match(spark, sf):
    return table(spark, sf, "documents").filter((c("lang") == "it") | X.lang_matches(c("lang"), "en")).select("doc_id", "lang")


@check("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
 year(o_orderdate) || '-01-01' AS begin_day, year(o_orderdate) || '-12-31' AS end_day FROM orders""")
def date_texts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.when(
        c("o_orderstatus") == "P", "").otherwise(c("o_orderdate").cast("date").cast("string")).alias("d"))
    return o.select("o_orderkey", X.blank_to_date(c("d")).alias("day"), X.phase_begin(c("y")).alias("begin_day"), X.phase_end(c("y")).alias("end_day"))


@check("""SELECT DISTINCT 'O_' || o_custkey AS identifier, CAST(NULL AS DATE) AS start_bob, CAST(o_orderdate AS DATE) AS start_eob,
 CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS DATE) END AS end_boe, CAST(NULL AS DATE) AS end_eoe,
 o_orderpriority AS geometry, 'Open Spaces' AS t, 2 AS z FROM orders""")
def openspaces_legacy(spark, sf):
    day = c("o_orderdate").cast("date")
    rows = table(spark, sf, "orders").select(
        c("o_orderkey").alias("id"), c("o_orderpriority").alias("geometry"), v.txt("O_", c("o_custkey")).alias("BW_ID"), F.year("o_orderdate").alias("Date"),
        day.cast("string").alias("Start"), F.when(c("o_orderstatus") == "O", "").otherwise(F.date_add(day, 30).cast("string")).alias("End"), "o_orderstatus")
    return E.openspaces_legacy([rows.filter("o_orderstatus = 'O'"), rows.filter("o_orderstatus <> 'O'")])


@check("""WITH p AS (SELECT CASE WHEN l_linestatus = 'F' THEN 'L_' || l_partkey END AS bw, 'S_' || l_suppkey AS geometry, CAST(year(l_shipdate) AS VARCHAR) AS d, l_orderkey AS id FROM lineitem),
 u AS (SELECT DISTINCT * FROM p), h AS (SELECT *, sha256(id || chr(31) || geometry || chr(31) || coalesce(bw, chr(0)) || chr(31) || d) AS h FROM u)
 SELECT DISTINCT coalesce(bw, left(h, 8) || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32]) AS identifier, geometry,
 CASE WHEN d = '2001' THEN 1 ELSE 0 END AS y2019, CASE WHEN d = '1995' THEN 1 ELSE 0 END AS y1982 FROM h""")
def export_site(spark, sf):
    """One site: union of yearly tables, filled ids, 0/1 flags."""
    rows = table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("id"), v.txt("S_", c("l_suppkey")).alias("geom"),
        F.when(c("l_linestatus") == "F", v.txt("L_", c("l_partkey"))).alias("bw_id"), F.year("l_shipdate").cast("string").alias("bob"), "l_returnflag")
    config = E.SiteExport("s", "buildings", {"y2019": "2001", "y1982": "1995"}, {"geom": "geometry", "bw_id": "BW_ID", "bob": "Date"})
    return E.export_site([rows.filter(c("l_returnflag") == f).drop("l_returnflag") for f in "ANR"], config, E.CONTRACT)


@check(with_views("periods") + """, m AS (SELECT * FROM (VALUES ('A', '2001', 'Today'), ('A', '2000', 'Today'), ('N', '1995', '1982: Ortofoto'), ('R', '1995', '1982: Ortofoto')) t(flag, period, source))
 SELECT DISTINCT 's' AS site, flag AS kind, identifier, geometry, source, true AS present FROM periods JOIN m USING (flag, period)""")
def import_layers(spark, sf):
    mapping = spark.createDataFrame(
        [("s", "A", "2001", "Today"), ("s", "A", "2000", "Today"), ("s", "N", "1995", "1982: Ortofoto"), ("s", "R", "1995", "1982: Ortofoto")],
        "site string, kind string, period string, source string")
    rows = v.periods(spark, sf).select(F.lit("s").alias("site"), c("flag").alias("kind"), "identifier", "geometry", "period")
    return E.import_layers_long(rows, mapping)


@check("""SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer JOIN nation ON c_nationkey = n_nationkey
 WHERE c_custkey = o.o_custkey AND c_acctbal < 0)""")
def drop_listed_rows(spark, sf):
    bad = table(spark, sf, "customer").filter("c_acctbal < 0").select(c("c_custkey").alias("o_custkey"))
    return P.drop_pairs(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), bad, ["o_custkey"])


@check(with_views("layer") + """ SELECT DISTINCT identifier, kind, CASE kind WHEN 'buildings' THEN 'Buildings' WHEN 'islands' THEN 'Island'
 WHEN 'openspaces' THEN 'Open Space' WHEN 'waterways' THEN 'Water way' END AS t, CASE kind WHEN 'islands' THEN 0 WHEN 'waterways' THEN -1 ELSE 1 END AS z FROM layer""")
def kind_values(spark, sf):
    lay = v.plain_layer(spark, sf)
    return lay.select("identifier", "kind", M.kind_value(c("kind"), "t").alias("t"), M.kind_value(c("kind"), "z").alias("z")).distinct()


@check(with_views("layer") + " SELECT DISTINCT identifier, site AS site, kind AS kind FROM layer")
def layer_names(spark, sf):
    """Site and kind read back from a layer name."""
    name = F.concat(F.lit("qgis_"), c("site"), F.lit("_"), F.when(c("kind") == "openspaces", "open_spaces").otherwise(c("kind")))
    site, kind = readers.split_layer_name(c("layer_name"))
    return v.plain_layer(spark, sf).select("identifier", name.alias("layer_name")).distinct().select("identifier", site.alias("site"), kind.alias("kind"))
