"""Queries for the bare sources and for branches that need odd rows: other systems, open rings, unlisted sources, clashing terms."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from checks.geo_checks import _WKT
from checks.registry import check
from checks.stream_checks import _folder
from checks.views import c, table, with_views
from chronogeo.functions import ewkb as W
from chronogeo.functions import geometry as G
from chronogeo.operators import features as Fe
from chronogeo.operators import geo
from chronogeo.operators import graph as R
from chronogeo.operators import periods as P
from chronogeo.plans import export as E
from chronogeo.schema import META_COLUMNS
from chronogeo.sources import readers, writers
from chronogeo.streaming import propagate as S

# ---------------------------------------------------------------- bare sources


@check("""SELECT 'L_' || l_partkey AS "BW_ID", 'S_' || l_suppkey AS geometry, CAST(l_orderkey AS BIGINT) AS id, CAST(year(l_shipdate) AS VARCHAR) AS "Date" FROM lineitem""")
def period_files(spark, sf):
    """A table per ship year, one with a drifted column name, read under one contract."""
    root, rows, paths = _folder(spark), table(spark, sf, "lineitem"), {}
    years = rows.agg(F.min(F.year("l_shipdate")).alias("a"), F.max(F.year("l_shipdate")).alias("b")).first()
    for year in map(str, range(years["a"], years["b"] + 1)):
        paths[year] = f"{root}/{year}"
        (rows.filter(F.year("l_shipdate") == int(year)).select(
            c("l_orderkey").alias("id"), v.txt("S_", c("l_suppkey")).alias("geom" if year == "1995" else "geometry"),
            v.txt("L_", c("l_partkey")).alias("BW_ID")).write.parquet(paths[year]))
    contract = T.StructType([f for f in E.CONTRACT if f.name != "Date"])
    parts = readers.read_periods(spark, paths, contract, {"geom": "geometry"})
    out = reduce(lambda a, b: a.unionByName(b), parts)
    tag = next(x for x in out.columns if x not in contract.fieldNames())
    return out.withColumnRenamed(tag, "Date")


@check("""SELECT 'C_' || c_custkey AS identifier, f AS source, CASE f WHEN 'Today' THEN c_acctbal < 0 ELSE c_nationkey % 2 = 1 END AS present
 FROM customer, (VALUES ('Today'), ('1982: Ortofoto')) x(f)""")
def number_flags(spark, sf):
    """A layer keyed by BW_ID whose flags are whole numbers: every column but the metadata is a source."""
    wide = table(spark, sf, "customer").select(
        v.txt("C_", c("c_custkey")).alias("BW_ID"), F.lit("G").alias("geometry"), c("c_name").alias("name"),
        (c("c_acctbal") < 0).cast("int").alias("Today"), (c("c_nationkey") % 2).cast("int").alias("1982: Ortofoto"))
    path = _folder(spark)
    wide.write.parquet(f"{path}/qgis_south_buildings")
    flags = P.source_columns(wide, exclude=(*META_COLUMNS, P.resolve_id_column(wide)))
    return readers.read_layers(spark, path, sources=flags).select("identifier", "source", "present")


@check("SELECT c_custkey AS k, c_mktsegment AS a FROM customer")
def replaced_table(spark, sf):
    """A catalog table written twice: the second one replaces the first."""
    name = f"t_{uuid.uuid4().hex}"
    rows = table(spark, sf, "customer").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("a"))
    writers.materialise(rows.limit(0), name)
    return writers.materialise(rows, name)


@check("""SELECT 'U_' || user_id AS identifier, CASE WHEN event_type = 'signup' THEN 'inserted' WHEN event_type = 'click' THEN 'skipped' ELSE 'error' END AS outcome,
 count(*) AS n FROM events GROUP BY ALL""")
def outcome_folders(spark, sf):
    """Outcomes in one folder each, read back with the outcome from the folder."""
    kind = F.when(c("event_type") == "signup", "inserted").when(c("event_type") == "click", "skipped").otherwise("error")
    path = _folder(spark)
    writers.write_outcomes(table(spark, sf, "events").select(v.txt("U_", c("user_id")).alias("identifier"), kind.alias("outcome")), path)
    return spark.read.schema("identifier string, outcome string").json(path).groupBy("identifier", "outcome").agg(F.count("*").alias("n"))


@check(with_views("poly") + f" SELECT identifier, {_WKT} AS wkt, srid FROM poly")
def ewkb_tab_file(spark, sf):
    """Layers as tab files with hex geometry and 0/1 flags, read back."""
    path = _folder(spark)
    rows = v.shapes(spark, sf).select("identifier", W.encode_ewkb(c("geom"), c("srid")).alias("geometry"), (c("srid") == 3857).alias("Today"))
    writers.write_layer_tsv(rows, path)
    back = readers.read_layer_tsv(spark, path)
    return back.select(c("identifier").cast("long").alias("identifier"), G.to_wkt(W.decode_ewkb(c("geometry"))).alias("wkt"), W.ewkb_srid(c("geometry")).alias("srid"))


_SITE = next(s for s in E.SITES if s.site == "sansecondo" and s.kind == "buildings")
_YEAR_OF = " ".join(f"WHEN {i} THEN '{y}'" for i, y in enumerate(_SITE.flags))


@check(f"""WITH r AS (SELECT 'P_' || l_partkey AS identifier, CASE l_suppkey % {len(_SITE.flags)} {_YEAR_OF} END AS y FROM lineitem)
 SELECT r.identifier, m.source, bool_or(list_contains(m.years, y)) AS present FROM r, (VALUES
 {', '.join("('" + s + "', [" + ', '.join(f"'{y}'" for y in ys) + "])" for s, ys in _SITE.mapping.items())}) m(source, years) GROUP BY ALL""")
def import_site(spark, sf):
    """A known site: yearly rows to year flags, year flags to source flags, one row per object."""
    year = F.element_at(F.array(*[F.lit(y) for y in _SITE.flags]), (c("l_suppkey") % len(_SITE.flags) + 1).cast("int"))
    rows = table(spark, sf, "lineitem").select(
        c("l_orderkey").cast("long").alias("id"), F.lit("G").alias("geometry"), v.txt("P_", c("l_partkey")).alias("BW_ID"), year.alias("Date"))
    layer = E.import_layer(E.export_site([rows], _SITE, E.CONTRACT), _SITE.mapping)
    return P.to_long(layer, ["identifier"], list(_SITE.mapping)).select("identifier", "source", c("present").cast("boolean").alias("present"))


# ---------------------------------------------------------------- projection and rings



def _mixed(spark, sf):
    """The boxes in 3857, 4326 and 32633, a third each, and every seventh row in a system that is not known."""
    k = c("identifier")
    g = v.shapes(spark, sf)
    there = F.when(k % 3 == 1, G.to_wkt(G.transform(c("geom"), 3857, 4326))).when(k % 3 == 2, G.to_wkt(G.transform(c("geom"), 3857, 32633))).otherwise(c("geometry"))
    srid = F.when(k % 7 == 0, 25832).when(k % 3 == 1, 4326).when(k % 3 == 2, 32633).otherwise(3857)
    return g.select(v.txt("B_", k).alias("identifier"), there.alias("geometry"), srid.alias("srid"))


@check(with_views("poly_m") + """ SELECT 'B_' || identifier AS identifier, CASE WHEN identifier % 7 <> 0 THEN round(CAST(area AS DOUBLE), 2) END AS area,
 CASE WHEN identifier % 7 <> 0 THEN round(CAST(min_x AS DOUBLE), 3) END AS min_x, CASE WHEN identifier % 7 <> 0 THEN round(CAST(min_y AS DOUBLE), 3) END AS min_y FROM poly_m""")
def publish_mixed_systems(spark, sf):
    """Every known system is published in 3857; a row of an unknown one has no geometry."""
    rows = _mixed(spark, sf).select(F.lit("buildings").alias("kind"), "identifier", c("identifier").alias("name"), "srid", "geometry")
    old = rows.limit(0).select("identifier", c("kind").alias("t"), F.lit(1).alias("z"), "name", "geometry")
    out = Fe.publish_features(rows, old).table.withColumn("geom", G.parse_wkt(c("geometry")))
    box = geo.with_measures(out)
    first = F.flatten(F.flatten("geom"))
    return box.select("identifier", (F.round("area", 2) + 0.0).alias("area"),
                      (F.round(F.array_min(F.transform(first, lambda p: p["x"])), 3) + 0.0).alias("min_x"),
                      (F.round(F.array_min(F.transform(first, lambda p: p["y"])), 3) + 0.0).alias("min_y"))


@check(with_views("poly") + " SELECT identifier, 'text' AS problem FROM poly WHERE st = 'O'")
def broken_texts(spark, sf):
    """Numbers cut off in the middle of a text: reported, and never another shape."""
    rows = v.polygons(spark, sf).withColumn("srid", F.lit(3857))
    holes = F.size(F.split("geometry", r"\)?,\(")) == 2
    bad = holes & ~c("geometry").contains("),(") | c("geometry").rlike(r"[0-9]\),\([0-9]")
    return geo.check_typed(rows.withColumn("geometry", F.when(bad, F.regexp_replace("geometry", r"(\d+) (\d+)\)\)\)$", "$1)))")).otherwise(c("geometry")))) \
        .select("identifier", "problem")


@check(with_views("poly") + """ SELECT layer, identifier, 0.5 AS shift, 0.0 AS area_diff, true AS significant FROM poly WHERE identifier % 2 = 0""")
def difference_of_open_rings(spark, sf):
    """Rings of the layer, holes and second parts too, are drawn open; published ones are closed, every second one moved by half a unit."""
    rows = v.polygons(spark, sf).withColumn("srid", F.lit(3857))
    drawn = rows.withColumn("geometry", F.regexp_replace("geometry", r",[^,()]*\)", ")"))
    step = F.when(c("identifier") % 2 == 0, 0.5).otherwise(0.0)
    moved = F.transform(G.parse_wkt(c("geometry")), lambda p: F.transform(p, lambda r: F.transform(r, lambda q: F.struct((q["x"] + step).alias("x"), q["y"].alias("y")))))
    diff = geo.geometry_diff(drawn, rows.select("identifier", G.to_wkt(moved).alias("geometry")))
    return diff.select("layer", "identifier", F.round("shift", 4).alias("shift"), F.round("area_diff", 4).alias("area_diff"), "significant")


# ---------------------------------------------------------------- graphs

@check("""SELECT 'x:p/' || p_partkey AS s, 'x:same' AS o, 'iri' AS o_type, CAST(NULL AS VARCHAR) AS g FROM part
 UNION ALL SELECT 'x:p/' || p_partkey, 'x:same', 'literal', NULL FROM part WHERE p_size < 20
 UNION ALL SELECT 'x:p/' || p_partkey, 'x:same', 'iri', 'x:g1' FROM part WHERE p_size > 40""")
def add_like_terms(spark, sf):
    """A literal and another graph's triple with the text of a stored IRI are new; the stored triple itself is not."""
    p = table(spark, sf, "part")
    s, same = v.txt("x:p/", c("p_partkey")), F.lit("x:same")
    old = p.select(F.inline(F.array(R.term(s, "x:is", same))))
    more = (p.filter("p_size < 20").select(F.inline(F.array(R.term(s, "x:is", same, "literal"), R.term(s, "x:is", same))))
            .unionByName(p.filter("p_size > 40").select(F.inline(F.array(R.term(s, "x:is", same, g=F.lit("x:g1")))))))
    return R.add_triples(old, more).select("s", "o", "o_type", "g")


@check("""SELECT 'x:p/' || p_partkey AS s, 'x:same' AS o, 'literal' AS o_type, CAST(NULL AS VARCHAR) AS g FROM part
 UNION ALL SELECT 'x:p/' || p_partkey, 'x:same', 'iri', 'x:g1' FROM part UNION ALL SELECT 'x:p/' || p_partkey, 'x:same', 'iri', NULL FROM part WHERE p_size >= 20""")
def delete_like_terms(spark, sf):
    """Deleting an IRI triple leaves the literal of the same text and the same triple of another graph."""
    p = table(spark, sf, "part")
    s, same = v.txt("x:p/", c("p_partkey")), F.lit("x:same")
    old = p.select(F.inline(F.array(R.term(s, "x:is", same), R.term(s, "x:is", same, "literal"), R.term(s, "x:is", same, g=F.lit("x:g1")))))
    gone = p.filter("p_size < 20").select(F.inline(F.array(R.term(s, "x:is", same))))
    return R.delete_triples(old, gone, ["x:is"]).select("s", "o", "o_type", "g")


@check("""SELECT 'x:c/' || p_partkey AS s, 'x:c/' || (5 * (p_partkey // 5) + (p_partkey + k) % 5) AS o, CAST(k AS INT) AS depth
 FROM part, range(0, 5) r(k) WHERE 5 * (p_partkey // 5) + 4 <= (SELECT max(p_partkey) FROM part) AND p_partkey >= 5""")
def ring_closure(spark, sf):
    """Rings of five: the loop ends although every node leads to itself."""
    p = table(spark, sf, "part").select(c("p_partkey").cast("long").alias("k"))
    last = p.agg(F.max("k").alias("last"))
    base = (F.floor(c("k") / 5) * 5).cast("long")
    rows = p.join(F.broadcast(last), c("last") >= base + 4).filter("k >= 5")
    links = rows.select(v.txt("x:c/", c("k")).alias("s"), v.txt("x:c/", base + (c("k") + 1) % 5).alias("o"))
    return R.closure(links)


# ---------------------------------------------------------------- sources and edits

@check("""WITH r AS (SELECT 'C_' || o_custkey AS identifier, 'Z ' || o_orderstatus AS source FROM orders UNION SELECT 'C_' || o_custkey, 'Today' FROM orders WHERE o_orderpriority = '1-URGENT')
 SELECT identifier, CASE WHEN bool_or(source = 'Today') THEN 'Today' ELSE min(source) END AS source FROM r GROUP BY identifier""")
def first_of_unlisted(spark, sf):
    """The order of sources lists one only; the others come after it and by name."""
    o = table(spark, sf, "orders")
    ident = v.txt("C_", c("o_custkey"))
    rows = o.select(ident.alias("identifier"), v.txt("Z ", c("o_orderstatus")).alias("source")).unionByName(
        o.filter("o_orderpriority = '1-URGENT'").select(ident.alias("identifier"), F.lit("Today").alias("source"))).distinct()
    layers = rows.select(F.lit("x").alias("site"), F.lit("buildings").alias("kind"), "identifier", "source", F.lit(True).alias("present"))
    return Fe.publish_sources(layers, rows.limit(0), "first", ["Today"], ["buildings"]).table.select("identifier", "source")


@check("""SELECT 'U_' || user_id AS identifier, min(event_id) AS seq FROM events GROUP BY user_id""")
def equal_seq_edits(spark, sf):
    """All edits of an object have one number: the smallest row stands for them, in features and links alike."""
    e = table(spark, sf, "events").select(
        v.txt("U_", c("user_id")).alias("identifier"), F.lit(1).cast("long").alias("seq"), F.lit("I").alias("op"), c("event_id").alias("name"))
    return S.distinct_edits(e).select("identifier", c("name").alias("seq"))
