"""Historical-map shaped views over the driver's tables.

Each view is a pure column expression over whole tables. `SQL` holds the same
definitions as CTEs, written independently for the comparison engine.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogeo import schema
from chronogeo.functions import geometry as G
from chronogeo.functions.years import parse_years_range
from chronogeo.operators.graph import TRIPLE_COLUMNS
from chronogeo.schema import VOCAB as V
from chronogeo.session import prepare, scratch_root, spread
from chronogeo.sources.readers import read_triples
from chronogeo.sources.writers import write_triples


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def txt(*parts) -> F.Column:
    return F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in parts])


c = F.col


# ---------------------------------------------------------------- periods and layers

def periods(spark, sf) -> DataFrame:
    """Line items as yearly map objects; the part is the object, the ship year the period."""
    return table(spark, sf, "lineitem").select(
        txt("L_", c("l_partkey")).alias("identifier"),
        F.year("l_shipdate").cast("string").alias("period"),
        txt("S_", c("l_suppkey")).alias("geometry"),
        c("l_returnflag").alias("flag"))


YEARS = [str(y) for y in range(1995, 2002)]


def label_of(year, priority, status, key):
    return (
        F.when(priority == "1-URGENT", "Today")
        .when(priority == "2-HIGH", F.concat(year.cast("string"), F.lit(": "), status))
        .when(priority == "3-MEDIUM", F.concat(year.cast("string"), F.lit("-"), F.substring((year + 1).cast("string"), 3, 2), F.lit(": b")))
        .when(priority == "4-NOT SPECIFIED", F.concat(year.cast("string"), F.lit("-"), (year + 1).cast("string")))
        .when(status == "F", F.lit("no year"))
        .when(status == "P", F.concat(year.cast("string"), F.lit("-5: "), key.cast("string")))
        .otherwise(F.concat(year.cast("string"), F.lit(":dis."), key.cast("string"))))


def labels(spark, sf) -> DataFrame:
    """Source labels of all shapes, one per order."""
    return table(spark, sf, "orders").select(
        "o_orderkey", label_of(F.year("o_orderdate"), c("o_orderpriority"), c("o_orderstatus"), c("o_custkey")).alias("label"))


def layer(spark, sf) -> DataFrame:
    """Long layer: customers are buildings, order priorities their phases, order labels their sources."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    digit = F.substring("o_orderpriority", 1, 1)
    year = F.year("o_orderdate")
    ident = F.concat(F.lit("C_BLDG_"), c("o_custkey").cast("string"),
                     F.when(digit == "1", "").otherwise(F.concat(F.lit("."), digit)))
    x, y = c("o_custkey").cast("double") * 10, digit.cast("double") * 10
    geom = F.array(F.array(F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in ((0, 0), (2, 0), (2, 3), (0, 3), (0, 0))])))
    rows = orders.join(customer, c("o_custkey") == c("c_custkey"))
    return rows.select(
        F.lower("c_mktsegment").alias("site"),
        F.when(digit.isin("1", "2"), "buildings").when(digit == "3", "islands").when(digit == "4", "openspaces").otherwise("waterways").alias("kind"),
        ident.alias("identifier"), F.concat(F.lit("House "), c("o_custkey").cast("string")).alias("name"),
        F.lit(3857).alias("srid"), G.to_wkt(geom).alias("geometry"),
        label_of(year, c("o_orderpriority"), c("o_orderstatus"), F.lit(7)).alias("source"),
        (c("o_orderstatus") != "P").alias("present"))


def plain_layer(spark, sf) -> DataFrame:
    """The layer without drawing its polygons."""
    return layer(spark, sf).select("site", "kind", "identifier", "name", "source", "present")


def source_years(spark, sf) -> DataFrame:
    """Years of the labels seen on finished orders; other labels stay unknown."""
    orders = table(spark, sf, "orders").filter(c("o_orderstatus") == "F")
    names = orders.select(label_of(F.year("o_orderdate"), c("o_orderpriority"), c("o_orderstatus"), F.lit(7)).alias("source")).distinct()
    return names.withColumn("s", parse_years_range(c("source"))).select("source", c("s.start").alias("start"), c("s.end").alias("end"))


def published(spark, sf) -> DataFrame:
    """Published ids: layer ids of customers in credit, and suppliers nobody drew."""
    good = table(spark, sf, "customer").filter(c("c_acctbal") >= 0).select("c_custkey")
    ids = table(spark, sf, "orders").select(
        "o_custkey", F.substring("o_orderpriority", 1, 1).alias("d")).distinct().join(good, c("o_custkey") == c("c_custkey"))
    own = ids.select(F.concat(F.lit("C_BLDG_"), c("o_custkey").cast("string"), F.when(c("d") == "1", "").otherwise(F.concat(F.lit("."), c("d")))).alias("identifier"))
    rest = table(spark, sf, "supplier").select(txt("SUP_", c("s_suppkey")).alias("identifier"))
    return own.unionByName(rest).select(
        "identifier", F.lit("Buildings").alias("t"), F.lit(1).alias("z"), F.lit("old").alias("name"), F.lit("G0").alias("geometry"))


def published_sources(spark, sf) -> DataFrame:
    """Links of the published ids that came from open orders, and links of customers out of credit (orphans)."""
    lay = plain_layer(spark, sf)
    return lay.filter(c("source").contains(": O") | (c("source") == "Today")).select("identifier", "source").distinct()


def registry(spark, sf) -> DataFrame:
    """Wired operations: inserts for all layers, updates where some order is pending, no deletes for water ways."""
    pairs = plain_layer(spark, sf).select("site", "kind").distinct()
    ins = pairs.withColumn("op", F.lit("insert"))
    upd = pairs.filter(c("kind").isin("buildings", "islands")).withColumn("op", F.lit("update"))
    dele = pairs.filter(c("kind") != "waterways").withColumn("op", F.lit("delete"))
    return ins.unionByName(upd).unionByName(dele)


# ---------------------------------------------------------------- polygons

def polygons(spark, sf) -> DataFrame:
    """One polygon per order: a box, a box with a hole, or two boxes, as WKT."""
    o = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate"))
    x, y = c("o_custkey"), c("o_orderkey")
    h = F.substring("o_orderpriority", 1, 1).cast("int") + 4

    def box(x0, y0, w, hh):
        pts = [(x0, y0), (x0 + w, y0), (x0 + w, y0 + hh), (x0, y0 + hh), (x0, y0)]
        return F.concat(F.lit("("), F.concat_ws(",", *[F.concat_ws(" ", a.cast("string"), b.cast("string")) for a, b in pts]), F.lit(")"))

    outer = box(x, y, F.lit(6), h)
    hole = box(x + 1, y + 1, F.lit(1), F.lit(2))
    far = box(x + 100, y, F.lit(2), F.lit(2))
    wkt = (
        F.when(c("o_orderstatus") == "F", F.concat(F.lit("MULTIPOLYGON(("), outer, F.lit("))")))
        .when(c("o_orderstatus") == "O", F.concat(F.lit("MULTIPOLYGON(("), outer, F.lit(","), hole, F.lit("))")))
        .otherwise(F.concat(F.lit("MULTIPOLYGON(("), outer, F.lit("),("), far, F.lit("))"))))
    return o.select(
        c("o_orderkey").alias("identifier"), c("o_orderpriority").alias("layer"), wkt.alias("geometry"),
        F.when(c("o_orderstatus") == "P", 32633).otherwise(3857).alias("srid"),
        c("o_orderdate").cast("date").alias("bob"),
        F.when(c("o_orderstatus") != "O", F.add_months(c("o_orderdate").cast("date"), 12)).alias("eoe"))


def shapes(spark, sf) -> DataFrame:
    return polygons(spark, sf).withColumn("geom", G.parse_wkt(c("geometry")))


# ---------------------------------------------------------------- triples

def _t(df: DataFrame, s, p: str, o, literal: bool = False, lang: str | None = None, g=None) -> DataFrame:
    return df.select(
        (F.lit(None) if g is None else g).cast("string").alias("g"), s.cast("string").alias("s"), F.lit(p).alias("p"),
        o.cast("string").alias("o"), F.lit("literal" if literal else "iri").alias("o_type"),
        F.lit(lang).cast("string").alias("lang"), F.lit(None).cast("string").alias("dtype")).select(*TRIPLE_COLUMNS)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _app(df, item, tail: str, kinds: list[str], label, typed: bool = True) -> list[DataFrame]:
    """An appellation node with types and label."""
    node = F.concat(item, F.lit("/" + tail))
    out = [_t(df, item, V.c("P1_is_identified_by"), node), _t(df, node, V.label, label, True)]
    out += [_t(df, node, V.c("P2_has_type"), F.lit(V.kind(k))) for k in kinds]
    return out + ([_t(df, node, V.rdf_type, F.lit(V.c("E41_Appellation")))] if typed else [])


def _year(df, event, label) -> list[DataFrame]:
    span, prim = F.concat(event, F.lit("/span")), F.concat(event, F.lit("/prim"))
    return [
        _t(df, event, V.c("P4_has_time-span"), span), _t(df, span, V.c("P170i_time_is_defined_by"), prim),
        _t(df, prim, V.rdf_type, F.lit(V.c("E61_Time-Primitive"))),
        _t(df, prim, V.c("P2_has_type"), F.lit(V.kind("time_primitive_year"))), _t(df, prim, V.label, label, True)]


def event_graph(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    item = txt("x:event/", c("event_id"))
    kinds = e.select("event_type").distinct()
    users = e.select("user_id").distinct()
    kind_iri = txt("x:etype/", c("event_type"))
    parts = [
        _t(e, item, V.rdf_type, F.lit(V.onto("Event"))),
        _t(e.filter("value >= 20"), item, V.label, c("event_type"), True, "it"),
        _t(e.filter("value >= 50"), item, V.label, txt("e-", c("event_type")), True, "en"),
        _t(e.filter("value < 80"), item, V.c("P2_has_type"), kind_iri),
        _t(kinds, kind_iri, V.c("P71i_is_listed_in"), F.lit(V.event_types)),
        _t(kinds, kind_iri, V.label, txt("tipo ", c("event_type")), True, "it"),
        _t(kinds, kind_iri, V.label, txt("type ", c("event_type")), True, "en"),
        _t(e, item, V.onto("has_island"), txt("x:island/", c("user_id"))),
    ]
    parts += _app(users, txt("x:island/", c("user_id")), "name", ["appellation"], txt("Isola ", c("user_id")))
    parts += _year(e.filter("event_type <> 'error'"), item, F.year("ts"))
    parts += _app(e.filter("event_type = 'purchase'"), item, "old", ["search_term"], F.lit("old term"))
    return _all(parts)


def group_graph(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier")
    item = txt("x:group/", c("s_suppkey"))
    parts = [_t(s, item, V.rdf_type, F.lit(V.onto("Group")))]
    parts += _app(s, item, "app", ["appellation"], c("s_name"), typed=False)
    parts += _app(s.filter("s_acctbal < 0"), item, "alias", ["alias"], txt("A", c("s_suppkey")), typed=False)
    parts += _app(s.filter("s_nationkey < 5"), item, "fam", ["family_name"], txt("Fam", c("s_nationkey")), typed=False)
    form, gone = txt(item, "/formed"), txt(item, "/gone")
    d = s.filter("s_acctbal > 5000")
    parts += [_t(s, item, V.c("P95i_was_formed_by"), form), _t(s, form, V.rdf_type, F.lit(V.c("E66_Formation")))]
    parts += _year(s, form, c("s_nationkey") + 1900)
    parts += [_t(d, item, V.c("P99i_dissolved_by"), gone), _t(d, gone, V.rdf_type, F.lit(V.c("E68_Dissolution")))]
    return _all(parts + _year(d, gone, c("s_nationkey") + 1950))


def person_graph(spark, sf) -> DataFrame:
    p = table(spark, sf, "customer").join(table(spark, sf, "nation"), c("c_nationkey") == c("n_nationkey"))
    item = txt("x:person/", c("c_custkey"))
    born, died = txt(item, "/birth"), txt(item, "/death")
    b, d = p.filter("c_mktsegment <> 'MACHINERY'"), p.filter("c_acctbal > 5000")
    parts = [_t(p, item, V.rdf_type, F.lit(V.onto("Person")))]
    parts += _app(p, item, "given", ["given_name"], c("c_name"), typed=False)
    parts += _app(p.filter("c_mktsegment = 'BUILDING'"), item, "given2", ["given_name"], txt("G2-", c("c_custkey")), typed=False)
    parts += _app(p, item, "family", ["family_name"], c("c_mktsegment"), typed=False)
    parts += _app(p.filter("c_acctbal < 0"), item, "alias", ["alias"], txt("Al", c("c_custkey")), typed=False)
    parts += _app(p, item, "pat", ["patronymic"], txt("di ", c("n_name")), typed=False)
    parts += [_t(b, item, V.c("P98i_was_born"), born), _t(b, born, V.rdf_type, F.lit(V.c("E67_Birth")))]
    parts += _year(b, born, c("c_nationkey") + 1900)
    parts += [_t(d, item, V.c("P100i_died_in"), died), _t(d, died, V.rdf_type, F.lit(V.c("E69_Death")))]
    parts += _year(d, died, c("c_nationkey") + 1960)
    parts += _app(p.filter("c_mktsegment = 'HOUSEHOLD'"), item, "old", ["search_term"], txt("old ", c("c_custkey")))
    return _all(parts)


def archive_graph(spark, sf) -> DataFrame:
    """Parts as an archive tree: node k lies in node floor(k/4), node 0 is the root."""
    p = table(spark, sf, "part")
    node = txt("x:arch/", c("p_partkey"))
    parts = [
        _t(p, node, V.rdf_type, F.lit(V.c("E78_Collection"))),
        _t(p, node, V.c("P71i_is_listed_in"), F.lit(V.archives_vocab)),
        _t(p.filter("p_partkey > 0"), node, V.c("P46i_forms_part_of"), txt("x:arch/", F.floor(c("p_partkey") / 4))),
        _t(p.filter("p_type <> 'ECONOMY'"), node, V.label, txt("N", c("p_partkey")), True, "it"),
        _t(p.filter("p_type <> 'PROMO'"), node, V.label, txt("E", c("p_partkey")), True, "en"),
    ]
    parts += _app(p.filter("p_size = 1"), node, "acr", ["acronym"], txt("AC", c("p_partkey")))
    return _all(parts)


def source_graph(spark, sf) -> DataFrame:
    """Parts as primary sources kept in the archive tree."""
    p = table(spark, sf, "part")
    item = txt("x:source/", c("p_partkey"))
    loc = txt(item, "/loc")
    made = txt(item, "/made")
    brands = p.select("p_brand").distinct()
    bib = txt("x:bib/", c("p_brand"))
    isle = txt("x:isle/", c("p_brand"))
    year = p.filter("p_size > 10")
    span, prim = txt(made, "/span"), txt(made, "/prim")
    parts = [
        _t(p, item, V.rdf_type, F.lit(V.onto("Source_Primary"))),
        _t(p.filter("p_size <> 7"), item, V.c("P53_has_former_or_current_location"), loc),
        _t(p.filter("p_size <> 7"), loc, V.c("P2_has_type"), F.lit(V.full_path)),
        _t(p.filter("p_size > 5 and p_size <> 7"), loc, V.c("P53_has_former_or_current_location"), txt("x:arch/", c("p_partkey"))),
        _t(p.filter("p_size < 9 and p_size <> 7"), loc, V.c("P46i_forms_part_of"), bib),
        _t(brands, bib, V.label, txt("Bib ", c("p_brand")), True),
        _t(p.filter("p_size > 20"), item, V.onto("has_island"), isle),
        _t(year, item, V.c("P108i_was_produced_by"), made), _t(year, made, V.rdf_type, F.lit(V.c("E12_Production"))),
        _t(year, made, V.c("P4_has_time-span"), span), _t(year, span, V.c("P170i_time_is_defined_by"), prim),
        _t(year, prim, V.c("P2_has_type"), F.lit(V.kind("time_primitive_year"))), _t(year, prim, V.label, c("p_size") + 1500, True),
        _t(p.filter("p_size > 30"), item, V.c("P53_has_former_or_current_location"), txt("x:medium/", c("p_type"))),
        _t(p.select("p_type").distinct(), txt("x:medium/", c("p_type")), V.c("P2_has_type"), F.lit(V.kind("medium"))),
        _t(p.select("p_type").distinct(), txt("x:medium/", c("p_type")), V.c("P2_has_type"), F.lit(V.carrier_types)),
        _t(p.select("p_type").distinct(), txt("x:medium/", c("p_type")), V.label, txt("supporto ", c("p_type")), True, "it"),
        _t(p, txt(item, "/medium_title"), V.label, c("p_name"), True),
    ]
    parts += _app(p, item, "title", ["attributed_title"], c("p_name"))
    parts += _app(p.filter("p_size > 45"), item, "title2", ["attributed_title"], c("p_brand"))
    parts += _app(brands, isle, "name", [], txt("Isola ", c("p_brand")))
    parts += _app(p.select("p_type").filter("p_type in ('PROMO', 'SMALL')").distinct(), txt("x:medium/", c("p_type")), "abbr", ["abbreviation"], txt(F.lower("p_type"), "."))
    return _all(parts).unionByName(archive_graph(spark, sf))


def book_graph(spark, sf) -> DataFrame:
    """Orders as secondary sources: customers edit, suppliers of the line items write."""
    o = table(spark, sf, "orders")
    item = txt("x:book/", c("o_orderkey"))
    pub, work, made = txt(item, "/pub"), txt(item, "/work"), txt(item, "/made")
    span = txt(pub, "/span")
    cur, pubr = txt(pub, "/cur"), txt(pub, "/publisher")
    e = o.filter("o_orderpriority <> '5-LOW'")
    dated = e.filter("o_orderstatus <> 'P'")
    curated = e.filter("o_orderstatus = 'F'")
    broader = o.filter("o_orderpriority in ('1-URGENT', '5-LOW')")
    status = o.select("o_orderstatus").distinct()
    series = txt("x:series/", c("o_orderstatus"))
    prio = o.select("o_orderpriority").distinct()
    cust, sup = table(spark, sf, "customer"), table(spark, sf, "supplier")
    # who wrote the other lines has neither a class nor a name
    actor = F.when(c("l_returnflag") == "A", txt("x:sup/", c("l_suppkey"))).otherwise(txt("x:unnamed/", c("l_returnflag")))
    wrote = table(spark, sf, "lineitem").select("l_orderkey", actor.alias("actor")).distinct()
    w_item = txt("x:book/", c("l_orderkey"))
    w_work, w_made = txt(w_item, "/work"), txt(w_item, "/made")
    parts = [
        _t(o, item, V.rdf_type, F.lit(V.onto("Source_Secondary"))),
        _t(e, item, V.frbroo + "R24i_was_created_through", pub), _t(e, pub, V.rdf_type, F.lit(V.frbroo + "F30_Publication_Event")),
        _t(curated, pub, V.c("P01i_is_domain_of"), cur), _t(curated, cur, V.c("P14.1_in_the_role_of"), F.lit(V.kind("curator"))),
        _t(curated, cur, V.c("P02_has_range"), txt("x:cust/", c("o_custkey"))),
        _t(cust, txt("x:cust/", c("c_custkey")), V.label, c("c_name"), True),
        _t(e, pub, V.c("P01i_is_domain_of"), pubr), _t(e, pubr, V.c("P14.1_in_the_role_of"), F.lit(V.kind("publisher"))),
        _t(e, pubr, V.c("P02_has_range"), txt("x:prio/", c("o_orderpriority"))),
        _t(prio, txt("x:prio/", c("o_orderpriority")), V.label, c("o_orderpriority"), True),
        _t(dated, pub, V.c("P4_has_time-span"), span), _t(dated, span, V.rdf_type, F.lit(V.c("E52_Time-Span"))),
        _t(dated, span, V.c("P82a_begin_of_the_begin"), c("o_orderdate").cast("date"), True),
        _t(e, pub, V.c("P7_took_place_at"), txt("x:place/", c("o_orderstatus"))),
        _t(status, txt("x:place/", c("o_orderstatus")), V.label, txt("Place ", c("o_orderstatus")), True),
        _t(broader, item, V.onto("has_broader"), series),
        _t(status.filter("o_orderstatus <> 'O'"), series, V.onto("has_broader_typology"), txt("x:typ/", c("o_orderstatus"))),
        _t(status, txt("x:typ/", c("o_orderstatus")), V.label, txt("Typ ", c("o_orderstatus")), True),
        _t(wrote, w_item, V.c("P129i_is_subject_of"), w_work), _t(wrote, w_work, V.rdf_type, F.lit(V.c("E33_Linguistic_Object"))),
        _t(wrote, w_work, V.c("P94i_was_created_by"), w_made), _t(wrote, w_made, V.rdf_type, F.lit(V.c("E65_Creation"))),
        _t(wrote, w_made, V.c("P14_carried_out_by"), c("actor")),
        _t(sup, txt("x:sup/", c("s_suppkey")), V.rdf_type, F.lit(V.c("E39_Actor"))),
        _t(sup, txt("x:sup/", c("s_suppkey")), V.label, c("s_name"), True),
    ]
    parts += _app(o, item, "title", ["title"], txt("Order ", c("o_orderkey")), typed=False)
    parts += _app(status, series, "title", ["title"], txt("Series ", c("o_orderstatus")), typed=False)
    return _all(parts)


def prov_graph(spark, sf) -> DataFrame:
    """Events as provenance rows of the source they touch; some sources have records and imported events."""
    e, p = table(spark, sf, "events"), table(spark, sf, "part")
    src = txt("x:source/", c("user_id"))
    g, ent = txt(src, "/container/context"), txt("x:prov/", c("event_id"))
    at, actor = c("ts").cast("string"), txt("x:actor/", c("event_type"))
    s2 = txt("x:source/", c("p_partkey"))
    rec = txt(s2, "/entity_form_record")
    have = p.filter("p_size < 25")
    rtype = V.record_types + "entity_form_record"
    old = e.filter("value > 90").withColumn("ev", txt("x:ev/", c("event_id")))
    r_old, span = txt(src, "/entity_form_record"), txt(c("ev"), "/span")
    made = have.filter("p_size < 5").withColumn("ev", txt("x:cr/", c("p_partkey")))
    parts = [
        _t(p, s2, V.rdf_type, F.lit(V.onto("Source_Primary"))),
        _t(e, ent, V.rdf_type, F.lit(V.prov + "Entity"), g=g),
        _t(e, ent, V.prov + "generatedAtTime", at, True, g=g),
        _t(e, ent, V.prov + "wasAttributedTo", actor, g=g),
        _t(have, s2, V.c("P129i_is_subject_of"), rec), _t(have, rec, V.rdf_type, F.lit(V.crmdig + "D1_Digital_Object")),
        _t(have, rec, V.c("P2_has_type"), F.lit(rtype)),
        _t(old, r_old, V.crmdig + "L11i_was_output_of", c("ev")), _t(old, c("ev"), V.rdf_type, F.lit(V.crmdig + "D7_Digital_Machine_Event")),
        _t(old, c("ev"), V.c("P2_has_type"), F.lit(rtype + "_modification")),
        _t(old, c("ev"), V.c("P14_carried_out_by"), actor), _t(old, c("ev"), V.c("P4_has_time-span"), span),
        _t(old, span, V.c("P82_at_some_time_within"), at, True),
        _t(made, rec, V.crmdig + "L11i_was_output_of", c("ev")), _t(made, c("ev"), V.c("P2_has_type"), F.lit(rtype + "_creation")),
    ]
    return _all(parts)


_STORED: dict[tuple, str] = {}


def stored(spark, sf, view) -> DataFrame:
    """A graph as a user keeps it: parquet partitioned by predicate, written once per session and scale."""
    key = (spark.sparkContext.applicationId, sf, view.__name__)
    if key not in _STORED:
        path = f"{scratch_root(spark)}/checks/{uuid.uuid4().hex}"
        write_triples(view(spark, sf), path, sorted_out=True)
        _STORED[key] = path
    return read_triples(spark, _STORED[key])


# ---------------------------------------------------------------- edits

def edits(spark, sf) -> DataFrame:
    """Events as layer edits of the object `user_id`."""
    e = table(spark, sf, "events")
    op = F.when(c("event_type").isin("signup", "click"), "I").when(c("event_type").isin("view", "purchase"), "U").otherwise("D")
    return e.select(
        op.alias("op"), c("event_id").alias("seq"),
        F.when(c("event_type") == "signup", "buildings").otherwise("islands").alias("kind"),
        txt("U_", c("user_id")).alias("identifier"), txt("n", c("event_id")).alias("name"), txt("g", c("event_id")).alias("geometry"),
        F.create_map(F.lit("Today"), c("value") >= 50, F.lit("1982: Ortofoto"), c("value") < 100).alias("flags"))


def edit_features(spark, sf) -> DataFrame:
    """Objects published before the edits: customers in debt."""
    return table(spark, sf, "customer").filter("c_acctbal < 0").select(
        txt("U_", c("c_custkey")).alias("identifier"), F.lit("Buildings").alias("t"), F.lit(1).alias("z"),
        c("c_name").alias("name"), F.lit("g-old").alias("geometry"))


def edit_sources(spark, sf) -> DataFrame:
    return edit_features(spark, sf).select("identifier", F.lit("Today").alias("source"))


# ---------------------------------------------------------------- the same views as SQL

_LABEL = """CASE WHEN o_orderpriority = '1-URGENT' THEN 'Today'
 WHEN o_orderpriority = '2-HIGH' THEN year(o_orderdate) || ': ' || o_orderstatus
 WHEN o_orderpriority = '3-MEDIUM' THEN year(o_orderdate) || '-' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) || ': b'
 WHEN o_orderpriority = '4-NOT SPECIFIED' THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1)
 WHEN o_orderstatus = 'F' THEN 'no year'
 WHEN o_orderstatus = 'P' THEN year(o_orderdate) || '-5: ' || {key}
 ELSE year(o_orderdate) || ':dis.' || {key} END"""

_IDENT = "'C_BLDG_' || o_custkey || CASE WHEN left(o_orderpriority, 1) = '1' THEN '' ELSE '.' || left(o_orderpriority, 1) END"

RANGE_START = """CASE WHEN lower({c}) = 'today' THEN 2000
 WHEN regexp_matches({c}, '[0-9]{{4}}') THEN CAST(regexp_extract({c}, '([0-9]{{4}})', 1) AS INT) ELSE 2000 END"""
RANGE_END = """CASE WHEN lower({c}) = 'today' THEN 40000
 WHEN regexp_matches({c}, '[0-9]{{4}}-[0-9]{{2,4}}') THEN
   CASE WHEN length(regexp_extract({c}, '[0-9]{{4}}-([0-9]{{2,4}})', 1)) = 2
     THEN CAST(left(regexp_extract({c}, '([0-9]{{4}})-[0-9]{{2,4}}', 1), 2) || regexp_extract({c}, '[0-9]{{4}}-([0-9]{{2,4}})', 1) AS INT)
     ELSE CAST(regexp_extract({c}, '[0-9]{{4}}-([0-9]{{2,4}})', 1) AS INT) END
 WHEN regexp_matches({c}, '[0-9]{{4}}') THEN CAST(regexp_extract({c}, '([0-9]{{4}})', 1) AS INT) ELSE 40000 END"""

SQL = {
    "periods": """SELECT 'L_' || l_partkey AS identifier, CAST(year(l_shipdate) AS VARCHAR) AS period, 'S_' || l_suppkey AS geometry,
 l_returnflag AS flag FROM lineitem""",
    "labels": "SELECT o_orderkey, " + _LABEL.format(key="o_custkey") + " AS label FROM orders",
    "layer": f"""SELECT lower(c_mktsegment) AS site, CASE left(o_orderpriority, 1) WHEN '1' THEN 'buildings' WHEN '2' THEN 'buildings'
 WHEN '3' THEN 'islands' WHEN '4' THEN 'openspaces' ELSE 'waterways' END AS kind, {_IDENT} AS identifier,
 'House ' || o_custkey AS name, {_LABEL.format(key="7")} AS source, o_orderstatus <> 'P' AS present,
 o_custkey * 10 AS x, CAST(left(o_orderpriority, 1) AS INT) * 10 AS y
 FROM orders JOIN customer ON o_custkey = c_custkey""",
    "source_years": f"""SELECT source, {RANGE_START.format(c="source")} AS start_y, {RANGE_END.format(c="source")} AS end_y FROM
 (SELECT DISTINCT {_LABEL.format(key="7")} AS source FROM orders WHERE o_orderstatus = 'F')""",
    "published": f"""SELECT DISTINCT {_IDENT} AS identifier FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0
 UNION ALL SELECT 'SUP_' || s_suppkey FROM supplier""",
    "published_sources": "SELECT DISTINCT identifier, source FROM layer WHERE contains(source, ': O') OR source = 'Today'",
    "registry": """SELECT DISTINCT site, kind, 'insert' AS op FROM layer UNION ALL
 SELECT DISTINCT site, kind, 'update' FROM layer WHERE kind IN ('buildings', 'islands') UNION ALL
 SELECT DISTINCT site, kind, 'delete' FROM layer WHERE kind <> 'waterways'""",
    "poly": """SELECT o_orderkey AS identifier, o_orderpriority AS layer, o_orderstatus AS st, o_custkey AS x, o_orderkey AS y, 6 AS w,
 CAST(left(o_orderpriority, 1) AS INT) + 4 AS h, CASE WHEN o_orderstatus = 'P' THEN 32633 ELSE 3857 END AS srid,
 CAST(o_orderdate AS DATE) AS bob, CASE WHEN o_orderstatus <> 'O' THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 12 MONTH AS DATE) END AS eoe
 FROM orders""",
    "poly_m": """SELECT *, w * h - CASE WHEN st = 'O' THEN 2 ELSE 0 END + CASE WHEN st = 'P' THEN 4 ELSE 0 END AS area,
 ((x + 3.0) * w * h - CASE WHEN st = 'O' THEN (x + 1.5) * 2 ELSE 0 END + CASE WHEN st = 'P' THEN (x + 101.0) * 4 ELSE 0 END) AS mx,
 ((y + h / 2.0) * w * h - CASE WHEN st = 'O' THEN (y + 2.0) * 2 ELSE 0 END + CASE WHEN st = 'P' THEN (y + 1.0) * 4 ELSE 0 END) AS my,
 x AS min_x, y AS min_y, CASE WHEN st = 'P' THEN x + 102 ELSE x + 6 END AS max_x, y + h AS max_y FROM poly""",
    "edits": """SELECT CASE WHEN event_type IN ('signup', 'click') THEN 'I' WHEN event_type IN ('view', 'purchase') THEN 'U' ELSE 'D' END AS op,
 event_id AS seq, event_type, 'U_' || user_id AS identifier, 'n' || event_id AS name, 'g' || event_id AS geometry, value FROM events""",
    "edit_features": "SELECT 'U_' || c_custkey AS identifier, c_name AS name FROM customer WHERE c_acctbal < 0",
    "tree": "SELECT p_partkey AS k, CAST(floor(p_partkey / 4) AS BIGINT) AS parent, p_size, p_type FROM part",
}

DEPENDS = {"published_sources": ["layer"], "registry": ["layer"], "poly_m": ["poly"]}


def with_views(*names: str, recursive: bool = False) -> str:
    """`WITH ...` text of the named views and what they need."""
    order: list[str] = []

    def add(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            add(dep)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
