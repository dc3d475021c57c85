"""Table contracts, seed dimensions and the RDF vocabulary."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LAYER_LONG = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("identifier", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("srid", T.IntegerType()),
    T.StructField("geometry", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("present", T.BooleanType()),
])

FEATURES = T.StructType([
    T.StructField("identifier", T.StringType(), False),
    T.StructField("t", T.StringType()),
    T.StructField("z", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("geometry", T.StringType()),
])

FEATURE_SOURCES = T.StructType([
    T.StructField("identifier", T.StringType(), False),
    T.StructField("source", T.StringType()),
])

SOURCE_YEARS = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
])

TRIPLES = T.StructType([
    T.StructField("g", T.StringType()),
    T.StructField("s", T.StringType()),
    T.StructField("p", T.StringType()),
    T.StructField("o", T.StringType()),
    T.StructField("o_type", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("dtype", T.StringType()),
])

CHANGES = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("identifier", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("geometry", T.StringType()),
    T.StructField("flags", T.MapType(T.StringType(), T.BooleanType())),
])

ISSUES = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("item", T.StringType()),
    T.StructField("detail", T.StringType()),
])

META_COLUMNS = ("identifier", "geometry", "identifier_short", "name")
ID_COLUMNS = ("identifier", "BW_ID", "bw_id")

# Display type and draw level per layer kind.
KIND_ROWS = [
    ("buildings", "Buildings", 1),
    ("islands", "Island", 0),
    ("openspaces", "Open Space", 1),
    ("waterways", "Water way", -1),
]

# First rows of the source -> years dimension.
SOURCE_YEAR_ROWS = [
    ("Today", 2000, 40000),
    ("1982: Ortofoto", 1982, 1982),
    ("1943-45: RAF", 1943, 1945),
    ("1850: Direzione genio militare", 1850, 1850),
    ("1838-41: Censo Stabile, Mappe Austriache - rettifica", 1838, 1841),
    ("1830-31: Censo Stabile, Mappe Austriache", 1830, 1831),
    ("1807-10: Censo Stabile, Mappe Napoleoniche", 1807, 1810),
]

# Labels from newest to oldest, used by the first-true-flag rule.
SOURCE_ORDER = [label for label, _, _ in SOURCE_YEAR_ROWS] + ["1789", "1697"]

# Map window in EPSG:3857 (min x, min y, max x, max y).
MAP_WINDOW = (1369976.3700049379840493, 5685579.3808039482682943, 1377990.9423133304808289, 5692943.0214672936126590)

# Site name -> identifier prefix.
SITE_PREFIXES = {
    "bueldellovo": "BDO", "burano": "BRN", "campalto": "CMP", "carbonera": "CRB", "casonmillecampi": "CMC",
    "casonmontiron": "CMT", "casonprimeposte": "CPP", "casontorson": "CTS", "certosa": "CRT", "chioggia": "CHG",
    "crevan": "CRV", "expoveglia": "EPV", "fisolo": "FSL", "giudecca": "GDC", "isoladeilaghi": "IDL",
    "lacura": "LCR", "lasalina": "LSL", "lazzarettonuovo": "LZN", "lazzarettovecchio": "LZV", "legrazie": "LGR",
    "lido": "LDO", "madonnadelmonte": "MDM", "mazzorbo": "MZB", "montedelloro": "MTD", "mottadisanlorenzo": "MSL",
    "murano": "MRN", "ottagonoabbandonato": "OAB", "ottagonodeglialberoni": "ODA", "ottagonodisanpietro": "OSP",
    "pellestrina": "PLS", "podo": "PDO", "poveglia": "PVG", "saccafisola": "SCF", "saccasanbiagio": "SSB",
    "saccasessola": "SCS", "sanclemente": "SCL", "sanfrancescodeldeserto": "SFD", "sangiacomoinpaludo": "SGP",
    "sangiorgioinalga": "SGA", "sangiorgiomaggiore": "SGM", "sangiuliano": "SGL", "sanlazzarodegliarmeni": "SLA",
    "sanmichele": "SMC", "sansecondo": "SSC", "sanservolo": "SSV", "santacristina": "SCR", "santandrea": "SAN",
    "santangelodellapolvere": "SAP", "santariano": "STR", "santerasmo": "STE", "santospirito": "SSP",
    "tessera": "TSR", "torcello": "TRC", "trezze": "TRZ", "vignole": "VGN",
}

TODAY_START, OPEN_END = 2000, 40000


def kinds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KIND_ROWS, "kind string, t string, z int")


def source_years_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCE_YEAR_ROWS, SOURCE_YEARS)


def site_prefixes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(SITE_PREFIXES.items()), "site string, prefix string")


@dataclass(frozen=True)
class Vocabulary:
    """IRIs used by the triple jobs. Set `base` to the namespace of your own graph."""

    base: str = "https://example.org/"
    crm: str = "http://www.cidoc-crm.org/cidoc-crm/"
    crmdig: str = "http://www.cidoc-crm.org/extensions/crmdig/"
    rdf_type: str = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
    label: str = "http://www.w3.org/2000/01/rdf-schema#label"
    value: str = "http://www.w3.org/2000/01/rdf-schema#value"
    prov: str = "http://www.w3.org/ns/prov#"
    frbroo: str = "http://iflastandards.info/ns/fr/frbr/frbroo/"
    xsd_date: str = "http://www.w3.org/2001/XMLSchema#date"
    archives_vocab: str = "http://www.researchspace.org/resource/vocab/archives"
    record_types: str = "http://www.researchspace.org/resource/system/vocab/resource_type/"

    def onto(self, name: str) -> str:
        return f"{self.base}ontology#{name}"

    def kind(self, name: str) -> str:
        return f"{self.base}resource/type/{name}"

    def c(self, name: str) -> str:
        return self.crm + name

    @property
    def event_types(self) -> str:
        return f"{self.base}resource/vocab/event_types"

    @property
    def carrier_types(self) -> str:
        return f"{self.base}resource/vocab/information_carrier/type"

    @property
    def full_path(self) -> str:
        return f"{self.base}resource/archival_entity/full_path"


VOCAB = Vocabulary()
