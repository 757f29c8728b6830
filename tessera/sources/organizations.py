"""Organisation records (TAR of JSON lines) and the registry (ZIP of a JSON array)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.schemas import RAW, fit
from tessera.sources.archives import dealt_out, read_tar_jsonl, read_zip_json_array

_RECORD = "id string, legalName string, legalShortName string, alternativeNames array<string>, country struct<code: string>, websiteUrl string, pids array<struct<scheme: string, value: string>>"
_REGISTRY = (
    "id string, names array<struct<value: string, types: array<string>>>, links array<struct<type: string, value: string>>, domains array<string>,"
    " locations array<struct<geonames_details: struct<country_code: string>>>, types array<string>, external_ids array<struct<type: string, all: string, preferred: string>>"
)
#: Schemes of records, and how their values are stored.
_SCHEMES = {"GRID": "grid", "ISNI": "isni", "Wikidata": "wikidata", "FundRef": "fundref"}


def _pids(scheme: str, clean) -> Column:
    hits = F.filter(F.coalesce("pids", F.array()), lambda p: (p["scheme"] == scheme) & (text.text_or_empty(p["value"]) != ""))
    return F.array_sort(F.array_distinct(F.transform(hits, lambda p: clean(p["value"]))))


def _cleaner(scheme: str):
    return lambda value: text.normalize_identifier(scheme, value)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """openaire_orgs: one row a record, identifiers by scheme, sorted and distinct."""
    return record_table(dealt_out(read_tar_jsonl(spark, path)))


def record_table(lines: DataFrame) -> DataFrame:
    rows = lines.select(F.from_json("value", _RECORD).alias("r")).select("r.*")
    out = rows.select(
        F.col("id").alias("record_id"),
        F.col("legalName").alias("legal_name"),
        text.normalize_name(F.col("legalName")).alias("normalized_name"),
        F.col("legalShortName").alias("legal_short_name"),
        text.sorted_set(F.transform("alternativeNames", text.strip)).alias("alt_names"),
        F.col("country.code").alias("country_code"),
        text.strip(F.col("websiteUrl")).alias("website_url"),
        text.domains_of(F.array(text.strip(F.col("websiteUrl")))).alias("domains"),
        _pids("PIC", text.strip).alias("pics"),
        _pids("ROR", text.short_ror_id).alias("rors"),
        *[_pids(name, _cleaner(scheme)).alias(f"{scheme}_ids") for name, scheme in _SCHEMES.items()],
    )
    return fit(out, RAW["openaire_orgs"])


def _external_ids(kind: str) -> Column:
    """Values of 'all' and 'preferred', each a string or a list."""
    own = F.filter(F.coalesce("external_ids", F.array()), lambda e: e["type"] == kind)
    listed = lambda v: F.when(v.startswith("["), F.from_json(v, "array<string>")).when(v.isNotNull(), F.array(v))
    nothing = F.array().cast("array<string>")
    values = F.flatten(F.transform(own, lambda e: F.concat(F.coalesce(listed(e["all"]), nothing), F.coalesce(listed(e["preferred"]), nothing))))
    return text.sorted_set(F.transform(values, _cleaner(kind)))


def display_name(names: Column) -> Column:
    """The first name shown or labelled, else the first that isn't empty."""
    names = F.coalesce(names, F.array())
    shown = F.filter(names, lambda n: F.coalesce(F.array_contains(n["types"], "ror_display") | F.array_contains(n["types"], "label"), F.lit(False)))
    filled = F.filter(names, lambda n: text.text_or_empty(n["value"]) != "")
    return text.strip(F.when(F.size(shown) > 0, F.get(shown, F.lit(0))["value"]).otherwise(F.get(filled, F.lit(0))["value"]))


def country_code(locations: Column) -> Column:
    """The first location's code that isn't empty."""
    codes = F.filter(F.transform(F.coalesce(locations, F.array()), lambda x: text.strip(x["geonames_details"]["country_code"])), lambda c: c != "")
    return text.text_or_empty(F.get(codes, F.lit(0)))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """ror_orgs: one row a registry entry with an id."""
    return registry_table(dealt_out(read_zip_json_array(spark, path)))


def registry_table(lines: DataFrame) -> DataFrame:
    rows = lines.select(F.from_json("value", _REGISTRY).alias("r")).select("r.*").withColumn("ror_id", text.short_ror_id(F.col("id"))).where("ror_id != ''")
    links = F.filter(F.coalesce("links", F.array()), lambda x: (x["type"] == "website") & (text.text_or_empty(x["value"]) != ""))
    sites = F.transform(links, lambda x: text.strip(x["value"]))
    rows = rows.withColumn("raw_names", text.sorted_set(F.transform("names", lambda n: text.strip(n["value"]))))
    named = rows.select("ror_id", F.explode("raw_names").alias("raw")).withColumn("normalized", text.normalize_name(F.col("raw")))
    named = named.where("normalized != ''").groupBy("ror_id").agg(F.array_sort(F.collect_set("normalized")).alias("normalized_names"))
    out = rows.select(
        "ror_id",
        display_name(F.col("names")).alias("display_name"),
        country_code(F.col("locations")).alias("country_code"),
        F.col("raw_names").alias("names"),
        text.domains_of(F.concat(F.coalesce("domains", F.array().cast("array<string>")), sites)).alias("domains"),
        F.array_sort(sites).alias("website_links"),
        *[_external_ids(kind).alias(f"{kind}_ids") for kind in ("grid", "isni", "wikidata", "fundref")],
        F.coalesce("types", F.array().cast("array<string>")).alias("types"),
    ).join(named, "ror_id", "left")
    return fit(out, RAW["ror_orgs"])
