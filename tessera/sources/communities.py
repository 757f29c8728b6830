"""Community JSON lines: awards, their participants, and organisation labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.schemas import RAW, fit

_IDS = "array<struct<scheme: string, identifier: string>>"
SCHEMA = (
    "id string, slug string, is_deleted boolean, parent struct<slug: string>, metadata struct<"
    f"funding: array<struct<award: struct<number: string, acronym: string, program: string, title: string, identifiers: {_IDS},"
    " organizations: array<struct<id: string, scheme: string, organization: string>>>>>,"
    f" organizations: array<struct<id: string, name: string, identifiers: {_IDS}>>>"
)


def read_communities(spark: SparkSession, path: str, parent_slug: str = "eu") -> tuple[DataFrame, DataFrame, DataFrame]:
    """community_awards, community_award_participants and community_orgs of the
    communities under a parent. Orders count from 1, before rows are left out."""
    rows = spark.read.schema(SCHEMA).json(path).where(F.col("parent.slug") == parent_slug)
    head = [text.text_or_empty(F.col("slug")).alias("slug"), text.text_or_empty(F.col("id")).alias("community_uuid"), F.coalesce("is_deleted", F.lit(False)).alias("is_deleted")]
    funding = rows.select(*head, F.posexplode("metadata.funding").alias("at", "f")).select("slug", "community_uuid", "is_deleted", (F.col("at") + 1).alias("award_order"), "f.award.*")
    funding = funding.withColumn("award_number", text.strip(F.col("number"))).where("award_number != ''")
    awards = funding.select(
        "slug", "community_uuid", "is_deleted", "award_order", "award_number", F.col("acronym").alias("award_acronym"), text.localized_title(F.col("title")).alias("award_title"),
        F.col("program").alias("award_program"), text.first_identifier(F.col("identifiers"), "url").alias("award_url"),
    )
    people = funding.select("slug", "award_number", F.posexplode("organizations").alias("at", "o"))
    people = people.select("slug", "award_number", (F.col("at") + 1).alias("participant_order"), text.strip(F.col("o.id")).alias("pic"), text.strip(F.col("o.organization")).alias("participant_name"), "o.scheme")
    people = people.where("scheme = 'pic' and pic != ''").withColumn("normalized_name", text.normalize_name(F.col("participant_name")))
    orgs = rows.select(head[0], F.posexplode("metadata.organizations").alias("at", "o")).select("slug", (F.col("at") + 1).alias("org_order"), "o.*")
    orgs = orgs.select(
        "slug", "org_order", text.strip(F.col("name")).alias("name"), text.strip(F.col("id")).alias("provided_id"), text.classify_provided_id(F.col("id")).alias("provided_id_kind"),
        text.community_ror_id(F.col("id"), F.col("identifiers")).alias("ror_id"), F.coalesce("identifiers", F.array().cast(_IDS)).alias("identifiers"),
    ).withColumn("normalized_name", text.normalize_name(F.col("name")))
    return fit(awards, RAW["community_awards"]), fit(people, RAW["community_award_participants"]), fit(orgs, RAW["community_orgs"].replace("struct<identifier: string, scheme: string>", "struct<scheme: string, identifier: string>"))
