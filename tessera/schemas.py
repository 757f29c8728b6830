"""Schemas of the stored tables, and the checks that stand in for primary keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Column lists by table; arrays stay arrays until an export writes them as JSON.
RAW = {
    "cordis_projects": "award_number string, origin string, acronym string, title string, programme string, project_url string, project_website string",
    "cordis_participants": "award_number string, origin string, participant_order int, participant_type string, pic string, legal_name string, normalized_legal_name string, short_name string, country_code string, website_url string, vat_number string, rcn string",
    "community_awards": "slug string, community_uuid string, is_deleted boolean, award_order int, award_number string, award_acronym string, award_title string, award_program string, award_url string",
    "community_award_participants": "slug string, award_number string, participant_order int, pic string, participant_name string, normalized_name string",
    "community_orgs": "slug string, org_order int, name string, normalized_name string, provided_id string, provided_id_kind string, ror_id string, identifiers array<struct<identifier: string, scheme: string>>",
    "openaire_orgs": "record_id string, legal_name string, normalized_name string, legal_short_name string, alt_names array<string>, country_code string, website_url string, domains array<string>, pics array<string>, rors array<string>, grid_ids array<string>, isni_ids array<string>, wikidata_ids array<string>, fundref_ids array<string>",
    "ror_orgs": "ror_id string, display_name string, country_code string, names array<string>, normalized_names array<string>, domains array<string>, website_links array<string>, grid_ids array<string>, isni_ids array<string>, wikidata_ids array<string>, fundref_ids array<string>, types array<string>",
}
DERIVED = {
    "suspicious_community_orgs": "slug string, org_order int, name string, normalized_name string, ror_id string, ror_display_name string, reason string",
    "openaire_pic_ror_matches": "pic string, ror_id string, strategy string, confidence string, source_record_id string, evidence_json string",
    "participant_pic_ror_matches": "pic string, ror_id string, strategy string, confidence string, participant_source string, source_origin string, award_number string, evidence_json string",
    "community_pic_ror_observations": "pic string, ror_id string, slug string, award_number string, participant_name string, community_org_name string, evidence_json string",
    "community_pic_ror_matches": "pic string, ror_id string, observation_count long, slug_count long, award_count long, community_status string, agrees_with_openaire_direct int, conflicts_with_openaire_direct int",
    "pic_ror_resolutions": "pic string, ror_id string, confidence string, source string, evidence_json string",
    "awards_best": "award_number string, source string, source_origin string, acronym string, title string, programme string, award_url string, project_website string",
    "award_participants_best": "award_number string, participant_order int, source string, source_origin string, pic string, participant_name string, participant_type string, country_code string, website_url string, ror_id string, resolution_confidence string, resolution_source string",
}
KEYS = {
    "cordis_projects": ["award_number", "origin"],
    "cordis_participants": ["award_number", "origin", "participant_order"],
    "community_awards": ["slug", "award_order"],
    "community_award_participants": ["slug", "award_number", "participant_order"],
    "community_orgs": ["slug", "org_order"],
    "openaire_orgs": ["record_id"],
    "ror_orgs": ["ror_id"],
    "suspicious_community_orgs": ["slug", "org_order", "reason"],
    "openaire_pic_ror_matches": ["pic", "ror_id", "strategy", "source_record_id"],
    "participant_pic_ror_matches": ["pic", "ror_id", "strategy", "participant_source", "source_origin", "award_number"],
    "community_pic_ror_observations": ["pic", "ror_id", "slug", "award_number"],
    "community_pic_ror_matches": ["pic", "ror_id"],
    "pic_ror_resolutions": ["pic"],
    "awards_best": ["award_number"],
    "award_participants_best": ["award_number", "source", "participant_order"],
}


class DuplicateKeyError(ValueError):
    """A table holds two rows of the same key."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def assert_unique(df: DataFrame, keys: list[str], name: str = "table") -> DataFrame:
    """df itself, after making sure that no two rows share a key."""
    found = duplicate_keys(df, keys).head(1)
    if found:
        raise DuplicateKeyError(f"{name}: {found[0].asDict()}")
    return df


def fit(df: DataFrame, ddl: str) -> DataFrame:
    """df with exactly the columns and types of ddl; missing strings become ''."""
    fields = df.sparkSession.createDataFrame([], ddl).schema
    out = []
    for f in fields:
        column = F.col(f.name).cast(f.dataType)
        kind = f.dataType.typeName()
        if kind == "string":
            column = F.coalesce(column, F.lit(""))
        elif kind == "array":
            column = F.coalesce(column, F.array().cast(f.dataType))
        out.append(column.alias(f.name))
    return df.select(*out)
