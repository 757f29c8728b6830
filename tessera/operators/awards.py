"""Best available award and participant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import labels
from tessera.operators.select import first_per_key, min_count_per_pair, renumbered


def origin_priority(origin) -> "F.Column":
    out = F.lit(999)
    for at, name in enumerate(labels.ORIGINS):
        out = F.when(origin == name, at).otherwise(out)
    return out


def best_awards(projects: DataFrame, community_awards: DataFrame) -> DataFrame:
    """One row an award: the official project of the first origin, else the first community."""
    official = projects.select(
        "award_number", F.lit("cordis").alias("source"), F.col("origin").alias("source_origin"), "acronym", "title", "programme", F.col("project_url").alias("award_url"), "project_website",
        F.struct(F.lit(0).alias("a"), origin_priority(F.col("origin")).alias("b"), F.col("origin").alias("c"), F.lit(0).alias("d")).alias("order__"),
    )
    listed = community_awards.select(
        "award_number", F.lit("community").alias("source"), F.col("slug").alias("source_origin"), F.col("award_acronym").alias("acronym"), F.col("award_title").alias("title"),
        F.col("award_program").alias("programme"), "award_url", F.lit("").alias("project_website"),
        F.struct(F.lit(1).alias("a"), F.lit(0).alias("b"), F.col("slug").alias("c"), F.col("award_order").alias("d")).alias("order__"),
    )
    return first_per_key(official.unionByName(listed), ["award_number"], "order__").drop("order__")


def modal_participants(participants: DataFrame) -> DataFrame:
    """(award_number, pic, participant_name, participant_order) by the most seen name of a
    code; ties go to the smaller order, then name. Orders are renumbered without gaps."""
    counted = min_count_per_pair(participants, ["award_number", "pic", "participant_name"], "participant_order")
    best = first_per_key(counted, ["award_number", "pic"], F.desc("seen"), "participant_order", "participant_name")
    return renumbered(best, ["award_number"], "participant_order", "participant_order", "pic", "participant_name").drop("seen")


def best_participants(awards: DataFrame, participants: DataFrame, community_participants: DataFrame, resolutions: DataFrame) -> DataFrame:
    """award_participants_best, with each code's resolution or ''."""
    chosen = awards.select("award_number", "source", "source_origin")
    official = chosen.where("source = 'cordis'").join(participants.withColumnRenamed("origin", "source_origin"), ["award_number", "source_origin"]).select(
        "award_number", "participant_order", "source", "source_origin", "pic", F.col("legal_name").alias("participant_name"), "participant_type", "country_code", "website_url"
    )
    blank = F.lit("")
    pooled = chosen.where("source = 'community'").join(modal_participants(community_participants), "award_number").select(
        "award_number", "participant_order", "source", "source_origin", "pic", "participant_name", blank.alias("participant_type"), blank.alias("country_code"), blank.alias("website_url")
    )
    known = resolutions.select("pic", "ror_id", F.col("confidence").alias("resolution_confidence"), F.col("source").alias("resolution_source"))
    out = official.unionByName(pooled)
    joined = out.join(known, "pic", "left")
    return joined.select(*out.columns, *[F.coalesce(F.col(c), blank).alias(c) for c in ("ror_id", "resolution_confidence", "resolution_source")])


def best_codes(awards: DataFrame, participants: DataFrame, community_participants: DataFrame, resolutions: DataFrame) -> DataFrame:
    """(award_number, pic, source) of award_participants_best, each once, with the code's
    resolution or '': all that coverage counts. Names and orders aren't chosen for it."""
    chosen = awards.select("award_number", "source", "source_origin")
    official = chosen.where("source = 'cordis'").join(participants.select("award_number", F.col("origin").alias("source_origin"), "pic"), ["award_number", "source_origin"])
    pooled = chosen.where("source = 'community'").join(community_participants.select("award_number", "pic"), "award_number")
    out = official.select("award_number", "pic", "source").unionByName(pooled.select("award_number", "pic", "source")).distinct()
    known = resolutions.select("pic", "ror_id", F.col("confidence").alias("resolution_confidence"))
    return out.join(known, "pic", "left").select(*out.columns, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("ror_id", "resolution_confidence")])
