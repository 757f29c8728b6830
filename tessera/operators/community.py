"""Community labels: which are suspicious, and what participants they explain."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import labels
from tessera.functions.text import json_value, normalize_name, text_or_empty
from tessera.operators import evidence as ev
from tessera.operators.select import first_per_key, unbroadcast
from tessera.operators.vote import single


def suspicious_orgs(orgs: DataFrame, ror: DataFrame) -> DataFrame:
    """Labels whose registry entry is missing, or doesn't have the label among its names."""
    names = ror.select("ror_id", "normalized_names", "display_name")
    joined = orgs.where("ror_id != ''").join(names, "ror_id", "left")
    known = (F.col("normalized_name") != "") & F.array_contains("normalized_names", F.col("normalized_name"))
    reason = F.when(F.col("normalized_names").isNull(), "missing-ror-record").when(~known, "name-not-in-ror-aliases")
    return joined.withColumn("reason", reason).where("reason is not null").select("slug", "org_order", "name", "normalized_name", "ror_id", text_or_empty(F.col("display_name")).alias("ror_display_name"), "reason")


def trusted_orgs(orgs: DataFrame, suspicious: DataFrame, ror: DataFrame) -> DataFrame:
    """Labels that aren't suspicious and whose registry entry exists."""
    kept = orgs.where("ror_id != ''").join(suspicious.select("slug", "org_order"), ["slug", "org_order"], "left_anti")
    return unbroadcast(kept.join(ror.select("ror_id"), "ror_id", "left_semi"))


def alias_map(trusted: DataFrame, ror: DataFrame) -> DataFrame:
    """(slug, normalized_name, ror_id): aliases that mean exactly one entry in a community."""
    own = trusted.select("slug", "normalized_name", "ror_id")
    listed = trusted.select("slug", "ror_id").join(ror.select("ror_id", F.explode("normalized_names").alias("normalized_name")), "ror_id").select("slug", "normalized_name", "ror_id")
    return single(own.unionByName(listed).where("normalized_name != ''"), ["slug", "normalized_name"], "ror_id")


def observations(participants: DataFrame, orgs: DataFrame, suspicious: DataFrame, ror: DataFrame) -> DataFrame:
    """community_pic_ror_observations: the first place of each code, target, community and award."""
    trusted = trusted_orgs(orgs, suspicious, ror)
    label = trusted.groupBy("slug", "ror_id").agg(F.min_by("name", "org_order").alias("community_org_name"))
    found = participants.where("pic != '' and normalized_name != ''").join(alias_map(trusted, ror), ["slug", "normalized_name"])
    found = first_per_key(found, ["pic", "ror_id", "slug", "award_number"], "participant_order").join(label, ["slug", "ror_id"])
    named = ev.with_names(found.withColumn("s_value", F.col("participant_name")).withColumn("s_normalized", F.col("normalized_name")).withColumn("fuzzy", F.lit(None).cast(ev.FUZZY_TYPE)), ror)
    label_check = ev.json_object(
        field=ev.constant("community organization label"),
        source_normalized=json_value(normalize_name(F.col("community_org_name"))),
        source_value=json_value(F.col("community_org_name")),
        target_normalized=json_value(text_or_empty(F.col("t_name_normalized"))),
        target_value=json_value(text_or_empty(F.col("t_name"))),
    )
    evidence = ev.json_object(
        comparison=ev.json_object(checked=ev.json_array(ev.name_check("participant name"), label_check), kind=ev.constant(labels.OBSERVED_KIND), score=ev.no_score()),
        from_=ev.constant("Community metadata"),
        rule=ev.constant(labels.OBSERVED_RULE),
        rule_code=ev.constant("community_exact_name"),
        source=json_value(F.struct("award_number", "community_org_name", F.col("slug").alias("community_slug"), "participant_name")),
        target=ev.target_summary(F.col("ror_id"), F.col("t_name"), F.col("t_country")),
        why=ev.constant(labels.OBSERVED_WHY),
    )
    return named.select("pic", "ror_id", "slug", "award_number", "participant_name", "community_org_name", evidence.alias("evidence_json"))


def community_counts(observed: DataFrame) -> DataFrame:
    """Observations, communities and awards of each code and target, and whether the code
    has one target only (stable) or several (ambiguous)."""
    counted = observed.groupBy("pic", "ror_id").agg(F.count("*").alias("observation_count"), F.countDistinct("slug").alias("slug_count"), F.countDistinct("award_number").alias("award_count"))
    alone = F.count("*").over(Window.partitionBy("pic")) == 1
    return counted.withColumn("community_status", F.when(alone, "stable").otherwise("ambiguous"))


def against_direct(counted: DataFrame, direct: DataFrame) -> DataFrame:
    """Whether direct links of the code, if it has any, agree with the target or conflict."""
    linked = direct.select("pic", F.lit(True).alias("linked__")).distinct()
    same = direct.select("pic", "ror_id", F.lit(True).alias("same__")).distinct()
    # pairs meet pairs: a code's links as an array would be searched for each of its targets
    joined = counted.join(linked, "pic", "left").join(same, ["pic", "ror_id"], "left")
    agrees = F.col("same__").isNotNull()
    return joined.select(
        *counted.columns,
        F.when(agrees, 1).otherwise(0).alias("agrees_with_openaire_direct"),
        F.when(F.col("linked__") & ~agrees & F.col("ror_id").isNotNull(), 1).otherwise(0).alias("conflicts_with_openaire_direct"),
    )


def community_matches(observed: DataFrame, openaire_matches: DataFrame) -> DataFrame:
    direct = openaire_matches.where("strategy = 'direct_unique'").select("pic", "ror_id")
    return against_direct(community_counts(observed), direct)
