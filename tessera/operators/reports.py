"""Reports: coverage, label review, curation queue, summary counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import normalize_name, percent, round_percent, text_or_empty
from tessera.operators.select import unbroadcast

# Bands of the reports.
COVERAGE_BINS = ("0%", ">0-20%", ">20-40%", ">40-60%", ">60-80%", ">80-<100%", "100%")
SIZE_BANDS = ("1-5", "6-10", "11-20", "21-40", "41+")
SOURCE_BUCKETS = ("cordis", "community", "mixed", "none")
ACCEPTED = ("high", "medium")


def accepted(confidence: Column) -> Column:
    return confidence.isin(*ACCEPTED)


def coverage_bin(value: Column) -> Column:
    """0 and 100 are bins of their own; the others take their upper end."""
    out = F.when(value == 0, COVERAGE_BINS[0])
    for upper, label in zip((20, 40, 60, 80), COVERAGE_BINS[1:], strict=False):
        out = out.when((value > 0) & (value <= upper), label)
    return out.when((value > 80) & (value < 100), COVERAGE_BINS[5]).when(value == 100, COVERAGE_BINS[6])


def size_band(total: Column) -> Column:
    return F.when(total <= 0, None).when(total <= 5, "1-5").when(total <= 10, "6-10").when(total <= 20, "11-20").when(total <= 40, "21-40").otherwise("41+")


def _people(participants: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a code within the keys: how well it is resolved, and the sources it comes from."""
    has = F.col("ror_id") != ""
    return participants.where("pic != ''").groupBy(*keys, "pic").agg(
        F.max((has & (F.col("resolution_confidence") == "high")).cast("int")).alias("high"),
        F.max((has & accepted(F.col("resolution_confidence"))).cast("int")).alias("high_medium"),
        F.max(has.cast("int")).alias("any"),
        F.min("source").alias("first_source"),
        F.max("source").alias("last_source"),
    )


_RESOLVED = ("high", "high_medium", "any")


def _covered() -> list[Column]:
    """Codes: all, resolved at high, at high or medium, at any confidence."""
    return [F.count("pic").alias("participants"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _RESOLVED]]


def source_bucket(first: Column, last: Column) -> Column:
    return F.when(first.isNull(), "none").when(first != last, "mixed").otherwise(first)


def community_coverage(awards: DataFrame, participants: DataFrame) -> DataFrame:
    """One row an active community, communities without participants included.

    A code of an award counts in every community that lists the award. Rather than a row each,
    64 communities are bits of one number, and a code gathers its awards' bits.
    """
    active = awards.where("not is_deleted").select("slug", "award_number").distinct()
    listed = active.groupBy("slug").agg(F.count("*").alias("award_count"))
    place = F.row_number().over(Window.partitionBy("part__").orderBy("slug")) - 1
    placed = active.select("slug").distinct().withColumn("part__", F.pmod(F.xxhash64("slug"), F.lit(4))).withColumn("place__", place)
    placed = placed.select("slug", (F.col("part__") + 4 * F.expr("place__ div 64")).alias("word__"), (F.col("place__") % 64).alias("bit__"))
    masks = active.join(placed, "slug").groupBy("award_number", "word__").agg(F.bit_or(F.expr("shiftleft(1L, bit__)")).alias("mask__"))
    has, mask = F.col("ror_id") != "", F.col("mask__")
    holds = {"all__": F.lit(True), "high": has & (F.col("resolution_confidence") == "high"), "high_medium": has & accepted(F.col("resolution_confidence")), "any": has}
    rows = participants.where("pic != ''").select("award_number", "pic", "source", *[c.alias(n) for n, c in holds.items()]).join(masks, "award_number")
    packed = rows.groupBy("pic", "source", "word__").agg(*[F.bit_or(F.when(F.col(n), mask).otherwise(F.lit(0).cast("long"))).alias(n) for n in holds])
    bit = lambda name: F.getbit(F.col(name), F.col("bit__"))
    people = packed.join(placed, "word__").where(bit("all__") == 1).groupBy("slug", "pic").agg(
        *[F.max(bit(c)).alias(c) for c in _RESOLVED], F.min("source").alias("first_source"), F.max("source").alias("last_source")
    )
    bucket = source_bucket(F.min("first_source"), F.max("last_source"))
    counted = people.groupBy("slug").agg(*_covered(), bucket.alias("source_bucket"))
    return listed.join(counted, "slug", "left").fillna(0, ["participants", *_RESOLVED]).fillna("none", ["source_bucket"])


def award_coverage(awards: DataFrame, participants: DataFrame) -> DataFrame:
    active = awards.where("not is_deleted").select("award_number").distinct()
    counted = _people(participants, ["award_number"]).groupBy("award_number").agg(*_covered())
    return active.join(counted, "award_number", "left").fillna(0, ["participants", *_RESOLVED]).drop("high")


def availability(community: DataFrame) -> DataFrame:
    some = F.count_if(F.col("participants") > 0)
    return community.agg(some.alias("communities_with_participants"), (F.count("*") - some).alias("communities_without_participants"), round_percent(some, F.count("*")).alias("pct_with_participants"))


def medians(rows: DataFrame, columns: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Exact medians, unrounded; null where there are no rows."""
    return rows.groupBy(*keys).agg(*[F.median(c).alias(name) for name, c in columns.items()])


def pct(column: str) -> Column:
    return percent(F.col(column), F.col("participants"))


def coverage_summary(community: DataFrame) -> DataFrame:
    rows = community.where("participants > 0")
    return medians(rows, {"median_high_pct": pct("high"), "median_high_medium_pct": pct("high_medium"), "median_any_pct": pct("any")})


def labelled(spark, labels: Sequence[str], name: str) -> DataFrame:
    return spark.range(len(labels)).select(F.col("id").cast("int").alias("position"), F.get(F.array(*map(F.lit, labels)), F.col("id")).alias(name))


def coverage_distribution(community: DataFrame, column: str) -> DataFrame:
    """(bin, n) of all bins, empty ones included."""
    counts = community.where("participants > 0").groupBy(coverage_bin(pct(column)).alias("bin")).agg(F.count("*").alias("n"))
    return labelled(community.sparkSession, COVERAGE_BINS, "bin").join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"), "position")


def award_summary(awards: DataFrame) -> DataFrame:
    some = F.col("participants") > 0
    with_rows = lambda c: F.median(F.when(some, pct(c)))
    return awards.agg(F.count_if(some).alias("awards_with_participants"), F.count_if(~some).alias("awards_without_participants"), with_rows("high_medium").alias("median_high_medium_pct"), with_rows("any").alias("median_any_pct"))


def coverage_by_source_bucket(community: DataFrame) -> DataFrame:
    some = F.col("participants") > 0
    only = lambda c: F.median(F.when(some, c))
    found = community.groupBy("source_bucket").agg(
        F.count("*").alias("communities"), F.count_if(some).alias("with_participants"), only(F.col("participants")).alias("median_participants"), only(pct("high_medium")).alias("median_hm_pct"), only(pct("any")).alias("median_any_pct")
    )
    return _by_label(community, found, SOURCE_BUCKETS, "source_bucket", ["communities", "with_participants"])


def coverage_by_size(community: DataFrame) -> DataFrame:
    rows = community.where("participants > 0").withColumn("band", size_band(F.col("participants")))
    found = rows.groupBy("band").agg(
        F.count("*").alias("communities"), F.median("participants").alias("median_total_participants"), F.median("any").alias("median_resolved_count_any"), F.median(pct("high_medium")).alias("median_hm_pct"), F.median(pct("any")).alias("median_any_pct")
    )
    return _by_label(community, found, SIZE_BANDS, "band", ["communities"])


def _by_label(df: DataFrame, found: DataFrame, names: Sequence[str], name: str, counts: Sequence[str]) -> DataFrame:
    return labelled(df.sparkSession, names, name).join(found, name, "left").fillna(0, list(counts))


def coordinator_coverage(awards: DataFrame, participants: DataFrame, community: DataFrame) -> DataFrame:
    """Over communities of official participants: how many have their coordinator resolved."""
    official = community.where("source_bucket = 'cordis'").select("slug")
    active = awards.where("not is_deleted").select("slug", "award_number").distinct()
    leads = participants.where("source = 'cordis' and participant_type = 'coordinator'").select("award_number", "ror_id", "resolution_confidence")
    has = F.col("ror_id") != ""
    # of all communities, so that the coverage is computed once
    by_slug = active.join(leads, "award_number").groupBy("slug").agg(F.bool_or(has).alias("any_"), F.bool_or(has & accepted(F.col("resolution_confidence"))).alias("hm_"))
    joined = official.join(by_slug, "slug", "left")
    rows, hm, some = F.count("any_"), F.count_if("hm_"), F.count_if("any_")
    return joined.agg(
        F.count("*").alias("communities_with_cordis_participants"),
        rows.alias("communities_with_any_coordinator_row"),
        hm.alias("communities_with_resolved_coordinator_hm"),
        some.alias("communities_with_resolved_coordinator_any"),
        round_percent(hm, rows).alias("pct_with_resolved_coordinator_hm"),
        round_percent(some, rows).alias("pct_with_resolved_coordinator_any"),
    )


def resolved_types(awards: DataFrame, participants: DataFrame, ror: DataFrame) -> DataFrame:
    """(ror_type, occurrences, unique_pic): participants of active awards, once a community
    that lists the award, and distinct codes."""
    kind = ror.select("ror_id", F.coalesce(F.get("types", F.lit(0)), F.lit("Unknown")).alias("ror_type"))
    # an award's communities are counted before its participants meet them
    listed = awards.where("not is_deleted").groupBy("award_number").agg(F.count("*").alias("n__"))
    rows = participants.where("ror_id != ''").join(listed, "award_number").groupBy("pic", "ror_id").agg(F.sum("n__").alias("n__"))
    typed = rows.join(kind, "ror_id", "left").withColumn("ror_type", F.coalesce("ror_type", F.lit("Unknown")))
    once = typed.groupBy("pic", "ror_id", "ror_type").agg(F.sum("n__").alias("n__"))
    return once.groupBy("ror_type").agg(F.sum("n__").alias("occurrences"), F.count("*").alias("unique_pic")).orderBy(F.desc("occurrences"), "ror_type")


def likely_wrong(suspicious: DataFrame, ror: DataFrame) -> DataFrame:
    """Suspicious labels that other entries carry as an exact name, unless the assigned
    entry's display name is the label."""
    named = ror.select(F.explode("normalized_names").alias("normalized_name"), F.struct(F.col("ror_id").alias("id"), "display_name", "country_code").alias("other"))
    fit = suspicious.where(normalize_name(F.col("ror_display_name")) != F.col("normalized_name"))
    # the entries of a name that some label has are gathered once, not once a label
    listed = named.join(fit.select("normalized_name"), "normalized_name", "left_semi").groupBy("normalized_name").agg(F.array_sort(F.collect_list("other")).alias("listed"))
    listed = unbroadcast(listed)
    found = fit.join(listed, "normalized_name").withColumn("others", F.filter("listed", lambda o: o["id"] != F.col("ror_id"))).where(F.size("others") > 0)
    shown = F.transform("others", lambda o: F.concat(o["id"], F.lit(" ("), o["display_name"], F.lit(", "), o["country_code"], F.lit(")")))
    return found.select(*suspicious.columns, F.size("others").alias("other_ror_count"), F.array_join(shown, " | ").alias("other_rors"))


def review_rows(suspicious: DataFrame, wrong: DataFrame) -> DataFrame:
    return suspicious.join(unbroadcast(wrong.select("slug", "org_order")), ["slug", "org_order"], "left_anti").select(suspicious.columns)


def conflict_rows(observed: DataFrame, matches: DataFrame, openaire: DataFrame, ror: DataFrame) -> DataFrame:
    """Observations whose target conflicts with the code's direct link."""
    conflicting = matches.where("conflicts_with_openaire_direct = 1").select("pic", "ror_id")
    direct = openaire.where("strategy = 'direct_unique'").select("pic", F.col("ror_id").alias("openaire_ror_id"))
    name = lambda key, out: ror.select(F.col("ror_id").alias(key), F.col("display_name").alias(out))
    # names come before the join by code, which makes every pair of an observation and a link
    rows = observed.join(conflicting, ["pic", "ror_id"]).withColumnRenamed("ror_id", "community_ror_id").join(name("community_ror_id", "community_ror_name"), "community_ror_id", "left")
    rows = rows.join(direct.join(name("openaire_ror_id", "openaire_ror_name"), "openaire_ror_id", "left"), "pic")
    return rows.select("slug", "pic", "participant_name", "community_org_name", "community_ror_id", "community_ror_name", "openaire_ror_id", "openaire_ror_name")


def label_summary(suspicious: DataFrame, wrong: DataFrame, review: DataFrame, conflicts: DataFrame) -> dict[str, int]:
    out = {}
    for name, df in (("suspicious", suspicious), ("likely_wrong", wrong), ("review", review), ("conflict", conflicts)):
        row = df.agg(F.count("*").alias("n"), F.countDistinct("slug").alias("c")).first()
        out |= {f"{name}_rows": row["n"], f"{name}_communities": row["c"]}
    return out


def openaire_signals(orgs: DataFrame) -> DataFrame:
    """(pic, openaire_alt_names, openaire_external_ids): up to five alternative names, and
    all identifiers, joined by bars."""
    ids = F.concat(*[F.transform(F.col(f"{s}_ids"), _prefixed(s)) for s in ("wikidata", "grid", "isni", "fundref")])
    rows = orgs.select(F.explode("pics").alias("pic"), "alt_names", ids.alias("ids"))
    merged = rows.groupBy("pic").agg(F.array_distinct(F.flatten(F.collect_set("alt_names"))).alias("names"), F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"))
    clean = lambda c: F.array_sort(F.filter(c, lambda x: x != ""))
    return merged.select("pic", F.array_join(F.slice(clean("names"), 1, 5), "|").alias("openaire_alt_names"), F.array_join(clean("ids"), "|").alias("openaire_external_ids"))


def _prefixed(scheme: str):
    return lambda v: F.when(v != "", F.concat(F.lit(f"{scheme}:"), v)).otherwise("")


def review_queue(participants: DataFrame, resolutions: DataFrame, signals: DataFrame, seen: Sequence[str] = ("award_number", "origin", "participant_order"), origins: Sequence[str] | None = None) -> DataFrame:
    """One row a code without an accepted resolution, most frequent first, with a count by
    origin, its most frequent descriptions and what is known of it."""
    done = resolutions.where(accepted(F.col("confidence"))).select("pic")
    described = (("country_code", "country"), ("short_name", "short_name"), ("legal_name", "legal_name"), ("website_url", "website_url"))
    rows = participants.where("pic != ''").select("pic", "origin", F.struct(*seen).alias("seen__"), *[c for c, _ in described]).join(done, "pic", "left_anti")
    if origins is None:
        origins = sorted(r[0] for r in rows.select("origin").distinct().collect())
    # a row each of an appearance's origin and descriptions, so that participants are made once
    pairs = F.array(*[F.struct(F.lit(name).alias("kind__"), F.col(c).alias("value__")) for c, name in (("origin", ""), *described)])
    tall = rows.select("pic", "seen__", F.inline(pairs)).where("kind__ = '' or value__ != ''")
    counted = tall.groupBy("pic", "kind__", "value__").agg(F.count("*").alias("n__"), F.min("seen__").alias("seen__"))
    of = lambda name, c: F.when(F.col("kind__") == name, c)
    total = lambda c: F.coalesce(F.sum(of("", c)), F.lit(0))
    out = counted.groupBy("pic").agg(
        total(F.col("n__")).alias("count"),
        *[total(F.when(F.col("value__") == o, F.col("n__"))).alias(f"count_{o.lower()}") for o in origins],
        *[F.min_by("value__", of(name, F.struct(-F.col("n__"), F.col("seen__"), F.col("value__")))).alias(name) for _, name in described],
    )
    open_rows = resolutions.where(~accepted(F.col("confidence"))).select("pic", F.col("ror_id").alias("pipeline_ror"), F.col("confidence").alias("pipeline_confidence"), F.col("source").alias("pipeline_source"))
    out = out.join(signals, "pic", "left").join(open_rows, "pic", "left")
    texts = [*[name for _, name in described], "openaire_alt_names", "openaire_external_ids", "pipeline_ror", "pipeline_confidence", "pipeline_source"]
    return out.select("pic", "count", *[f"count_{o.lower()}" for o in origins], *[text_or_empty(F.col(c)).alias(c) for c in texts])


def queue_order() -> list[Column]:
    return [F.desc("count"), F.asc("pic")]


def queue_totals(queue: DataFrame) -> DataFrame:
    has = F.col("pipeline_ror") != ""
    return queue.agg(F.count("*").alias("pics"), F.coalesce(F.sum("count"), F.lit(0)).alias("appearances"), F.count_if(has).alias("with_candidate"), F.count_if(~has).alias("without_candidate"))


def review_statistics(entries: DataFrame, queue: DataFrame, marker: str = "generalized to parent") -> DataFrame:
    """Totals of a reviewed list (pic, ror, reasoning), and the appearances it accounts for."""
    taken = F.trim("ror") != ""
    stats = entries.agg(F.count("*").alias("total"), F.count_if(taken).alias("accepted"), F.count_if(~taken).alias("unresolved"), F.count_if(taken & F.lower("reasoning").contains(marker)).alias("generalized"))
    covered = queue.join(entries.where(taken).select("pic").distinct(), "pic", "left_semi").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("appearances_covered"))
    total = queue.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total_unresolved_appearances"))
    one = lambda df: df.withColumn("one__", F.lit(1))
    return one(stats).join(one(covered), "one__").join(one(total), "one__").drop("one__")


def label_quality(orgs: DataFrame, suspicious: DataFrame) -> DataFrame:
    """(bucket, count): labels without an entry, suspicious ones, and the rest."""
    flagged = orgs.join(suspicious.select("slug", "org_order").distinct().withColumn("hit__", F.lit(True)), ["slug", "org_order"], "left")
    bucket = F.when(F.col("ror_id") == "", "no_ror").when(F.col("hit__"), "suspicious").otherwise("self_consistent")
    return flagged.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("count"))


def counts_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def top_sources(mapping: DataFrame, k: int = 15) -> DataFrame:
    return counts_by(mapping, "source").orderBy(F.desc("count"), "source").limit(k)


def table_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {name: df.count() for name, df in tables.items()}
