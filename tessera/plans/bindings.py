"""One query an operator, over the stand-in tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions import labels, text
from tessera.functions.similarity import similarity
from tessera.operators import awards, candidates, community, fuzzy, publish, reports, resolve, select, vote
from tessera.plans import standins as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


# --- scalar functions -------------------------------------------------------


@query
def normalize_name(spark, d):
    p = t.parts(spark, d).withColumn("raw", F.expr("concat('  ', upper(p_name), ' & ', p_brand, ', Inc. GmbH')"))
    return p.select("p_partkey", text.normalize_name(F.col("raw")).alias("normalized"))


@query
def normalize_document_names(spark, d):
    """Accents, ligatures and other scripts: the whole text of every document, as one name."""
    return t.table(spark, d, "documents").select("doc_id", text.normalize_name(F.col("text")).alias("normalized"))


@query
def token_sort_key(spark, d):
    p = t.parts(spark, d)
    return p.select("p_partkey", text.token_sort_key(t.norm(F.col("display"))).alias("token_key"))


@query
def corporate_suffix_strip(spark, d):
    p = t.parts(spark, d).withColumn("raw", F.expr("concat(p_name, ' ', element_at(array('GmbH', 'Co. KG', 'S.A.', 'Ltd Inc', 'SA', 'group'), cast(p_partkey % 6 as int) + 1))"))
    return p.select("p_partkey", t.norm(F.col("raw")).alias("normalized"))


@query
def normalize_domain(spark, d):
    return t.table(spark, d, "pages").select("page_id", text.normalize_domain(F.col("url")).alias("domain"))


@query
def identifier_functions(spark, d):
    p = t.parts(spark, d).withColumn("raw", F.expr("case p_partkey % 4 when 0 then concat('https://ror.org/', lpad(p_partkey, 9, '0'), '/') when 1 then lpad(p_partkey, 9, 'a') when 2 then concat('edmo:', p_partkey) else '  ' end"))
    raw = F.col("raw")
    return p.select("p_partkey", text.short_ror_id(raw).alias("short_id"), text.classify_provided_id(raw).alias("kind"), text.looks_like_ror_id(raw).alias("ror_shaped"), text.normalize_identifier("isni", F.concat(F.lit(" 0000 "), "p_brand", F.lit(" X "))).alias("isni"))


@query
def meaningful_names(spark, d):
    p = t.parts(spark, d).withColumn("raw", F.expr("case p_partkey % 5 when 0 then 'University' when 1 then substring(p_name, 1, 3) when 2 then substring_index(p_name, ' ', 1) when 3 then 'GmbH' else p_name end"))
    name = t.norm(F.col("raw"))
    return p.select("p_partkey", text.is_meaningful_alias(name).alias("as_alias"), text.is_meaningful_fuzzy(name).alias("as_fuzzy"))


@query
def lateral_json_each(spark, d):
    """Members of a JSON array column, null-tolerant."""
    e = t.table(spark, d, "events").withColumn("raw", F.expr("concat('[\"', event_type, '\", \"', user_id, '\"]')"))
    return e.select("event_id", F.explode(text.json_strings(F.col("raw"))).alias("member"))


@query
def localized_titles(spark, d):
    p = t.parts(spark, d).withColumn("raw", F.expr("case p_partkey % 3 when 0 then p_name when 1 then concat('{\"de\": \"x\", \"en\": \"', p_name, '\"}') else concat('{\"fr\": \"', p_brand, '\"}') end"))
    return p.select("p_partkey", text.localized_title(F.col("raw")).alias("title"))


# --- uniqueness votes -------------------------------------------------------


@query
def unique_name_country(spark, d):
    return vote.name_vote(t.orgs(spark, d), vote.name_index(t.ror(spark, d)), "record_id", F.col("normalized_name"), F.col("country_code"))


@query
def vote_external_ids(spark, d):
    return vote.vote(vote.external_ids(t.orgs(spark, d), "record_id"), vote.external_index(t.ror(spark, d)), ["scheme", "value"], "record_id", "ror_id")


@query
def vote_domains(spark, d):
    return vote.vote(t.orgs(spark, d).select("record_id", F.explode("domains").alias("domain")), vote.domain_index(t.ror(spark, d)), ["domain"], "record_id", "ror_id")


@query
def alias_vote(spark, d):
    o = t.orgs(spark, d).select("record_id", F.explode("alt_names").alias("raw"), F.col("country_code").alias("country"))
    out = vote.alias_vote(o.withColumn("name", t.norm(F.col("raw"))), vote.name_index(t.ror(spark, d)), "record_id", "ror_id", "raw")
    return out.withColumn("matched_names", F.array_join("matched_names", "|"))


@query
def token_sort_unique(spark, d):
    return vote.token_sort_vote(t.orgs(spark, d), vote.token_sort_index(t.ror(spark, d)), "record_id", F.col("normalized_name"), F.col("country_code"))


# --- inexact matching -------------------------------------------------------


@query
def fuzzy_block_join(spark, d):
    """Size of each block of names that are compared."""
    named = t.ror(spark, d).select(F.explode("normalized_names").alias("n"), "country_code").distinct()
    return named.select("country_code", F.explode(text.fuzzy_block_keys(F.col("n"))).alias("block")).groupBy("country_code", "block").agg(F.count("*").alias("n_names"))


@query
def fuzzy_similarity(spark, d):
    p = t.parts(spark, d).select("p_partkey", t.norm(F.col("display")).alias("a"), t.norm(F.expr("concat(p_size, ' ', p_name, 's ', p_brand)")).alias("b"))
    return p.withColumn("s", similarity("a", "b")).select("p_partkey", "s.*")


@query
def fuzzy_best_match(spark, d):
    names = t.orgs(spark, d).select(F.col("record_id").alias("record"), F.lit(0).alias("position"), F.col("legal_name").alias("raw"), F.col("normalized_name").alias("normalized"), F.col("country_code").alias("country"))
    return fuzzy.best_unique_match(names, fuzzy.fuzzy_targets(t.ror(spark, d))).select("record", "ror_id", "fuzzy.score", "fuzzy.margin", "fuzzy.target_normalized")


# --- candidates and resolution ---------------------------------------------


@query
def openaire_candidates(spark, d):
    return candidates.openaire_matches(t.orgs(spark, d), t.ror(spark, d))


@query
def openaire_exact_candidates(spark, d):
    """The rules that have an SQL form, a row a code, target, rule and record."""
    found = candidates.record_strategies(t.orgs(spark, d), t.ror(spark, d)).where("strategy not like 'fuzzy%'")
    pics = t.orgs(spark, d).select(F.col("record_id").alias("record"), F.explode("pics").alias("pic"))
    return found.join(pics, "record").select("pic", "ror_id", "strategy", labels.lookup(F.col("strategy"), labels.CONFIDENCE).alias("confidence"), F.col("record").alias("source_record_id"))


@query
def participant_candidates(spark, d):
    """Over all records; of the stand-in codes every fifth is renamed to one that no record lists."""
    pic = F.expr("case when cast(substring(pic, 2) as int) % 5 = 0 then concat('n', pic) else pic end")
    return candidates.participant_matches(t.participants(spark, d).withColumn("pic", pic), t.orgs(spark, d), t.ror(spark, d))


@query
def suspicious_orgs(spark, d):
    return community.suspicious_orgs(t.community_orgs(spark, d), t.ror(spark, d))


def _suspicious(spark, d):
    return community.suspicious_orgs(t.community_orgs(spark, d), t.ror(spark, d))


def _observed(spark, d):
    return community.observations(t.community_participants(spark, d), t.community_orgs(spark, d), _suspicious(spark, d), t.ror(spark, d))


def _direct(spark, d):
    return t.orgs(spark, d).where("size(rors) = 1").select(F.explode("pics").alias("pic"), F.get("rors", F.lit(0)).alias("ror_id"))


@query
def community_observations(spark, d):
    return _observed(spark, d).drop("evidence_json")


@query
def stable_vs_ambiguous(spark, d):
    return community.community_counts(_observed(spark, d))


@query
def agrees_conflicts(spark, d):
    return community.against_direct(community.community_counts(_observed(spark, d)), _direct(spark, d))


def _event_signals(spark, d):
    """Candidates and community counts of codes made of a user and a day."""
    e = t.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int")).withColumn("pic", F.expr("concat(user_id, '-', day(ts))")).withColumn("ror_id", F.expr("concat('r', k % 3)"))
    group = F.expr("case event_type when 'click' then case when k % 2 = 0 then 'direct_unique' else 'direct_ambiguous' end when 'view' then 'external' when 'purchase' then 'domain' when 'signup' then case when k % 5 < 2 then 'exact_name' when k % 5 < 4 then 'token_sort' else 'fuzzy_name' end end")
    supporter = F.expr("case when k % 2 = 0 then 'openaire:' else 'participant:' end || case when k % 5 < 2 then if(k % 2 = 0, 'name_country_unique', 'participant_name_country_unique') when k % 5 < 4 then if(k % 2 = 0, 'token_sort_name_country_unique', 'participant_token_sort_name_country_unique') else if(k % 2 = 0, 'fuzzy_name_country_unique', 'participant_fuzzy_name_country_unique') end")
    found = e.where("event_type <> 'error'").select("pic", "ror_id", group.alias("group"), supporter.alias("supporter"))
    observed = e.where("event_type = 'error'").select("pic", "ror_id", F.col("event_type").alias("slug"), F.col("event_id").cast("string").alias("award_number"))
    return found, community.community_counts(observed)


@query
def rule_chain_resolution(spark, d):
    found, observed = _event_signals(spark, d)
    return resolve.decide(resolve.signals(found, observed)).select("pic", "ror_id", "confidence", "source", "reason")


@query
def resolution_trace(spark, d):
    """Resolutions of records and communities with the whole trace."""
    registry, records = t.ror(spark, d), t.orgs(spark, d)
    found = select.settled(candidates.openaire_matches(records, registry))
    people = select.settled(candidates.participant_matches(t.participants(spark, d), records, registry))
    observed = select.settled(_observed(spark, d))
    return resolve.traced_resolutions(found, people, community.community_matches(observed, found), observed, registry)


# --- selection --------------------------------------------------------------


@query
def first_per_key(spark, d):
    o = t.table(spark, d, "orders")
    return select.first_per_key(o, ["o_custkey"], F.desc("o_totalprice"), "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query
def best_by_priority(spark, d):
    return awards.best_awards(t.projects(spark, d), t.community_awards(spark, d))


@query
def modal_value(spark, d):
    l = t.table(spark, d, "lineitem").withColumn("mode_", F.concat("l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").cast("string")))
    return select.most_frequent(l, ["l_suppkey"], "mode_", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"), "modal")


@query
def min_count_per_pair(spark, d):
    return select.min_count_per_pair(t.table(spark, d, "orders"), ["o_custkey", "o_orderpriority"], "o_orderkey")


@query
def renumbered_participants(spark, d):
    return awards.modal_participants(t.community_participants(spark, d))


@query
def award_participants_best(spark, d):
    best = awards.best_awards(t.projects(spark, d), t.community_awards(spark, d))
    return awards.best_participants(best, t.participants(spark, d), t.community_participants(spark, d), t.resolutions(spark, d))


@query
def posexplode_before_filter(spark, d):
    """Ordinals from 1 that count members which are then left out."""
    e = t.table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("at", "x")).select("vec_id", (F.col("at") + 1).alias("ordinal"), "x")
    return e.where("x > 0.2").select("vec_id", "ordinal")


@query
def duplicate_keys(spark, d):
    return schemas.duplicate_keys(t.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- joins ------------------------------------------------------------------


@query
def anti_join_unseen(spark, d):
    """Customers without an urgent order of some size."""
    urgent = t.table(spark, d, "orders").where("o_orderpriority = '1-URGENT' and o_totalprice > 200000")
    return t.table(spark, d, "customer").join(urgent.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query
def semi_join_known(spark, d):
    late = t.table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return t.table(spark, d, "customer").join(late, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query
def exists_bucket(spark, d):
    return reports.label_quality(t.community_orgs(spark, d), _suspicious(spark, d))


@query
def full_outer_override_merge(spark, d):
    s = t.table(spark, d, "supplier")
    overrides = s.where("s_suppkey % 4 = 0").select(F.expr("concat('p', s_suppkey)").alias("pic"), F.expr("case when s_suppkey % 3 = 0 then '' else concat('m', s_suppkey) end").alias("ror"), F.expr("case when s_suppkey % 8 = 0 then 'checked' else '' end").alias("note"))
    return publish.merge_overrides(t.resolutions(spark, d), overrides).drop("evidence_json")


@query
def likely_wrong_labels(spark, d):
    return reports.likely_wrong(_suspicious(spark, d), t.ror(spark, d))


@query
def review_labels(spark, d):
    found = _suspicious(spark, d)
    return reports.review_rows(found, reports.likely_wrong(found, t.ror(spark, d)))


@query
def conflict_report(spark, d):
    observed = select.settled(_observed(spark, d).drop("evidence_json"))
    direct = _direct(spark, d).withColumn("strategy", F.lit("direct_unique"))
    return reports.conflict_rows(observed, community.against_direct(community.community_counts(observed), direct), direct, t.ror(spark, d))


# --- reports ----------------------------------------------------------------


def _best(spark, d):
    return award_participants_best(spark, d)


def _codes(spark, d):
    best = awards.best_awards(t.projects(spark, d), t.community_awards(spark, d))
    return awards.best_codes(best, t.participants(spark, d), t.community_participants(spark, d), t.resolutions(spark, d))


@query
def community_coverage(spark, d):
    return reports.community_coverage(t.community_awards(spark, d), _codes(spark, d))


@query
def award_coverage(spark, d):
    return reports.award_coverage(t.community_awards(spark, d), _codes(spark, d))


@query
def participant_list_availability(spark, d):
    return reports.availability(community_coverage(spark, d))


@query
def coverage_medians(spark, d):
    return reports.coverage_summary(community_coverage(spark, d))


@query
def award_medians(spark, d):
    return reports.award_summary(award_coverage(spark, d))


@query
def coverage_bins(spark, d):
    return reports.coverage_distribution(community_coverage(spark, d), "high_medium")


@query
def source_bucket(spark, d):
    return reports.coverage_by_source_bucket(community_coverage(spark, d))


@query
def size_bands(spark, d):
    return reports.coverage_by_size(community_coverage(spark, d))


@query
def coordinator_coverage(spark, d):
    return reports.coordinator_coverage(t.community_awards(spark, d), _best(spark, d), community_coverage(spark, d))


@query
def type_occurrences(spark, d):
    return reports.resolved_types(t.community_awards(spark, d), _best(spark, d), t.ror(spark, d))


@query
def openaire_signals(spark, d):
    return reports.openaire_signals(t.orgs(spark, d))


def _queue(spark, d):
    return reports.review_queue(t.participants(spark, d, keep=t.SEEN[2:]), t.resolutions(spark, d), reports.openaire_signals(t.orgs(spark, d)), t.SEEN, sorted(labels.ORIGINS))


@query
def pivot_counts(spark, d):
    return _queue(spark, d).select("pic", "count", "count_fp7", "count_h2020", "count_he")


@query
def review_queue(spark, d):
    return _queue(spark, d)


@query
def queue_totals(spark, d):
    return reports.queue_totals(_queue(spark, d))


def _curve(spark, d):
    return select.running_share(_queue(spark, d).select("pic", "count"), "count", *reports.queue_order())


@query
def cumulative_curve(spark, d):
    queue = _queue(spark, d)
    return select.every_step(_curve(spark, d), queue.count())


@query
def top_n_coverage(spark, d):
    return _curve(spark, d).where(F.col("rank").isin(10, 30, 100, 500, 1000)).select("rank", "cumulative", "share")


@query
def share_of_total(spark, d):
    counts = reports.counts_by(t.resolutions(spark, d), "source")
    total = counts.agg(F.sum("count").alias("total_"))
    return counts.withColumn("one_", F.lit(1)).join(total.withColumn("one_", F.lit(1)), "one_").select("source", "count", (F.col("count") / F.col("total_")).alias("share"))


@query
def top_sources(spark, d):
    return reports.top_sources(t.resolutions(spark, d), 15)


@query
def resolution_confidence(spark, d):
    return reports.counts_by(t.resolutions(spark, d), "confidence")


@query
def summary_counts(spark, d):
    """Rows of every driver table."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
    counted = [t.table(spark, d, n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows")) for n in names]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


@query
def review_statistics(spark, d):
    entries = t.table(spark, d, "part").where("p_partkey % 2 = 0").select(F.expr("concat('p', p_partkey)").alias("pic"), F.expr("case when p_partkey % 3 = 0 then '' else 'r' end").alias("ror"), F.expr("case when p_partkey % 5 = 0 then 'Generalized to parent body' else '' end").alias("reasoning"))
    return reports.review_statistics(entries, _queue(spark, d))


# --- more functions and reports ----------------------------------------------


@query
def domains_of_urls(spark, d):
    """Distinct hosts of an array of URLs, a row a second-level label."""
    pages = t.table(spark, d, "pages").groupBy((F.col("page_id") % 20).alias("bucket")).agg(F.array_sort(F.collect_list("url")).alias("urls"))
    return pages.select("bucket", F.array_join(text.domains_of(F.col("urls")), "|").alias("domains"))


def _identifiers(p):
    return p.withColumn("ids", F.expr("array(named_struct('scheme', 'isni', 'identifier', p_brand), named_struct('scheme', case when p_partkey % 2 = 0 then 'ror' else 'url' end, 'identifier', concat('https://x/', p_partkey)), named_struct('scheme', 'ror', 'identifier', 'https://ror.org/later'))"))


@query
def first_identifiers(spark, d):
    """Award URLs and community registry ids: the first identifier of a scheme."""
    p = _identifiers(t.parts(spark, d))
    top = F.expr("case when p_partkey % 5 = 0 then lpad(p_partkey, 9, '0') else p_name end")
    return p.select("p_partkey", text.first_identifier(F.col("ids"), "url").alias("award_url"), text.community_ror_id(top, F.col("ids")).alias("ror_id"))


@query
def registry_fields(spark, d):
    """Display name, country and external ids as the registry's records hold them."""
    from tessera.sources.organizations import registry_table

    record = F.expr(
        """concat('{"id": "https://ror.org/r', p_partkey, '/", "names": [{"value": "', p_brand, '", "types": ["alias"]}, {"value": " ', p_name, ' ", "types": ["', case when p_partkey % 2 = 0 then 'label' else 'alias' end, '"]}],'
        , ' "locations": [{"geonames_details": {"country_code": ""}}, {"geonames_details": {"country_code": "', p_type, '"}}],'
        , ' "external_ids": [{"type": "grid", "all": ', case when p_partkey % 3 = 0 then '["Grid.A", "grid.b"]' else '"GRID.C"' end, ', "preferred": null}]}')"""
    )
    out = registry_table(t.parts(spark, d).select(record.alias("value")))
    return out.select("ror_id", "display_name", "country_code", F.array_join("names", "|").alias("names"), F.array_join("normalized_names", "|").alias("normalized_names"), F.array_join("grid_ids", "|").alias("grid_ids"))


@query
def matching_names(spark, d):
    """The first raw registry name of each normalized one."""
    from tessera.operators.evidence import named_targets

    return named_targets(t.ror(spark, d)).select("ror_id", F.col("s_normalized").alias("normalized"), F.col("t_matching").alias("name"))


@query
def group_supports(spark, d):
    """Which rules back each target, by code and signal."""
    found, _ = _event_signals(spark, d)
    return found.groupBy("pic", "group", "ror_id").agg(F.array_join(F.array_sort(F.collect_set("supporter")), "|").alias("supporters"))


@query
def resolver_signals(spark, d):
    """Each code's single target by signal, before the chain."""
    found, observed = _event_signals(spark, d)
    out = resolve.signals(found, observed)
    return out.select("pic", *resolve.SIGNALS, "community", "community_count", F.array_join(F.array_sort("direct_ambiguous"), "|").alias("ambiguous"))


@query
def rule_labels(spark, d):
    """Texts of strategies, groups and sources, unknown codes included."""
    found, observed = _event_signals(spark, d)
    chosen = resolve.decide(resolve.signals(found, observed))
    return chosen.select("source", "confidence").distinct().select("source", "confidence", labels.lookup(F.col("source"), labels.SOURCES).alias("label"))


@query
def conditional_distinct_counts(spark, d):
    """Distinct customers: all, urgent, urgent or high, with a large order."""
    o = t.table(spark, d, "orders")
    hit = lambda cond: F.countDistinct(F.when(cond, F.col("o_custkey")))
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return o.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("customers"), hit(urgent).alias("urgent"), hit(high).alias("urgent_high"), hit(F.col("o_totalprice") > 200000).alias("large"))


@query
def curve_sample(spark, d):
    """What a slider shows: the first sample at or after a rank, else the last."""
    parts_ = [select.sample_at_or_after(_curve(spark, d), n).select(F.lit(n).alias("n"), "rank", "cumulative") for n in (7, 100, 1000000)]
    return parts_[0].unionByName(parts_[1]).unionByName(parts_[2])


@query
def label_review_summary(spark, d):
    found = _suspicious(spark, d)
    wrong = reports.likely_wrong(found, t.ror(spark, d))
    rest = reports.review_rows(found, wrong)
    count = lambda df, name: df.agg(F.lit(name).alias("kind"), F.count("*").alias("n_rows"), F.countDistinct("slug").alias("n_communities"))
    return count(found, "suspicious").unionByName(count(wrong, "likely_wrong")).unionByName(count(rest, "review"))
