"""The queries of bindings in SQL, where SQL can express them."""

from __future__ import annotations

from tessera.functions import labels, text
from tessera.plans.standins import sql_norm, sql_token_sort, with_tables

_GENERIC = ", ".join(f"'{w}'" for w in (*text.CORPORATE_SUFFIXES, *text.GENERIC_NAMES))


def _alias(name: str) -> str:
    return f"({name} <> '' and {name} not in ({_GENERIC}) and (contains({name}, ' ') or length({name}) >= 4))"


_DOMAIN = r"""regexp_replace(regexp_replace(string_split(string_split(lower(regexp_extract(case when contains(url, '://') then url else 'https://' || url end, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '@')[-1], ':')[1], '^\.+|\.+$', '', 'g'), '^www\.', '')"""

_EVENTS = """select concat(user_id, '-', day(ts)) as pic, 'r' || (k % 3) as ror_id, event_type, event_id, k,
    case event_type when 'click' then case when k % 2 = 0 then 'direct_unique' else 'direct_ambiguous' end when 'view' then 'external' when 'purchase' then 'domain' when 'signup' then case when k % 5 < 2 then 'exact_name' when k % 5 < 4 then 'token_sort' else 'fuzzy_name' end end as grp,
    (case when k % 2 = 0 then 'openaire' else 'participant' end) as side
    from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events)"""


def _one(group: str) -> str:
    only = f"case when grp = '{group}' then ror_id end"
    return f"coalesce(case when min({only}) = max({only}) then min({only}) end, '') as {group}"


def _side(group: str, both: str, own: str, other: str) -> str:
    return f"case {group}_sides when 'openaire' then '{own}' when 'participant' then '{other}' else '{both}' end"


_CHAIN = [
    ("direct_unique <> ''", "direct_unique", "high", "'openaire_direct'", "OpenAIRE carries exactly one direct PIC->ROR link."),
    ("community <> '' and community in (external, domain, exact_name, token_sort)", "community", "high", "'community_supported'", "Stable community evidence agrees with another unique candidate."),
    ("external <> '' and list_contains(ambiguous, external)", "external", "medium", "'openaire_ambiguous_external'", "Direct OpenAIRE ROR list is ambiguous, but external ids pick one candidate."),
    ("domain <> '' and list_contains(ambiguous, domain)", "domain", "medium", "'openaire_ambiguous_domain'", "Direct OpenAIRE ROR list is ambiguous, but the website domain picks one candidate."),
    ("exact_name <> '' and list_contains(ambiguous, exact_name)", "exact_name", "medium", "'openaire_ambiguous_exact_name'", "Direct OpenAIRE ROR list is ambiguous, but exact same-country name evidence picks one candidate."),
    ("token_sort <> '' and list_contains(ambiguous, token_sort)", "token_sort", "review", "'openaire_ambiguous_token_sort'", "Direct OpenAIRE ROR list is ambiguous, and token-sort evidence picks one candidate."),
    ("fuzzy_name <> '' and list_contains(ambiguous, fuzzy_name)", "fuzzy_name", "review", "'openaire_ambiguous_fuzzy_name'", "Direct OpenAIRE ROR list is ambiguous, and close same-country name evidence picks one candidate."),
    ("external <> '' and external = domain", "external", "medium", "'openaire_external_domain'", "External ids and website domain agree on one ROR."),
    ("external <> '' and external = exact_name", "external", "medium", "'openaire_external_name'", "External ids and exact same-country name evidence agree on one ROR."),
    ("domain <> '' and domain = exact_name", "domain", "medium", "'openaire_domain_name'", "Website domain and exact same-country name evidence agree on one ROR."),
    ("domain <> '' and domain = fuzzy_name", "domain", "medium", "'openaire_domain_fuzzy_name'", "Website domain and close same-country name evidence agree on one ROR."),
    ("community <> '' and community_count >= 2", "community", "medium", "'community_repeat'", "The same community-derived mapping repeats across at least two observations."),
    ("external <> ''", "external", "review", "'openaire_external'", "External identifiers map uniquely to one ROR."),
    ("domain <> ''", "domain", "review", "'openaire_domain'", "Website domain maps uniquely to one ROR."),
    ("exact_name <> ''", "exact_name", "review", _side("exact_name", "exact_name", "openaire_name_country", "participant_name_country"), "Exact same-country name evidence points to one ROR."),
    ("token_sort <> ''", "token_sort", "review", _side("token_sort", "token_sort_name", "openaire_token_sort_name", "participant_token_sort_name"), "Token-sort exact name evidence points to one ROR."),
    ("fuzzy_name <> ''", "fuzzy_name", "review", _side("fuzzy_name", "fuzzy_name", "openaire_fuzzy_name", "participant_fuzzy_name"), "Close same-country name evidence points to one ROR."),
    ("community <> ''", "community", "review", "'community_single'", "A single stable community-derived mapping exists."),
]


def _case(pick) -> str:
    return "case " + " ".join(f"when {rule[0]} then {pick(rule)}" for rule in _CHAIN) + " end"


_GROUPS = ("direct_unique", "external", "domain", "exact_name", "token_sort", "fuzzy_name")
_RESOLUTION = f"""with e as ({_EVENTS}),
    g as (select pic, {", ".join(_one(n) for n in _GROUPS)}, list(distinct ror_id) filter (grp = 'direct_ambiguous') as amb,
        {", ".join(f"string_agg(distinct side, ',' order by side) filter (grp = '{n}') as {n}_sides" for n in _GROUPS[3:])} from e where event_type <> 'error' group by 1),
    c as (select pic, min(ror_id) as community, count(*) as community_count from e where event_type = 'error' group by 1 having min(ror_id) = max(ror_id)),
    j as (select pic, {", ".join(f"coalesce({n}, '') as {n}" for n in _GROUPS)}, coalesce(amb, []) as ambiguous, {", ".join(f"{n}_sides" for n in _GROUPS[3:])},
        coalesce(community, '') as community, coalesce(community_count, 0) as community_count from g full outer join c using (pic))
    select pic, {_case(lambda r: r[1])} as ror_id, {_case(lambda r: f"'{r[2]}'")} as confidence, {_case(lambda r: r[3])} as source, {_case(lambda r: f"'{r[4]}'")} as reason
    from j where {_case(lambda r: r[1])} is not null"""

_CONFIDENCE = "case strategy " + " ".join(f"when '{s}' then '{c}'" for s, c in labels.CONFIDENCE.items()) + " end"
_NOT_DIRECT = "record_id in (select record_id from orgs where len(rors) <> 1)"
_ALIAS_VOTE = f"""select record_id, min(ror_id) as ror_id, array_to_string(list_sort(list(distinct raw)), '|') as matched_names from (
    select record_id, raw, {sql_norm("raw")} as name, country from (select record_id, unnest(alt_names) as raw, country_code as country from orgs)) join name_index using (name, country)
    where {_alias("name")} and country <> '' group by 1 having min(ror_id) = max(ror_id)"""
_SHORT_VOTE = f"""select record_id, ror_id from (select record_id, {sql_norm("legal_short_name")} as name, country_code as country from orgs) join name_index using (name, country) where {_alias("name")} and country <> ''"""
_CANDIDATES = f"""select pic, ror_id, strategy, {_CONFIDENCE} as confidence, record_id as source_record_id from (
    select record_id, unnest(rors) as ror_id, case when len(rors) = 1 then 'direct_unique' else 'direct_ambiguous' end as strategy from orgs
    union all select record_id, ror_id, 'external_id_unique' from external_vote where {_NOT_DIRECT}
    union all select record_id, ror_id, 'domain_unique' from domain_vote where {_NOT_DIRECT}
    union all select record_id, ror_id, 'name_country_unique' from name_vote where {_NOT_DIRECT}
    union all select record_id, ror_id, 'short_name_country_unique' from ({_SHORT_VOTE}) where {_NOT_DIRECT}
    union all select record_id, ror_id, 'alt_name_country_unique' from ({_ALIAS_VOTE}) where {_NOT_DIRECT}
    union all select record_id, ror_id, 'token_sort_name_country_unique' from (select record_id, ror_id from token_vote except select record_id, ror_id from name_vote) where {_NOT_DIRECT})
    join (select record_id, unnest(pics) as pic from orgs) using (record_id)"""

_PCT = "100.0 * {} / participants"
_HM, _ANY = _PCT.format("high_medium"), _PCT.format('"any"')
_BIN = f"case when {_HM} = 0 then '0%' when {_HM} <= 20 then '>0-20%' when {_HM} <= 40 then '>20-40%' when {_HM} <= 60 then '>40-60%' when {_HM} <= 80 then '>60-80%' when {_HM} < 100 then '>80-<100%' else '100%' end"
_BINS = "(values (0, '0%'), (1, '>0-20%'), (2, '>20-40%'), (3, '>40-60%'), (4, '>60-80%'), (5, '>80-<100%'), (6, '100%')) as b(position, bin)"
_BAND = "case when participants <= 5 then '1-5' when participants <= 10 then '6-10' when participants <= 20 then '11-20' when participants <= 40 then '21-40' else '41+' end"
_RANKED = f"select pic, count, cast(row_number() over w as bigint) as rank, cast(sum(count) over (order by count desc, pic rows between unbounded preceding and current row) as bigint) as cumulative, (sum(count) over (order by count desc, pic rows between unbounded preceding and current row)) / (select sum(count) from queue)::double as share from queue window w as (order by count desc, pic)"


def _first_mode(value: str, name: str) -> str:
    """Most frequent value of a code, ties to the first seen."""
    return f"""(select pic, {value} as {name} from (select *, row_number() over (partition by pic order by n desc, a, o, p) as k from (
        select pic, {value}, max(c) as n, min(award_number) as a, arg_min(origin, place) as o, arg_min(participant_order, place) as p from (
        select *, count(*) over (partition by pic, {value}) as c, row_number() over (partition by pic, {value} order by award_number, origin, participant_order) as place from participants where {value} <> '') group by 1, 2)) where k = 1)"""


_SIGNALS = """select pic, array_to_string(list_slice(list_sort(list_distinct(flatten(list(alt_names)))), 1, 5), '|') as openaire_alt_names,
    array_to_string(list_sort(list_distinct(flatten(list(ids)))), '|') as openaire_external_ids from (select unnest(pics) as pic, alt_names,
    list_concat(list_concat(list_transform(wikidata_ids, lambda x: 'wikidata:' || x), list_transform(grid_ids, lambda x: 'grid:' || x)), list_transform(isni_ids, lambda x: 'isni:' || x)) as ids from orgs) group by 1"""
_ORIGIN_COUNTS = "select pic, count(*) as count, count(*) filter (origin = 'FP7') as count_fp7, count(*) filter (origin = 'H2020') as count_h2020, count(*) filter (origin = 'HE') as count_he from participants where pic in (select pic from queue) group by 1"
_LIKELY = f"""select s.slug, s.org_order, s.name, s.normalized_name, s.ror_id, s.ror_display_name, s.reason, cast(count(*) as integer) as other_ror_count,
    string_agg(r.ror_id || ' (' || r.display_name || ', ' || r.country_code || ')', ' | ' order by r.ror_id, r.display_name, r.country_code) as other_rors
    from suspicious s join name_pairs n on n.name = s.normalized_name join ror r on r.ror_id = n.ror_id
    where r.ror_id <> s.ror_id and {sql_norm("s.ror_display_name")} <> s.normalized_name group by all"""

_QUERIES = {
    "normalize_name": f"select p_partkey, {sql_norm("'  ' || upper(p_name) || ' & ' || p_brand || ', Inc. GmbH'")} as normalized from part",
    "token_sort_key": f"select p_partkey, {sql_token_sort(sql_norm('display'))} as token_key from parts",
    "corporate_suffix_strip": f"select p_partkey, {sql_norm("p_name || ' ' || ['GmbH', 'Co. KG', 'S.A.', 'Ltd Inc', 'SA', 'group'][cast(p_partkey % 6 as integer) + 1]")} as normalized from part",
    "normalize_domain": f"select page_id, {_DOMAIN} as domain from pages",
    "identifier_functions": r"""select p_partkey, trim(string_split(regexp_replace(raw, '/+$', ''), '/')[-1]) as short_id, case when trim(raw) = '' then 'none' when starts_with(trim(raw), 'edmo:') then 'edmo' when regexp_full_match(trim(raw), '[0-9a-z]{9}') then 'ror' else 'other' end as kind,
        regexp_full_match(raw, '[0-9a-z]{9}') as ror_shaped, replace(lower(trim(' 0000 ' || p_brand || ' X ')), ' ', '') as isni from (
        select *, case p_partkey % 4 when 0 then 'https://ror.org/' || lpad(cast(p_partkey as varchar), 9, '0') || '/' when 1 then lpad(cast(p_partkey as varchar), 9, 'a') when 2 then 'edmo:' || p_partkey else '  ' end as raw from part)""",
    "meaningful_names": f"""select p_partkey, {_alias("n")} as as_alias, {_alias("n")} and (contains(n, ' ') or length(n) >= 8) as as_fuzzy from (
        select p_partkey, {sql_norm("case p_partkey % 5 when 0 then 'University' when 1 then substring(p_name, 1, 3) when 2 then string_split(p_name, ' ')[1] when 3 then 'GmbH' else p_name end")} as n from part)""",
    "lateral_json_each": "select event_id, unnest([event_type, cast(user_id as varchar)]) as member from events",
    "localized_titles": "select p_partkey, case p_partkey % 3 when 2 then p_brand else p_name end as title from part",
    "unique_name_country": "select record_id, ror_id from name_vote",
    "vote_external_ids": "select record_id, ror_id from external_vote",
    "vote_domains": "select record_id, ror_id from domain_vote",
    "alias_vote": _ALIAS_VOTE,
    "token_sort_unique": "select record_id, ror_id from token_vote",
    "fuzzy_block_join": """select country_code, block, count(*) as n_names from (select country_code, unnest(list_distinct(['compact:' || substring(replace(n, ' ', ''), 1, 6), 'first:' || substring(string_split(n, ' ')[1], 1, 4), 'last:' || substring(string_split(n, ' ')[-1], 1, 4)])) as block
        from (select distinct unnest(normalized_names) as n, country_code from ror) where n <> '') group by 1, 2""",
    "openaire_exact_candidates": _CANDIDATES,
    "suspicious_orgs": "select slug, org_order, name, normalized_name, ror_id, ror_display_name, reason from suspicious",
    "community_observations": "select pic, ror_id, slug, award_number, participant_name, community_org_name from observed",
    "stable_vs_ambiguous": "select pic, ror_id, observation_count, slug_count, award_count, community_status from observed_counts",
    "agrees_conflicts": "select * from community_matches",
    "rule_chain_resolution": _RESOLUTION,
    "first_per_key": "select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as n from orders) where n = 1",
    "best_by_priority": "select * from best_awards",
    "modal_value": """select l_suppkey, m as modal from (select *, row_number() over (partition by l_suppkey order by n desc, a, b, c, e, m) as k from (
        select l_suppkey, m, count(*) as n, min(l_orderkey) as a, arg_min(l_linenumber, place) as b, arg_min(l_partkey, place) as c, arg_min(l_extendedprice, place) as e from (
        select *, row_number() over (partition by l_suppkey, m order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as place from (select *, l_returnflag || l_linestatus || cast(cast(l_quantity as integer) as varchar) as m from lineitem)) group by 1, 2)) where k = 1""",
    "min_count_per_pair": "select o_custkey, o_orderpriority, min(o_orderkey) as o_orderkey, count(*) as seen from orders group by 1, 2",
    "renumbered_participants": "select award_number, pic, participant_name, participant_order from modal_participants",
    "award_participants_best": "select * from best_participants",
    "posexplode_before_filter": "select vec_id, cast(ordinal as integer) as ordinal from (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as ordinal from embeddings) where x > 0.2",
    "duplicate_keys": "select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1",
    "anti_join_unseen": "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 200000)",
    "semi_join_known": "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'F')",
    "exists_bucket": "select case when ror_id = '' then 'no_ror' when exists (select 1 from suspicious s where s.slug = c.slug and s.org_order = c.org_order) then 'suspicious' else 'self_consistent' end as bucket, count(*) as count from community_orgs c group by 1",
    "full_outer_override_merge": """select pic, case when ror is not null then ror else ror_id end as ror_id, case when ror is not null then 'manual' else confidence end as confidence, case when ror is not null then 'manual_override' else source end as source,
        case when ror is not null and note <> '' then note end as override_note from resolutions full outer join (
        select 'p' || s_suppkey as pic, case when s_suppkey % 3 = 0 then '' else 'm' || s_suppkey end as ror, case when s_suppkey % 8 = 0 then 'checked' else '' end as note from supplier where s_suppkey % 4 = 0) using (pic)
        where (ror is not null and ror <> '') or (ror is null and confidence in ('high', 'medium'))""",
    "likely_wrong_labels": _LIKELY,
    "review_labels": f"select slug, org_order, name, normalized_name, ror_id, ror_display_name, reason from suspicious where (slug, org_order) not in (select (slug, org_order) from ({_LIKELY}))",
    "conflict_report": """select o.slug, o.pic, o.participant_name, o.community_org_name, o.ror_id as community_ror_id, r.display_name as community_ror_name, d.ror_id as openaire_ror_id, e.display_name as openaire_ror_name
        from observed o join community_matches m on m.pic = o.pic and m.ror_id = o.ror_id join direct_links d on d.pic = o.pic left join ror r on r.ror_id = o.ror_id left join ror e on e.ror_id = d.ror_id where m.conflicts_with_openaire_direct = 1""",
    "community_coverage": "select * from community_coverage",
    "award_coverage": "select * from award_coverage",
    "participant_list_availability": "select count(*) filter (participants > 0) as communities_with_participants, count(*) filter (participants = 0) as communities_without_participants, round_even(100.0 * count(*) filter (participants > 0) / count(*), 1) as pct_with_participants from community_coverage",
    "coverage_medians": f"select median({_PCT.format('high')}) as median_high_pct, median({_HM}) as median_high_medium_pct, median({_ANY}) as median_any_pct from community_coverage where participants > 0",
    "award_medians": f"select count(*) filter (participants > 0) as awards_with_participants, count(*) filter (participants = 0) as awards_without_participants, median({_HM}) filter (participants > 0) as median_high_medium_pct, median({_ANY}) filter (participants > 0) as median_any_pct from award_coverage",
    "coverage_bins": f"select bin, coalesce(n, 0) as n, cast(position as integer) as position from {_BINS} left join (select {_BIN} as bin, count(*) as n from community_coverage where participants > 0 group by 1) using (bin)",
    "source_bucket": f"""select source_bucket, cast(position as integer) as position, coalesce(communities, 0) as communities, coalesce(with_participants, 0) as with_participants, median_participants, median_hm_pct, median_any_pct
        from (values (0, 'cordis'), (1, 'community'), (2, 'mixed'), (3, 'none')) as b(position, source_bucket) left join (select source_bucket, count(*) as communities, count(*) filter (participants > 0) as with_participants,
        median(participants) filter (participants > 0) as median_participants, median({_HM}) filter (participants > 0) as median_hm_pct, median({_ANY}) filter (participants > 0) as median_any_pct from community_coverage group by 1) using (source_bucket)""",
    "size_bands": f"""select band, cast(position as integer) as position, coalesce(communities, 0) as communities, median_total_participants, median_resolved_count_any, median_hm_pct, median_any_pct
        from (values (0, '1-5'), (1, '6-10'), (2, '11-20'), (3, '21-40'), (4, '41+')) as b(position, band) left join (select {_BAND} as band, count(*) as communities, median(participants) as median_total_participants, median("any") as median_resolved_count_any,
        median({_HM}) as median_hm_pct, median({_ANY}) as median_any_pct from community_coverage where participants > 0 group by 1) using (band)""",
    "coordinator_coverage": """select count(*) as communities_with_cordis_participants, count(some_) as communities_with_any_coordinator_row, count(*) filter (hm_) as communities_with_resolved_coordinator_hm, count(*) filter (some_) as communities_with_resolved_coordinator_any,
        case when count(some_) = 0 then 0.0 else round_even(100.0 * count(*) filter (hm_) / count(some_), 1) end as pct_with_resolved_coordinator_hm, case when count(some_) = 0 then 0.0 else round_even(100.0 * count(*) filter (some_) / count(some_), 1) end as pct_with_resolved_coordinator_any
        from (select slug from community_coverage where source_bucket = 'cordis') left join (select slug, bool_or(ror_id <> '') as some_, bool_or(ror_id <> '' and resolution_confidence in ('high', 'medium')) as hm_
        from active_awards join best_participants using (award_number) where source = 'cordis' and participant_type = 'coordinator' group by 1) using (slug)""",
    "type_occurrences": """select coalesce(o.ror_type, u.ror_type) as ror_type, coalesce(occurrences, 0) as occurrences, coalesce(unique_pic, 0) as unique_pic from (
        select coalesce(r.ror_type, 'Unknown') as ror_type, count(*) as occurrences from best_participants b join community_awards a using (award_number) left join ror r on r.ror_id = b.ror_id where not a.is_deleted and b.ror_id <> '' group by 1) o
        full outer join (select coalesce(r.ror_type, 'Unknown') as ror_type, count(*) as unique_pic from (select distinct pic, ror_id from best_participants where ror_id <> '' and award_number in (select award_number from active_awards)) b left join ror r on r.ror_id = b.ror_id group by 1) u on u.ror_type = o.ror_type""",
    "openaire_signals": _SIGNALS,
    "pivot_counts": _ORIGIN_COUNTS,
    "review_queue": f"""select c.pic, c.count, count_fp7, count_h2020, count_he, coalesce(country, '') as country, coalesce(s.short_name, '') as short_name, coalesce(l.legal_name, '') as legal_name, coalesce(w.website_url, '') as website_url,
        coalesce(openaire_alt_names, '') as openaire_alt_names, coalesce(openaire_external_ids, '') as openaire_external_ids, coalesce(r.ror_id, '') as pipeline_ror, coalesce(r.confidence, '') as pipeline_confidence, coalesce(r.source, '') as pipeline_source
        from ({_ORIGIN_COUNTS}) c left join {_first_mode("country_code", "country")} k using (pic) left join {_first_mode("short_name", "short_name")} s using (pic) left join {_first_mode("legal_name", "legal_name")} l using (pic)
        left join {_first_mode("website_url", "website_url")} w using (pic) left join ({_SIGNALS}) g using (pic) left join (select * from resolutions where confidence not in ('high', 'medium')) r using (pic)""",
    "queue_totals": "select count(*) as pics, cast(sum(count) as bigint) as appearances, count(*) filter (r.ror_id is not null) as with_candidate, count(*) filter (r.ror_id is null) as without_candidate from queue left join (select * from resolutions where confidence not in ('high', 'medium')) r using (pic)",
    "cumulative_curve": f"select pic, count, rank, cumulative, share from ({_RANKED}) where rank = 1 or rank = (select count(*) from queue) or rank % greatest(1, (select count(*) from queue) // 200) = 0",
    "top_n_coverage": f"select rank, cumulative, share from ({_RANKED}) where rank in (10, 30, 100, 500, 1000)",
    "share_of_total": "select source, count(*) as count, count(*) / (select count(*) from resolutions)::double as share from resolutions group by 1",
    "top_sources": "select source, count(*) as count from resolutions group by 1 order by 2 desc, 1 limit 15",
    "resolution_confidence": "select confidence, count(*) as count from resolutions group by 1",
    "summary_counts": " union all ".join(f"select '{n}' as table_name, count(*) as n_rows from {n}" for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")),
    "review_statistics": """select count(*) as total, count(*) filter (ror <> '') as accepted, count(*) filter (ror = '') as unresolved, count(*) filter (ror <> '' and reasoning <> '') as generalized,
        (select cast(coalesce(sum(count), 0) as bigint) from queue where pic in (select 'p' || p_partkey from part where p_partkey % 2 = 0 and p_partkey % 3 <> 0)) as appearances_covered, (select cast(sum(count) as bigint) from queue) as total_unresolved_appearances
        from (select 'p' || p_partkey as pic, case when p_partkey % 3 = 0 then '' else 'r' end as ror, case when p_partkey % 5 = 0 then 'x' else '' end as reasoning from part where p_partkey % 2 = 0)""",
    "domains_of_urls": f"select bucket, array_to_string(list_sort(list(distinct domain)), '|') as domains from (select page_id % 20 as bucket, {_DOMAIN} as domain from pages) where domain <> '' group by 1",
    "first_identifiers": "select p_partkey, case when p_partkey % 2 = 1 then 'https://x/' || p_partkey else '' end as award_url, case when p_partkey % 5 = 0 then lpad(cast(p_partkey as varchar), 9, '0') when p_partkey % 2 = 0 then cast(p_partkey as varchar) else 'later' end as ror_id from part",
    "registry_fields": f"""select 'r' || p_partkey as ror_id, case when p_partkey % 2 = 0 then p_name else p_brand end as display_name, p_type as country_code, array_to_string(list_sort([p_brand, p_name]), '|') as names,
        array_to_string(list_sort([{sql_norm("p_brand")}, {sql_norm("p_name")}]), '|') as normalized_names, case when p_partkey % 3 = 0 then 'grid.a|grid.b' else 'grid.c' end as grid_ids from part""",
    "matching_names": f"select ror_id, {sql_norm('raw')} as normalized, min(raw) as name from (select ror_id, unnest(names) as raw from ror) group by 1, 2",
    "group_supports": f"""select pic, grp as "group", ror_id, array_to_string(list_sort(list(distinct side || ':' || rule)), '|') as supporters from (
        select *, case when k % 5 < 2 then case when k % 2 = 0 then 'name_country_unique' else 'participant_name_country_unique' end when k % 5 < 4 then case when k % 2 = 0 then 'token_sort_name_country_unique' else 'participant_token_sort_name_country_unique' end
        else case when k % 2 = 0 then 'fuzzy_name_country_unique' else 'participant_fuzzy_name_country_unique' end end as rule from ({_EVENTS})) where event_type <> 'error' group by 1, 2, 3""",
    "resolver_signals": f"""select pic, {", ".join(f"coalesce({n}, '') as {n}" for n in _GROUPS)}, coalesce(community, '') as community, coalesce(community_count, 0) as community_count, coalesce(array_to_string(list_sort(amb), '|'), '') as ambiguous from (
        select pic, {", ".join(_one(n) for n in _GROUPS)}, list(distinct ror_id) filter (grp = 'direct_ambiguous') as amb from ({_EVENTS}) where event_type <> 'error' group by 1)
        full outer join (select pic, min(ror_id) as community, count(*) as community_count from ({_EVENTS}) where event_type = 'error' group by 1 having min(ror_id) = max(ror_id)) using (pic)""",
    "rule_labels": f"select distinct source, confidence, case source {' '.join(f"when '{k}' then '{v}'" for k, v in labels.SOURCES.items())} else replace(source, '_', ' ') end as label from ({_RESOLUTION})",
    "conditional_distinct_counts": "select o_orderstatus, count(distinct o_custkey) as customers, count(distinct o_custkey) filter (o_orderpriority = '1-URGENT') as urgent, count(distinct o_custkey) filter (o_orderpriority in ('1-URGENT', '2-HIGH')) as urgent_high, count(distinct o_custkey) filter (o_totalprice > 200000) as large from orders group by 1",
    "curve_sample": f"with c as ({_RANKED}) select cast(n as integer) as n, rank, cumulative from (values (7), (100), (1000000)) v(n) join c on c.rank = coalesce((select min(rank) from c c2 where c2.rank >= v.n), (select max(rank) from c c3))",
    "label_review_summary": f"""select 'suspicious' as kind, count(*) as n_rows, count(distinct slug) as n_communities from suspicious union all select 'likely_wrong', count(*), count(distinct slug) from ({_LIKELY})
        union all select 'review', count(*), count(distinct slug) from suspicious where (slug, org_order) not in (select (slug, org_order) from ({_LIKELY}))""",
}


ORACLES = {name: with_tables(sql) for name, sql in _QUERIES.items()}
