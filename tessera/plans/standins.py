"""Stand-ins for the source dumps, made of the driver tables.

The dumps themselves aren't at hand, so each stored table gets a binding to a driver
table with the same shape: parts are registry entries, orders are records and awards,
line items are participants. SQL[name] is the same table in SQL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators.select import unbroadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return unbroadcast(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def norm(column: Column) -> Column:
    """normalize_name of names that are ASCII, as all of the parts' are."""
    return text.normalize_name(column, ascii_input=True)


def sql_norm(expression: str) -> str:
    run = "(?:(?:^| )(?:" + "|".join(text.CORPORATE_SUFFIXES) + "))+$"
    words = f"trim(regexp_replace(replace(lower({expression}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
    return f"regexp_replace({words}, '{run}', '')"


def sql_token_sort(expression: str) -> str:
    return f"coalesce(array_to_string(list_sort(list_filter(string_split({expression}, ' '), lambda t: t <> '')), ' '), '')"


_DISPLAY = "concat(p_name, ' ', p_brand, ' ', p_size)"
_NONE = "cast(array() as array<string>)"


def parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").withColumn("display", F.expr(_DISPLAY))


def ror(spark: SparkSession, d: str) -> DataFrame:
    """Registry: a name and an alias an entry; some names, domains and ids are shared."""
    p = parts(spark, d).withColumn("alias", F.expr("concat(p_brand, ' ', p_name, ' Holding ', p_partkey % 7, ' Ltd')"))
    names = F.array_sort(F.array("display", "alias"))
    return p.select(
        F.expr("concat('r', p_partkey)").alias("ror_id"),
        F.col("display").alias("display_name"),
        F.col("p_type").alias("country_code"),
        names.alias("names"),
        F.array_sort(F.array_distinct(F.transform(names, norm))).alias("normalized_names"),
        F.expr("array(concat(lower(replace(p_brand, '#', '')), '-', p_partkey % 97, '.example.org'))").alias("domains"),
        F.expr(_NONE).alias("website_links"),
        F.expr("array(concat('grid.', p_partkey % 1500))").alias("grid_ids"),
        F.expr("array(concat('isni', p_partkey))").alias("isni_ids"),
        F.expr("array(concat('q', p_partkey % 700))").alias("wikidata_ids"),
        F.expr(_NONE).alias("fundref_ids"),
        F.expr("array(lower(p_type))").alias("types"),
    )


def orgs(spark: SparkSession, d: str) -> DataFrame:
    """Records: an order of the customer whose number is the part's."""
    o = table(spark, d, "orders").join(parts(spark, d), F.col("o_custkey") == F.col("p_partkey"))
    legal = F.expr("case o_orderkey % 6 when 0 then concat(upper(p_name), ' ', p_brand, ' ', p_size) when 1 then concat(p_size, ' ', p_brand, ' ', p_name) when 2 then concat(p_name, 's ', p_brand, ' ', p_size) else concat('Unknown ', o_orderkey) end")
    o = o.withColumn("legal_name", legal)
    return o.select(
        F.expr("concat('o', o_orderkey)").alias("record_id"),
        "legal_name",
        norm(F.col("legal_name")).alias("normalized_name"),
        F.expr("case when o_orderkey % 7 = 0 then display else '' end").alias("legal_short_name"),
        F.expr(f"case when o_orderkey % 5 = 0 then array(display, 'zz') else {_NONE} end").alias("alt_names"),
        F.col("p_type").alias("country_code"),
        F.lit("").alias("website_url"),
        F.expr(f"case when o_orderkey % 4 = 0 then array(concat(lower(replace(p_brand, '#', '')), '-', p_partkey % 97, '.example.org')) else {_NONE} end").alias("domains"),
        F.expr("array(concat('p', o_orderkey % 4000))").alias("pics"),
        F.expr(f"case when o_orderkey % 9 = 0 then array(concat('r', p_partkey)) when o_orderkey % 11 = 0 then array(concat('r', p_partkey), concat('r', p_partkey + 1)) else {_NONE} end").alias("rors"),
        F.expr(f"case when o_orderkey % 3 = 0 then array(concat('grid.', p_partkey % 1500)) else {_NONE} end").alias("grid_ids"),
        F.expr(f"case when o_orderkey % 8 = 0 then array(concat('isni', p_partkey)) else {_NONE} end").alias("isni_ids"),
        F.expr(f"case when o_orderkey % 2 = 0 then array(concat('q', p_partkey % 700)) else {_NONE} end").alias("wikidata_ids"),
        F.expr(_NONE).alias("fundref_ids"),
    )


def projects(spark: SparkSession, d: str) -> DataFrame:
    """Official projects: a row an award and origin."""
    o = table(spark, d, "orders").where("o_orderkey % 2 = 0")
    origin = F.expr("case o_orderstatus when 'F' then 'HE' when 'O' then 'H2020' else 'FP7' end")
    rows = o.groupBy(F.expr("concat('a', o_orderkey % 3000)").alias("award_number"), origin.alias("origin")).agg(F.min("o_orderkey").alias("k"))
    return rows.select("award_number", "origin", F.expr("concat('acr', k)").alias("acronym"), F.expr("concat('Project ', k)").alias("title"), F.lit("prog").alias("programme"), F.expr("concat('https://p.example/', award_number)").alias("project_url"), F.lit("").alias("project_website"))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").join(parts(spark, d), F.col("l_partkey") == F.col("p_partkey"))


_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


#: The order of participants, as participant_order numbers them: without the numbers, nothing is sorted for it.
SEEN = ("award_number", "origin", *_LINE_ORDER)


def participants(spark: SparkSession, d: str, keep: Sequence[str] = ()) -> DataFrame:
    """keep: columns of SEEN beside the table's own."""
    l = _lines(spark, d).withColumn("award_number", F.expr("concat('a', l_orderkey % 3000)")).withColumn("origin", F.expr("case l_returnflag when 'A' then 'HE' when 'N' then 'H2020' else 'FP7' end"))
    place = F.row_number().over(Window.partitionBy("award_number", "origin").orderBy(*_LINE_ORDER))
    l = l.withColumn("participant_order", place).withColumn("legal_name", F.expr("case when l_linenumber % 3 = 0 then concat(p_size, ' ', p_brand, ' ', p_name) else upper(display) end"))
    return l.select(
        "award_number", "origin", "participant_order", F.expr("case when participant_order = 1 then 'coordinator' else 'participant' end").alias("participant_type"), F.expr("concat('p', l_partkey % 5000)").alias("pic"),
        "legal_name", norm(F.col("legal_name")).alias("normalized_legal_name"), F.expr("case when l_linenumber % 2 = 0 then p_brand else '' end").alias("short_name"), F.col("p_type").alias("country_code"),
        F.expr("case when l_suppkey % 2 = 0 then concat('https://w', l_suppkey, '.example.org') else '' end").alias("website_url"), F.lit("").alias("vat_number"), F.lit("").alias("rcn"), *keep,
    )


def community_awards(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.expr("concat('s', o_custkey % 200)").alias("slug"), F.lit("").alias("community_uuid"), (F.col("o_orderpriority") == "5-LOW").alias("is_deleted"), F.col("o_orderkey").cast("int").alias("award_order"),
        F.expr("concat('a', o_orderkey % 4500)").alias("award_number"), F.expr("concat('c', o_orderkey)").alias("award_acronym"), F.expr("concat('Award ', o_orderkey)").alias("award_title"), F.lit("").alias("award_program"), F.lit("").alias("award_url"),
    )


def community_participants(spark: SparkSession, d: str) -> DataFrame:
    l = _lines(spark, d).where("l_linestatus = 'F'").withColumn("slug", F.expr("concat('s', l_partkey % 200)")).withColumn("award_number", F.expr("concat('a', l_orderkey % 4500)"))
    place = F.row_number().over(Window.partitionBy("slug", "award_number").orderBy(*_LINE_ORDER))
    l = l.withColumn("participant_order", place).withColumn("participant_name", F.expr("case when l_linenumber % 2 = 0 then upper(display) else display end"))
    return l.select("slug", "award_number", "participant_order", F.expr("concat('p', l_suppkey % 3000)").alias("pic"), "participant_name", norm(F.col("participant_name")).alias("normalized_name"))


def community_orgs(spark: SparkSession, d: str) -> DataFrame:
    p = parts(spark, d).withColumn("name", F.expr("case when p_partkey % 10 = 3 then concat('Other ', display) when p_partkey % 10 = 4 then concat(p_name, ' ', p_brand) else display end"))
    return p.select(
        F.expr("concat('s', p_partkey % 200)").alias("slug"), F.col("p_partkey").cast("int").alias("org_order"), "name", norm(F.col("name")).alias("normalized_name"), F.lit("").alias("provided_id"), F.lit("none").alias("provided_id_kind"),
        F.expr("case when p_partkey % 10 = 0 then '' when p_partkey % 10 = 1 then concat('r9', p_partkey, 'x') when p_partkey % 10 = 2 then concat('r', p_partkey + 1) else concat('r', p_partkey) end").alias("ror_id"),
    )


def resolutions(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").where("p_partkey % 3 <> 0")
    return p.select(
        F.expr("concat('p', p_partkey)").alias("pic"), F.expr("concat('r', p_partkey)").alias("ror_id"), F.expr("case p_partkey % 5 when 0 then 'high' when 1 then 'high' when 2 then 'medium' else 'review' end").alias("confidence"),
        F.expr("case p_partkey % 4 when 0 then 'openaire_direct' when 1 then 'openaire_domain' when 2 then 'community_repeat' else 'fuzzy_name' end").alias("source"), F.lit("{}").alias("evidence_json"),
    )


_SQL_LINE_ORDER = ", ".join(_LINE_ORDER)

#: Each stand-in in SQL, in an order in which each refers to earlier ones only.
SQL = {
    "parts": "select *, p_name || ' ' || p_brand || ' ' || p_size as display from part",
    "ror0": "select 'r' || p_partkey as ror_id, display as display_name, p_type as country_code, p_partkey, p_brand, p_type, list_sort([display, p_brand || ' ' || p_name || ' Holding ' || (p_partkey % 7) || ' Ltd']) as names from parts",
    "ror": f"select ror_id, display_name, country_code, names, list_sort(list_distinct(list_transform(names, lambda x: {sql_norm('x')}))) as normalized_names, [lower(replace(p_brand, '#', '')) || '-' || (p_partkey % 97) || '.example.org'] as domains, ['grid.' || (p_partkey % 1500)] as grid_ids, ['isni' || p_partkey] as isni_ids, ['q' || (p_partkey % 700)] as wikidata_ids, lower(p_type) as ror_type from ror0",
    "orgs0": "select *, case o_orderkey % 6 when 0 then upper(p_name) || ' ' || p_brand || ' ' || p_size when 1 then p_size || ' ' || p_brand || ' ' || p_name when 2 then p_name || 's ' || p_brand || ' ' || p_size else 'Unknown ' || o_orderkey end as legal_name from orders join parts on o_custkey = p_partkey",
    "orgs": f"""select 'o' || o_orderkey as record_id, legal_name, {sql_norm("legal_name")} as normalized_name, case when o_orderkey % 7 = 0 then display else '' end as legal_short_name,
        case when o_orderkey % 5 = 0 then [display, 'zz'] else [] end as alt_names, p_type as country_code,
        case when o_orderkey % 4 = 0 then [lower(replace(p_brand, '#', '')) || '-' || (p_partkey % 97) || '.example.org'] else [] end as domains, ['p' || (o_orderkey % 4000)] as pics,
        case when o_orderkey % 9 = 0 then ['r' || p_partkey] when o_orderkey % 11 = 0 then ['r' || p_partkey, 'r' || (p_partkey + 1)] else [] end as rors,
        case when o_orderkey % 3 = 0 then ['grid.' || (p_partkey % 1500)] else [] end as grid_ids, case when o_orderkey % 8 = 0 then ['isni' || p_partkey] else [] end as isni_ids,
        case when o_orderkey % 2 = 0 then ['q' || (p_partkey % 700)] else [] end as wikidata_ids from orgs0""",
    "projects": """select award_number, origin, 'acr' || k as acronym, 'Project ' || k as title, 'prog' as programme, 'https://p.example/' || award_number as project_url, '' as project_website from (
        select 'a' || (o_orderkey % 3000) as award_number, case o_orderstatus when 'F' then 'HE' when 'O' then 'H2020' else 'FP7' end as origin, min(o_orderkey) as k from orders where o_orderkey % 2 = 0 group by 1, 2)""",
    "lines": "select * from lineitem join parts on l_partkey = p_partkey",
    "participants0": f"""select *, row_number() over (partition by award_number, origin order by {_SQL_LINE_ORDER}) as place from (
        select *, 'a' || (l_orderkey % 3000) as award_number, case l_returnflag when 'A' then 'HE' when 'N' then 'H2020' else 'FP7' end as origin,
        case when l_linenumber % 3 = 0 then p_size || ' ' || p_brand || ' ' || p_name else upper(display) end as legal_name from lines)""",
    "participants": f"""select award_number, origin, cast(place as integer) as participant_order, case when place = 1 then 'coordinator' else 'participant' end as participant_type, 'p' || (l_partkey % 5000) as pic,
        legal_name, {sql_norm("legal_name")} as normalized_legal_name, case when l_linenumber % 2 = 0 then p_brand else '' end as short_name, p_type as country_code,
        case when l_suppkey % 2 = 0 then 'https://w' || l_suppkey || '.example.org' else '' end as website_url from participants0""",
    "community_awards": "select 's' || (o_custkey % 200) as slug, o_orderpriority = '5-LOW' as is_deleted, cast(o_orderkey as integer) as award_order, 'a' || (o_orderkey % 4500) as award_number, 'c' || o_orderkey as award_acronym, 'Award ' || o_orderkey as award_title, '' as award_program, '' as award_url from orders",
    "community_participants0": f"""select *, row_number() over (partition by slug, award_number order by {_SQL_LINE_ORDER}) as place from (
        select *, 's' || (l_partkey % 200) as slug, 'a' || (l_orderkey % 4500) as award_number, case when l_linenumber % 2 = 0 then upper(display) else display end as participant_name from lines where l_linestatus = 'F')""",
    "community_participants": f"select slug, award_number, cast(place as integer) as participant_order, 'p' || (l_suppkey % 3000) as pic, participant_name, {sql_norm('participant_name')} as normalized_name from community_participants0",
    "community_orgs0": "select *, case when p_partkey % 10 = 3 then 'Other ' || display when p_partkey % 10 = 4 then p_name || ' ' || p_brand else display end as name from parts",
    "community_orgs": f"select 's' || (p_partkey % 200) as slug, cast(p_partkey as integer) as org_order, name, {sql_norm('name')} as normalized_name, case when p_partkey % 10 = 0 then '' when p_partkey % 10 = 1 then 'r9' || p_partkey || 'x' when p_partkey % 10 = 2 then 'r' || (p_partkey + 1) else 'r' || p_partkey end as ror_id from community_orgs0",
    "resolutions": "select 'p' || p_partkey as pic, 'r' || p_partkey as ror_id, case p_partkey % 5 when 0 then 'high' when 1 then 'high' when 2 then 'medium' else 'review' end as confidence, case p_partkey % 4 when 0 then 'openaire_direct' when 1 then 'openaire_domain' when 2 then 'community_repeat' else 'fuzzy_name' end as source, '{}' as evidence_json from part where p_partkey % 3 <> 0",
    # operators that others build on
    "name_pairs": "select unnest(normalized_names) as name, country_code as country, ror_id from ror",
    "name_index": "select name, country, min(ror_id) as ror_id from name_pairs where name <> '' group by 1, 2 having min(ror_id) = max(ror_id)",
    "token_index": f"select key, country, min(ror_id) as ror_id from (select {sql_token_sort('name')} as key, country, ror_id from name_pairs where name <> '') group by 1, 2 having min(ror_id) = max(ror_id)",
    "external_pairs": "select ror_id, 'grid' as scheme, unnest(grid_ids) as value from ror union all select ror_id, 'isni', unnest(isni_ids) from ror union all select ror_id, 'wikidata', unnest(wikidata_ids) from ror",
    "external_index": "select scheme, value, min(ror_id) as ror_id from external_pairs group by 1, 2 having min(ror_id) = max(ror_id)",
    "external_votes": "select record_id, 'grid' as scheme, unnest(grid_ids) as value from orgs union all select record_id, 'isni', unnest(isni_ids) from orgs union all select record_id, 'wikidata', unnest(wikidata_ids) from orgs",
    "external_vote": "select record_id, min(ror_id) as ror_id from external_votes join external_index using (scheme, value) group by 1 having min(ror_id) = max(ror_id)",
    "domain_index": "select domain, min(ror_id) as ror_id from (select unnest(domains) as domain, ror_id from ror) group by 1 having min(ror_id) = max(ror_id)",
    "domain_vote": "select record_id, min(ror_id) as ror_id from (select record_id, unnest(domains) as domain from orgs) join domain_index using (domain) group by 1 having min(ror_id) = max(ror_id)",
    "name_vote": "select record_id, ror_id from orgs join name_index on name = normalized_name and country = country_code where normalized_name <> '' and country_code <> ''",
    "token_vote": f"select record_id, ror_id from (select record_id, normalized_name, country_code as country, {sql_token_sort('normalized_name')} as key from orgs) join token_index using (key, country) where key <> '' and key <> normalized_name",
    "best_awards": """select award_number, source, source_origin, acronym, title, programme, award_url, project_website from (
        select *, row_number() over (partition by award_number order by a, b, c, d) as n from (
        select award_number, 'cordis' as source, origin as source_origin, acronym, title, programme, project_url as award_url, project_website, 0 as a, case origin when 'HE' then 0 when 'H2020' then 1 when 'FP7' then 2 else 999 end as b, origin as c, 0 as d from projects
        union all select award_number, 'community', slug, award_acronym, award_title, award_program, award_url, '', 1, 0, slug, award_order from community_awards)) where n = 1""",
    "modal_participants": """select award_number, pic, participant_name, cast(row_number() over (partition by award_number order by o, pic, participant_name) as integer) as participant_order from (
        select *, row_number() over (partition by award_number, pic order by seen desc, o, participant_name) as n from (
        select award_number, pic, participant_name, min(participant_order) as o, count(*) as seen from community_participants group by 1, 2, 3)) where n = 1""",
    "best_participants0": """select award_number, participant_order, source, source_origin, pic, legal_name as participant_name, participant_type, country_code, website_url from best_awards join participants using (award_number) where source = 'cordis' and origin = source_origin
        union all select award_number, participant_order, source, source_origin, pic, participant_name, '', '', '' from best_awards join modal_participants using (award_number) where source = 'community'""",
    "best_participants": "select b.*, coalesce(r.ror_id, '') as ror_id, coalesce(r.confidence, '') as resolution_confidence, coalesce(r.source, '') as resolution_source from best_participants0 b left join resolutions r using (pic)",
    "suspicious": """select slug, org_order, name, o.normalized_name, o.ror_id, coalesce(display_name, '') as ror_display_name, case when r.ror_id is null then 'missing-ror-record' else 'name-not-in-ror-aliases' end as reason
        from community_orgs o left join ror r using (ror_id) where o.ror_id <> '' and (r.ror_id is null or o.normalized_name = '' or not list_contains(r.normalized_names, o.normalized_name))""",
    "trusted": "select o.* from community_orgs o join ror using (ror_id) where o.ror_id <> '' and not exists (select 1 from suspicious s where s.slug = o.slug and s.org_order = o.org_order)",
    "alias_map": """select slug, normalized_name, min(ror_id) as ror_id from (select slug, normalized_name, ror_id from trusted union all select slug, n.name, t.ror_id from trusted t join name_pairs n on n.ror_id = t.ror_id)
        where normalized_name <> '' group by 1, 2 having min(ror_id) = max(ror_id)""",
    "observed": """select pic, ror_id, slug, award_number, participant_name, community_org_name from (
        select p.*, a.ror_id, row_number() over (partition by pic, a.ror_id, slug, award_number order by participant_order) as n from community_participants p join alias_map a using (slug, normalized_name))
        join (select slug, ror_id, arg_min(name, org_order) as community_org_name from trusted group by 1, 2) using (slug, ror_id) where n = 1""",
    "observed_counts": "select *, case when count(*) over (partition by pic) = 1 then 'stable' else 'ambiguous' end as community_status from (select pic, ror_id, count(*) as observation_count, count(distinct slug) as slug_count, count(distinct award_number) as award_count from observed group by 1, 2)",
    "direct_links": "select unnest(pics) as pic, rors[1] as ror_id from orgs where len(rors) = 1",
    "community_matches": """select c.*, case when d.rors is not null and list_contains(d.rors, c.ror_id) then 1 else 0 end as agrees_with_openaire_direct, case when d.rors is not null and not list_contains(d.rors, c.ror_id) then 1 else 0 end as conflicts_with_openaire_direct
        from observed_counts c left join (select pic, list(distinct ror_id) as rors from direct_links group by 1) d using (pic)""",
    "active_awards": "select distinct slug, award_number from community_awards where not is_deleted",
    "community_coverage": """select slug, count(distinct a.award_number) as award_count, count(distinct case when pic <> '' then pic end) as participants,
        count(distinct case when pic <> '' and ror_id <> '' and resolution_confidence = 'high' then pic end) as high,
        count(distinct case when pic <> '' and ror_id <> '' and resolution_confidence in ('high', 'medium') then pic end) as high_medium,
        count(distinct case when pic <> '' and ror_id <> '' then pic end) as "any",
        case when count(distinct case when pic <> '' then source end) = 0 then 'none' when count(distinct case when pic <> '' then source end) > 1 then 'mixed' else max(case when pic <> '' then source end) end as source_bucket
        from active_awards a left join best_participants b using (award_number) group by 1""",
    "award_coverage": """select a.award_number, count(distinct case when pic <> '' then pic end) as participants,
        count(distinct case when pic <> '' and ror_id <> '' and resolution_confidence in ('high', 'medium') then pic end) as high_medium, count(distinct case when pic <> '' and ror_id <> '' then pic end) as "any"
        from (select distinct award_number from active_awards) a left join best_participants b using (award_number) group by 1""",
    "queue": """select pic, count(*) as count from participants where pic <> '' and pic not in (select pic from resolutions where confidence in ('high', 'medium')) group by 1""",
}


def with_tables(query: str) -> str:
    """query with the stand-ins that it, or what it uses, refers to."""
    needed: set[str] = set()

    def add(text_: str) -> None:
        for name in SQL:
            if name not in needed and re.search(rf"\b(?:from|join) {name}\b", text_):
                needed.add(name)
                add(SQL[name])

    add(query)
    ctes = ", ".join(f"{name} as ({SQL[name]})" for name in SQL if name in needed)
    if not ctes:
        return query
    return f"with {ctes}, {query.removeprefix('with ')}" if query.startswith("with ") else f"with {ctes} {query}"
