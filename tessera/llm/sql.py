"""SQL of the operators that have one, for DuckDB over the driver tables.

Fingerprints, trained models, rule sets, merges and file formats have no SQL form; the
tests hold those against brute force.
"""

from __future__ import annotations

from tessera.llm import host_quality as hq
from tessera.llm import line_dedup as ld
from tessera.llm import queries as q

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _weight(column: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"when '{name}' then {weight}" for name, weight in weights.items())
    return f"case {column} {cases} else 1 end" if cases else "1"


def _share(nodes: str, parent: str, budget: str, name: str, out: str) -> str:
    """The children of each parent with their part of its budget; see mixing.share."""
    order = f"partition by {parent} order by cast(capacity as double) / weight, {name}"
    return f"""select *, case when filled then capacity else (weight::hugeint * rest) // heads end::bigint as {out} from (
        select *, max(case when not filled then left_ end) over (partition by {parent}) as rest, max(case when not filled then weight_ end) over (partition by {parent}) as heads from (
        select *, capacity::hugeint * weight_ <= weight::hugeint * left_ as filled from (
        select *, greatest({budget} - coalesce(sum(capacity) over ({order} rows between unbounded preceding and 1 preceding), 0), 0)::hugeint as left_,
        (sum(weight) over ({order} rows between current row and unbounded following))::bigint as weight_ from {nodes})))"""


_MIX = f"""with d as (select doc_id, ['{"', '".join(q.DOMAINS)}'][(strpos('0123456789abcdef', substr(md5(coalesce(source, '')), 1, 1)) - 1) % {len(q.DOMAINS)} + 1] as domain,
        coalesce(lang, '') as lang, coalesce(source, '') as source, len({_WORDS})::bigint as n_tokens from documents),
    leaves as (select domain, lang, source, sum(n_tokens)::bigint as tokens, (sum(n_tokens) * {q.MIX_EPOCHS})::bigint as capacity, 1 as weight from d group by 1, 2, 3),
    langs as (select domain, lang, sum(tokens)::bigint as tokens, sum(capacity)::bigint as capacity, {_weight("lang", q.MIX_WEIGHTS["lang"])} as weight from leaves group by 1, 2),
    domains as (select domain, sum(tokens)::bigint as tokens, sum(capacity)::bigint as capacity, {_weight("domain", q.MIX_WEIGHTS["domain"])} as weight, 0 as root from langs group by 1),
    rooted as (select *, least((sum(tokens) over ()) * {q.MIX_SHARE[0]} // {q.MIX_SHARE[1]}, sum(capacity) over ())::bigint as budget from domains),
    top as ({_share("rooted", "root", "budget", "domain", "domain_share")}),
    mid0 as (select l.*, domain_share from langs l join top using (domain)),
    mid as ({_share("mid0", "domain", "domain_share", "lang", "lang_share")}),
    low0 as (select l.*, lang_share from leaves l join mid using (domain, lang)),
    low as ({_share("low0", "domain, lang", "lang_share", "source", "share_")}),
    plan as (select domain, lang, source, whole, share_ - whole * tokens as rest from (select *, (case when tokens > 0 then share_ // tokens else 1 end)::integer as whole from low)),
    e as (select d.*, whole, rest, unnest(range(0, least(whole, {q.MIX_EPOCHS - 1}) + 1))::integer as epoch from d join plan using (domain, lang, source)),
    p as (select *, sum(n_tokens) over (partition by domain, lang, source order by md5('{q.MIX_SEED}:' || epoch || ':' || coalesce(doc_id::varchar, 'null')), doc_id, n_tokens rows between unbounded preceding and current row) as run
        from e where epoch = whole and rest > 0)
    select doc_id, domain, lang, source, n_tokens, epoch from e where epoch < whole
    union all select doc_id, domain, lang, source, n_tokens, epoch from p where run <= rest"""

_TOPK = """with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as c from embeddings
        where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    s as (select a.r, b.r as other, a.vec_id as query_id, b.vec_id, cast(list_dot_product(cast(a.c as double[]), cast(b.c as double[])) as bigint) as score from v a join v b on a.r <> b.r and len(a.c) = len(b.c) where a.vec_id % 100 = 0)
    select query_id, cast(n as integer) as rank, vec_id, score from (select *, row_number() over (partition by r order by score desc, vec_id, other) as n from s) where n <= 10"""


def _page_text() -> str:
    text = "html"
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    line = lambda s: "chr(10)" if s == "\n" else quoted(s)
    for pattern, by in ld.PAGE_RULES:
        text = f"regexp_replace({text}, {quoted(pattern)}, {line(by)}, 'g')"
    for entity, char in ld.ENTITIES:
        text = f"replace({text}, {quoted(entity)}, {quoted(char)})"
    return f"regexp_replace(regexp_replace({text}, {quoted(ld.LINE_BREAK)}, chr(10), 'g'), {quoted(ld.OUTER_SPACE)}, '', 'g')"


_HAS_WORD = r"regexp_matches(l, '[^\x20\x09-\x0D]')"
_LINES = f"""with t as (select page_id, lower(regexp_extract(coalesce(url, ''), '{ld.HOST}', 1)) as host, {_page_text()} as text from pages),
    s as (select *, string_split(text, chr(10)) as lines from t),
    n as (select host, count(*) as pages from s group by 1),
    b as (select host, list(l) as boiler from (select host, l, count(*) as c from (select host, unnest(list_distinct(list_filter(lines, lambda l: {_HAS_WORD}))) as l from s) group by 1, 2) join n using (host)
        where c >= {ld.MIN_PAGES} and c > {ld.RATIO} * pages group by 1)
    select page_id, host, case when boiler is null then text else array_to_string(kept, chr(10)) end as text, case when boiler is null then 0 else coalesce(len(lines) - len(kept), 0) end::bigint as n_dropped,
        coalesce(len(list_filter(lines, lambda l: {_HAS_WORD})), 0)::bigint as n_lines
    from (select s.*, boiler, list_filter(lines, lambda l: not {_HAS_WORD} or not list_contains(boiler, l)) as kept from s left join b using (host))"""


def _soft(slack: float) -> str:
    return f"""(n_symbols * 100 > n_words * {hq.MAX_SYMBOL_PERCENT * slack} or n_dup_lines * 100 > n_lines * {hq.MAX_DUP_LINE_PERCENT * slack}
        or word_chars * {slack} < n_words * {hq.MIN_MEAN_CHARS} or word_chars > n_words * {hq.MAX_MEAN_CHARS * slack})"""


_QUALITY = rf"""with d as (select doc_id, coalesce(source, chr(0)) as host, coalesce(text, '') as text, {_WORDS} as w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: {_HAS_WORD}) as lines from documents),
    win as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as k from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
    rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from (select *, count(*) over (partition by doc_id, k) as c from win) where c > 1) group by 1),
    m as (select doc_id, host, len(w)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, len(lines) as n_lines, coalesce(n, 0)::bigint as n_repeat_words from d left join rep using (doc_id)),
    f as (select *, n_words < {hq.MIN_WORDS} or 100 * n_repeat_words > {hq.MAX_REPEAT_PERCENT} * n_words as base_failed from m),
    h as (select host, count(*) as docs, (count(*) filter (base_failed or {_soft(1.0)}))::double as bad from f group by 1),
    g as (select sum(docs)::double as n, sum(bad) / sum(docs) as mean, sum(docs * (bad / docs) * (bad / docs)) / sum(docs) as square, sum(docs)::double / count(*) as average, count(*) / sum(docs)::double as sampling from h),
    r as (select *, mean * (1 - mean) as chance, square - mean * mean - mean * (1 - mean) * sampling as between_ from g),
    prior as (select mean, case when between_ > 0 then greatest(chance / between_ - 1, 2.0) else greatest(average, 2.0) end as strength from r),
    v as (select host, (bad + mean * strength) / (docs + strength) as rate from h, prior)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and case when rate >= {hq.BLOCK_RATE} then false when rate >= {hq.STRICT_RATE} then not {_soft(1.0)} else not {_soft(hq.SLACK)} end as kept from f join v using (host)"""

ORACLES = {"op1_mix_sources": _MIX, "op2_exact_topk": _TOPK, "op7_line_dedup": _LINES, "op8_host_quality": _QUALITY}
