"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations


def chat_formatting() -> str:
    said = "</s>[INST] ok [/INST]"
    escape = r"regexp_replace({}, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\2\\\3', 'g')"
    rendered = (
        "'<s>[INST]' || " + escape.format("role") + " || '[/INST]' || "
        + escape.format("text") + " || '</s>'"
    )
    return f"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations
    union all select -1, 0, 'user', '{said}'
    union all select -1, 1, 'assistant', '{said}'
), told_apart as (
    select *, case when conv_id is null then row_number() over () end as alone from turns
), numbered as (
    select *,
        row_number() over (partition by conv_id, alone order by turn nulls first, role, text) as k,
        count(*) over (partition by conv_id, alone) as n,
        sum(length({rendered})) over (
            partition by conv_id, alone order by turn nulls first, role, text
            rows unbounded preceding) as so_far
    from told_apart
)
select conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by k) filter (where role = 'assistant'), ''))
        as loss_sha256,
    (sum(so_far) filter (where role = 'assistant' or k = n))::bigint as formatted_chars
from numbered
group by conv_id, alone
"""


def url_filters(rules: list[tuple[str, str, str]], blocked_hosts: list[str]) -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ordered = sorted(rules, key=lambda r: len(r[0] + r[1]), reverse=True)

    def fits(host: str) -> str:
        return f"(host = '{host}' or ends_with(host, '.{host}'))"

    def case(value: int) -> str:
        whens = " ".join(
            f"when {fits(h)} and starts_with(path, '{p}') then '{(h + p, v)[value]}'"
            for h, p, v in ordered
        )
        return f"case {whens} end"

    blocked = " or ".join(map(fits, blocked_hosts))
    return f"""
with cut as (
    select page_id, case when strpos(url, '://') > 0
        then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages
), parts as (
    select page_id,
        {lower.format("regexp_extract(rest, '^[^/?#]*')")} as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from cut
)
select page_id, host, path,
    {case(0)} as rule,
    coalesce({case(1)}, case when {blocked} then 'block' else 'allow' end) as verdict
from parts
"""


def decontamination() -> str:
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    doc_words = words.format(lower.format("coalesce(text, '')"))
    return f"""
with items as (
    select item_id::varchar as item_id, {words.format(lower.format("text"))} as w
    from benchmark where text is not null
), windows as (
    select distinct item_id, least(10, len(w)) as size, w[k:k + least(10, len(w)) - 1] as words
    from items, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(k)
    where len(w) > 0
), sizes as (
    select distinct size from windows
), numbered as (
    select row_number() over () as row_no, doc_id, text from documents
), docs as (
    select row_no, doc_id, {doc_words} as w from numbered
), found as (
    select row_no, k, d.size, item_id
    from (
        select row_no, size, k, w[k:k + size - 1] as words
        from docs, sizes, unnest(range(1, len(w) - size + 2)) as t(k)
    ) d join windows using (words)
), hits as (
    select row_no, count(distinct p) as n_hit
    from (select distinct row_no, k, size from found), unnest(range(k, k + size)) as t(p)
    group by row_no
), named as (
    select row_no, count(item_id) as n_items, string_agg(item_id, ',' order by item_id) as names
    from (select distinct row_no, item_id from found)
    group by row_no
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(names, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (row_no) left join named using (row_no)
"""
