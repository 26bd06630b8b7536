"""DuckDB SQL for the queries that SQL can express."""

_HOST = r"translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
_QUERY = r"coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*(.*)$', 1), '')"

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_WORDS = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op10_decontamination": rf"""
with docs as (select doc_id, {_WORDS} as w from documents),
items as (select item_id, {_WORDS} as w from benchmark),
parts as (select item_id, w, least(len(w), 10) as n from items where len(w) > 0),
windows as (select distinct item_id, n, array_to_string(w[s:s + n - 1], ' ') as gram
  from (select *, unnest(range(1, len(w) - n + 2)) as s from parts)),
spots as (select doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') as gram from (
  select doc_id, n, w, unnest(range(1, len(w) - n + 2)) as s from docs, (select distinct n from windows) where len(w) >= n)),
hits as (select doc_id, item_id, spots.n, s from spots join windows on spots.n = windows.n and spots.gram = windows.gram),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from hits) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as listed
  from (select distinct doc_id, cast(item_id as varchar) as item_id from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(listed, '')) as items_sha256, n_hit is not null as contaminated
from docs left join words using (doc_id) left join named using (doc_id)""",
    "op6_url_filters": rf"""
with parts as (select page_id, {_HOST} as host, {_PATH} as path, {_QUERY} as query from pages),
sites as (select page_id, host, path, case
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule,
  case when regexp_matches(path || ' ' || query, '[?&]page=[0-9]+') then 'listing'
    when regexp_matches(path, '/cart([/.]|$)') then 'cart'
    when regexp_matches(path, '/login([/.]|$)') then 'login'
    when regexp_matches(path, '\.zip$') then 'archive file' end as pattern from parts)
select page_id, host, path, rule,
  case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
    when pattern is not null then 'block' else 'allow' end as verdict,
  case when rule is null then pattern end as pattern from sites""",
    "op12_divergence": rf"""
with docs as (select row_number() over () as nr, coalesce(lang, '') as lang, coalesce(source, '') as source, {_TERMS} as t from documents),
words as (select nr, lang, source, unnest(t) as term from docs),
kept as (select lang, term from words group by lang, term having count(distinct nr) >= 10),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (select lang, source, coalesce(v, 0) as v from (select distinct lang, source from docs) left join sizes using (lang)),
used as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by lang, source, term),
totals as (select lang, source, sum(n) as total from used group by lang, source),
slots as (select g.lang, g.source, term, 1 + (1000000000::hugeint * (coalesce(n, 0) + 2)) // (coalesce(total, 0) + 2 * v)::hugeint as p, coalesce(n, 0) as n
  from groups g join kept using (lang) left join used using (lang, source, term) left join totals using (lang, source)),
whole as (select lang, term, 1 + (1000000000::hugeint * (sum(n) + 2)) // (any_value(total) + 2 * any_value(v))::hugeint as q
  from used join (select lang, sum(total) as total from totals group by lang) using (lang) join sizes using (lang) group by lang, term),
pairs as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
  from slots a join slots b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair_rows as (select a.lang, a.source, b.source as item, coalesce(value, 0) as value from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source),
term_rows as (select lang, source, term as item, (p - q) * (p - q) // (p + q) as value from slots join whole using (lang, term) where n > 0 and p > q),
ranked as (select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pair_rows
  union all select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) from term_rows)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 10""",
}
