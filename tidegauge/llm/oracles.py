"""DuckDB SQL for the registered queries that SQL can express."""

from functools import reduce

from tidegauge.llm.chat import CHAT
from tidegauge.llm.divergence import MIN_DOCS, TOP_TERMS
from tidegauge.llm.line_dedup import MIN_PAGES, RATIO
from tidegauge.llm.terms import LETTERS, WORDS, pattern

LINE_DEDUP = rf"""
with split as (
  select doc_id, source, text, string_split(text, chr(10)) as lines from documents
), pages as (
  select distinct source, text, lines from split where source is not null and text is not null
), totals as (
  select source, count(*) as total from pages group by source
), bare as (
  select distinct source, text, trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) as line
  from (select source, text, unnest(lines) as x from pages)
), boilerplate as (
  select source, list(line) as drops from (
    select b.source, b.line from bare b join totals t on b.source = t.source
    where b.line <> '' group by b.source, b.line, t.total
    having count(*) >= {MIN_PAGES} and count(*) > {RATIO} * t.total
  ) group by source
), kept as (
  select s.doc_id, s.source, s.text, s.lines,
         case when b.drops is null then s.lines else list_filter(s.lines, lambda x:
           not list_contains(b.drops, trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)))) end as rest
  from split s left join boilerplate b on s.source = b.source
)
select doc_id, source, case when len(rest) = len(lines) then text else array_to_string(rest, chr(10)) end as text,
       coalesce(len(lines) - len(rest), 0)::integer as lines_dropped
from kept
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RANKED_SEARCH = rf"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all({LOWER.format("text")}, '{pattern(WORDS)}') as words
  from documents
), corpus as (
  select count(*) as n_docs, sum(len(words))::bigint as n_terms from docs where len(words) > 0
), lengths as (
  select r, doc_id, len(words)::bigint as n, words from docs where len(words) > 0
), postings as (
  select r, term, count(*)::bigint as tf from (select r, unnest(words) as term from lengths) group by r, term
), asked as (
  select distinct item_id, term from (
    select item_id, unnest(regexp_extract_all({LOWER.format("text")}, '{pattern(WORDS)}')) as term
    from benchmark where item_id is not null)
), weights as (
  select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as w
  from postings, corpus group by term, n_docs
), scores as (
  select a.item_id, l.doc_id, l.r, sum(w.w * ((1000000000 * p.tf)
           // (1000 * p.tf + 20 * (50 + (50 * l.n * c.n_docs) // c.n_terms))))::bigint as score
  from asked a join postings p on a.term = p.term join weights w on w.term = a.term
  join lengths l on l.r = p.r, corpus c
  where l.doc_id is not null
  group by a.item_id, l.doc_id, l.r
)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::integer as rank, doc_id, score
from scores where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50
"""

SOURCE_DIVERGENCE = rf"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{pattern(LETTERS)}') as words
  from documents
), counted as (
  select lang, source, r, term, count(*) as n from (select lang, source, r, unnest(words) as term from docs)
  group by all
), kept as (
  select lang, term, sum(n)::hugeint as lang_n from counted group by lang, term having count(*) >= {MIN_DOCS}
), langs as (
  select lang, count(*)::hugeint as v, sum(lang_n)::hugeint as lang_total from kept group by lang
), groups as (
  select distinct lang, source from docs
), found as (
  select c.lang, c.source, c.term, sum(c.n)::hugeint as n
  from counted c join kept k on c.lang = k.lang and c.term = k.term group by all
), totals as (
  select lang, source, sum(n)::hugeint as total from found group by lang, source
), shares as (
  select g.lang, g.source, k.term, coalesce(f.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(f.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * l.v) as p,
         1 + (1000000000::hugeint * (k.lang_n + 2)) // (l.lang_total + 2 * l.v) as q
  from groups g join langs l on g.lang = l.lang join kept k on k.lang = g.lang
  left join totals t on t.lang = g.lang and t.source = g.source
  left join found f on f.lang = g.lang and f.source = g.source and f.term = k.term
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
), terms as (
  select lang, source, term as item, ((p - q) * (p - q) // (p + q))::bigint as value from shares where n > 0 and p > q
)
select lang, source, 'pair' as part, item, value,
       (row_number() over (partition by lang, source order by value desc, item))::integer as rank
from pairs
union all
select lang, source, 'term', item, value,
       (row_number() over (partition by lang, source order by value desc, item))::integer as rank
from terms qualify row_number() over (partition by lang, source order by value desc, item) <= {TOP_TERMS}
"""


def _escaped(text: str) -> str:
    """SQL for the template's escaping."""
    doubled = f"replace({text}, '\\', '\\\\')"
    return reduce(lambda t, c: f"replace({t}, '{c}', '{c[0]}\\{c[1:]}')", CHAT.controls, doubled)


_LEARNT = f"role in ({', '.join(repr(r) for r in CHAT.learnt)})"

CHAT_FORMATTING = rf"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as place,
         {len(CHAT.begin + CHAT.between + CHAT.end)} + length({_escaped("role")}) + length({_escaped("text")}) as chars
  from said
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
       coalesce(sum(length(text)) filter ({_LEARNT}), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by place) filter ({_LEARNT}), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from turns group by conv_id
"""

ORACLES = {
    "op3_line_dedup": LINE_DEDUP,
    "op11_ranked_search": RANKED_SEARCH,
    "op12_source_divergence": SOURCE_DIVERGENCE,
    "op13_chat_formatting": CHAT_FORMATTING,
}
