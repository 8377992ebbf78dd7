"""DuckDB SQL for those queries of this subpackage that SQL can express, by strings where the queries hash."""

from __future__ import annotations

_WORDS = "[^ \\t\\n\\x0b\\f\\r]+"
_FOLD = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

OP7 = f"""with d as (select doc_id, source, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{_WORDS}') as words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) as told from d),
g as (select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as k from w, unnest(range(1, len(words) - 1)) as t(i)),
twice as (select doc_id, i from g qualify count(*) over (partition by doc_id, k) > 1),
covered as (select doc_id, count(distinct i + j)::bigint as n from twice, range(3) as r(j) group by 1),
lines as (select doc_id, source, text, len(regexp_extract_all(x, '{_WORDS}')) as n, lower(trim(regexp_replace(x, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'))) as k from w, unnest(told) as t(x)),
common as (select source, k from lines group by 1, 2 having count(distinct text) > 20),
gone as (select doc_id, sum(n)::bigint as n from lines l where exists (select 1 from common c where c.source is not distinct from l.source and c.k = l.k) group by 1),
m as (select w.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(told) - len(list_distinct(told)))::bigint as n_dup_lines,
coalesce(covered.n, 0) as n_repeat_words, len(words) - coalesce(gone.n, 0) as n_left from w left join covered using (doc_id) left join gone using (doc_id))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_left >= 0.3::double * n_words as kept from m"""

OP10 = f"""with d as (select doc_id, regexp_extract_all({_FOLD.format('text')}, '{_PLAIN}') as w from documents),
b as (select item_id, regexp_extract_all({_FOLD.format('text')}, '{_PLAIN}') as w from benchmark),
iw as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as k from b, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(i) where len(w) > 0),
sizes as (select distinct n from iw),
dw as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as k from d, sizes, unnest(range(1, len(w) - n + 2)) as t(i)),
met as (select doc_id, dw.n, i, item_id from dw join iw on dw.n = iw.n and dw.k = iw.k),
hit as (select doc_id, count(distinct i + j)::bigint as n_hit from (select distinct doc_id, n, i from met), unnest(range(0, n)) as t(j) group by 1),
items as (select doc_id, count(*)::bigint as n_items, sha256(string_agg(item, ',' order by item)) as items_sha256 from (select distinct doc_id, item_id::varchar as item from met where item_id is not null) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(items_sha256, sha256('')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (doc_id) left join items using (doc_id)"""

ORACLES = {"op7_line_frequency": OP7, "op10_winnowing": OP10}
