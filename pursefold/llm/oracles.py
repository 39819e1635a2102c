"""The registered queries that SQL can express, for an independent check."""

from __future__ import annotations

from pursefold.llm import lines
from pursefold.llm.decontaminate import LOWER, UPPER
from pursefold.llm.quality_rules import LEAST, MAX_REPEAT_PERCENT, METRICS, MIN_WORDS

WORD = r"[^\x20\x09-\x0D]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_VALUE = "case when {bottom} > 0 then ({top} * {scale}) // {bottom} else 0 end"
_VALUES = ", ".join(f"{_VALUE.format(top=t, bottom=b, scale=s)} as raw_{m}" for m, (t, b, s, *_) in METRICS.items())
_ROUNDED = ", ".join(f"raw_{m} - raw_{m} % (10 ** greatest(length(raw_{m}::varchar) - 3, 0))::bigint as {m}" for m in METRICS)
_TAILS = " union all ".join(f"select '{m}' as metric, {inside} as inside, {more} as more, {two} as two" for m, (_, _, _, inside, more, two) in METRICS.items())
_LONG = " union all ".join(f"select lang, source, '{m}' as metric, {m} as v from measured where not base_failed" for m in METRICS)
_LEVELS = " union all ".join(
    f"select {k} as level, {l} as l, {s} as s, metric, v, count(*) as n from long group by all"
    for k, l, s in ((0, "null::varchar", "null::varchar"), (1, "lang", "null::varchar"), (2, "lang", "source"))
)
_INSIDE = " and ".join(f"{m} between min(case when metric = '{m}' then lo end) and max(case when metric = '{m}' then hi end)" for m in METRICS)

QUALITY_RULES = f"""
with texts as (select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as t from documents),
split as (
  select *, regexp_extract_all(t, '{WORD}') as w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from texts),
starts as (select rid, unnest(range(1, len(w) - 1)) as i from split where len(w) > 2),
windows as (select starts.rid, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from starts join split on starts.rid = split.rid),
twice as (select rid, i from windows qualify count(*) over (partition by rid, a, b, c) > 1),
repeated as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from twice) group by 1),
counted as (
  select split.rid, doc_id, lang, source, len(w) as n_words,
         length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
         len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words,
         len(lines) as n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_upper
  from split left join repeated on split.rid = repeated.rid),
raw as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed, {_VALUES}
  from counted),
measured as (select *, {_ROUNDED} from raw),
long as ({_LONG}),
sketch as ({_LEVELS}),
summed as (
  select *, sum(n) over (partition by level, l, s, metric order by v) as upto,
         sum(n) over (partition by level, l, s, metric) as total
  from sketch),
fences as (
  select level, l, s, metric, max(total) as total, min(case when upto * 1000 >= total * inside then v end) + any_value(more) as hi,
         case when any_value(two) then min(case when upto * 1000 >= total * (1000 - inside) then v end) - any_value(more) else -1 end as lo
  from summed join ({_TAILS}) using (metric) group by 1, 2, 3, 4),
chosen as (
  select rid, f.* from measured m join fences f
  on (level = 0 or (total >= {LEAST} and l is not distinct from lang and (level = 1 or s is not distinct from source)))
  qualify level = max(level) over (partition by rid)),
verdicts as (
  select rid, {_INSIDE} as inside from measured join chosen using (rid) group by rid, {", ".join(METRICS)})
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and coalesce(inside, true) as kept
from measured left join verdicts using (rid)"""

DECONTAMINATION = f"""
with items as (
  select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}') as w
  from benchmark),
starts as (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from items where len(w) > 0),
windows as (select distinct item, w[i:i + 12] as win from starts),
sizes as (select distinct len(win) as size from windows),
docs as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}') as w
  from documents),
places as (select rid, w, size, unnest(range(1, len(w) - size + 2)) as i from docs, sizes where len(w) >= size),
hits as (select rid, i, size, item from places join windows on w[i:i + size - 1] = win and len(win) = size),
words as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + size)) as p from hits) group by 1),
found as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct rid, item from hits) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join words using (rid) left join found using (rid)"""

SUBSTRING = f"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
starts as (select doc_id, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20),
windows as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as win from starts join docs using (doc_id)),
later as (select doc_id, i from windows qualify row_number() over (partition by win order by doc_id, i) > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as p from later),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from docs),
kept as (
  select doc_id, string_agg(word, ' ' order by p) as text, count(*) as n
  from words anti join gone using (doc_id, p) group by 1)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (doc_id)"""

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINE_DEDUP = f"""
with docs as (select row_number() over () as rid, doc_id, source as host, text, string_split(text, chr(10)) as parts from documents),
pages as (select distinct host, text from docs),
totals as (select host, count(*) as total from pages group by 1),
lines as (select distinct host, text, trim(line, {_BLANK}) as line from (select host, text, unnest(string_split(text, chr(10))) as line from pages)),
counted as (select host, line, count(*) as n from lines where line <> '' group by 1, 2),
boiler as (
  select counted.host, list(line) as bad from counted join totals on counted.host is not distinct from totals.host
  where n >= {lines.MIN_PAGES} and n > total * {lines.MAX_RATIO}::double group by 1),
cut as (
  select rid, doc_id, text, parts, list_filter(parts, lambda x: not list_contains(coalesce(bad, []), trim(x, {_BLANK}))) as kept
  from docs left join boiler on docs.host is not distinct from boiler.host)
select doc_id, coalesce(len(parts), 0)::bigint as n_lines, coalesce(len(parts) - len(kept), 0)::bigint as n_removed,
       sha256(coalesce(case when len(kept) < len(parts) then array_to_string(kept, chr(10)) else text end, '')) as text_sha256
from cut"""

ORACLES = {
    "op3_quality_rules": QUALITY_RULES,
    "op5_decontamination": DECONTAMINATION,
    "op8_substring": SUBSTRING,
    "op10_line_dedup": LINE_DEDUP,
}
