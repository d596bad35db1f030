"""DuckDB SQL of the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

from lamina.llm.op7_quality_rules import CUTOFFS, ERROR, MAX_FALSE_REJECTION
from lamina.llm.queries import CONTROL_TEXT

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
with recursive lists as (
  select doc_id, {WORDS.format(LOWER)} as w from documents),
sets as (
  select distinct doc_id, unnest(
    case when len(w) = 0 then []
         when len(w) < 5 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
  from lists),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select shared.a, shared.b from shared
  join sizes x on x.doc_id = shared.a join sizes y on y.doc_id = shared.b
  where 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select reach.doc_id, links.b from reach join links on links.a = reach.other)
select doc_id, coalesce(max(sizes.n), 0) as n_shingles, min(other) as component_id,
       min(other) = doc_id as kept
from reach left join sizes using (doc_id)
group by doc_id
"""

OP6 = f"""
with lists as (
  select doc_id, {WORDS.format("coalesce(text, '')")} as w from documents),
word as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos, len(w) as n,
         w from lists),
wins as (
  select doc_id, pos, word, n,
         case when pos <= n - 12 then array_to_string(w[pos:pos + 12], ' ') end as win
  from word),
firsts as (select win, min(doc_id) as doc_id from wins where win is not null group by win),
marked as (
  select wins.doc_id, pos, word,
         max(case when firsts.doc_id < wins.doc_id then pos end)
           over (partition by wins.doc_id order by pos) as last
  from wins left join firsts using (win)),
kept as (
  select doc_id, count(*) filter (pos - last <= 12) as n_removed,
         string_agg(word, ' ' order by pos) filter (last is null or pos - last > 12) as kept
  from marked group by doc_id)
select lists.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from lists left join kept using (doc_id)
"""

_MEASURES = {
    "symbol_share": "case when word_chars > 0 then n_symbols / word_chars else 0 end",
    "shout_share": "case when n_words > 0 then n_shouted / n_words else 0 end",
    "dup_line_share": "case when n_lines > 0 then n_dup_lines / n_lines else 0 end",
    "repeat_share": "case when n_words > 0 then n_repeat_words / n_words else 0 end",
    "mean_word_excess": "case when n_words > 0 then word_chars / n_words else 0 end",
}
_TESTS = ", ".join(
    f"('{rule}', {step}, {cutoff})"
    for rule, cutoffs in CUTOFFS.items()
    for step, cutoff in enumerate(cutoffs)
)
_VALUE = "case rule " + " ".join(f"when '{r}' then {r}" for r in CUTOFFS) + " end"
_BROKEN = ", ".join(
    f"case when {r} > (select cutoff from chosen where rule = '{r}'"
    f" and stratum is not distinct from judged.lang) then '{r}' end"
    for r in CUTOFFS
)

OP7 = rf"""
with lists as (
  select doc_id, lang, coalesce(text, '') as text, {WORDS.format("coalesce(text, '')")} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
wins as (
  select doc_id, unnest(range(1, len(w) - 3)) as pos,
         unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) as win
  from lists where len(w) >= 5),
hits as (
  select doc_id, pos from wins
  qualify count(*) over (partition by doc_id, win) > 1),
repeated as (
  select doc_id, sum(step) as n_repeat_words
  from (select doc_id, least(5, coalesce(lead(pos) over (partition by doc_id order by pos) - pos, 5)) as step
        from hits)
  group by doc_id),
counted as (
  select lists.doc_id, lang, len(w) as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words,
         len(list_filter(w, lambda x: upper(x) = x and lower(x) <> x)) as n_shouted
  from lists left join repeated using (doc_id)),
judged as (
  select *, {", ".join(f"{sql} as {rule}" for rule, sql in _MEASURES.items())},
         n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
  from counted),
good as (
  select doc_id from labels where quality is not null group by doc_id having min(quality) = 1),
counts as (
  select lang as stratum, rule, step, cutoff, count(*) filter (not base_failed) as n,
         count(*) filter (not base_failed and {_VALUE} > cutoff) as k
  from judged join good using (doc_id), (values {_TESTS}) as t(rule, step, cutoff)
  group by all),
total as (
  select count(*) + {len(CUTOFFS)} as n_tests from (select distinct stratum, rule from counts)),
sized as (
  select counts.*, n_tests, n > 0 and n * ln(1 - {MAX_FALSE_REJECTION}) + ln(n_tests) > ln({ERROR}) as small
  from counts, total),
pooled as (
  select small, case when not small then stratum end as own, rule, step, cutoff, n_tests,
         cast(sum(n) as bigint) as n, cast(sum(k) as bigint) as k
  from sized group by all),
tested as (
  select *, case when k <= n * {MAX_FALSE_REJECTION} then
      list_sum(list_transform(range(0, k + 1), lambda i: exp(
        lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
        + i * ln({MAX_FALSE_REJECTION}) + (n - i) * ln(1 - {MAX_FALSE_REJECTION})))) else 1 end
      * n_tests <= {ERROR} as passed
  from pooled),
reached as (
  select small, own, rule, min(cutoff) as cutoff from tested t
  where step < coalesce((select min(step) from tested f where not f.passed and f.rule = t.rule
                         and f.small = t.small and f.own is not distinct from t.own), 1000000)
  group by all),
chosen as (
  select distinct stratum, reached.rule, reached.cutoff
  from sized join reached on reached.rule = sized.rule and reached.small = sized.small
    and reached.own is not distinct from case when not sized.small then sized.stratum end),
ruled as (
  select *, list_filter([{_BROKEN}], lambda x: x is not null) as broken from judged)
select doc_id, n_words, cast(word_chars as bigint) as word_chars, n_symbols, n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and len(broken) = 0 as kept,
       coalesce(array_to_string(broken, ','), '') as broken_rules
from ruled
"""

OP9 = f"""
with turns as (
  select conv_id, turn, role, text from conversations
  union all select -1, 0, 'user', '{CONTROL_TEXT}'
  union all select -1, 1, 'assistant', '{CONTROL_TEXT}'),
said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         replace(replace(coalesce(text, ''), '~', '~~'), '<|', '<~|') as body,
         replace(replace(replace(coalesce(role, ''), '~', '~~'), '<|', '<~|'), chr(10), '<~n') as head
  from turns)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, head, body)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(string_agg(case when role = 'assistant' then text else '' end, ''
                         order by turn nulls first, head, body)) as loss_sha256,
       cast(sum(length('<|im_start|>' || head || chr(10) || body || '<|im_end|>' || chr(10))) as bigint)
         as formatted_chars,
       cast(0 as bigint) as expanded_tokens
from said
group by conv_id
"""

OP13 = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
lists as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from lists),
sizes as (select lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) as k from starts),
grams as (select lang, k, w[i:i + k - 1] as words, count(*) as a from sizes group by all),
totals as (select lang, cast(sum(a) as hugeint) as n from grams where k = 1 group by lang),
frequent as (select * from grams where a >= 100),
cuts as (
  select f.lang, f.words, f.a, unnest(range(1, f.k)) as cut from frequent f where f.k > 1),
scored as (
  select c.lang, c.words, c.a, cut, l.a as l, r.a as r, n,
         (1000 * cast(c.a as hugeint) * n) // (cast(l.a as hugeint) * r.a) as score
  from cuts c
  join frequent l on l.lang = c.lang and l.words = c.words[1:cut]
  join frequent r on r.lang = c.lang and r.words = c.words[cut + 1:]
  join totals t on t.lang = c.lang),
lowest as (
  select * from scored
  qualify row_number() over (partition by lang, words order by score, cut) = 1),
inside as (
  select distinct lang, a, unnest(flatten(list_transform(range(2, k), lambda m:
           list_transform(range(1, k - m + 2), lambda i: words[i:i + m - 1])))) as words
  from frequent where k > 2),
kept as (
  select lang, array_to_string(words, ' ') as phrase, a, l, r, n, score
  from lowest
  where not exists (
    select 1 from inside where inside.lang = lowest.lang and inside.words = lowest.words and inside.a >= lowest.a))
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
where rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op2_near": OP2,
    "op6_substring": OP6,
    "op7_quality": OP7,
    "op9_chat": OP9,
    "op13_phrases": OP13,
}
