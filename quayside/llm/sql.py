"""SQL for the queries here that SQL can express, for comparison in another engine.

Line rules, mixing, conversation repairs, the main texts of the test pages and collocations have one. Templates grown and
merged level by level, fingerprints, trained classifiers, compression, byte-pair merging, packing and the multi-index have
none; tests hold them against plain Python.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
# The rules' patterns are spelled out again, so that an error in theirs shows.
_MENU = (
    r"(?i)^[^\pL\pN]*(home|menu|log ?in|sign (in|up)|register|next( page)?|prev(ious)?( page)?|back to top|"
    r"skip to (main )?content|read more|search|site ?map|contact( us)?|about us|share|print|reply)[^\pL\pN]*$"
)
_LEGAL = (
    r"(?i)(all rights reserved|copyright (\(c\)|©|[0-9])|privacy policy|terms of (use|service)|"
    r"(accept|use[s]?) (all )?cookies|enable javascript|lorem ipsum|licensed under|permission is hereby granted|"
    r"without warranty|subscribe to our|click here)"
)


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


_N = _count("l", _WORD)
_FAILS = f"""{_N} > 0 and (
    {_count("l", "[#*$%&|<>]")} >= {_N} or {_count("l", "!!")} * 2 >= {_N}
    or ({_N} >= 40 and not regexp_matches(l, '[.!?,;:。！？、…]'))
    or {_count("l", "[|»›]")} * 3 >= {_N} or ({_N} <= 4 and regexp_matches(l, '{_MENU}'))
    or ({_N} <= 40 and regexp_matches(l, '{_LEGAL}')))"""

LINE_RULES = f"""
with texts as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
cut as (select *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) as lines,
    array_to_string(list_filter(string_split(t, chr(10)), lambda l: not ({_FAILS})), chr(10)) as clean from texts),
places as (select rid, w, unnest(range(1, len(w) - 1)) as i from cut where len(w) >= 3),
windows as (select rid, i, count(*) over (partition by rid, w[i], w[i + 1], w[i + 2]) as n from places),
covered as (select rid, count(distinct j) as n from
    (select rid, unnest([i, i + 1, i + 2]) as j from windows where n > 1) group by rid),
counted as (select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    {_count("t", "[#*$%&|<>]")}::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words, {_count("clean", _WORD)} as n_clean
  from cut left join covered using (rid)),
based as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and n_clean * 100 >= n_words * 70 as kept
from based"""

# A source is at its cap if the words left after all caps up to its own, by cap per weight, would overfill it.
MIXING = """
with sized as (select doc_id, source, coalesce(text, '') as t,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
places as (select *, md5('0/' || coalesce(doc_id::varchar, '') || '/' || md5(t)) as place from sized),
sources as (select source, sum(size)::bigint as source_size,
    [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as w from sized group by source),
lined as (select *, sum(source_size * 2) over upto - source_size * 2 as caps, sum(w) over () - sum(w) over upto + w as rest,
    (select sum(size) from sized) * 3 as thrice
  from sources window upto as (order by source_size / w, source nulls last rows unbounded preceding)),
judged as (select *, (thrice - 2 * caps) * w > 4 * source_size * rest as above from lined),
filled as (select source, source_size, w, above, thrice - 4 * coalesce(sum(source_size) filter (where above) over (), 0) as twice_left,
    sum(w) filter (where not above) over () as open_w from judged),
aimed as (select source, source_size, case when above then (2 * source_size)::double
    else (twice_left * w)::double / (2 * open_w)::double end as target from filled),
given as (select *, round_even(target, 0)::bigint as words, greatest(source_size, 1) as per from aimed),
placed as (select p.*, g.source_size, g.target, words // per as passes, words % per as rest,
    sum(size) over (partition by p.source order by place) as upto, sum(size) over (partition by p.source, place) as own
  from places p join given g on p.source is not distinct from g.source)
select doc_id, size, source_size::bigint as source_size, target,
  (size * (passes + case when upto <= rest or (upto - own < rest and upto - rest < rest - (upto - own)) then 1 else 0 end)
  )::bigint as taken
from placed"""


COLLOCATIONS = r"""
with texts as (select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from texts),
worded as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
grams as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda s: array_to_string(w[s:s + k - 1], ' '))) as phrase
  from worded, range(1, 6) as ks(k)),
counts as (select lang, k, phrase, count(*)::bigint as f from grams group by lang, k, phrase),
sizes as (select lang, sum(f)::bigint as n from counts where k = 1 group by lang),
several as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counts where k >= 2 and f >= 100),
inner_phrases as (select lang, a, unnest(list_transform(range(0, k - m + 1), lambda s: array_to_string(w[s + 1:s + m], ' '))) as phrase
  from several, range(2, 5) as ms(m) where m < k),
holders as (select lang, phrase, max(a) as longest from inner_phrases group by lang, phrase),
candidates as (select s.* from several s left join holders h using (lang, phrase)
  where h.longest is null or 100 * h.longest < 100 * s.a),
cuts as (select lang, phrase, a, unnest(range(1, k)) as cut, w, k from candidates),
scored as (select c.lang, c.phrase, c.a, cut, x.f as l, y.f as r, n,
    ((1000::hugeint * c.a * n) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.cut], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ') join sizes z on z.lang = c.lang),
worst as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from worst qualify rank <= 2000"""


# The test pages are all laid out alike, so their main text can be told without looking for it: what <article> holds.
TAG_PATHS = r"""
with held as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) as inside from pages),
cut as (select page_id, url, list_transform(regexp_split_to_array(inside, '</?(?:p|h1)>'), lambda b: trim(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
    '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) as found from held)
select page_id, url, array_to_string(list_filter(found, lambda b: b <> ''), chr(10)) as text,
  length(array_to_string(list_filter(found, lambda b: b <> ''), chr(10)))::bigint as n_chars
from cut"""

# Repairs: per conversation, row after row, the best (cost, audit, text) that ends in each of the four states.


def _moved(path: str, cost: str, edit: str, line: str, first: bool = False) -> str:
    text = line if first else f"{path}.t || chr(10) || {line}"
    return f"case when {path} is not null then {{'c': {path}.c + {cost}, 'a': {path}.a || '{edit}', 't': {text}}} end"


def _best(*paths: str) -> str:
    return f"list_min(list_filter([{', '.join(paths)}], lambda p: p is not null))"


def _dropped(path: str) -> str:
    return f"case when {path} is not null then {{'c': {path}.c + 2, 'a': {path}.a || 'D', 't': {path}.t}} end"


def _stays(path: str, name: str, first: bool = False) -> str:
    """Kept, if the initial fits, or given the role."""
    kept = _moved(path, "extra", "K", "role || ':' || body", first)
    given = _moved(path, "extra + 1", "R", f"'{name}:' || body", first)
    return f"case when not gone and left(role, 1) = '{name[0]}' then {kept} when not gone then {given} end"


_SYSTEM = _moved("p0", "extra", "K", "role || ':' || body", True)
_USER = [_stays("p0", "user", True), _stays("p1", "user"), _stays("p3", "user")]
_INSERTED = [_moved("q0", "5", "I", "'user:'", True), _moved("q1", "5", "I", "'user:'"), _moved("q3", "5", "I", "'user:'")]
CONVERSATIONS = rf"""
with recursive bits(i, k, v) as (select i, 0, i::bigint from range(256) r(i) union all
  select i, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end from bits where k < 8),
crcs as (select list(v order by i) as crc from bits where k = 8),
keyed as (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
fated as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(name, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]))) % 20 as fate from keyed, crcs),
damaged as (select conv_id, turn, case fate when 4 then 'user' else role end as role,
    case fate when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as body,
    unnest(range(case fate when 3 then 2 else 1 end)) as copy from fated where fate <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, body) as i from damaged),
judged as (select *, not regexp_matches(body, '[^\x20\x09-\x0D]') as blank,
    row_number() over (partition by conv_id, role, body order by i) > 1 as seen,
    not regexp_matches(body, '[.!?][\x20\x09-\x0D]*$') as cut_off, lag(role) over (partition by conv_id order by i) as before
  from placed),
steps as (select *, blank or seen as gone, case when cut_off then 5 else 0 end as extra from judged),
ids as (select distinct conv_id from conversations),
paths(conv_id, i, p0, p1, p2, p3) as (
  select conv_id, 0::bigint, {{'c': 0::bigint, 'a': '', 't': ''}}, null::struct(c bigint, a varchar, t varchar),
    {{'c': 5::bigint, 'a': 'I', 't': 'user:'}}, {{'c': 10::bigint, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} from ids
  union all
  select conv_id, i, q0, q1, {_best("r2", _moved("r3", "5", "I", "'user:'"))}, r3 from (
    select *, {_best("q3", _moved("r2", "5", "I", "'assistant:'"))} as r3 from (
      select *, {_best("q2", *_INSERTED)} as r2 from (
        select p.conv_id, s.i, {_dropped("p0")} as q0,
          {_best(_dropped("p1"), f"case when not gone and left(role, 1) = 's' then {_SYSTEM} end")} as q1,
          {_best(_dropped("p2"), *_USER)} as q2, {_best(_dropped("p3"), _stays("p2", "assistant"))} as q3
        from paths p join steps s on s.conv_id is not distinct from p.conv_id and s.i = p.i + 1)))),
counted as (select conv_id, count(*) as rows, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count_if(blank) as blank,
    count_if(seen and not blank) as duplicate, count_if(not gone and cut_off) as truncated,
    count_if(before is not null and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au')) as illegal
  from steps group by conv_id),
ended as (select p.conv_id, {_best("p0", "p3")} as best, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
    coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal
  from paths p left join counted c on c.conv_id is not distinct from p.conv_id where p.i = coalesce(c.rows, 0))
select conv_id, gaps, blank, duplicate, truncated, illegal, best.c as cost, best.a as audit, sha256(best.t) as repaired_sha256
from ended"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_rules": LINE_RULES,
        "op7_mixing": MIXING,
        "op11_conversation_repair": CONVERSATIONS,
        "op12_tag_paths": TAG_PATHS,
        "op13_collocations": COLLOCATIONS,
    }
