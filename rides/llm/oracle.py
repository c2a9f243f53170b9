"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
with d as (
  select doc_id, coalesce(text, '') as t from documents
), w as (
  select doc_id, t, regexp_extract_all(t, '{WORD}') as words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines
  from d
), places as (
  select doc_id, words, unnest(range(1, len(words) - 6)) as i from w where len(words) >= 8
), grams as (
  select doc_id, i, array_to_string(words[i:i + 7], ' ') as gram from places
), twice as (
  select doc_id, i from (
    select doc_id, i, count(*) over (partition by doc_id, gram) as n from grams) x where n > 1
), covered as (
  select doc_id, count(distinct i + j) as n
  from (select doc_id, i, unnest(range(0, 8)) as j from twice) y group by doc_id
), m as (
  select w.doc_id, len(words) as n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(covered.n, 0) as n_repeat_words
  from w left join covered on w.doc_id = covered.doc_id
), b as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
  cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or word_chars < 3 * n_words
       or word_chars > 10 * n_words or 2 * n_dup_lines > n_lines) as kept
from b
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
with d as (
  select doc_id, regexp_extract_all({_LOWER}, '{ITEM_WORD}') as words from documents
), b as (
  select item_id, regexp_extract_all({_LOWER}, '{ITEM_WORD}') as words from benchmark
), sized as (
  select item_id, words, least(len(words), 10) as n from b where len(words) > 0
), windows as (
  select distinct item_id, n, array_to_string(words[i:i + n - 1], ' ') as win
  from (select item_id, words, n, unnest(range(1, len(words) - n + 2)) as i from sized) x
), lengths as (
  select distinct n from windows
), spots as (
  select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i
  from d, lengths where len(words) >= n
), hit as (
  select s.doc_id, s.i, s.n, w.item_id
  from (select doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') as win from spots) s
  join windows w on s.n = w.n and s.win = w.win
), words_hit as (
  select doc_id, count(distinct i + j) as n_hit
  from (select doc_id, i, unnest(range(0, n)) as j from hit) y group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from hit) z group by doc_id
)
select d.doc_id, cast(len(d.words) as bigint) as n_words,
  cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
  cast(coalesce(i.n_items, 0) as bigint) as n_items,
  sha256(coalesce(i.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from d left join words_hit h on d.doc_id = h.doc_id left join items i on d.doc_id = i.doc_id
"""

_SAFE = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

CHAT = rf"""
with all_turns as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), base as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as seq
  from all_turns
), sized as (
  select *, seq = 1 and role = 'system' as is_system,
    len(regexp_extract_all(text, '{WORD}')) + 1 as tokens,
    length({_SAFE.format('role')}) + length({_SAFE.format('text')}) + 11 as chars
  from base
), own as (
  select *, case when is_system then 0 else tokens end as own from sized
), sums as (
  select *, coalesce(sum(own) over (partition by conv_id order by seq
      rows between unbounded preceding and 1 preceding), 0) as start,
    sum(own) over (partition by conv_id) as total, max(own) over (partition by conv_id) as longest,
    max(case when is_system then tokens else 0 end) over (partition by conv_id) as sys_tokens,
    max(case when is_system then chars else 0 end) over (partition by conv_id) as sys_chars
  from own
), strided as (
  select *, 512 - sys_tokens - longest as free,
    greatest(512 - sys_tokens - longest - 128, 1) as stride from sums
), placed as (
  select *, greatest(least(free - stride + 1, 128), 0) as room,
    cast(floor(start / stride) as bigint) as span from strided
), spans as (
  select *, min(start) over (partition by conv_id, span) as span_start,
    max(start + own) over (partition by conv_id, span) as span_stop from placed
)
select conv_id, cast(count(*) as bigint) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by seq)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by seq)) as loss_sha256,
  cast(sum(chars
    + case when not is_system and span_stop < total and span_stop - start <= room then chars else 0 end
    + case when not is_system and span > 0 and start = span_start then sys_chars else 0 end) as bigint)
    as formatted_chars
from spans group by conv_id
"""

# CRC-32 (reflected polynomial 0xEDB88320) of the decimal text of doc_id, by a
# table of bytes that the polynomial makes.
CRC = """
crc_table as (
  select list(v order by b) as steps from (
    select b, list_reduce(list_concat([b], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))) as v
    from (select unnest(range(256)) as b) y) x
), crc as (
  select doc_id as crc_id, xor(list_reduce(
      list_concat([4294967295], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
      lambda x, c: xor(x >> 8, steps[(xor(x, c) & 255) + 1])), 4294967295) as h
  from (select distinct doc_id from documents where doc_id is not null) d, crc_table
)"""

TREE_LEVELS = 9                     # 8^9 leaves a tree


def _merkle() -> str:
    def enc(name: str) -> str:
        return f"coalesce(cast(strlen({name}) as varchar) || ':' || {name}, '-')"

    head = " || ".join(enc(f"cast({c} as varchar)") for c in ("doc_id", "source", "lang", "n_chars"))
    parts = [CRC.strip(), f"""doc as (
  select d.doc_id, lang, sha256({head} || {enc("text")}) as leaf, sha256({head} || {enc(
        "case when h % 3 = 0 then translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else text end"
    )}) as claimed from documents d left join crc on d.doc_id = crc_id
), leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i,
    count(*) over (partition by lang) as n from doc
)"""]

    def tree(prefix: str, key: str, base: str) -> None:
        """Levels of one kind of tree (key, i, n, digest), and the proof of each node of level 0."""
        on = f"r.{key} is not distinct from p.{key}"
        parts.append(f"{prefix}0 as ({base})")
        parts.append(f"{prefix}p0 as (select {key}, i, i as node, '' as proof from {prefix}0)")
        for h in range(1, TREE_LEVELS + 1):
            below, shorter = f"{prefix}{h - 1}", 8 ** (h - 1)
            parts.append(f"""{prefix}{h} as (
  select {key}, i // 8 as i, any_value(n) as n, case when any_value(n) > {shorter}
    then sha256(string_agg(digest, '' order by i)) else any_value(digest) end as digest
  from {below} group by {key}, i // 8)""")
            parts.append(f"""{prefix}p{h} as (
  select p.{key}, p.i, p.node // 8 as node, p.proof || coalesce(
    (select string_agg(r.digest, '' order by r.i) from {below} r
     where {on} and r.i // 8 = p.node // 8 and r.i <> p.node), '') as proof
  from {prefix}p{h - 1} p)""")

    tree("t", "lang", "select lang, i, n, leaf as digest from leaves")
    top = TREE_LEVELS
    parts.append(f"""langs as (
  select 0 as forest, lang, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n, digest
  from t{top})""")
    tree("f", "forest", "select forest, i, n, digest from langs")
    fold = []
    for prefix, n, key in (("t", "l.n", "l.lang"), ("f", "g.n", "g.forest")):
        for h in range(1, TREE_LEVELS + 1):
            fold.append((prefix, n, key, h))
    # the root from a claimed leaf: level by level over its run with its own digest replaced
    previous = "fold0"
    parts.append("""fold0 as (
  select l.doc_id, l.lang, l.i, l.leaf, l.i as a, l.n as tn, g.i as b, g.n as gn, l.claimed as digest
  from leaves l join langs g on l.lang is not distinct from g.lang)""")
    for j, (prefix, _, key, h) in enumerate(fold, 1):
        at, size = ("a", "tn") if prefix == "t" else ("b", "gn")
        on = "r.lang is not distinct from x.lang" if prefix == "t" else "true"
        parts.append(f"""fold{j} as (
  select x.doc_id, x.lang, x.i, x.leaf, {"x.a // 8 as a, x.tn, x.b" if prefix == "t" else "x.a, x.tn, x.b // 8 as b"}, x.gn,
    case when any_value(x.{size}) > {8 ** (h - 1)} then sha256(string_agg(
      case when r.i = x.{at} then x.digest else r.digest end, '' order by r.i)) else any_value(x.digest) end as digest
  from {previous} x join {prefix}{h - 1} r on {on} and r.i // 8 = x.{at} // 8
  group by x.doc_id, x.lang, x.i, x.leaf, x.a, x.tn, x.b, x.gn)""")
        previous = f"fold{j}"
    return "with " + ", ".join(parts) + f"""
select x.doc_id, x.leaf, s.digest as subroot, r.digest as root, sha256(p.proof || q.proof) as proof_sha256,
  x.digest as folded_root, x.digest = r.digest as verified
from {previous} x join langs s on x.lang is not distinct from s.lang
join f{top} r on true
join tp{top} p on x.lang is not distinct from p.lang and x.i = p.i
join fp{top} q on s.i = q.i
"""


def _periodic_runs() -> str:
    """Runs from equal grams: at width w, a period in (w/2, w] (at 16: up to
    16) is the distance to the next equal gram of w words, at every place from
    the run's start on, as far as both grams lie inside it."""
    widths = [16 << k for k in range(17)]
    parts = [CRC.strip(), f"""words as (
  select row_number() over () as k, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents
), sized as (
  select k, doc_id, w, len(w) as n, h, h // 10 as g from words left join crc on doc_id = crc_id
), copied as (
  select k, doc_id, w, n, case when h % 10 = 0 and n > 0 then g % n end as a,
    case when h % 10 = 0 and n > 0 then 1 + (n - g % n) // (3 + g % 8) end as p from sized
), places as (
  select k, w, a, p, unnest(range(n)) as i from copied
), x as (
  select k, i, case when i >= a then w[a + (i - a) % p + 1] else w[i + 1] end as word from places
), g1 as (select k, i, hash(word) as h from x)"""]
    width = 1
    while width < widths[-1]:
        parts.append(f"""g{2 * width} as (
  select k, i, hash(h, after) as h from (
    select k, i, h, lead(h, {width}) over (partition by k order by i) as after from g{width}) y
  where after is not null)""")
        width *= 2
    pairs = " union all ".join(
        f"""select k, i, d, {w} as width from (
    select k, i, lead(i) over (partition by k, h order by i) - i as d from g{w}) y{w}
  where d <= {w}""" + (f" and d > {w // 2}" if w > 16 else "") for w in widths)
    parts.append(f"""pairs as ({pairs}), islands as (
  select k, d, width, i, i - row_number() over (partition by k, d, width order by i) as island from pairs
), runs as (
  select k, min(i) as start, max(i) - min(i) + width + d as length, d as period
  from islands group by k, d, width, island having max(i) - min(i) + width + d >= greatest(24, 3 * d)
), dropped as (
  select distinct k, unnest(range(start + period, start + length)) as i from runs
), kept as (
  select x.k, string_agg(word, ' ' order by x.i) as t from x
  left join dropped d on x.k = d.k and x.i = d.i where d.i is null group by x.k
), summed as (
  select k, count(*) as n_runs,
    sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256
  from runs group by k
), best as (
  select r.* from runs r where not exists (
    select 1 from runs o where o.k = r.k and (o.length * r.period > r.length * o.period
      or (o.length * r.period = r.length * o.period and (o.start < r.start
        or (o.start = r.start and o.period < r.period)))))
)""")
    return "with " + ", ".join(parts) + """
select c.doc_id, cast(coalesce(s.n_runs, 0) as bigint) as n_runs, cast(b.start as bigint) as start,
  cast(b.length as bigint) as length, cast(b.period as bigint) as period,
  cast(1000 * b.length // b.period as bigint) as exponent_milli,
  coalesce(s.runs_sha256, sha256('')) as runs_sha256, sha256(coalesce(t.t, '')) as collapsed_sha256
from copied c left join summed s on c.k = s.k left join best b on c.k = b.k left join kept t on c.k = t.k
"""


TOP_K = """
with v as (
  select vec_id, list_transform(embedding, lambda c: cast(floor(64 * cast(c as double)) as bigint)) as x,
    row_number() over () as k
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
), scores as (
  select q.vec_id as query_id, q.k, c.vec_id, list_sum(list_transform(
      range(1, len(q.x) + 1), lambda i: q.x[i] * c.x[i])) as score
  from v q join v c on q.k <> c.k and len(q.x) = len(c.x) where q.vec_id % 20 = 0
), placed as (
  select *, row_number() over (partition by k order by score desc, vec_id nulls last) as place from scores
)
select query_id, cast(place as integer) as rank, vec_id, cast(score as bigint) as score
from placed where place <= 20
"""

SQL: dict[str, str] = {
    "op3_quality_rules": QUALITY,
    "op5_decontamination": DECONTAMINATION,
    "op7_chat_format": CHAT,
    "op11_merkle": _merkle(),
    "op12_periodic_runs": _periodic_runs(),
    "op13_bit_sliced": TOP_K,
}
