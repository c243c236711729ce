"""SQL for the queries that another engine can express."""

from __future__ import annotations

from wakeline.llm.secrets import BASE_KINDS, RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _spans(order: int) -> str:
    """Matches of a rule as ``[start, order, end]``, from lengths of matches and of what is between."""
    rule = RULES[order]
    pattern = _quoted(rule.pattern)
    return f"""
  list_transform(
    list_filter(
      list_transform(
        list_zip(regexp_extract_all(t, {pattern}, 0), regexp_extract_all(t, {pattern}, {rule.group}),
                 range(1, len(regexp_extract_all(t, {pattern}, 0)) + 1)),
        lambda m: struct_pack(
          s := length(array_to_string(regexp_split_to_array(t, {pattern})[1:m[3]], ''))
               + length(array_to_string(regexp_extract_all(t, {pattern}, 0)[1:m[3] - 1], '')),
          n := length(m[1]), own := length(m[2]))),
      lambda m: m.own >= {rule.least}),
    lambda m: [m.s, {order}, m.s + m.n])"""


def _text(spans: str) -> str:
    kinds = "[" + ", ".join(_quoted(r.kind) for r in RULES) + "]"
    each = f"list_transform({spans}, lambda s: concat({kinds}[s[2] + 1], ':', s[1], ':', s[3]))"
    return f"coalesce(array_to_string({each}, ','), '')"


def secret_scan() -> str:
    every = ", ".join(_spans(order) for order in range(len(RULES)))
    base = f"list_filter(spans, lambda s: s[2] < {len(BASE_KINDS)})"
    counts = ", ".join(
        f"cast(len(list_filter(spans, lambda s: s[2] = {order})) as bigint) as n_{kind}"
        for order, kind in enumerate(BASE_KINDS)
    )
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
found as (select doc_id, list_sort(flatten([{every}])) as spans from texts)
select doc_id, {counts}, sha256({_text(base)}) as base_sha256, {_text('spans')} as spans from found"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, byte by byte and bit by bit."""
    bits = (
        "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: "
        "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)"
    )
    codes = f"list_transform(string_split({text}, ''), lambda x: ord(x)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda a, b: {bits}), 4294967295::bigint)"


def reversed_search() -> str:
    """Scores of all documents that share a term with an item."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pattern = _quoted(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def split(table: str, key: str) -> str:
        text = f"translate(text, '{upper}', '{upper.lower()}')"
        return f"select {key}, unnest(regexp_extract_all({text}, {pattern})) as term from {table}"

    return f"""
with words as ({split('documents', 'doc_id')}),
counts as (select doc_id, term, count(*) as tf from words group by all),
sizes as (select doc_id, sum(tf)::bigint as n from counts group by all),
whole as (select count(*)::bigint as c, sum(n)::bigint as l from sizes),
weights as (select term, floor(1000 * ln((2 * c + 2) / (2 * count(*) + 1)))::bigint as w
            from counts, whole group by term, c),
asked as (select item_id, term, count(*) as times from ({split('benchmark', 'item_id')}) group by all),
found as (
  select item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * c) // l))))::bigint as score
  from asked join counts using (term) join weights using (term) join sizes using (doc_id), whole
  group by all having score > 0)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from found)
where rank <= 10"""


def conversation_repair() -> str:
    """Cheapest edits row by row: the least cost, audit and text of every state, from the first row on.

    Two audits of one cost that lead to one state are never one the beginning of the other, so the
    least beginning is that of the least whole.
    """
    key = "concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' '))"
    space = _quoted(r"[\x20\x09-\x0D]+")
    end = _quoted(r"[.!?][\x20\x09-\x0D]*$")

    def plus(x: str, cost: str, letter: str, line: str) -> str:
        return f"struct_pack(cost := {x}.cost + {cost}, audit := {x}.audit || '{letter}', out := {line})"

    def least(options: list[str]) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda o: o.cost < 1000000000))[1]"

    never = "struct_pack(cost := 1000000000::bigint, audit := '', out := []::varchar[])"

    def states(forms: list[list[str]]) -> str:
        return ", ".join(f"coalesce({least(f)}, {never}) as x{i}" for i, f in enumerate(forms))

    def inserted(x: str, role: str) -> str:
        return plus(x, "5", "I", f"list_append({x}.out, '{role}:')")

    # user rows may come after all states but 2, assistant rows after 2 only
    once = states(
        [["x0"], ["x1"], ["x2", *[inserted(f"x{k}", "user") for k in (0, 1, 3)]], ["x3", inserted("x2", "assistant")]]
    )
    more = states([["x0"], ["x1"], ["x2", inserted("x3", "user")], ["x3", inserted("x2", "assistant")]])
    late = "case when fault = 'truncated' then 5 else 0 end"

    def step(to: int) -> str:
        options = [plus(f"x{to}", "2", "D", f"x{to}.out")]
        came = {0: [], 1: [0], 2: [0, 1, 3], 3: [2]}[to]
        for x in (f"x{k}" for k in came):
            line = f"list_append({x}.out, role || ':' || text)"
            keep = plus(x, late, "K", line)
            stay = f"fault in ('none', 'truncated') and left(role, 1) = '{'-sua'[to]}'"
            options.append(f"case when {stay} then {keep} else {never} end")
            if to > 1:
                line = f"list_append({x}.out, '{('user', 'assistant')[to - 2]}:' || text)"
                change = plus(x, f"1 + {late}", "R", line)
                options.append(f"case when fault in ('none', 'truncated') then {change} else {never} end")
        return f"coalesce({least(options)}, {never}) as x{to}"

    moved = ", ".join(step(to) for to in range(4))
    return f"""
with recursive hurt as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc32(key)} % 20 as fate
  from conversations),
rows_ as (
  select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when fate = 3 then 2 else 1 end)) as again
  from hurt where fate <> 0),
seen as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), again) as pos,
    row_number() over (partition by conv_id, role, text order by turn nulls first, again) as time_
  from rows_),
marked as (
  select *, case when regexp_replace(text, {space}, '', 'g') = '' then 'blank' when time_ > 1 then 'duplicate'
    when not regexp_matches(text, {end}) then 'truncated' else 'none' end as fault,
    lag(role) over (partition by conv_id order by pos) as before
  from seen),
walk as (
  select conv_id, 0::bigint as pos, struct_pack(cost := 0::bigint, audit := '', out := []::varchar[]) as x0,
    {never} as x1, {never} as x2, {never} as x3
  from (select distinct conv_id from conversations)
  union all
  select conv_id, pos, {moved} from (
    select t.*, m.role, m.text, m.fault from (
      select conv_id, pos + 1 as pos, {more} from (select conv_id, pos, {once} from walk)
    ) t join marked m on m.conv_id is not distinct from t.conv_id and m.pos = t.pos)),
last as (
  select conv_id, {least(['x0', 'x3'])} as best
  from (select conv_id, pos, {more} from (select conv_id, pos, {once} from (
    select * from walk qualify row_number() over (partition by conv_id order by pos desc) = 1)))),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id)
select l.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, best.cost as cost, best.audit as audit,
  sha256(array_to_string(best.out, chr(10))) as repaired_sha256
from last l left join counts c on c.conv_id is not distinct from l.conv_id"""
