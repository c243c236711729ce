"""Secret scans behind a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: alternatives, each a
set of trigrams that any match must hold. The index has a row for every document and query trigram
that its lower-cased text holds. Intersecting postings gives the candidates of each rule, and only
those are searched with the expression itself. A rule whose matches need hold no trigram, such as a
run of hexadecimal digits, is searched in every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _parser as regex_syntax

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import kept, text_of

#: Most literal strings that one stretch of an expression is spelled out into.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a match counts if its group has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, then well-known token formats.
RULES = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
BASE_KINDS = ("assign", "access", "hex")


def _strings(op, value) -> set[str] | None:
    """All strings a part of an expression can match, or nothing if there are too many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(value).lower()}
    if name == "IN":
        if all(str(kind) == "LITERAL" for kind, _ in value) and len(value) <= 8:
            return {chr(code).lower() for _, code in value}
        return None
    if name == "SUBPATTERN":
        return _sequence_strings(value[-1])
    if name == "BRANCH":
        each = [_sequence_strings(branch) for branch in value[1]]
        return None if None in each else set().union(*each)
    if name == "MAX_REPEAT" and value[1] == 1:
        inner = _sequence_strings(value[2])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _sequence_strings(parts) -> set[str] | None:
    each = [_strings(op, value) for op, value in parts]
    if None in each:
        return None
    found = {"".join(x) for x in product(*each)}
    return found if len(found) <= MOST_STRINGS else None


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams that a lower-cased text with a match holds; empty if none must be."""
    stretches, current = [], {""}
    for op, value in [*regex_syntax.parse(pattern), (None, None)]:
        found = _strings(op, value)
        if found is None or len(found) * len(current) > MOST_STRINGS:
            stretches.append(current)
            current = found or {""}
        else:
            current = {a + b for a in current for b in found}
    clauses = [s for s in stretches if min(map(len, s)) >= 3]
    sets = [[{t[i : i + 3] for i in range(len(t) - 2)} for t in s] for s in clauses]
    while len(sets) > 1 and len(sets[0]) * len(sets[1]) <= MOST_STRINGS:
        sets[:2] = [[a | b for a in sets[0] for b in sets[1]]]
    return [frozenset(x) for x in sets[0]] if sets else []


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``doc_id, trigram``: the postings of every given trigram."""
    text = F.lower(text_of("text"))
    held = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("t"), t))
    rows = docs.select("doc_id", text.alias("t"))
    return kept(rows.select("doc_id", F.explode(held).alias("trigram")))


def candidates(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id, kinds``: the rules whose trigram query a document's postings satisfy."""
    queries = [(r.kind, alt) for r in rules for alt in trigram_query(r.pattern)]
    trigrams = sorted(set().union(*[alt for _, alt in queries]))
    bits = [
        F.struct(
            F.lit(t).alias("trigram"),
            F.lit(number).alias("query"),
            F.lit(1 << sorted(alt).index(t)).cast("long").alias("bit"),
        )
        for number, (_, alt) in enumerate(queries)
        for t in sorted(alt)
    ]
    whole = F.create_map(
        *[F.lit(x) for n, (_, alt) in enumerate(queries) for x in (n, (1 << len(alt)) - 1)]
    )
    kind = F.create_map(*[F.lit(x) for n, (k, _) in enumerate(queries) for x in (n, k)])
    wanted = docs.sparkSession.range(1).select(F.inline(F.array(*bits)))
    hits = trigram_index(docs, trigrams).join(wanted, "trigram")
    held = hits.groupBy("doc_id", "query").agg(F.bit_or("bit").alias("bits"))
    found = held.where(F.col("bits") == F.element_at(whole, F.col("query")).cast("long"))
    return found.groupBy("doc_id").agg(
        F.collect_set(F.element_at(kind, F.col("query"))).alias("kinds")
    )


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Matches as ``start, order, end`` in code points: lengths of matches and of what is between."""
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(
        F.split(text, rule.pattern).alias("before"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("own"),
    )
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"))
        counts = F.length(x["own"]) >= rule.least
        return F.struct(
            end.alias("at"),
            F.when(counts, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), none.alias("out"))
    searched = F.aggregate(parts, begin, step)["out"]
    return F.when(text.rlike(rule.pattern), searched).otherwise(none)


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """``doc_id, spans`` for every row: an array of ``start, order, end``, by start, then rule.

    ``order`` is the rule's place in ``rules``; positions are code points, the end exclusive. A
    null or empty text has no spans. Rows that share a ``doc_id``, null among them, are searched
    for what any of them is a candidate of, which finds the same. An empty table gives none;
    further columns are ignored.
    """
    none = F.array().cast("array<struct<start:int,order:int,end:int>>")
    found = candidates(docs, rules).withColumnRenamed("doc_id", "d")
    rows = docs.select("doc_id", text_of("text").alias("t"))
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("d")), "left")
    each = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("t"), rule, order)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("kinds", rule.kind), spans).otherwise(none)
        each.append(spans)
    return rows.select("doc_id", F.array_sort(F.concat(*each)).alias("spans"))


def span_text(spans: Column, rules=RULES) -> Column:
    """``kind:start:end``, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"], s["end"]),
        ),
        ",",
    )
