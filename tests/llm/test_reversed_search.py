from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from tests.llm.frames import documents, empty, odd
from wakeline.llm import queries, reversed_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, best=10):
    own = [(i, Counter(terms(t))) for i, t in docs]
    n, length = sum(bool(c) for _, c in own), sum(sum(c.values()) for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        asked, rows = Counter(terms(text)), []
        for doc_id, counts in own:
            m = 25 + (75 * sum(counts.values()) * n) // max(length, 1)
            score = 0
            for term, times in asked.items():
                if counts[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += times * w * ((10**9 * counts[term]) // (1000 * counts[term] + 8 * m))
            if score > 0:
                rows.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r + 1, row[3], -row[0]) for r, row in enumerate(sorted(rows)[:best])]
    return sorted(out, key=str)


def found(docs, items, **more):
    return sorted((tuple(r) for r in reversed_search.search(docs, items, **more).collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, doc_id string, n int")


@pytest.mark.parametrize("postings", [1 << 21, 500])
def test_against_brute_force(spark, postings):
    docs = queries.documents(spark, SF)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.collect()])
    assert found(docs.repartition(5), items, postings=postings) == want


def test_heaps_keep_ties_and_move_on(spark, monkeypatch):
    monkeypatch.setattr(reversed_search, "WAITING", 20)
    monkeypatch.setattr(reversed_search, "MERGED", 1)
    monkeypatch.setattr(reversed_search, "CELLS", 9)
    rows = [(i, "equal words here" if i % 3 else f"words {i}", "en", "a") for i in range(300)]
    docs = documents(spark, rows + rows[:40])
    asked = [(1, "Equal WORDS"), (2, "here"), (3, "7 words"), (4, "nothing"), (5, "here here")]
    every = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, items_of(spark, asked)) == brute(every, asked)


def test_odd_rows(spark):
    asked = [(1, "one TWO 中文"), (1, "word3 and7"), (None, "five words"), (2, None), (3, ""), (4, "!! --"), (5, "É é 34")]
    asked.append((6, "y" * 3_000_000))
    docs = odd(spark).union(documents(spark, [(8, "y" * 3_000_000, "en", "a"), (9, "É word3", "en", "a")]))
    every = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(docs, items_of(spark, asked)) == brute(every, asked)


def test_empty_tables(spark):
    none = items_of(spark, [(1, "a")]).where("item_id > 1")
    assert found(empty(spark), items_of(spark, [(1, "a")])) == []
    assert found(odd(spark), none) == []
    assert reversed_search.search(odd(spark), none).columns == ["item_id", "rank", "doc_id", "score"]
