from __future__ import annotations

import random
import re

import pytest

from tests.llm.frames import documents, empty, odd
from wakeline.llm import components, ngram_join, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    width = min(5, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def groups(texts):
    """Smallest id of every component, by comparing all pairs that share a shingle."""
    sets, holders, parent = {i: shingles(t) for i, t in texts.items()}, {}, {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sorted(sets.items()):
        seen = set()
        for x in s:
            seen.update(holders.setdefault(x, []))
            holders[x].append(i)
        for j in seen:
            both = len(s & sets[j])
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def got(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, sf).collect()}
    assert got(queries.QUERIES["op7_ngram_join"](spark, sf)) == groups(texts)


def near_copies(seed=0, count=300):
    """Chains and clusters of edited copies, copies of passages, short texts, case and spacing."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 5)))
    passage = [word() for _ in range(60)]
    bases = [[word() for _ in range(rng.choice([3, 5, 8, 40, 120]))] for _ in range(12)]
    texts = {}
    for i in range(count):
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            own[rng.randrange(len(own))] = word()
        if rng.random() < 0.3:
            own += passage
        if rng.random() < 0.1:
            bases.append(own)
        texts[i] = rng.choice([" ", "\n", "  "]).join(own)
        if rng.random() < 0.2:
            texts[i] = texts[i].upper()
    return texts


@pytest.mark.parametrize("seed, frequent", [(0, 64), (1, 4)])
def test_edited_copies(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    texts = near_copies(seed)
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    assert got(ngram_join.similar_groups(docs)) == groups(texts)


def test_a_large_group_of_near_copies_costs_few_pairs(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[: i % 90] + [f"x{i}"] + base[i % 90 :]), "en", "a") for i in range(400)]
    docs = documents(spark, rows)
    found = got(ngram_join.similar_groups(docs))
    assert {c for _, c in found.values()} == {0}


def test_odd_rows(spark):
    docs = odd(spark)
    found = ngram_join.similar_groups(docs).collect()
    assert len(found) == docs.count()
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["n_shingles"] for i in (1, 2, 3)] == [0, 0, 0]
    assert [by_id[i]["component_id"] for i in (1, 2, 3, 4, None)] == [1, 2, 3, 4, None]
    assert ngram_join.similar_groups(empty(spark)).count() == 0


def test_one_of_each(spark):
    docs = odd(spark)
    left = ngram_join.one_of_each(docs)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(ids, key=str) == sorted([1, 2, 3, 4, 5, None, 6, 7], key=str)
    texts = near_copies(2, 100)
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    kept = {r["doc_id"] for r in ngram_join.one_of_each(docs).collect()}
    assert kept == {c for _, c in groups(texts).values()}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(1900, 1990)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["component"] for r in found}
    assert got == {n: root(n) for a, b in edges if a != b for n in (a, b)}
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).count() == 0


def test_repeated_ids_with_other_texts(spark):
    """Every text of an id takes part, and what one links with all do."""
    a, b = (" ".join(f"{k}{i}" for i in range(40)) for k in "ab")
    rows = [(7, a), (3, a), (7, b), (9, b), (20, b + " more"), (20, b + " more"), (30, "apart " * 9), (30, "")]
    found = ngram_join.similar_groups(documents(spark, [(*r, "en", "a") for r in rows])).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in found} == {7: 3, 3: 3, 9: 3, 20: 3, 30: 30}


def test_pairs_follow_the_entries_in_columns_of_any_length(spark, monkeypatch):
    """Every row meets the column's pivots, once each, and no other row."""
    monkeypatch.setattr(ngram_join, "_possible", lambda met, sizes, percent: met)
    few = len(ngram_join.MASKS)
    for length in (1, 2, 3, 9, 16, 17, 60):
        column = spark.range(length).selectExpr("7L shingle", "id * 7919 - 20000 node")
        met = [tuple(r) for r in ngram_join._near_pairs(column, None, 75).collect()]
        assert len(met) == len(set(met)) and all(a < b for a, b in met)
        assert {n for pair in met for n in pair} == ({i * 7919 - 20000 for i in range(length)} if length > 1 else set())
        pivots = min(few, length)
        assert len(met) <= pivots * (length - pivots) + pivots * (pivots - 1) // 2
