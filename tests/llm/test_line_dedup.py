from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tests.llm.frames import documents, empty, odd
from wakeline.llm import line_dedup, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def removed(texts, percent=80):
    """Lines with an earlier similar one, each compared with all that share a word."""
    sets, holders, out = [], {}, {}
    for doc_id in sorted(texts):
        for number, line in enumerate((texts[doc_id] or "").split("\n")):
            own = frozenset(WORD.findall(line.translate(LOWER)))
            if not own:
                continue
            earlier = {j for w in own for j in holders.get(w, ())}
            for j in earlier:
                both = len(own & sets[j])
                if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                    out.setdefault(doc_id, []).append(number)
                    break
            for w in own:
                holders.setdefault(w, []).append(len(sets))
            sets.append(own)
    return out


def got(frame):
    return {r["doc_id"]: r["removed"] for r in frame.collect()}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, sf).collect()}
    rows = queries.QUERIES["op6_line_join"](spark, sf).collect()
    want = removed(texts)
    assert len(rows) == len(texts)
    for r in rows:
        assert r["removed"] == want.get(r["doc_id"], [])
        assert (r["n_lines"], r["n_removed"]) == (texts[r["doc_id"]].count("\n") + 1, len(r["removed"]))


@pytest.mark.parametrize("seed, frequent", [(0, 10**6), (1, 4), (2, 1)])
def test_edited_lines(spark, monkeypatch, seed, frequent):
    """Every share of frequent words, down to all of them."""
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(line_dedup, "LOCAL", 1)
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(40)] + ["The", "of", "and"]
    lines = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 30))] for _ in range(60)]
    texts = {}
    for doc_id in range(80):
        own = []
        for _ in range(rng.randint(1, 6)):
            line = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice(vocabulary)
            rng.shuffle(line)
            own.append(" ".join(line).upper() if rng.random() < 0.2 else " ".join(line))
        texts[doc_id] = "\n".join(own)
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    assert got(line_dedup.later_lines(docs)) == removed(texts)


def test_close_pairs_loses_none():
    rng = np.random.default_rng(0)
    sets = [frozenset(rng.choice(25, rng.integers(5, 12), replace=False).tolist()) for _ in range(150)]
    rows = []
    for node, own in enumerate(sets):
        n, bits = len(own), (sum(1 << w for w in own if w < 12), sum(1 << w for w in own if w >= 12))
        lead = n - (80 * n + 99) // 100 + 1
        rows += [(w, node, node % 9, n, at, bits) for at, w in enumerate(sorted(own)[:lead])]
    entries = np.array(rows, dtype=line_dedup.ENTRY)
    found = {tuple(p) for p in line_dedup.close_pairs(entries, 80).tolist()}
    first = line_dedup.earliest_partners(entries, 80)
    known = {tuple(sorted(p)) for p in zip(first["a"], first["b"])}
    more = set(first["a"][first["more"]])
    for a in range(150):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                assert (b, a) in found
                # the first step has the pair, or the later line is looked at again
                assert (b, a) in known or (a if a % 9 > b % 9 else b) in more


def test_odd_rows(spark):
    docs = odd(spark)
    shorter = line_dedup.without_later_lines(docs)
    assert shorter.columns == docs.columns and shorter.count() == docs.count()
    by_id = {r["doc_id"]: r for r in shorter.collect()}
    assert by_id[1]["text"] is None and by_id[2]["text"] == ""
    assert by_id[4]["text"] == "one two three four five six seven" and by_id[4]["n_chars"] == 33
    assert by_id[None]["text"] == "no id here at all, but five words"
    assert line_dedup.without_later_lines(empty(spark)).count() == 0
    report = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.line_report(docs).collect()}
    assert (report[1], report[2], report[4]) == ((0, 0), (1, 0), (2, 1))
