from __future__ import annotations

import re
from collections import Counter

import numpy as np

from tests.llm.frames import documents, empty, odd
from wakeline.llm import quality_rules, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def got(r):
    return tuple(r[c] for c in (*quality_rules.BASE_COLUMNS, "base_failed"))


def test_query(spark):
    found = queries.QUERIES["op2_robust_quality"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, SF).collect()}
    assert len(found) == len(texts)
    assert all(got(r) == base(texts[r["doc_id"]]) for r in found)
    assert not any(r["kept"] for r in found if r["base_failed"])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    quality = {r["doc_id"]: r["quality"] for r in labels}
    clean = [r["kept"] for r in found if quality.get(r["doc_id"]) == 1 and not r["base_failed"]]
    junk = [r["kept"] for r in found if quality.get(r["doc_id"]) == 0]
    assert all(clean) and np.mean(junk) < 0.2


def test_distances_are_those_of_a_robust_estimate(spark):
    """Many outliers of one kind do not move the centre, and numpy agrees on the distances."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(80)]
        if i % 5 == 0:
            words = [w + "***$$$" for w in words]
        rows.append((i, " ".join(words), "en", "a"))
    found = {r["doc_id"]: r for r in quality_rules.quality(documents(spark, rows)).collect()}
    assert all(found[i]["kept"] == (i % 5 != 0) for i in range(400))
    near = [found[i]["distance"] for i in range(400) if i % 5]
    far = [found[i]["distance"] for i in range(400) if i % 5 == 0]
    assert max(near) < 20 < min(far)


def test_small_groups_pool_by_language_and_smaller_ones_are_not_judged(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text + f" x{i}", "en", f"s{i % 40}") for i in range(200)]
    rows += [(1000 + i, text + f" y{i}", None, None) for i in range(5)]
    found = quality_rules.quality(documents(spark, rows)).collect()
    assert all(r["kept"] for r in found)
    assert all((r["distance"] is None) == (r["doc_id"] >= 1000) for r in found)


def test_odd_rows(spark):
    docs = odd(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = quality_rules.quality(docs).collect()
    assert len(found) == docs.count()
    assert all(got(r) == base(texts[r["doc_id"]]) for r in found)
    assert quality_rules.quality(empty(spark)).count() == 0
