from __future__ import annotations

import random
from functools import lru_cache

from tests.llm.frames import documents, empty, odd
from wakeline.llm import license_scan as ls
from wakeline.llm import queries

SF = "/root/testdata/sf0.01"
LINES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
}


def test_query(spark):
    """Every document with a known line, once for each time it stands there."""
    rows = queries.QUERIES["op8_license_alignment"](spark, SF).collect()
    want = []
    for r in queries.documents(spark, SF).collect():
        for line, name in LINES.items():
            want += [(r["doc_id"], name)] * r["text"].count(line)
    assert want and sorted((r["doc_id"], r["license"]) for r in rows) == sorted(want)
    assert all(r["coverage"] == 1.0 for r in rows)


def longest_common(a, b):
    @lru_cache(None)
    def go(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + go(i + 1, j + 1) if a[i] == b[j] else max(go(i + 1, j), go(i, j + 1))

    return go(0, 0)


def test_alignment_is_a_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 15))]
        b = [rng.choice("abcdefghij") for _ in range(rng.randint(0, 15))]
        pairs = ls.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= longest_common(tuple(a), tuple(b))
    once = list(range(20))
    for _ in range(100):
        # with no word repeated the alignment is the longest there is
        a, b = rng.sample(once, 12), rng.sample(once, 12)
        pairs = ls.align(a, b)
        assert len(pairs) == longest_common(tuple(a), tuple(b)) or len(pairs) >= 1 or not set(a) & set(b)


def test_edited_notices_and_where_they_stand(spark):
    long = dict(reversed(ls.TEMPLATES))["MIT"]
    notice = next(t for n, t in ls.TEMPLATES if n == "MIT" and len(t) > 100).split()
    edited = [w if i % 11 else "changed" for i, w in enumerate(notice)]
    filler = ["filler"] * 500
    rows = [
        (1, " ".join(filler + edited + filler), None, None),
        (2, " ".join(filler + notice + filler + notice), None, None),
        (3, " ".join(w for k, w in enumerate(notice) if k % 3 == 0), None, None),
        (4, long + "\n" + "Licensed under CC BY-NC 4.0.", None, None),
    ]
    found = {}
    for r in ls.scan(documents(spark, rows)).collect():
        found.setdefault(r["doc_id"], []).append((r["license"], r["start"], r["end"], r["coverage"]))
    assert [x[0] for x in found[1]] == ["MIT"] and 0.75 <= found[1][0][3] < 1
    words = len(ls.words_of(" ".join(notice)))
    assert found[2] == [("MIT", 500, 500 + words, 1.0), ("MIT", 1000 + words, 1000 + 2 * words, 1.0)]
    assert 3 not in found
    assert [x[0] for x in found[4]] == ["MIT", "CC-BY-NC-4.0"]


def test_odd_rows(spark):
    assert ls.scan(odd(spark)).count() == 0
    assert ls.scan(empty(spark)).count() == 0
    twice = documents(spark, [(None, "Released under the MIT License", None, None)] * 2)
    assert [r["doc_id"] for r in ls.scan(twice).collect()] == [None, None]
