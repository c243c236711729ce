"""Line dedup: hashes of words, which lines are compared, places, and numbers of lines."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from tests.llm.frames import documents
from tests.llm.test_line_dedup import got, removed
from wakeline.llm import line_dedup, queries


def test_hashes_tell_words_apart():
    words = ["", "a", "b", "ab", "ba", "abcdefgh", "abcdefghi", "abcdefgh\0", "é" * 9, "x" * 100, "x" * 101]
    both = pa.array(["left out", *words, *words])[1:]
    found = line_dedup.hashes(both)
    assert (found[: len(words)] == found[len(words) :]).all()
    assert len(np.unique(found)) == len(words)
    assert len(line_dedup.hashes(pa.array([], pa.string()))) == 0


def test_near_copies_cost_few_pairs():
    """Versions of one line: the nearest earlier one does, and others are met with earlier ones only."""
    rng = np.random.default_rng(0)
    base = rng.integers(1, 1 << 48, 60).astype(np.uint64)
    sets = []
    for _ in range(300):
        own = base.copy()
        own[1 + rng.choice(59, rng.integers(3, 12), replace=False)] = 0
        sets.append(np.unique(own[own > 0]))
    codes, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    line, begin = np.repeat(np.arange(300), sizes), np.cumsum(sizes) - sizes
    ids = np.arange(300)
    entries, _ = line_dedup._entries(codes, line, begin, sizes, ids.astype(np.uint64), ids, 80)
    first = line_dedup.earliest_partners(entries, 80)

    def similar(a, b):
        both = len(np.intersect1d(sets[a], sets[b]))
        return 100 * both >= 80 * (sizes[a] + sizes[b] - both)

    found = {a for a, b in zip(first["a"], first["b"]) if similar(a, b)}
    late = {a for a in range(300) if any(similar(a, b) for b in range(a))}
    assert len(late) > 200 and len(late - found) <= 2
    among = np.arange(200, 210).astype(np.uint64)
    pairs = line_dedup.close_pairs(entries, 80, among)
    assert set(pairs.max(axis=1)) <= set(among.tolist())


def test_ids_and_lines_of_any_size(spark):
    """Places that fit into one number and those that don't; texts that share an id."""
    rng = random.Random(1)
    pool = [" ".join(f"w{rng.randrange(30)}" for _ in range(12)) for _ in range(9)]
    for ids in (range(40), range(-(2**63), -(2**63) + 40), range(2**63 - 40, 2**63)):
        texts = {i: "\n".join(rng.choice(pool) for _ in range(3)) + "\n" for i in ids}
        docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
        assert got(line_dedup.later_lines(docs)) == removed(texts)


def test_sets_are_of_the_line_that_stands_first(spark):
    """Two texts of one id: the line's place is the same, its words are not."""
    words = [f"a{i}" for i in range(10)]
    other = " ".join(f"b{i}" for i in range(10))
    rows = [(1, " ".join(words), "en", "a")] + [(1, other, "en", "a")] * 3
    rows += [(2, " ".join([*words[:9], "new"]), "en", "a"), (3, other + " more", "en", "a")]
    assert got(line_dedup.later_lines(documents(spark, rows))) == {2: [0], 3: [0]}


def test_report_counts_lines_of_every_row(spark):
    rows = [(1, "a\nb\n", "en", "a"), (1, "a", "en", "a"), (None, "x\ny", "en", "a"), (None, None, "en", "a")]
    rows += [(2, None, "en", "a"), (3, "", "en", "a"), (4, "\n", "en", "a")]
    report = line_dedup.line_report(documents(spark, rows)).collect()
    want = [(None, 0), (None, 2), (1, 1), (1, 3), (2, 0), (3, 1), (4, 2)]
    assert sorted(((r["doc_id"], r["n_lines"]) for r in report), key=lambda x: (x[0] or 0, x[1])) == want
    assert queries.QUERIES["op6_line_join"](spark, "/root/testdata/sf0.001").count() > 0


def test_few_lines_spare_the_texts_a_shuffle(spark):
    """Also above what Spark broadcasts by itself."""
    rows = [(i, f"own line of {i}\nwords that every text has", "en", "a") for i in range(30)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shorter = line_dedup.without_later_lines(documents(spark, rows))
        plan = shorter._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    texts = {r["doc_id"]: r["text"] for r in shorter.collect()}
    assert texts[0].endswith("\nwords that every text has") and texts[29] == "own line of 29"
