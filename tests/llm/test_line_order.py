"""Line dedup on rows that a task does not read in the order of ``doc_id``."""

from __future__ import annotations

import random

from tests.llm.frames import DOCS
from tests.llm.test_line_dedup import got, removed
from wakeline.llm import line_dedup


def in_order(spark, texts, order, parts):
    rows = [(i, texts[i], "en", "a", len(texts[i]), 7, "x") for i in order]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, parts), DOCS)


def test_first_copy_is_read_late(spark):
    """K ~ L ~ M, K not ~ M: M goes because of L, whose first copy is read after another."""
    texts, order, want = {}, [], {}
    for base in range(0, 40_000, 1000):
        line_k, line_l, line_m = (
            " ".join(f"w{base}x{i}" for i in range(start, start + 10)) for start in range(3)
        )
        texts |= {base + 500: line_l, base + 3: line_l, base + 1: line_k, base + 100: line_m}
        order += [base + 500, base + 3, base + 1, base + 100]
        want |= {base + 3: [0], base + 100: [0], base + 500: [0]}
    docs = in_order(spark, texts, order, 1)
    assert got(line_dedup.later_lines(docs)) == removed(texts) == want


def test_shuffled_rows(spark, monkeypatch):
    """Copies and edited copies in any order, few and many tasks, chunks of a few lines."""
    monkeypatch.setattr(line_dedup, "CHUNK", 64)
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(60)]
    lines = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 20))] for _ in range(15)]
    pool = []
    for _ in range(150):
        line = list(rng.choice(lines))
        for _ in range(rng.choice([0, 1, 2, 3])):
            line[rng.randrange(len(line))] = rng.choice(vocabulary)
        pool.append(" ".join(line))
    texts = {i: "\n".join(rng.choice(pool) for _ in range(3)) for i in range(200)}
    want = removed(texts)
    for parts in (1, 7):
        order = rng.sample(sorted(texts), len(texts))
        assert got(line_dedup.later_lines(in_order(spark, texts, order, parts))) == want
