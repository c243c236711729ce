from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import documents, empty, odd
from wakeline.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def targets(sizes):
    """By raising one level until the total is shared out."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 3 * sizes[s] for s in over}
        open_ -= over
    return target


def check(rows):
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        largest[s] = max(largest.get(s, 0), r["size"])
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
    want = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6


def test_query(spark):
    make = queries.QUERIES["op10_mix_sources"]
    rows = make(spark, SF).collect()
    texts = queries.documents(spark, SF).select("doc_id", "text").collect()
    size = {r["doc_id"]: len(r["text"].split()) for r in texts}
    assert len(rows) == len(texts)
    assert all(r["size"] == size[r["doc_id"]] for r in rows)
    check(rows)
    assert sorted(rows) == sorted(make(spark, SF).collect())


def test_capped_sources_and_equal_documents(spark):
    rows = [(i, "a b c d e f g h i j", "en", "large") for i in range(1000)]
    rows += [(2000 + i, "a b c", "en", f"small{i % 5}") for i in range(25)]
    out = mixing.mix(documents(spark, rows)).collect()
    check(out)
    assert {r["copies"] for r in out if r["source"] == "small1"} == {3}


def test_odd_rows(spark):
    out = mixing.mix(odd(spark)).collect()
    assert len(out) == odd(spark).count()
    check(out)
    assert all(r["size"] == 0 for r in out if r["doc_id"] in (1, 2, 3))
    assert mixing.mix(empty(spark)).count() == 0


def test_documents_are_repeated_as_drawn(spark):
    docs = odd(spark)
    want = mixing.copies_of(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {r["doc_id"]: r["n"] for r in want if r["n"]}
    assert mixing.mixed_documents(empty(spark)).count() == 0
