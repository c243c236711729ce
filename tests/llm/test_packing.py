from __future__ import annotations

import random
import zlib
from array import array

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.frames import documents, empty, odd
from wakeline.llm import packing, queries

SF = "/root/testdata/sf0.001"


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, texts, capacity=2048):
    """``rows`` are all pieces; texts by id."""
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = whole(tokenizer, texts[doc_id])
        want = [ids[i : i + capacity] for i in range(0, len(ids), capacity)]
        got = sorted((p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces)
        assert got == [
            (n, n * capacity, len(w), zlib.crc32(array("I", w).tobytes())) for n, w in enumerate(want)
        ]
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    return len(by_sequence), total


def test_query_against_the_tokenizer(spark):
    rows = queries.QUERIES["op1_best_fit_packing"](spark, SF).collect()
    docs = queries.documents(spark, SF).collect()
    sequences, total = check(rows, {r["doc_id"]: r["text"] for r in docs})
    assert sequences <= 1.05 * total / 2048 + 1


def test_odd_rows(spark):
    docs = odd(spark).dropDuplicates(["doc_id"])
    rows = queries.packed(docs).collect()
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert queries.packed(odd(spark)).where("doc_id = 4").count() == 2
    assert queries.packed(empty(spark)).count() == 0


@pytest.mark.parametrize(
    "text",
    [
        "It's can't o'' x''s ab's <|endoftext|> x<|endoftext|>y <|ENDOFTEXT|>",
        "İstanbul ŉ ΣΑΣ a\u0085b a\xa0b \x1c a\x1cb  ",
        "'S T'S DON'T we'LL ...,.. 12ab ab12 ab- -ab (x) x). a,b. Ĳ ǅ ª µ",
        "Å K ﬁ é 中文 \U0001f642 café, naïve.",
    ],
)
def test_words_give_the_ids_of_the_text(text):
    encoder = packing.WordIds(queries.tokenizer_path())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(2):
        assert list(array("I", encoder.encode([text.encode()])[0])) == want


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert bins.place(6) == (0, 0)  # 4 left
    assert bins.place(7) == (1, 0)  # 3 left
    assert bins.place(3) == (1, 7)  # the tightest, now full
    assert bins.place(8) == (2, 0)  # 2 left
    assert bins.place(9) == (3, 0)  # the fullest, number 2, closes
    assert bins.place(2) == (0, 6)
    assert bins.place(1) == (3, 9)


def test_best_fit_against_a_list():
    rng = random.Random(1)
    bins, plain = packing.BestFit(100, 1000), {}
    for _ in range(2000):
        length = rng.randint(1, 100)
        fitting = [f for f in plain.values() if f >= length]
        sequence, offset = bins.place(length)
        if fitting:
            assert plain[sequence] == min(fitting) == 100 - offset
        else:
            assert sequence not in plain and offset == 0
        plain[sequence] = 100 - offset - length


def test_a_task_that_runs_again_gives_the_same(spark):
    docs = documents(spark, [(i, f"text number {i} " * (i % 50), "en", "a") for i in range(300)])
    docs = docs.coalesce(2).sortWithinPartitions("doc_id")
    key = F.struct("doc_id", "piece", "sequence_id", "offset")
    first, again = (sorted(r[0] for r in queries.packed(docs).select(key).collect()) for _ in "ab")
    assert first == again
