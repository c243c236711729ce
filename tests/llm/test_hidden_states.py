from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest
import zstandard

from tests.llm.frames import documents, empty, odd
from wakeline.llm import common, queries
from wakeline.llm import hidden_states as hs

SF = "/root/testdata/sf0.01"


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def base(rows):
    """``doc_id, text`` to held out, tokens, known tokens, training tokens and the base score."""
    counts = Counter(t for i, text in rows if i is not None and not held(i) for t in tokens(text))
    n, kinds = sum(counts.values()), len(counts)

    def one(i, text):
        own = tokens(text)
        score = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (kinds + 1))) for t in own)
        return i, held(i), len(own), sum(counts[t] > 0 for t in own), n, score

    return [one(*r) for r in rows]


def compare(found, want):
    key = lambda r: (str(r[0]), r[2], r[5])
    found, want = sorted((tuple(r) for r in found), key=key), sorted(want, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in found], [r[5] for r in want], rtol=1e-9)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in found)


def test_base_scores_and_held_out_likelihood(spark):
    docs = queries.documents(spark, SF)
    found = hs.score(docs).collect()
    compare(found, base([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    for out in (True, False):
        rows = [r for r in found if r["held_out"] == out]
        assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.05 * sum(r["n_tokens"] for r in rows)


def plain(model, sequences, counts, own, train):
    """Forward and backward one token at a time: log10 likelihoods and expected counts."""
    emit, part = model.emissions(counts, own)
    starts, moves, states = np.zeros(8), np.zeros((8, 8)), np.zeros((len(counts), 8))
    scores = []
    for words, learn in zip(sequences, train):
        alpha = [model.start * emit[words[0]]]
        for w in words[1:]:
            alpha.append(alpha[-1] @ model.move * emit[w])
        whole = alpha[-1].sum()
        scores.append(math.log10(whole))
        if not learn:
            continue
        beta = np.ones(8)
        for t in range(len(words) - 1, -1, -1):
            states[words[t]] += alpha[t] * beta / whole
            if t:
                after = emit[words[t]] * beta
                moves += np.outer(alpha[t - 1], after) * model.move / whole
                beta = model.move @ after
        starts += alpha[0] * beta / whole
    return np.array(scores), starts, moves, states * part


def test_a_round_against_plain_recursions(spark, monkeypatch):
    monkeypatch.setattr(hs, "BATCH", 40)
    draw = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 12, n)) for n in [0, 1, 2, 9, 30, 17, 5, 5]]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    blocks = hs._blocks(documents(spark, rows).coalesce(1)).collect()
    assert len(blocks) == 1
    row, shards = blocks[0], 3
    lengths = np.array(row["lengths"])
    flat, parts = hs.unpacked(row["tokens"], "<u4"), np.array(row["parts"])
    sequences = [x.tolist() for x in np.split(flat, np.cumsum(lengths)[:-1])]
    c = hs.unpacked(row["counts"], "<u4").astype(float)
    own = draw.integers(0, 256, (len(c), 8)).astype(np.uint8)
    own[c == 0] = 0
    move, start = draw.random((8, 8)), draw.random(8)
    model = hs.Model(
        start / start.sum(), move / move.sum(axis=1, keepdims=True), (own * c[:, None]).sum(axis=0), int(c.sum()), int((c > 0).sum())
    )
    emit, _ = model.emissions(c, own)
    unknown = 0.1 * 0.1 / (c.sum() + 0.1 * ((c > 0).sum() + 1))
    assert np.allclose(emit[c > 0].sum(axis=0) + unknown, 1)
    scores, starts, moves, states = plain(model, sequences, c, own, parts == hs.TRAIN)

    table = spark.createDataFrame(blocks)
    keys = np.frombuffer(row["keys"], np.uint64)
    shared = hs._shared_words(table, shards).toArrow()
    order = np.argsort(keys[c > 0])
    told = [
        t
        for shard in range(shards)
        for t in hs._told(
            shared.filter(pa.compute.equal(shared["shard"], shard)), keys[c > 0][order], c[c > 0][order].astype(np.uint64), own[c > 0][order]
        ).to_pylist()
        if t["kind"] == hs.WORDS
    ]
    told = spark.createDataFrame([tuple(t.values()) for t in told], hs.ROWS_DDL)
    got = hs._expected(table, told, model, shards).collect()
    numbers = {r["kind"]: np.array(r["numbers"]) / hs.UNITS for r in got if r["kind"] != hs.WORDS}
    assert np.allclose(numbers[hs.MOVES].reshape(8, 8), moves, atol=1e-4)
    assert np.allclose(numbers[hs.STARTS], starts, atol=1e-4)
    place, some, _ = hs.by_shard(keys, shards)
    shares = {r["shard"]: r["data"] for r in got if r["kind"] == hs.WORDS}
    shares = b"".join(zstandard.ZstdDecompressor().decompress(shares[s]) for s in some.tolist())
    want = states / np.maximum(states.sum(axis=1, keepdims=True), 1e-300)
    assert np.abs(np.frombuffer(shares, np.uint8).reshape(-1, 8) / 255 - want[place]).max() < 0.003
    found = {r["doc_id"]: r["score"] for r in hs._scores(table, told, model, shards).collect()}
    assert np.allclose([found[i] for i in row["ids"]], scores)


def test_shards_sum_all_blocks(spark, monkeypatch):
    """What blocks hear is what one block would say of the whole corpus."""
    docs = queries.documents(spark, "/root/testdata/sf0.001")

    def heard(parts):
        blocks = common.kept(hs._blocks(docs.repartition(parts, "doc_id")))
        shared = common.kept(hs._shared_words(blocks, 5))
        first = hs._first_told(shared)
        sums = hs._sums(common.kept(first))
        out = {}
        keys = {(r["block"], r["shard"]): np.frombuffer(r["keys"], np.uint64) for r in shared.collect()}
        for r in first.where("kind = 0").collect():
            c, s = hs._heard(r["data"])
            out |= {k: (int(n), *x) for k, n, x in zip(keys[r["block"], r["shard"]].tolist(), c, s.tolist())}
        return sums[hs.TOTALS].tolist(), out

    one, many = heard(1), heard(7)
    assert one == many
    counts = Counter(t for i, text in docs.select("doc_id", "text").collect() if not held(i) for t in tokens(text))
    assert sorted(v[0] for v in one[1].values() if v[0]) == sorted(counts.values())


def test_rounds_raise_the_likelihood(spark):
    draw = np.random.default_rng(2)
    kinds = [[f"{k}{x}" for x in range(30)] for k in "abc"]
    rows = [(i, " ".join(draw.choice(kinds[i % 3], 40)), "en", "a") for i in range(300)]
    sums = [sum(r["score"] for r in hs.score(documents(spark, rows), rounds).collect()) for rounds in (0, 1, 3)]
    assert sums[0] < sums[1] < sums[2]


@pytest.mark.parametrize("tokens_", [1 << 22, 50])
def test_odd_rows(spark, monkeypatch, tokens_):
    monkeypatch.setattr(hs, "BLOCK", tokens_)
    docs = odd(spark).union(documents(spark, [(8, "z" * 3_000_000 + " end", "en", "a"), (9, "É É w", "en", "a")]))
    found = hs.score(docs).collect()
    compare(found, base([tuple(r) for r in docs.select("doc_id", "text").collect()]))


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(200) if held(i)][:3]
    found = hs.score(documents(spark, [(i, "some words", "en", "a") for i in ids])).collect()
    assert [r["train_tokens"] for r in found] == [0, 0, 0] and all(r["n_known"] == 0 for r in found)
    assert all(math.isfinite(r["score"]) for r in found)
    assert hs.score(empty(spark)).collect() == []
