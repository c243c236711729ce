"""A hidden Markov language model of the corpus, and exact likelihoods under it.

Texts are sequences of words and an end. They are written once as blocks: a block has its distinct
words and the sequences as numbers of these. Words are dealt to shards by hash. A round of Baum-Welch
sends every block what the shards know of its words, runs scaled forward and backward recursions over
its sequences, and sends each shard the block's expected counts, which are summed over all blocks. Both
ways a block and a shard have one packed row. Blocks, and the words that shards and blocks share, stand
in buckets, so rounds move emissions and counts but never the texts or the words. Words, counts and
states' shares of them may be of any size; only the states' own numbers reach the driver.

A state emits a word by its share of the word's count, mixed with the smoothed counts that are the base
score's, so a word that training has not seen is possible too. Shares are kept in 255ths, a byte for
every state, which the normalisers are worked out from: emissions of all words sum to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import bucketed, dropped, kept, slices, tasks_find_package

STATES, ROUNDS = 8, 3
#: What the end is known by: no word has a line feed in it.
END = xxhash.xxh64_intdigest(b"\n")
#: Weight of the smoothed counts in a state's emissions; what a count is smoothed by; chance to stay.
BACKGROUND, SMOOTH, STAY = 0.1, 0.1, 0.9
#: Tokens and bytes of a block, bytes a bucket is made for, padded tokens of a batch, words of a shard.
BLOCK, BYTES, BUCKET, BATCH, SHARD = 1 << 22, 1 << 25, 1 << 25, 1 << 18, 1 << 18
#: Most buckets a table may have.
BUCKETS = 100_000
#: Expected numbers are summed as whole numbers of this many to one, so that no order matters.
UNITS = 1 << 20
FULL = 255
TRAIN, HELD, NEITHER = 0, 1, 2
#: Kinds of rows: a block's words of a shard, and numbers to sum - moves, starts, and by a shard the
#: states' totals, tokens and kinds of words.
WORDS, MOVES, STARTS, TOTALS = range(4)
ROWS = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("shard", pa.int64()), ("data", pa.binary()), ("numbers", pa.list_(pa.int64()))]
)
ROWS_DDL = "kind int, block long, shard long, data binary, numbers array<long>"


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def packed(numbers: np.ndarray) -> bytes:
    """Small whole numbers, planes of bytes together, compressed."""
    width = numbers.dtype.itemsize
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents: keys and training counts of words, and the texts as numbers of words."""

    def block(number: int, ids: list, parts: list, sequences: list, known: dict) -> pa.RecordBatch:
        lengths = np.array([len(s) for s in sequences], dtype=np.int64)
        flat = np.concatenate(sequences)
        end = known[b"\n"]
        keys = np.array([xxhash.xxh64_intdigest(w) for w in known], dtype=np.uint64)
        keys[end] = END
        learnt = np.repeat(np.array(parts) == TRAIN, lengths)
        often = np.bincount(flat, minlength=len(keys))
        counts = np.bincount(flat[learnt], minlength=len(keys))
        order = np.argsort(-often, kind="stable")  # frequent words get small numbers
        place = np.empty(len(order), dtype=np.uint32)
        place[order] = np.arange(len(order))
        arrays = [
            pa.array([number], pa.int64()),
            pa.array([keys[order].tobytes()], pa.binary()),
            pa.array([packed(counts[order].astype(np.uint32))], pa.binary()),
            pa.array([len(keys)], pa.int64()),
            pa.array([ids], pa.list_(pa.int64())),
            pa.array([parts], pa.list_(pa.int32())),
            pa.array([lengths], pa.list_(pa.int64())),
            pa.array([packed(place[flat])], pa.binary()),
        ]
        names = ["block", "keys", "counts", "size", "ids", "parts", "lengths", "tokens"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        ids, parts, sequences, known, tokens, size = [], [], [], _Numbers(), 0, 0
        for batch in slices(batches, 2):
            rows = zip(*[batch.column(i).to_pylist() for i in (0, 1)], batch.column(2).cast(pa.binary()).to_pylist())
            for doc_id, part, text in rows:
                words = (text or b"").lower().split()
                words.append(b"\n")
                sequences.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
                ids.append(doc_id)
                parts.append(part)
                tokens += len(words)
                size += len(text or b"")
                if tokens >= BLOCK or size >= BYTES:
                    yield block(number, ids, parts, sequences, known)
                    number += 1
                    ids, parts, sequences, known, tokens, size = [], [], [], _Numbers(), 0, 0
        if ids:
            yield block(number, ids, parts, sequences, known)

    schema = (
        "block long, keys binary, counts binary, size long, ids array<long>, parts array<int>,"
        " lengths array<long>, tokens binary"
    )
    left = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    part = F.when(left == 0, HELD).when(left > 0, TRAIN).otherwise(NEITHER)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), part.alias("part"), "text")
    return rows.mapInArrow(run, schema)


def by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of words by shard, and in it the shards that have any and where each begins."""
    shard = (keys >> np.uint64(20)) % np.uint64(shards)
    order = np.lexsort((keys, shard))
    some, begin = np.unique(shard[order], return_index=True)
    return order, some.astype(np.int64), begin


def _shared_words(blocks: DataFrame, shards: int) -> DataFrame:
    """``shard, block, keys, counts``: a block's words of a shard, by key, and their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, keys, counts in zip(*[c.to_pylist() for c in batch.columns]):
                keys, counts = np.frombuffer(keys, np.uint64), unpacked(counts, "<u4")
                order, some, begin = by_shard(keys, shards)
                keys, counts = np.split(keys[order], begin[1:]), np.split(counts[order], begin[1:])
                arrays = [
                    pa.array(some),
                    pa.array(np.full(len(some), number)),
                    pa.array([x.tobytes() for x in keys], pa.binary()),
                    pa.array([packed(x) for x in counts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["shard", "block", "keys", "counts"])

    read = blocks.select("block", "keys", "counts")
    return read.mapInArrow(run, "shard long, block long, keys binary, counts binary")


def batches_of(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Sequences, longest first, as many at a time as stay under ``BATCH`` padded tokens."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        many = max(1, BATCH // int(lengths[order[at]]))
        yield order[at : at + many]
        at += many


class Recursions:
    """Scaled recursions over sequences of words, whose emissions are rows of a matrix.

    ``own`` is the part of an emission that is the state's own, which is what states are counted by.
    """

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, own: np.ndarray):
        self.start, self.move = start.astype(emit.dtype), move.astype(emit.dtype)
        self.emit, self.own = emit, own

    def _grid(self, flat: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> None:
        """Time by sequence; sequences go from the longest to the shortest."""
        time = np.arange(lengths[0])[:, None]
        self.there = time < lengths
        self.active = self.there.sum(axis=1)
        self.word = flat[np.where(self.there, begin + time, 0)]
        self.chance = self.emit[self.word]

    def forward(self, flat: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log10 likelihoods; the scaled states stay for ``backward``."""
        self._grid(flat, begin, lengths)
        self.alpha, self.scale = np.zeros_like(self.chance), np.ones(self.there.shape, self.chance.dtype)
        for t, d in enumerate(self.active):
            now = (self.alpha[t - 1, :d] @ self.move if t else self.start) * self.chance[t, :d]
            total = now.sum(axis=1)
            self.alpha[t, :d] = now / total[:, None]
            self.scale[t, :d] = total
        return np.log10(self.scale).sum(axis=0, dtype=np.float64)

    def backward(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts and moves, and the words in order with the states they came from."""
        moves = np.zeros(self.move.shape)
        beta = np.ones(self.alpha.shape[1:], self.alpha.dtype)
        for t in range(len(self.active) - 1, -1, -1):
            if t + 1 < len(self.active):
                d = self.active[t + 1]
                after = self.chance[t + 1, :d] * beta[:d] / self.scale[t + 1, :d, None]
                moves += self.alpha[t, :d].T @ after
                beta[:d] = after @ self.move.T
            self.alpha[t] *= beta
        word = self.word[self.there]
        starts = self.alpha[0].sum(axis=0, dtype=np.float64)
        return starts, moves * self.move, word, self.alpha[self.there] * self.own[word]


class Model:
    """What all blocks need of the model: numbers of the states and of the corpus."""

    def __init__(self, start, move, totals, tokens: int, kinds: int):
        self.start, self.move, self.totals = start, move, totals
        self.tokens, self.kinds = tokens, kinds

    def smoothed(self, counts: np.ndarray) -> np.ndarray:
        return (counts + SMOOTH) / (self.tokens + SMOOTH * (self.kinds + 1))

    def emissions(self, counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chances of words in every state, and the part of them that is the state's own."""
        own = shares * (counts[:, None] * ((1 - BACKGROUND) / np.maximum(self.totals, 1)))
        every = own + BACKGROUND * self.smoothed(counts)[:, None]
        return every, np.divide(own, every, out=own)


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(ROWS)
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, ROWS)], schema=ROWS)


def _told(shared: pa.Table, keys: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> pa.Table:
    """What a shard tells blocks of their words: counts and states' shares, in the words' order.

    ``keys`` are sorted; words that only documents without training have are not among them.
    """
    rows = []
    for block, shard, data in zip(*[shared.column(c).to_pylist() for c in ("block", "shard", "keys")]):
        own = np.frombuffer(data, np.uint64)
        at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
        known = keys[at] == own if len(keys) else np.zeros(len(own), dtype=bool)
        c, s = np.zeros(len(own), dtype=np.uint64), np.zeros((len(own), STATES), dtype=np.uint8)
        c[known], s[known] = counts[at[known]], shares[at[known]]
        rows.append((WORDS, block, shard, zstandard.ZstdCompressor(level=1).compress(_planes(c) + s.tobytes()), None))
    totals = (shares.astype(np.int64) * counts.astype(np.int64)[:, None]).sum(axis=0)
    rows.append((TOTALS, None, None, None, [*totals.tolist(), int(counts.sum()), len(keys)]))
    return _table(rows)


def _planes(c: np.ndarray) -> bytes:
    return c.view(np.uint8).reshape(-1, 8).T.tobytes()


def _heard(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    many = len(raw) // (8 + STATES)
    counts = raw[: 8 * many].reshape(8, many).T.copy().view(np.uint64).ravel()
    return counts, raw[8 * many :].reshape(many, STATES)


def _learnt(shared: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys that training has, their counts, and for every block's words the place of the key and count."""
    keys = [np.frombuffer(x, np.uint64) for x in shared.column("keys").to_pylist()]
    counts = np.concatenate([unpacked(x, "<u4") for x in shared.column("counts").to_pylist()])
    known, place = np.unique(np.concatenate(keys), return_inverse=True)
    whole = np.zeros(len(known), dtype=np.uint64)
    np.add.at(whole, place, counts.astype(np.uint64))
    return known, whole, place, counts


def _first_told(shared: DataFrame) -> DataFrame:
    """To begin with, states share words at random."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts, _, _ = _learnt(table)
        keys, counts = keys[counts > 0], counts[counts > 0]
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        drawn = (mixed ^ (mixed >> np.uint64(32))).view(np.uint8).reshape(-1, 8)[:, :STATES]
        return _told(table, keys, counts, 32 + (drawn % 224).astype(np.uint8))

    return shared.groupBy("shard").applyInArrow(run, ROWS_DDL)


def _told_again(shared: DataFrame, expected: DataFrame) -> DataFrame:
    """Blocks' expected counts summed, and what blocks are told of them; numbers to sum go on."""

    def run(table: pa.Table, rows: pa.Table) -> pa.Table:
        if not table.num_rows:
            return rows.select(ROWS.names).cast(ROWS)
        keys, counts, place, own = _learnt(table)
        data = dict(zip(rows.column("block").to_pylist(), rows.column("data").to_pylist()))
        parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(data[b]), np.uint8) for b in table.column("block").to_pylist()]
        share = np.concatenate(parts).reshape(-1, STATES)
        shares = np.zeros((len(keys), STATES), dtype=np.uint8)
        n = np.stack([np.bincount(place, weights=share[:, k] * own.astype(np.float64), minlength=len(keys)) for k in range(STATES)], axis=1)
        whole = n.sum(axis=1, keepdims=True)
        shares[:] = np.rint(FULL * np.divide(n, whole, out=np.zeros_like(n), where=whole > 0))
        seen = counts > 0
        return _told(table, keys[seen], counts[seen], shares[seen])

    return shared.groupBy("shard").cogroup(expected.groupBy("shard")).applyInArrow(run, ROWS_DDL)


class _Block:
    """A block's sequences, and what it was told of its words."""

    def __init__(self, left: pa.Table, right: pa.Table, shards: int):
        row = {c: left.column(c)[0] for c in left.column_names}
        self.number, self.ids = row["block"].as_py(), row["ids"].values
        self.parts, self.lengths = row["parts"].values, row["lengths"].values.to_numpy()
        self.flat = unpacked(row["tokens"].as_py(), "<u4").view(np.int32)
        self.begin = np.cumsum(self.lengths) - self.lengths
        keys = np.frombuffer(row["keys"].as_py(), np.uint64)
        self.order, self.shards, self.cuts = by_shard(keys, shards)
        told = dict(zip(right.column("shard").to_pylist(), right.column("data").to_pylist()))
        heard = [_heard(told[s]) for s in self.shards.tolist()]
        self.counts = np.empty(len(keys), dtype=np.float64)
        self.shares = np.empty((len(keys), STATES), dtype=np.uint8)
        self.counts[self.order] = np.concatenate([c for c, _ in heard])
        self.shares[self.order] = np.concatenate([s for _, s in heard])


def _expected(blocks: DataFrame, told: DataFrame, model: Model, shards: int) -> DataFrame:
    """Rows for shards: states' shares of a block's words; and numbers of moves and starts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left, right, shards)
        emit, own = model.emissions(block.counts, block.shares)
        recursions = Recursions(model.start, model.move, emit.astype(np.float32), own.astype(np.float32))
        del emit, own
        starts, moves = np.zeros(STATES), np.zeros((STATES, STATES))
        n = np.zeros((STATES, len(block.counts)))
        learnt = np.flatnonzero(block.parts.to_numpy() == TRAIN)
        for some in batches_of(block.lengths[learnt]):
            some = learnt[some]
            recursions.forward(block.flat, block.begin[some], block.lengths[some])
            first, between, word, state = recursions.backward()
            starts += first
            moves += between
            for k in range(STATES):
                n[k] += np.bincount(word, weights=state[:, k], minlength=n.shape[1])
        n = n.T[block.order]
        whole = n.sum(axis=1, keepdims=True)
        share = np.rint(FULL * np.divide(n, whole, out=np.zeros_like(n), where=whole > 0)).astype(np.uint8)
        press = zstandard.ZstdCompressor(level=1).compress
        rows = [
            (WORDS, block.number, shard, press(part.tobytes()), None)
            for shard, part in zip(block.shards.tolist(), np.split(share, block.cuts[1:]))
        ]
        for kind, numbers in ((MOVES, moves), (STARTS, starts)):
            rows.append((kind, None, None, None, np.rint(UNITS * numbers).astype(np.int64).ravel().tolist()))
        return _table(rows)

    words = told.where(F.col("kind") == WORDS)
    return blocks.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(run, ROWS_DDL)


def _scores(blocks: DataFrame, told: DataFrame, model: Model, shards: int) -> DataFrame:
    names = ["doc_id", "part", "n_tokens", "n_known", "base_score", "score"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left, right, shards)
        recursions = Recursions(model.start, model.move, *model.emissions(block.counts, block.shares))
        known = np.add.reduceat((block.counts > 0)[block.flat].astype(np.int64), block.begin)
        base = np.add.reduceat(np.log10(model.smoothed(block.counts))[block.flat], block.begin)
        score = np.empty(len(block.lengths))
        for some in batches_of(block.lengths):
            score[some] = recursions.forward(block.flat, block.begin[some], block.lengths[some])
        columns = [block.ids, block.parts, block.lengths, known, base, score]
        return pa.Table.from_arrays([pa.array(x, type=t) for x, t in zip(columns, types)], names=names)

    words = told.where(F.col("kind") == WORDS)
    ddl = "doc_id long, part int, n_tokens long, n_known long, base_score double, score double"
    return blocks.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(run, ddl)


def _sums(told: DataFrame) -> dict[int, np.ndarray]:
    """Numbers by kind: at most a matrix of the states each."""
    rows = told.where(F.col("kind") != WORDS).select("kind", F.posexplode("numbers").alias("at", "x"))
    out: dict[int, dict[int, int]] = {}
    for kind, at, x in rows.groupBy("kind", "at").agg(F.sum("x")).collect():
        out.setdefault(kind, {})[at] = x
    return {kind: np.array([own[i] for i in range(len(own))], dtype=np.float64) for kind, own in out.items()}


def score(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Tokens are runs of characters other than ASCII white space, A-Z in lower case, and an end; a null or
    empty text has the end alone. Rows whose ``doc_id`` has a CRC-32 divisible by ten are held out, all
    others teach; rows without ``doc_id`` do neither. ``base_score`` is the log10 likelihood by
    smoothed counts of single tokens, ``score`` that of the hidden Markov model after ``rounds`` of
    Baum-Welch. Without training rows every token is unknown and both are finite. Repeated rows teach
    and are scored each; an empty table gives none; further columns are ignored. Words are told apart
    by 64-bit hashes, and whole texts are read.
    """
    spark = docs.sparkSession
    tasks_find_package(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = bucketed(_blocks(docs), max(8, min(BUCKETS, -(-size // BUCKET))), "block")
    shards = max(8, -(-(blocks.agg(F.sum("size")).first()[0] or 0) // SHARD))
    buckets = min(BUCKETS, shards)
    shared = bucketed(_shared_words(blocks, shards).repartition(buckets, "shard"), buckets, "shard")

    start = np.full(STATES, 1 / STATES)
    move = np.full((STATES, STATES), (1 - STAY) / (STATES - 1))
    np.fill_diagonal(move, STAY)
    told = kept(_first_told(shared))
    for number in range(rounds + 1):
        sums = _sums(told)
        totals = sums.get(TOTALS, np.zeros(STATES + 2))
        if MOVES in sums:
            counted = sums[MOVES].reshape(STATES, STATES) / UNITS + 1
            move = counted / counted.sum(axis=1, keepdims=True)
            start = (sums[STARTS] / UNITS + 1) / (sums[STARTS] / UNITS + 1).sum()
        model = Model(start, move, totals[:STATES], int(totals[STATES]), int(totals[STATES + 1]))
        if number < rounds:
            before, told = told, kept(_told_again(shared, _expected(blocks, told, model, shards)))
            dropped(before)
    return _scores(blocks, told, model, shards).select(
        "doc_id",
        (F.col("part") == HELD).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
