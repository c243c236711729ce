"""Toxicity by class-conditional Kneser-Ney models of the letters of words.

A word is read as a sequence of symbols, its bytes folded to ``1 << BITS`` classes with an end
behind, so that the ``ORDER`` symbols of an n-gram are one number below ``1 << ORDER * BITS``:
that bounds the model whatever the corpus. For either class, toxic and ordinary, the chance of the
next symbol after the ``ORDER - 1`` before it is its discounted count plus what the discounts took
times a shorter n-gram's chance. The shorter ones are continuation counts of both classes together,
each backing off to a shorter one again, so a rare expression is judged by the letters that stand
out in it, and one that neither class has seen by what both share, which favours neither. Discounts
follow from the counts of counts. A count is of the documents that hold a word, gathered from all
labelled documents in Spark.

A text's evidence is the log-likelihood ratio of its distinct words, as far as a word's is above
either of ``MARGINS``, normalised by the text's length. A logistic curve turns it into a score; it
is fitted on labelled documents by a model that does not count them yet.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import BROADCAST_IDS, LONG, kept, slices, tasks_find_package, text_of, uniform
from wakeline.llm.langid import held_out as is_held_out
from wakeline.llm.langid import may_learn

#: Symbols of an n-gram and bits of one: at most 2^25 n-grams.
ORDER, BITS = 5, 5
#: Order, bits and margins have the least log loss in cross-validation on rows that may be learnt from.
MARGINS, FLAG = (2.0, 4.0), 0.7
#: Evidence is summed as whole numbers of this many to one, so that no order matters.
UNITS = 1 << 20
#: Labelled documents kept for the curve: their share, and the most of each class.
CURVE_SHARE, CURVE_ROWS = 0.2, 4_000
#: N-grams a task counts, and words it remembers, at a time.
COUNTED, WORDS = 1 << 20, 150_000
#: The curve where labels are too few to fit one: weights of the features, then the constant.
DEFAULT_CURVE = (1.0, 1.0, 0.0, 0.0, -3.0)

FEATURES = ("low_root", "low_log", "high_root", "high_log")

#: Blank for ASCII that is neither letter nor digit: what is left are words.
LETTERS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def _symbol(byte: int) -> int:
    if byte > 127:
        return 28 + byte % 4
    if 97 <= byte <= 122:
        return byte - 96
    return 27 if 48 <= byte <= 57 else 0


#: The symbol of a byte: its letter, one for digits, four for bytes beyond ASCII, 0 for the end.
SYMBOLS = np.array([_symbol(b) for b in range(256)], dtype=np.int64)


def words(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, in lower case."""
    return (text or "").lower().encode(errors="replace").translate(LETTERS).split()


def ngrams(sample: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of words, one for each symbol and end, and where those of each word begin."""
    if not sample:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = b" " * ORDER
    flat = SYMBOLS[np.frombuffer(gap + gap.join(sample) + b" ", np.uint8)]
    grams = np.zeros(len(flat) - ORDER + 1, np.int64)
    for k in range(ORDER):
        grams = (grams << BITS) | flat[k : k + len(grams)]
    last, before = flat[ORDER - 1 :], flat[ORDER - 2 : -1]
    grams = grams[(last > 0) | (before > 0)]
    lengths = np.fromiter(map(len, sample), np.int64, len(sample)) + 1
    return grams, np.cumsum(lengths) - lengths


def ngram_counts(labelled: DataFrame) -> DataFrame:
    """``gram, toxic, ordinary``: n-grams of the distinct words of ``text``, by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, place, np.concatenate([v for _, v in parts]))
            return keys, n

        def rows(y: int) -> pa.RecordBatch:
            keys, n = merged(held[y])
            arrays = [pa.array(keys), pa.array(n * (y == 1)), pa.array(n * (y == 0))]
            return pa.RecordBatch.from_arrays(arrays, names=["gram", "toxic", "ordinary"])

        held: list[list] = [[], []]
        for batch in slices(batches, 0):
            toxic = batch.column(1).to_pylist()
            samples: list[list[bytes]] = [[], []]
            for text, y in zip(batch.column(0).to_pylist(), toxic):
                samples[int(y > 0)].extend(set(words(text)))
            for y in (0, 1):
                if samples[y]:
                    grams, _ = ngrams(samples[y])
                    held[y] = [merged([*held[y], np.unique(grams, return_counts=True)])]
                    if len(held[y][0][0]) > COUNTED:
                        yield rows(y)
                        held[y] = []
        for y in (0, 1):
            if held[y]:
                yield rows(y)

    each = labelled.select("text", "toxic").mapInArrow(run, "gram long, toxic long, ordinary long")
    return each.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken off a count of none, one, two and three or more, from the counts of counts."""
    n = [max(1, int((counts == k).sum())) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    of = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    # where few counts make them odd they stay between nothing and the count
    return np.array([0.0, *(np.clip(d, 0.1, k - 0.02) for k, d in zip((1, 2, 3), of))])


class Level:
    """Discounted chances of n-grams of one order, and what each history leaves to shorter ones."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams = grams
        taken = discounts(counts)[np.minimum(counts, 3)]
        self.histories, start = np.unique(grams >> BITS, return_index=True)
        if not len(grams):
            self.own = self.rest = np.empty(0)
            return
        whole = np.add.reduceat(counts, start).astype(float)
        self.rest = np.add.reduceat(taken, start) / whole
        self.own = (counts - taken) / whole[np.searchsorted(self.histories, grams >> BITS)]

    def left(self, histories: np.ndarray) -> np.ndarray:
        return _found(self.histories, self.rest, histories, 1.0)

    def chance(self, grams: np.ndarray, shorter: np.ndarray) -> np.ndarray:
        return _found(self.grams, self.own, grams, 0.0) + self.left(grams >> BITS) * shorter


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, other: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), other)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], other)


class Model(NamedTuple):
    """Log-likelihood ratios of n-grams seen, and of what follows a history otherwise, sorted."""

    grams: np.ndarray
    ratios: np.ndarray
    histories: np.ndarray
    others: np.ndarray

    def evidence(self, sample: list[bytes]) -> list[int]:
        """What the log-likelihood ratio of each word has above the lower margin, in ``UNITS``."""
        if not sample:
            return []
        grams, start = ngrams(sample)
        ratio = _found(self.grams, self.ratios, grams, np.nan)
        new = np.isnan(ratio)
        ratio[new] = _found(self.histories, self.others, grams[new] >> BITS, 0.0)
        above = np.maximum(np.add.reduceat(ratio, start) - MARGINS[0], 0)
        return np.rint(above * UNITS).astype(np.int64).tolist()


def model_of(grams: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> Model:
    """Both classes' models from the counts of n-grams, of which there are at most 2^25."""
    order = np.argsort(grams)
    grams, toxic, ordinary = grams[order], toxic[order], ordinary[order]
    levels, keys = [], grams
    for length in range(ORDER - 1, 0, -1):
        keys, kinds = np.unique(keys & ((1 << BITS * length) - 1), return_counts=True)
        levels.append((length, Level(keys, kinds)))
    shorter = np.full(len(grams), 1 / (1 << BITS))
    for length, level in reversed(levels):
        shorter = level.chance(grams & ((1 << BITS * length) - 1), shorter)
    one, two = (Level(grams[n > 0], n[n > 0]) for n in (toxic, ordinary))
    histories = np.unique(grams >> BITS)
    ratios = np.log(one.chance(grams, shorter) / two.chance(grams, shorter))
    # the shorter n-grams are common to both and cancel
    return Model(grams, ratios, histories, np.log(one.left(histories) / two.left(histories)))


def _learnable(labels: DataFrame) -> DataFrame:
    """``d, toxic``: one label for a document, the higher if several differ."""
    known = labels.where(F.col("toxic").isNotNull() & may_learn(F.col("doc_id")))
    return known.groupBy(F.col("doc_id").alias("d")).agg(F.max("toxic").cast("int").alias("toxic"))


def curve_rows(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labels that the curve is fitted on, at most ``CURVE_ROWS`` a class, and all the others."""
    known = kept(_learnable(labels))
    order = [F.xxhash64("d"), F.col("d")]
    some = known.where(uniform("d") < CURVE_SHARE)
    toxic = some.where("toxic > 0").orderBy(*order).limit(CURVE_ROWS)
    ordinary = some.where("toxic <= 0").orderBy(*order).limit(CURVE_ROWS)
    curve = kept(toxic.unionByName(ordinary))
    return curve, kept(known.join(F.broadcast(curve.select("d")), "d", "left_anti"))


def counts_of(docs: DataFrame, known: DataFrame) -> np.ndarray:
    """Rows of ``gram, toxic, ordinary`` of the documents in ``known``, ``d, toxic``: 2^25 at most."""
    texts = docs.select("doc_id", text_of("text").alias("text"))
    # counted, and broadcast if few enough, which spares the texts a shuffle
    side = F.broadcast(known) if known.count() <= BROADCAST_IDS else known
    found = ngram_counts(texts.join(side, F.col("doc_id") == F.col("d"))).toArrow()
    columns = [found.column(c).to_numpy().astype(np.int64) for c in ("gram", "toxic", "ordinary")]
    return np.array(columns).reshape(3, -1)


def added(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Both tables of counts in one."""
    both = np.concatenate([one, two], axis=1)
    grams, place = np.unique(both[0], return_inverse=True)
    out = np.zeros((3, len(grams)), np.int64)
    out[0] = grams
    for row in (1, 2):
        np.add.at(out[row], place, both[row])
    return out


def fit(docs: DataFrame, known: DataFrame) -> Model:
    """The model of all documents with a label in ``known``, ``d, toxic``."""
    return model_of(*counts_of(docs, known))


def evidence(docs: DataFrame, model: Model, others: str) -> DataFrame:
    """``FEATURES`` beside the columns named in ``others``, in place of the text.

    The evidence of a text's distinct words by the root and by the logarithm of its length, above
    either margin.
    """
    # sent once to a machine, at most 2^25 n-grams
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    names = [c for c in docs.columns if c != "text"]
    between = round((MARGINS[1] - MARGINS[0]) * UNITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = Model(*shared.value), {}
        for batch in slices(batches, batch_column):
            found, sizes, low, high = [], [], [], []
            for text in batch.column(batch_column).to_pylist():
                own = words(text)
                sizes.append(len(own))
                found.append(set(own))
            if len(known) > WORDS:
                known.clear()
            new = [w for w in set().union(*found) if w not in known]
            told = dict(zip(new, model.evidence(new)))
            for own in found:
                units = [known[w] if w in known else told[w] for w in own]
                low.append(sum(units))
                high.append(sum(v - between for v in units if v > between))
            known.update((w, v) for w, v in told.items() if len(w) <= LONG)
            arrays = [batch.column(c) for c in names]
            arrays += [pa.array(v, pa.int64()) for v in (sizes, low, high)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n", "low", "high"])

    batch_column = docs.columns.index("text")
    out = docs.mapInArrow(run, f"{others}, n long, low long, high long")
    low, high = (F.col(c) / F.lit(float(UNITS)) for c in ("low", "high"))
    root, log = F.sqrt(F.col("n") + 1), F.log(F.col("n") + 3)
    features = [low / root, low / log, high / root, high / log]
    return out.select(*names, *[c.alias(name) for c, name in zip(features, FEATURES)])


def fit_curve(docs: DataFrame, curve: DataFrame, model: Model) -> np.ndarray:
    """Weights of the features and a constant, by Newton's method with a small ridge."""
    # at most 2 * CURVE_ROWS rows of four numbers
    rows = docs.select("doc_id", text_of("text").alias("text")).join(
        F.broadcast(curve), F.col("doc_id") == F.col("d")
    )
    table = evidence(rows.select("text", "toxic"), model, "toxic int").toPandas()
    table = table.sort_values([*FEATURES, "toxic"])  # sums in one order
    toxic = (table["toxic"] > 0).to_numpy(dtype=float)
    if len(table) < 20 or toxic.min() == toxic.max():
        return np.array(DEFAULT_CURVE)
    x = np.column_stack([table[list(FEATURES)], np.ones(len(table))])
    weights, ridge = np.zeros(len(FEATURES) + 1), np.diag([0.1] * len(FEATURES) + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (toxic - p) - ridge @ weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge
        weights += np.clip(np.linalg.solve(bend, slope), -5, 5)
    return weights


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts score by the curve's constant, as texts without evidence do. A null label
    teaches nothing, of several labels the higher counts, and rows without ``doc_id`` are neither
    learnt from nor held out. Without labels every score is that of no evidence. Whole texts are
    read. Repeated rows are each scored; an empty table gives none; further columns are ignored.
    """
    tasks_find_package(docs.sparkSession)
    curve, known = curve_rows(labels)
    others = counts_of(docs, known)
    *weights, constant = map(float, fit_curve(docs, curve, model_of(*others)))
    model = model_of(*added(others, counts_of(docs, curve)))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out(F.col("doc_id")).alias("held_out"),
        text_of("text").alias("text"),
    )
    found = evidence(rows, model, "doc_id long, held_out boolean")
    total = sum((F.col(name) * w for name, w in zip(FEATURES, weights)), F.lit(constant))
    score = 1 / (1 + F.exp(-total))
    return found.select("doc_id", "held_out", score.alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= FLAG, 1).otherwise(0)
    )
