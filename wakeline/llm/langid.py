"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For every bit a binary classifier over hashed byte trigrams
tells the languages whose bit is set from the others: naive Bayes, whose weights follow from counts
of all training documents, summed in Spark. A text's mean weight per trigram is the bit's margin;
the margins are decoded to the language with the smallest weighted loss, bits that separate their
two sides better weighing more. Where the two best languages are nearly even, the text is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import frugal, memory_returned, tasks_find_package, text_of

UNKNOWN = "und"
#: Hashed trigrams; the model has a count for each and language.
GRAMS = 1 << 15
#: Bits of a codeword where the exhaustive code is too long, and the draws to choose it from.
BITS, DRAWS = 24, 200
#: How steeply a margin's loss falls, and losses turn into a score; a score under this is ambiguous.
STEEP, SHARP, AMBIGUOUS = 4.0, 6.0, 0.45
#: Bytes scored at a time.
BLOCK = 1 << 19


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def may_learn(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def grams(text: bytes) -> np.ndarray:
    """Hashed trigrams of a text's bytes, white space around it."""
    b = np.frombuffer(b" " + text + b" ", dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, dtype=np.uint32)
    mixed = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return (mixed * np.uint32(2654435761)) >> np.uint32(32 - 15)


def blocks(text: bytes) -> Iterator[np.ndarray]:
    """A long text's trigrams in blocks, those over a seam included."""
    for at in range(0, max(len(text), 1), BLOCK):
        yield grams(text[max(0, at - 2) : at + BLOCK])


def codewords(languages: int) -> np.ndarray:
    """A row of +1 and -1 for every language: all splits of few, well-spread draws for many."""
    if languages <= 5:
        count = max(1, 2 ** (languages - 1) - 1)
        rows = [[1] * count]
        rows += [[1 if n >> k & 1 else -1 for n in range(count)] for k in range(languages - 1)]
        return np.array(rows[:languages], dtype=np.float64)
    rng, best, spread = np.random.default_rng(0), None, -1
    for _ in range(DRAWS):
        code = rng.choice([-1.0, 1.0], size=(languages, BITS))
        if (np.abs(code.sum(axis=0)) == languages).any():
            continue
        apart = code @ code.T - 2 * BITS * np.eye(languages)
        if best is None or -apart.max() > spread:
            best, spread = code, -apart.max()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # a row per hashed trigram, a column per bit
    trust: np.ndarray  # a bit's share in the loss

    def margins(self, text: bytes) -> np.ndarray:
        total, count = np.zeros(self.code.shape[1]), 0
        for ids in blocks(text):
            total += self.weights[ids].sum(axis=0, dtype=np.float64)
            count += len(ids)
        return total / max(count, 1)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language and its score for every row of margins."""
        loss = np.logaddexp(0, -STEEP * margins[:, None, :] * self.code[None]) @ self.trust
        odds = np.exp(-SHARP * (loss - loss.min(axis=1, keepdims=True)))
        odds /= odds.sum(axis=1, keepdims=True)
        best = odds.argmax(axis=1)
        return best, odds[np.arange(len(best)), best]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all given documents, summed per task first."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame["lang"], frame["text"]):
                own = sums.setdefault(lang, np.zeros(GRAMS, dtype=np.int64))
                for ids in blocks(text.lower().encode()):
                    if len(ids) < GRAMS // 8:
                        np.add.at(own, ids, 1)
                    else:
                        own += np.bincount(ids, minlength=GRAMS)
        for lang, own in sums.items():
            found = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "gram": found, "n": own[found]})
        memory_returned()

    each = docs.mapInPandas(run, "lang string, gram long, n long")
    return each.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame) -> Model | None:
    """The model of all learnable documents; none if no language is known."""
    known = docs.where(may_learn(F.col("doc_id")) & F.col("lang").isNotNull())
    with frugal(docs.sparkSession):
        counts = gram_counts(known.select("lang", text_of("text").alias("text"))).toPandas()
    languages = sorted(counts["lang"].unique())
    if not languages:
        return None
    table = np.full((len(languages), GRAMS), 0.5)
    at = {lang: n for n, lang in enumerate(languages)}
    table[counts["lang"].map(at), counts["gram"]] += counts["n"]
    table /= table.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights, trust = np.zeros((GRAMS, code.shape[1])), np.zeros(code.shape[1])
    for bit in range(code.shape[1]):
        yes, no = table[code[:, bit] > 0], table[code[:, bit] < 0]
        if not len(no) or not len(yes):
            trust[bit] = 1.0
            continue
        yes, no = yes.mean(axis=0), no.mean(axis=0)
        weight = np.log(yes) - np.log(no)
        apart = ((yes - no) * weight).sum() / 2
        weights[:, bit], trust[bit] = weight / max(apart, 1e-9), apart
    return Model(languages, code, weights.astype(np.float32), trust / max(trust.sum(), 1e-9))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row, learnt from the rows.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text where no
    document has a language to learn from. A row without ``doc_id`` is neither learnt from nor
    held out. Repeated rows count as often as they stand; whole texts are read, long ones in
    blocks. An empty table gives none; further columns are ignored.
    """
    tasks_find_package(docs.sparkSession)
    model = fit(docs)
    rows = docs.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"),
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[["doc_id", "held_out"]].assign(lang_pred=UNKNOWN, score=0.0, ambiguous=False)
            known = np.flatnonzero(frame["text"].notna()) if model else []
            if len(known):
                texts = frame["text"].to_numpy()
                margins = np.array([model.margins(texts[i].lower().encode()) for i in known])
                best, score = model.decode(margins)
                out.iloc[known, 2] = np.array(model.languages, dtype=object)[best]
                out.iloc[known, 3] = score
                out.iloc[known, 4] = score < AMBIGUOUS
            yield out.astype({"doc_id": "Int64"})
        memory_returned()

    schema = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return rows.mapInPandas(run, schema)
