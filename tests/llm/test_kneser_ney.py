"""The class-conditional models of op5 against a plain reading of their definition."""

from __future__ import annotations

import math
from collections import Counter

from tests.llm.frames import documents
from tests.llm.test_toxicity import labelled
from wakeline.llm import toxicity

TOXIC = ["you vile vilest crook", "vile crooks réeux crook", "vile vile 4ever", None, ""]
ORDINARY = ["you mild man", "the mild villa by the brook", "books, brooks; 42 villas", "mild"]


def grams_of(word: bytes) -> list[tuple[int, ...]]:
    symbols = [0] * (toxicity.ORDER - 1) + [int(toxicity.SYMBOLS[b]) for b in word] + [0]
    return [tuple(symbols[i : i + toxicity.ORDER]) for i in range(len(word) + 1)]


def number(gram) -> int:
    return sum(s << toxicity.BITS * k for k, s in enumerate(reversed(gram)))


def counted(texts) -> Counter:
    return Counter(g for t in texts for w in set(toxicity.words(t)) for g in grams_of(w))


def chance(counts: Counter, gram, shorter: float) -> float:
    """Interpolated, with discounts that grow with the count."""
    n = [max(1, sum(v == k for v in counts.values())) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    d = {k: min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.02) for k in (1, 2, 3)}
    after = {g: v for g, v in counts.items() if g[:-1] == gram[:-1]}
    if not after:
        return shorter
    whole, own = sum(after.values()), counts.get(gram, 0)
    rest = sum(d[min(v, 3)] for v in after.values()) / whole
    return (own - d[min(own, 3)] if own else 0) / whole + rest * shorter


def brute(word: bytes) -> float:
    """The log-likelihood ratio of a word."""
    counts, total = [counted(ORDINARY), counted(TOXIC)], 0.0
    kinds = set(counts[0]) | set(counts[1])
    lower = {}
    for length in range(toxicity.ORDER - 1, 0, -1):
        kinds_next = Counter(g[1:] for g in kinds)
        lower[length], kinds = kinds_next, set(kinds_next)
    for gram in grams_of(word):
        p = 1 / (1 << toxicity.BITS)
        for length in range(1, toxicity.ORDER):
            p = chance(lower[length], gram[-length:], p)
        total += math.log(chance(counts[1], gram, p) / chance(counts[0], gram, p))
    return total


def small_model(spark):
    texts = [(t, 1) for t in TOXIC] + [(t, 0) for t in ORDINARY]
    docs = documents(spark, [(i, t, "en", "a") for i, (t, _) in enumerate(texts)])
    known = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "d long, toxic int")
    return toxicity.fit(docs, known)


def test_ratios_of_words(spark):
    model = small_model(spark)
    seen = {w for t in TOXIC + ORDINARY for w in toxicity.words(t)}
    for word in sorted(seen | {b"vilely", b"zz", "réeuxpa".encode(), b"brookside", b"7"}):
        above = max(brute(word) - toxicity.MARGINS[0], 0)
        assert abs(model.evidence([word])[0] / toxicity.UNITS - above) < 1e-5, word
    assert model.evidence([b"vile"])[0] > 0
    assert model.evidence([]) == []


def test_counts(spark):
    texts = [(t, 1) for t in TOXIC] + [(t, 0) for t in ORDINARY]
    frame = spark.createDataFrame(texts, "text string, toxic int").repartition(3)
    found = {r["gram"]: (r["toxic"], r["ordinary"]) for r in toxicity.ngram_counts(frame).collect()}
    one, two = counted(TOXIC), counted(ORDINARY)
    assert found == {number(g): (one[g], two[g]) for g in set(one) | set(two)}


def test_counts_add_up(spark):
    texts = [(t, 1) for t in TOXIC] + [(t, 0) for t in ORDINARY]
    docs = documents(spark, [(i, t, "en", "a") for i, (t, _) in enumerate(texts)])
    known = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "d long, toxic int")
    whole = toxicity.counts_of(docs, known)
    parts = [toxicity.counts_of(docs, known.where(f"d % 2 = {k}")) for k in (0, 1)]
    whole = whole[:, whole[0].argsort()]
    assert (toxicity.added(*parts) == whole).all()
    none = toxicity.counts_of(docs, known.where("d < 0"))
    assert (toxicity.added(none, whole) == whole).all()


def test_chances_sum_to_one(spark):
    counts = counted(TOXIC)
    keys = sorted({number(g): v for g, v in counts.items()}.items())
    level = toxicity.Level(*map(toxicity.np.array, zip(*keys)))
    for history in level.histories:
        grams = (int(history) << toxicity.BITS) + toxicity.np.arange(1 << toxicity.BITS)
        even = toxicity.np.full(len(grams), 1 / len(grams))
        assert abs(level.chance(grams, even).sum() - 1) < 1e-9


def test_all_labels_but_the_curves_are_counted(spark):
    labels = labelled(spark, [(i, int(i % 3 == 0), 1) for i in range(600)])
    curve, known = toxicity.curve_rows(labels)
    one, two = ({r["d"] for r in f.collect()} for f in (curve, known))
    assert not one & two
    assert one | two == {r["d"] for r in toxicity._learnable(labels).collect()}


def test_enormous_word(spark):
    word = "viled" * 400_000
    rows = [(1, word, "en", "a"), (2, f"a {word} b", "en", "a"), (3, "vile", "en", "a"), (4, "mild", "en", "a")]
    found = toxicity.toxicity(documents(spark, rows), labelled(spark, [(1, 1, 1), (3, 1, 1), (4, 0, 1)])).collect()
    assert len(found) == 4
