"""The model of op5 grows with its input: what is rare among many toxic documents stays in it."""

from __future__ import annotations

import pytest

from tests.llm.frames import documents
from tests.llm.test_toxicity import labelled
from wakeline.llm import toxicity


@pytest.mark.parametrize("most", [400_000, 0])
def test_rare_word_among_many(spark, monkeypatch, most):
    """Twelve of 6,000 toxic documents hold a word of their own, by a dictionary and by a shuffle."""
    monkeypatch.setattr(toxicity, "BROADCAST_STEMS", most, raising=False)
    rows, labels = [], []
    for i in range(9_000):
        toxic = i % 3 > 0
        rare = toxic and i // 3 % 500 < 1
        text = f"some plain words and {'zzgrunk' if rare else 'vile' if toxic else 'mild'}"
        rows.append((i, text, "en", "a"))
        labels.append((i, int(toxic), 1))
    rows.append((10_000, "some plain words and zzgrunk", "en", "a"))
    rows.append((10_001, "some plain words and", "en", "a"))
    docs, known = documents(spark, rows), labelled(spark, labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, known).collect()}
    assert len(found) == len(rows)
    assert found[10_000] > found[10_001]
