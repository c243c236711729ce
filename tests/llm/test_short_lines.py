"""Line dedup of lines with few words, which no floor keeps out."""

from __future__ import annotations

import random

import pytest

from tests.llm.frames import documents
from tests.llm.test_line_dedup import LOWER, WORD, got
from wakeline.llm import line_dedup, queries


def removed_all(texts, percent=80):
    """Lines with an earlier similar one, of any number of words but none."""
    sets, holders, out = [], {}, {}
    for doc_id in sorted(texts):
        for number, line in enumerate((texts[doc_id] or "").split("\n")):
            own = frozenset(WORD.findall(line.translate(LOWER)))
            if not own:
                continue
            for j in {j for w in own for j in holders.get(w, ())}:
                both = len(own & sets[j])
                if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                    out.setdefault(doc_id, []).append(number)
                    break
            # copies add nothing to compare with
            if not any(sets[j] == own for j in holders.get(next(iter(own)), ())):
                for w in own:
                    holders.setdefault(w, []).append(len(sets))
                sets.append(own)
    return out


def test_short_lines(spark):
    texts = {
        1: "les.\nbuy now buy now\na b c d",
        2: "Les.\nnow buy\na b c",
        3: "a b c d e\n\nles. les.",
        4: "c b a",
    }
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    # four words of five are 80 percent, three of four are not
    want = {2: [0, 1], 3: [0, 2], 4: [0]}
    assert removed_all(texts) == want
    assert got(line_dedup.later_lines(docs)) == want
    assert got(line_dedup.later_lines(docs, least_words=5)) == {}


@pytest.mark.parametrize("percent, frequent", [(80, 10**6), (80, 1), (50, 1)])
def test_edited_short_lines(spark, monkeypatch, percent, frequent):
    monkeypatch.setattr(line_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(line_dedup, "LOCAL", 1)
    rng = random.Random(percent + frequent)
    texts = {
        i: "\n".join(
            " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 7)))
            for _ in range(3)
        )
        for i in range(60)
    }
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    assert got(line_dedup.later_lines(docs, percent)) == removed_all(texts, percent)


def test_query_takes_short_lines(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in queries.documents(spark, sf).collect()}
    rows = queries.QUERIES["op6_line_join"](spark, sf).collect()
    want = removed_all(texts)
    assert {r["doc_id"]: r["removed"] for r in rows} == {i: want.get(i, []) for i in texts}
