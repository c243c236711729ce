"""How often the mix shuffles texts, and rows that share a key."""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter

from tests.llm.frames import documents
from wakeline.llm import mixing


def test_mix_shuffles_texts_once(spark):
    rows = [(i, f"some words of {i}", "en", "ab"[i % 2]) for i in range(40)]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        mixing.mixed_documents(documents(spark, rows)).explain(mode="formatted")
    nodes = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hash", out.getvalue(), re.M)
    assert sum("row#" in n for n in nodes) == 1


def test_rows_of_one_key_and_text_share_its_copies(spark):
    """Equal rows, rows that differ in the text alone, and rows without ``doc_id`` or source."""
    rows = [(1, "a b c", "en", "large")] * 5 + [(1, "a b d", "en", "large")] * 4
    rows += [(None, "e f g", "en", "large")] * 3 + [(None, None, "en", None)] * 2
    rows += [(i, "w " * 9, "en", "large") for i in range(10, 200)]
    rows += [(i, "x y", "en", "small") for i in range(300, 306)] + [(400, "z z", "en", None)]
    docs = documents(spark, rows)
    want = Counter()
    for r in mixing.copies_of(docs).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    got = Counter()
    for r in mixing.mixed_documents(docs).collect():
        got[r["doc_id"], r["source"], len((r["text"] or "").split())] += 1
    assert got == +want
