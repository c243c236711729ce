from __future__ import annotations

import zlib

import numpy as np

from tests.llm.frames import documents, empty, odd
from wakeline.llm import langid, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op4_language_codes"](spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in queries.documents(spark, SF).collect()}
    assert len(found) == len(lang)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in found if r["held_out"]]
    assert np.mean(held) > 0.98


def test_languages_of_held_out_rows_teach_nothing(spark):
    rows = [(i, f"plain words again {i}", "en", "a") for i in range(60)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i, t, "xx" if i in held else lang, s) for i, t, lang, s in rows]
    assert {r["lang_pred"] for r in langid.identify(documents(spark, rows)).collect()} == {"en"}


def test_odd_rows(spark):
    plain = documents(spark, [(i, "a few plain words", "en", "a") for i in range(100, 120)])
    found = {r["doc_id"]: r for r in langid.identify(odd(spark).unionByName(plain)).collect()}
    for doc_id in (1, 2, 3, 7):
        assert found[doc_id]["lang_pred"] == "und" and found[doc_id]["score"] == 0
    assert found[None]["held_out"] is False and found[None]["lang_pred"] != "und"
    assert langid.identify(empty(spark)).count() == 0
    none = langid.identify(documents(spark, [(1, "some words", None, None)])).collect()
    assert none[0]["lang_pred"] == "und"


def test_codewords_differ_and_blocks_make_the_whole():
    for n in (1, 2, 4, 5, 6, 30):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code}) == n
        if n > 1:
            assert (np.abs(code.sum(axis=0)) < n).all()
    text = ("abc d" * 300_000).encode()
    pieces = [g for g in langid.blocks(text)]
    assert len(pieces) > 1
    # each seam adds the white space around a block, and no trigram of the text is missing
    assert set(langid.grams(text)) <= set(np.concatenate(pieces))
