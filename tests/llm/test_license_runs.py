"""License notices next to each other, and words of a notice before it."""

from __future__ import annotations

from wakeline.llm import license_scan as ls


def found(text):
    known = [ls.Template(*t) for t in ls.TEMPLATES]
    return ls.find(ls.words_of(text), known, ls.LEAST)


def test_back_to_back():
    text = "Released under the MIT License. " * 2
    assert found(text) == [("MIT", 1.0, 0, 5), ("MIT", 1.0, 5, 10)]
    text = "Licensed under CC BY-NC 4.0. " * 9
    assert found(text) == [("CC-BY-NC-4.0", 1.0, 7 * i, 7 * i + 7) for i in range(9)]


def test_mention_before_the_notice():
    text = (
        "Version 2.0 of the Apache License foo bar baz "
        "Licensed under the Apache License, Version 2.0"
    )
    assert found(text) == [("Apache-2.0", 1.0, 10, 18)]


def test_cut_notice_before_a_whole_one():
    notice = next(t for n, t in ls.TEMPLATES if n == "MIT" and len(t) > 100)
    words = ls.words_of(notice)
    hits = found(" ".join(words[:-9] + words))
    assert [h[0] for h in hits] == ["MIT", "MIT"]
    assert hits[1] == ("MIT", 1.0, len(words) - 9, 2 * len(words) - 9)
