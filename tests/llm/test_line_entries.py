"""Line dedup: how entries are stored, and what they take on disk."""

from __future__ import annotations

import random
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa

from tests.llm.frames import documents
from tests.llm.test_line_dedup import got, removed
from wakeline.llm import common, line_dedup


def test_rows_are_stored_and_restored():
    rng = np.random.default_rng(0)
    for kind in (line_dedup.KEY, line_dedup.LINE):
        for n in (0, 1, 500):
            rows = np.frombuffer(rng.bytes(n * kind.itemsize), dtype=kind)
            stored = pa.array([line_dedup._stored(rows)], pa.binary())[0]
            assert (line_dedup._restored(stored, kind) == rows).all()


def test_entries_take_little_disk(spark, tmp_path, monkeypatch):
    """What the entries of a line share is stored once: no table takes 20 bytes an entry."""
    monkeypatch.setattr(common, "scratch", lambda _: f"file://{tmp_path}/{uuid.uuid4().hex}")
    most = []

    def kept(frame, keep=common.kept):
        out = keep(frame)
        files = {f.removeprefix("file://") for f in out.inputFiles()}
        most.append(sum(Path(f).stat().st_size for f in files))
        return out

    monkeypatch.setattr(line_dedup, "kept", kept)
    rng = random.Random(5)
    # lines of 75 rare words: 16 keys each
    texts = {i: " ".join(f"{rng.getrandbits(40):x}" for _ in range(75)) for i in range(3000)}
    rows = [(i, t, "en", "a") for i, t in texts.items()]
    assert line_dedup.later_lines(documents(spark, rows)).count() == 0
    assert max(most) < 3000 * 16 * 20


def test_rounds_without_entries(spark, monkeypatch):
    """Too few keys for all rounds, and lines that have none."""
    monkeypatch.setattr(line_dedup, "MANY", 0)
    words = [f"a{i}" for i in range(10)]
    texts = {1: "a\nb", 2: " ".join(words), 3: "\n".join([" ".join([*words[:9], "new"]), "b"])}
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    monkeypatch.setattr(line_dedup, "ROUNDS", 13)
    assert got(line_dedup.later_lines(docs)) == removed(texts)
