"""What kept frames and the joins leave on disk, and which lines become candidates."""

from __future__ import annotations

import random
import time
import uuid

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tests.llm.frames import documents
from tests.llm.test_line_dedup import got, removed
from wakeline.llm import common, line_dedup, ngram_join


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


def test_kept_frames_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    setting = spark.conf.get(common.CLEANUP)
    counts = common.kept(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):  # files go a little after the query
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert counts.count() == 7 and spark.conf.get(common.CLEANUP) == setting


def test_dropped_frames_leave_no_files(spark):
    frames = [common.kept(spark.range(10)) for _ in range(2)]
    assert all(f.inputFiles() for f in frames)
    paths = [f.inputFiles()[0].rsplit("/", 1)[0] for f in frames]
    common.dropped(*frames)
    assert not any(spark.read.schema("id long").parquet(p).inputFiles() for p in paths)


def test_long_lines_that_share_a_word_are_no_candidates():
    """200 words of each fill a bitmap; the parity of its bits still tells them apart."""
    rng = np.random.default_rng(0)
    sets = [np.sort(rng.integers(1, 1 << 48, 200).astype(np.uint64)) for _ in range(40)]
    for own in sets:
        own[0] = 1
    codes, sizes = np.concatenate(sets), np.full(40, 200)
    line, begin = np.repeat(np.arange(40), sizes), np.arange(40) * 200
    node = np.arange(40, dtype=np.uint64)
    entries, _ = line_dedup._entries(codes, line, begin, sizes, node, np.arange(40), 80)
    assert (np.bincount(entries["node"]) > 1).all()
    assert len(line_dedup.close_pairs(entries, 80)) == 0


def left_columns(folder):
    return {c for f in folder.rglob("*.parquet") for c in pq.read_schema(f).names}


def test_line_dedup_leaves_no_entries_or_sets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch", lambda _: f"file://{tmp_path}/{uuid.uuid4().hex}")
    rows = [(i, " ".join(f"w{i % 5}x{j + i % 2}" for j in range(20)), "en", "a") for i in range(50)]
    out = line_dedup.later_lines(documents(spark, rows))
    assert out.count() == 45
    assert left_columns(tmp_path) <= {"doc_id", "removed", "n", "word", "node"}


def test_rounds_find_the_same_lines(spark, monkeypatch):
    rng = random.Random(3)
    pool = [[f"v{rng.randrange(90)}" for _ in range(14)] for _ in range(12)]
    texts = {}
    for i in range(120):
        line = list(rng.choice(pool))
        line[rng.randrange(14)] = f"v{rng.randrange(90)}"
        texts[i] = " ".join(line)
    docs = documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    monkeypatch.setattr(line_dedup, "MANY", 0)
    assert got(line_dedup.later_lines(docs)) == removed(texts)


def test_ngram_join_leaves_no_columns_or_sets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch", lambda _: f"file://{tmp_path}/{uuid.uuid4().hex}")
    rows = [(i, " ".join(f"w{i % 5}x{j + i % 2}" for j in range(60)), "en", "a") for i in range(40)]
    out = ngram_join.similar_groups(documents(spark, rows))
    left = left_columns(tmp_path)
    assert not left & {"rare", "often", "shingles", "set", "stands", "old", "c", "d"}
    assert {r["component_id"] for r in out.collect()} == set(range(5))
