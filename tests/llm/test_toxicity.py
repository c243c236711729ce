from __future__ import annotations

import zlib

import numpy as np

from tests.llm.frames import documents, empty, odd
from wakeline.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int")


def test_held_out_rows(spark):
    found = queries.QUERIES["op5_toxicity_models"](spark, SF).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(found) == queries.documents(spark, SF).count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in labels]
    predicted, toxic = np.array(held).T
    assert (predicted & toxic).sum() / predicted.sum() > 0.95
    assert (predicted & toxic).sum() / toxic.sum() > 0.8


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows, labels = [], []
    for i in range(200):
        held = zlib.crc32(str(i).encode()) % 3 == 1
        rows.append((i, f"these are words vile{'' if i % 2 else ' and mild'} {i}", "en", "a"))
        labels.append((i, int(held), 1))
    found = toxicity.toxicity(documents(spark, rows), labelled(spark, labels)).collect()
    assert {r["predicted"] for r in found} == {0}


def test_odd_rows(spark):
    labels = labelled(spark, [(1, 1, 0), (4, 0, 1), (4, 1, 1), (5, None, None), (None, 1, 1), (99, 1, 1)])
    found = toxicity.toxicity(odd(spark), labels).collect()
    assert len(found) == odd(spark).count()
    assert all(0 <= r["score"] <= 1 for r in found)
    none = labelled(spark, [])
    assert toxicity.toxicity(odd(spark), none).count() == odd(spark).count()
    assert toxicity.toxicity(empty(spark), labels).count() == 0
