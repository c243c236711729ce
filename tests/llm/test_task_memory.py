"""What Python workers are handed at a time."""

from __future__ import annotations

import pyarrow as pa

from tests.llm.frames import documents
from wakeline.llm import common, packing, queries


def test_texts_go_to_workers_in_small_batches(spark):
    text = "some words of a text " * 500
    docs = documents(spark, [(i, text, "en", "a") for i in range(2000)]).coalesce(1)
    before = spark.conf.get(common.BATCH)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    sizes = [r["size"] for r in common.kept(docs.select("text").mapInArrow(run, "size long")).collect()]
    assert sum(sizes) > 4 * common.BATCH_BYTES
    assert max(sizes) < 2 * common.BATCH_BYTES
    assert spark.conf.get(common.BATCH) == before


def test_packing_gets_texts_in_small_batches(spark, monkeypatch):
    """Also when its result is what a query or the pipeline returns."""
    text = "some words of a text " * 500
    docs = documents(spark, [(i, text, "en", "a") for i in range(2000)]).coalesce(1)

    def pack(docs, tokenizer):
        def run(batches):
            for batch in batches:
                values = [[0], [0], [0], [batch.nbytes], [b""], [0], [0]]
                arrays = [pa.array(v, t.type) for v, t in zip(values, packing.ARROW)]
                yield pa.RecordBatch.from_arrays(arrays, schema=packing.ARROW)

        return docs.select("doc_id", "text").mapInArrow(run, packing.SCHEMA)

    monkeypatch.setattr(packing, "pack", pack)
    sizes = [r["length"] for r in queries.packed(docs).collect()]
    assert sum(sizes) > 4 * common.BATCH_BYTES
    assert max(sizes) < 2 * common.BATCH_BYTES


def test_a_worker_encodes_few_texts_at_a_time(spark, monkeypatch):
    seen = []

    class Encoder:
        def encode(self, texts):
            seen.append(sum(map(len, texts)))
            return [b""] * len(texts)

    class Docs:
        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    class Task:
        get = staticmethod(lambda: type("At", (), {"partitionId": staticmethod(lambda: 0)}))

    monkeypatch.setattr(packing, "_encoder", lambda path: Encoder())
    monkeypatch.setattr(packing, "TaskContext", Task)
    texts = ["some words of a text " * 500] * 400
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    rows = sum(b.num_rows for b in packing.pack(Docs(), "")(iter([batch])))
    assert rows == 400 and max(seen) < 2 * packing.TEXT
