"""Ranked lexical search turned round: documents stream through an index of the query items.

The items' terms, their weights and the items that hold them are an inverted index, which every task
gets as a broadcast; items come in blocks that bound its size. Each document's term counts go through
the index once, adding to the scores of the items that share a term, and every item keeps a heap of its
best documents, so a task returns a few rows an item whatever it read. Heaps are merged in two steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import dropped, kept, slices, tasks_find_package

#: Bytes of a term stay, A-Z in lower case; all others, ASCII only, are blanks.
TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
BEST = 10
#: Entries of the index of a block of items, and numbers scored at a time.
POSTINGS, CELLS = 1 << 21, 1 << 20
#: Rows that wait for an item's heap, all items together; heaps merged at a time.
WAITING, MERGED = 1 << 16, 64


def terms(text: str | bytes | None) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text or b""
    return raw.translate(TERM).split()


class Numbers(dict):
    """Numbers of known terms, -1 for others."""

    def __missing__(self, term: bytes) -> int:
        return -1


@dataclass
class Index:
    """Places of terms' items (from ``begin[t]`` to ``begin[t + 1]``) with how often each has the term."""

    number: Numbers
    begin: np.ndarray
    item: np.ndarray
    times: np.ndarray
    items: int

    @staticmethod
    def of(texts: list[str | None]) -> Index:
        number, found = Numbers(), []
        for item, text in enumerate(texts):
            own, times = np.unique(
                np.array([number.setdefault(t, len(number)) for t in terms(text)], dtype=np.int64),
                return_counts=True,
            )
            found.append(np.column_stack([own, np.full(len(own), item), times]))
        table = np.concatenate([np.empty((0, 3), dtype=np.int64), *found])
        table = table[np.argsort(table[:, 0], kind="stable")]
        begin = np.searchsorted(table[:, 0], np.arange(len(number) + 1))
        return Index(number, begin, table[:, 1], table[:, 2], len(texts))


def _counts(docs: DataFrame, index) -> DataFrame:
    """``doc_id, n, terms, times``: a document's number of terms and its counts of the index's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value.number
        for batch in slices(batches, 1):
            sizes, ids = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                own = terms(text)
                sizes.append(len(own))
                ids.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            flat = np.concatenate([np.empty(0, dtype=np.int64), *ids])
            owner, flat = owner[flat >= 0], flat[flat >= 0]
            width = max(len(number), 1)
            cells, times = np.unique(owner * width + flat, return_counts=True)
            offsets = np.searchsorted(cells, np.arange(len(sizes) + 1) * width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array((cells % width).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "times"],
            )

    schema = "doc_id long, n long, terms array<int>, times array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class Heaps:
    """The best documents of every item: highest scores, then smallest ids, null ids last."""

    def __init__(self, items: int, best: int):
        self.items, self.best = items, best
        self.least = np.ones(items, dtype=np.int64)
        self.rows, self.waiting = np.empty((0, 4), dtype=np.int64), []

    def offer(self, scores: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        """``scores``: a row for each document and a column for each item."""
        row, item = np.nonzero(scores >= self.least)
        self.waiting.append(np.column_stack([item, scores[row, item], none[row], ids[row]]))
        if sum(map(len, self.waiting)) > WAITING:
            self.settle()

    def settle(self) -> np.ndarray:
        rows = np.concatenate([self.rows, *self.waiting])
        rows = rows[np.lexsort([rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]])]
        first = np.searchsorted(rows[:, 0], np.arange(self.items + 1))
        place = np.arange(len(rows)) - first[rows[:, 0]]
        full = np.flatnonzero(np.diff(first) >= self.best)
        self.least[full] = rows[first[full] + self.best - 1, 1]
        self.rows, self.waiting = rows[place < self.best], []
        return self.rows


def _scored(counts: DataFrame, index, weights, n: int, length: int, best: int) -> DataFrame:
    """``item, doc_id, score``: a task's heaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, weight = index.value, weights.value
        fan = np.diff(find.begin)
        heaps = Heaps(find.items, best)
        step = max(1, CELLS // max(find.items, 1))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows = part.num_rows
                size = part.column(1).to_numpy(zero_copy_only=False)
                have = np.diff(part.column(2).offsets.to_numpy())
                term = part.column(2).flatten().to_numpy().astype(np.int64)
                times = part.column(3).flatten().to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(rows), have)
                m = 25 + (75 * size * n) // length
                adds = weight[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[owner]))
                # an entry for every item that holds the term
                wide = fan[term]
                entry = np.repeat(np.arange(len(term)), wide)
                place = find.begin[term][entry] + np.arange(len(entry)) - np.repeat(np.cumsum(wide) - wide, wide)
                scores = np.zeros(rows * find.items, dtype=np.int64)
                np.add.at(scores, owner[entry] * find.items + find.item[place], adds[entry] * find.times[place])
                none = np.asarray(part.column(0).is_null()).astype(np.int64)
                ids = part.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                heaps.offer(scores.reshape(rows, find.items), ids, none)
        out = heaps.settle()
        ids = pa.array(out[:, 3], mask=out[:, 2] > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[:, 0]), ids, pa.array(out[:, 1])], names=["item", "doc_id", "score"]
        )

    return counts.mapInArrow(run, "item long, doc_id long, score long")


def _merged(heaps: DataFrame, best: int) -> DataFrame:
    """``item, doc_id, score, rank``: the tasks' heaps, some at a time, then what they leave."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item", "part").orderBy(*order)
    heaps = heaps.withColumn("part", (F.spark_partition_id() / MERGED).cast("int"))
    heaps = heaps.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= best)
    last = Window.partitionBy("item").orderBy(*order)
    return heaps.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= best)


def _search(docs: DataFrame, names: DataFrame, texts: list[str | None], best: int) -> DataFrame:
    spark = docs.sparkSession
    index = Index.of(texts)
    shared = spark.sparkContext.broadcast(index)
    counts = kept(_counts(docs, shared))
    n, length = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = dict(found.collect())  # a number for each term of the block
    weights = np.array(
        [math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(index.number))],
        dtype=np.int64,
    )
    weights = spark.sparkContext.broadcast(weights)
    heaps = kept(_scored(counts, shared, weights, n, max(length, 1), best))
    dropped(counts)
    rows = _merged(heaps, best).join(F.broadcast(names), "item")
    return rows.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, postings: int = POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of every item with a score above 0.

    Terms are runs of ASCII letters and digits and all characters beyond ASCII, A-Z in lower case. A
    null or empty text has none: such a document is found by no item and such an item finds none. Equal
    scores stand by ``doc_id``, null ids last; repeated rows of documents are each ranked, as are
    repeated rows of items. Without documents or items there are no rows; further columns are
    ignored. Texts of documents are read whole, once for each block of items; a block has about
    ``postings`` index entries, more only if a single item has.
    """
    spark = docs.sparkSession
    tasks_find_package(spark)
    items = items.select("item_id", "text").withColumn("size", F.octet_length(F.coalesce("text", F.lit(""))))
    # two bytes a term at least
    whole = items.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-whole // (2 * postings)))
    dealt = kept(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))))
    schema = "item_id " + dict(items.dtypes)["item_id"] + ", item long"
    out = spark.createDataFrame([], schema.replace("item long", "rank int, doc_id long, score long"))
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).select("item_id", "text").collect()
        if rows:
            rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"] or ""))
            names = spark.createDataFrame([(r["item_id"], i) for i, r in enumerate(rows)], schema)
            out = out.unionByName(_search(docs, names, [r["text"] for r in rows], best))
    return out
