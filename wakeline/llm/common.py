"""What the operators share: words, scratch tables, and where tasks find this package."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
#: Most ids that are broadcast: 8 bytes each.
BROADCAST_IDS = 500_000


#: Bytes of the longest words that a task remembers.
LONG = 64


class Known(dict):
    """What a task remembers of words, long ones left out: worked out when first asked for."""

    def __init__(self, find: Callable[[bytes], int]):
        super().__init__()
        self.find = find

    def __missing__(self, word: bytes) -> int:
        found = self.find(word)
        if len(word) <= LONG:
            self[word] = found
        return found

    def numbers(self, words: list[bytes], most: int) -> np.ndarray:
        """The unsigned 64-bit numbers of words; what is remembered is dropped above ``most``."""
        if len(self) > most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows with about ``most`` bytes of text at a time, one at least.

    So few texts stand in a task's memory as objects, however many rows a batch has.
    """
    for batch in batches:
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            if end > at:
                yield batch.slice(at, end - at)


def text_of(column: str | Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than space and the ASCII controls 9 to 13."""
    return F.array_remove(F.split(text, WHITE), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) fixed by the values, null among them."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def scratch(spark: SparkSession) -> str:
    """A new place in the folder all executors share, named in ``spark.checkpoint.dir``.

    Only a local session, as in tests, may have none configured.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        shared = tempfile.mkdtemp(prefix="run-scratch-", dir="/tmp")
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def memory_returned() -> None:
    """Give back what a task has freed: its Python worker stays, and counts, while others run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library may have none
    if trim is not None:
        trim(0)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes that go to a Python worker at a time: held by Spark and by the worker, twice while copied.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


@contextmanager
def frugal(spark: SparkSession):
    """Within, the shuffle files of a query go when it ends, not when the driver collects garbage.

    Python workers get texts in small batches.
    """
    before = {name: spark.conf.get(name) for name in (CLEANUP, BATCH)}
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def kept(frame: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back, so that its lineage ends here.

    Nothing reads its shuffles again, so their files go.
    """
    spark = frame.sparkSession
    path = scratch(spark)
    with frugal(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def bucketed(frame: DataFrame, buckets: int, column: str) -> DataFrame:
    """The frame written once to the shared folder in buckets by a column.

    Groups and joins on the column then read it in place, however often, without a shuffle.
    """
    path, name = scratch(frame.sparkSession), f"llm_{uuid.uuid4().hex}"
    frame.write.bucketBy(buckets, column).option("path", path).saveAsTable(name, format="parquet")
    return frame.sparkSession.table(name)


def dropped(*frames: DataFrame) -> None:
    """Take written frames' files away, once nothing that is still to run reads them."""
    for frame in frames:
        spark = frame.sparkSession
        for file in frame.inputFiles():
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def by_ids(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id") -> DataFrame:
    """Documents semi- or anti-joined by ``doc_id``, or another key, with a column of distinct ids.

    The ids are counted, and broadcast if they are few enough, which spares the texts a shuffle.
    """
    ids = kept(ids.select(F.col(ids.columns[0]).alias("_id")))
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, F.col(key) == F.col("_id"), how)


def tasks_find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    here = spark.sparkContext.environment
    known = here.get("PYTHONPATH", "")
    if root not in known.split(":"):
        here["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
