"""Jaccard join of documents on word shingles, as a blocked sparse matrix product.

The matrix has a row for every distinct set of shingles (copies share one) and a column for every
shingle. Two rows can only reach the similarity if they meet in the columns that remain when each
leaves out all but the last ``ceil(s * size)`` of its columns, in an order common to all; in that
order columns known to be frequent come last, so that a shared passage brings few rows together.
The product runs over blocks of columns, each an equal share by hash, whose number follows the
input. Overlaps of rows are accumulated over the columns in which they meet, first with a few
pivots of each column; sizes bound what the other columns can add, which discards nearly all pairs
that are not alike, and whole sets verify the rest. Rows that are then in
one component need no more pairs with each other; all pairs between different components are
accumulated too, so no link that joins components is lost, while a large group of near copies costs
a few pairs for each of its rows, not the square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import (
    BLANKS,
    Known,
    by_ids,
    dropped,
    kept,
    memory_returned,
    slices,
    tasks_find_package,
    text_of,
)
from wakeline.llm.components import components

WIDTH = 5
#: Shingles a task counts at a time, and the count there that makes one a candidate for frequent.
COUNTED, LOCAL = 1 << 21, 4
#: Documents that make a shingle frequent, doubled until at most so many are.
FREQUENT, FREQUENT_LIMIT = 64, 1 << 20
#: Entries of a block of columns.
BLOCK = 1 << 20
#: The masks that choose a column's pivots: of all 64 bits, as ids may be any; the first chooses the
#: smallest id, as copies often follow it.
MASKS = tuple(k * 0x9E3779B97F4A7C15 % (1 << 63) for k in range(8))
#: Words whose hashes a task remembers.
WORDS = 200_000

_MIX, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self, width: int = WIDTH):
        self.width, self.known = width, Known(xxhash.xxh64_intdigest)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # as bytes: A-Z and ASCII white space only
        if not words:
            return np.empty(0, dtype=np.uint64)
        h = self.known.numbers(words, WORDS)
        width = min(self.width, len(h))
        out = np.full(len(h) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            out = out * _MIX + h[k : k + len(out)]
            out ^= out >> np.uint64(29)
        out *= _ODD
        return np.unique(out ^ (out >> np.uint64(32)))


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles of many documents, rarest first: at most ``FREQUENT_LIMIT``.

    Counts are of what stands out within a task, summed; they only choose the order of columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def standing_out(parts: list[np.ndarray]) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            often = n >= LOCAL
            arrays = [pa.array(found[often].view(np.int64)), pa.array(n[often].astype(np.int64))]
            return pa.RecordBatch.from_arrays(arrays, names=["shingle", "n"])

        shingles, parts, size = Shingles(width), [], 0
        for batch in slices(batches, 0):
            for text in batch.column(0).to_pylist():
                parts.append(shingles(text))
                size += len(parts[-1])
                if size >= COUNTED:
                    yield standing_out(parts)
                    parts, size = [], 0
        if parts:
            yield standing_out(parts)
        parts.clear()
        shingles.known.clear()
        memory_returned()

    each = docs.select("text").mapInArrow(run, "shingle long, n long")
    counts = kept(each.groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT))
    least = FREQUENT
    while counts.where(F.col("n") >= least).count() > FREQUENT_LIMIT:
        least *= 2
    rows = counts.where(F.col("n") >= least).toPandas().sort_values(["n", "shingle"])
    return rows["shingle"].to_numpy(dtype=np.int64).view(np.uint64)


def _signatures(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """``doc_id, n, first, second, rare, often``: size, fingerprint and leading columns of a set."""
    frequent = frequent_shingles(docs, width)
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT_LIMIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, frequent = Shingles(width), shared.value
        place = np.argsort(frequent)  # the n-th smallest hash stands at this place in the order
        ordered = frequent[place]
        for batch in slices(batches, 1):
            sizes, prints, leading, common = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text)
                lead = len(s) - (percent * len(s) + 99) // 100 + 1 if len(s) else 0
                often = np.empty(0, dtype=np.uint64)
                rare = s
                if len(ordered) and len(s):
                    at = np.minimum(np.searchsorted(ordered, s), len(ordered) - 1)
                    hit = ordered[at] == s
                    rare, often = s[~hit], frequent[np.sort(place[at[hit]])]
                    often = often[: max(0, lead - len(rare))]
                sizes.append(len(s))
                prints.append(_fingerprint(s))
                leading.append(rare[:lead].view(np.int64))
                common.append(often.view(np.int64))
            first, second = zip(*prints)
            longs = pa.list_(pa.int64())
            arrays = [pa.array(sizes, pa.int64()), pa.array(first), pa.array(second)]
            arrays += [pa.array(leading, longs), pa.array(common, longs)]
            names = ["doc_id", "n", "first", "second", "rare", "often"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)
        shingles.known.clear()
        memory_returned()

    schema = "doc_id long, n long, first long, second long, rare array<long>, often array<long>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    second = (s * s ^ (s >> np.uint64(7))).sum(dtype=np.uint64)
    return int(s.sum(dtype=np.uint64).view(np.int64)), int(second.view(np.int64))


def _print() -> Column:
    """One number for all rows that have the same set."""
    return F.xxhash64("first", "second", "n").alias("print")


def _meeting(rows: DataFrame, blocks: int) -> DataFrame:
    """``shingle, node``: entries of columns in which several rows meet."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a row's columns, cut by block
        for batch in batches:
            values = batch.column(1)
            lengths = pa.compute.list_value_length(values).to_numpy(zero_copy_only=False)
            flat = values.flatten().to_numpy()
            owner = np.repeat(np.arange(len(lengths)), lengths.astype(np.int64))
            part = (flat.view(np.uint64) >> np.uint64(11)) % np.uint64(blocks)
            order = np.lexsort((part, owner))
            flat, owner, part = flat[order], owner[order], part[order]
            new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(part.astype(np.int64), prepend=-1) != 0))
            offsets = np.append(new, len(flat)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part[new].astype(np.int64)),
                    batch.column(0).take(pa.array(owner[new])),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["block", "node", "shingles"],
            )
        memory_returned()

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        lengths = frame["shingles"].str.len().to_numpy()
        flat = np.concatenate(frame["shingles"].to_numpy())
        owner = np.repeat(np.arange(len(lengths)), lengths)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        same = flat[1:] == flat[:-1]
        shared = np.append(same, False) | np.insert(same, 0, False)
        owner = owner[shared]
        pa.default_memory_pool().release_unused()
        return pd.DataFrame(
            {
                "shingle": flat[shared],
                "node": frame["node"].to_numpy()[owner],
            }
        )


    parts = rows.select("node", "rare").mapInArrow(
        split, "block long, node long, shingles array<long>"
    )
    light = parts.groupBy("block").applyInPandas(meet, "shingle long, node long")
    heavy = rows.select(F.explode("often").alias("shingle"), "node")
    return light.unionByName(heavy)


def _sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """``node, set``: whole sets of the given nodes, as sorted 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        for batch in slices(batches, 0):
            sets = [shingles(t) for t in batch.column(0).to_pylist()]
            first, second = zip(*map(_fingerprint, sets))
            arrays = [pa.array(first), pa.array(second), pa.array([len(s) for s in sets], pa.int64())]
            arrays.append(pa.array([s.tobytes() for s in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["first", "second", "n", "set"])
        shingles.known.clear()
        memory_returned()

    wanted = kept(classes.join(nodes, "node").select("doc", "node", "print"))
    chosen = by_ids(docs.select("doc_id", "text"), wanted.select("doc").distinct(), "left_semi")
    found = chosen.select("text").mapInArrow(run, "first long, second long, n long, set binary")
    # other texts of the same ids go again
    found = found.select(_print(), "set").join(wanted.select("node", "print"), "print")
    return found.select("node", "set").dropDuplicates(["node"])


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs whose counted overlap reaches the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * overlap >= percent * (len(x) + len(y) - overlap))
            chosen = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            yield chosen
        memory_returned()

    one = sets.select(F.col("node").alias("a"), F.col("set").alias("left"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("right"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a long, b long")


def _pivots(meeting: DataFrame) -> DataFrame:
    """The pivots of every column: rows that come first under different bit masks."""
    pivots = [F.min(F.col("node").bitwiseXOR(mask)).bitwiseXOR(mask) for mask in MASKS]
    return meeting.groupBy("shingle").agg(F.array_distinct(F.array(*pivots)).alias("pivots"))


def _possible(met: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs, met once for each column, that the similarity is still possible for.

    Of the two, one has its leading columns end first; all that the pair shares up to there is
    counted, and what follows is at most that one's other columns.
    """
    counted = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("overlap"))
    sized = counted.join(sizes.select(F.col("node").alias("a"), "n"), "a")
    sized = sized.join(sizes.select(F.col("node").alias("b"), F.col("n").alias("m")), "b")
    larger, smaller = F.greatest("n", "m"), F.least("n", "m")
    need = F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))
    rest = F.ceil(percent * larger / 100) - 1
    fits = (100 * smaller >= percent * larger) & (F.col("overlap") >= need - rest)
    return sized.where(fits).select("a", "b")


def _near_pairs(meeting: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a column's rows with its pivots, two pivots once.

    A row meets at most a few others in a column of any length, so pairs follow the entries.
    """
    entries = meeting.select("shingle", "node").join(_pivots(meeting), "shingle")
    node = F.col("node")
    others = F.filter("pivots", lambda p: (p < node) | (p > node) & ~F.array_contains("pivots", node))
    met = entries.select("node", F.explode(others).alias("other"))
    met = met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    return _possible(met, sizes, percent)


def _may_link(shared: str, sizes: list[str], percent: int) -> Column:
    """Whether so many shared columns may do for some pair of rows with sizes in these bounds.

    The fewest do when the smaller row is as small and the larger as large as can be; rounding is
    left out, which lets more through.
    """
    small, large = F.least(*sizes), F.greatest(*sizes)
    small = F.greatest(small, percent * large / 100)
    return F.col(shared) > percent * (small + large) / (100 + percent) - percent * large / 100 - 1e-6


def _still_apart(
    meeting: DataFrame, groups: DataFrame, sizes: DataFrame, percent: int
) -> DataFrame:
    """Pairs of rows in different groups, written; columns within one group take no part.

    A group stands in a column once, however many of its rows do, and rows of a group that have
    one size and the same columns are one row. Only of two groups that share columns enough are
    rows held against the other group, and only those that share enough with it against each other.
    """
    placed = meeting.select("shingle", "node").join(groups, "node", "left")
    placed = placed.select("shingle", "node", F.coalesce("component", "node").alias("c"))
    columns = placed.groupBy("shingle").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    shared = kept(placed.join(columns.where("lo < hi").select("shingle"), "shingle"))
    alike = shared.groupBy("node", "c").agg(
        F.bit_xor(F.xxhash64("shingle")).alias("columns"), F.count(F.lit(1)).alias("k")
    )
    prints = kept(alike.join(sizes, "node").select("node", F.xxhash64("c", "n", "columns", "k").alias("p")))
    alike = prints.join(prints.groupBy("p").agg(F.min("node").alias("stands")), "p").select("node", "stands")
    alike = kept(alike)
    entries = kept(shared.join(alike.where("node = stands").select("node"), "node", "left_semi"))
    dropped(shared, prints)
    present = entries.select("shingle", "c").distinct()
    bounds = sizes.join(groups, "node", "left").groupBy(F.coalesce("component", "node").alias("c"))
    bounds = bounds.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    bounds = kept(bounds.join(present.select("c").distinct(), "c", "left_semi"))
    other = bounds.toDF("d", "lo_d", "hi_d")

    # c < d takes every two groups once, those with rows of sizes that may go together
    present = kept(present.join(bounds, "c").select("shingle", "c", "lo", "hi"))
    met = present.join(present.toDF("shingle", "d", "lo_d", "hi_d"), "shingle").where("c < d")
    met = met.where((100 * F.col("hi") >= percent * F.col("lo_d")) & (100 * F.col("hi_d") >= percent * F.col("lo")))
    met = met.select("shingle", "c", "d")
    shared = met.groupBy("c", "d").agg(F.count(F.lit(1)).alias("shared"))
    shared = shared.join(bounds, "c").join(other, "d")
    near = shared.where(_may_link("shared", ["lo", "hi", "lo_d", "hi_d"], percent)).select("c", "d")
    near = kept(near)
    met = kept(met.join(near, ["c", "d"]).select("shingle", "c", "d"))
    dropped(present, near)
    both = met.unionByName(met.select("shingle", F.col("d").alias("c"), F.col("c").alias("d")))

    # rows that share enough with the other group, and where they do
    every = kept(entries.join(both, ["shingle", "c"]))
    dropped(entries, met)
    enough = every.groupBy("node", "d").agg(F.count(F.lit(1)).alias("shared"))
    enough = enough.join(sizes, "node").join(other, "d")
    enough = enough.where(_may_link("shared", ["n", "lo_d", "hi_d"], percent)).select("node", "d")
    facing = kept(every.join(enough, ["node", "d"]))
    dropped(every, bounds)
    left = facing.where("c < d").select("shingle", F.col("node").alias("x"), "c", "d")
    right = facing.where("c > d").select(
        "shingle", F.col("node").alias("y"), F.col("d").alias("c"), F.col("c").alias("d")
    )
    met = left.join(right, ["shingle", "c", "d"]).select(F.col("x").alias("a"), F.col("y").alias("b"))
    found = _possible(met, sizes, percent).toDF("x", "y")
    found = found.join(alike.toDF("a", "x"), "x").join(alike.toDF("b", "y"), "y")
    found = kept(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    dropped(alike, facing)
    return found


def similar_groups(docs: DataFrame, percent: int = 75, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Two documents link if their sets of ``width``-word shingles overlap in ``percent`` of their
    union or more; a text of fewer words is one shingle. A null or empty text has an empty set and
    links with nothing, as does a row without ``doc_id``, whose component is null. Rows that share
    a ``doc_id`` are one document: what one of them links with, all do. Shingles are told apart by
    64-bit hashes. An empty table gives none; further columns are ignored.
    """
    tasks_find_package(docs.sparkSession)
    written = kept(_signatures(docs, percent, width))
    signed = written.withColumn("print", F.when(F.col("n") > 0, _print()))
    brief = kept(signed.select("doc_id", "n", "print"))
    full = signed.where("n > 0 and doc_id is not null")
    known = brief.where("n > 0 and doc_id is not null")
    classes = known.groupBy("print").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"))
    # a class goes by its smallest doc_id; classes of one id, if it has several texts, by their prints
    classes = kept(classes.withColumn("several", F.count(F.lit(1)).over(Window.partitionBy("doc")) > 1))
    several = kept(classes.where("several").select("doc").distinct())
    node = F.when(F.col("several"), F.col("print")).otherwise(F.col("doc"))
    classes = classes.select("print", "doc", "n", node.alias("node"))
    sizes = classes.select("node", "n")
    # the row of the smallest doc_id stands for its class, once
    own = F.xxhash64("doc_id", "print").alias("own")
    places = known.groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("rows")).join(classes, "print")
    copy = (F.col("doc_id") > F.col("doc")).alias("copy")
    places = kept(places.select("doc_id", "print", "node", "rows", copy))
    rows = full.select("doc_id", "print", "n", "rare", "often", own)
    rows = by_ids(rows, places.where("copy").select(own), "left_anti", "own")
    often = kept(places.where("not copy and rows > 1").select(own))
    again = by_ids(rows, often, "left_semi", "own").dropDuplicates(["own"])
    rows = by_ids(rows, often, "left_anti", "own").unionByName(again).drop("own")
    alone = by_ids(rows, several, "left_anti").withColumn("node", F.col("doc_id"))
    rows = alone.unionByName(by_ids(rows, several, "left_semi").withColumn("node", F.col("print")))
    entries = signed.agg(F.sum(F.size("rare"))).first()[0] or 0
    meeting = kept(_meeting(rows, max(64, -(-entries // BLOCK))))
    dropped(written, often)

    pairs = kept(_near_pairs(meeting, sizes, percent))
    sets = kept(_sets(docs, _ends(pairs), classes, width))
    found = components(_links(pairs, sets, percent))
    apart = _still_apart(meeting, found, sizes, percent)
    dropped(meeting)
    rest = kept(apart.join(pairs, ["a", "b"], "left_anti"))
    dropped(apart, pairs)
    ends = kept(_ends(rest))
    unread = kept(ends.join(sets.select("node"), "node", "left_anti"))
    read = sets.join(ends, "node", "left_semi")
    new = kept(_sets(docs, unread, classes, width))
    # what is found joins through its smallest node, and the classes of one id through theirs
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    shared = places.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    shared = places.join(shared.where("a < z").select("doc_id", "a"), "doc_id")
    shared = shared.select("a", F.col("node").alias("b"))
    links = stars.unionByName(_links(rest, read.unionByName(new), percent)).unionByName(shared)
    groups = components(links)
    dropped(sets, new, rest, ends, unread, places)

    # the smallest id of a component
    inside = classes.join(groups, "node", "left").select("print", "doc", F.coalesce("component", "node").alias("c"))
    least = inside.groupBy("c").agg(F.min("doc").alias("least"))
    least = kept(inside.join(least, "c").select("print", "least"))
    dropped(classes)
    placed = brief.join(least, "print", "left")
    own = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNotNull(), own)
    return placed.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 75, width: int = WIDTH) -> DataFrame:
    """The documents with all their columns, one of each group: that with the smallest ``doc_id``.

    Documents without words or without ``doc_id`` all stay; of rows that share a ``doc_id`` and
    have words one stays.
    """
    gone = similar_groups(docs, percent, width).where("doc_id <> component_id").select("doc_id")
    stay = by_ids(docs.select(F.struct("*").alias("row"), "doc_id"), gone.distinct(), "left_anti")
    # only ids that stand more than once need a look at their rows
    often = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    often = kept(often.where("rows > 1").select("doc_id"))
    once = by_ids(stay, often, "left_anti")
    rest = by_ids(stay, often, "left_semi")
    blank = F.length(F.translate(text_of("row.text"), BLANKS, "")) == 0
    first = rest.where(~blank).groupBy("doc_id").agg(F.min_by("row", F.xxhash64("row.text")).alias("row"))
    out = once.select("row").unionByName(rest.where(blank).select("row"))
    return out.unionByName(first.select("row")).select("row.*")
