"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors of a label are one class. Every tree splits by a random direction at each depth, at
the median of what reaches a node, found on a bounded sample; vectors close to a split go to both
sides. Depth follows the number of classes of the largest label, so leaves stay small. Vectors of a
label are compared within leaves, in double precision; leaves of more than ``LEAF_MOST`` vectors
are compared in pairs of parts, each its own task, so that none is too large. Links of all trees
are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import kept, tasks_find_package
from wakeline.llm.components import components

TREES, LEAF, LEAF_MOST = 10, 96, 2_048
#: Share of a direction's spread within which a vector goes to both sides of a split.
SPILL = 0.1
#: Vectors that splits are fitted on, and depths that are; deeper ones split at drawn values.
SAMPLE, FITTED, SEED = 20_000, 12, 7


class Forest:
    """Directions of every tree and depth, and where each node splits."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES):
        self.depth, self.trees = depth, trees
        rng = np.random.default_rng(SEED)
        self.directions = rng.standard_normal((trees, depth, sample.shape[1]))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True)
        self.spread = np.ones((trees, depth))
        self.middle = np.zeros((trees, depth))
        self.splits: list[list[np.ndarray]] = []
        for tree in range(trees):
            at, levels = np.zeros(len(sample), dtype=np.int64), []
            for level in range(depth):
                along = sample @ self.directions[tree, level]
                if len(along):
                    self.middle[tree, level] = np.median(along)
                    self.spread[tree, level] = max(along.std(), 1e-9)
                if level < FITTED:
                    split = np.full(1 << level, self.middle[tree, level])
                    order = np.argsort(at, kind="stable")
                    nodes, begin = np.unique(at[order], return_index=True)
                    for node, own in zip(nodes, np.split(along[order], begin[1:])):
                        split[node] = np.median(own)
                    levels.append(split)
                at = 2 * at + (along > self._split(levels, tree, level, at))
            self.splits.append(levels)

    def _split(self, levels, tree: int, level: int, at: np.ndarray) -> np.ndarray:
        if level < FITTED:
            return levels[level][at]
        drawn = (at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) / (1 << 24)
        return self.middle[tree, level] + (drawn - 0.5) * self.spread[tree, level]

    def leaves(self, vectors: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and the leaves they fall into, a row once for each leaf."""
        rows, at = np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
        for level in range(self.depth):
            along = (vectors @ self.directions[tree, level])[rows]
            off = along - self._split(self.splits[tree], tree, level, at)
            both = np.abs(off) < SPILL * self.spread[tree, level]
            at = np.concatenate([2 * at + (off > 0), 2 * at[both] + (off[both] <= 0)])
            rows = np.concatenate([rows, rows[both]])
        return rows, at


def _unit(vectors) -> np.ndarray:
    x = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _leaf_rows(classes: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """``node, label, size, tree, leaf``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, own in frame.groupby("size"):
                vectors, forest = _unit(own["embedding"]), forests[int(size)]
                for tree in range(forest.trees):
                    rows, leaf = forest.leaves(vectors, tree)
                    out = own.iloc[rows][["node", "label", "size"]]
                    yield out.assign(tree=tree, leaf=leaf)

    return classes.select("node", "label", "size", "embedding").mapInPandas(
        run, "node long, label long, size int, tree int, leaf long"
    )


def _close(cells: DataFrame, least: float) -> DataFrame:
    """``a, b``: pairs within a cell at ``least`` or more; a cell of two parts compares across."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        node, part = frame["node"].to_numpy(), frame["part"].to_numpy()
        first, second = frame["first"].iloc[0], frame["second"].iloc[0]
        x = _unit(frame["embedding"])
        left = np.flatnonzero(part == first)
        right = np.flatnonzero(part == second)
        found = []
        for at in range(0, len(left), 256):
            rows = left[at : at + 256]
            i, j = np.nonzero(x[rows] @ x[right].T >= least)
            a, b = node[rows[i]], node[right[j]]
            found.append(np.column_stack([a, b])[a != b])
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    cell = ["label", "size", "tree", "leaf", "first", "second"]
    return cells.groupBy(*cell).applyInPandas(run, "a long, b long").distinct()


def _cells(leaves: DataFrame) -> DataFrame:
    """Every leaf as one cell, or as all pairs of its parts where it is large."""
    leaf = ["label", "size", "tree", "leaf"]
    large = leaves.groupBy(*leaf).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LEAF_MOST)
    parts = F.coalesce(F.ceil(F.col("n") / LEAF_MOST), F.lit(1)).cast("int")
    placed = leaves.join(large, leaf, "left").withColumn("parts", parts)
    placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    both = placed.select("node", *leaf, "part", other)
    return both.select(
        "node",
        *leaf,
        "part",
        F.least("part", "other").alias("first"),
        F.greatest("part", "other").alias("second"),
    )


def near_vectors(vectors: DataFrame, least: float = 0.98, trees: int = TREES) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Vectors of one label link when a tree brings them together and their cosine is ``least`` or
    more. A null label, a null or zero vector, or one with a null or non-finite component links
    with nothing, nor does a row without ``vec_id``, whose component is null and which is kept.
    Vectors of different lengths never link. Equal vectors always do; repeated rows are such. An
    empty table gives none; further columns are ignored.
    """
    tasks_find_package(vectors.sparkSession)
    vector = F.col("embedding")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & ~odd & (length > 0)
    key = [F.col("label").cast("long").alias("label"), F.size(vector).alias("size")]
    key += [F.xxhash64(vector).alias("one"), F.xxhash64(F.reverse(vector)).alias("two")]
    rows = vectors.select("vec_id", vector, *key, F.coalesce(usable, F.lit(False)).alias("usable"))
    names = ["label", "size", "one", "two"]
    classes = kept(
        rows.where("usable")
        .groupBy(*names)
        .agg(
            F.min("vec_id").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.any_value("embedding").alias("embedding"),
        )
    )
    forests = {}
    counts = classes.groupBy("size", "label").agg(F.count(F.lit(1)).alias("n"))
    for row in counts.groupBy("size").agg(F.max("n").alias("n")).collect():
        drawn = classes.where(F.col("size") == row["size"]).orderBy(F.xxhash64("node"), "node")
        sample = drawn.limit(SAMPLE).select("embedding").toPandas()
        depth = max(0, int(np.ceil(np.log2(max(row["n"] / LEAF, 1)))))
        forests[row["size"]] = Forest(_unit(sample["embedding"]), depth, trees if depth else 1)
    if not forests:
        forests[0] = Forest(np.ones((1, 1)), 0, 1)
    leaves = kept(_leaf_rows(classes, forests))
    cells = _cells(leaves).join(classes.select("node", "embedding"), "node")
    pairs = kept(_close(cells, least))

    groups = components(pairs)
    copies = classes.select(F.col("node").alias("other"), "copies")
    both = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
            )
        )
    )
    linked = both.join(copies, "other").groupBy("node").agg(F.sum("copies").alias("linked"))
    placed = classes.select(*names, F.col("node").alias("class"), "copies")
    placed = placed.join(linked, F.col("class") == linked["node"], "left").drop("node")
    placed = placed.join(groups, F.col("class") == groups["node"], "left")
    found = placed.select(
        *[F.col(c).alias(f"k_{c}") for c in names],
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("links"),
        F.coalesce("component", "class").alias("component"),
    )
    same = F.col("usable")
    for c in names:
        same = same & (F.col(c) == F.col(f"k_{c}"))
    out = rows.join(found, same, "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
