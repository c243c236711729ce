"""Repeatable samples of exact size.

Every row has a fixed hash of its key and the seed, and a sample is the rows with
the smallest hashes; rows of one hash are ordered by all their columns, so that a
key that is not unique leaves nothing to chance. A small count per hash prefix
tells where the cut falls, and counts within the cut prefix narrow it by further
digits, so only rows next to the cut are ever ranked; a stratum holding most of
the rows is no harder than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.schema import SAMPLE_COLUMNS
from wakeline.sources.tables import layer_path, write_full

SEED = 42
ROWS_PER_DAY = 60_000
#: Hexadecimal digits of the hash that one counting step adds, and the steps: 32 bits in all, so
#: that of 10^12 rows of a stratum a few hundred share the cut prefix.
PREFIX_DIGITS, STEPS = 4, 2
DEFAULT_KEY = ("mmsi", "event_time")


def _row_hash(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def stratified_sample(
    frame: DataFrame,
    n: int,
    strata: Sequence[str] = ("source_date",),
    key: Sequence[str] = DEFAULT_KEY,
    seed: int = SEED,
    prefix_digits: int = PREFIX_DIGITS,
    steps: int = STEPS,
) -> DataFrame:
    """Up to ``n`` rows of each stratum, which is all of a smaller one.

    ``key`` identifies a row as far as it can; rows equal in it are told apart by
    their other columns. Cuts have one row per stratum; how they are joined is left
    to adaptive execution. Building the sample starts no job.
    """
    strata = list(strata)
    hashed = frame.withColumn("_hash", _row_hash(key, seed))
    cuts = _cuts(hashed, strata, int(n), prefix_digits, steps)
    prefix = F.substring("_hash", 1, prefix_digits * steps)
    near = _beside(hashed, cuts, strata).where(prefix <= F.col("_cut"))
    # prefixes below the cut are taken whole; inside the cut prefix the rank decides
    rest = [c for c in frame.columns if c not in key and _orderable(frame.schema[c].dataType)]
    within = Window.partitionBy(*strata, prefix).orderBy("_hash", *key, *rest)
    chosen = near.withColumn("_rank", F.row_number().over(within)).where(
        (prefix < F.col("_cut")) | (F.col("_rank") <= F.col("_room"))
    )
    return chosen.select(*frame.columns)


def _orderable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def _beside(hashed: DataFrame, cuts: DataFrame, strata: list[str]) -> DataFrame:
    """Rows beside the cut of their stratum, null being a stratum of its own."""
    if not strata:
        cut = cuts.select(F.struct("_cut", "_room").alias("_")).scalar()
        return hashed.withColumn("_at", cut).select("*", "_at.*").drop("_at")
    same = [hashed[s].eqNullSafe(cuts[f"_s{i}"]) for i, s in enumerate(strata)]
    return hashed.join(cuts, same)


def _cuts(hashed: DataFrame, strata: list[str], n: int, digits: int, steps: int) -> DataFrame:
    """Per stratum the prefix in which the sample fills up and the room left in it."""
    names = [f"_s{i}" for i in range(len(strata))]
    named = [F.col(s).alias(name) for s, name in zip(strata, names)]
    rows, room, cuts = hashed, F.lit(n), None
    for step in range(1, steps + 1):
        if cuts is not None:
            # only the rows of the cut prefix are counted again
            rows = _beside(hashed, cuts, strata)
            rows = rows.where(F.substring("_hash", 1, digits * (step - 1)) == F.col("_cut"))
            room = F.max("_room")
        prefix = F.substring("_hash", 1, digits * step).alias("_prefix")
        counts = rows.groupBy(*named, prefix).agg(F.count(F.lit(1)).alias("_n"), room.alias("_left"))
        running = Window.partitionBy(*names).orderBy("_prefix")
        before = F.sum("_n").over(running) - F.col("_n")
        cuts = (
            counts.withColumn("_free", F.col("_left") - before)
            .where(F.col("_free") > 0)
            .groupBy(*names)
            .agg(F.max("_prefix").alias("_cut"), F.max_by("_free", "_prefix").alias("_room"))
        )
    return cuts


def capped_sample(
    frame: DataFrame,
    n: int,
    key: Sequence[str] = DEFAULT_KEY,
    seed: int = SEED,
) -> DataFrame:
    """``n`` rows of the whole frame, or all of it when it is smaller."""
    return stratified_sample(frame, n, (), key, seed)


def proportional_sample(
    frame: DataFrame,
    n: int,
    strata: Sequence[str] = ("source_date",),
    minimum: int = 1000,
    key: Sequence[str] = DEFAULT_KEY,
    seed: int = SEED,
) -> DataFrame:
    """An equal share of ``n`` from every stratum, ``minimum`` at least, then at most ``n``."""
    groups = frame.select(*strata).distinct().count()
    share = max(n // max(groups, 1), minimum)
    shares = stratified_sample(frame, share, strata, key, seed)
    return capped_sample(shares, n, key, seed)


def daily_position_sample(
    positions: DataFrame, rows_per_day: int = ROWS_PER_DAY, seed: int = SEED
) -> DataFrame:
    """The dashboard's position sample: few columns, a fixed number of rows per day."""
    days = positions.select(*SAMPLE_COLUMNS, F.col("source_date").cast("date"))
    sample = stratified_sample(days, rows_per_day, ("source_date",), DEFAULT_KEY, seed)
    return sample.withColumn("source_date", F.col("source_date").cast("string"))


def write_position_sample(
    positions: DataFrame, root: str, rows_per_day: int = ROWS_PER_DAY, seed: int = SEED
) -> None:
    """Replace the sample layer, by date."""
    sample = daily_position_sample(positions, rows_per_day, seed)
    write_full(sample, layer_path(root, "silver_sample"), ["source_date"])
