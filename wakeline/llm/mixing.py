"""Mixing sources to target weights by pivotal dependent rounding.

A document's copies are a whole number plus a fraction to be rounded. Two fractional documents
exchange words, in a direction drawn so that expectations stay, until one has a whole number of
copies; its partner goes on. Words are conserved in each exchange, so a source ends within one
document of its target. Chunks of about ``CHUNK`` documents fold this way at once, each leaving at
most one fractional document; those fold again in chunks, level by level: a reduction tree whose
groups are bounded however large a source is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import dropped, kept, text_of, uniform, word_count

CHUNK = 128
#: A fraction this near to 0 or 1 counts as whole.
EPS = 1e-9
WEIGHTS = (1, 2, 3)
ITEM = "struct<size:bigint,key:bigint,doc_id:bigint,occurrence:int,base:int,part:double>"
DONE = "array<struct<size:bigint,doc_id:bigint,occurrence:int,copies:int>>"


def source_targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``.

    Sources in code point order, null last, weigh 1, 2, 3, repeating. Targets share the total by
    weight; none is above ``most`` times its source, and what that cuts off is shared again.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: the only thing ranked in one task
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    per = kept(per.select("source", "source_size", weight.alias("weight")))

    cap = F.col("source_size") * most
    level, capped = 0.0, -1
    while True:
        over = F.lit(level) * F.col("weight") > cap
        row = per.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(over, cap)).alias("held"),
            F.sum(F.when(~over, F.col("weight"))).alias("open"),
            F.count_if(over).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["open"]:
            break
        capped = row["capped"] if level else -1
        level = ((row["total"] or 0) - (row["held"] or 0)) / row["open"]
    target = F.least(cap.cast("double"), F.lit(level) * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def _exchange(level: int):
    """A fold's step: the waiting fractional document meets the next one."""

    def step(acc: Column, x: Column) -> Column:
        def meet(v: Column) -> Column:
            # v: gain and loss of x in words, as far as one of the two gets whole
            wins = uniform(x["doc_id"], x["occurrence"], F.lit(level)) * (
                v["gain"] + v["loss"]
            ) < v["loss"]
            moved = F.when(wins, v["gain"]).otherwise(-v["loss"])
            return F.struct(
                (x["part"] + moved / x["size"]).alias("own"),
                (acc["held"]["part"] - moved / acc["held"]["size"]).alias("other"),
            )

        def settle(v: Column) -> Column:
            own_done = (v["own"] < EPS) | (v["own"] > 1 - EPS)
            other_done = (v["other"] < EPS) | (v["other"] > 1 - EPS)
            done = F.concat(
                acc["done"],
                F.when(own_done, F.array(_whole(x, v["own"]))).otherwise(F.array().cast(DONE)),
                F.when(other_done, F.array(_whole(acc["held"], v["other"]))).otherwise(
                    F.array().cast(DONE)
                ),
            )
            held = F.when(~own_done, _item(x, v["own"])).when(
                ~other_done, _item(acc["held"], v["other"])
            )
            return F.struct(held.alias("held"), done.alias("done"))

        held = acc["held"]
        gain = F.least(x["size"] * (1 - x["part"]), held["size"] * held["part"])
        loss = F.least(x["size"] * x["part"], held["size"] * (1 - held["part"]))
        both = F.struct(gain.alias("gain"), loss.alias("loss"))
        # transform over one element names a value, so that it is worked out once
        met = F.transform(F.transform(F.array(both), meet), settle)[0]
        first = F.struct(_item(x, x["part"]).alias("held"), acc["done"].alias("done"))
        return F.when(held.isNull(), first).otherwise(met)

    return step


def _item(x: Column, part: Column) -> Column:
    names = ("size", "key", "doc_id", "occurrence", "base")
    return F.struct(*[x[n].alias(n) for n in names], part.alias("part")).cast(ITEM)


def _whole(x: Column, part: Column) -> Column:
    copies = (x["base"] + F.round(part)).cast("int")
    names = ("size", "doc_id", "occurrence")
    return F.struct(*[x[n].alias(n) for n in names], copies.alias("copies"))


def _fold(items: DataFrame, level: int) -> DataFrame:
    """``source, left, held, done``: a chunk's fractional rest, and the documents it settled."""
    chunks = F.ceil(F.col("left") / CHUNK).cast("long")
    bucket = F.pmod(F.xxhash64("doc_id", "occurrence", F.lit(level)), chunks)
    start = F.struct(F.lit(None).cast(ITEM).alias("held"), F.array().cast(DONE).alias("done"))
    folded = F.aggregate(F.array_sort("items"), start, _exchange(level))
    # dealt by chunk, or Spark would keep a source that an earlier join brought together in one task
    dealt = items.select("*", bucket.alias("bucket"), chunks.alias("chunks")).repartition(
        "source", "bucket"
    )
    return (
        dealt.groupBy("source", "bucket", F.col("chunks").alias("left"))
        .agg(F.collect_list(F.struct("size", "key", "doc_id", "occurrence", "base", "part")).alias("items"))
        .select("source", "left", folded.alias("folded"))
        .select("source", "left", "folded.held", "folded.done")
    )


def copies_of(docs: DataFrame, most: int = 3) -> DataFrame:
    """``doc_id, source, size, occurrence, source_size, target, copies`` for every document row.

    ``occurrence`` counts equal ``(doc_id, source, size)`` rows from 1. See ``mix``.
    """
    size = word_count(text_of("text"))
    return _copies(docs.select("doc_id", "source", size.alias("size")), most)


def _copies(sizes: DataFrame, most: int) -> DataFrame:
    per = sizes.groupBy("doc_id", "source", "size")
    rows = kept(per.agg(F.count(F.lit(1)).alias("rows")))
    total = rows.select("source", (F.col("size") * F.col("rows")).alias("size"))
    targets = source_targets(total, most)
    counts = rows.where("size > 0").groupBy("source").agg(F.sum("rows").alias("left"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio + EPS).cast("int")
    part = F.when(ratio - base < EPS, 0.0).otherwise(ratio - base)
    plan = targets.join(
        counts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left"
    ).select("source", "left", base.alias("base"), part.alias("part"))
    occurrence = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("occurrence")
    items = (
        rows.join(
            plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
        )
        .select("doc_id", "source", "size", "left", "base", "part", occurrence)
        .withColumn("key", F.xxhash64("doc_id", "occurrence"))
    )
    names = ["doc_id", "source", "size", "occurrence", "copies"]
    drawn = (F.col("part") > uniform("doc_id", "occurrence", F.lit(-1))).cast("int")
    # nothing to exchange: no fraction, or no words
    settled = items.where("part = 0 or size = 0").withColumn("copies", F.col("base") + drawn)
    done = [settled.select(*names)]
    items = items.where("part > 0 and size > 0")
    left, level = counts.agg(F.max("left")).first()[0] or 0, 0
    while left > 1:
        folded = kept(_fold(items, level))
        done.append(folded.select("source", F.inline("done")).select(*names))
        items = folded.where("held is not null").select("source", "left", "held.*")
        left, level = -(-left // CHUNK), level + 1
    last = items.withColumn("copies", F.col("base") + drawn)
    done.append(last.select(*names))
    out = done[0]
    for part_done in done[1:]:
        out = out.unionByName(part_done)
    return out.join(
        targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).select(*names[:4], "source_size", "target", "copies")


def mix(docs: DataFrame, most: int = 3) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, source`` for every document row.

    A document's size is its number of words, null text 0; ``taken`` its words times its copies.
    A source without words has target 0 and gives no copies; a document without words is copied
    by the same fraction, drawn by its key. Null is a source of its own, last in order. Repeated
    rows are documents of their own. All draws are hashes of ``doc_id`` and occurrence, so reruns
    agree. An empty table gives none; further columns are ignored.
    """
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return copies_of(docs, most).select(
        "doc_id", "size", "source_size", "target", taken, "copies", "source"
    )


def mixed_documents(docs: DataFrame, most: int = 3) -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with all their columns.

    Occurrences are given out among hashes of texts first. Rows of one key and text share what
    falls to them, so a text is only shuffled once, to the shares of its hash.
    """
    size, text = word_count(text_of("text")), F.xxhash64("text").alias("hash")
    key = F.struct("doc_id", "source").alias("key")
    light = kept(docs.select("doc_id", "source", size.alias("size"), text))
    same = Window.partitionBy("doc_id", "source", "size").orderBy("hash")
    numbered = light.withColumn("occurrence", F.row_number().over(same))
    names = ["doc_id", "source", "size", "occurrence"]
    copies = _copies(light.select(*names[:3]), most).select(
        F.struct(*names).alias("place"), "copies"
    )
    numbered = numbered.select(key, "hash", F.struct(*names).alias("place"))
    shares = numbered.join(copies, "place").groupBy("key", "hash")
    shares = shares.agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies"))
    shares = kept(shares.where("copies > 0"))
    dropped(light)

    whole, over = F.expr("copies div rows"), F.expr("copies % rows")
    named = docs.select(F.struct("*").alias("row"), key, text)
    among = F.row_number().over(Window.partitionBy("key", "hash").orderBy(F.lit(0)))
    dealt = named.withColumn("at", among).join(shares, ["key", "hash"])
    times = (whole + F.when(F.col("at") <= over, 1).otherwise(0)).alias("times")
    each = F.explode(F.sequence(F.lit(1), "times")).alias("copy")
    return dealt.select("row", times).where("times > 0").select("row", each).select("row.*")
