"""Quality rules: base limits, then robust multivariate outliers of text statistics.

A document's statistics are made into a vector of roughly symmetric numbers. For every language
and source the minimum-covariance-determinant estimate of that vector is found: from several
starting subsets, means and covariances of the ``H`` share of documents nearest to the centre are
worked out again and again (concentration steps), and the start that ends with the smallest
determinant counts. A document far from its group's centre by Mahalanobis distance is rejected.
All of it is aggregation over a narrow table of numbers written once; group tables have one row per
group and start. Groups of any size are summed in part before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import BLANKS, kept, text_of, words

SYMBOLS = "#*$%&|<>"
BASE_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
VECTOR = ["word_length", "symbols", "dup_lines", "repeats"]
#: Least spread of each number, so that a statistic that is nearly always 0 does not decide alone.
FLOOR = {"word_length": 0.15, "symbols": 0.12, "dup_lines": 0.4, "repeats": 0.4}
#: Share of documents nearest the centre, concentration steps, added variance, smallest group.
H, STEPS, RIDGE, MIN_GROUP = 0.75, 3, 0.25, 100
#: Squared distance above which a document goes, and the median: the 0.9995 and 0.5 quantiles of
#: chi-square with 4 degrees of freedom.
CUT, CHI2_MEDIAN = 20.0, 3.3567
ACCURACY = 1000
#: Parts that a group's rows are joined in, so that a large group is not brought to one task.
SALTS = 32


def _repeat_words(word_list: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def window(word: Column, at: Column) -> Column:
        text = F.concat_ws(" ", word, F.get(word_list, at + 1), F.get(word_list, at + 2))
        return F.struct(text.alias("text"), at.alias("at"))

    windows = F.slice(F.transform(word_list, window), 1, F.greatest(F.size(word_list) - 2, F.lit(0)))

    def again(ordered: Column) -> Column:
        def equal(x: Column, at: Column) -> Column:
            before, after = F.get(ordered, at - 1)["text"], F.get(ordered, at + 1)["text"]
            return F.coalesce(x["text"] == before, F.lit(False)) | F.coalesce(
                x["text"] == after, F.lit(False)
            )

        return F.sort_array(F.transform(F.filter(ordered, equal), lambda x: x["at"]))

    starts = F.transform(F.array(F.sort_array(windows)), again)[0]
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, at: F.struct(
            at.alias("last"), (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n")
        ),
    )
    return F.coalesce(covered["n"], F.lit(0).cast("long"))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the counts of ``BASE_COLUMNS``, ``n_lines`` and ``base_failed``.

    Lines count if they hold a word. A null text has no words, and so fails the base rules.
    """
    text = F.col("t")
    rows = docs.select("doc_id", "lang", "source", text_of("text").alias("t"))
    rows = rows.withColumn("w", words(text)).withColumn(
        "lines", F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    )
    counted = rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def _vector() -> dict[str, Column]:
    n, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "word_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "symbols": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / lines),
        "repeats": F.sqrt(F.col("n_repeat_words") / n),
    }


def _beside(rows: DataFrame, groups: DataFrame, *keys: str) -> DataFrame:
    """Rows, which have a ``salt``, beside the row of their group."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return rows.join(groups.select("*", salts), [*keys, "salt"])


def _scaled(rows: DataFrame) -> DataFrame:
    """The vector in units of its group's median deviation from its group's median."""
    half = lambda c: F.percentile_approx(c, 0.5, ACCURACY)
    medians = kept(rows.groupBy("cell").agg(*[half(v).alias(f"mid_{v}") for v in VECTOR]))
    off = _beside(rows, medians, "cell")
    spread = kept(
        off.groupBy("cell").agg(
            *[half(F.abs(F.col(v) - F.col(f"mid_{v}"))).alias(f"mad_{v}") for v in VECTOR]
        )
    )
    unit = {v: F.greatest(1.4826 * F.col(f"mad_{v}"), F.lit(FLOOR[v])) for v in VECTOR}
    scaled = {v: (F.col(v) - F.col(f"mid_{v}")) / unit[v] for v in VECTOR}
    names = [c for c in rows.columns if c not in VECTOR]
    return _beside(off, spread, "cell").select(*names, *[scaled[v].alias(v) for v in VECTOR])


def _starts() -> Column:
    """First distances: Euclidean, largest and mean deviation, each a start of its own."""
    off = [F.abs(F.col(v)) for v in VECTOR]
    first = [sum(x * x for x in off), F.greatest(*off), sum(off)]
    return F.explode(
        F.array(*[F.struct(F.lit(n).alias("start"), d.alias("d2")) for n, d in enumerate(first)])
    ).alias("first")


def _estimate(subset: DataFrame) -> DataFrame:
    """Means, Cholesky factor of the covariance and its log determinant, by group and start."""
    size = len(VECTOR)
    moments = [F.avg(v).alias(f"m{i}") for i, v in enumerate(VECTOR)]
    moments += [
        F.avg(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"c{i}{j}")
        for i in range(size)
        for j in range(i + 1)
    ]
    fit = subset.groupBy("cell", "start").agg(*moments)
    col = F.col
    for j in range(size):
        for i in range(j, size):
            value = col(f"c{i}{j}") - col(f"m{i}") * col(f"m{j}")
            value -= sum((col(f"l{i}{k}") * col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(0.0)) + RIDGE)
            else:
                value = value / col(f"l{j}{j}")
            fit = fit.withColumn(f"l{i}{j}", value)
    log_det = sum(F.log(col(f"l{i}{i}")) for i in range(size))
    means, factor = [f"m{i}" for i in range(size)], [c for c in fit.columns if c[0] == "l"]
    return kept(fit.select("cell", "start", *means, *factor, log_det.alias("log_det")))


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: list[Column] = []
    for i, v in enumerate(VECTOR):
        left = F.col(v) - F.col(f"m{i}")
        for j, y in enumerate(solved):
            left = left - F.col(f"l{i}{j}") * y
        solved.append(left / F.col(f"l{i}{i}"))
    return sum(y * y for y in solved)


def _nearest(rows: DataFrame) -> DataFrame:
    """Rows among the ``H`` share nearest the centre of their group and start."""
    limit = rows.groupBy("cell", "start").agg(F.percentile_approx("d2", H, ACCURACY).alias("limit"))
    return _beside(rows, limit, "cell", "start").where("d2 <= limit")


def _best_fit(rows: DataFrame) -> DataFrame:
    """The estimate with the smallest determinant for every group, and its median distance."""
    first = rows.select("cell", "salt", *VECTOR, _starts())
    fit = _estimate(_nearest(first.select("cell", "salt", *VECTOR, "first.*")))
    starts = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("start")
    every = rows.select("cell", "salt", *VECTOR, starts)
    for _ in range(STEPS):
        near = _beside(every, fit, "cell", "start")
        near = near.select("cell", "salt", "start", *VECTOR, _distance().alias("d2"))
        fit = _estimate(_nearest(near))
    best = fit.groupBy("cell").agg(F.min(F.struct("log_det", "start")).alias("best"))
    fit = fit.join(best, "cell").where("start = best.start").drop("best", "start")
    middle = (
        _beside(rows, fit, "cell")
        .groupBy("cell")
        .agg(F.percentile_approx(_distance(), 0.5, ACCURACY).alias("middle"))
    )
    return kept(fit.join(middle, "cell"))


def quality(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``distance`` and ``kept`` for every row.

    A document goes if it fails the base rules or its squared robust distance is above ``cut``;
    distances whose median is above that of a chi-square variable are scaled down to it. Groups are language and source,
    null being a value; those under ``MIN_GROUP`` documents pool by language, and where even that
    is too few nobody is judged and ``distance`` is null. Repeated rows are each judged; an empty
    table gives none; further columns are ignored.
    """
    rows = kept(statistics(docs))
    names = ["doc_id", *BASE_COLUMNS, "base_failed"]
    judged = rows.where("not base_failed")
    both, alone = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    sizes = judged.groupBy(both.alias("both"), alone.alias("alone")).agg(F.count(F.lit(1)).alias("n"))
    cells = sizes.select(
        "both", "n", F.when(F.col("n") >= MIN_GROUP, F.col("both")).otherwise(F.col("alone")).alias("cell")
    )
    totals = cells.groupBy("cell").agg(F.sum("n").alias("total"))
    cells = kept(
        cells.join(totals, "cell").select(
            "both", F.when(F.col("total") >= MIN_GROUP, F.col("cell")).alias("cell")
        )
    )
    # the key of a document, as far as it has one, deals its group's rows
    salt = F.pmod(F.xxhash64("doc_id", "word_chars"), F.lit(SALTS)).cast("int")
    celled = _beside(judged.withColumns({"both": both, "salt": salt}), cells, "both").drop("both")
    vectors = celled.select(*names, "cell", "salt", *[c.alias(v) for v, c in _vector().items()])
    scaled = kept(_scaled(vectors.where("cell is not null")))
    fit = _best_fit(scaled)
    scale = F.greatest(F.col("middle") / CHI2_MEDIAN, F.lit(1.0))
    distance = _beside(scaled, fit, "cell").select(*names, (_distance() / scale).alias("distance"))
    free = vectors.where("cell is null").unionByName(
        rows.where("base_failed").select(*names), allowMissingColumns=True
    )
    free = free.select(*names, F.lit(None).cast("double").alias("distance"))
    verdict = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cut)
    return distance.unionByName(free).withColumn("kept", verdict)
