"""A corpus pipeline out of the text operators: documents in, packed sequences out.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before it kept, and returns
the columns of ``documents``; the last returns pieces and their places. ``run`` writes what a stage
returns to the folder all executors share and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import common, langid, line_dedup, mixing, ngram_join, packing, queries


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: neither ``und`` nor too ambiguous to call.

    Decisions go by ``doc_id``: rows that share one go if any of them is rejected. Rows without
    ``doc_id`` cannot be told apart and stay.
    """
    found = langid.identify(docs)
    rejected = found.where((F.col("lang_pred") == langid.UNKNOWN) | F.col("ambiguous"))
    gone = rejected.where("doc_id is not null").select("doc_id").distinct()
    return common.by_ids(docs, gone, "left_anti")


def line_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that repeat an earlier one; none goes as a whole."""
    return line_dedup.without_later_lines(docs)


def ngram_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, none among them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    return queries.packed(docs)


STAGES = [
    ("language_id", language_id),
    ("line_join", line_join),
    ("ngram_groups", ngram_groups),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models, similarity joins and tokenizers are beyond SQL; the stages are tested by brute
#: force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = common.kept(docs)
    return docs
