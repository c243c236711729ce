"""One query per operator, over its whole table, and the SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm import (
    common,
    conversation_repair,
    embedding_dedup,
    hidden_states,
    langid,
    license_scan,
    line_dedup,
    mixing,
    ngram_join,
    oracle,
    packing,
    quality_rules,
    reversed_search,
    secrets,
    toxicity,
)

QUERIES = {}
ORACLE: dict[str, str] = {
    "op3_secret_scan": oracle.secret_scan(),
    "op11_conversation_repair": oracle.conversation_repair(),
    "op13_reversed_search": oracle.reversed_search(),
}


def query(function):
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed(docs: DataFrame) -> DataFrame:
    """Pieces and their places, written: so texts go to Python workers in small batches."""
    pieces = packing.pack(docs, tokenizer_path())
    return common.kept(
        pieces.select(
            "doc_id",
            "piece",
            "start",
            "length",
            F.crc32("ids").alias("ids_crc32"),
            "sequence_id",
            "offset",
        )
    )


@query
def op1_best_fit_packing(spark, sf_dir):
    return packed(documents(spark, sf_dir))


@query
def op10_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir))


@query
def op2_robust_quality(spark, sf_dir):
    return quality_rules.quality(documents(spark, sf_dir))


@query
def op3_secret_scan(spark, sf_dir):
    spans = F.col("spans")

    def count(order: int):
        return F.size(F.filter(spans, lambda s: s["order"] == order)).cast("long")

    n = {kind: count(order) for order, kind in enumerate(secrets.BASE_KINDS)}
    base = F.filter(spans, lambda s: s["order"] < len(secrets.BASE_KINDS))
    return secrets.scan(documents(spark, sf_dir)).select(
        "doc_id",
        *[c.alias(f"n_{k}") for k, c in n.items()],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(spans).alias("spans"),
    )


@query
def op4_language_codes(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@query
def op5_toxicity_models(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels)


@query
def op7_ngram_join(spark, sf_dir):
    return ngram_join.similar_groups(documents(spark, sf_dir))


@query
def op6_line_join(spark, sf_dir):
    return line_dedup.line_report(documents(spark, sf_dir))


@query
def op8_license_alignment(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir))


@query
def op9_vector_forest(spark, sf_dir):
    return embedding_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op12_hidden_states(spark, sf_dir):
    return hidden_states.score(documents(spark, sf_dir))


@query
def op13_reversed_search(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return reversed_search.search(documents(spark, sf_dir), items)
