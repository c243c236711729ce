from __future__ import annotations

import corpus_pipeline
import __spark_entry__ as entry
from tests.llm.frames import empty, odd
from tests.llm.test_line_dedup import removed
from tests.llm.test_ngram_join import groups
from tests.llm.test_packing import check
from wakeline.llm import common, queries

SF = "/root/testdata/sf0.001"
NAMES = ["language_id", "line_join", "ngram_groups", "mix_sources", "best_fit_packing"]


def test_stages_against_brute_force(spark):
    """Each stage on what the one before it left."""
    docs, stages = queries.documents(spark, SF), dict(corpus_pipeline.STAGES)
    columns = docs.columns
    assert list(stages) == NAMES

    def step(name, before):
        out = common.kept(stages[name](spark, before, SF))
        return out, out.collect()

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    told, rows = step("language_id", docs)
    assert told.columns == columns
    assert {r["doc_id"] for r in rows} == {i for i, t in texts.items() if any(c.isalpha() for c in t)}

    shorter, rows = step("line_join", told)
    gone = removed({r["doc_id"]: r["text"] for r in told.collect()})
    left = {r["doc_id"]: r["text"] for r in rows}
    assert shorter.columns == columns and gone
    for doc_id, text in left.items():
        lines = texts[doc_id].split("\n")
        assert text == "\n".join(x for n, x in enumerate(lines) if n not in gone.get(doc_id, ()))

    apart, rows = step("ngram_groups", shorter)
    want = groups(left)
    assert apart.columns == columns
    assert {r["doc_id"] for r in rows} == {i for i, (_, c) in want.items() if i == c}

    mixed, rows = step("mix_sources", apart)
    assert mixed.columns == columns
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in apart.collect()}

    once = mixed.dropDuplicates(["doc_id"])
    packed = stages["best_fit_packing"](spark, once, SF).collect()
    check(packed, {r["doc_id"]: r["text"] for r in once.collect()})


def test_run_is_the_stages_one_after_the_other(spark):
    whole = corpus_pipeline.run(spark, SF)
    docs = queries.documents(spark, SF)
    for _, stage in corpus_pipeline.STAGES:
        docs = common.kept(stage(spark, docs, SF))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(whole.select(*key).collect()) == sorted(docs.select(*key).collect())
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_odd_and_empty_documents_pass_every_stage(spark):
    for docs in (odd(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            docs = common.kept(stage(spark, docs, SF))
            if docs.count() == 0:
                break


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(entry.queries())
