"""The pipeline's stages on the smallest tables and on odd rows."""

import corpus_pipeline
import numpy as np
import pytest
import tiktoken  # noqa: F401  (the stages need the tokenizer files)

from farebox.llm import mixing, simhash, toxicity
from farebox.llm.common import table
from farebox.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_stages_on_documents(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "secret_scan", "mixing", "byte_bpe"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == columns
        if name == "toxicity":
            predicted = toxicity.score(before, toxicity.fit(before, table(spark, SF, "labels")))
            assert kept.count() == predicted.where("predicted = 0").count()
        if name == "simhash_near_dedup":
            rows = simhash.near_duplicates(before).collect()
            assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in rows})
    assert kept.where("text rlike 'AKIA[A-Z0-9]{14,}'").count() == 0
    ids = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "n_tokens", "ids"} <= set(ids.columns) and ids.count() > 0


def test_mixing_after_toxicity_meets_shares(spark):
    """Stage 4 on what stage 1 leaves: shares reached, and no document multiplied."""
    docs = corpus_pipeline.drop_toxic(spark, table(spark, SF, "documents"), SF)
    rows = mixing.mix(docs, table(spark, SF, "labels")).collect()
    total = [sum(r.n_tokens * r[f"p_{d}"] * r.rate for r in rows) for d in mixing.TARGETS]
    present = np.array([sum(r.n_tokens * r[f"p_{d}"] for r in rows) for d in mixing.TARGETS])
    goals = mixing.goals_of(present)
    for got, goal in zip(total, goals):
        assert np.isnan(goal) or got == pytest.approx(goal, rel=0.02)
    assert max(r.rate for r in rows) <= 1 / mixing.SCARCE


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_odd_rows(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 50_000, None, "s", 100_000),
            (3, "a normal text of some words", "en", None, None)]
    out = stage(spark, spark.createDataFrame(rows, schema), SF)
    assert out.count() >= 0
    assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0
