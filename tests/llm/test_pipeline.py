"""The pipeline's stages against plain computations on the same rows."""

from __future__ import annotations

import corpus_pipeline
from echoloom.llm import golay, queries
from echoloom.workspace import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        found[name] = {r["doc_id"]: r for r in docs.collect()}
        assert name == "bpe" or docs.columns == columns
    clean = found["toxicity"]
    last = {}
    for doc, row in clean.items():
        last[row["text"]] = max(doc, last.get(row["text"], doc))
    assert set(found["exact_dedup"]) == set(last.values())
    prints = {d: golay.fingerprint(r["text"].encode()) for d, r in found["exact_dedup"].items()}
    linked = {
        d for d in prints for e in prints
        if e < d and ((prints[d] ^ prints[e]) & (2**64 - 1)).bit_count() <= 4
    }
    assert set(found["near_dedup"]) == set(prints) - linked
    assert set(found["mix_sources"]) == set(found["near_dedup"]) == set(found["bpe"])


def test_run_is_registered(spark):
    import __spark_entry__

    rows = __spark_entry__.queries()["pipeline"](spark, SF)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "position"]
    assert rows.count() > 0


def test_exact_query_equals_sql(spark):
    from oracle import compare, connect

    name = "op7_exact_refinement"
    assert compare(spark, connect(SF), queries.QUERIES[name], queries.ORACLES[name], SF) is None
