"""The mixture reaches the rows that the pipeline returns."""

from __future__ import annotations

import corpus_pipeline
from echoloom.llm import mixing
from echoloom.workspace import materialize

SF = "/root/testdata/sf0.01"


def test_rows_follow_the_schedule(spark):
    docs = materialize(spark.read.parquet(f"{SF}/documents.parquet").limit(600), "few")
    slots = mixing.mix_sources(docs, mixing.tempered_weights(docs)).collect()
    order = [r["doc_id"] for r in sorted(slots, key=lambda r: (r["slot"], r["row_in_block"]))]
    stored = materialize(corpus_pipeline.mix(spark, docs, SF), "mixed")
    rows = corpus_pipeline.encode(spark, stored, SF).collect()
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["position"])] == order
    assert len({r["position"] for r in rows}) == len(rows)


def test_run_returns_rows_in_mixed_order(spark, monkeypatch):
    stages = [s for s in corpus_pipeline.STAGES if s[0] in ("exact_dedup", "mix_sources", "bpe")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = materialize(corpus_pipeline.exact_dedup(spark, docs, SF), "left")
    slots = mixing.mix_sources(left, mixing.tempered_weights(left)).collect()
    order = [r["doc_id"] for r in sorted(slots, key=lambda r: (r["slot"], r["row_in_block"]))]
    # Many small files, read in an order of the reader's own.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "100k"}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = corpus_pipeline.run(spark, SF).collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert [r["doc_id"] for r in rows] == order


def test_placed_replaces_a_column_of_its_name(spark):
    stored = materialize(spark.range(5).selectExpr("id AS doc_id", "'x' AS position", "1 AS _file", "2 AS _at"), "named")
    found = corpus_pipeline.placed(stored)
    assert found.columns == ["doc_id", "_file", "_at", "position"]
    assert [r["doc_id"] for r in found.orderBy("position").collect()] == list(range(5))
