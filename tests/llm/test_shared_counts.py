"""Pairs are sent once, as arrays, and counted where documents are scored."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from echoloom.llm import cross_entropy


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.4, 60) % 900) for _ in range(80)]
    return spark.createDataFrame([*enumerate([*texts, "", None, texts[0]])], "doc_id bigint, text string")


def scores(docs, models):
    return {r["doc_id"]: tuple(r)[1:] for r in cross_entropy.score_documents(docs, models).collect()}


def test_arrays_come_back():
    values = np.array([0, 1, 255, 256, 2**40 + 7, 2**64 - 1], dtype=np.uint64)
    assert cross_entropy.unpacked(cross_entropy.packed(values)).tolist() == values.tolist()
    assert len(cross_entropy.unpacked(cross_entropy.packed(values[:0]))) == 0


def test_scores_do_not_depend_on_chunks_and_slices(docs, monkeypatch):
    models = cross_entropy.fit_models(docs, docs.limit(3))
    whole = scores(docs, models)
    monkeypatch.setattr(cross_entropy, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(cross_entropy, "SLICE_TOKENS", 200)
    assert scores(docs, models) == whole
    some = docs.filter("doc_id % 3 = 0")
    assert scores(some, models) == {k: v for k, v in whole.items() if k % 3 == 0}


def test_a_pair_is_sent_in_one_array_of_its_chunk(docs, monkeypatch):
    """Each pair was a row of five numbers, and of nine when it met its counts."""
    sizes = docs.select(F.octet_length("text")).collect()
    tokens = [cross_entropy.token_numbers((r["text"] or "").encode()) for r in docs.collect()]
    batch = cross_entropy.sent_slices(cross_entropy.Counts.of(tokens), 4, 0, cross_entropy.SCORED)
    assert batch.num_rows <= 4 and len(sizes) == 83
    pairs = [cross_entropy.unpacked(x) for x in batch.column("pairs").to_pylist()]
    assert len(np.unique(np.concatenate(pairs))) == sum(map(len, pairs))
