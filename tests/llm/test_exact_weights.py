"""Schedules against the weights as given, not against rounded ones."""

from __future__ import annotations

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from echoloom.llm import mixing

WEIGHTS = [
    {"a": 1, "b": 1, "c": 1},
    {f"s{i}": 1 for i in range(600)},
    {"a": 0.9999, "b": 0.0001},
    {"a": 0.123457, "b": 0.7, "c": 0.176543},
    {"a": Fraction(1, 3), "b": Fraction(1, 7), "c": 2},
]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_every_slot_is_within_a_block_of_the_given_weights(weights):
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total = sum(exact.values())
    had = dict.fromkeys(exact, 0)
    for source, block, release, deadline, slot in mixing.schedule(mixing.exact_parts(weights), 12_000):
        assert had[source] == block and release <= slot < deadline
        had[source] += 1
        lag = had[source] - exact[source] / total * (slot + 1)
        assert abs(lag) < 1
        if slot % 500 == 499:
            assert all(abs(n - exact[s] / total * (slot + 1)) < 1 for s, n in had.items())


@pytest.mark.parametrize("weights, most", [
    (None, 100_000), ({"a": 0.7001, "b": 0.2, "c": 0.0999}, 100_000), ({"a": 0.7001, "b": 0.2, "c": 0.0999}, 10),
])
def test_rows_get_the_slots_of_the_given_weights(spark, monkeypatch, weights, most):
    monkeypatch.setattr(mixing, "BROADCAST_SLOTS", most)
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("source"),
    )
    rows = mixing.mix_sources(docs, weights, block_rows=1).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(6000))
    exact = {s: Fraction(str(w)) for s, w in (weights or dict.fromkeys("abc", 1)).items()}
    total = sum(exact.values())
    assert len({r["slot"] for r in rows}) == 6000
    for r in rows:
        # Block j (from 0) of a source of weight w lies between j / w and (j + 1) / w.
        share = exact[r["source"]] / total
        assert r["release"] == r["block"] // share and r["deadline"] == -(-(r["block"] + 1) // share)
        assert r["release"] <= r["slot"] < r["deadline"]
