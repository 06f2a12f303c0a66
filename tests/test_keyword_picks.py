"""Keywords from the first terms of a cluster, and from all where these do not settle it."""

from __future__ import annotations

import numpy as np
import pytest

from echoloom.operators import topics


def plain(terms, n, diversity=0.5):
    """Marginal relevance over all (term, score)."""
    def alike(a, b):
        a, b = set(a.split()), set(b.split())
        return len(a & b) / (len(a) * len(b)) ** 0.5

    top = max(s for _, s in terms)
    picked = [min(terms, key=lambda t: (-t[1], t[0]))[0]]
    while len(picked) < min(n, len(terms)):
        left = [t for t in terms if t[0] not in picked]
        gains = [(-round((1 - diversity) * s / top - diversity * max(alike(t, p) for p in picked), 9), -s, t) for t, s in left]
        picked.append(min(gains)[2])
    return picked


@pytest.mark.parametrize("first", [1, 2, 5, 200])
def test_picks_equal_those_among_all_terms(spark, monkeypatch, first):
    monkeypatch.setattr(topics, "FIRST_TERMS", first)
    monkeypatch.setattr(topics._picked, "__defaults__", (first,))
    rng = np.random.default_rng(first)
    words = [f"w{i}" for i in range(6)]
    every, rows = {}, []
    for cluster in range(12):
        names = sorted({" ".join(rng.choice(words, rng.integers(1, 3))) for _ in range(cluster + 1)})
        every[cluster] = [(t, float(rng.integers(1, 6))) for t in names]
        rows += [("a", cluster, t, s) for t, s in every[cluster]]
    df = spark.createDataFrame(rows, "app_id string, cluster int, term string, score double")
    got = {r["cluster"]: r["keywords"] for r in topics.diverse_keywords(df, ["app_id"], 3).collect()}
    assert got == {c: plain(t, 3) for c, t in every.items()}


def test_other_terms_are_stored_only_where_needed(spark, monkeypatch):
    stored = {}
    store = topics.materialize

    def counting(df, label):
        found = store(df, label)
        stored[label] = stored.get(label, 0) + found.count()
        return found

    monkeypatch.setattr(topics, "materialize", counting)
    rows = [("a", 0, f"term{i}", 1000.0 - i) for i in range(1000)]
    df = spark.createDataFrame(rows, "app_id string, cluster int, term string, score double")
    assert topics.diverse_keywords(df, ["app_id"], 2).first()["keywords"] == ["term0", "term1"]
    assert stored["candidates"] == topics.FIRST_TERMS
