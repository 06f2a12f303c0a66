"""Language models keep every word and every pair apart."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from echoloom.llm import cross_entropy


def test_rare_words_and_pairs_are_counted_exactly(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{n}" for n in rng.zipf(1.3, 400) % 60_000) for _ in range(300)]
    texts += [texts[0], "only here"]
    wanted = ["w1 rareword w2", "rareword w2 w1"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    models = cross_entropy.fit_models(docs, spark.createDataFrame([(t,) for t in wanted], "text string"))
    got = {r["doc_id"]: r for r in cross_entropy.score_documents(docs, models).collect()}
    corpora = {"far": [t.split() for t in texts], "near": [t.split() for t in wanted]}
    pairs = {k: Counter(p for t in c for p in zip(["^", *t], t)) for k, c in corpora.items()}
    words = {k: Counter(w for t in c for w in t) for k, c in corpora.items()}
    size = len(set(words["far"]) | set(words["near"])) + 2
    assert len(models.numbers) == size - 2
    mass = {k: sum(c.values()) for k, c in words.items()}
    contexts = {k: Counter() for k in corpora}
    for k in corpora:
        for (v, _), n in pairs[k].items():
            contexts[k][v] += n
    for i in (0, 1, 150, 300, 301):
        text = texts[i].split()
        own = Counter(zip(["^", *text], text)), Counter(["^", *text][:-1]), Counter(text)
        mean = {}
        for k in corpora:
            scale, off = min(mass.values()) / mass[k], k == "far"
            bits = []
            for v, w in zip(["^", *text], text):
                one = ((words[k][w] - off * own[2][w]) * scale + 0.1) / ((mass[k] - off * len(text)) * scale + 0.1 * size)
                pair = (pairs[k][v, w] - off * own[0][v, w]) * scale
                bits.append(-np.log2((pair + 50 * one) / ((contexts[k][v] - off * own[1][v]) * scale + 50)))
            mean[k] = np.mean(bits)
        assert got[i]["n_tokens"] == len(text)
        assert got[i]["difference"] == pytest.approx(mean["near"] - mean["far"], abs=1e-9)
