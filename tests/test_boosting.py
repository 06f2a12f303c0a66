"""Boosted trees against a plain fit over dense values, in one task and in rounds."""

from __future__ import annotations

from itertools import combinations
from threading import Barrier

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from echoloom.operators import boosting, pairwise


def made_up(n=90, seed=4):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0.1, 1, (n, 6)), 1) * (rng.random((n, 6)) < 0.6)
    y = np.where(x[:, 0] + x[:, 1] > 0.8, 2, np.where(x[:, 2] > 0.3, 1, 0))
    return x, np.where(rng.random(n) < 0.1, rng.integers(0, 3, n), y)


def plain_fit(x, y, kind, rounds, rate, depth):
    """Chances of the rows, by trying every cut of every feature at every node."""
    k = 3
    start = np.log(np.bincount(y, minlength=k) / len(y)) if kind == "gradient" else np.zeros(k)
    f = np.tile(start, (len(y), 1))
    for _ in range(rounds):
        p = np.exp(f) / np.exp(f).sum(1, keepdims=True)
        r = np.eye(k)[y] - p
        step = np.zeros_like(f)
        for c in range(k):
            if kind == "gradient":
                g, h = r[:, c], np.abs(r[:, c]) * (1 - np.abs(r[:, c]))
            else:
                g, h = -r[:, c], 2 * p[:, c] * (1 - p[:, c])

            def worth(m):
                return g[m].sum() ** 2 / max(m.sum(), 1) if kind == "gradient" else g[m].sum() ** 2 / (h[m].sum() + 1) / 2

            def split(m, level):
                best = (1e-9, None)
                for j in range(x.shape[1]) if level < depth else ():
                    present = x[:, j] != 0
                    for cut in [0.0, *np.unique(x[m & present, j])]:
                        for absent_left in (True, False) if kind == "newton" else (True,):
                            left = m & np.where(present, x[:, j] <= cut, absent_left)
                            right = m & ~left
                            if not left.any() or not right.any():
                                continue
                            if kind == "newton" and min(h[left].sum(), h[right].sum()) < 1:
                                continue
                            gain = round(worth(left) + worth(right) - worth(m), 9)
                            if gain > best[0]:
                                best = (gain, (left, right))
                if best[1]:
                    for part in best[1]:
                        split(part, level + 1)
                elif kind == "gradient":
                    step[m, c] = rate * (k - 1) / k * (g[m].sum() / h[m].sum() if h[m].sum() > 1e-150 else 0)
                else:
                    step[m, c] = -rate * g[m].sum() / (h[m].sum() + 1)

            split(np.ones(len(y), bool), 0)
        f += step
    return np.exp(f) / np.exp(f).sum(1, keepdims=True)


def frame(spark, x, y):
    rows = [(i, int(label), Vectors.sparse(6, [(j, float(v)) for j, v in enumerate(row) if v])) for i, (row, label) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "label", "features"]).repartition(4)


@pytest.mark.parametrize("kind, rate, depth", [("gradient", 0.3, 3), ("newton", 0.3, 4)])
def test_fits_equal_a_plain_one(spark, kind, rate, depth):
    x, y = made_up()
    df = frame(spark, x, y)
    settings = {"kind": kind, "rounds": 4, "rate": rate, "depth": depth}
    local = boosting.BoostedTrees(**settings).fit(df)
    found = np.array([r["probability"] for r in local.transform(df).orderBy("id").collect()])
    assert found == pytest.approx(plain_fit(x, y, kind, 4, rate, depth), abs=1e-6)


def test_rounds_on_partitions_equal_one_task(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REWRITE_ROUNDS", 2)
    df = frame(spark, *made_up(60, 7))
    for kind in ("gradient", "newton"):
        settings = {"kind": kind, "rounds": 3, "rate": 0.5, "depth": 2}
        one, many = (boosting.BoostedTrees(localEntries=n, **settings).fit(df).trees() for n in (10**6, 0))
        for a, b in zip(one, many, strict=True):
            for s, t in zip(a, b, strict=True):
                assert [e[:5] if len(e) > 1 else pytest.approx(e) for e in s] == t


def test_held_out_rows_and_a_stored_model(spark, tmp_path):
    x, y = made_up(400, 9)
    train, test = frame(spark, x[:250], y[:250]), frame(spark, x[250:], y[250:])
    model = boosting.BoostedTrees(rounds=30, rate=0.1, depth=3).fit(train)
    scored = model.transform(test)
    assert scored.filter("prediction = label").count() / 150 > 0.8
    chance = F.get("probability", F.col("label").cast("int"))
    shares = np.bincount(y[:250]) / 250
    assert scored.agg(F.avg(-F.log(chance))).first()[0] < 0.5 * -np.log(shares[y[250:]]).mean()
    path = str(tmp_path / "model")
    PipelineModel([model]).write().save(path)
    again = PipelineModel.load(path).transform(test)
    assert again.orderBy("id").collect() == scored.orderBy("id").collect()


def test_odd_rows(spark):
    rows = [(0, 1, Vectors.sparse(6, [])), (1, 1, Vectors.dense([0, 0, 1.0, 0, 0, 0])), (2, 1, Vectors.sparse(6, [(5, 2.0)]))]
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    for kind in ("gradient", "newton"):
        model = boosting.BoostedTrees(kind=kind, rounds=2).fit(df)
        assert [r["prediction"] for r in model.transform(df).collect()] == [1.0] * 3
        assert model.transform(df.filter("false")).count() == 0


def test_pairwise_votes_equal_a_plain_count(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(90, 3))
    y = rng.integers(0, 3, 90)
    x[np.arange(90), y] += 1.5
    rows = [(i, float(c), Vectors.dense(v)) for i, (c, v) in enumerate(zip(y, x))]
    df = spark.createDataFrame(rows, ["id", "label", "features"]).coalesce(1).cache()
    model = pairwise.OneVsOneSVM(C=1.0, maxIter=12).fit(df)
    found = model.transform(df)
    assert found.columns == ["id", "label", "features", "prediction"]
    machines = [m for m in model.stages if hasattr(m, "coefficients")]
    assert len(machines) == 3
    for row in found.collect():
        votes = np.zeros(3)
        for (a, b), m in zip(combinations(range(3), 2), machines):
            side = m.coefficients.toArray() @ row["features"].toArray() + m.intercept > 0
            votes[b if side else a] += 1
        assert row["prediction"] == votes.argmax()
    assert found.filter("prediction = label").count() > 55
    one = pairwise.OneVsOneSVM(maxIter=2).fit(df.filter("label = 2")).transform(df)
    assert {r["prediction"] for r in one.collect()} == {2.0}


def test_blocks_and_slices_grow_the_same_trees(spark, monkeypatch):
    # Blocks of a few values, fewer features than slices, and rows without any value.
    x, y = made_up(80, 9)
    x[::7] = 0.0
    df = frame(spark, x, y)
    settings = {"kind": "newton", "rounds": 3, "rate": 0.4, "depth": 3}
    one = boosting.BoostedTrees(**settings).fit(df).trees()
    monkeypatch.setattr(boosting, "BLOCK_ENTRIES", 20)
    stored, _, entries = boosting.binned_rows(df, "features", "label")
    blocks = boosting.blocks_of(stored, entries, [0.0] * 3).collect()
    assert sum(len(r["features"]) // 4 for r in blocks) == entries and max(len(r["features"]) for r in blocks) <= 4 * 26
    assert sum(len(r["sizes"]) // 4 for r in blocks) == 80
    many = boosting.BoostedTrees(localEntries=0, **settings).fit(df).trees()
    for a, b in zip((t for r in one for t in r), (t for r in many for t in r), strict=True):
        assert [n[:5] if len(n) > 1 else None for n in a] == [n[:5] if len(n) > 1 else None for n in b]
        assert [n[0] for n in a] == pytest.approx([n[0] for n in b])


def test_machines_take_their_steps_side_by_side(spark, monkeypatch):
    x, y = made_up(60, 3)
    df = frame(spark, x, y)
    together, fit = Barrier(3, timeout=60), pairwise.LinearSVC.fit

    def waiting(self, *args):
        together.wait()  # never passed by machines that are fitted one after the other
        return fit(self, *args)

    monkeypatch.setattr(pairwise.LinearSVC, "fit", waiting)
    model = pairwise.OneVsOneSVM(C=1.0, maxIter=5).fit(df)
    assert model.transform(df).select("prediction").count() == 60
    names = [stage.getPredictionCol() for stage in model.stages[:3]]
    assert names == ["_vote0", "_vote1", "_vote2"]


def test_chunks_of_features_find_the_cuts_of_all(monkeypatch):
    rng = np.random.default_rng(8)
    present = rng.random((50, 9)) < 0.4
    row, feature = np.nonzero(present)
    bins = rng.integers(1, 5, len(row))
    g, h = rng.normal(size=50), rng.uniform(0.5, 1, 50)
    node = rng.integers(-1, 3, 50)  # -1: closed
    for kind in ("gradient", "newton"):
        rules = boosting.Rules(kind, 3, 0.1, 3)
        state = boosting.open_state(node, [0, 1, 2], g, h)
        assert state[0] == pytest.approx(np.array([[g[node == i].sum(), h[node == i].sum(), (node == i).sum()] for i in range(3)]))
        whole = boosting.Columns(feature, bins, row).best_cuts(rules, [state, state])
        assert whole[0] == whole[1] and all(whole[0])
        monkeypatch.setattr(boosting, "CHUNK_ENTRIES", 7)
        assert len(list(boosting.Columns(feature, bins, row).chunks())) > 3
        assert boosting.Columns(feature, bins, row).best_cuts(rules, [state]) == whole[:1]
        monkeypatch.undo()
        assert boosting.Columns(feature[:0], bins[:0], row[:0]).best_cuts(rules, [state]) == [[None] * 3]
