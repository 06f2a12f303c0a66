"""What runs leave in the shared folder."""

from __future__ import annotations

import os

import numpy as np

from echoloom.operators import density, layout, topics
from echoloom.plans.analyze import discover_topics
from echoloom.workspace import materialize, release, released, shared_dir

ROW = "review_id bigint, app_id string, content string, embedding array<double>"


def stored(spark):
    folder = f"{shared_dir(spark)}/echoloom"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def labels(names):
    return sorted(name.rpartition("-")[0] for name in names)


def test_a_block_keeps_what_it_is_told_to(spark):
    before = stored(spark)
    with released(spark):
        with released(spark):
            gone = materialize(spark.range(3), "gone")
            inner = materialize(gone, "inner", kept=True)
        assert labels(stored(spark) - before) == ["inner"]
        outer = materialize(inner, "outer", kept=True)
    assert labels(stored(spark) - before) == ["outer"] and outer.count() == 3
    release(outer)
    assert stored(spark) == before


def test_clusters_and_layouts_leave_their_result_only(spark):
    rng = np.random.default_rng(5)
    points = np.repeat(np.eye(4), 40, axis=0) + rng.normal(size=(160, 4)) * 0.1
    rows = [(i, "ab"[i % 2], f"word{i % 4} other", [float(x) for x in p]) for i, p in enumerate(points)]
    df = materialize(spark.createDataFrame(rows, ROW), "given")
    for run, left in (
        (lambda: density.density_cluster(df, "app_id", cell_rows=30, block_rows=20), ["clusters"]),
        (lambda: layout.layout(df, 2, "app_id", rounds=2, epochs=2, cell_rows=30, block_rows=20), ["layout"]),
    ):
        before = stored(spark)
        found = run()
        assert labels(stored(spark) - before) == left
        assert found.count() == 160


def test_topics_leave_no_vectors(spark):
    rows = [(i, "a", f"word{i % 3} other{i % 5} more", None) for i in range(24)]
    reviews = spark.createDataFrame(rows, ROW).drop("embedding")
    before = stored(spark)
    found = discover_topics(reviews)
    left = set(labels(stored(spark) - before))
    assert found.count() == 24
    assert not left & {"words", "embedded", "units", "vectors", "packed", "near", "neighbours"}


def test_blocks_name_each_word_once(spark, monkeypatch):
    texts = [(1, "red red blue"), (2, "blue sky"), (3, None), (4, ""), (1, "sky sky sky red")]
    df = spark.createDataFrame(texts, "review_id bigint, content string").coalesce(1)
    (block,) = topics.word_blocks(df).collect()
    terms = dict(zip(block["terms"], block["documents"], strict=True))
    assert terms == {"red": 2, "blue": 2, "sky": 2} and block["keys"] == [1, 2, 3, 4, 1]
    sizes, at, uses = (topics._of_planes(block[c]) for c in ("sizes", "at", "uses"))
    row = np.repeat(np.arange(5), sizes)
    named = [(r, block["terms"][a], n) for r, a, n in zip(row, at, uses, strict=True)]
    assert sorted(named) == [(0, "blue", 1), (0, "red", 2), (1, "blue", 1), (1, "sky", 1), (4, "red", 1), (4, "sky", 3)]
    embedder = topics.fit_embedder(df)
    vectors = topics.embed_text(df, embedder)
    whole = {r["review_id"]: np.array(r["embedding"]) for r in vectors.collect()}
    assert abs(np.linalg.norm(whole[1]) - 1) < 1e-12
    assert not whole[3].any() and not whole[4].any()
    # Blocks of one text each, and an embedder of other rows, give the same.
    monkeypatch.setattr(topics, "BLOCK_WORDS", 1)
    again = {r["review_id"]: np.array(r["embedding"]) for r in topics.embed_text(df.repartition(2), embedder).collect()}
    assert all(np.allclose(again[k], whole[k]) for k in whole)
