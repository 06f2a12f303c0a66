"""Neighbours, components, clustering, keywords and the whole analysis."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from echoloom.operators import density, neighbours, topics, train
from echoloom.plans.analyze import analyze_apps, discover_topics

VECTORS = "review_id bigint, app_id string, embedding array<double>, truth int"


def brute_force(rows, k):
    """(app, src) -> [(dst, distance)] by comparing everything within an app."""
    result = {}
    for app in {r[1] for r in rows}:
        part = sorted((r for r in rows if r[1] == app), key=lambda r: r[0])
        points = np.array([r[2] for r in part])
        ids = np.array([r[0] for r in part])
        for i, row in enumerate(part):
            far = np.round(np.sqrt(((points - points[i]) ** 2).sum(axis=1)), 9)
            order = [j for j in np.lexsort((ids, far)) if j != i][:k]
            result[(app, row[0])] = [(int(ids[j]), float(far[j])) for j in order]
    return result


@pytest.fixture(scope="module")
def points(spark):
    """Blobs, a far outlier, a small app, and one vector that a third of the rows share."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(240):
        centre = np.array([10.0 * (i % 4), 5.0 * (i % 2), 0.0])
        rows.append((i, "big", [float(x) for x in centre + rng.normal(size=3)], i % 4))
    rows += [(300 + i, "big", [1.5, 1.5, 1.5], 9) for i in range(120)]
    rows.append((500, "big", [500.0, 0.0, 0.0], -1))
    rows += [(600 + i, "small", [float(i), 0.0, 0.0], 0) for i in range(3)]
    return rows


@pytest.mark.parametrize("cell_rows, block_rows, fanout", [(8192, 8192, 64), (20, 15, 64), (60, 1000, 64), (9, 25, 4)])
def test_knn_equals_brute_force(spark, points, cell_rows, block_rows, fanout):
    df = spark.createDataFrame(points, VECTORS)
    found = {}
    options = {"cell_rows": cell_rows, "block_rows": block_rows, "fanout": fanout}
    graph = neighbours.knn_graph(df, 4, by="app_id", **options)
    for r in graph.orderBy("app_id", "src", "rank").collect():
        found.setdefault((r["app_id"], r["src"]), []).append((r["dst"], r["distance"]))
    assert found == brute_force(points, 4)


def test_pivot_tree_of_three_levels(spark, points):
    df = neighbours.as_points(spark.createDataFrame(points, VECTORS), "app_id", "review_id", "embedding")
    vectors = neighbours.distinct_vectors(df)
    tree = neighbours.pivot_tree(vectors, cell_rows=9, fanout=4)
    assert len(tree.levels) >= 3
    cells = tree.cells.withColumns({f"at{d}": tree.ancestor(d) for d in range(4)}).collect()
    assert len(cells) == vectors.count()
    assert {r["cell"] for r in cells if r["grp"] == "small"} == {1}
    for depth, level in enumerate(tree.levels[:3]):
        for row in level.collect():
            below = [r for r in cells if r["grp"] == row["grp"] and r[f"at{depth}"] == row["cell"]]
            assert len(below) > 9
            for child in row["children"]:
                inside = [r for r in below if r[f"at{depth + 1}"] == child["cell"]]
                far = [np.linalg.norm(np.array(r["vec"]) - child["vec"]) for r in inside]
                assert max(far) == pytest.approx(child["radius"])


def test_nearby_finds_most_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "a", [float(x) for x in rng.normal(size=4)], 0) for i in range(600)]
    df = neighbours.as_points(spark.createDataFrame(rows, VECTORS), None, "review_id", "embedding")
    exact = {(r["src"], r["dst"]) for r in neighbours.nearest(df, 5).collect()}
    found = {(r["src"], r["dst"]) for r in neighbours.nearby(df, 5, 4, cell_rows=80, fanout=8).collect()}
    assert len(found) == len(exact) == 3000 and len(found & exact) / len(exact) > 0.9


def test_components(spark):
    rng = np.random.default_rng(3)
    nodes = [(g, n) for g in ("x", "y") for n in range(200)]
    edges = [("x", n, n + 1) for n in range(0, 99)]  # a path
    edges += [("x", 100, n) for n in range(101, 160)]  # a hub
    edges += [("y", int(a), int(b)) for a, b in rng.integers(0, 200, size=(150, 2)) if a != b]
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for g, a, b in edges:
        low, high = sorted((find((g, a)), find((g, b))))
        parent[high] = low
    both = edges + [(g, b, a) for g, a, b in edges]
    got = density.connected_components(
        spark.createDataFrame(nodes, "grp string, node bigint"),
        spark.createDataFrame(both, "grp string, a bigint, b bigint"),
        ["grp"],
    )
    assert {(r["grp"], r["node"]): r["comp"] for r in got.collect()} == {n: find(n)[1] for n in nodes}


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    rows = []
    for c in range(4):
        centre = rng.normal(size=8) * 12
        rows += [(len(rows) + i, "a", [float(x) for x in centre + rng.normal(size=8)], c) for i in range(90)]
    rows += [(400 + i, "a", [float(x) for x in rng.uniform(-30, 30, size=8)], -1) for i in range(25)]
    for c in range(2):
        rows += [(500 + 20 * c + i, "b", [float(x) for x in 9.0 * c + rng.normal(size=8)], c) for i in range(20)]
    rows += [(600 + i, "c", [1.0 * i] * 8, -1) for i in range(2)]
    return spark.createDataFrame(rows, VECTORS).cache()


def partition_of(df):
    groups = {}
    for r in df.collect():
        groups.setdefault((r["app_id"], r["cluster"]), set()).add(r["review_id"])
    return groups


def test_density_finds_planted_clusters(planted):
    found = density.density_cluster(planted, by="app_id", cell_rows=60, block_rows=64)
    assert found.count() == planted.count()
    sizes = {}
    for r in found.groupBy("app_id", "cluster", "truth").count().collect():
        sizes.setdefault((r["app_id"], r["cluster"]), {})[r["truth"]] = r["count"]
    clusters = {k: v for k, v in sizes.items() if k[1] >= 0}
    assert sorted(k for k in clusters) == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 0), ("b", 1)]
    for (app, _), truth in clusters.items():
        assert max(truth.values()) / sum(truth.values()) > 0.95
        assert sum(truth.values()) >= (50 if app == "a" else 5)
    assert sizes[("c", -1)] == {-1: 2}


def test_density_does_not_depend_on_partitions(planted):
    one = planted.filter("app_id = 'b'")
    first = partition_of(density.density_cluster(one.coalesce(1), by="app_id"))
    assert first == partition_of(density.density_cluster(one.repartition(11), by="app_id"))


def test_copies_form_one_cluster(spark):
    rows = [(i, "a", [0.0, 0.0], 0) for i in range(40)] + [(100 + i, "a", [5.0 + 0.01 * i, 5.0], 1) for i in range(40)]
    found = density.density_cluster(spark.createDataFrame(rows, VECTORS), by="app_id")
    per_truth = {r["truth"]: r["c"] for r in found.groupBy("truth").agg(F.collect_set("cluster").alias("c")).collect()}
    assert len(per_truth[0]) == 1 and per_truth[0] != per_truth[1] and -1 not in per_truth[0]


@pytest.mark.parametrize("n, size, samples", [(3, 2, 1), (8, 2, 1), (40, 5, 2), (99, 5, 2), (100, 50, 25)])
def test_density_params(spark, n, size, samples):
    a, b = density.density_params(F.lit(n))
    assert tuple(spark.range(1).select(a, b).first()) == (size, samples)


def test_fixed_cut(spark):
    rows = [(i, "a", [float(x)], 0) for i, x in enumerate([0, 1, 2, 10, 11, 30])]
    got = density.components_within(spark.createDataFrame(rows, VECTORS), 1.5, 3)
    assert {r["review_id"]: r["comp"] for r in got.collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5}


def test_embedding_is_unit_and_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "battery drain"), (2, "battery battery drain drain"), (3, ""), (4, None), (5, "great ui")],
        "review_id bigint, content string",
    )
    embedder = topics.fit_embedder(df)
    rows = {r["review_id"]: np.array(r["embedding"]) for r in topics.embed_text(df.repartition(3), embedder).collect()}
    assert all(len(v) == topics.DIMENSIONS for v in rows.values())
    assert np.linalg.norm(rows[1]) == pytest.approx(1) and rows[1] == pytest.approx(rows[2])
    assert not rows[3].any() and not rows[4].any()
    assert abs(rows[1] @ rows[5]) < 0.8


def test_embedding_keeps_rare_and_unseen_words(spark):
    common = [(i, f"common words {i % 7}") for i in range(50)]
    df = spark.createDataFrame([*common, (90, "quixotic")], "review_id bigint, content string")
    embedder = topics.fit_embedder(df)
    later = spark.createDataFrame([(90, "quixotic", 1), (91, "zyzzyva", 2)], "review_id bigint, content string, term int")
    rows = {r["review_id"]: np.array(r["embedding"]) for r in topics.embed_text(later, embedder).collect()}
    assert all(np.linalg.norm(v) == pytest.approx(1) for v in rows.values())
    assert np.count_nonzero(rows[90]) == 1


def test_every_term_competes_for_a_keyword(spark):
    # The 30 best terms share a word, so the diverse pick comes after them.
    alike = [("a", 0, f"battery drain{i:02d}", 100.0 - i) for i in range(30)]
    df = spark.createDataFrame([*alike, ("a", 0, "design", 65.0)], "app_id string, cluster int, term string, score double")
    assert topics.diverse_keywords(df, ["app_id"], 2).first()["keywords"] == ["battery drain00", "design"]


def test_reducer(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.r_[rng.normal(size=2) * 5, rng.normal(size=6) * 0.01]]) for i in range(80)]
    df = spark.createDataFrame(rows, "review_id bigint, embedding array<double>")
    reduced = np.array([r["reduced"] for r in topics.reduce_dims(df, topics.fit_reducer(df, 3)).collect()])
    assert reduced.shape == (80, 3)
    spread = reduced.var(axis=0)
    assert spread[0] >= spread[1] >= spread[2] and spread[:2].sum() > 0.95 * spread.sum()
    flat = topics.project_2d(df)
    assert {"x", "y"} <= set(flat.columns) and flat.count() == 80


@pytest.fixture(scope="module")
def clustered(spark):
    texts = [(0, "the battery drain is bad battery"), (0, "battery drain again and drain"), (1, "love the design design"), (1, "nice design colours"), (-1, "battery design")]
    return spark.createDataFrame(
        [(i, "a", t, c) for i, (c, t) in enumerate(texts)], "review_id bigint, app_id string, content string, cluster int"
    )


def test_keywords(clustered):
    found = {r["cluster"]: r["topic"] for r in topics.cluster_topics(clustered, ["app_id"]).collect()}
    assert found[-1] == "Uncategorized"
    first = found[0].split(" | ")
    assert len(first) == 3 and len(set(first)) == 3 and first[0] in ("battery", "drain", "battery drain")
    assert not any(w in topic.split() for topic in found.values() for w in ("the", "is", "and"))


def test_sample_text_is_ordered_and_limited(clustered):
    got = {r["cluster"]: r["sample"] for r in topics.cluster_sample_text(clustered, n=1).collect()}
    assert got == {0: "the battery drain is bad battery", 1: "love the design design"}


def test_names(spark):
    df = spark.createDataFrame([("battery drain | app",), ("Uncategorized",), ("",), (None,)], "topic string")
    got = {r["topic"]: r["clean_topic"] for r in topics.name_topics(df).collect()}
    assert got == {"battery drain | app": "Battery Drain", "": None}


def test_analysis_end_to_end(spark):
    themes = {
        "Negative": ["crash on startup screen freeze", "battery drain overnight heat"],
        "Positive": ["love clean design colours", "fast sync works offline"],
    }
    rows = []
    for i in range(160):
        label = ("Negative", "Positive")[i % 2]
        rows.append((i, f"app{i // 80}", f"{themes[label][(i // 2) % 2]} v{i % 5}x", label))
    reviews = spark.createDataFrame(rows, "review_id bigint, app_id string, content string, sentiment string")
    found = discover_topics(reviews)
    assert found.count() == 160 and found.filter("clean_topic is null").count() == 0
    assert found.filter("cluster >= 0").select("app_id", "cluster").distinct().count() >= 4
    model = train.train_one(reviews, "LogisticRegression", C=10.0, max_iter=30)
    fresh = spark.sql("SELECT 'app0' AS app_id, TIMESTAMP '2024-01-01 00:00:00' AS computed_at")
    now = F.lit("2024-01-01 00:10:00").cast("timestamp")
    result = analyze_apps(reviews, model, fresh, now).collect()
    assert [r["app_id"] for r in result] == ["app1"]
    assert result[0]["sentiment_distribution"].asDict() == {"Positive": 40, "Neutral": 0, "Negative": 40}
    assert result[0]["topics"] and result[0]["top_negative_topics"]


@pytest.mark.parametrize("local_edges", [50_000, 20])
def test_spanning_tree_keeps_all_pairs_components_at_every_cut(spark, local_edges):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(size=(30, 2)) + 40 * i for i in range(4)])
    core = rng.uniform(0, 0.5, len(points))
    far = np.round(np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)), 9)
    length = np.maximum(np.maximum(far, core[:, None]), core[None])
    order = np.argsort(far, axis=1)[:, 1:4]
    edges = [("g", i, int(j), float(length[i, j])) for i, row in enumerate(order) for j in row]
    known = [("g", i, float(core[i]), float(max(core[i], far[i, row[-1]]))) for i, row in enumerate(order)]
    vectors = [("g", i, [float(x) for x in p]) for i, p in enumerate(points)] + [("alone", 999, [0.0, 0.0])]
    tree = neighbours.pivot_tree(spark.createDataFrame(vectors, "grp string, id bigint, vec array<double>"), 12, 15, 4)
    found = density.spanning_tree(
        spark.createDataFrame(edges, "grp string, u bigint, v bigint, length double"),
        spark.createDataFrame([*known, ("alone", 999, 0.0, float("inf"))], "grp string, id bigint, core double, limit double"),
        tree, local_edges, 15,
    )
    got = [(r["u"], r["v"], r["length"]) for r in found.collect()]
    pairs = [(i, j, float(length[i, j])) for i in range(len(points)) for j in range(i)]

    def components(rows, cut):
        parent = list(range(len(points)))

        def find(n):
            while parent[n] != n:
                n = parent[n]
            return n

        for a, b, w in rows:
            if w <= cut:
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        return [find(n) for n in parent]

    assert len(got) == len(points) - 1 and all(w == length[u, v] for u, v, w in got)
    assert all(components(got, cut) == components(pairs, cut) for cut in [*np.linspace(0.1, 3, 20), 30, 60])
