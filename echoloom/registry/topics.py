"""Queries for embeddings, neighbours, clustering and topics."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from echoloom.constants import NOISE, UNCATEGORIZED
from echoloom.operators import density, layout, neighbours, split, topics, train
from echoloom.plans.analyze import analyze_apps as analyze
from echoloom.plans.analyze import discover_topics
from echoloom.registry.core import CLUSTERED, REVIEWS, query, words
from echoloom.sources import fixtures
from echoloom.workspace import materialize, release, released

VOCABULARY = f"""tokens AS (SELECT review_id, unnest({words('content')}) AS term FROM reviews),
    vocabulary AS (SELECT term, count(DISTINCT review_id) AS documents FROM tokens GROUP BY term),
    places AS (SELECT term, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 256 AS dim,
      CASE WHEN substr(md5(term), 9, 1) < '8' THEN 1 ELSE -1 END
        * (ln((1.0 + (SELECT count(*) FROM reviews)) / (1.0 + documents)) + 1) AS w FROM vocabulary),
    cells AS (SELECT review_id, dim, sum(w) AS v FROM tokens JOIN places ON tokens.term = places.term GROUP BY review_id, dim)"""


def _embedded(spark, sf_dir):
    reviews = fixtures.reviews_with_sentiment(spark, sf_dir)
    return topics.embed_text(reviews, topics.fit_embedder(reviews))


@query(
    "embed_text",
    f"""WITH {REVIEWS}, {VOCABULARY}
    SELECT review_id, CAST(dim AS INT) AS dim, round(v / sqrt(sum(v * v) OVER (PARTITION BY review_id)), 6) AS value
    FROM cells QUALIFY abs(v / sqrt(sum(v * v) OVER (PARTITION BY review_id))) >= 0.00001""",
)
def embed_text(spark, sf_dir):
    return (
        _embedded(spark, sf_dir)
        .select("review_id", F.posexplode("embedding").alias("dim", "value"))
        .filter(F.abs("value") >= 0.00001)
        .withColumn("value", F.round("value", 6))
    )


@query("reduce_dims")
def reduce_dims(spark, sf_dir):
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    return topics.reduce_dims(vectors, topics.fit_reducer(vectors)).select(
        "vec_id", F.size("reduced").alias("dimensions"), "reduced"
    )


@query(
    "reduce_dims_facts",
    """SELECT count(*) AS n, CAST(10 AS INT) AS fewest, CAST(10 AS INT) AS most, TRUE AS descending, TRUE AS uncorrelated
    FROM embeddings""",
)
def reduce_dims_facts(spark, sf_dir):
    """Every vector has ten axes of descending variance that do not correlate."""
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    reduced = topics.reduce_dims(vectors, topics.fit_reducer(vectors))
    axes = [F.get("reduced", F.lit(i)) for i in range(topics.REDUCED)]
    spread = [F.var_pop(axis) for axis in axes]
    falls = [a >= b for a, b in zip(spread, spread[1:])]
    ties = [F.abs(F.corr(a, b)) for i, a in enumerate(axes) for b in axes[:i]]
    return reduced.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size("reduced")).alias("fewest"),
        F.max(F.size("reduced")).alias("most"),
        reduce(and_, falls).alias("descending"),
        (F.greatest(*ties) < 0.001).alias("uncorrelated"),
    )


@query("reduce_text")
def reduce_text(spark, sf_dir):
    embedded = materialize(_embedded(spark, sf_dir).select("review_id", "embedding"), "embedded")
    return topics.reduce_dims(embedded, topics.fit_reducer(embedded)).select("review_id", "reduced")


@query("reduce_layout")
def reduce_layout(spark, sf_dir):
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    return layout.layout(vectors, topics.REDUCED, key="vec_id").select(
        "vec_id", F.size("reduced").alias("dimensions"), "reduced"
    )


@query(
    "reduce_layout_facts",
    """SELECT count(*) AS n, CAST(10 AS INT) AS fewest, CAST(10 AS INT) AS most, TRUE AS keeps_more FROM embeddings""",
)
def reduce_layout_facts(spark, sf_dir):
    """The layout keeps more of each vector's nearest by cosine than the main axes do."""
    vectors = fixtures.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    placed = materialize(layout.layout(vectors, topics.REDUCED, key="vec_id"), "placed")
    axes = topics.reduce_dims(vectors, topics.fit_reducer(vectors), out="axes").select("vec_id", "axes")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    units = vectors.withColumn("unit", F.transform("embedding", lambda x: x / length))

    def near(df, column):
        found = neighbours.knn_graph(df, layout.NEIGHBOURS, key="vec_id", vector=column)
        return materialize(found.select("src", "dst"), "near")

    true = near(units, "unit")
    kept, mixed = (near(df, c).join(true, ["src", "dst"]).agg(F.count(F.lit(1))).scalar() for df, c in ((placed, "reduced"), (axes, "axes")))
    return placed.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size("reduced")).alias("fewest"), F.max(F.size("reduced")).alias("most")
    ).select("*", (kept > mixed).alias("keeps_more"))


@query("project_2d")
def project_2d(spark, sf_dir):
    return topics.project_2d(fixtures.table(spark, sf_dir, "embeddings")).select(
        "vec_id", "label", "x", "y"
    )


@query(
    "density_params",
    """WITH apps AS (SELECT o_custkey AS app_id, count(*) AS n FROM orders GROUP BY o_custkey
      UNION ALL SELECT -1, count(*) FROM orders),
    sized AS (SELECT *, CASE WHEN n < 100 THEN greatest(2, least(5, n // 4)) ELSE 50 END AS size FROM apps)
    SELECT app_id, n, CAST(size AS INT) AS min_cluster_size, CAST(greatest(1, size // 2) AS INT) AS min_samples FROM sized""",
)
def density_params(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("app_id"))
    apps = orders.groupBy("app_id").agg(F.count(F.lit(1)).alias("n")).unionByName(
        orders.agg(F.lit(-1).cast("bigint").alias("app_id"), F.count(F.lit(1)).alias("n"))
    )
    size, samples = density.density_params(F.col("n"))
    return apps.select("app_id", "n", size.alias("min_cluster_size"), samples.alias("min_samples"))


@query(
    "knn_graph",
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    pairs AS (SELECT a.vec_id AS src, b.vec_id AS dst, round(list_distance(a.e, b.e), 9) AS d
      FROM v a JOIN v b ON a.vec_id <> b.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS r FROM pairs)
    SELECT src, dst, round(d, 6) AS distance, CAST(r AS INT) AS rank FROM ranked WHERE r <= 10""",
)
def knn_graph(spark, sf_dir):
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    return neighbours.knn_graph(vectors, 10, key="vec_id").withColumn(
        "distance", F.round("distance", 6)
    )


@query(
    "knn_graph_by_label",
    """WITH v AS (SELECT vec_id, CAST(label AS VARCHAR) AS label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    pairs AS (SELECT a.label, a.vec_id AS src, b.vec_id AS dst, round(list_distance(a.e, b.e), 9) AS d
      FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS r FROM pairs)
    SELECT label, src, dst, round(d, 6) AS distance, CAST(r AS INT) AS rank FROM ranked WHERE r <= 5""",
)
def knn_graph_by_label(spark, sf_dir):
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    return neighbours.knn_graph(vectors, 5, by="label", key="vec_id").withColumn(
        "distance", F.round("distance", 6)
    )


@query(
    "components_within",
    """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    pairs AS (SELECT a.vec_id AS src, b.vec_id AS dst, round(list_distance(a.e, b.e), 9) AS d
      FROM v a JOIN v b ON a.vec_id <> b.vec_id),
    near AS (SELECT src, dst FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS r FROM pairs)
      WHERE r <= 10 AND d <= 1.1),
    ways AS (SELECT src AS a, dst AS b FROM near UNION SELECT dst, src FROM near),
    reach AS (SELECT vec_id, vec_id AS node FROM v UNION SELECT reach.vec_id, ways.b FROM reach JOIN ways ON reach.node = ways.a)
    SELECT vec_id, min(node) AS comp FROM reach GROUP BY vec_id""",
)
def components_within(spark, sf_dir):
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    return density.components_within(vectors, 1.1, 10, key="vec_id")


def _clustered_texts(spark, sf_dir):
    with released(spark):
        with released(spark):
            embedded = materialize(_embedded(spark, sf_dir).select("review_id", "embedding"), "embedded", kept=True)
        reduced = topics.reduce_dims(embedded, topics.fit_reducer(embedded)).select("review_id", "reduced")
        reduced = materialize(reduced, "reduced", kept=True)
    return density.density_cluster(reduced, vector="reduced")


@query(
    "density_cluster_facts",
    """SELECT count(*) AS n, count(DISTINCT doc_id) AS reviews, CAST(0 AS BIGINT) AS too_small, TRUE AS numbered, TRUE AS several
    FROM documents""",
)
def density_cluster_facts(spark, sf_dir):
    """Clusters of the text vectors: each review once, none below the least size, at least two in enough rows, numbered 0, 1, ..."""
    found = materialize(_clustered_texts(spark, sf_dir), "found")
    size, _ = density.density_params(found.agg(F.count(F.lit(1))).scalar())
    clusters = found.filter(F.col("cluster") >= 0).groupBy("cluster").count()
    small = clusters.agg(F.count_if(F.col("count") < size)).scalar()
    numbered = F.coalesce(F.max("cluster") + 1, F.lit(0)) == F.count(F.lit(1))
    return found.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("review_id").alias("reviews")
    ).select(
        "n",
        "reviews",
        small.alias("too_small"),
        clusters.agg(numbered).scalar().alias("numbered"),
        # Ten times the least size of a cluster can be expected to hold two.
        ((clusters.agg(F.count(F.lit(1))).scalar() >= 2) | (F.col("n") < 10 * size)).alias("several"),
    )


@query("density_cluster_text")
def density_cluster_text(spark, sf_dir):
    return _clustered_texts(spark, sf_dir).select("review_id", "cluster")


@query("density_cluster")
def density_cluster(spark, sf_dir):
    vectors = fixtures.table(spark, sf_dir, "embeddings")
    return density.density_cluster(vectors, key="vec_id").select("vec_id", "label", "cluster")


@query(
    "cluster_sample_text",
    f"""WITH {CLUSTERED}, ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY review_id) AS r
      FROM clustered WHERE cluster <> -1)
    SELECT cluster, string_agg(content, ' ' ORDER BY review_id) AS sample FROM ranked WHERE r <= 200 GROUP BY cluster""",
)
def cluster_sample_text(spark, sf_dir):
    return topics.cluster_sample_text(fixtures.clustered(spark, sf_dir))


# Stop words of the checked query, in the four languages of the test texts.
STOP_WORDS = ("the", "of", "and", "is", "le", "la", "de", "et", "el", "los", "der", "die", "und")


def _candidates_sql(by: str) -> str:
    on = "t.app_id = {0}.app_id AND " if by else ""
    return f"""{CLUSTERED},
    kept AS (SELECT app_id, cluster, list_filter({words('content')}, lambda w: w NOT IN {STOP_WORDS}) AS t
      FROM clustered WHERE cluster <> -1),
    grams AS (SELECT app_id, cluster, unnest(list_concat(t, list_transform(range(1, greatest(len(t), 1)),
      lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM kept),
    terms AS (SELECT {by}cluster, term, count(*) AS uses FROM grams GROUP BY {by}cluster, term),
    overall AS (SELECT {by}term, sum(uses) AS everywhere FROM terms GROUP BY {by}term),
    sizes AS (SELECT {by}cluster, sum(uses) AS n FROM terms GROUP BY {by}cluster),
    means AS (SELECT {by}avg(n) AS mean FROM sizes {'GROUP BY app_id' if by else ''}),
    scored AS (SELECT {'t.app_id, ' if by else ''}t.cluster, t.term, t.uses, round(t.uses * ln(1.0 + mean / everywhere), 9) AS score
      FROM terms t JOIN overall ON {on.format('overall')}t.term = overall.term JOIN means ON {on.format('means')}TRUE),
    best AS (SELECT *, row_number() OVER (PARTITION BY {by}cluster ORDER BY score DESC, term) AS r FROM scored)"""


@query(
    "keyword_candidates",
    f"""WITH {_candidates_sql('')}
    SELECT cluster, term, uses, round(score, 6) AS score FROM scored""",
)
def keyword_candidates(spark, sf_dir):
    found = topics.keyword_candidates(fixtures.clustered(spark, sf_dir), stop_words=STOP_WORDS)
    return found.withColumn("score", F.round("score", 6))


def _mmr_sql(by: str) -> str:
    def step(n: int) -> str:
        previous = " UNION ALL ".join(f"SELECT * FROM pick{i}" for i in range(1, n))
        keys = f"{'b.app_id = p.app_id AND ' if by else ''}b.cluster = p.cluster"
        return f""",
    seen{n} AS ({previous}),
    gains{n} AS (SELECT b.*, round(0.5 * b.score / top - 0.5 * (SELECT max(
        len(list_intersect(b.words, p.words)) / sqrt(CAST(len(b.words) * len(p.words) AS DOUBLE)))
        FROM seen{n} p WHERE {keys}), 9) AS gain
      FROM lists b WHERE NOT EXISTS (SELECT 1 FROM seen{n} p WHERE {keys} AND b.r = p.r)),
    pick{n} AS (SELECT * EXCLUDE (gain) FROM gains{n}
      QUALIFY row_number() OVER (PARTITION BY {by}cluster ORDER BY gain DESC, r) = 1)"""

    picked = " UNION ALL ".join(f"SELECT *, {i} AS place FROM pick{i}" for i in range(1, 4))
    return f"""{_candidates_sql(by)},
    lists AS (SELECT *, list_distinct(string_split(term, ' ')) AS words,
      max(score) OVER (PARTITION BY {by}cluster) AS top FROM best),
    pick1 AS (SELECT * FROM lists WHERE r = 1){step(2)}{step(3)},
    topics AS (SELECT {by}cluster, string_agg(term, ' | ' ORDER BY place) AS topic FROM ({picked}) GROUP BY {by}cluster)"""


def _topics_sql(by: str) -> str:
    keys = "c.app_id = t.app_id AND " if by else ""
    out = "c.app_id, " if by else ""
    return f"""WITH {_mmr_sql(by)}, named AS (SELECT {out}c.cluster, CASE WHEN c.cluster = -1 THEN 'Uncategorized'
      ELSE coalesce(topic, '') END AS topic FROM (SELECT DISTINCT {by}cluster FROM clustered) c
      LEFT JOIN topics t ON {keys}c.cluster = t.cluster)"""


@query("cluster_keywords", f"{_topics_sql('')} SELECT cluster, topic FROM named")
def cluster_keywords(spark, sf_dir):
    return topics.cluster_topics(fixtures.clustered(spark, sf_dir), stop_words=STOP_WORDS)


@query("cluster_keywords_by_app", f"{_topics_sql('app_id, ')} SELECT app_id, cluster, topic FROM named")
def cluster_keywords_by_app(spark, sf_dir):
    return topics.cluster_topics(
        fixtures.clustered(spark, sf_dir), ["app_id"], stop_words=STOP_WORDS
    )


@query(
    "name_topics",
    f"""{_topics_sql('app_id, ')}, parts AS (SELECT DISTINCT topic, string_split(string_split(topic, ' | ')[1], ' ') AS w
      FROM named WHERE topic <> 'Uncategorized')
    SELECT topic, nullif(array_to_string(list_transform(w, lambda x: upper(x[1:1]) || lower(x[2:])), ' '), '') AS clean_topic
    FROM parts""",
)
def name_topics(spark, sf_dir):
    found = topics.cluster_topics(
        fixtures.clustered(spark, sf_dir), ["app_id"], stop_words=STOP_WORDS
    )
    return topics.name_topics(found)


@query("topic_discovery")
def topic_discovery(spark, sf_dir):
    reviews = fixtures.reviews_with_sentiment(spark, sf_dir).drop("lang", "score")
    return discover_topics(reviews).drop("content")


@query(
    "topic_discovery_facts",
    """SELECT count(*) AS n, count(DISTINCT doc_id) AS reviews, CAST(0 AS BIGINT) AS noise_named,
      CAST(0 AS BIGINT) AS several_topics FROM documents""",
)
def topic_discovery_facts(spark, sf_dir):
    """Each review once, exactly the noise uncategorised, and one topic for each cluster of an app."""
    found = materialize(topic_discovery(spark, sf_dir), "found")
    noise, unnamed = F.col("cluster") == NOISE, F.col("topic") == UNCATEGORIZED
    topics_of = found.groupBy("app_id", "cluster").agg(F.countDistinct("topic", "clean_topic").alias("topics"))
    return found.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("review_id").alias("reviews"),
        F.count_if(~noise.eqNullSafe(unnamed)).alias("noise_named"),
    ).withColumn("several_topics", topics_of.agg(F.count_if(F.col("topics") != 1)).scalar())


@query("analyze_apps")
def analyze_apps(spark, sf_dir):
    reviews = materialize(
        fixtures.reviews_with_sentiment(spark, sf_dir).drop("lang", "score"), "reviews"
    )
    training, _ = split.stratified_split(reviews)
    model = train.train_one(training, "LogisticRegression", C=1.0)
    # Scoring reads the texts once, so they need not be kept for it.
    release(reviews)
    return analyze(fixtures.reviews_with_sentiment(spark, sf_dir).drop("lang", "score"), model)
