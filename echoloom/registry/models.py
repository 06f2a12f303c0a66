"""Queries for splitting, features, training and evaluation."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.constants import LABELS, LAYERS, ML, ML_MODELS, NEGATIVE, NEUTRAL, POSITIVE, Warehouse
from echoloom.functions.text import clean_text
from echoloom.operators import evaluate, features, runs, split, train
from echoloom.plans import ml
from echoloom.registry.core import LABELLED, REVIEWS, query, words
from echoloom.sources import fixtures, writers
from echoloom.workspace import materialize, scratch_path

def _split_stored(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, split once and stored."""
    marked = materialize(split.mark_split(reviews), "split")
    return marked.filter(~F.col("is_test")), marked.filter("is_test")


def _split_gold(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return _split_stored(_gold(spark, sf_dir))


def _split_reviews(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return _split_stored(fixtures.reviews_with_sentiment(spark, sf_dir))


def _gold(spark, sf_dir) -> DataFrame:
    return fixtures.reviews_with_sentiment(spark, sf_dir).select(
        "review_id", "app_id", clean_text(F.col("content")).alias("content"), "sentiment"
    )


# --- split and features ------------------------------------------------------

SPLIT = """known AS (SELECT review_id, app_id, content, sentiment FROM labelled WHERE sentiment <> 'Unknown'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY md5('42:' || review_id), review_id) AS r,
      count(*) OVER (PARTITION BY sentiment) AS n FROM known)"""


@query(
    "stratified_split",
    f"""WITH {LABELLED}, {SPLIT}
    SELECT review_id, sentiment, r <= floor(0.2 * n + 0.5) AS is_test FROM ranked""",
)
def stratified_split(spark, sf_dir):
    return split.mark_split(fixtures.reviews_with_sentiment(spark, sf_dir)).select(
        "review_id", "sentiment", "is_test"
    )


@query(
    "stratified_split_orders",
    """WITH scored AS (SELECT o_orderkey AS review_id, CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS INT) <= 2 THEN 'Negative'
      WHEN CAST(substr(o_orderpriority, 1, 1) AS INT) = 3 THEN 'Neutral' ELSE 'Positive' END AS sentiment FROM orders),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY md5('42:' || review_id), review_id) AS r,
      count(*) OVER (PARTITION BY sentiment) AS n FROM scored)
    SELECT review_id, sentiment, r <= floor(0.1 * n + 0.5) AS is_test FROM ranked""",
)
def stratified_split_orders(spark, sf_dir):
    from echoloom.functions.labels import sentiment_from_score

    orders = fixtures.scored_orders(spark, sf_dir).select(
        "review_id", sentiment_from_score(F.col("score")).alias("sentiment")
    )
    return split.mark_split(orders, test_share=0.1)


@query(
    "tfidf_terms",
    f"""WITH {REVIEWS}, tokens AS (SELECT review_id, unnest({words('content')}) AS term FROM reviews),
    tf AS (SELECT review_id, term, count(*) AS tf FROM tokens GROUP BY review_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    weighted AS (SELECT tf.review_id, tf.term, tf, df,
      tf * (ln((1.0 + (SELECT count(*) FROM reviews WHERE content IS NOT NULL)) / (1.0 + df)) + 1) AS w FROM tf JOIN df ON tf.term = df.term)
    SELECT review_id, term, tf, df, round(w / sqrt(sum(w * w) OVER (PARTITION BY review_id)), 6) AS weight FROM weighted""",
)
def tfidf_terms(spark, sf_dir):
    return features.tfidf_terms(fixtures.reviews(spark, sf_dir)).withColumn(
        "weight", F.round("weight", 6)
    )


GRAMS = f"""grams AS (SELECT review_id, unnest(list_concat(t, list_transform(range(1, greatest(len(t), 1)),
      lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM (SELECT review_id, {words('content')} AS t FROM train))"""
VOCABULARY = f"""train AS (SELECT * FROM ranked WHERE r > floor(0.2 * n + 0.5)),
    {GRAMS},
    vocabulary AS (SELECT term, count(*) AS uses, count(DISTINCT review_id) AS documents FROM grams
      GROUP BY term ORDER BY uses DESC, term LIMIT 10000)"""


@query(
    "vocabulary",
    f"WITH {LABELLED}, {SPLIT}, {VOCABULARY} SELECT term, uses, documents FROM vocabulary",
)
def vocabulary(spark, sf_dir):
    training, _ = _split_reviews(spark, sf_dir)
    return features.vocabulary(features.term_statistics(training, longest=2))


@query(
    "tfidf_features",
    f"""WITH {LABELLED}, {SPLIT}, {VOCABULARY},
    counts AS (SELECT review_id, term, count(*) AS tf FROM grams GROUP BY review_id, term),
    weighted AS (SELECT c.review_id, c.tf * (ln((1.0 + (SELECT count(*) FROM train)) / (1.0 + v.documents)) + 1) AS w
      FROM counts c JOIN vocabulary v ON c.term = v.term),
    norms AS (SELECT review_id, count(*) AS terms, sum(w) AS s, sqrt(sum(w * w)) AS length, max(w) AS m FROM weighted GROUP BY review_id)
    SELECT t.review_id, coalesce(terms, 0) AS terms, round(coalesce(s / length, 0.0), 6) AS weight_sum,
      round(coalesce(m / length, 0.0), 6) AS weight_max
    FROM train t LEFT JOIN norms ON t.review_id = norms.review_id""",
)
def tfidf_features(spark, sf_dir):
    training, _ = _split_reviews(spark, sf_dir)
    vectors = features.tfidf_model(training).transform(training)
    weights = F.filter(vector_to_array("features"), lambda w: w != 0)
    return vectors.select("review_id", weights.alias("w")).select(
        "review_id",
        F.size("w").cast("bigint").alias("terms"),
        F.round(F.aggregate("w", F.lit(0.0), lambda a, b: a + b), 6).alias("weight_sum"),
        F.round(F.coalesce(F.array_max("w"), F.lit(0.0)), 6).alias("weight_max"),
    )


# --- evaluation --------------------------------------------------------------
# Rule-based classifiers over all labelled texts give predictions that need no model.

RULES = (("Length", "length(content)", 800), ("Length", "length(content)", 2000)) + tuple(
    ("Lines", "length(content) - length(replace(content, '\n', ''))", t) for t in (2, 6)
) + (("Commas", "length(content) - length(replace(content, ',', ''))", 8),)


def _rule(expression: str, threshold: int) -> str:
    return (
        f"CASE WHEN {expression} < {threshold} THEN '{NEGATIVE}' "
        f"WHEN {expression} < {2 * threshold} THEN '{NEUTRAL}' ELSE '{POSITIVE}' END"
    )


PREDICTIONS = f"""{LABELLED}, known AS (SELECT review_id, content, sentiment FROM labelled WHERE sentiment <> 'Unknown'),
predictions AS (""" + " UNION ALL ".join(
    f"""SELECT '{family}' AS model, '{family}-{t}' AS run_id, review_id, sentiment AS actual_sentiment,
  {_rule(e, t)} AS predicted_sentiment FROM known"""
    for family, e, t in RULES
) + ")"


def _predictions(spark, sf_dir) -> DataFrame:
    known = fixtures.reviews_with_sentiment(spark, sf_dir).filter(F.col("sentiment").isin(*LABELS))
    guesses = F.array(
        *(
            F.struct(
                F.lit(family).alias("model"),
                F.lit(f"{family}-{t}").alias("run_id"),
                F.expr(_rule(e, t)).alias("predicted_sentiment"),
            )
            for family, e, t in RULES
        )
    )
    return known.select(
        "review_id", F.col("sentiment").alias("actual_sentiment"), F.inline(guesses)
    )


CELLS = f"""{PREDICTIONS},
labels AS (SELECT * FROM (VALUES ('Negative'), ('Neutral'), ('Positive')) AS t(label)),
scores AS (SELECT model, run_id, label,
    count(*) FILTER (WHERE actual_sentiment = label AND predicted_sentiment = label) AS hits,
    count(*) FILTER (WHERE actual_sentiment = label) AS support,
    count(*) FILTER (WHERE predicted_sentiment = label) AS claimed
  FROM predictions CROSS JOIN labels GROUP BY model, run_id, label),
rates AS (SELECT *, CASE WHEN claimed > 0 THEN hits / claimed ELSE 0.0 END AS p,
    CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS r,
    CASE WHEN support + claimed > 0 THEN 2.0 * hits / (support + claimed) ELSE 0.0 END AS f FROM scores),
metrics AS (SELECT model, run_id, round(sum(f * support) / sum(support), 4) AS f1_weighted,
    round(sum(hits) / sum(support), 4) AS accuracy,
    round(sum(p * support) / sum(support), 4) AS "precision",
    round(sum(r * support) / sum(support), 4) AS recall FROM rates GROUP BY model, run_id)"""


@query("eval_metrics", f'WITH {CELLS} SELECT run_id, f1_weighted, accuracy, "precision", recall FROM metrics')
def eval_metrics(spark, sf_dir):
    return evaluate.eval_metrics(_predictions(spark, sf_dir), ["run_id"])


@query(
    "confusion_matrix",
    f"""WITH {PREDICTIONS} SELECT run_id, actual_sentiment AS actual,
      count(*) FILTER (WHERE predicted_sentiment = 'Negative') AS "predicted_Negative",
      count(*) FILTER (WHERE predicted_sentiment = 'Neutral') AS "predicted_Neutral",
      count(*) FILTER (WHERE predicted_sentiment = 'Positive') AS "predicted_Positive"
    FROM predictions GROUP BY run_id, actual_sentiment""",
)
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_predictions(spark, sf_dir), ["run_id"])


@query(
    "classification_report",
    f"""WITH {CELLS}
    SELECT run_id, label, round(p, 4) AS "precision", round(r, 4) AS recall, round(f, 4) AS f1, support FROM rates
    UNION ALL SELECT run_id, 'macro avg', round(avg(p), 4), round(avg(r), 4), round(avg(f), 4), CAST(sum(support) AS BIGINT)
      FROM rates GROUP BY run_id
    UNION ALL SELECT run_id, 'weighted avg', round(sum(p * support) / sum(support), 4),
      round(sum(r * support) / sum(support), 4), round(sum(f * support) / sum(support), 4), CAST(sum(support) AS BIGINT)
      FROM rates GROUP BY run_id""",
)
def classification_report(spark, sf_dir):
    return evaluate.classification_report(_predictions(spark, sf_dir), ["run_id"])


def _rule_runs(spark, sf_dir) -> DataFrame:
    return evaluate.eval_metrics(_predictions(spark, sf_dir), ["model", "run_id"]).withColumns(
        {
            "batch_id": F.lit("rules"),
            "status": F.when(F.col("run_id") == "Lines-6", "FAILED").otherwise("FINISHED"),
        }
    )


@query(
    "leaderboard",
    f"""WITH {CELLS} SELECT model, run_id, f1_weighted, accuracy FROM metrics WHERE run_id <> 'Lines-6'
    QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1_weighted DESC, accuracy DESC, run_id) = 1""",
)
def leaderboard(spark, sf_dir):
    return runs.leaderboard(_rule_runs(spark, sf_dir), "rules").select(
        "model", "run_id", "f1_weighted", "accuracy"
    )


@query(
    "best_run",
    f"""WITH {CELLS} SELECT model, run_id, f1_weighted, accuracy FROM metrics WHERE run_id <> 'Lines-6'
    ORDER BY f1_weighted DESC, accuracy DESC, run_id LIMIT 1""",
)
def best_run(spark, sf_dir):
    return runs.best_run(_rule_runs(spark, sf_dir), "rules").select(
        "model", "run_id", "f1_weighted", "accuracy"
    )


# --- training ----------------------------------------------------------------


def _trained(name: str, family: str, **params) -> None:
    """Train on the training rows, report the metrics on the test rows."""

    @query(name)
    def _(spark, sf_dir):
        training, test = _split_gold(spark, sf_dir)
        model = train.train_one(training, family, **params)
        return evaluate.eval_metrics(train.predict_batch(model, test)).withColumn(
            "model", F.lit(family)
        )


_trained("train_logreg", "LogisticRegression", C=1.0)
_trained("train_rf", "RandomForest")
_trained("train_gbt", "GradientBoosting")
_trained("train_svm", "LinearSVM")
_trained("train_xgb", "DeepBoosting")


@query("grid_search")
def grid_search(spark, sf_dir):
    training, test = _split_gold(spark, sf_dir)
    found = train.grid_search(training, test)
    return spark.createDataFrame(
        [(t.run["model"], t.run["f1_weighted"], t.run["accuracy"]) for t in found],
        "model string, f1_weighted double, accuracy double",
    )


def _scored(spark, sf_dir):
    training, test = _split_gold(spark, sf_dir)
    model = train.train_one(training, "LogisticRegression", C=1.0)
    return model, test, _gold(spark, sf_dir)


@query("predict_batch")
def predict_batch(spark, sf_dir):
    model, test, _ = _scored(spark, sf_dir)
    return train.predict_batch(model, test)


@query("score_reviews")
def score_reviews(spark, sf_dir):
    model, _, gold = _scored(spark, sf_dir)
    return train.score_reviews(model, gold.drop("sentiment"), normalize=True)


HELD_OUT = f"""WITH {LABELLED}, {SPLIT}, held_out AS (SELECT * FROM ranked WHERE r <= floor(0.2 * n + 0.5))"""


def _facts(rows: DataFrame, label: str) -> DataFrame:
    """How many rows, reviews, and labels out of the domain a scored table has."""
    return rows.agg(
        F.count(F.lit(1)).alias("scored"),
        F.countDistinct("review_id").alias("reviews"),
        F.count_if(~F.col(label).isin(*LABELS) | F.col(label).isNull()).alias("no_label"),
    )


@query(
    "predict_batch_facts",
    f"""{HELD_OUT} SELECT count(*) AS scored, count(DISTINCT review_id) AS reviews, CAST(0 AS BIGINT) AS no_label
    FROM held_out""",
)
def predict_batch_facts(spark, sf_dir):
    """Each held-out review once, with a label of the domain."""
    model, test, _ = _scored(spark, sf_dir)
    return _facts(train.predict_batch(model, test), "predicted_sentiment")


@query(
    "score_reviews_facts",
    f"""WITH {REVIEWS} SELECT normalized, count(*) AS scored, count(DISTINCT review_id) AS reviews,
      CAST(0 AS BIGINT) AS no_label FROM reviews, (VALUES (FALSE), (TRUE)) AS t(normalized) GROUP BY normalized""",
)
def score_reviews_facts(spark, sf_dir):
    """Each review once in both settings of the text."""
    model, _, gold = _scored(spark, sf_dir)
    plain, lowered = (
        _facts(train.score_reviews(model, gold.drop("sentiment"), normalize=flag), "sentiment").withColumn(
            "normalized", F.lit(flag)
        )
        for flag in (False, True)
    )
    return plain.unionByName(lowered)


@query(
    "sink_model",
    f"{HELD_OUT} SELECT review_id, sentiment, TRUE AS same FROM held_out",
)
def sink_model(spark, sf_dir):
    """A stored model, read again, gives the held-out reviews the same labels."""
    model, test, _ = _scored(spark, sf_dir)
    again = writers.load_model(writers.sink_model(model, scratch_path(spark, "model")))
    both = train.predict_batch(again, test).withColumnRenamed("predicted_sentiment", "again")
    first = train.predict_batch(model, test).select("review_id", "predicted_sentiment")
    return both.join(first, "review_id").select(
        "review_id",
        F.col("actual_sentiment").alias("sentiment"),
        F.col("again").eqNullSafe(F.col("predicted_sentiment")).alias("same"),
    )


def _own_warehouse() -> Warehouse:
    return Warehouse(prefix=f"w{uuid.uuid4().hex[:12]}_")


@query(
    "register_best",
    f"""WITH {CELLS}, best AS (SELECT run_id, f1_weighted FROM metrics WHERE run_id <> 'Lines-6'
      ORDER BY f1_weighted DESC, accuracy DESC, run_id LIMIT 1)
    SELECT CAST(version AS INT) AS version, run_id, 'models/' || version AS path, f1_weighted
    FROM best, (VALUES (1), (2)) AS t(version)""",
)
def register_best(spark, sf_dir):
    """The best rule run registered twice, as versions 1 and 2."""
    warehouse = _own_warehouse()
    writers.create_schemas(spark, warehouse, [ML], scratch_path(spark, "models"))
    best = materialize(runs.best_run(_rule_runs(spark, sf_dir), "rules"), "best")
    table = warehouse.table(ML, ML_MODELS)
    for version in (1, 2):
        models = runs.register_best(spark, best, f"models/{version}", table)
    return models


@query(
    "ddl_namespace",
    f"""WITH {LABELLED} SELECT layer, sentiment, count(*) AS n FROM labelled,
      (VALUES ('bronze'), ('silver'), ('gold'), ('ml')) AS t(layer) GROUP BY layer, sentiment""",
)
def ddl_namespace(spark, sf_dir):
    """One schema per layer, each taking a table of the reviews' sentiments."""
    warehouse = _own_warehouse()
    writers.create_schemas(spark, warehouse, location=scratch_path(spark, "layers"))
    reviews = fixtures.reviews_with_sentiment(spark, sf_dir).select("review_id", "sentiment")
    stored = [
        writers.sink_table(reviews, warehouse.table(layer, "reviews"))
        .groupBy("sentiment")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("layer", F.lit(layer))
        for layer in LAYERS
    ]
    return reduce(DataFrame.unionByName, stored)


@query(
    "join_predictions",
    f"""WITH {PREDICTIONS} SELECT review_id, content, predicted_sentiment AS sentiment
    FROM predictions JOIN known USING (review_id) WHERE run_id = 'Length-800'""",
)
def join_predictions(spark, sf_dir):
    from echoloom.operators.rows import join_predictions as join

    side = _predictions(spark, sf_dir).filter(F.col("run_id") == "Length-800")
    return join(
        fixtures.reviews(spark, sf_dir).select("review_id", "content"),
        side.select("review_id", F.col("predicted_sentiment").alias("sentiment")),
    )


@query("training_run")
def training_run(spark, sf_dir):
    """Split, grid, best run, registration and predictions through tables."""
    result = ml.run_training(
        spark,
        _gold(spark, sf_dir),
        _own_warehouse(),
        scratch_path(spark, "tables"),
    )
    return result.predictions
