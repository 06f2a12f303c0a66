"""Ties, empty labels and noise in the insight tables."""

from __future__ import annotations

import pytest

from echoloom.operators import insights


def make(spark, *rows):
    data = []
    for app, cluster, topic, sentiment, n in rows:
        data += [(len(data) + i, app, sentiment, cluster, topic) for i in range(n)]
    return spark.createDataFrame(
        data, "review_id bigint, app_id string, sentiment string, cluster int, clean_topic string"
    )


@pytest.fixture(scope="module")
def reviews(spark):
    return make(
        spark,
        ("a", 0, "crash", "Negative", 6),
        ("a", 1, "ads", "Negative", 6),
        ("a", -1, "Uncategorized", "Negative", 8),
        ("a", 1, "ads", "Positive", 6),
        ("a", 2, "price", "Neutral", 60),
        ("b", 3, "ui", "Positive", 3),
        ("b", 4, None, "Positive", 2),
        ("b", 3, "ui", "Unknown", 4),
    )


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_distribution(reviews):
    assert rows(insights.sentiment_distribution(reviews)) == [
        ("Negative", 20),
        ("Neutral", 60),
        ("Positive", 11),
    ]
    by_app = {(r[0], r[1]): r[2] for r in rows(insights.sentiment_distribution(reviews, ["app_id"]))}
    assert by_app[("b", "Negative")] == 0


def test_noise_only_counts_in_the_base(reviews):
    assert rows(insights.complaint_topics(reviews)) == [("ads", 6, 30.0), ("crash", 6, 30.0)]
    assert rows(insights.top_negative_topics(reviews, n=2)) == [("Uncategorized", 8), ("ads", 6)]


def test_breakdown_and_ties(reviews):
    got = {r["topic"]: r for r in insights.topic_sentiment_breakdown(reviews).collect()}
    assert set(got) == {"crash", "ads", "price", "ui"}
    assert got["ads"]["dominant_sentiment"] == "Negative"
    assert got["ui"]["total"] == 3


def test_polarizing_keeps_neutral_topics(reviews):
    assert [r["topic"] for r in insights.polarizing_topics(reviews, min_reviews=50).collect()] == ["price"]
    scores = {r["topic"]: r["polarizing_score"] for r in insights.polarizing_topics(reviews, min_reviews=1).collect()}
    assert scores["price"] == 1.0 and scores["ads"] == 1.0 and scores["crash"] == 0.0


def test_cluster_stats(reviews):
    assert insights.cluster_stats(reviews).first().asDict() == {
        "clusters": 5,
        "noise": 8,
        "total": 95,
        "noise_percentage": 8.4,
    }


def test_analysis_result(reviews):
    got = {r["app_id"]: r for r in insights.analysis_result(reviews).collect()}
    assert got["a"]["topics"][0].asDict() == {"topic": "price", "count": 60}
    assert got["b"]["top_negative_topics"] == []
    assert got["b"]["sentiment_distribution"].asDict() == {"Positive": 5, "Neutral": 0, "Negative": 0}


def test_report_reads_its_input_once(spark, reviews, tmp_path):
    path = str(tmp_path / "clustered")
    reviews.write.parquet(path)
    report = insights.summary_report(spark.read.parquet(path))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    assert plan.count("FileScan") == 1


def test_empty_input(reviews):
    nothing = reviews.filter("false")
    assert [r[1] for r in rows(insights.sentiment_distribution(nothing))] == [0, 0, 0]
    assert rows(insights.complaint_topics(nothing)) == []
