"""Queries for sentiment, topic and cluster insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from echoloom.functions.labels import encode_label
from echoloom.operators import insights
from echoloom.registry.core import CLUSTERED, LABELLED, query
from echoloom.sources import fixtures

APP = ["app_id"]


def _both(name: str, sql, build) -> None:
    """Register an insight once for all rows and once per app.

    ``sql`` gets the grouping prefix (``""`` or ``"app_id, "``).
    """
    query(name, sql(""))(lambda spark, sf_dir: build(fixtures.clustered(spark, sf_dir), []))
    query(f"{name}_by_app", sql("app_id, "))(
        lambda spark, sf_dir: build(fixtures.clustered(spark, sf_dir), APP)
    )


def _group(by: str, *columns: str) -> str:
    keys = [*(c for c in by.replace(" ", "").split(",") if c), *columns]
    return f"GROUP BY {', '.join(keys)}" if keys else ""


def _rank(by: str, order: str) -> str:
    partition = "PARTITION BY app_id " if by else ""
    return f"row_number() OVER ({partition}ORDER BY {order})"


def _on(by: str, left: str, right: str) -> str:
    return f"{left}.app_id = {right}.app_id" if by else "TRUE"


_both(
    "sentiment_distribution",
    lambda by: f"""WITH {LABELLED}, counts AS (
      SELECT {by}count(*) FILTER (WHERE sentiment = 'Negative') AS n0,
             count(*) FILTER (WHERE sentiment = 'Neutral') AS n1,
             count(*) FILTER (WHERE sentiment = 'Positive') AS n2 FROM labelled {_group(by)})
    SELECT {by}'Negative' AS sentiment, n0 AS reviews FROM counts
    UNION ALL SELECT {by}'Neutral', n1 FROM counts UNION ALL SELECT {by}'Positive', n2 FROM counts""",
    insights.sentiment_distribution,
)

_both(
    "sentiment_share",
    lambda by: f"""WITH {LABELLED}, counts AS (
      SELECT {by}sentiment, count(*) AS reviews FROM labelled {_group(by, 'sentiment')})
    SELECT {by}sentiment, reviews,
      round(reviews * 100.0 / sum(reviews) OVER ({'PARTITION BY app_id' if by else ''}), 1) AS percentage
    FROM counts""",
    insights.sentiment_share,
)


@query(
    "label_counts",
    f"""WITH {LABELLED} SELECT CASE sentiment WHEN 'Negative' THEN 0 WHEN 'Neutral' THEN 1 ELSE 2 END AS label,
      count(*) AS reviews FROM labelled WHERE sentiment <> 'Unknown' GROUP BY 1""",
)
def label_counts(spark, sf_dir):
    df = fixtures.reviews_with_sentiment(spark, sf_dir)
    return insights.label_counts(df.select(encode_label(F.col("sentiment")).alias("label")))


def _top_sql(by: str, measure: str, n: int, where: str = "TRUE") -> str:
    return f"""WITH {CLUSTERED}, counts AS (
      SELECT {by}clean_topic AS topic, count(*) AS {measure} FROM clustered WHERE {where}
      {_group(by, 'clean_topic')})
    SELECT {by}topic, {measure} FROM counts QUALIFY {_rank(by, f'{measure} DESC, topic')} <= {n}"""


_both("topic_frequency", lambda by: _top_sql(by, "reviews", 10), insights.topic_frequency)
_both("top_topics", lambda by: _top_sql(by, '"count"', 5), insights.top_topics)
_both(
    "top_negative_topics",
    lambda by: _top_sql(by, "negative_reviews", 5, "sentiment = 'Negative'"),
    insights.top_negative_topics,
)

_both(
    "topic_sentiment_heatmap",
    lambda by: f"""WITH {CLUSTERED} SELECT {by}clean_topic AS topic,
      count(*) FILTER (WHERE sentiment = 'Negative') AS "Negative",
      count(*) FILTER (WHERE sentiment = 'Neutral') AS "Neutral",
      count(*) FILTER (WHERE sentiment = 'Positive') AS "Positive",
      count(*) FILTER (WHERE sentiment = 'Unknown') AS "Unknown"
    FROM clustered {_group(by, 'clean_topic')}""",
    insights.topic_sentiment_heatmap,
)


def _share_sql(by: str, sentiment: str) -> str:
    partition = "PARTITION BY c.app_id " if by else ""
    return f"""WITH {CLUSTERED}, chosen AS (SELECT * FROM clustered WHERE sentiment = '{sentiment}'),
    base AS (SELECT {by}count(*) AS n FROM chosen {_group(by)}),
    counts AS (SELECT {by}clean_topic AS topic, count(*) AS review_count FROM chosen WHERE cluster <> -1
      {_group(by, 'clean_topic')})
    SELECT {'c.app_id, ' if by else ''}topic, review_count, round(review_count * 100.0 / n, 1) AS percentage
    FROM counts c JOIN base b ON {_on(by, 'c', 'b')}
    QUALIFY row_number() OVER ({partition}ORDER BY review_count DESC, topic) <= 10"""


_both("complaint_topics", lambda by: _share_sql(by, "Negative"), insights.complaint_topics)
_both("praise_topics", lambda by: _share_sql(by, "Positive"), insights.praise_topics)


def _breakdown_cte(by: str) -> str:
    return f"""{CLUSTERED}, counts AS (
      SELECT {by}clean_topic AS topic,
        count(*) FILTER (WHERE sentiment = 'Negative') AS "Negative",
        count(*) FILTER (WHERE sentiment = 'Neutral') AS "Neutral",
        count(*) FILTER (WHERE sentiment = 'Positive') AS "Positive"
      FROM clustered WHERE cluster <> -1 {_group(by, 'clean_topic')}),
    breakdown AS (SELECT *, "Negative" + "Neutral" + "Positive" AS total FROM counts
      WHERE "Negative" + "Neutral" + "Positive" > 0)"""


_both(
    "topic_sentiment_breakdown",
    lambda by: f"""WITH {_breakdown_cte(by)} SELECT {by}topic, "Negative", "Neutral", "Positive", total,
      CASE greatest("Negative", "Neutral", "Positive") WHEN "Negative" THEN 'Negative'
        WHEN "Neutral" THEN 'Neutral' ELSE 'Positive' END AS dominant_sentiment FROM breakdown""",
    insights.topic_sentiment_breakdown,
)


def _polarizing_sql(by: str, least: int) -> str:
    return f"""WITH {_breakdown_cte(by)}, scored AS (
      SELECT {by}topic, "Negative", "Positive", total,
        1 - abs("Negative" / total - "Positive" / total) AS score FROM breakdown WHERE total >= {least})
    SELECT {by}topic, "Negative", "Positive", total, round(score, 9) AS polarizing_score FROM scored
    QUALIFY {_rank(by, 'score DESC, topic')} <= 8"""


query("polarizing_topics", _polarizing_sql("", 30))(
    lambda spark, sf_dir: insights.polarizing_topics(
        fixtures.clustered(spark, sf_dir), min_reviews=30
    ).withColumn("polarizing_score", F.round("polarizing_score", 9))
)
query("polarizing_topics_by_app", _polarizing_sql("app_id, ", 1))(
    lambda spark, sf_dir: insights.polarizing_topics(
        fixtures.clustered(spark, sf_dir), APP, min_reviews=1
    ).withColumn("polarizing_score", F.round("polarizing_score", 9))
)

_both(
    "cluster_stats",
    lambda by: f"""WITH {CLUSTERED} SELECT {by}count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS clusters,
      count(*) FILTER (WHERE cluster = -1) AS noise, count(*) AS total,
      round(count(*) FILTER (WHERE cluster = -1) * 100.0 / count(*), 1) AS noise_percentage
    FROM clustered {_group(by)}""",
    insights.cluster_stats,
)
_both(
    "cluster_sizes",
    lambda by: f"WITH {CLUSTERED} SELECT {by}cluster, count(*) AS reviews FROM clustered {_group(by, 'cluster')}",
    insights.cluster_sizes,
)


def _report_sql(by: str) -> str:
    keys = "app_id" if by else "NULL AS app_id"
    partition = "PARTITION BY app_id"
    out = "app_id, " if by else ""
    return f"""WITH {CLUSTERED}, base AS (SELECT {keys}, cluster, sentiment, clean_topic AS topic FROM clustered),
    stats AS (SELECT app_id, count(*) AS total, count(DISTINCT cluster) FILTER (WHERE cluster <> -1) AS topics,
      count(*) FILTER (WHERE cluster = -1) AS noise FROM base GROUP BY app_id),
    shares AS (SELECT app_id, sentiment, count(*) AS n FROM base GROUP BY app_id, sentiment),
    tops AS (SELECT app_id, sentiment, topic, count(*) FILTER (WHERE cluster <> -1) AS n,
        sum(count(*)) OVER (PARTITION BY app_id, sentiment) AS base_n
      FROM base WHERE sentiment IN ('Negative', 'Positive') GROUP BY app_id, sentiment, topic),
    report AS (
      SELECT app_id, 'total' AS section, 1 AS rank, 'reviews' AS key, total AS reviews, NULL AS percentage FROM stats
      UNION ALL SELECT app_id, 'topics', 1, 'clusters', topics, NULL FROM stats
      UNION ALL SELECT app_id, 'noise', 1, 'noise', noise, round(noise * 100.0 / total, 1) FROM stats
      UNION ALL SELECT app_id, 'sentiment', row_number() OVER ({partition} ORDER BY n DESC, sentiment), sentiment, n,
        round(n * 100.0 / sum(n) OVER ({partition}), 1) FROM shares
      UNION ALL SELECT * FROM (SELECT app_id, CASE sentiment WHEN 'Negative' THEN 'complaints' ELSE 'praises' END,
          row_number() OVER (PARTITION BY app_id, sentiment ORDER BY n DESC, topic) AS r, topic, n,
          round(n * 100.0 / base_n, 1) FROM tops WHERE n > 0) WHERE r <= 3)
    SELECT {out}section, CAST(rank AS INT) AS rank, key, CAST(reviews AS BIGINT) AS reviews,
      CAST(percentage AS DOUBLE) AS percentage FROM report"""


_both("summary_report", _report_sql, insights.summary_report)


@query(
    "chart_tables",
    f"""WITH {_breakdown_cte('')}, topics AS (SELECT clean_topic AS topic, count(*) AS n FROM clustered GROUP BY 1),
    tops AS (SELECT sentiment, clean_topic AS topic, count(*) AS n FROM clustered WHERE cluster <> -1
      AND sentiment IN ('Negative', 'Positive') GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (ORDER BY total DESC, topic) AS r FROM breakdown),
    charts AS (
      SELECT 'sentiment_distribution' AS chart, CASE sentiment WHEN 'Negative' THEN 1 WHEN 'Neutral' THEN 2 ELSE 3 END AS rank,
        sentiment AS label, 'reviews' AS series, count(*) AS value
      FROM clustered WHERE sentiment <> 'Unknown' GROUP BY sentiment
      UNION ALL SELECT * FROM (SELECT 'topic_frequency', row_number() OVER (ORDER BY n DESC, topic) AS r, topic, 'reviews', n
        FROM topics) WHERE r <= 10
      UNION ALL SELECT * FROM (SELECT CASE sentiment WHEN 'Negative' THEN 'complaints' ELSE 'praises' END,
        row_number() OVER (PARTITION BY sentiment ORDER BY n DESC, topic) AS r, topic, sentiment, n FROM tops) WHERE r <= 8
      UNION ALL SELECT 'topic_sentiment', r, topic, 'Negative', "Negative" FROM ranked WHERE r <= 10
      UNION ALL SELECT 'topic_sentiment', r, topic, 'Neutral', "Neutral" FROM ranked WHERE r <= 10
      UNION ALL SELECT 'topic_sentiment', r, topic, 'Positive', "Positive" FROM ranked WHERE r <= 10)
    SELECT chart, CAST(rank AS INT) AS rank, substr(label, 1, 30) AS label, series, CAST(value AS BIGINT) AS value FROM charts""",
)
def chart_tables(spark, sf_dir):
    return insights.chart_tables(fixtures.clustered(spark, sf_dir))


@query(
    "analysis_result",
    f"""WITH {CLUSTERED}, dist AS (SELECT app_id, count(*) FILTER (WHERE sentiment = 'Positive') AS positive,
        count(*) FILTER (WHERE sentiment = 'Neutral') AS neutral,
        count(*) FILTER (WHERE sentiment = 'Negative') AS negative FROM clustered GROUP BY app_id),
    tops AS (SELECT app_id, clean_topic AS topic, count(*) AS n, count(*) FILTER (WHERE sentiment = 'Negative') AS neg
      FROM clustered GROUP BY app_id, clean_topic),
    t AS (SELECT app_id, string_agg(topic || ':' || n, ',' ORDER BY r) AS topics FROM (SELECT *,
      row_number() OVER (PARTITION BY app_id ORDER BY n DESC, topic) AS r FROM tops) WHERE r <= 5 GROUP BY app_id),
    g AS (SELECT app_id, string_agg(topic || ':' || neg, ',' ORDER BY r) AS negatives FROM (SELECT *,
      row_number() OVER (PARTITION BY app_id ORDER BY neg DESC, topic) AS r FROM tops WHERE neg > 0) WHERE r <= 5 GROUP BY app_id)
    SELECT dist.app_id, positive, neutral, negative, coalesce(topics, '') AS topics,
      coalesce(negatives, '') AS top_negative_topics
    FROM dist LEFT JOIN t ON dist.app_id = t.app_id LEFT JOIN g ON dist.app_id = g.app_id""",
)
def analysis_result(spark, sf_dir):
    result = insights.analysis_result(fixtures.clustered(spark, sf_dir))
    distribution = F.col("sentiment_distribution")
    return result.select(
        "app_id",
        distribution["Positive"].alias("positive"),
        distribution["Neutral"].alias("neutral"),
        distribution["Negative"].alias("negative"),
        F.array_join(
            F.transform("topics", lambda t: F.concat_ws(":", t["topic"], t["count"])), ","
        ).alias("topics"),
        F.array_join(
            F.transform(
                "top_negative_topics", lambda t: F.concat_ws(":", t["topic"], t["negative_reviews"])
            ),
            ",",
        ).alias("top_negative_topics"),
    )
