"""Insight tables over clustered reviews.

Input is one row per review with ``sentiment``, ``cluster`` and a topic column.
Every operator starts from :func:`topic_cube`, a map-side combined count per
(cluster, topic, sentiment); whatever follows works on that small table, so a
topic or app that owns a third of the reviews costs no more than any other.
``by`` gives one result per key, for example ``["app_id"]``.  Ties are broken
by topic name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echoloom.constants import LABELS, NEGATIVE, NEUTRAL, NOISE, POSITIVE, UNKNOWN
from echoloom.operators.keyed import first_per_group

Keys = Sequence[str]


def topic_cube(clustered: DataFrame, by: Keys = (), topic: str = "clean_topic") -> DataFrame:
    """Review counts per (by, cluster, topic, sentiment)."""
    return clustered.groupBy(*by, "cluster", F.col(topic).alias("topic"), "sentiment").agg(
        F.count(F.lit(1)).alias("reviews")
    )


def _sum_where(condition: Column, value: str = "reviews") -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col(value))), F.lit(0).cast("bigint"))


def _with_total(counts: DataFrame, by: Keys, value: Column, name: str) -> DataFrame:
    """Add the sum of ``value`` per key; one scalar subquery when there is no key."""
    if by:
        return counts.withColumn(name, F.sum(value).over(Window.partitionBy(*by)))
    return counts.withColumn(name, counts.agg(F.sum(value)).scalar())


def _percentage(part: Column, whole: Column) -> Column:
    return F.round(part * 100.0 / F.nullif(whole, F.lit(0)), 1)


# --- sentiment ---------------------------------------------------------------


def sentiment_distribution(reviews: DataFrame, by: Keys = ()) -> DataFrame:
    """Positive, Neutral and Negative counts, 0 where a label is absent."""
    counts = reviews.groupBy(*by).agg(
        *(F.count_if(F.col("sentiment") == label).alias(label) for label in LABELS)
    )
    return counts.unpivot(list(by), list(LABELS), "sentiment", "reviews")


def sentiment_share(reviews: DataFrame, by: Keys = ()) -> DataFrame:
    """Count and percentage of all rows per label."""
    counts = reviews.groupBy(*by, "sentiment").agg(F.count(F.lit(1)).alias("reviews"))
    return (
        _with_total(counts, by, F.col("reviews"), "_all")
        .filter(F.col("sentiment").isNotNull())
        .select(*by, "sentiment", "reviews", _percentage(F.col("reviews"), F.col("_all")).alias("percentage"))
    )


def label_counts(encoded: DataFrame, by: Keys = (), label: str = "label") -> DataFrame:
    return (
        encoded.filter(F.col(label).isNotNull())
        .groupBy(*by, label)
        .agg(F.count(F.lit(1)).alias("reviews"))
    )


# --- topics ------------------------------------------------------------------


def _per_topic(cube: DataFrame, by: Keys, **measures: Column) -> DataFrame:
    """Measures per topic; ``_named`` tells real topics from the null one.

    Conditions sit in the measures and in ``_named`` rather than in filters,
    which Spark would push below the cube and so compute it once per condition.
    """
    return cube.groupBy(*by, "topic").agg(
        F.count("topic").alias("_named"), *(m.alias(name) for name, m in measures.items())
    )


def _topic_totals(cube: DataFrame, by: Keys) -> DataFrame:
    totals = _per_topic(
        cube,
        by,
        reviews=F.sum("reviews"),
        negative_reviews=_sum_where(F.col("sentiment") == NEGATIVE),
    )
    return totals.filter(F.col("_named") > 0).drop("_named")


def _top(df: DataFrame, by: Keys, measure: str, n: int, rank: str | None = None) -> DataFrame:
    return first_per_group(df, by, [F.col(measure).desc(), F.col("topic").asc()], n, rank)


def topic_frequency(clustered: DataFrame, by: Keys = (), n: int = 10) -> DataFrame:
    """Most frequent topics, the uncategorised one included."""
    totals = _topic_totals(topic_cube(clustered, by), by).select(*by, "topic", "reviews")
    return _top(totals, by, "reviews", n)


def top_topics(clustered: DataFrame, by: Keys = (), n: int = 5) -> DataFrame:
    return topic_frequency(clustered, by, n).withColumnRenamed("reviews", "count")


def top_negative_topics(clustered: DataFrame, by: Keys = (), n: int = 5) -> DataFrame:
    """Topics with most negative reviews, the uncategorised one included."""
    totals = _topic_totals(topic_cube(clustered, by), by)
    negative = totals.filter(F.col("negative_reviews") > 0).select(*by, "topic", "negative_reviews")
    return _top(negative, by, "negative_reviews", n)


def topic_sentiment_heatmap(
    clustered: DataFrame, by: Keys = (), sentiments: Sequence[str] = (*LABELS, UNKNOWN)
) -> DataFrame:
    """Topic by sentiment counts, one column per sentiment, 0 where empty."""
    return (
        clustered.filter(F.col("clean_topic").isNotNull() & F.col("sentiment").isNotNull())
        .groupBy(*by, F.col("clean_topic").alias("topic"))
        .agg(*(F.count_if(F.col("sentiment") == s).alias(s) for s in sentiments))
    )


def _sentiment_topics(cube: DataFrame, sentiment: str, by: Keys) -> DataFrame:
    """Share of each real topic in all reviews of one sentiment."""
    of_sentiment = F.col("sentiment") == sentiment
    counts = _per_topic(
        cube,
        by,
        review_count=_sum_where(of_sentiment & (F.col("cluster") != NOISE)),
        _with_noise=_sum_where(of_sentiment),
    )
    return (
        _with_total(counts, by, F.col("_with_noise"), "_all")
        .filter((F.col("_named") > 0) & (F.col("review_count") > 0))
        .select(
            *by,
            "topic",
            "review_count",
            _percentage(F.col("review_count"), F.col("_all")).alias("percentage"),
        )
    )


def sentiment_topics(
    clustered: DataFrame, sentiment: str, by: Keys = (), n: int = 10
) -> DataFrame:
    counts = _sentiment_topics(topic_cube(clustered, by), sentiment, by)
    return _top(counts, by, "review_count", n)


def complaint_topics(clustered: DataFrame, by: Keys = (), n: int = 10) -> DataFrame:
    """Top topics of negative reviews without noise; noise stays in the base of the share."""
    return sentiment_topics(clustered, NEGATIVE, by, n)


def praise_topics(clustered: DataFrame, by: Keys = (), n: int = 10) -> DataFrame:
    return sentiment_topics(clustered, POSITIVE, by, n)


def _breakdown(cube: DataFrame, by: Keys) -> DataFrame:
    negative, neutral, positive = map(F.col, (NEGATIVE, NEUTRAL, POSITIVE))
    real = F.col("cluster") != NOISE
    counts = _per_topic(
        cube,
        by,
        **{label: _sum_where(real & (F.col("sentiment") == label)) for label in LABELS},
    )
    return (
        counts.withColumn("total", negative + neutral + positive)
        .filter((F.col("_named") > 0) & (F.col("total") > 0))
        .drop("_named")
        .withColumn(
            "dominant_sentiment",
            F.when((negative >= neutral) & (negative >= positive), NEGATIVE)
            .when(neutral >= positive, NEUTRAL)
            .otherwise(POSITIVE),
        )
    )


def topic_sentiment_breakdown(clustered: DataFrame, by: Keys = ()) -> DataFrame:
    """Sentiment counts, total and most common sentiment per real topic."""
    return _breakdown(topic_cube(clustered, by), by)


def polarizing_topics(
    clustered: DataFrame, by: Keys = (), min_reviews: int = 50, n: int = 8
) -> DataFrame:
    """Topics whose negative and positive shares are closest."""
    scored = (
        topic_sentiment_breakdown(clustered, by)
        .filter(F.col("total") >= min_reviews)
        .select(
            *by,
            "topic",
            NEGATIVE,
            POSITIVE,
            "total",
            (
                1 - F.abs(F.col(NEGATIVE) / F.col("total") - F.col(POSITIVE) / F.col("total"))
            ).alias("polarizing_score"),
        )
    )
    return _top(scored, by, "polarizing_score", n)


# --- clusters ----------------------------------------------------------------


def cluster_sizes(clustered: DataFrame, by: Keys = ()) -> DataFrame:
    return clustered.groupBy(*by, "cluster").agg(F.count(F.lit(1)).alias("reviews"))


def cluster_stats(clustered: DataFrame, by: Keys = ()) -> DataFrame:
    """Number of clusters, noise rows and noise percentage."""
    return _cluster_stats(cluster_sizes(clustered, by), by)


def _cluster_stats(sizes: DataFrame, by: Keys) -> DataFrame:
    return (
        sizes.groupBy(*by)
        .agg(
            F.count_if(F.col("cluster") != NOISE).alias("clusters"),
            _sum_where(F.col("cluster") == NOISE).alias("noise"),
            F.sum("reviews").alias("total"),
        )
        .withColumn("noise_percentage", _percentage(F.col("noise"), F.col("total")))
    )


# --- reports -----------------------------------------------------------------


def _section(name: str, df: DataFrame, by: Keys, rank, key, reviews, percentage) -> DataFrame:
    return df.select(
        *by,
        F.lit(name).alias("section"),
        rank.cast("int").alias("rank"),
        key.cast("string").alias("key"),
        reviews.cast("bigint").alias("reviews"),
        percentage.cast("double").alias("percentage"),
    )


def summary_report(clustered: DataFrame, by: Keys = ()) -> DataFrame:
    """Totals, sentiment shares and top three complaints and praises as rows.

    All sections read one topic cube, whose exchange Spark reuses.
    """
    cube = topic_cube(clustered, by)
    stats = _cluster_stats(cube.groupBy(*by, "cluster").agg(F.sum("reviews").alias("reviews")), by)
    labels = cube.groupBy(*by, "sentiment").agg(
        F.sum("reviews").alias("reviews"), F.count("sentiment").alias("_known")
    )
    shares = _with_total(labels, by, F.col("reviews"), "_all").filter(F.col("_known") > 0)
    # At most a handful of labels per key, so ranking them is cheap.
    label_rank = F.row_number().over(
        Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.col("reviews").desc(), "sentiment")
    )
    headline = F.array(
        *(
            F.struct(
                F.lit(section).alias("section"),
                F.lit(key).alias("key"),
                F.col(reviews).alias("reviews"),
                percentage.cast("double").alias("percentage"),
            )
            for section, key, reviews, percentage in (
                ("total", "reviews", "total", F.lit(None)),
                ("topics", "clusters", "clusters", F.lit(None)),
                ("noise", "noise", "noise", F.col("noise_percentage")),
            )
        )
    )
    parts = [
        stats.select(*by, F.inline(headline)).withColumn("rank", F.lit(1)),
        _section(
            "sentiment",
            shares,
            by,
            label_rank,
            F.col("sentiment"),
            F.col("reviews"),
            _percentage(F.col("reviews"), F.col("_all")),
        ),
    ]
    for name, sentiment in (("complaints", NEGATIVE), ("praises", POSITIVE)):
        top = _top(_sentiment_topics(cube, sentiment, by), by, "review_count", 3, "_rank")
        parts.append(
            _section(
                name, top, by, F.col("_rank"), F.col("topic"), F.col("review_count"), F.col("percentage")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def chart_tables(clustered: DataFrame) -> DataFrame:
    """The numbers behind the charts as (chart, rank, label, series, value)."""
    cube = topic_cube(clustered)
    totals = _topic_totals(cube, ())
    position = F.array_position(F.array(*map(F.lit, LABELS)), F.col("sentiment"))
    labels = cube.groupBy("sentiment").agg(
        F.sum("reviews").alias("reviews"), F.max(position).alias("_position")
    )

    def bars(chart: str, df: DataFrame, rank, label, series, value) -> DataFrame:
        return df.select(
            F.lit(chart).alias("chart"),
            rank.cast("int").alias("rank"),
            F.substring(label, 1, 30).alias("label"),
            series.alias("series"),
            value.cast("bigint").alias("value"),
        )

    parts = [
        bars(
            "sentiment_distribution",
            labels.filter(F.col("_position") > 0),
            F.col("_position"),
            F.col("sentiment"),
            F.lit("reviews"),
            F.col("reviews"),
        ),
        bars(
            "topic_frequency",
            _top(totals, (), "reviews", 10, "_rank"),
            F.col("_rank"),
            F.col("topic"),
            F.lit("reviews"),
            F.col("reviews"),
        ),
    ]
    for chart, sentiment in (("complaints", NEGATIVE), ("praises", POSITIVE)):
        top = _top(_sentiment_topics(cube, sentiment, ()), (), "review_count", 8, "_rank")
        parts.append(
            bars(chart, top, F.col("_rank"), F.col("topic"), F.lit(sentiment), F.col("review_count"))
        )
    stacked = _top(_breakdown(cube, ()), (), "total", 10, "_rank").unpivot(
        ["_rank", "topic"], list(LABELS), "series", "value"
    )
    parts.append(
        bars("topic_sentiment", stacked, F.col("_rank"), F.col("topic"), F.col("series"), F.col("value"))
    )
    return reduce(DataFrame.unionByName, parts)


def analysis_result(clustered: DataFrame, by: Keys = ("app_id",), n: int = 5) -> DataFrame:
    """One row per app: sentiment distribution, top topics, top negative topics."""
    cube = topic_cube(clustered, by)
    distribution = cube.groupBy(*by).agg(
        F.struct(
            *(
                _sum_where(F.col("sentiment") == label).alias(label)
                for label in (POSITIVE, NEUTRAL, NEGATIVE)
            )
        ).alias("sentiment_distribution")
    )
    totals = _topic_totals(cube, by)

    def ranked(df: DataFrame, measure: str, label: str, name: str) -> DataFrame:
        top = _top(df, by, measure, n, "_rank")
        rows = F.array_sort(
            F.collect_list(
                F.struct(F.col("_rank"), F.col("topic"), F.col(measure).alias(label))
            )
        )
        return top.groupBy(*by).agg(
            F.transform(rows, lambda r: F.struct(r["topic"].alias("topic"), r[label].alias(label))).alias(name)
        )

    topics = ranked(totals, "reviews", "count", "topics")
    negative = ranked(
        totals.filter(F.col("negative_reviews") > 0),
        "negative_reviews",
        "negative_reviews",
        "top_negative_topics",
    )
    empty = "array<struct<topic:string,{}:bigint>>"
    return (
        distribution.join(topics, list(by), "left")
        .join(negative, list(by), "left")
        .withColumn("topics", F.coalesce("topics", F.array().cast(empty.format("count"))))
        .withColumn(
            "top_negative_topics",
            F.coalesce("top_negative_topics", F.array().cast(empty.format("negative_reviews"))),
        )
    )
