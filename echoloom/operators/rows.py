"""Row-level operators: filters, projections, profiling, de-duplication, lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.constants import NOISE, RESULT_TTL_SECONDS, UNCATEGORIZED, UNKNOWN_TOPIC
from echoloom.functions.text import tokenize
from echoloom.operators.keyed import counted_lookup_join, first_per_group, lookup_join


def project_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def filter_noise(df: DataFrame) -> DataFrame:
    return df.filter(F.col("cluster") != NOISE)


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    return df.na.drop(subset=list(columns))


def profile_nulls(df: DataFrame) -> DataFrame:
    """Null count of every column, as (column_name, nulls)."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return counts.unpivot([], df.columns, "column_name", "nulls")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def row_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )


def preview(df: DataFrame, n: int = 5, key: str = "review_id") -> DataFrame:
    return df.orderBy(key).limit(n)


def sort_rows(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def top_k(df: DataFrame, order: Sequence[Column], k: int, by: Sequence[str] = ()) -> DataFrame:
    return first_per_group(df, by, order, k)


def add_ingest_metadata(
    df: DataFrame, source: str, batch_date: str, ingested_at: Column | None = None
) -> DataFrame:
    """Ingest time, source tag and batch date; the date is given, so reruns agree."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
            "_source": F.lit(source),
            "_batch_date": F.lit(batch_date),
        }
    )


def cast_types(df: DataFrame, column: str = "score") -> DataFrame:
    """Column as a number, null where it is none."""
    return df.withColumn(column, F.col(column).try_cast("double"))


def tokenize_reviews(df: DataFrame, content: str = "content", words: str = "words") -> DataFrame:
    return df.withColumn(words, tokenize(F.col(content)))


def dedup_reviews(df: DataFrame, by: Sequence[str] = ("app_id",), key: str = "review_id") -> DataFrame:
    """One row per key and content, the lowest id wins.

    Copies are compared by digest, and each map task keeps one row per digest
    before anything is shuffled, so a text repeated a billion times is cheap.
    """
    digest = df.withColumn("_digest", F.sha2(F.col("content"), 256))
    return first_per_group(digest, [*by, "_digest"], [F.col(key)], 1).drop("_digest")


# --- lookups -----------------------------------------------------------------


def join_cluster_topic(
    clustered: DataFrame,
    cluster_topics: DataFrame,
    by: Sequence[str] = (),
    key: str = "review_id",
) -> DataFrame:
    """Topic of each cluster; null where the cluster has none.

    Clusters are counted first, as noise may own a third of the rows, so
    ``clustered`` should be stored.
    """
    return counted_lookup_join(clustered, cluster_topics, [*by, "cluster"], [key])


def join_clean_topic(
    clustered: DataFrame, topic_names: DataFrame, key: str = "review_id"
) -> DataFrame:
    """Readable name of each topic.

    The uncategorised topic keeps its name, a topic without a name becomes
    Unknown Topic, a missing topic stays null.  The uncategorised and the missing
    ones look nothing up, however many they are.
    """
    looked_up = F.when(F.col("topic") != UNCATEGORIZED, F.col("topic"))
    names = topic_names.withColumnsRenamed({"topic": "_topic", "clean_topic": "_name"})
    named = lookup_join(clustered.withColumn("_topic", looked_up), names, ["_topic"], [key])
    return named.withColumn(
        "clean_topic",
        F.when(F.col("topic").isNull(), F.lit(None))
        .when(F.col("topic") == UNCATEGORIZED, F.col("topic"))
        .otherwise(F.coalesce(F.trim("_name"), F.lit(UNKNOWN_TOPIC))),
    ).drop("_name", "_topic")


def join_predictions(
    reviews: DataFrame, predictions: DataFrame, key: str = "review_id"
) -> DataFrame:
    """Put each prediction beside its review by key."""
    return reviews.join(predictions, key, "inner")


def stale_apps(
    apps: DataFrame,
    results: DataFrame,
    now: Column,
    ttl_seconds: int = RESULT_TTL_SECONDS,
    key: str = "app_id",
    computed_at: str = "computed_at",
) -> DataFrame:
    """Apps without a result younger than ``ttl_seconds``."""
    age = F.unix_micros(now) - F.unix_micros(F.col(computed_at))
    fresh = results.filter(age < ttl_seconds * 1_000_000).select(key).distinct()
    return apps.join(fresh, key, "left_anti")
