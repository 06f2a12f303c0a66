"""Exact, reproducible stratified split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echoloom.constants import LABELS, SPLIT_SEED, TEST_SHARE

# Hex digits of the digest that form a bucket: 16^4 buckets per label.
BUCKET_DIGITS = 4


def split_digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _cutoffs(keyed: DataFrame, label: str, key: str, share: float) -> DataFrame:
    """Per label, the (digest, key) of the last test row.

    Ranking a whole label would put a third of all rows into one task.  Instead
    digests are counted per bucket (a bounded table), the bucket that holds the
    last test row is found from running counts, and only that bucket is ranked.
    """
    buckets = keyed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    by_label = Window.partitionBy(label)
    running = by_label.orderBy("_bucket")
    boundary = (
        buckets.withColumn("_through", F.sum("_rows").over(running))
        .withColumn("_wanted", F.floor(F.sum("_rows").over(by_label) * F.lit(share) + 0.5))
        .filter(
            (F.col("_through") >= F.col("_wanted"))
            & (F.col("_through") - F.col("_rows") < F.col("_wanted"))
        )
        .select(label, "_bucket", (F.col("_wanted") - F.col("_through") + F.col("_rows")).alias("_nth"))
    )
    # One row per label at most: a safe broadcast.
    inside = keyed.join(F.broadcast(boundary), [label, "_bucket"])
    place = F.row_number().over(Window.partitionBy(label).orderBy("_digest", key))
    return (
        inside.withColumn("_place", place)
        .filter(F.col("_place") == F.col("_nth"))
        .select(label, F.col("_digest").alias("_last_digest"), F.col(key).alias("_last_key"))
    )


def mark_split(
    df: DataFrame,
    label: str = "sentiment",
    key: str = "review_id",
    test_share: float = TEST_SHARE,
    seed: int = SPLIT_SEED,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Add ``is_test``: exactly ``round(test_share * n)`` rows of every label.

    Rows with another label are dropped.  Membership depends on the key alone,
    so it is the same under any partitioning.  Only labels and keys are
    shuffled; the rows themselves pass through untouched.
    """
    known = df.filter(F.col(label).isin(*labels)).withColumn("_digest", split_digest(key, seed))
    keyed = known.select(
        label, key, "_digest", F.substring("_digest", 1, BUCKET_DIGITS).alias("_bucket")
    )
    # One row per label at most: a safe broadcast.
    cutoffs = F.broadcast(_cutoffs(keyed, label, key, test_share))
    before_last = (F.col("_digest") < F.col("_last_digest")) | (
        (F.col("_digest") == F.col("_last_digest")) & (F.col(key) <= F.col("_last_key"))
    )
    return (
        known.join(cutoffs, label, "left")
        .withColumn("is_test", F.coalesce(before_last, F.lit(False)))
        .drop("_digest", "_last_digest", "_last_key")
    )


def stratified_split(df: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(train, test) of :func:`mark_split`."""
    marked = mark_split(df, **options)
    return (
        marked.filter(~F.col("is_test")).drop("is_test"),
        marked.filter("is_test").drop("is_test"),
    )
