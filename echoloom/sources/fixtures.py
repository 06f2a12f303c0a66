"""Review views over the given parquet tables.

The test tables hold no app reviews, so documents stand in for review texts,
their quality labels for star ratings and their sources for apps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.constants import NOISE, UNCATEGORIZED
from echoloom.functions.labels import sentiment_from_score


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    score = (
        F.when(F.col("toxic") == 1, 1).when(F.col("quality") == 0, 3).when(F.col("quality") == 1, 5)
    )
    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("app_id"),
        "lang",
        F.col("text").alias("content"),
        score.alias("score"),
    )


def reviews_with_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews(spark, sf_dir).withColumn("sentiment", sentiment_from_score(F.col("score")))


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        "o_custkey",
        F.substring("o_orderpriority", 1, 1).cast("int").alias("score"),
    )


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with a given cluster and topic, so insights need no model."""
    noise = F.col("review_id") % 5 == 0
    return reviews_with_sentiment(spark, sf_dir).select(
        "review_id",
        "app_id",
        "content",
        "sentiment",
        F.when(noise, NOISE)
        .when(F.col("lang") == "de", 0)
        .when(F.col("lang") == "en", 1)
        .when(F.col("lang") == "es", 2)
        .otherwise(3)
        .alias("cluster"),
        F.when(noise, UNCATEGORIZED).otherwise(F.col("lang")).alias("clean_topic"),
    )
