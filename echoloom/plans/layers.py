"""Bronze, silver and gold layers.

Each layer is a ``DataFrame -> DataFrame`` function; only :func:`run_medallion`
writes between them.  Keys are carried through all layers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from echoloom.constants import BRONZE, GOLD, LAYER_TABLES, SILVER, Warehouse
from echoloom.functions.labels import sentiment_from_score
from echoloom.functions.text import clean_text
from echoloom.operators.rows import (
    add_ingest_metadata,
    cast_types,
    dedup_reviews,
    tokenize_reviews,
)
from echoloom.sources.writers import create_schemas, sink_table

KEYS = ("review_id", "app_id")


def bronze_layer(raw: DataFrame, source: str, batch_date: str) -> DataFrame:
    return add_ingest_metadata(raw, source, batch_date)


def silver_layer(bronze: DataFrame, cast: bool = False) -> DataFrame:
    """Keys, content and sentiment; ``cast`` turns a textual score into a number."""
    typed = cast_types(bronze) if cast else bronze
    return typed.select(*KEYS, "content", sentiment_from_score(F.col("score")).alias("sentiment"))


def gold_layer(silver: DataFrame, dedup: bool = False, tokens: bool = False) -> DataFrame:
    """Silver with cleaned content; optionally one row per text and a word list."""
    cleaned = silver.withColumn("content", clean_text(F.col("content")))
    if dedup:
        cleaned = dedup_reviews(cleaned)
    return tokenize_reviews(cleaned) if tokens else cleaned


def medallion(raw: DataFrame, source: str, batch_date: str, **options) -> DataFrame:
    """All three layers as one plan, nothing written in between."""
    return gold_layer(silver_layer(bronze_layer(raw, source, batch_date)), **options)


def run_medallion(
    spark: SparkSession,
    raw: DataFrame,
    source: str,
    batch_date: str,
    warehouse: Warehouse,
    location: str | None = None,
    dedup: bool = False,
    tokens: bool = False,
) -> tuple[DataFrame, dict[str, int]]:
    """Write all layers; returns the gold table and the rows written per layer."""
    create_schemas(spark, warehouse, tuple(LAYER_TABLES), location)
    counts: dict[str, int] = {}

    def store(layer: str, df: DataFrame, partition_by=()) -> DataFrame:
        counted = Observation(layer)
        stored = sink_table(
            df,
            warehouse.table(layer, LAYER_TABLES[layer]),
            warehouse.file_format,
            partition_by,
            counted,
        )
        counts[layer] = counted.get["row_count"]
        return stored

    bronze = store(BRONZE, bronze_layer(raw, source, batch_date), ("_batch_date",))
    silver = store(SILVER, silver_layer(bronze))
    gold = store(GOLD, gold_layer(silver, dedup, tokens))
    return gold, counts
