"""The layers over a stream of landed review files.

The layer functions hold no state, so the batch code runs unchanged on a
streaming frame; each trigger appends what has arrived since the last one.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from echoloom import schema
from echoloom.plans.layers import medallion


def stream_medallion(
    spark: SparkSession,
    landing: str,
    gold_path: str,
    checkpoint: str,
    source: str,
    batch_date: str,
    columns: T.StructType = schema.RAW_REVIEWS,
    files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Clean every landed parquet file once into ``gold_path``, then stop."""
    raw = (
        spark.readStream.schema(columns)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(landing)
    )
    return (
        medallion(raw, source, batch_date)
        .writeStream.format("parquet")
        .option("path", gold_path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
