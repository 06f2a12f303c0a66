"""Labelled samples for fitting, and the counts of words in a corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.workspace import send_with_tasks

send_with_tasks(__name__)

WORDS_HELD = 500_000  # distinct words a task counts before it passes them on


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether a key belongs to the fold that is never learned from; a null key does not."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    rows: int,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, text, label) of at most ``rows`` labelled documents, chosen by the hash of their key.

    ``usable`` is a condition on the columns of ``labels``.  The chosen keys are
    few, so texts are not shuffled to find them.  A key with two labels takes the
    larger; of the rows that repeat a key one is used.
    """
    chosen = (
        labels.filter(usable & F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(key)
        .agg(F.max(label).cast("int").alias("_label"))
        .orderBy(F.xxhash64(key), key)
        .limit(rows)
        .withColumnRenamed(key, "_chosen")
    )
    # At most ``rows`` rows.
    found = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(
        F.broadcast(chosen), F.col(key) == F.col("_chosen")
    )
    return found.groupBy(key).agg(
        F.min("_text").alias("_text"), F.min("_label").alias("_label")
    )


def word_counts(
    docs: DataFrame, text: str = "text", by: str | None = None
) -> DataFrame:
    """(by, word binary, n) over all whole texts, lower-cased in A-Z and cut at ASCII space.

    Every task counts what it reads and passes its counts on when it holds many
    words; they are added up by word.
    """
    schema = "_by string, word binary, n bigint"

    def rows(counts: dict[str | None, Counter]) -> pa.RecordBatch:
        flat = [(b, w, n) for b, words in counts.items() for w, n in words.items()]
        columns = list(zip(*flat)) if flat else [(), (), ()]
        kinds = [pa.string(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["_by", "word", "n"]
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str | None, Counter] = {}
        for batch in batches:
            for group, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if value:
                    counts.setdefault(group, Counter()).update(value.lower().split())
            if sum(map(len, counts.values())) >= WORDS_HELD:
                yield rows(counts)
                counts = {}
        yield rows(counts)

    group = F.col(by).cast("string") if by else F.lit(None).cast("string")
    narrow = docs.select(group.alias("_by"), F.col(text).cast("binary").alias("_text"))
    counted = narrow.mapInArrow(scan, schema)
    keys = ["_by", "word"] if by else ["word"]
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("n"))
    return totals.withColumnRenamed("_by", by) if by else totals
