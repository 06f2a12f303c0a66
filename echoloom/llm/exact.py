"""Exact duplicates by progressive refinement: length, prefix hash, full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.operators.keyed import counted_lookup_join
from echoloom.workspace import materialize

PREFIX = 64  # characters hashed before the whole text is
# Bits of the filter that marks groups with more than one row.  Its size (1 MB)
# does not depend on the data; two groups on one bit only hash a text too many.
FILTER_BITS = 2**23
WORD_BITS = 32_768  # bits in one row of Spark's bitmap functions


def _place(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(FILTER_BITS).cast("bigint"))


def _marked(bitmap: Column, place: Column) -> Column:
    """Whether the bit of ``place`` is set in its row of the filter."""
    offset = F.pmod(place, F.lit(WORD_BITS))
    byte = F.substring(bitmap, (F.floor(offset / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    bit = F.pmod(F.floor(value / F.pow(F.lit(2.0), F.pmod(offset, F.lit(8)))), F.lit(2))
    return F.coalesce(bit == 1, F.lit(False))


def exact_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    prefix: int = PREFIX,
    all_digests: bool = False,
) -> DataFrame:
    """One row per document: key, keep_id, group_size, kept, digest.

    Equal texts form a group and the largest key of a group stays.  Rows are
    refined step by step: by length and by the hash of the first ``prefix``
    characters (one aggregation, as a shared prefix group implies a shared
    length), and only rows that share both with another row are hashed whole.
    The step between is a filter of fixed size, so texts are never shuffled and
    no group is ever held by one task; heavy groups are split by
    ``counted_lookup_join``.

    Null texts count as empty, and all empty texts are one group.  A null key is
    smaller than any other.  Rows that repeat a key and its text share one
    decision; rows that repeat a key with other texts belong to several groups.
    ``digest`` (SHA-256, binary) is null for rows that needed no full hash, unless
    ``all_digests`` asks for them.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    length, start = F.octet_length(value), F.xxhash64(F.substring(value, 1, prefix))
    signed = docs.select(
        F.col(key).alias("_key"), value.alias("_value"), length.alias("_length"), start.alias("_start")
    )
    shared = (
        signed.groupBy("_length", "_start")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > 1)
        .select((_place(F.col("_length"), F.col("_start")) + 1).alias("_bit"))
    )
    marks = shared.groupBy(F.bitmap_bucket_number("_bit").alias("_word")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bitmap")
    )
    place = _place(F.col("_length"), F.col("_start"))
    # At most FILTER_BITS / WORD_BITS rows of 4 KB each.
    tested = signed.withColumn("_word", F.floor(place / WORD_BITS) + 1).join(
        F.broadcast(materialize(marks, "marks")), "_word", "left"
    )
    marked = _marked(F.col("_bitmap"), place)
    whole = F.unhex(F.sha2(F.col("_value"), 256))
    hashed = materialize(
        tested.select(
            "_key", marked.alias("_marked"), F.when(F.lit(all_digests) | marked, whole).alias("digest")
        ),
        "digests",
    )
    groups = materialize(
        hashed.filter("_marked")
        .groupBy("digest")
        .agg(F.max("_key").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") > 1)
        .withColumn("_rows", F.col("group_size")),
        "groups",
    )
    joined = counted_lookup_join(hashed, groups, ["digest"], ["_key"], "_rows")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("_key")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("_key").alias(key),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("_key").eqNullSafe(keep).alias("kept"),
        "digest",
    )


def drop_exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Only the dropped rows' keys and digests are joined back.  An empty table
    stays empty; see :func:`exact_duplicates` for the other cases.
    """
    found = exact_duplicates(docs, key, text)
    dropped = materialize(
        found.filter(~F.col("kept")).select(F.col(key).alias("_gone"), "digest").distinct(), "dropped"
    )
    value = F.coalesce(F.col(text), F.lit(""))
    # The key decides alone whenever keys are unique; the digest settles repeated keys.
    return docs.join(
        dropped,
        docs[key].eqNullSafe(dropped["_gone"])
        & (F.unhex(F.sha2(value, 256)) == dropped["digest"]),
        "left_anti",
    )
