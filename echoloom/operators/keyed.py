"""Building blocks that hold up when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Salts are the low bits of a hash, so their numbers are powers of two.
SALTS = 32


def _salt(columns: Sequence[str], salts: int) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit(salts - 1).cast("bigint"))


def _all_salts(salts: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))


def _any_null(columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for column in columns:
        missing = missing | F.col(column).isNull()
    return missing


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """Join many ``facts`` to a much smaller ``dim`` with one row per key.

    No broadcast is forced: Spark broadcasts ``dim`` when its measured size is
    below the threshold.  Beyond it the shuffle key carries a salt taken from
    the row's own key, so a key that owns a third of ``facts`` is still spread
    over ``salts`` tasks; only the small side is copied.  Facts with a null in
    the key match nothing and go everywhere.

    The salt is never null, so Spark pushes no extra filter below ``facts`` and
    an exchange that ``facts`` and ``dim`` have in common is reused.
    """
    missing = _any_null(on)
    salt = F.when(missing, F.xxhash64(*spread_by)).otherwise(_salt(spread_by, salts))
    salted_facts = facts.withColumn("_salt", salt)
    salted_dim = dim.withColumn("_salt", F.explode(_all_salts(salts)))
    return salted_facts.join(salted_dim, [*on, "_salt"], how).drop("_salt")


def counted_lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    rows: str | None = None,
    how: str = "left",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``facts`` to a large ``dim`` with one row per key.

    ``rows`` is the column of ``dim`` with the number of facts per key; without
    it they are counted, so ``facts`` (or ``dim``) should be stored.  A key is
    heavy when it holds more than its even share, all rows over the number of
    shuffle partitions, so no more keys than partitions can be heavy: their list
    is broadcast whole.  A heavy key is cut into as many salts as it holds
    shares; the rest of ``dim`` is not copied.  Facts with a null in the key
    match nothing and are spread like a heavy key.  ``hot_rows`` replaces the
    even share.
    """
    spark = facts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows is None:
        counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    else:
        counts = dim.select(*on, F.col(rows).cast("bigint").alias("_rows"))
    if hot_rows is None:
        share = F.ceil(counts.agg(F.coalesce(F.sum("_rows"), F.lit(1)) / F.lit(parts)).scalar())
        share = F.greatest(share.cast("bigint"), F.lit(1).cast("bigint"))
    else:
        share = F.lit(hot_rows).cast("bigint")
    heavy = counts.filter(F.col("_rows") > share).select(
        *on, F.ceil(F.col("_rows") / share).cast("bigint").alias("_salts")
    )
    none = F.lit(0).cast("bigint")
    missing = _any_null(on)
    digest = F.xxhash64(*spread_by)
    salt = (
        F.when(missing, F.pmod(digest, F.lit(parts).cast("bigint")))
        .when(F.col("_salts").isNotNull(), F.pmod(digest, F.col("_salts")))
        .otherwise(none)
    )
    salted_facts = facts.join(F.broadcast(heavy), list(on), "left").withColumn("_salt", salt)
    salted_dim = dim.join(F.broadcast(heavy), list(on), "left").withColumn(
        "_salt", F.explode(F.sequence(none, F.coalesce("_salts", F.lit(1)) - 1))
    )
    spare = ["_salts"] if rows is None else ["_salts", rows]
    return (
        salted_facts.drop("_salts")
        .join(salted_dim.drop(*spare), [*on, "_salt"], how)
        .drop("_salt")
    )


def first_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark cuts every group to ``n`` rows on the map side, so a hot group never
    reaches one task whole.  It does so up to a threshold; for a larger ``n``
    each group is first cut within salted parts.  Without grouping it is a plain
    ordered limit.
    """
    if not by:
        if rank is None:
            return df.orderBy(*order).limit(n)
        # The ordered limit leaves n rows, so the single-partition window is bounded.
        return df.orderBy(*order).limit(n).withColumn(
            rank, F.row_number().over(Window.orderBy(*order))
        )
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        salt = _salt(order_columns(df, by), SALTS)
        within = Window.partitionBy(*by, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_place", F.row_number().over(within))
            .filter(F.col("_place") <= n)
            .drop("_salt", "_place")
        )
    position = rank or "_position"
    ranked = df.withColumn(
        position, F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    ).filter(F.col(position) <= n)
    return ranked if rank else ranked.drop(position)


def order_columns(df: DataFrame, by: Sequence[str]) -> list[str]:
    """Columns that tell the rows of a group apart and can be hashed."""
    return [f.name for f in df.schema.fields if f.name not in by and f.dataType.typeName() != "map"]


def dense_numbers(df: DataFrame, by: Sequence[str], key: str, name: str) -> DataFrame:
    """Number the distinct keys of each group 0, 1, ..., in the order of their digests.

    Keys are numbered within 4096 digest buckets and the buckets' offsets added,
    so no task sees a whole group.
    """
    bucketed = df.withColumn("_digest", F.md5(F.col(key).cast("string"))).withColumn(
        "_bucket", F.substring("_digest", 1, 3)
    )
    counts = bucketed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    through = F.sum("_rows").over(Window.partitionBy(*by).orderBy("_bucket"))
    offsets = counts.select(*by, "_bucket", (through - F.col("_rows")).alias("_offset"))
    place = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy("_digest", key))
    return (
        bucketed.join(offsets, [*by, "_bucket"])
        .withColumn(name, (F.col("_offset") + place - 1).cast("int"))
        .drop("_digest", "_bucket", "_offset")
    )


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, digest: Column
) -> DataFrame:
    """Number the rows of each group 0, 1, ..., by ``digest`` (bigint) and then ``order``.

    The digest's range is cut into buckets, so many that the largest group's hold
    an even share of all rows (rows over shuffle partitions), and the buckets'
    offsets are added: no task sees a whole group.  The columns of ``by`` hold no
    nulls.  ``df`` is read three times, twice without its other columns.
    """
    by = list(by)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    most, total = groups.agg(F.max("_rows"), F.sum("_rows")).first()
    bits = ((most or 0) // max(1, (total or 0) // parts)).bit_length()
    # The top bits of the digest, as an unsigned number.
    bucket = F.shiftrightunsigned(digest, 64 - bits) if bits else F.lit(0).cast("bigint")
    bucketed = df.withColumn("_digest", digest).withColumn("_bucket", bucket)
    counts = bucketed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    through = F.sum("_rows").over(Window.partitionBy(*by).orderBy("_bucket"))
    offsets = counts.select(*by, "_bucket", (through - F.col("_rows")).alias("_offset"))
    # Unsigned order within a bucket: the sign bit is flipped.
    unsigned = F.col("_digest").bitwiseXOR(F.lit(-(2**63)).cast("bigint"))
    place = F.row_number().over(
        Window.partitionBy(*by, "_bucket").orderBy(unsigned, *order)
    )
    # The join and the window share one exchange.
    return (
        bucketed.join(offsets, [*by, "_bucket"])
        .withColumn(name, (F.col("_offset") + place - 1).cast("bigint"))
        .drop("_digest", "_bucket", "_offset")
    )
