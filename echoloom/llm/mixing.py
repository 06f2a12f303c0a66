"""Mixing sources to target weights by Pfair scheduling.

A source of weight w gets one block in every window from floor((j - 1) / w) to
ceil(j / w), j = 1, 2, ... (Baruah et al. 1996).  Running the released block with
the earliest deadline in each slot meets all windows, so after t slots each
source has had w * t blocks, give or take less than one.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.operators.keyed import counted_lookup_join, numbered

BLOCK_ROWS = 64
TEMPER = 0.5  # exponent of a source's size where no weights are given from outside
WEIGHT_DIGITS = 2
BROADCAST_SLOTS = 100_000  # of a schedule; a longer one is joined
SEED = 17


def tempered_weights(
    docs: DataFrame, source: str = "source", exponent: float = TEMPER
) -> dict[str | None, Fraction]:
    """A target weight for each source: its number of rows to the power of ``exponent``.

    One keeps the sources' own proportions, zero makes all alike; in between small
    sources are read more often than they are large.  Weights are rounded to
    ``WEIGHT_DIGITS`` digits of the largest and are never below the last of them.
    The null source is one of the sources; an empty table has none.
    """
    counts = docs.groupBy(source).agg(F.count(F.lit(1)).alias("rows")).collect()
    raised = {r[source]: float(r["rows"]) ** exponent for r in counts}
    most = max(raised.values(), default=1.0)
    step = 10**WEIGHT_DIGITS
    return {s: Fraction(max(1, round(x / most * step)), step) for s, x in raised.items()}


def exact_parts(weights: Mapping[str, float | Fraction]) -> dict[str, int]:
    """Weights as the smallest whole numbers in exactly their proportions.

    A float counts as the decimal number that it is written as.  The schedule
    repeats after as many slots as the sum.
    """
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    if exact and min(exact.values()) <= 0:
        raise ValueError("weights must be positive")
    whole = math.lcm(*(w.denominator for w in exact.values()))
    parts = {s: int(w * whole) for s, w in exact.items()}
    common = math.gcd(*parts.values())
    return {s: n // common for s, n in parts.items()}


def window(block: int, share: int, parts: int) -> tuple[int, int]:
    """Release time and deadline of the ``block``-th block (from 1) of a source with ``share`` parts."""
    return (block - 1) * parts // share, -(-block * parts // share)


def schedule(shares: Mapping[str, int], slots: int) -> Iterator[tuple[str, int, int, int, int]]:
    """(source, block from 0, release, deadline, slot) of the first ``slots``, earliest deadline first.

    Every source always has a next block.  Windows never reach over the end of a
    period (the sum of the shares), so the schedule of all time is one period repeated.
    """
    parts = sum(shares.values())
    coming = [(0, source, 0) for source in shares]
    heapq.heapify(coming)
    ready: list[tuple[int, str, int, int]] = []
    for slot in range(slots):
        while coming[0][0] <= slot:
            release, source, block = coming[0]
            heapq.heappush(ready, (window(block + 1, shares[source], parts)[1], source, block, release))
            heapq.heapreplace(
                coming, (window(block + 2, shares[source], parts)[0], source, block + 1)
            )
        deadline, source, block, release = heapq.heappop(ready)
        assert slot < deadline
        yield source, block, release, deadline, slot


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float | Fraction] | None = None,
    key: str = "doc_id",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``block``, ``release``, ``deadline``, ``slot`` and ``row_in_block``.

    Rows of a source are shuffled by the hash of their key and cut into blocks of
    ``block_rows``; block j of a source gets its slot of the schedule.  Reading
    the rows by (slot, row_in_block) gives the mixture.  While every source has
    blocks left, each is within one block of its target at every slot; the slots
    of a source that has run out stay empty, and no row is left out or repeated.

    Without ``weights`` all sources weigh the same.  A source without a given
    weight gets the smallest given weight; the null source may be given one as ``None``.  Rows with equal
    or null keys are told apart by their number only; an empty table stays empty.
    Columns of ``docs`` called like the added ones are replaced.

    Weights are taken as they are, not rounded.  The sources' names and sizes and the
    slots of the blocks in one period pass through the driver, or of all blocks there
    are if the rows end before the period does: at most one slot a block.  The driver's
    time grows with the slots up to there.  A source's rows are numbered in
    buckets whose number follows its size, so a hot source is spread.
    """
    spark = docs.sparkSession
    added = ["block", "release", "deadline", "slot", "row_in_block"]
    fields = [c for c in docs.columns if c not in added]
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col(key).alias("_key"),
        # The null source goes by a name that no other source has.
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null")).alias("_source"),
    )
    filled = {
        r["_source"]: -(-r["rows"] // block_rows)
        for r in rows.groupBy("_source").agg(F.count(F.lit(1)).alias("rows")).collect()
    }
    given = {"null" if name is None else f"={name}": weight for name, weight in (weights or {}).items()}
    least = min(given.values(), default=1)
    shares = exact_parts({name: given.get(name, least) for name in filled})
    parts = sum(shares.values())
    # The last block's deadline, or the end of the period if that comes first.
    slots = min(parts, max((window(n, shares[s], parts)[1] for s, n in filled.items()), default=0))
    period = [
        (name, shares[name], block, release, deadline, slot, -(-(filled[name] - block) // shares[name]) * block_rows)
        for name, block, release, deadline, slot in schedule(shares, slots)
        if block < filled[name]
    ]
    table = spark.createDataFrame(
        period,
        "_source string, _share bigint, _at bigint, _release bigint, _deadline bigint, _slot bigint, _rows bigint",
    )
    sizes = F.broadcast(spark.createDataFrame(list(shares.items()), "_source string, _share bigint"))
    ranked = numbered(rows, ["_source"], ["_key"], "_number", F.xxhash64("_key", F.lit(SEED)))
    turned = (
        ranked.withColumn("_block", F.floor(F.col("_number") / block_rows))
        .join(sizes, "_source")
        .withColumn("_at", F.pmod("_block", "_share"))
        .withColumn("_turn", F.expr("_block div _share"))
    )
    on = ["_source", "_at"]
    if len(period) <= BROADCAST_SLOTS:
        placed = turned.join(F.broadcast(table.drop("_share", "_rows")), on)
    else:
        placed = counted_lookup_join(turned, table.drop("_share"), on, ["_number"], "_rows", how="inner")
    start = F.col("_turn") * F.lit(parts).cast("bigint")
    return placed.select(
        *(F.col("_row")[name].alias(name) for name in fields),
        F.col("_block").alias("block"),
        (start + F.col("_release")).alias("release"),
        (start + F.col("_deadline")).alias("deadline"),
        (start + F.col("_slot")).alias("slot"),
        F.pmod("_number", F.lit(block_rows).cast("bigint")).alias("row_in_block"),
    )


def in_mixed_order(docs: DataFrame, weights: Mapping[str, float] | None = None, **options) -> DataFrame:
    """The rows of ``docs`` in the order of the mixture, with their own columns only.

    Written as files, part after part and row after row follow the schedule.
    """
    kept = docs.columns
    wrapped = docs.select(
        F.struct(*kept).alias("_doc"),
        F.col(options.get("key", "doc_id")).alias("_id"),
        F.col(options.get("source", "source")).alias("_from"),
    )
    options = {k: v for k, v in options.items() if k not in ("key", "source")}
    mixed = mix_sources(wrapped, weights, key="_id", source="_from", **options)
    return mixed.orderBy("slot", "row_in_block").select(
        *(F.col("_doc")[name].alias(name) for name in kept)
    )
