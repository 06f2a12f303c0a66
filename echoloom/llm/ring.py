"""Shards from a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many points (virtual nodes) on a ring of hash values, and a row
goes to the next point clockwise of its key's hash (Karger et al. 1997).  A shard
takes no more rows than its capacity; rows that find it full go on clockwise to
the next point of a shard that has room (Mirrokni, Thorup and Zadimoghaddam 2018).
Rows whose first shard has room never move because of others.
"""

from __future__ import annotations

import hashlib
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.operators.keyed import numbered
from echoloom.workspace import materialize

SHARDS = 24
POINTS = 128  # virtual nodes of a shard
RING = 1 << 60


def ring_points(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes in clockwise order.

    A shard's places depend on its number alone, so one more shard leaves the
    other points where they are.
    """

    def place(shard: int, copy: int) -> int:
        return int(hashlib.md5(f"{shard}/{copy}".encode()).hexdigest()[:15], 16)

    return sorted((place(s, c), s) for s in range(shards) for c in range(points))


@dataclass(frozen=True)
class Span:
    """Rows ``start`` to ``stop`` of an arc, in ring order, and where they go."""

    arc: int
    start: int
    stop: int
    shard: int
    slot: int


def fill(points: list[tuple[int, int]], rows: list[int], capacity: list[int]) -> list[Span]:
    """Spans of all arcs, from the number of rows in each.

    First every shard takes the rows of its own arcs in ring order, as far as it
    has room.  Then the rows left over are carried clockwise, first come first
    served, and taken by the points they pass; with room for all rows at most two
    turns are needed.  The work depends on the number of points only.
    """
    room = list(capacity)
    taken = [0] * len(capacity)
    spans: list[Span] = []
    left: list[tuple[int, int, int] | None] = []

    def take(shard: int, arc: int, start: int, stop: int) -> int:
        """Rows that ``shard`` still accepts of a stretch."""
        fits = min(room[shard], stop - start)
        if fits:
            spans.append(Span(arc, start, start + fits, shard, taken[shard]))
            room[shard] -= fits
            taken[shard] += fits
        return fits

    for arc, (_, shard) in enumerate(points):
        fits = take(shard, arc, 0, rows[arc])
        left.append((arc, fits, rows[arc]) if fits < rows[arc] else None)
    carried: deque[tuple[int, int, int]] = deque()
    for turn in range(2):
        for arc, (_, shard) in enumerate(points):
            while carried and room[shard]:
                from_arc, start, stop = carried.popleft()
                fits = take(shard, from_arc, start, stop)
                if start + fits < stop:
                    carried.appendleft((from_arc, start + fits, stop))
            if turn == 0 and left[arc]:
                carried.append(left[arc])
    if carried:
        raise ValueError("the shards hold fewer rows than there are")
    return spans


def ring_place(key: Column) -> Column:
    """Place of a key on the ring; a null key has the place of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    key: str = "doc_id",
    points: int = POINTS,
    slack: float = 0.0,
) -> DataFrame:
    """Add ``shard`` and ``slot``, a gapless number from 0 within the shard.

    ``slack`` is the share of rows a shard may hold above the mean.  With 0 all
    shards are filled to counts at most one apart.  More slack moves fewer rows
    away from their first shard (``home_shard``, added too).

    Only the number of rows per arc (``shards * points`` of them) reaches the
    driver; rows are numbered within arcs in parallel and look their shard up in
    the spans.  Null keys and repeated keys share a place and are told apart by
    their number; equal rows get different slots.  An empty table stays empty.
    Columns of ``docs`` called like the added ones are replaced.
    """
    added = ["home_shard", "shard", "slot"]
    docs = docs.select(F.struct(*(c for c in docs.columns)).alias("_row"), F.col(key).alias("_key"))
    ends = ring_points(shards, points)
    # The arc of a row ends at the first point at or after its place, round to the first one.
    table = docs.sparkSession.createDataFrame(
        [
            (arc, ends[arc - 1][0] if arc else -1, place)
            for arc, (place, _) in enumerate(ends)
        ]
        + [(0, ends[-1][0], RING)],
        "_arc int, _after bigint, _through bigint",
    )
    # Points are cut by the ring's top bits, so that a row meets only a few of them.
    cell_bits = max(1, (len(ends) * 4).bit_length())
    cells = table.withColumn(
        "_cell",
        F.explode(
            F.sequence(
                F.shiftright(F.col("_after") + 1, 60 - cell_bits),
                F.shiftright(F.least(F.col("_through"), F.lit(RING - 1)), 60 - cell_bits),
            )
        ),
    )
    placed = docs.withColumn("_place", ring_place(F.col("_key"))).withColumn(
        "_cell", F.shiftright("_place", 60 - cell_bits)
    )
    # Its size follows from shards and points alone.
    located = placed.join(
        F.broadcast(cells),
        (placed["_cell"] == cells["_cell"])
        & (F.col("_place") > F.col("_after"))
        & (F.col("_place") <= F.col("_through")),
    ).select(
        "_row",
        "_key",
        "_place",
        "_arc",
        ((F.col("_place") - F.col("_after")) / (F.col("_through") - F.col("_after"))).alias("_along"),
    )
    ranked = materialize(
        numbered(
            located,
            ["_arc"],
            ["_place", "_key"],
            "_number",
            # How far along its arc a row lies: spreads an arc over buckets and keeps its order.
            F.shiftleft((F.col("_along") * 2.0**62).cast("bigint"), 1),
        ),
        "ring",
    )
    counts = {r["_arc"]: r["n"] for r in ranked.groupBy("_arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = [counts.get(arc, 0) for arc in range(len(ends))]
    total = sum(rows)
    most = [total // shards + (s < total % shards) for s in range(shards)]
    if slack:
        most = [max(m, -(-int(total * (1 + slack)) // shards)) for m in most]
    spans = docs.sparkSession.createDataFrame(
        [(s.arc, s.start, s.stop, s.shard, s.slot, ends[s.arc][1]) for s in fill(ends, rows, most)],
        "_arc int, _start bigint, _stop bigint, _shard int, _slot bigint, _home int",
    )
    # One span per arc, and one more for every time a shard fills up or a stretch is split.
    found = ranked.join(
        F.broadcast(spans),
        (ranked["_arc"] == spans["_arc"])
        & (F.col("_number") >= F.col("_start"))
        & (F.col("_number") < F.col("_stop")),
    )
    fields = [f.name for f in docs.schema["_row"].dataType.fields if f.name not in added]
    return found.select(
        *(F.col("_row")[name].alias(name) for name in fields),
        F.col("_home").alias("home_shard"),
        F.col("_shard").alias("shard"),
        (F.col("_slot") + F.col("_number") - F.col("_start")).alias("slot"),
    )
