"""Connected components of a graph of any size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echoloom.operators.keyed import counted_lookup_join
from echoloom.workspace import materialize, materialize_counted, send_with_tasks

send_with_tasks(__name__)

# As many edges as one task finishes in memory; a constant, whatever the input.
LOCAL_EDGES = 50_000


def component_roots(
    edges: DataFrame, keys: Sequence[str] = (), local_edges: int = LOCAL_EDGES
) -> DataFrame:
    """(keys, node, root) for every node of ``edges`` (keys, a, b), one row per node.

    All nodes of a component get the same root, one of its nodes.  Rounds of
    contraction (each node moves to its neighbour of the smallest digest, which
    keeps chains short) shrink the graph until one task can finish it.  Each
    round is stored and the rounds are folded from the last to the first into
    one map, so no plan grows with the number of rounds.  Hubs are safe: minima
    combine on the map side and lookups split heavy nodes.
    """
    keys = list(keys)
    a_first = F.col("a") < F.col("b")
    low, high = F.when(a_first, F.col("a")).otherwise(F.col("b")), F.when(a_first, F.col("b")).otherwise(F.col("a"))
    edges, left = _stored(edges.select(*keys, low.alias("a"), high.alias("b")), keys)
    steps: list[DataFrame] = []
    while left > local_edges:
        both = edges.select(*keys, "a", "b").unionByName(
            edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"))
        )
        rank = F.struct(F.xxhash64("b").alias("digest"), F.col("b").alias("node"))
        own = F.struct(F.xxhash64("a").alias("digest"), F.col("a").alias("node"))
        best = both.groupBy(*keys, "a").agg(F.min(rank).alias("_best"), F.count(F.lit(1)).alias("rows"))
        step = materialize(
            best.select(*keys, F.col("a").alias("node"), F.least("_best", own)["node"].alias("to"), "rows"),
            "hooks",
        )
        steps.append(step)
        moved = _renamed(edges, step, keys, "a", "b")
        moved = _renamed(moved, step, keys, "b", "a")
        a_first = F.col("a") < F.col("b")
        edges, left = _stored(
            moved.select(
                *keys,
                F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("a"),
                F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("b"),
            ),
            keys,
        )
    roots = materialize(_finished(edges, keys), "roots")
    for step in reversed(steps):
        counts = step.groupBy(*keys, "to").agg(F.count(F.lit(1)).alias("rows"))
        targets = roots.select(*keys, F.col("node").alias("to"), "root").join(
            counts, [*keys, "to"], "inner"
        )
        folded = counted_lookup_join(
            step.select(*keys, "node", "to"), materialize(targets, "targets"), [*keys, "to"], ["node"], "rows"
        )
        roots = materialize(
            folded.select(*keys, "node", F.coalesce("root", "to").alias("root")), "roots"
        )
    return roots


def _stored(edges: DataFrame, keys: list[str]) -> tuple[DataFrame, int]:
    return materialize_counted(
        edges.filter(F.col("a") != F.col("b")).select(*keys, "a", "b").distinct(), "edges"
    )


def _renamed(
    df: DataFrame, step: DataFrame, keys: list[str], column: str, spread: str
) -> DataFrame:
    target = step.select(*keys, F.col("node").alias(column), "to", "rows")
    joined = counted_lookup_join(df, target, [*keys, column], [spread], "rows", how="inner")
    return joined.withColumn(column, F.col("to")).drop("to")


def _finished(edges: DataFrame, keys: list[str]) -> DataFrame:
    """The last edges, at most ``local_edges`` of them, by union-find in one task."""
    fields = {f.name: f.dataType for f in edges.schema.fields}
    schema = T.StructType(
        [T.StructField(k, fields[k]) for k in keys]
        + [T.StructField("node", fields["a"]), T.StructField("root", fields["a"])]
    )

    def join_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}

        def find(node):
            parent.setdefault(node, node)
            while parent[node] != node:
                parent[node] = parent[parent[node]]
                node = parent[node]
            return node

        for frame in frames:
            for row in frame.itertuples(index=False, name=None):
                group, a, b = row[:-2], row[-2], row[-1]
                low, high = sorted((find((*group, a)), find((*group, b))))
                parent[high] = low
        rows = [(*node, find(node)[-1]) for node in list(parent)]
        yield pd.DataFrame(rows, columns=schema.fieldNames())

    return edges.select(*keys, "a", "b").repartition(1).mapInPandas(join_up, schema)
