"""Boosted trees over several labels, grown from histograms.

Each round grows one tree for each label on the gradients of the shared softmax.  Every
feature is cut into bins once; a level of all trees of a round needs one aggregation of
gradient sums by (label, node, feature, bin), from which the best cut of each node is
chosen.  Two kinds differ in how sums become cuts and leaves:

* ``GRADIENT`` fits residuals by least squares and gives a leaf one Newton step
  (Friedman 2001); absent values are zeros, which are the smallest.
* ``NEWTON`` uses the second-order gain with penalised Hessian sums (Chen and Guestrin
  2016); absent values go the way that gains more.

Features are not negative, as term weights are.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.workspace import materialize, release, send_with_tasks

send_with_tasks(__name__)

GRADIENT, NEWTON = "gradient", "newton"
BINS = 32  # of a feature's values beside the absent one
LOCAL_ENTRIES = 2_000_000  # values that one task grows all trees on
BLOCK_ENTRIES = 250_000  # values that are counted together beyond that
SLICE_ENTRIES = 8_000_000  # values of the features that one task chooses from, at most on average
CHUNK_ENTRIES = 1_000_000  # values whose sums a task holds at a time
REWRITE_ROUNDS = 10  # after which scores are kept, so that no task walks all trees for each level
DIGITS = 9  # gains are compared rounded, so that ties do not depend on the order of sums
TINY = 1e-12


@dataclass(frozen=True)
class Rules:
    """Settings of a fit."""

    kind: str
    labels: int
    rate: float
    depth: int
    penalty: float = 1.0  # on squared leaf values, NEWTON only
    least_weight: float = 1.0  # Hessian sum of a child, NEWTON only


# --- arithmetic of one level ---------------------------------------------------


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def gradients(rules: Rules, scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative sums' terms of each row and label, in the form that the kind adds up."""
    chance = softmax(scores)
    residual = (labels[:, None] == np.arange(rules.labels)[None, :]) - chance
    if rules.kind == GRADIENT:
        return residual, np.abs(residual) * (1 - np.abs(residual))
    return -residual, np.maximum(2 * chance * (1 - chance), 1e-16)


def leaf_value(rules: Rules, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    if rules.kind == GRADIENT:
        step = np.where(h > 1e-150, g / np.where(h > 1e-150, h, 1.0), 0.0)
        return rules.rate * (rules.labels - 1) / rules.labels * step
    return -rules.rate * g / (h + rules.penalty)


def _worth(rules: Rules, g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What a node with these sums is worth by itself."""
    if rules.kind == GRADIENT:
        return g**2 / np.maximum(n, 1)
    return g**2 / (h + rules.penalty) / 2


def best_cut(rules: Rules, total: tuple[float, float, float], feature: np.ndarray, bins: np.ndarray, sums: np.ndarray):
    """(gain, feature, bin, absent to the left) of one node, or None.

    ``feature`` and ``bins`` (ascending) name the histogram's filled cells of present
    values, ``sums`` (cells, 3) their gradient, Hessian and row sums; ``total`` is the
    node's.  Present values up to ``bin`` go left; bin 0 sends present ones right.  Ties
    go to the first feature, then bin, then absent values to the left.
    """
    if not len(feature):
        return None
    whole = np.array(total)
    first = np.flatnonzero(np.concatenate(([True], feature[1:] != feature[:-1])))
    sizes = np.diff(np.concatenate((first, [len(feature)])))
    below = np.cumsum(sums, axis=0)
    before = np.repeat(below[first] - sums[first], sizes, axis=0)
    upto = below - before  # present values up to this bin
    present = np.repeat(np.add.reduceat(sums, first, axis=0), sizes, axis=0)
    absent = whole[None, :] - present
    # A cut after each filled bin, and one before the first.
    cuts = [(np.zeros_like(absent[first]), absent[first], feature[first], np.zeros(len(first), np.int64)), (upto, absent, feature, bins)]
    options = []
    for present_left, lacking, of, at in cuts:
        for to_left in (True, False) if rules.kind == NEWTON else (True,):
            left = present_left + lacking if to_left else present_left
            right = whole[None, :] - left
            gain = _worth(rules, *left.T) + _worth(rules, *right.T) - _worth(rules, *whole)
            fine = (left[:, 2] > 0.5) & (right[:, 2] > 0.5)
            if rules.kind == NEWTON:
                fine &= (left[:, 1] >= rules.least_weight) & (right[:, 1] >= rules.least_weight)
            gain = np.where(fine, np.round(gain, DIGITS), -np.inf)
            options.append((gain, of, at, np.full(len(of), to_left)))
    gain, of, at, to_left = (np.concatenate(x) for x in zip(*options))
    largest = gain.max()
    if not largest > 10.0**-DIGITS:
        return None
    level = np.flatnonzero(gain == largest)
    best = level[np.lexsort((~to_left[level], at[level], of[level]))[0]]
    return float(gain[best]), int(of[best]), int(at[best]), bool(to_left[best])


# A tree is a list of nodes: [feature, bin, absent left, left, right] or [value].
Tree = list[list]


def walk(tree: Tree, lookup, rows: int) -> np.ndarray:
    """Node that each row comes to; ``lookup(feature)`` is the rows' bins, 0 for absent."""
    node = np.zeros(rows, dtype=np.int64)
    inside = {0: np.arange(rows)}
    for number, entry in enumerate(tree):  # children come after their parents
        here = inside.pop(number, None)
        if len(entry) == 1 or here is None or not len(here):
            continue
        feature, cut, absent_left, left, right = entry
        found = lookup(feature)[here]
        goes_left = np.where(found == 0, bool(absent_left), found <= cut)
        for child, rows_there in ((left, here[goes_left]), (right, here[~goes_left])):
            inside[child] = rows_there
            node[rows_there] = child
    return node


class Binned:
    """Rows of one batch: their present values as (feature, row, bin), by feature."""

    def __init__(self, features: pd.Series, bins: pd.Series):
        empty = np.zeros(0, np.int32)
        self._set(
            np.array([len(f) for f in features], dtype=np.int64),
            np.concatenate([empty, *(np.asarray(f, np.int32) for f in features)]),
            np.concatenate([empty, *(np.asarray(b, np.int32) for b in bins)]),
        )

    @classmethod
    def of_block(cls, block: dict) -> Binned:
        """The rows of a stored block, see :func:`blocks_of`."""
        data = cls.__new__(cls)
        data._set(*(np.frombuffer(block[name], np.int32) for name in ("sizes", "features", "bins")))
        return data

    def _set(self, sizes: np.ndarray, features: np.ndarray, bins: np.ndarray) -> None:
        self.rows = len(sizes)
        order = np.argsort(features, kind="stable")
        self.feature, self.bin = features[order], bins[order]
        self.row = np.repeat(np.arange(self.rows, dtype=np.int32), sizes)[order]
        self._columns: dict[int, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_columns": {}}

    def lookup(self, feature: int) -> np.ndarray:
        known = self._columns.get(feature)
        if known is None:
            a, b = np.searchsorted(self.feature, np.array([feature, feature + 1], np.int32))
            known = np.zeros(self.rows, dtype=np.int32)
            known[self.row[a:b]] = self.bin[a:b]
            if len(self._columns) < 512:
                self._columns[feature] = known
        return known

    def raised(self, scores: np.ndarray, trees: list[list[Tree]]) -> np.ndarray:
        """``scores`` with the values of finished rounds added."""
        scores = scores.copy()
        for round_ in trees:
            for label, tree in enumerate(round_):
                values = np.array([entry[0] if len(entry) == 1 else 0.0 for entry in tree])
                scores[:, label] += values[walk(tree, self.lookup, self.rows)]
        return scores


class Columns:
    """Present values of some features of all rows, sorted into cells (feature, bin)."""

    def __init__(self, feature: np.ndarray, bins: np.ndarray, row: np.ndarray):
        order = np.lexsort((row, bins, feature))
        feature, bins = feature[order], bins[order]
        starts = np.flatnonzero((np.diff(feature, prepend=-1) != 0) | (np.diff(bins, prepend=-1) != 0))
        self.row = row[order].astype(np.int32)
        self.ends = np.append(starts, len(row))  # of the cells, with the first start
        self.feature, self.bin = feature[starts].astype(np.int64), bins[starts].astype(np.int64)

    def chunks(self) -> Iterator[tuple[int, int]]:
        """Ranges of cells of whole features with about ``CHUNK_ENTRIES`` values."""
        heads = np.append(np.flatnonzero(np.diff(self.feature, prepend=-1)), len(self.feature))
        at = 0
        while at < len(heads) - 1:
            upto = int(np.searchsorted(self.ends[heads], self.ends[heads[at]] + CHUNK_ENTRIES, side="right")) - 1
            upto = max(upto, at + 1)
            yield int(heads[at]), int(heads[upto])
            at = upto

    def best_cuts(self, rules: Rules, states: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> list[list]:
        """Best cut of each open node of each tree among these features.

        A state is (totals, place, g, h): the open nodes' sums, and of each row the place of its node
        in them, -1 for none, and its gradient and Hessian.
        """
        best: list[list] = [[None] * len(totals) for totals, *_ in states]
        for first, last in self.chunks():
            row = self.row[self.ends[first] : self.ends[last]]
            cell = np.repeat(np.arange(last - first), np.diff(self.ends[first : last + 1]))
            feature, bins = self.feature[first:last], self.bin[first:last]
            for cuts, (totals, place, g, h) in zip(best, states):
                n = len(totals)
                node = place[row]
                of, key = row, cell * n + node
                if (node < 0).any():
                    of, key = row[node >= 0], key[node >= 0]
                size = (last - first) * n
                sums = np.stack([np.bincount(key, w, size) for w in (g[of], h[of], None)], axis=1)
                sums = sums.reshape(last - first, n, 3)
                for i in range(n):
                    filled = np.flatnonzero(sums[:, i, 2])
                    cut = best_cut(rules, tuple(totals[i]), feature[filled], bins[filled], sums[filled, i])
                    if cut and (cuts[i] is None or (-cut[0], cut[1]) < (-cuts[i][0], cuts[i][1])):
                        cuts[i] = cut
        return best


def open_state(node: np.ndarray, open_nodes: list[int], g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The state of one tree that :meth:`Columns.best_cuts` takes; ``node`` is each row's, -1 for none."""
    places = np.full(max(open_nodes) + 2, -1, np.int64)
    places[open_nodes] = np.arange(len(open_nodes))
    place = places[np.where(node <= max(open_nodes), node, -1)]
    return node_sums(place, len(open_nodes), g, h), place, g, h


def node_sums(place: np.ndarray, nodes: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(nodes, 3) gradient, Hessian and row sums."""
    inside = place >= 0
    return np.stack([np.bincount(place[inside], w, nodes) for w in (g[inside], h[inside], None)], axis=1)


def grow_level(rules: Rules, tree: Tree, cuts: dict[int, tuple], level: int) -> list[int]:
    """Splits or closes the open nodes of ``tree``; the new open ones."""
    opened = []
    for node, (total, cut) in sorted(cuts.items()):
        if cut is None or level == rules.depth:
            tree[node] = [float(leaf_value(rules, np.array(total[0]), np.array(total[1])))]
            continue
        _, feature, at, absent_left = cut
        left = len(tree)
        tree[node] = [feature, at, absent_left, left, left + 1]
        tree += [[0.0], [0.0]]
        opened += [left, left + 1]
    return opened


def start_scores(rules: Rules, counts: np.ndarray) -> list[float]:
    """Scores before the first round: the logarithms of the labels' shares, or zero."""
    if rules.kind == NEWTON:
        return [0.0] * rules.labels
    shares = counts / max(counts.sum(), 1)
    return np.log(np.clip(shares, np.finfo(np.float32).eps, 1.0)).tolist()


def fit_local(rules: Rules, rounds: int, data: Binned, labels: np.ndarray, start: list[float]) -> list[list[Tree]]:
    """All rounds on rows that one task holds."""
    scores = np.tile(np.array(start), (data.rows, 1))
    columns = Columns(data.feature, data.bin, data.row)
    trees: list[list[Tree]] = []
    for _ in range(rounds):
        g, h = gradients(rules, scores, labels)
        grown: list[Tree] = []
        for label in range(rules.labels):
            tree, open_nodes = [[0.0]], [0]
            for level in range(rules.depth + 1):
                if not open_nodes:
                    break
                node = walk(tree, data.lookup, data.rows)
                state = open_state(node, open_nodes, g[:, label].copy(), h[:, label].copy())
                found = columns.best_cuts(rules, [state])[0] if level < rules.depth else [None] * len(open_nodes)
                cuts = {n: (tuple(total), cut) for n, total, cut in zip(open_nodes, state[0].tolist(), found)}
                open_nodes = grow_level(rules, tree, cuts, level)
            grown.append(tree)
        trees.append(grown)
        scores = data.raised(scores, [grown])
    return trees


# --- as Spark jobs -------------------------------------------------------------


def feature_cuts(entries: DataFrame, bins: int = BINS) -> dict[int, np.ndarray]:
    """Upper ends of each feature's bins, at most ``bins - 1``, from its present values.

    As many numbers reach the driver as there are features times bins, which the size of
    the vocabulary bounds.
    """
    shares = [i / bins for i in range(1, bins)]
    found = entries.groupBy("feature").agg(F.percentile_approx("value", shares, 10_000).alias("cuts"))
    return {r["feature"]: np.unique(r["cuts"]) for r in found.toLocalIterator()}


def binned_rows(rows: DataFrame, features: str, label: str) -> tuple[DataFrame, dict[int, np.ndarray], int]:
    """Stored (label, features, bins) of every row, the cuts, and the number of present values."""
    vector = F.unwrap_udt(features)
    dense = vector["indices"].isNull()
    index = F.when(dense, F.sequence(F.lit(0), F.size(vector["values"]) - 1)).otherwise(vector["indices"])
    pairs = F.filter(F.arrays_zip(index.alias("f"), vector["values"].alias("v")), lambda x: x["v"] != 0)
    flat = materialize(rows.select(F.col(label).cast("int").alias("label"), pairs.alias("_pairs")), "rows")
    each = flat.select(F.explode("_pairs").alias("p")).select(F.col("p.f").alias("feature"), F.col("p.v").alias("value"))
    cuts = feature_cuts(each)
    shared = rows.sparkSession.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = shared.value
        for batch in batches:
            pairs = batch.column("_pairs")
            flat = pairs.flatten()
            features, values = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("f", "v"))
            bins = np.zeros(len(features), np.int32)
            order = np.argsort(features, kind="stable")
            starts = np.flatnonzero(np.diff(features[order], prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(order)]):
                bins[order[a:b]] = 1 + np.searchsorted(cuts[int(features[order[a]])], values[order[a:b]], side="left")
            offsets = pa.array(np.concatenate(([0], np.cumsum(pairs.value_lengths().to_numpy(zero_copy_only=False)))), pa.int32())
            lists = (pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (features, bins))
            yield pa.RecordBatch.from_arrays([batch.column("label"), *lists], ["label", "features", "bins"])

    stored = materialize(flat.mapInArrow(place, "label int, features array<int>, bins array<int>"), "binned")
    return stored, cuts, each.count()


def _fit_in_one_task(rules: Rules, rounds: int, stored: DataFrame, start: list[float]) -> list[list[Tree]]:
    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gathered = [f for f in frames if len(f)]
        if gathered:
            table = pd.concat(gathered, ignore_index=True)
            data = Binned(table["features"], table["bins"])
            trees = fit_local(rules, rounds, data, table["label"].to_numpy(), start)
            yield pd.DataFrame({"trees": [json.dumps(trees)]})

    found = stored.repartition(1).mapInPandas(fit, "trees string").collect()
    return json.loads(found[0]["trees"]) if found else []


def blocks_of(stored: DataFrame, entries: int, start: list[float]) -> DataFrame:
    """Stored rows as blocks of about ``BLOCK_ENTRIES`` present values: (label, sizes, features, bins, scores), all binary, and block, a number."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            flat = {c: [chunk.flatten().to_numpy() for chunk in rows.column(c).chunks] for c in ("features", "bins")}
            values = {
                "label": rows.column("label").to_numpy().astype(np.int32),
                "sizes": rows.column("features").combine_chunks().value_lengths().to_numpy().astype(np.int32),
                **{c: np.concatenate([np.zeros(0, np.int32), *parts]).astype(np.int32) for c, parts in flat.items()},
                "scores": np.tile(np.array(start, dtype=float), (len(rows), 1)),
            }
            held.clear()
            return pa.RecordBatch.from_pydict({name: pa.array([v.tobytes()], pa.binary()) for name, v in values.items()})

        size = 0
        for batch in batches:
            at = 0
            ends = np.cumsum(batch.column("features").value_lengths().to_numpy(zero_copy_only=False))
            while at < len(batch):
                before = ends[at - 1] if at else 0
                upto = max(at + 1, int(np.searchsorted(ends, before + BLOCK_ENTRIES - size, side="right")))
                held.append(batch.slice(at, upto - at))
                size += int(ends[upto - 1] - before)
                at = upto
                if at < len(batch) or size >= BLOCK_ENTRIES:
                    yield block()
                    size = 0
        if held:
            yield block()

    # Dealt out, as a few files of many rows would keep a few cores busy.
    dealt = stored.repartition(max(1, -(-entries // BLOCK_ENTRIES)))
    kinds = "label binary, sizes binary, features binary, bins binary, scores binary"
    return materialize(dealt.mapInArrow(gather, kinds).withColumn("block", F.monotonically_increasing_id()), "blocks")


def hessians(rules: Rules, g: np.ndarray) -> np.ndarray:
    """Second sums' terms from the first ones, which hold all that is needed."""
    size = np.abs(g)
    return size * (1 - size) if rules.kind == GRADIENT else np.maximum(2 * size * (1 - size), 1e-16)


def _itself(part: int) -> int:
    return part


def _fit_in_rounds(rules: Rules, rounds: int, stored: DataFrame, start: list[float], entries: int) -> list[list[Tree]]:
    """All rounds on rows of any number; only cuts and leaves reach the driver.

    Values are kept twice, by rows and by features.  For each level, blocks of rows tell all
    slices of the features the gradient and node of their rows, some bytes for each row and not for
    each value, and a slice tells the best cut of every node among its features.
    """
    context = stored.sparkSession.sparkContext
    state = blocks_of(stored, entries, start)
    sizes = state.select("block", (F.length("sizes") / 4).cast("bigint").alias("rows")).orderBy("block").collect()
    offsets, total = {}, 0
    for row in sizes:
        offsets[row["block"]] = total
        total += row["rows"]
    slices = max(1, context.defaultParallelism, -(-entries // SLICE_ENTRIES))

    def read(row) -> tuple:
        data = Binned.of_block(row)
        labels = np.frombuffer(row["label"], np.int32)
        return offsets[row["block"]], data, labels, np.frombuffer(row["scores"]).reshape(data.rows, rules.labels)

    def by_feature(blocks: Iterator[tuple]) -> Iterator[tuple]:
        for offset, data, _, _ in blocks:
            part = data.feature % slices
            for i in range(slices):
                own = np.flatnonzero(part == i)
                yield i, (data.feature[own], data.bin[own].astype(np.int8), data.row[own] + np.int32(offset))

    def together(parts: Iterator[tuple]) -> Iterator[tuple]:
        found = list(parts)
        if found:
            number = found[0][0]
            feature, bins, row = (np.concatenate(x) for x in zip(*(p for _, p in found)))
            found.clear()
            yield number, Columns(feature, bins, row)

    keep = StorageLevel.MEMORY_AND_DISK
    blocks = state.rdd.map(read).persist(keep)
    dealt = blocks.mapPartitions(by_feature).partitionBy(slices, _itself)
    columns = dealt.mapPartitions(together, preservesPartitioning=True).persist(keep)
    columns.count()
    dealt._jrdd.rdd().cleanShuffleDependencies(False)
    trees: list[list[Tree]] = []
    recent: list[list[Tree]] = []

    def nodes_of(shared) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
        """(offset, gradients, nodes) of each block, by label."""

        def run(parts: Iterator[tuple]) -> Iterator[tuple]:
            done, grown, opened = shared.value
            for offset, data, labels, scores in parts:
                g, _ = gradients(rules, data.raised(scores, done), labels)
                node = np.stack([walk(grown[label], data.lookup, data.rows) for label in opened]).astype(np.int32)
                yield offset, np.ascontiguousarray(g[:, list(opened)].T), node

        return run

    def send(shared) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
        def run(parts: Iterator[tuple]) -> Iterator[tuple]:
            told = list(nodes_of(shared)(parts))
            for i in range(slices):
                yield i, told

        return run

    def choose(shared) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
        def run(parts: Iterator[tuple]) -> Iterator[tuple]:
            _, _, opened = shared.value
            held = None
            g, node = np.zeros((len(opened), total)), np.full((len(opened), total), -1, np.int32)
            for _, part in parts:
                if isinstance(part, Columns):
                    held = part
                    continue
                for offset, some_g, some_nodes in part:
                    place = slice(offset, offset + some_g.shape[1])
                    g[:, place], node[:, place] = some_g, some_nodes
            states = [open_state(node[i], nodes, g[i], hessians(rules, g[i])) for i, nodes in enumerate(opened.values())]
            found = held.best_cuts(rules, states) if held else [[None] * len(nodes) for nodes in opened.values()]
            for (tree, nodes), (totals, *_), cuts in zip(opened.items(), states, found):
                yield from ((tree, n, tuple(t), cut) for n, t, cut in zip(nodes, totals.tolist(), cuts))

        return run

    def leaves(shared) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
        def run(parts: Iterator[tuple]) -> Iterator[tuple]:
            _, _, opened = shared.value
            for offset, g, node in nodes_of(shared)(parts):
                for i, (tree, nodes) in enumerate(opened.items()):
                    totals, *_ = open_state(node[i], nodes, g[i], hessians(rules, g[i]))
                    yield from ((offset, tree, n, t) for n, t in zip(nodes, totals.tolist()))

        return run

    try:
        for _ in range(rounds):
            grown: list[Tree] = [[[0.0]] for _ in range(rules.labels)]
            opened = {label: [0] for label in range(rules.labels)}
            for level in range(rules.depth + 1):
                if not opened:
                    break
                shared = context.broadcast((recent, grown, opened))
                cuts: dict[int, dict] = {}
                if level == rules.depth:
                    for _, tree, node, part in sorted(blocks.mapPartitions(leaves(shared)).collect()):
                        sums, _ = cuts.setdefault(tree, {}).get(node, ((0.0, 0.0, 0.0), None))
                        cuts[tree][node] = (tuple(a + b for a, b in zip(sums, part)), None)
                else:
                    sent = blocks.mapPartitions(send(shared)).partitionBy(slices, _itself)
                    # Both sides are dealt by slice already, so only what the blocks tell moves.
                    found = columns.union(sent).mapPartitions(choose(shared)).collect()
                    sent._jrdd.rdd().cleanShuffleDependencies(False)
                    for tree, node, sums, cut in found:
                        of = cuts.setdefault(tree, {})
                        known, best = of.get(node, (sums, None))
                        if cut and (best is None or (-cut[0], cut[1]) < (-best[0], best[1])):
                            best = cut
                        of[node] = (known, best)
                shared.destroy()
                opened = {t: grow_level(rules, grown[t], c, level) for t, c in cuts.items()}
                opened = {t: nodes for t, nodes in sorted(opened.items()) if nodes}
            trees.append(grown)
            recent.append(grown)
            if len(recent) == REWRITE_ROUNDS:
                done, recent = recent, []
                raised = blocks.map(lambda b, done=done: (b[0], b[1], b[2], b[1].raised(b[3], done))).persist(keep)
                raised.count()
                blocks.unpersist()
                blocks = raised
    finally:
        blocks.unpersist()
        columns.unpersist()
        release(state)
    return trees


class _Settings(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vectors", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label numbers from 0", TypeConverters.toString)
    kind = Param(Params._dummy(), "kind", "gradient or newton", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "trees for each label", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "shrinkage of each tree", TypeConverters.toFloat)
    depth = Param(Params._dummy(), "depth", "deepest level", TypeConverters.toInt)
    localEntries = Param(Params._dummy(), "localEntries", "present values one task may hold", TypeConverters.toInt)


class BoostedTrees(Estimator, _Settings, DefaultParamsWritable, DefaultParamsReadable):
    """Multinomial boosting; labels are 0, 1, ... up to the largest seen."""

    @keyword_only
    def __init__(self, *, kind=GRADIENT, rounds=100, rate=0.1, depth=3, featuresCol="features", labelCol="label", localEntries=LOCAL_ENTRIES):
        super().__init__()
        self._set(**self._input_kwargs)
        for name, value in (
            ("kind", kind), ("rounds", rounds), ("rate", rate), ("depth", depth), ("featuresCol", featuresCol),
            ("labelCol", labelCol), ("localEntries", localEntries),
        ):
            self._set(**{name: value})

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        get = self.getOrDefault
        stored, cuts, entries = binned_rows(dataset, get(self.featuresCol), get(self.labelCol))
        counts = {r["label"]: r["count"] for r in stored.groupBy("label").count().collect()}
        labels = max(counts, default=0) + 1
        rules = Rules(get(self.kind), max(labels, 2), get(self.rate), get(self.depth))
        start = start_scores(rules, np.array([counts.get(i, 0) for i in range(rules.labels)]))
        if entries <= get(self.localEntries):
            trees = _fit_in_one_task(rules, get(self.rounds), stored, start)
        else:
            trees = _fit_in_rounds(rules, get(self.rounds), stored, start, entries)
        used = sorted({e[0] for round_ in trees for tree in round_ for e in tree if len(e) > 1})
        told = {"start": start, "trees": trees, "cuts": {str(f): cuts[f].tolist() for f in used}}
        return BoostedTreesModel(told=json.dumps(told), featuresCol=get(self.featuresCol))


class BoostedTreesModel(Model, DefaultParamsWritable, DefaultParamsReadable):
    """Adds ``probability`` (array) and ``prediction``."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vectors", TypeConverters.toString)
    told = Param(Params._dummy(), "told", "start scores, trees and cuts as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, told="", featuresCol="features"):
        super().__init__()
        self._set(told=told, featuresCol=featuresCol)

    def trees(self) -> list[list[Tree]]:
        return json.loads(self.getOrDefault(self.told))["trees"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast(json.loads(self.getOrDefault(self.told)))

        def score(frames):
            model = shared.value
            cuts = {int(f): np.array(c) for f, c in model["cuts"].items()}
            for indices, values in frames:
                features, bins = [], []
                for index, value in zip(indices, values):
                    kept = [(i, v) for i, v in zip(range(len(value)) if index is None else index, value) if v != 0 and i in cuts]
                    features.append([i for i, _ in kept])
                    bins.append([1 + int(np.searchsorted(cuts[i], v, side="left")) for i, v in kept])
                data = Binned(pd.Series(features), pd.Series(bins))
                start = np.tile(np.array(model["start"]), (data.rows, 1))
                yield pd.Series(list(softmax(data.raised(start, model["trees"]))))

        vector = F.unwrap_udt(self.getOrDefault(self.featuresCol))
        # Told apart by real types; annotations of this module are texts.
        score.__annotations__ = {"frames": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
        chances = F.pandas_udf(score, "array<double>")
        scored = dataset.withColumn("probability", chances(vector["indices"], vector["values"]))
        largest = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", largest.cast("double"))
