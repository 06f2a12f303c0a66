"""Quality classifier: a support vector machine on naive Bayes features.

N-gram indicators are scaled by the log ratio of their class counts, and a linear
model with hinge loss is fitted to them (Wang and Manning 2012) by dual
coordinate descent (Hsieh et al. 2008).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.sampling import labelled_sample
from echoloom.workspace import send_with_tasks

send_with_tasks(__name__)

# Labelled rows that the model is fitted on, at most.
SAMPLE_ROWS = 8000
BYTE_DIMENSIONS = 1 << 16  # hashed three-byte grams
CLASSES = 16  # shapes of a word
SHAPE_DIMENSIONS = CLASSES + CLASSES**2 + CLASSES**3  # one to three shapes in a row
DIMENSIONS = BYTE_DIMENSIONS + SHAPE_DIMENSIONS
SYMBOLS = frozenset(b"#*$%&|<>")
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 30
SHAPES_HELD = 200_000


def _shape(word: bytes) -> int:
    lower = any(97 <= b <= 122 or b >= 128 for b in word)
    upper = any(65 <= b <= 90 for b in word)
    return lower | upper << 1 | (not SYMBOLS.isdisjoint(word)) << 2


class Shapes(dict):
    """Shape of each word seen: letters of either case, symbols."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= SHAPES_HELD:
            self.clear()
        found = _shape(word)
        if len(word) <= 64:
            self[word] = found
        return found


def indicators(text: bytes, shapes: Shapes) -> np.ndarray:
    """Sorted numbers of the n-grams that occur in a text; none in an empty one.

    N-grams are runs of three bytes, hashed, and runs of one to three word
    shapes, where a shape also tells whether the word repeats the one before.
    """
    seen = np.zeros(DIMENSIONS, dtype=bool)
    raw = np.frombuffer(text, dtype=np.uint8)
    if len(raw) >= 3:
        grams = raw[:-2].astype(np.uint32) << 16
        grams |= raw[1:-1].astype(np.uint32) << 8
        grams |= raw[2:]
        grams *= np.uint32(2654435761)
        seen[grams >> 16] = True
    words = text.split()
    if words:
        one = np.array([shapes[w] for w in words], dtype=np.int64)
        one[1:] |= np.array([a == b for a, b in zip(words, words[1:])], dtype=np.int64) << 3
        at = BYTE_DIMENSIONS
        seen[at + one] = True
        two = one[:-1] * CLASSES + one[1:]
        seen[at + CLASSES + two] = True
        three = two[:-1] * CLASSES + one[2:]
        seen[at + CLASSES + CLASSES**2 + three] = True
    return np.flatnonzero(seen)


@dataclass(frozen=True)
class LinearModel:
    weights: np.ndarray  # of each indicator, float32
    bias: float

    def margin(self, found: np.ndarray) -> float:
        if not len(found):
            return self.bias
        return float(self.weights[found].sum(dtype=np.float64)) / math.sqrt(len(found)) + self.bias


def fit(rows: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> LinearModel:
    """Fit to sorted indicator lists.  With one class only, that class always wins."""
    y = np.where(np.array(labels, dtype=np.int64) == 1, 1.0, -1.0)
    positive = int((y > 0).sum())
    if positive in (0, len(y)):
        return LinearModel(np.zeros(DIMENSIONS, np.float32), float(np.sign(y.sum())))
    counts = np.full((2, DIMENSIONS), SMOOTHING)
    for found, sign in zip(rows, y):
        counts[int(sign > 0), found] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = [ratio[f] / math.sqrt(max(1, len(f))) for f in rows]
    # Both classes cost the same in total.
    cost = np.where(y > 0, 0.5 * len(y) / positive, 0.5 * len(y) / (len(y) - positive)) * COST
    own = np.array([(v**2).sum() + 1.0 for v in values])
    weights, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(y))
    generator = np.random.default_rng(0)
    for _ in range(rounds):
        largest = 0.0
        for i in generator.permutation(len(y)):
            found, value = rows[i], values[i]
            slope = y[i] * (weights[found] @ value + bias) - 1
            # At an end of its range a multiplier moves inwards only.
            if (alpha[i] == 0 and slope >= 0) or (alpha[i] == cost[i] and slope <= 0):
                continue
            largest = max(largest, abs(slope))
            before = alpha[i]
            alpha[i] = min(cost[i], max(0.0, before - slope / own[i]))
            step = (alpha[i] - before) * y[i]
            weights[found] += step * value
            bias += step
        if largest < 0.01:
            break
    return LinearModel((weights * ratio).astype(np.float32), bias)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    usable,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> LinearModel:
    """Fit to at most ``rows`` labelled documents, in one task; the weights come to the driver."""
    sample = labelled_sample(docs, labels, label, usable, rows, key, text)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            found = [indicators(t, shapes).astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)],
                ["_key", "_found", "_label"],
            )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = []
        for batch in batches:
            gathered += zip(
                batch.column(0).to_pylist(),
                (np.asarray(v.values) for v in batch.column(1)),
                batch.column(2).to_pylist(),
            )
        gathered.sort(key=lambda row: row[0])
        model = fit([r[1] for r in gathered], [r[2] for r in gathered])
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.weights.tobytes()]), pa.array([model.bias])], ["weights", "bias"]
        )

    narrow = sample.select(
        F.col(key).cast("string").alias("_key"), F.col("_text").cast("binary"), "_label"
    )
    features = narrow.mapInArrow(extract, "_key string, _found array<int>, _label int")
    fitted = features.repartition(1).mapInArrow(train, "weights binary, bias double").collect()
    if not fitted:
        return LinearModel(np.zeros(DIMENSIONS, np.float32), 0.0)
    return LinearModel(np.frombuffer(fitted[0]["weights"], np.float32), fitted[0]["bias"])


def score_quality(
    docs: DataFrame, model: LinearModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score, predicted) of every whole text; the score is 0.5 on the border.

    Null texts count as empty; an empty text has the score of the bias alone.
    Repeated rows get equal scores, an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, shapes = shared.value, Shapes()
        for batch in batches:
            margins = np.array(
                [model.margin(indicators(t or b"", shapes)) for t in batch.column(1).to_pylist()]
            )
            scores = 1 / (1 + np.exp(-2 * np.clip(margins, -15, 15)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [key, "score", "predicted"],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    return narrow.mapInArrow(scan, f"`{key}` {kind}, score double, predicted int")
