"""Toxicity by a factorization machine over hashed terms (Rendle 2010).

Besides a weight per term, each term has a short vector, and the product of two
terms' vectors is the weight of both occurring in one text: an insult beside the
mention of a group counts for more than the two alone.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.sampling import labelled_sample
from echoloom.workspace import send_with_tasks

send_with_tasks(__name__)

SAMPLE_ROWS = 8000  # labelled rows that the model is fitted on, at most
DIMENSIONS = 1 << 18
FACTORS = 4
FEWEST_TEXTS = 5  # texts of the sample that a term occurs in before it is learned
# Chi-squared of a term and the label, one degree of freedom, before it is learned
# (about one in 20,000 unrelated terms passes).
LEAST_DEPENDENCE = 16.0
# The same of a pair beyond what its two terms tell alone: a pair of terms without link to
# the label passes about once in 10**12.
LEAST_INTERACTION = 49.0
PAIR_TERMS = 4096  # most frequent terms of the sample that are tried in pairs
PAIR_BLOCK = 1024
ROUNDS = 30
RATE = 0.2
DECAY = 1e-4
STEM = 4  # letters that stand for the words beginning with them; like ROUNDS by least log loss in folds of allowed rows
TERMS_HELD = 300_000
MARKS = string.punctuation.encode()


class Terms(dict):
    """Hashed numbers of each word seen, lower-cased and without marks around it, and of its stem."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= TERMS_HELD:
            self.clear()
        term = word.strip(MARKS).decode("utf-8", "replace").lower()
        numbers = (zlib.crc32(term.encode()) % DIMENSIONS,) if term else ()
        if len(term) > STEM:
            numbers += (zlib.crc32(f"{term[:STEM]}*".encode()) % DIMENSIONS,)
        if len(word) <= 64:
            self[word] = numbers
        return numbers


def hashed_terms(text: bytes, terms: Terms) -> np.ndarray:
    """Sorted numbers of the terms that occur in a text."""
    found: set[int] = set()
    for word in set(text.split()):
        found.update(terms[word])
    return np.array(sorted(found), dtype=np.int64)


@dataclass(frozen=True)
class FactorModel:
    numbers: np.ndarray  # of the terms that matter, sorted
    weights: np.ndarray
    factors: np.ndarray  # (terms, FACTORS)
    bias: float

    def margin(self, found: np.ndarray) -> float:
        """Bias, weights, and half the difference of squared sums and summed squares."""
        if not len(self.numbers) or not len(found):
            return self.bias
        place = np.searchsorted(self.numbers, found)
        place = place[self.numbers[np.minimum(place, len(self.numbers) - 1)] == found]
        v = self.factors[place]
        return float(
            self.bias + self.weights[place].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
        )


def interacting(rows: list[np.ndarray], y: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Which of ``terms`` make up a pair that tells more of the label than both alone.

    Of every pair the labels of the texts holding both are compared with those that
    the two terms let expect.  Repeated texts count once.  The pairs are products of
    blocks of a table of texts and terms.
    """
    seen: dict[bytes, int] = {}
    for i, row in enumerate(rows):
        seen.setdefault(row.tobytes() + bytes([y[i]]), i)
    once = sorted(seen.values())
    texts = np.zeros((len(once), len(terms)), dtype=np.float32)
    for at, i in enumerate(once):
        texts[at, np.flatnonzero(np.isin(terms, rows[i], assume_unique=True))] = 1
    rest = y[once] - y[once].mean()
    spread = max(float((rest**2).mean()), 1e-9)
    alone = (rest @ texts) / np.maximum(texts.sum(0), 1)
    found = np.zeros(len(terms), dtype=bool)
    weighed = texts * rest[:, None].astype(np.float32)
    for a in range(0, len(terms), PAIR_BLOCK):
        for b in range(a, len(terms), PAIR_BLOCK):
            left, right = slice(a, a + PAIR_BLOCK), slice(b, b + PAIR_BLOCK)
            both = texts[:, left].T @ texts[:, right]
            excess = weighed[:, left].T @ texts[:, right] - both * (alone[left, None] + alone[None, right])
            passes = excess**2 >= LEAST_INTERACTION * spread * np.maximum(both, 1)
            if a == b:
                np.fill_diagonal(passes, False)
            found[left] |= passes.any(1)
            found[right] |= passes.any(0)
    return found


def fit(rows: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> FactorModel:
    """Logistic loss by stochastic gradients with a step size per parameter.

    Terms are learned that depend on the label, alone or in a pair.  With one class only, that class always wins.
    """
    y = np.array(labels, dtype=np.int64)
    positive = int(y.sum())
    if positive in (0, len(y)):
        none = np.zeros(0)
        sure = 0.0 if not len(y) else (5.0 if positive else -5.0)
        return FactorModel(none.astype(np.int64), none, np.zeros((0, FACTORS)), sure)
    texts = np.bincount(np.concatenate(rows), minlength=DIMENSIONS)
    toxic = np.bincount(
        np.concatenate([r for r, label in zip(rows, y) if label == 1]), minlength=DIMENSIONS
    )
    share = positive / len(y)
    expected = texts * share
    spread = np.maximum(expected * (1 - share) * (1 - texts / len(y)), 1e-9)
    dependence = (toxic - expected) ** 2 / spread
    chosen = (texts >= FEWEST_TEXTS) & (dependence >= LEAST_DEPENDENCE)
    frequent = np.argsort(-texts, kind="stable")[:PAIR_TERMS]
    frequent = np.sort(frequent[texts[frequent] >= FEWEST_TEXTS])
    chosen[frequent[interacting(rows, y, frequent)]] = True
    numbers = np.flatnonzero(chosen)
    place = np.full(DIMENSIONS, -1, dtype=np.int64)
    place[numbers] = np.arange(len(numbers))
    active = [p[p >= 0] for p in (place[r] for r in rows)]
    generator = np.random.default_rng(0)
    w, v = np.zeros(len(numbers)), generator.normal(0, 0.01, (len(numbers), FACTORS))
    bias = 0.0
    seen_w, seen_v, seen_b = np.full(len(numbers), 1e-3), np.full(v.shape, 1e-3), 1e-3
    importance = np.where(y == 1, 0.5 * len(y) / positive, 0.5 * len(y) / (len(y) - positive))
    for _ in range(rounds):
        for i in generator.permutation(len(y)):
            at = active[i]
            vi = v[at]
            total = vi.sum(0)
            margin = bias + w[at].sum() + 0.5 * ((total**2).sum() - (vi**2).sum())
            slope = importance[i] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[i])
            if abs(slope) < 1e-3:
                continue
            step_w = slope + DECAY * w[at]
            step_v = slope * (total - vi) + DECAY * vi
            seen_w[at] += step_w**2
            seen_v[at] += step_v**2
            seen_b += slope**2
            w[at] -= RATE * step_w / np.sqrt(seen_w[at])
            v[at] = vi - RATE * step_v / np.sqrt(seen_v[at])
            bias -= RATE * slope / np.sqrt(seen_b)
    return FactorModel(numbers, w, v, float(bias))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable,
    label: str = "toxic",
    key: str = "doc_id",
    text: str = "text",
    rows: int = SAMPLE_ROWS,
) -> FactorModel:
    """Fit to at most ``rows`` labelled documents, in one task; the terms kept come to the driver."""
    sample = labelled_sample(docs, labels, label, usable, rows, key, text)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            found = [hashed_terms(t, terms).astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)],
                ["_key", "_found", "_label"],
            )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = []
        for batch in batches:
            gathered += zip(
                batch.column(0).to_pylist(),
                (np.asarray(v.values, dtype=np.int64) for v in batch.column(1)),
                batch.column(2).to_pylist(),
            )
        gathered.sort(key=lambda row: row[0])
        model = fit([r[1] for r in gathered], [r[2] for r in gathered])
        parts = (model.numbers, model.weights, model.factors)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([p.tobytes()]) for p in parts), pa.array([model.bias])],
            ["numbers", "weights", "factors", "bias"],
        )

    narrow = sample.select(
        F.col(key).cast("string").alias("_key"), F.col("_text").cast("binary"), "_label"
    )
    features = narrow.mapInArrow(extract, "_key string, _found array<int>, _label int")
    fitted = (
        features.repartition(1)
        .mapInArrow(train, "numbers binary, weights binary, factors binary, bias double")
        .collect()
    )
    if not fitted:
        return fit([], [])
    row = fitted[0]
    return FactorModel(
        np.frombuffer(row["numbers"], np.int64),
        np.frombuffer(row["weights"]),
        np.frombuffer(row["factors"]).reshape(-1, FACTORS),
        row["bias"],
    )


def score_toxicity(
    docs: DataFrame, model: FactorModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, score, predicted) of every whole text.

    Null texts count as empty; a text without known terms has the score of the
    bias alone.  Repeated rows get equal scores, an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.numbers, model.weights, model.factors, model.bias))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, terms = FactorModel(*shared.value), Terms()
        for batch in batches:
            margins = np.array(
                [model.margin(hashed_terms(t or b"", terms)) for t in batch.column(1).to_pylist()]
            )
            scores = 1 / (1 + np.exp(-np.clip(margins, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                [key, "score", "predicted"],
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    return narrow.mapInArrow(scan, f"`{key}` {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: FactorModel, text: str = "text") -> DataFrame:
    """The rows that the model does not reject, with all their columns.

    Every row is decided where it is read, by its own whole text, so nothing is
    shuffled and null or repeated keys need no care.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.numbers, model.weights, model.factors, model.bias))
    place = docs.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, terms = FactorModel(*shared.value), Terms()
        for batch in batches:
            clean = [
                model.margin(hashed_terms((t or "").encode(), terms)) < 0
                for t in batch.column(place).to_pylist()
            ]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)
