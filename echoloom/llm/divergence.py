"""Quality rules: how far a document's histograms lie from those of its language.

The Jensen-Shannon distance (square root of the divergence in bits, 0 to 1)
compares a document's shares of character classes and of common words with those
of its language, taken over the whole corpus.  Documents too short for a
histogram are not judged by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.llm.sampling import word_counts
from echoloom.operators.keyed import first_per_group
from echoloom.workspace import materialize, send_with_tasks

send_with_tasks(__name__)

COMMON_WORDS = 50  # most used words of a language that have a bin of their own
STEPS = 1000  # resolution of a median share
MOST_CHARACTER_DISTANCE = 0.20
MOST_WORD_DISTANCE = 0.50
FEWEST_CHARACTERS = 200  # in words
FEWEST_WORDS = 30
# Fixed rules of the base verdict.
BASE_WORDS, BASE_REPEATED_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\r\x0b\x0c"
CLASSES = ("lower", "upper", "digit", "stop", "mark", "symbol", "control", "other")


def _class_of_byte() -> np.ndarray:
    """Class number of every byte; -1 for space and the inner bytes of a character."""
    table = np.full(256, CLASSES.index("other"))
    table[:128] = CLASSES.index("mark")
    table[list(range(32)) + [127]] = CLASSES.index("control")
    table[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    table[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    table[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    table[list(b".,;:'\"()-?")] = CLASSES.index("stop")
    table[list(SYMBOLS)] = CLASSES.index("symbol")
    table[list(SPACE)] = -1
    table[0x80:0xC0] = -1
    return table


CLASS_OF_BYTE = _class_of_byte()


def byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256)


def class_counts(counts: np.ndarray) -> np.ndarray:
    """Characters of words by class, from the counts of bytes."""
    inside = CLASS_OF_BYTE >= 0
    return np.bincount(CLASS_OF_BYTE[inside], weights=counts[inside], minlength=len(CLASSES))


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 0 if either is empty."""
    if not a.sum() or not b.sum():
        return 0.0
    p, q = a / a.sum(), b / b.sum()
    mean = (p + q) / 2

    def relative(x: np.ndarray) -> float:
        some = x > 0
        return float((x[some] * np.log2(x[some] / mean[some])).sum())

    return float(np.sqrt(max(0.0, (relative(p) + relative(q)) / 2)))


@dataclass(frozen=True)
class Reference:
    """Histograms of one language."""

    classes: np.ndarray
    words: dict[bytes, int]  # place of each common word
    word_shares: np.ndarray  # of the common words, and of all others together


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by runs of ``window`` words that occur twice or more, exactly.

    Runs are numbered by pairing the numbers of shorter runs, so equal numbers
    mean equal words.
    """
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    one = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    if len(numbers) == n:
        return 0
    run, length = one, 1
    while length < window:
        step = min(length, window - length)
        # The run of `length` words at i and the one that ends `step` words later.
        pairs = run[: len(run) - step] * (n + 1) + run[step:]
        _, run = np.unique(pairs, return_inverse=True)
        length += step
    times = np.bincount(run)
    starts = np.flatnonzero(times[run] >= 2)
    covered = np.zeros(n + 1, dtype=np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes], counts: np.ndarray) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    characters = int(class_counts(counts).sum())
    symbols = int(counts[list(SYMBOLS)].sum())
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return characters, symbols, len(lines) - len(set(lines)), repeated_words(words)


def references(
    docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS
) -> dict[str | None, Reference]:
    """Histograms of every language over all its documents, and of the whole corpus (None).

    The share of a character class is the median over documents, to a thousandth,
    so that even much junk does not shift it; the share of a common word is its
    part of all words.  Counts are added up on the executors; at most a thousand
    rows per language and class and ``common`` words per language come to the
    driver.  Documents without a language count for the whole corpus only.
    """

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str | None, np.ndarray] = {}
        kinds = np.arange(len(CLASSES))
        for batch in batches:
            for group, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = class_counts(byte_counts(value or b""))
                if counts.sum() >= FEWEST_CHARACTERS:
                    found = sums.setdefault(group, np.zeros((len(CLASSES), STEPS + 1), np.int64))
                    found[kinds, (counts / counts.sum() * STEPS).astype(np.int64)] += 1
        rows = [
            (g, int(c), int(s), int(found[c, s]))
            for g, found in sums.items()
            for c, s in zip(*np.nonzero(found))
        ]
        columns = list(zip(*rows)) if rows else [(), (), (), ()]
        types = [pa.string(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, types)], ["lang", "class", "step", "n"]
        )

    narrow = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("_text"))
    by_class = (
        narrow.mapInArrow(classes, "lang string, class int, step int, n bigint")
        .groupBy("lang", "class", "step")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    named = narrow.withColumnRenamed("_text", "text")
    counted = materialize(word_counts(named, "text", "lang"), "words")
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    order = [F.col("n").desc(), F.col("word")]
    best = first_per_group(counted.filter("lang IS NOT NULL"), ["lang"], order, common).collect()
    overall = (
        counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(*order).limit(common).collect()
    )
    found: dict[str | None, Reference] = {}
    for name in {*totals, None}:
        steps = np.zeros((len(CLASSES), STEPS + 1), np.int64)
        for r in by_class:
            if name is None or r["lang"] == name:
                steps[r["class"], r["step"]] += r["n"]
        below = np.cumsum(steps, axis=1)
        # The step that half of the documents do not pass; none if there are no documents.
        histogram = (below < (below[:, -1:] + 1) // 2).sum(axis=1) / STEPS
        words = sorted(
            ((r["n"], bytes(r["word"])) for r in (overall if name is None else best)
             if name is None or r["lang"] == name),
            key=lambda w: (-w[0], w[1]),
        )
        total = sum(totals.values()) if name is None else totals[name]
        shares = np.array([n for n, _ in words] + [total - sum(n for n, _ in words)], dtype=float)
        found[name] = Reference(histogram, {w: i for i, (_, w) in enumerate(words)}, shares)
    return found


def judge(
    docs: DataFrame,
    known: dict[str | None, Reference],
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    most_character_distance: float = MOST_CHARACTER_DISTANCE,
    most_word_distance: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    character_distance, word_distance, kept) of every whole text.

    Base rules come first: fewer than ten words, or over a fifth of the words in
    repeated runs of five.  Then both distances to the document's language must
    be small; a document with fewer than ``FEWEST_CHARACTERS`` characters or
    ``FEWEST_WORDS`` words passes that test unseen (its distance is null).  A
    document without a language, or with one that has no reference, is compared
    with the whole corpus.  Null texts have no words and fail the base rules.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows = []
            for group, value in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                value = value or b""
                reference = known.get(group) or known[None]
                words, counts = value.split(), byte_counts(value)
                characters, symbols, lines, repeated = base_counts(value, words, counts)
                n = len(words)
                failed = n < BASE_WORDS or 100 * repeated > BASE_REPEATED_PERCENT * n
                by_class = by_word = None
                if characters >= FEWEST_CHARACTERS:
                    by_class = distance(class_counts(counts), reference.classes)
                if n >= FEWEST_WORDS:
                    place, rest = reference.words, len(reference.words)
                    bins = [place.get(w, rest) for w in value.lower().split()]
                    histogram = np.bincount(bins, minlength=rest + 1)
                    by_word = distance(histogram, reference.word_shares)
                kept = (
                    not failed
                    and (by_class or 0.0) <= most_character_distance
                    and (by_word or 0.0) <= most_word_distance
                )
                rows.append((n, characters, symbols, lines, repeated, failed, by_class, by_word, kept))
            columns = list(zip(*rows)) if rows else [()] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.float64()] * 2 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names
            )

    names = [
        key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "character_distance", "word_distance", "kept",
    ]
    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(
        F.col(key), F.col(lang).cast("string").alias("_lang"), F.col(text).cast("binary").alias("_text")
    )
    return narrow.mapInArrow(
        scan,
        f"`{key}` {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, character_distance double, word_distance double, "
        "kept boolean",
    )
