"""Terms of one or more words, counted on whole batches of tokenised texts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.functions.text import WORD_CHARACTERS
from echoloom.workspace import materialize, send_with_tasks

send_with_tasks(__name__)

BUCKETS = 1 << 20  # that runs of words are first counted in
PARTS = 16  # of the buckets, each added up on its own
PIECE = 1 << 22  # bytes of text that are cut into words at once, or one text


@cache
def word_characters(spark: SparkSession) -> np.ndarray:
    """Which code points Spark's patterns take for characters of words."""
    known = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    lines = ["".join(map(chr, known[i : i + 4096])) for i in range(0, len(known), 4096)]
    kept = F.regexp_replace("line", f"[^{WORD_CHARACTERS}]", "").alias("kept")
    found = np.zeros(0x110000, bool)
    for row in spark.createDataFrame(pa.table({"line": lines})).select(kept).collect():
        found[np.frombuffer(row["kept"].encode("utf-32-le"), np.uint32)] = True
    return found


def _pieces(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(starts) - 1:
        last = max(int(np.searchsorted(starts, starts[first] + PIECE, "right")) - 1, first + 1)
        yield first, last
        first = last


def _mark(piece: np.ndarray, inside: np.ndarray, characters: np.ndarray) -> None:
    """Say of every byte of a character beyond ASCII whether it is one of a word."""
    for size, lead, last, bits in ((2, 0xC2, 0xDF, 0x1F), (3, 0xE0, 0xEF, 0x0F), (4, 0xF0, 0xF4, 0x07)):
        at = np.flatnonzero((piece >= lead) & (piece <= last))
        code = (piece[at] & bits).astype(np.int64)
        for k in range(1, size):
            code = code << 6 | piece[at + k] & 0x3F
        for k in range(size):
            inside[at + k] = characters[code]


def split_words(texts: pa.Array, characters: np.ndarray) -> pa.ListArray:
    """The words of lower-case texts as ``tokenize`` finds them: runs of two or more of these characters."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, content = texts.buffers()
    starts = np.frombuffer(places, np.int64)[texts.offset :][: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    content = np.frombuffer(content or b"", np.uint8)
    ascii_words = np.zeros(256, bool)
    ascii_words[:128] = characters[:128]
    width = np.ones(256, np.int64)  # bytes of a character, by its first one
    width[0xC0:], width[0xE0:], width[0xF0:] = 2, 3, 4
    rows, sizes, parts = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.zeros(0, np.uint8)]
    seen = 0
    for first, last in _pieces(starts):
        piece = content[starts[first] : starts[last]]
        own = starts[first : last + 1] - starts[first]
        inside = ascii_words[piece]
        _mark(piece, inside, characters)
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        # Words do not go on from text to text.
        borders = own[(own > 0) & (own < len(piece))]
        begins[borders], ends[borders - 1] = inside[borders], inside[borders - 1]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        single = ends - begins == width[piece[begins]]
        for k in range(4):
            byte = begins[single] + k
            inside[byte[byte < ends[single]]] = False
        begins, ends = begins[~single], ends[~single]
        rows.append(np.searchsorted(begins, own[1:]) + seen)
        seen += len(begins)
        sizes.append(ends - begins)
        parts.append(piece[inside])
    buffers = [None, pa.py_buffer(np.cumsum(np.concatenate(sizes))), pa.py_buffer(np.concatenate(parts))]
    words = pa.Array.from_buffers(pa.large_string(), seen, buffers).cast(pa.string())
    return pa.ListArray.from_arrays(pa.array(np.concatenate(rows), pa.int32()), words)


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The row of each word, and the words of all rows."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten()


def _coded(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def run_buckets(row: np.ndarray, words: pa.Array, codes: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Where the runs of 2, 3, ... words begin, and each one's bucket of ``BUCKETS``."""
    hashed = np.array([zlib.crc32(w) for w in words.cast(pa.binary()).to_pylist()] or [0], np.uint64)[codes]
    whole = hashed.copy()
    for n in range(2, longest + 1):
        inside = np.flatnonzero(row[: max(len(row) - n + 1, 0)] == row[n - 1 :])
        runs = whole[inside]
        runs *= np.uint64(0x9E3779B97F4A7C15)
        runs ^= hashed[inside + n - 1]
        if n < longest:
            whole[inside] = runs
        runs *= np.uint64(0xBF58476D1CE4E5B9)
        runs ^= runs >> np.uint64(31)
        runs *= np.uint64(0x94D049BB133111EB)
        runs >>= np.uint64(40)
        yield inside, (runs % np.uint64(BUCKETS)).view(np.int64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the place of each key among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place


def _documents(at: np.ndarray, ids: np.ndarray, rows: int, kinds: int) -> np.ndarray:
    """In how many rows each of so many kinds of ids stands."""
    cells = np.sort(ids * rows + at)
    new = np.ones(len(cells), bool)
    new[1:] = cells[1:] != cells[:-1]
    return np.bincount(cells[new] // max(rows, 1), minlength=kinds)


def term_uses(
    lists: pa.Array, longest: int, shortest: int = 1, passing: np.ndarray | None = None
) -> list[pa.RecordBatch]:
    """Uses and containing texts of each run of ``shortest`` to ``longest`` words of a batch of texts.

    With ``passing`` only runs of several words whose buckets pass, as those of all shorter runs they begin with.
    """
    row, flat = _flat(lists)
    return _term_uses(row, *_coded(flat), len(lists), longest, shortest, passing)


def _term_uses(
    row: np.ndarray, words: pa.Array, codes: np.ndarray, rows: int,
    longest: int, shortest: int = 1, passing: np.ndarray | None = None,
) -> list[pa.RecordBatch]:
    buckets = run_buckets(row, words, codes, longest) if passing is not None else None
    alive = np.ones(len(row), bool)
    names, ids = words, codes
    found = []
    for n in range(1, longest + 1):
        at = row[: len(ids)]
        if n > 1:
            if buckets is None:
                inside = np.flatnonzero(row[: max(len(row) - n + 1, 0)] == row[n - 1 :])
            else:
                inside, bucket = next(buckets)
                inside = inside[alive[inside] & passing[bucket]]
                alive[:] = False
                alive[inside] = True
            # Ids of the runs one shorter stand where those begin; other places are not looked at.
            keys = before[inside] * max(len(words), 1) + codes[inside + n - 1]
            runs, ids = _distinct(keys)
            head, last = (pa.array(x) for x in (runs // max(len(words), 1), runs % max(len(words), 1)))
            names = pc.binary_join_element_wise(names.take(head), words.take(last), " ")
            at = row[inside]
            before = np.zeros(len(row), np.int64)
            before[inside] = ids
        else:
            before = ids
        if n < shortest:
            continue
        uses, documents = np.bincount(ids, minlength=len(names)), _documents(at, ids, rows, len(names))
        found.append(pa.RecordBatch.from_arrays([names, pa.array(uses), pa.array(documents)], ["term", "uses", "documents"]))
    return pa.Table.from_batches(found).combine_chunks().to_batches()


def counted_terms(texts: DataFrame, words: str, longest: int) -> DataFrame:
    """(term, uses, documents) of every batch of a column of words, to be added up by term."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from term_uses(batch.column(0), longest)

    return texts.select(words).mapInArrow(scan, "term string, uses bigint, documents bigint")


def frequent_terms(texts: DataFrame, words: str, longest: int, most: int) -> DataFrame:
    """(term, uses, documents) of all terms that can be among the ``most`` most used ones, and of more words.

    A run of words among them is used at least as often as the ``most``-th word.  Runs are first
    counted in buckets, which hold no less than each of their runs, so only runs in full
    buckets have to be sent.  Buckets stay few, as the least use grows with the texts.
    ``words`` holds lists of words, or lower-case texts, whose words are those of ``tokenize``.
    """
    spark = texts.sparkSession
    whole = texts.schema[words].dataType.typeName() == "string"
    characters = spark.sparkContext.broadcast(word_characters(spark)) if whole else None

    def coded(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray, int]:
        lists = split_words(batch.column(0), characters.value) if whole else batch.column(0)
        row, flat = _flat(lists)
        return row, *_coded(flat), len(lists)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = np.zeros(BUCKETS, np.int64)
        kinds = pa.schema([("term", pa.string()), ("uses", pa.int64()), ("documents", pa.int64()), ("part", pa.int32()), ("buckets", pa.binary())])
        for batch in batches:
            row, names, codes, rows = coded(batch)
            for _, bucket in run_buckets(row, names, codes, longest):
                buckets += np.bincount(bucket, minlength=BUCKETS)
            for found in _term_uses(row, names, codes, rows, 1):
                lacking = [pa.nulls(len(found), pa.int32()), pa.nulls(len(found), pa.binary())]
                yield pa.RecordBatch.from_arrays([*found.columns, *lacking], schema=kinds)
        if longest > 1 and buckets.any():
            parts = [x.tobytes() for x in np.split(buckets, PARTS)]
            lacking = [pa.nulls(PARTS, kind) for kind in (pa.string(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*lacking, pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], schema=kinds)

    kinds = "term string, uses bigint, documents bigint, part int, buckets binary"
    texts = texts.select(words)
    first = materialize(texts.mapInArrow(scan, kinds), "words")
    sums = [F.sum(c).alias(c) for c in ("uses", "documents")]
    counted = first.filter("term IS NOT NULL").groupBy("term").agg(*sums)
    if longest == 1:
        return counted
    counted = materialize(counted, "counted")
    used = counted.orderBy(F.col("uses").desc()).limit(most).agg(F.count("uses").alias("n"), F.min("uses").alias("least")).first()
    least = used["least"] if used["n"] == most else 1

    def added(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.int64) for x in table.column("buckets").to_pylist()], axis=0)
        return pa.table({"part": table.column("part").take(pa.array([0])), "passing": pa.array([(total >= least).tobytes()], pa.binary())})

    parts = first.filter("part IS NOT NULL").select("part", "buckets").groupBy("part")
    found = {r["part"]: r["passing"] for r in parts.applyInArrow(added, "part int, passing binary").collect()}
    passing = np.concatenate([np.frombuffer(found[i], bool) for i in range(PARTS)]) if found else np.zeros(BUCKETS, bool)
    shared = spark.sparkContext.broadcast(passing)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _term_uses(*coded(batch), longest, 2, shared.value)

    longer = texts.mapInArrow(runs, "term string, uses bigint, documents bigint").groupBy("term").agg(*sums)
    return counted.unionByName(longer)


class Lookup:
    """The places of terms in a vocabulary, found word by word."""

    def __init__(self, vocabulary: list[str]):
        split = [term.split(" ") for term in vocabulary]
        self.size = len(vocabulary)
        self.words = sorted({w for term in split for w in term})
        number = {w: i for i, w in enumerate(self.words)}
        self.value_set = pa.array(self.words, pa.string())
        # Of each length: sorted keys (number of the run one shorter, word), and the term's place or -1.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        known = {(i,): i for i in range(len(self.words))}
        place = {tuple(number[w] for w in term): i for i, term in enumerate(split)}
        self.single = np.array([place.get((i,), -1) for i in range(len(self.words))] or [-1], np.int64)
        for n in range(2, max(map(len, split), default=1) + 1):
            runs = sorted({run[:n] for run in place if len(run) >= n}, key=lambda run: (known[run[:-1]], run[-1]))
            keys = np.array([known[run[:-1]] * len(self.words) + run[-1] for run in runs], np.int64)
            self.levels.append((keys, np.array([place.get(run, -1) for run in runs], np.int64)))
            known = {run: i for i, run in enumerate(runs)}

    def counts(self, lists: pa.Array) -> pa.StructArray:
        """Sparse vectors of the uses of each term of the vocabulary."""
        row, flat = _flat(lists)
        number = pc.fill_null(pc.index_in(flat, value_set=self.value_set), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.flatnonzero(number >= 0)
        run = number[at]
        found = [(row[at], self.single[run])]
        for n, (keys, places) in enumerate(self.levels, 2):
            last = at + n - 1
            fits = last < len(row)
            at, run, last = at[fits], run[fits], last[fits]
            fits = (row[last] == row[at]) & (number[last] >= 0)
            at, run, last = at[fits], run[fits], last[fits]
            key = run * len(self.words) + number[last]
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            fits = keys[place] == key
            at, run = at[fits], place[fits]
            found.append((row[at], places[run]))
        rows, terms = (np.concatenate(x) for x in zip(*found))
        kept = terms >= 0
        found = np.sort(rows[kept] * max(self.size, 1) + terms[kept])
        new = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])[: len(found)])
        cells, uses = found[new], np.diff(new, append=len(found))
        ends = np.searchsorted(cells, np.arange(len(lists) + 1) * max(self.size, 1))
        offsets = pa.array(ends, pa.int32())
        indices = pa.ListArray.from_arrays(offsets, pa.array(cells % max(self.size, 1), pa.int32()))
        values = pa.ListArray.from_arrays(offsets, pa.array(uses, pa.float64()))
        sparse, size = np.zeros(len(lists), np.int8), np.full(len(lists), self.size, np.int32)
        return pa.StructArray.from_arrays([pa.array(sparse), pa.array(size), indices, values], ["type", "size", "indices", "values"])


class TermCounts(Transformer, DefaultParamsWritable, DefaultParamsReadable):
    """Adds a vector of how often a text uses each term of a vocabulary; no text, no uses."""

    inputCol = Param(Params._dummy(), "inputCol", "texts", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vectors of counts", TypeConverters.toString)
    vocabulary = Param(Params._dummy(), "vocabulary", "terms, words joined by a space", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol="content", outputCol="counts", vocabulary=()):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, vocabulary=list(vocabulary))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        shared = spark.sparkContext.broadcast((self.getOrDefault(self.vocabulary), word_characters(spark)))

        def count(batches):
            vocabulary, characters = shared.value
            lookup = Lookup(vocabulary)
            for texts in batches:
                yield lookup.counts(split_words(texts, characters))

        # Told apart by real types; annotations of this module are texts.
        count.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
        counted = F.arrow_udf(count, VectorUDT())
        return dataset.withColumn(self.getOrDefault(self.outputCol), counted(F.lower(F.col(f"`{self.getOrDefault(self.inputCol)}`"))))
