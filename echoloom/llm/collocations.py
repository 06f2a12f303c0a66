"""Phrases whose words stand together more often than their parts would by chance.

Every place in a piece of text is a pointer to a suffix of words.  Suffixes are routed
by their leading words, so that all that begin alike meet in one task, and are ordered
there by multikey three-way quicksort up to the greatest phrase length: the size of a
partition of equal words is the count of the phrase that its suffixes begin with.  A
partition too small for a frequent phrase is abandoned, and so is, before routing, a
place where two words meet that cannot be a frequent pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.operators.keyed import counted_lookup_join, first_per_group, lookup_join
from echoloom.workspace import materialize, send_with_tasks

send_with_tasks(__name__)

# Phrase lengths in words, the least count, phrases listed and the language of null.
SHORTEST, LONGEST = 2, 5
LEAST = 100
LISTED = 2000
NO_LANGUAGE = "und"
# Bytes that end a piece, and bytes between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

SEGMENT_BYTES = 500_000  # of text looked at together
HASHED_BYTES = 64  # of a word; longer ones are hashed one by one
PAIRS_HELD = 1_000_000  # counted by a task before it passes them on
SORTED_TOGETHER = 400_000  # suffixes of whole routes that are sorted in one go
# Sizes of the two filters, in bits of an address: a few bits for each entry, 32 MB at most.
# Fuller filters let more through; what passes is counted exactly all the same.
FEWEST_BITS, MOST_BITS = 20, 28
SLOTS_PER_WORD = 16
PLACES_PER_SLOT = 4

WORD, BLANK, END = 0, 1, 2


# --- words as numbers --------------------------------------------------------


def _lowered() -> bytes:
    """Byte table: A-Z in lower case, every piece end a line feed, every blank a space."""
    table = bytearray(range(256))
    for b in range(ord("A"), ord("Z") + 1):
        table[b] = b + 32
    for b in PIECE_ENDS:
        table[b] = ord("\n")
    for b in BLANKS:
        table[b] = ord(" ")
    return bytes(table)


LOWERED = _lowered()


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, dtype=np.uint8)
    kinds[ord(" ")], kinds[ord("\n")] = BLANK, END
    return kinds


def scrambled(values: np.ndarray, seed: int) -> np.ndarray:
    """A mixed 64-bit number of each one (finaliser of SplitMix64)."""
    x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Cuts lowered text into words and numbers them by a hash of language and bytes."""

    def __init__(self, seed: int):
        self.seed = seed
        cells = np.arange(HASHED_BYTES * 256, dtype=np.uint64)
        self.table = scrambled(cells, seed + 1)  # a number for each byte at each place
        self.kinds = _kinds()

    def cut(self, lang: str, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, code and piece of every word."""
        values = np.frombuffer(text, dtype=np.uint8)
        kinds = self.kinds[values]
        inside = np.zeros(len(values) + 2, dtype=np.int8)
        inside[1:-1] = kinds == WORD
        edges = np.diff(inside)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if not len(starts):
            return starts, ends, starts.astype(np.int64), starts
        pieces = np.cumsum(kinds == END, dtype=np.int32)[starts]
        sizes = ends - starts
        letters = values[kinds == WORD]
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(letters)) - np.repeat(first, sizes)
        hashed = self.table[np.minimum(place, HASHED_BYTES - 1) * 256 + letters]
        codes = np.add.reduceat(hashed, first)
        for i in np.flatnonzero(sizes > HASHED_BYTES).tolist():
            codes[i] = xxhash.xxh64_intdigest(text[starts[i] : ends[i]], self.seed)
        codes ^= np.uint64(xxhash.xxh64_intdigest(lang.encode(), self.seed + 2))
        codes = scrambled(codes, self.seed + 3)
        codes[codes == 0] = 1  # 0 stands for the end of a suffix
        return starts, ends, codes.view(np.int64), pieces


def segments(langs: list[str], texts: list[bytes | None]) -> Iterator[tuple[str, bytes]]:
    """Lowered texts of one language joined by line feeds, in segments cut at ends of pieces."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for lang, text in zip(langs, texts):
        if not text:
            continue
        lowered = text.translate(LOWERED)
        at = 0
        while len(lowered) - at > SEGMENT_BYTES:  # a long text, cut at the last end of a piece if there is one
            end = lowered.rfind(b"\n", at, at + SEGMENT_BYTES)
            if end < 0:
                end = lowered.find(b"\n", at + SEGMENT_BYTES)
            if end < 0:
                break
            yield lang, lowered[at : end + 1]
            at = end + 1
        held.setdefault(lang, []).append(lowered[at:] if at else lowered)
        sizes[lang] = sizes.get(lang, 0) + len(lowered) - at + 1
        if sizes[lang] >= SEGMENT_BYTES:
            yield lang, b"\n".join(held.pop(lang))
            sizes[lang] = 0
    for lang, parts in held.items():
        yield lang, b"\n".join(parts)


# --- filters -----------------------------------------------------------------


def _address_bits(entries: int) -> int:
    return min(MOST_BITS, max(FEWEST_BITS, int(entries).bit_length()))


def _marks(df: DataFrame, slot: str, bits: int) -> np.ndarray:
    """A bit for every ``slot`` of ``df``; 2 ** ``bits`` bits come to the driver, at most 32 MB."""
    words = (
        df.select((F.col(slot) + 1).alias("_bit"))
        .groupBy(F.bitmap_bucket_number("_bit").alias("word"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))
    )
    marks = np.zeros(1 << bits - 3, dtype=np.uint8)
    for row in words.toLocalIterator():
        start = (row["word"] - 1) * len(row["bits"])
        marks[start : start + len(row["bits"])] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return marks


def _marked(marks: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (marks[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _word_slot(codes: np.ndarray, bits: int) -> np.ndarray:
    return codes & ((1 << bits) - 1)


def _pair_slot(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    mixed = scrambled(first.view(np.uint64) * np.uint64(3) + second.view(np.uint64), 7)
    return (mixed >> np.uint64(64 - bits)).view(np.int64)


# --- suffixes ----------------------------------------------------------------


def combined(suffixes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the sums of their weights."""
    mixed = np.zeros(len(suffixes), dtype=np.uint64)
    for column in suffixes.T:
        mixed = scrambled(mixed ^ column.view(np.uint64), 11)
    _, first, group = np.unique(mixed, return_index=True, return_inverse=True)
    distinct = suffixes[first]
    if not (distinct[group] == suffixes).all():  # two rows on one number
        distinct, group = np.unique(suffixes, axis=0, return_inverse=True)
        group = group.reshape(-1)
    return distinct, np.bincount(group, weights).astype(np.int64)


def sort_suffixes(suffixes: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of two words or more that ``suffixes`` (rows of codes, 0 at the end) begin with, and their counts.

    Multikey three-way quicksort of pointers: those whose word at the depth is below,
    equal to or above the pivot's.  The equal ones go one word deeper.  Partitions that
    weigh less than ``least`` are abandoned.
    """
    depths = suffixes.shape[1]
    columns = [np.ascontiguousarray(suffixes[:, d]) for d in range(depths)]
    heads, sizes, counts = [], [], []
    stack = [(np.arange(len(suffixes)), 0)] if len(suffixes) and weights.sum() >= least else []
    while stack:
        pointers, depth = stack.pop()
        if len(pointers) == 1:  # nothing left to order
            alone = int(pointers[0])
            for d in range(depth, depths):
                if columns[d][alone] == 0:
                    break
                if d >= SHORTEST - 1:
                    heads.append(alone)
                    sizes.append(d + 1)
                    counts.append(int(weights[alone]))
            continue
        words = columns[depth][pointers]
        pivot = words[len(words) // 2]
        equal = pointers[words == pivot]
        for others in (pointers[words < pivot], pointers[words > pivot]):
            if len(others) and weights[others].sum() >= least:
                stack.append((others, depth))
        count = int(weights[equal].sum())
        if pivot == 0 or count < least:
            continue
        if depth >= SHORTEST - 1:
            heads.append(int(equal[0]))
            sizes.append(depth + 1)
            counts.append(count)
        if depth + 1 < depths:
            stack.append((equal, depth + 1))
    phrases = suffixes[np.array(heads, dtype=np.int64)]
    phrases = np.where(np.arange(depths)[None, :] < np.array(sizes, dtype=np.int64)[:, None], phrases, 0)
    return phrases, np.array(counts, dtype=np.int64)


# --- counting as Spark jobs --------------------------------------------------


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    return segments(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _word_table(narrow: DataFrame, seed: int) -> DataFrame:
    """(lang, word binary, code, n) of every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(seed)
        for batch in batches:
            for lang, text in _texts(batch):
                starts, ends, codes, _ = words.cut(lang, text)
                distinct, first, n = np.unique(codes, return_index=True, return_counts=True)
                found = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found, pa.binary()), pa.array(distinct), pa.array(n)],
                    ["lang", "word", "code", "n"],
                )

    return (
        narrow.mapInArrow(count, "lang string, word binary, code bigint, n bigint")
        .groupBy("lang", "word", "code")
        .agg(F.sum("n").alias("n"))
    )


def word_table(narrow: DataFrame) -> tuple[DataFrame, int]:
    """The stored table of words and the seed under which no two of them share a code.

    A segment tells words apart by code alone, so with a shared code one of two words
    in it would be counted for both; both still reach the table from segments that hold
    one of them.  Only two words that are together in every segment would escape, with
    a chance of one in 2 ** 64 for each pair of words.
    """
    seed = 0
    while True:
        table = materialize(_word_table(narrow, seed), "words")
        shared = table.groupBy("code").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > 1)
        if shared.isEmpty():
            return table, seed
        seed += 10


class Pairs:
    """Finds places where two words of the filter stand side by side in a piece."""

    def __init__(self, seed: int, words_known: np.ndarray, word_bits: int):
        self.words, self.known, self.bits = Words(seed), words_known, word_bits

    def __call__(self, lang: str, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all words, and whether each one and the next are a pair of known words."""
        _, _, codes, pieces = self.words.cut(lang, text)
        if len(codes) < 2:
            return codes, np.zeros(len(codes), dtype=bool)
        known = _marked(self.known, _word_slot(codes, self.bits))
        pair = np.zeros(len(codes), dtype=bool)
        pair[:-1] = known[:-1] & known[1:] & (pieces[:-1] == pieces[1:])
        return codes, pair


def pair_slots(narrow: DataFrame, seed: int, known, word_bits: int, bits: int) -> DataFrame:
    """(slot, n): how often pairs of words on each slot occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(seed, known.value, word_bits)
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            slots, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.int64),) * 2
            return pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n)], ["slot", "n"])

        for batch in batches:
            for lang, text in _texts(batch):
                codes, pair = pairs(lang, text)
                at = np.flatnonzero(pair)
                held.append(_pair_slot(codes[at], codes[at + 1], bits))
                size += len(at)
                if size >= PAIRS_HELD:
                    yield counted()
                    held, size = [], 0
        yield counted()

    return (
        narrow.mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    )


CODES = [f"w{i}" for i in range(1, LONGEST + 1)]
SUFFIX_ROW = "route bigint, heavy boolean, " + ", ".join(f"{c} bigint" for c in CODES) + ", n bigint"
PHRASE_ROW = ", ".join(f"{c} bigint" for c in CODES) + ", n bigint"


def suffixes(narrow: DataFrame, seed: int, known, word_bits: int, often, bits: int, heavy) -> DataFrame:
    """(route, heavy, w1 to w5, n): the suffixes at all pairs on frequent slots, up to the last such pair.

    The route is the hash of the two leading words.  Pairs on heavy slots are routed by
    all their words instead; equal suffixes of a segment are added up before they go.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(seed, known.value, word_bits)
        for batch in batches:
            for lang, text in _texts(batch):
                codes, pair = pairs(lang, text)
                at = np.flatnonzero(pair)
                pair[at] = _marked(often.value, _pair_slot(codes[at], codes[at + 1], bits))
                at = np.flatnonzero(pair)
                if not len(at):
                    continue
                rows = np.zeros((len(at), LONGEST), dtype=np.int64)
                rows[:, 0], rows[:, 1] = codes[at], codes[at + 1]
                on = np.ones(len(at), dtype=bool)
                for depth in range(SHORTEST, LONGEST):
                    # The word at ``depth`` belongs to the suffix if the pair before it is kept.
                    further = np.minimum(at + depth - 1, len(codes) - 1)
                    on &= pair[further]
                    rows[on, depth] = codes[further[on] + 1]
                rows, n = combined(rows, np.ones(len(rows), dtype=np.int64))
                words = [np.ascontiguousarray(c) for c in rows.T]
                split = np.isin(_pair_slot(words[0], words[1], bits), heavy.value)
                route = deep = scrambled(words[0].view(np.uint64) * np.uint64(3) + words[1].view(np.uint64), 5)
                for column in words[SHORTEST:]:
                    deep = scrambled(deep ^ column.view(np.uint64), 5)
                route = np.where(split, deep, route).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(route), pa.array(split), *map(pa.array, words), pa.array(n)],
                    ["route", "heavy", *CODES, "n"],
                )

    return narrow.mapInArrow(find, SUFFIX_ROW)


def phrase_counts(found: DataFrame, least: int) -> DataFrame:
    """(w1 to w5, n) of every phrase of ``least`` or more occurrences among ``suffixes``."""

    def rows(batch: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        heavy = batch.column("heavy").to_numpy(zero_copy_only=False).astype(bool)
        codes = np.stack([batch.column(c).to_numpy() for c in CODES], axis=1)
        return heavy, codes, batch.column("n").to_numpy()

    def counted(table: pa.Table) -> Iterator[pa.RecordBatch]:
        heavy, codes, n = rows(table)
        # Suffixes of a heavy pair are spread, so their counts are only parts.
        for spread, enough in ((False, least), (True, 1)):
            phrases, counts = sort_suffixes(codes[heavy == spread], n[heavy == spread], enough)
            if len(counts):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.ascontiguousarray(c)) for c in phrases.T), pa.array(counts)], [*CODES, "n"]
                )

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < SORTED_TOGETHER:
                continue
            table = pa.Table.from_batches(held)
            route = table.column("route").to_numpy()
            # The last route may go on in the next batch.
            whole = int(np.searchsorted(route, route[-1], side="left"))
            if whole:
                yield from counted(table.slice(0, whole))
            held = table.slice(whole).to_batches()
            size = table.num_rows - whole
        if size:
            yield from counted(pa.Table.from_batches(held))

    dealt = found.repartition("route").sortWithinPartitions("route")
    return (
        dealt.mapInArrow(sort, PHRASE_ROW)
        .groupBy(*CODES)
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """The stored tables (lang, word, code, n) of all words and (codes array, size, a) of frequent phrases."""
    spark = docs.sparkSession
    context = spark.sparkContext
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(text).cast("binary").alias("text"),
    )
    words, seed = word_table(narrow)
    frequent = words.filter(F.col("n") >= least)
    sums = frequent.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    word_bits = _address_bits(SLOTS_PER_WORD * sums[0])
    slot = F.col("code").bitwiseAND(F.lit((1 << word_bits) - 1).cast("bigint")).alias("slot")
    known = context.broadcast(_marks(frequent.select(slot), "slot", word_bits))
    bits = _address_bits(sums[1] // PLACES_PER_SLOT)
    slots = materialize(
        pair_slots(narrow, seed, known, word_bits, bits).filter(F.col("n") >= least), "pairs"
    )
    often = context.broadcast(_marks(slots, "slot", bits))
    # A heavy slot holds more than an even share of the pairs, so there are fewer than partitions.
    total = slots.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = slots.filter(F.col("n") > max(least, total // parts)).select("slot").collect()
    spread = context.broadcast(np.array([r["slot"] for r in heavy], dtype=np.int64))
    found = suffixes(narrow, seed, known, word_bits, often, bits, spread)
    present = F.filter(F.array(*CODES), lambda c: c != 0)
    phrases = phrase_counts(found, least).select(present.alias("codes"), F.col("n").alias("a"))
    return words, materialize(phrases.withColumn("size", F.size("codes")), "phrases")


# --- scores ------------------------------------------------------------------


def _named(phrases: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``phrases`` with their language and their words joined by spaces."""
    spelled = words.filter(F.col("n") >= least).select("code", "lang", "word")
    each = materialize(
        phrases.select("codes", F.posexplode("codes").alias("at", "code")), "phrase-words"
    )
    joined = counted_lookup_join(each, spelled, ["code"], ["codes", "at"], how="inner")
    text = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: F.decode(x["word"], "UTF-8")), " "
    )
    names = joined.groupBy("codes").agg(F.min("lang").alias("lang"), text.alias("phrase"))
    return phrases.join(names, "codes")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    least: int = LEAST,
    listed: int = LISTED,
    covered: int = 100,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``listed`` phrases of each language.

    Texts are lower-cased in A-Z, cut into pieces at punctuation and line ends, and
    pieces into words at spaces and tabs.  A phrase of two to five words with ``a`` of
    ``least`` or more occurrences is cut after each of its words into parts of ``l``
    and ``r`` occurrences; ``score`` is the least ``floor(1000 * a * n / (l * r))``,
    ``n`` being all words of the language.  A phrase inside a longer frequent one goes
    if that has ``covered`` of a hundred of its occurrences or more.  Order: score and
    ``a`` falling, then the phrase's bytes.

    Null and empty texts hold no words; a null language is ``und``.  Repeated rows
    count each time; other columns are not looked at.  A long text is looked at in
    segments cut at ends of pieces, so only a long piece without any is held whole.
    An empty table gives an empty result.
    """
    words, phrases = frequent_phrases(docs, lang, text, least)
    # What lies inside a longer phrase lies inside one a single word longer, with a count no smaller.
    longer = phrases.filter(F.col("size") > SHORTEST)
    inner = longer.select(F.slice("codes", 1, F.col("size") - 1).alias("codes"), F.col("a").alias("_longer")).unionByName(
        longer.select(F.slice("codes", 2, F.col("size") - 1).alias("codes"), F.col("a").alias("_longer"))
    )
    most = inner.groupBy("codes").agg(F.max("_longer").alias("_longer"))
    kept = phrases.join(most, "codes", "left").filter(
        F.col("_longer").isNull() | (100 * F.col("_longer") < covered * F.col("a"))
    )
    counts = materialize(
        phrases.select("codes", F.col("a").alias("f")).unionByName(
            words.filter(F.col("n") >= least).select(F.array("code").alias("codes"), F.col("n").alias("f"))
        ),
        "counts",
    )
    cuts = materialize(
        kept.select("codes", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
            "codes",
            "a",
            "k",
            F.slice("codes", F.lit(1), F.col("k")).alias("first"),
            F.slice("codes", F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
        ),
        "cuts",
    )
    left = counts.select(F.col("codes").alias("first"), F.col("f").alias("l"))
    right = counts.select(F.col("codes").alias("rest"), F.col("f").alias("r"))
    halves = materialize(counted_lookup_join(cuts, left, ["first"], ["codes", "k"], how="inner"), "halves")
    both = counted_lookup_join(halves, right, ["rest"], ["codes", "k"], how="inner")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    named = _named(kept.select("codes", "a"), words, least).select("codes", "lang", "phrase")
    sized = lookup_join(named, totals, ["lang"], ["codes"], how="inner")

    scored = both.join(sized, "codes").withColumn(
        "score",
        F.expr(
            "(CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(18,0)) * CAST(1000 AS DECIMAL(4,0)))"
            " div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"
        ),
    )
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    chosen = scored.groupBy("codes", "lang", "phrase", "a", "n").agg(lowest)
    order = [F.col("_cut.score").desc(), F.col("a").desc(), F.col("phrase")]
    return first_per_group(chosen, ["lang"], order, listed, rank="rank").select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        "a",
        F.col("_cut.l").alias("l"),
        F.col("_cut.r").alias("r"),
        "n",
        F.col("_cut.score").alias("score"),
    )
