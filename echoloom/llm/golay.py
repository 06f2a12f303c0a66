"""SimHash near-duplicates found by Golay-code fuzzy hashing.

The binary Golay code [23, 12, 7] is perfect: every 23-bit word lies within three
bits of exactly one codeword.  A fingerprint segment is therefore hashed to the
index of its codeword, and to those of the words one bit away, which makes one
or six keys.  Segments one bit apart share a segment's own index, segments two
bits apart share a key, as the word halfway decodes to the same codeword.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echoloom.operators.components import component_roots
from echoloom.operators.keyed import counted_lookup_join
from echoloom.workspace import materialize, send_with_tasks

send_with_tasks(__name__)

SHINGLE = 4  # words
SEED = 42
MOST_BITS = 4  # fingerprints this close are linked
HASHES_AT_ONCE = 65_536
# Fixed value: generator polynomial of the Golay code.
GENERATOR = 0b101011100011
LENGTH, MESSAGE = 23, 12
# (offset, bits) of the three segments; each fits a code word.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
THIRDS = 3  # parts of a segment: 7, 7 and the remaining 7 or 8 bits
# Bits of the filter that marks buckets with more than one fingerprint.  Its size
# (4 MB) does not depend on the data; two buckets on one bit let a few more rows through.
FILTER_BITS = 25
BLOCK = 2048  # fingerprints of a bucket compared in one task with as many others


# --- fingerprints --------------------------------------------------------------


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits of a UTF-8 text, as a signed integer; zero without words."""
    # bytes.lower() and bytes.split() know ASCII letters and ASCII space only.
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        pairs = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * set_bits > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """(key, fingerprint bigint) of every document; null texts count as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], [key, "fingerprint"]
            )

    kind = docs.schema[key].dataType.simpleString()
    narrow = docs.select(F.col(key), F.col(text).cast("binary").alias("_text"))
    return narrow.mapInArrow(scan, f"`{key}` {kind}, fingerprint bigint")


# --- the code ------------------------------------------------------------------


def _remainder(word: int) -> int:
    """Of a polynomial over two elements, divided by the generator."""
    for bit in range(LENGTH - 1, MESSAGE - 2, -1):
        if word >> bit & 1:
            word ^= GENERATOR << bit - (MESSAGE - 1)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low and high halves of a word, and the error of each remainder."""
    low = np.array([_remainder(i) for i in range(1 << 12)], dtype=np.int32)
    high = np.array([_remainder(i << 12) for i in range(1 << 11)], dtype=np.int32)
    errors = np.zeros(1 << 11, dtype=np.int32)
    ones = [1 << i for i in range(LENGTH)]
    for a in [0, *ones]:
        for b in [0, *ones]:
            for c in [0, *ones]:
                errors[_remainder(a | b | c)] = a | b | c
    return low, high, errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each 23-bit word."""
    low, high, errors = _tables()
    remainder = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ errors[remainder]) >> (LENGTH - MESSAGE)


def nearby(words: np.ndarray, bits: int) -> np.ndarray:
    """Codeword indices of each word and of the words one bit away: (n, bits + 1), sorted."""
    flips = np.array([0, *(1 << i for i in range(bits))], dtype=np.int64)
    return np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys such that fingerprints at most four bits apart share a key.

    With four errors over three segments, either a segment is free of errors,
    and then one of the other two has at most two (keys: the exact segment with
    every nearby index of the other one), or every segment has an error, and then
    two of them have exactly one each (the own index of one segment with every
    nearby index of the other, both ways round) and the third has one or two, which
    leave one of its three parts exact (keys: the two indices with each part).
    """
    whole = prints.view(np.uint64)
    exact = [
        ((whole >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        for at, bits in SEGMENTS
    ]
    near = [nearby(w, bits) for w, (_, bits) in zip(exact, SEGMENTS)]
    own = [decode(w) for w in exact]
    rows, keys = [], []

    fresh = [np.concatenate((np.ones((len(n), 1), bool), n[:, 1:] != n[:, :-1]), 1) for n in near]
    tag = 0
    for i in range(3):
        for j in range(3):
            if i != j:
                row, column = np.nonzero(fresh[j])
                rows.append(row)
                keys.append((tag << 40) | (exact[i][row] << 12) | near[j][row, column])
                tag += 1
    for i in range(3):
        for j in range(i + 1, 3):
            row, column = np.nonzero(fresh[j])
            one_way = (own[i][row] << 12) | near[j][row, column]
            back, column = np.nonzero(fresh[i])
            other = near[i][back, column]
            new = other != own[i][back]  # the own index is in the first way already
            back, other = back[new], other[new]
            # Both ways have the same order of segments, so that they meet.
            row = np.concatenate((row, back))
            both = np.concatenate((one_way, (other << 12) | own[j][back]))
            third = exact[3 - i - j]
            for part in range(THIRDS):
                rows.append(row)
                keys.append((tag << 40) | (both << 8) | (third[row] >> (7 * part) & (0xFF if part == 2 else 0x7F)))
                tag += 1
    return np.concatenate(rows), np.concatenate(keys)


# --- links ---------------------------------------------------------------------


def forest(prints: list[int], most: int = MOST_BITS) -> list[tuple[int, int]]:
    """Edges that connect what is linked within one bucket, fewer than its members."""
    members = sorted(set(prints))
    if len(members) == 2:
        a, b = members
        return [(a, b)] if ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count() <= most else []
    edges = []
    left = np.array(members, dtype=np.int64)
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            node = queue.pop()
            close = np.bitwise_count((left ^ node).view(np.uint64)) <= most
            if close.any():
                found = left[close]
                edges.extend((int(node), int(x)) for x in found)
                queue.extend(found)
                left = left[~close]
    return edges


def _marks(buckets: DataFrame) -> np.ndarray:
    """Bytes of the filter; at most 2 ** FILTER_BITS bits come to the driver."""
    folded = F.col("bucket").bitwiseXOR(F.shiftright("bucket", FILTER_BITS))
    bit = folded.bitwiseAND(F.lit((1 << FILTER_BITS) - 1).cast("bigint")) + 1
    words = (
        buckets.select(bit.alias("_bit"))
        .groupBy(F.bitmap_bucket_number("_bit").alias("word"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("bits"))
        .collect()
    )
    marks = np.zeros(1 << FILTER_BITS - 3, dtype=np.uint8)
    for row in words:
        start = (row["word"] - 1) * len(row["bits"])
        marks[start : start + len(row["bits"])] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return marks


def links(prints: DataFrame, most: int = MOST_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): verified links that connect the distinct ``prints`` (fingerprint).

    Buckets of one fingerprint are dropped before anything is collected.  A
    bucket larger than ``block`` is cut into blocks and every pair of blocks is
    compared in a task of its own, so a task holds two blocks whatever the
    bucket's size.  Each task emits a spanning forest, never all pairs.
    """

    def keyed(batches: Iterator[pa.RecordBatch], marks: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy()
            for at in range(0, len(values), 4096):
                part = np.ascontiguousarray(values[at : at + 4096])
                rows, keys = fuzzy_keys(part)
                if marks is not None:
                    place = (keys ^ keys >> FILTER_BITS) & ((1 << FILTER_BITS) - 1)
                    known = marks[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
                    rows, keys = rows[known], keys[known]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[rows]), pa.array(keys)], ["fingerprint", "bucket"]
                )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [e for members in batch.column(0).to_pylist() for e in forest(members, most)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    spark = prints.sparkSession
    # A fingerprint has some 120 keys, so few files are worth many tasks.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.select("fingerprint").repartition(parts, "fingerprint")
    schema = "fingerprint bigint, bucket bigint"
    shared = materialize(
        spread.mapInArrow(lambda batches: keyed(batches, None), schema)
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("members"))
        .filter(F.col("members") > 1),
        "buckets",
    )
    filled = spark.sparkContext.broadcast(_marks(shared))
    # Keys are made again, and those of buckets with one member go no further.
    keys = spread.mapInArrow(lambda batches: keyed(batches, filled.value), schema)
    rows = F.col("members").alias("_rows")
    members = counted_lookup_join(
        keys, shared.select("bucket", "members", rows), ["bucket"], ["fingerprint"], "_rows", how="inner"
    )
    blocks = F.ceil(F.col("members") / block)
    own = F.pmod(F.xxhash64("fingerprint"), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), blocks - 1),
        lambda other: F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high")),
    )
    tasks = (
        members.select("fingerprint", "bucket", F.inline(pairs))
        .groupBy("bucket", "low", "high")
        .agg(F.collect_list("fingerprint").alias("members"))
        .select("members")
    )
    return tasks.mapInArrow(compared, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    most: int = MOST_BITS,
) -> DataFrame:
    """(key, fingerprint bigint, component_id) of every document.

    Fingerprints at most ``most`` (up to four) bits apart are linked;
    ``component_id`` is the smallest key reachable over links.  Equal
    fingerprints are one node of the graph, so copies cost nothing; links are
    searched and verified between distinct fingerprints only.

    Null and empty texts have fingerprint zero and are linked like any other.
    Null keys are ignored in the minimum, so a component without any other key
    has a null ``component_id``.  Repeated rows are kept.  An empty table gives
    an empty result.
    """
    if not 0 <= most <= MOST_BITS:
        raise ValueError(f"keys are built for at most {MOST_BITS} differing bits")
    marked = materialize(fingerprints(docs, key, text, shingle), "fingerprints")
    distinct = materialize(
        marked.groupBy("fingerprint").agg(F.min(key).alias("_least"), F.count(F.lit(1)).alias("_rows")),
        "distinct",
    )
    return named_components(marked, distinct, links(distinct, most), key)


def named_components(marked: DataFrame, distinct: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, fingerprint, component_id) of ``marked`` (key, fingerprint) by the links (a, b) in ``edges``.

    ``distinct`` has every fingerprint once, with its least key and number of rows.
    """
    roots = component_roots(edges).withColumnRenamed("node", "fingerprint")
    placed = distinct.join(roots, "fingerprint", "inner")
    members = materialize(
        placed.groupBy("root").agg(F.min("_least").alias("_first"), F.count(F.lit(1)).alias("_nodes")),
        "components",
    )
    linked = counted_lookup_join(
        roots, members, ["root"], ["fingerprint"], "_nodes", how="inner"
    ).select("fingerprint", "_first")
    named = materialize(
        distinct.join(linked, "fingerprint", "left").select(
            "fingerprint", F.coalesce("_first", "_least").alias("component_id"), "_rows"
        ),
        "named",
    )
    return counted_lookup_join(marked, named, ["fingerprint"], [key], "_rows", how="inner").select(
        key, "fingerprint", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    most: int = MOST_BITS,
) -> DataFrame:
    """One document of each component stays, the one with the smallest key, with all columns.

    Rows with a null key stay: nothing tells them apart.
    """
    return drop_others(docs, near_duplicates(docs, key, text, shingle, most), key)


def drop_others(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``docs`` without the keys that ``found`` puts into the component of another key."""
    gone = materialize(
        found.filter(F.col(key) != F.col("component_id")).select(F.col(key).alias("_gone")).distinct(),
        "dropped",
    )
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti")
