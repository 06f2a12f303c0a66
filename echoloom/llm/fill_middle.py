"""Fill-in-the-middle transformation with cuts selected from a compressed set of boundaries.

A text of n units has n + 1 boundaries.  Their offsets are held as a Roaring-style
set: one container for each 65,536 offsets, as an array, a bitmap or runs, whichever
is smallest, with the number of boundaries before each container.  The boundary after
i units is found by searching the containers' counts and selecting within one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.workspace import send_with_tasks

send_with_tasks(__name__)

LOW_BITS = 16
CHUNK = 1 << LOW_BITS
BITMAP_BYTES = CHUNK // 8
# Sentinels, shares of a hundred and the words that name the three forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED_OF_HUNDRED, SUFFIX_FIRST_OF_HUNDRED = 90, 20
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"


@dataclass
class ArrayContainer:
    """Low halves of the members, in order."""

    low: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> ArrayContainer:
        return cls(low.astype(np.uint16))

    def select(self, i: int) -> int:
        return int(self.low[i])


@dataclass
class BitmapContainer:
    """One bit for each offset, with the number of members before each word of 64 bits."""

    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> BitmapContainer:
        bits = np.zeros(CHUNK, dtype=np.uint8)
        bits[low] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        return cls(words, np.cumsum(counts) - counts)

    def select(self, i: int) -> int:
        # Words without members repeat a count; the last of equal ones holds the member.
        at = int(np.searchsorted(self.before, i, side="right")) - 1
        bits = np.unpackbits(self.words[at : at + 1].view(np.uint8), bitorder="little")
        return at * 64 + int(np.flatnonzero(bits)[i - self.before[at]])


@dataclass
class RunContainer:
    """First members of the runs, with the number of members before each run."""

    starts: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, low: np.ndarray) -> RunContainer:
        first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
        return cls(low[first].astype(np.uint16), first)

    def select(self, i: int) -> int:
        at = int(np.searchsorted(self.before, i, side="right")) - 1
        return int(self.starts[at]) + i - int(self.before[at])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three forms for ascending ``low`` below 65,536."""
    runs = int(np.count_nonzero(np.diff(low, prepend=-2) != 1))
    sizes = [(4 * runs, 0, RunContainer), (2 * len(low), 1, ArrayContainer), (BITMAP_BYTES, 2, BitmapContainer)]
    return min(sizes)[2].of(low)


class BoundarySet:
    """Ascending offsets that can be selected by their number."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> LOW_BITS
        first = np.flatnonzero(np.diff(high, prepend=-1))
        self.high = high[first]
        self.before = first
        self.size = len(offsets)
        ends = [*first[1:].tolist(), len(offsets)]
        self.containers = [
            container(offsets[a:b] & CHUNK - 1) for a, b in zip(first.tolist(), ends)
        ]

    def __len__(self) -> int:
        return self.size

    def select(self, i: int) -> int:
        """Offset of the boundary after ``i`` units."""
        at = int(np.searchsorted(self.before, i, side="right")) - 1
        low = self.containers[at].select(i - int(self.before[at]))
        return (int(self.high[at]) << LOW_BITS) + low


def boundaries(text: str) -> BoundarySet:
    """Code point offsets where a unit begins or the text ends; units are runs of A-Z, a-z or single others."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = ((points | 32) >= ord("a")) & ((points | 32) <= ord("z"))
    inside = letter[1:] & letter[:-1]
    offsets = np.concatenate(([0], np.flatnonzero(~inside) + 1, [len(points)] if len(points) else []))
    return BoundarySet(offsets.astype(np.int64))


CUT = "units bigint, start bigint, stop bigint"


def _cuts(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
    rows = []
    for text, a, b in zip(texts, first, second):
        found = boundaries(text)
        low, high = sorted((int(a) % len(found), int(b) % len(found)))
        rows.append((len(found) - 1, found.select(low), found.select(high)))
    return pd.DataFrame(rows, columns=["units", "start", "stop"], dtype="int64")


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    seed: int = 1,
    changed: int = CHANGED_OF_HUNDRED,
    suffix_first: int = SUFFIX_FIRST_OF_HUNDRED,
) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output) of every row.

    Two cuts are drawn from the digest of ``seed`` and key among the boundaries of
    the text's n units.  Of a hundred texts ``changed`` are rearranged, of these
    ``suffix_first`` of a hundred with the suffix first; the others, empty texts
    and texts that contain a sentinel stay plain, with null character counts.
    Only the units are counted in Python; texts are cut by Spark.

    Null texts count as empty.  A null key is hashed as an empty one.  Repeated rows
    are kept, each with the same result; other columns are not looked at.  A very
    long text is held whole by one task, in five bytes a code point beside its set
    of boundaries.  An empty table gives an empty result.
    """
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    drawn = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    whole = docs.select(
        F.col(key).alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
        *(h.alias(f"_h{i}") for i, h in enumerate(drawn)),
    )
    cut = whole.withColumn("_cut", F.pandas_udf(_cuts, CUT)("_text", "_h0", "_h1"))
    body = F.col("_text")
    untouched = F.length(body) == 0
    for mark in (PREFIX, SUFFIX, MIDDLE):
        untouched = untouched | F.contains(body, F.lit(mark))
    form = (
        F.when(untouched | (F.col("_h2") % 100 >= changed), PLAIN)
        .when(F.col("_h3") % 100 < suffix_first, SUFFIX_FIRST)
        .otherwise(PREFIX_FIRST)
    )
    start, stop = F.col("_cut.start").cast("int"), F.col("_cut.stop").cast("int")
    prefix = F.substring(body, F.lit(1), start)
    middle = F.substring(body, start + 1, stop - start)
    suffix = F.substring(body, stop + 1, F.length(body))
    rearranged = F.col("_form") != PLAIN
    output = (
        F.when(F.col("_form") == PLAIN, body)
        .when(
            F.col("_form") == PREFIX_FIRST,
            F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle),
        )
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return cut.withColumn("_form", form).select(
        F.col("_key").alias(key),
        F.col("_cut.units").alias("n"),
        F.col("_form").alias("form"),
        F.when(rearranged, start.cast("bigint")).alias("prefix_chars"),
        F.when(rearranged, (stop - start).cast("bigint")).alias("middle_chars"),
        output.alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made of.

    A rearranged text holds each sentinel once, as no text with a sentinel is
    rearranged and no end of a part and a sentinel together make another one.
    """
    marks = "|".join(re.escape(mark) for mark in (PREFIX, SUFFIX, MIDDLE))
    parts = F.split(output, marks)
    first, second, third = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == PLAIN, output)
        .when(form == PREFIX_FIRST, F.concat(first, third, second))
        .otherwise(F.concat(second, third, first))
    )
