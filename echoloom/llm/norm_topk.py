"""Exact largest inner products by buckets of vectors of similar length.

Vectors are sorted by length, longest first, and cut into buckets.  A query that
already knows k products of at least t can find a better one in a bucket only at a
cosine of t / (its length x the bucket's greatest length): above one the bucket is
skipped.  A low threshold is met by too many directions, so only vectors too short
for it are left out; a high one confines every coordinate of a unit vector to a
short range, and the bucket's sorted coordinates give the candidates.  All that is
left is verified by whole products (after Teflioudi, Gemulla and Mykytiuk 2015).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.operators.keyed import first_per_group
from echoloom.workspace import materialize, materialize_counted, send_with_tasks

send_with_tasks(__name__)

SEED_ROWS = 2048  # longest vectors that give every query its first threshold
MOST_CLASSES = 1024  # classes of length; bounds what reaches the driver, classes are cut into parts
PART_ROWS = 32_768  # vectors a task holds
QUERY_ROWS = 32_768  # queries a task holds
BUCKET_ROWS = 2048
QUERY_CHUNK = 256
# Above this cosine three coordinates leave few candidates; below it whole products are cheaper.
COORDINATE_COSINE = 0.9
FOCUS = 3  # coordinates that a query looks at, its largest ones
SLACK = 1e-9  # for rounding in lengths and cosines; a product is compared exactly
EXACT_DOUBLE, EXACT_LONG = 2.0**53, 2.0**63


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors held as doubles or longs."""
    reach = _length(queries).max(initial=0.0) * _length(vectors).max(initial=0.0)
    if reach < EXACT_DOUBLE:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    if reach >= EXACT_LONG:
        raise OverflowError("an inner product does not fit 64 bits")
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


def _length(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    if all(len(v) == width for v in vectors):
        return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), width)
    rows = np.zeros((len(vectors), width), dtype=np.int64)
    for row, vector in zip(rows, vectors):
        row[: len(vector)] = vector
    return rows


class Best:
    """The k best (score, id) of each query so far, ties to the smaller id."""

    def __init__(self, queries: int, k: int, known: np.ndarray):
        self.k = k
        self.scores = np.full((queries, k), np.iinfo(np.int64).min)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)
        self.found = np.zeros((queries, k), dtype=bool)
        self.known = known  # k products of at least this exist

    def least(self, rows: np.ndarray) -> np.ndarray:
        """A product below it is of no use to the query."""
        return np.maximum(self.known[rows], np.where(self.found[rows, -1], self.scores[rows, -1], self.known[rows]))

    def useful(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        last, last_id = self.scores[rows, -1], self.ids[rows, -1]
        full = self.found[rows, -1]
        return (scores >= self.known[rows]) & (
            ~full | (scores > last) | ((scores == last) & (ids < last_id))
        )

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(rows)
        old, place = np.nonzero(self.found[touched])
        row = np.concatenate((rows, touched[old]))
        score = np.concatenate((scores, self.scores[touched[old], place]))
        number = np.concatenate((ids, self.ids[touched[old], place]))
        order = np.lexsort((number, -score, row))
        row, score, number = row[order], score[order], number[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        row, place = row[keep], place[keep]
        self.scores[row, place] = score[keep]
        self.ids[row, place] = number[keep]
        self.found[row, place] = True


class Bucket:
    """Vectors of similar length, longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray):
        self.ids, self.vectors, self.lengths = ids, vectors, lengths
        self.longest = lengths[0]
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._units: np.ndarray | None = None

    def units(self) -> np.ndarray:
        if self._units is None:
            self._units = self.vectors / np.where(self.lengths > 0, self.lengths, 1.0)[:, None]
        return self._units

    def long_enough(self, least: np.ndarray) -> np.ndarray:
        """How many vectors, from the longest on, are at least so long."""
        return np.searchsorted(-self.lengths, -(least - SLACK * np.abs(least)), side="right")

    def candidates(self, unit: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors whose coordinates allow the cosine with ``unit``."""
        focus = np.argsort(-np.abs(unit))[:FOCUS]
        ranges = []
        for axis in focus:
            q = unit[axis]
            spread = np.sqrt(max(0.0, (1 - cosine**2) * (1 - q**2)))
            low = -1.0 if -q >= cosine else q * cosine - spread
            high = 1.0 if q >= cosine else q * cosine + spread
            if axis not in self._sorted:
                order = np.argsort(self.units()[:, axis], kind="stable")
                self._sorted[axis] = (order, self.units()[order, axis])
            order, values = self._sorted[axis]
            a = np.searchsorted(values, low - SLACK, side="left")
            b = np.searchsorted(values, high + SLACK, side="right")
            ranges.append((b - a, axis, low - SLACK, high + SLACK, order[a:b]))
        # The shortest list is walked, the other ranges are tested on it.
        _, first, _, _, rows = min(ranges, key=lambda r: r[0])
        for _, axis, low, high, _ in ranges:
            if axis != first:
                values = self.units()[rows, axis]
                rows = rows[(values >= low) & (values <= high)]
        return rows


def search(
    queries: np.ndarray,
    query_ids: np.ndarray,
    known: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    k: int,
    bucket_rows: int = BUCKET_ROWS,
    coordinate_cosine: float = COORDINATE_COSINE,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of the ``k`` best of ``vectors`` that reach each query's ``known`` product."""
    lengths = _length(vectors)
    order = np.lexsort((ids, -lengths))
    vectors, ids, lengths = vectors[order], ids[order], lengths[order]
    query_lengths = _length(queries)
    units = queries / np.where(query_lengths > 0, query_lengths, 1.0)[:, None]
    best = Best(len(queries), k, known)
    for at in range(0, len(ids), bucket_rows):
        cut = slice(at, at + bucket_rows)
        bucket = Bucket(ids[cut], vectors[cut], lengths[cut])
        everyone = np.arange(len(queries))
        least = best.least(everyone)
        reach = query_lengths * bucket.longest
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(least > 0, least / reach, -1.0)  # no length rules out a product of at most 0
            shortest = np.where(least > 0, least / query_lengths, 0.0)
        alive = cosine <= 1 + SLACK
        by_coordinate = alive & (cosine >= coordinate_cosine)
        for row in np.flatnonzero(by_coordinate):
            near = bucket.candidates(units[row], min(1.0, cosine[row] * (1 - SLACK)))
            near = near[bucket.ids[near] != query_ids[row]]
            if len(near):
                score = products(queries[row : row + 1], bucket.vectors[near])[0]
                _keep(best, np.full(len(near), row), score, bucket.ids[near])
        by_length = np.flatnonzero(alive & ~by_coordinate)
        counts = bucket.long_enough(shortest[by_length])
        # Queries that look equally far stand together, so that few products are made in vain.
        by_length = by_length[np.argsort(counts, kind="stable")]
        counts = np.sort(counts)
        for start in range(0, len(by_length), QUERY_CHUNK):
            rows = by_length[start : start + QUERY_CHUNK]
            wide = int(counts[start : start + QUERY_CHUNK].max())
            score = products(queries[rows], bucket.vectors[:wide])
            own = query_ids[rows][:, None] == bucket.ids[None, :wide]
            row, column = np.nonzero((score >= best.least(rows)[:, None]) & ~own)
            _keep(best, rows[row], score[row, column], bucket.ids[column])
    row, place = np.nonzero(best.found)
    return query_ids[row], best.ids[row, place], best.scores[row, place]


def _keep(best: Best, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
    use = best.useful(rows, scores, ids)
    if use.any():
        best.add(rows[use], scores[use], ids[use])


def integer_vectors(
    df: DataFrame, asks: Column, scale: float, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(id, asks, vec array<bigint>, length) of the rows that take part, one for each key.

    Components become ``floor(scale * x)``, x as double.
    """
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.select(
        F.col(key).cast("bigint").alias("id"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        F.col(vector).cast("array<double>").alias("vec"),
    ).filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite)
    whole = usable.withColumn("vec", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale)))))
    one = whole.groupBy("id").agg(F.max("asks").alias("asks"), F.min("vec").alias("vec"))
    squares = F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")
    )
    return one.withColumn("length", F.sqrt(squares))


def top_products(
    df: DataFrame,
    asks: Column,
    k: int,
    scale: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
    part_rows: int = PART_ROWS,
    query_rows: int = QUERY_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    seed_rows: int = SEED_ROWS,
    coordinate_cosine: float = COORDINATE_COSINE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each asking row with other rows.

    ``asks`` is a condition on the columns of ``df``.  Components are floored after
    scaling, so products are integers and exact; ties go to the smaller key.  Tasks
    hold a part of the vectors and a block of the queries; only queries whose
    threshold the part's longest vector can reach are sent to it.  What reaches the
    driver is bounded: ``seed_rows`` vectors and two numbers for each class of length.

    Vectors that are null or hold a null or non-finite component, and rows with a
    null key, take no part; an empty vector does, with products of 0, and shorter
    vectors count as padded with zeros.  Of rows that repeat a key the one with the
    smallest vector counts.  A query with fewer than ``k`` others gets them all.
    A product beyond 64 bits raises.  An empty table gives an empty result.
    """
    points, n = materialize_counted(integer_vectors(df, asks, scale, key, vector), "vectors")
    classes = max(1, min(MOST_CLASSES, -(-n // part_rows)))
    bounds: list[float] = []
    if classes > 1:
        shares = [i / classes for i in range(1, classes)]
        bounds = points.agg(F.percentile_approx("length", shares, 10 * classes).alias("at")).first()["at"]
    # Class 0 has the longest vectors; vectors of one length are in one class, which parts then cut.
    above = F.filter(F.array(*map(F.lit, bounds)), lambda b: b > F.col("length"))
    ranged = points.withColumn("cls", F.size(above) if bounds else F.lit(0))
    longest_first = [F.col("length").desc(), F.col("id")]
    stats = ranged.groupBy("cls").agg(
        F.max("length").alias("longest"), F.count(F.lit(1)).alias("rows"), F.max(F.size("vec")).alias("width"),
        F.count_if("asks").alias("queries"),
    ).orderBy("cls").collect()
    schema = "query_id bigint, vec_id bigint, score bigint"
    if not stats:
        return df.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = max(row["width"] for row in stats)
    parts = {row["cls"]: -(-row["rows"] // part_rows) for row in stats}
    first_part = dict(zip(parts, np.cumsum([0, *parts.values()])[:-1].tolist()))
    blocks = max(1, -(-sum(row["queries"] for row in stats) // query_rows))
    numbers, longest = list(parts), np.array([row["longest"] for row in stats])
    # Parts of the classes up to each one.
    through = np.array([first_part[c] + parts[c] for c in numbers])

    seeds = pd.DataFrame(
        [tuple(r) for r in ranged.select("id", "vec").orderBy(*longest_first).limit(seed_rows).collect()],
        columns=["id", "vec"],
    )
    seed_vectors, seed_ids = _matrix(seeds["vec"], width), seeds["id"].to_numpy(dtype=np.int64)
    none = np.iinfo(np.int64).min

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query with its threshold, once for every part that may hold a better one."""
        for frame in frames:
            for at in range(0, len(frame), QUERY_CHUNK):
                chunk = frame.iloc[at : at + QUERY_CHUNK]
                rows = _matrix(chunk["vec"], width)
                score = products(rows, seed_vectors)
                score[chunk["id"].to_numpy()[:, None] == seed_ids[None, :]] = none
                if score.shape[1] >= k:
                    known = np.partition(score, -k, axis=1)[:, -k]
                else:
                    known = np.full(len(chunk), none)
                reach = chunk["length"].to_numpy()[:, None] * longest[None, :] * (1 + SLACK)
                visited = (known[:, None] <= 0) | (reach >= known[:, None])
                # Classes get shorter, so those that can be reached come first.
                last = through[np.maximum(visited.sum(axis=1), 1) - 1]
                again = np.repeat(np.arange(len(chunk)), last)
                part = np.concatenate([np.arange(x) for x in last])
                yield pd.DataFrame(
                    {
                        "part": part,
                        "block": chunk["block"].to_numpy()[again],
                        "id": chunk["id"].to_numpy()[again],
                        "vec": chunk["vec"].to_numpy()[again],
                        "known": known[again],
                    }
                )

    digest = F.xxhash64("id")
    asked = (
        ranged.filter("asks")
        .select("id", "vec", "length", F.pmod(digest, F.lit(blocks)).cast("int").alias("block"))
        .mapInPandas(route, "part int, block int, id bigint, vec array<bigint>, known bigint")
    )
    # A class's first part and number of parts; classes are few.
    table = F.array(*(F.struct(F.lit(first_part.get(c, 0)).alias("at"), F.lit(parts.get(c, 1)).alias("n")) for c in range(max(numbers) + 1)))
    own = F.get(table, F.col("cls"))
    # The digest's upper half cuts classes into parts, as its lower half may cut blocks.
    held = ranged.select(
        (own["at"] + F.pmod(F.shiftright(digest, 32), own["n"])).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "id",
        "vec",
    )

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        found = search(
            _matrix(left["vec"], width),
            left["id"].to_numpy(dtype=np.int64),
            left["known"].to_numpy(dtype=np.int64),
            _matrix(right["vec"], width),
            right["id"].to_numpy(dtype=np.int64),
            k,
            bucket_rows,
            coordinate_cosine,
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    found = (
        asked.groupBy("part", "block").cogroup(held.groupBy("part", "block")).applyInPandas(compare, schema)
    )
    order = [F.col("score").desc(), F.col("vec_id")]
    return first_per_group(found, ["query_id"], order, k, rank="rank").select(
        "query_id", "rank", "vec_id", "score"
    )
