"""Text embeddings, reduced vectors, cluster keywords and topic names."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, Normalizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from echoloom.constants import NOISE, UNCATEGORIZED
from echoloom.functions.text import ngrams, tokenize
from echoloom.operators.keyed import counted_lookup_join, first_per_group, lookup_join
from echoloom.workspace import materialize, send_with_tasks

send_with_tasks(__name__)

DIMENSIONS = 256
BLOCK_WORDS = 500_000  # of the texts that look up their words together
REDUCED = 10
# Texts per cluster sample, keywords per topic, their diversity and separator.
SAMPLE_TEXTS = 200
KEYWORDS = 3
DIVERSITY = 0.5
SEPARATOR = " | "
FIRST_TERMS = 200  # of a cluster, by score, that are tried for a place before all others


# --- embedding ---------------------------------------------------------------


@dataclass(frozen=True)
class TextEmbedder:
    """How many texts hold each word, as a stored table (term, documents), and all texts.

    ``words`` are the stored :func:`word_blocks` of the rows it was fitted on, so that these
    are not cut into words again.
    """

    terms: DataFrame
    texts: int
    dimensions: int = DIMENSIONS
    fitted_on: DataFrame | None = None
    words: DataFrame | None = None
    content: str = "content"
    key: str = "review_id"


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 with all first bytes before all second ones and so on, which compresses well."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _of_planes(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


def word_blocks(reviews: DataFrame, content: str = "content", key: str = "review_id") -> DataFrame:
    """Stored texts as blocks of about ``BLOCK_WORDS`` words: each names its words once.

    Columns: block, keys (of the texts), terms and documents (texts of the block that hold
    them), and as :func:`_planes` sizes (distinct words of each text), at and uses: the place in
    ``terms`` and the uses of each distinct word of a text.
    """
    kind = reviews.schema[key].dataType
    own = pa.schema([("keys", pa.list_(to_arrow_type(kind)))]).field("keys").type

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("_words")), 0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            at = 0
            while at < len(batch):
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_WORDS, side="right")))
                part = batch.slice(at, upto - at)
                words = part.column("_words").flatten().dictionary_encode()
                terms = words.dictionary
                found = np.repeat(np.arange(len(part)), sizes[at:upto]) * max(len(terms), 1) + words.indices.to_numpy()
                found, uses = np.unique(found, return_counts=True)
                row, place = np.divmod(found, max(len(terms), 1))
                columns = {
                    "keys": pa.array([part.column("_key").to_pylist()], own),
                    "terms": pa.array([terms.to_pylist()], pa.list_(pa.string())),
                    "documents": pa.array([np.bincount(place, minlength=len(terms))], pa.list_(pa.int64())),
                }
                numbers = {"sizes": np.bincount(row, minlength=len(part)), "at": place, "uses": uses}
                columns |= {name: pa.array([_planes(x)], pa.binary()) for name, x in numbers.items()}
                yield pa.RecordBatch.from_pydict(columns)
                at = upto

    words = reviews.select(F.col(key).alias("_key"), F.array_compact(tokenize(F.col(content))).alias("_words"))
    schema = f"keys array<{kind.simpleString()}>, terms array<string>, documents array<bigint>, sizes binary, at binary, uses binary"
    return materialize(words.mapInArrow(cut, schema).withColumn("block", F.monotonically_increasing_id()), "words")


def fit_embedder(
    reviews: DataFrame, content: str = "content", dimensions: int = DIMENSIONS, key: str = "review_id"
) -> TextEmbedder:
    """Document counts of every word; one aggregation, nothing of it on the driver."""
    words = word_blocks(reviews, content, key)
    each = words.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), "documents")))
    stored = materialize(each.groupBy("term").agg(F.sum("documents").alias("documents")), "terms")
    texts = reviews.filter(F.col(content).isNotNull()).count()
    return TextEmbedder(stored, texts, dimensions, reviews, words, content, key)


def embed_text(
    reviews: DataFrame,
    embedder: TextEmbedder,
    content: str = "content",
    out: str = "embedding",
    key: str = "review_id",
) -> DataFrame:
    """Add a unit vector per text: its TF-IDF words, each on a signed hashed dimension.

    Every word counts; one that the embedder never saw weighs like a word of no
    text.  A block of texts asks once for each of its words, in a join, and words come
    together again by ``key``, which names one row.  A text without words gets zeros.
    """
    width = embedder.dimensions
    if embedder.fitted_on is reviews and (embedder.content, embedder.key) == (content, key):
        words = embedder.words
    else:
        words = word_blocks(reviews, content, key)
    asked = words.select("block", F.posexplode("terms").alias("number", "term"))
    weighed = counted_lookup_join(asked, embedder.terms, ["term"], ["block"])
    digest = F.md5("term")
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % width
    sign = F.when(F.substring(digest, 9, 1) < "8", 1.0).otherwise(-1.0)
    seen = F.coalesce("documents", F.lit(0))
    weight = F.ln((1.0 + embedder.texts) / (1.0 + seen)) + 1.0
    answer = F.struct("number", place.cast("int").alias("place"), (sign * weight).alias("weight"))
    answers = weighed.groupBy("block").agg(F.array_sort(F.collect_list(answer)).alias("answers"))
    told = words.select("block", "keys", "sizes", "at", "uses").join(answers, "block")
    kind = reviews.schema[key].dataType.simpleString()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                keys = batch.column("keys")[i].values
                sizes, at, uses = (_of_planes(batch.column(name)[i].as_py()) for name in ("sizes", "at", "uses"))
                answers = batch.column("answers")[i].values
                place, weight = (answers.field(name).to_numpy(zero_copy_only=False) for name in ("place", "weight"))
                cell = np.repeat(np.arange(len(keys)), sizes) * width + place[at]
                sums = np.bincount(cell, uses * weight[at], len(keys) * width)
                raw = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * width, pa.int32()), pa.array(sums))
                yield pa.RecordBatch.from_arrays([keys, raw], [key, "_raw"])

    parts = told.mapInArrow(add_up, f"{key} {kind}, _raw array<double>")
    # Rows of one key, if there are several, are added up.
    sums = parts.groupBy(key).agg(F.collect_list("_raw").alias("_parts")).select(
        key,
        F.aggregate(
            F.slice("_parts", 2, F.size("_parts")), F.get("_parts", F.lit(0)), lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
        ).alias("_raw"),
    )
    length = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda a, x: a + x * x))
    vectors = sums.withColumn("_length", length).select(
        key, F.when(F.col("_length") > 0, F.transform("_raw", lambda v: v / F.col("_length"))).alias(out)
    )
    return (
        reviews.drop(out)
        .join(vectors, key, "left")
        .select(
            *(c for c in reviews.columns if c != out),
            F.coalesce(out, F.array_repeat(F.lit(0.0), F.lit(width))).alias(out),
        )
    )


# --- reduction ---------------------------------------------------------------


def fit_reducer(
    vectors: DataFrame, dimensions: int = REDUCED, vector: str = "embedding"
) -> PipelineModel:
    """Unit vectors onto their main axes; the fit sums one small matrix."""
    unit = Normalizer(p=2.0, inputCol="_vector", outputCol="_unit")
    prepared = vectors.filter(F.col(vector).isNotNull()).select(
        array_to_vector(F.col(vector)).alias("_vector")
    )
    axes = PCA(k=dimensions, inputCol="_unit", outputCol="_reduced").fit(unit.transform(prepared))
    return PipelineModel([unit, axes])


def reduce_dims(
    df: DataFrame, reducer: PipelineModel, vector: str = "embedding", out: str = "reduced"
) -> DataFrame:
    """Add the reduced vector, rounded so that it does not depend on summing order."""
    prepared = df.filter(F.col(vector).isNotNull()).withColumn(
        "_vector", array_to_vector(F.col(vector))
    )
    rounded = F.transform(vector_to_array("_reduced"), lambda x: F.round(x, 6))
    return (
        reducer.transform(prepared).withColumn(out, rounded).drop("_vector", "_unit", "_reduced")
    )


def project_2d(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add plot coordinates ``x`` and ``y``."""
    flat = reduce_dims(df, fit_reducer(df, 2, vector), vector, "_flat")
    return flat.withColumns(
        {"x": F.get("_flat", F.lit(0)), "y": F.get("_flat", F.lit(1))}
    ).drop("_flat")


# --- keywords ----------------------------------------------------------------


def cluster_sample_text(
    clustered: DataFrame,
    by: Sequence[str] = (),
    key: str = "review_id",
    n: int = SAMPLE_TEXTS,
) -> DataFrame:
    """First ``n`` texts of each real cluster, in key order, joined by a space."""
    first = first_per_group(
        clustered.filter((F.col("cluster") != NOISE) & F.col("content").isNotNull()).select(
            *by, "cluster", key, "content"
        ),
        [*by, "cluster"],
        [F.col(key)],
        n,
    )
    texts = F.array_sort(F.collect_list(F.struct(key, "content")))
    return first.groupBy(*by, "cluster").agg(
        F.array_join(F.transform(texts, lambda t: t["content"]), " ").alias("sample")
    )


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def keyword_candidates(
    clustered: DataFrame,
    by: Sequence[str] = (),
    stop_words: Sequence[str] | None = None,
    longest: int = 2,
    sample: int | None = None,
    key: str = "review_id",
) -> DataFrame:
    """All terms of each real cluster with their class-based TF-IDF (Grootendorst 2022).

    ``score = tf * ln(1 + mean words per cluster / uses in all clusters)``, over
    all texts of a cluster, or its first ``sample`` ones.  Columns: by, cluster,
    term, uses, score.
    """
    dropped = english_stop_words() if stop_words is None else list(stop_words)
    texts = clustered.filter(F.col("cluster") != NOISE).select(*by, "cluster", key, "content")
    if sample is not None:
        texts = first_per_group(texts, [*by, "cluster"], [F.col(key)], sample)
    words = tokenize(F.col("content"))
    kept = F.filter(words, lambda w: ~w.isin(dropped)) if dropped else words
    terms = (
        texts.select(*by, "cluster", kept.alias("_words"))
        .select(*by, "cluster", F.explode(ngrams("_words", longest)).alias("term"))
        .dropna(subset=[*by, "cluster", "term"])
        .groupBy(*by, "cluster", "term")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    # Counted once; the tables below all derive from it.
    terms = materialize(terms, "terms")
    per_cluster = terms.groupBy(*by, "cluster").agg(F.sum("uses").alias("_words"))
    mean = F.avg("_words").alias("_mean")
    # A term has one row for each cluster, so no group is larger than the number of clusters.
    everywhere = F.sum("uses").over(Window.partitionBy(*by, "term"))
    scored = terms.withColumn("_everywhere", everywhere)
    if by:
        # Stored, so that Spark knows its size and broadcasts it only when small.
        means = materialize(per_cluster.groupBy(*by).agg(mean), "means")
        scored = lookup_join(scored, means, list(by), ["term"], how="inner")
    else:
        scored = scored.withColumn("_mean", per_cluster.agg(mean).scalar())
    score = F.round(F.col("uses") * F.ln(1.0 + F.col("_mean") / F.col("_everywhere")), 9)
    return scored.select(*by, "cluster", "term", "uses", score.alias("score"))


def _similarity(a: Column, b: Column) -> Column:
    """Cosine of two phrases as sets of words."""
    shared = F.size(F.array_intersect(a, b))
    return shared / F.sqrt((F.size(a) * F.size(b)).cast("double"))


def _words(term: Column) -> Column:
    return F.array_distinct(F.split(term, " "))


def diverse_keywords(
    candidates: DataFrame,
    by: Sequence[str] = (),
    n: int = KEYWORDS,
    diversity: float = DIVERSITY,
) -> DataFrame:
    """Keywords per cluster by maximal marginal relevance (Carbonell and Goldstein 1998).

    Every term of a cluster competes for every place; ties go to the higher score, then
    by term.  The first terms by score are tried, and where they do not rule out the
    others, all are.  The picks, one row per cluster, are joined to the terms, and the best
    gain is combined on the map side.
    """
    keys = [*by, "cluster"]
    order = [F.col("score").desc(), F.col("term")]
    narrow = candidates.select(*keys, "term", "score")
    first = materialize(first_per_group(narrow, keys, order, FIRST_TERMS), "candidates")
    picks = materialize(_picked(first, keys, n, diversity), "picks")
    unsure = materialize(picks.filter(~F.col("_sure")).select(*keys), "unsure")
    if not unsure.isEmpty():
        # Terms beyond the first may do better here, so all of them compete.
        same = reduce(and_, (F.col(f"_{i}").eqNullSafe(F.col(c)) for i, c in enumerate(keys)))
        named = unsure.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keys)))
        whole = materialize(narrow.join(named, same, "left_semi"), "candidates")
        picks = picks.filter("_sure").unionByName(_picked(whole, keys, n, diversity, None))
    return picks.select(*keys, F.col("_picked").alias("keywords"))


def _picked(terms: DataFrame, keys: list[str], n: int, diversity: float, most: int | None = FIRST_TERMS) -> DataFrame:
    """(keys, _picked, _sure) from the stored first ``most`` terms of each cluster, or all of them.

    A pick is sure if no term beyond the first can gain more: these score no higher than
    the last of them, and none gains more than its share of the score.
    """
    rows = F.count(F.lit(1)).alias("_rows")
    best = F.min(F.struct((-F.col("score")).alias("_score"), "term")).alias("_best")
    picks = terms.groupBy(*keys).agg(best, rows, F.min("score").alias("_last")).select(
        *keys,
        "_rows",
        "_last",
        (-F.col("_best._score")).alias("_top"),
        F.array("_best.term").alias("_picked"),
        F.lit(True).alias("_sure"),
    )
    for _ in range(n - 1):
        joined = counted_lookup_join(
            terms, materialize(picks, "picks"), keys, ["term"], "_rows", how="inner"
        )
        closest = F.array_max(
            F.transform("_picked", lambda p: _similarity(F.col("_words"), _words(p)))
        )
        gain = F.round(
            (1 - diversity) * F.col("score") / F.col("_top") - diversity * closest, 9
        )
        place = F.struct((-gain).alias("_gain"), (-F.col("score")).alias("_score"), "term")
        best = F.min(F.when(~F.array_contains("_picked", F.col("term")), place)).alias("_best")
        beyond = F.round((1 - diversity) * F.col("_last") / F.col("_top"), 9)
        sure = F.coalesce((F.col("_top") > 0) & (-F.col("_best._gain") >= beyond), F.lit(False))
        picks = (
            joined.withColumn("_words", _words(F.col("term")))
            .groupBy(*keys, "_top", "_picked", "_last", "_sure")
            .agg(best, rows)
            .select(
                *keys,
                "_rows",
                "_last",
                "_top",
                F.when(F.col("_best").isNull(), F.col("_picked"))
                .otherwise(F.concat("_picked", F.array("_best.term")))
                .alias("_picked"),
                (F.col("_sure") & (sure if most is None else sure | (F.col("_rows") < most))).alias("_sure"),
            )
        )
    return picks.select(*keys, "_picked", F.lit(True).alias("_sure") if most is None else "_sure")


def cluster_topics(
    clustered: DataFrame, by: Sequence[str] = (), n: int = KEYWORDS, **options
) -> DataFrame:
    """(by, cluster, topic): keywords of each cluster, Uncategorized for noise."""
    keywords = diverse_keywords(keyword_candidates(clustered, by, **options), by, n).select(
        *by, "cluster", F.array_join("keywords", SEPARATOR).alias("topic")
    )
    clusters = clustered.select(*by, "cluster").distinct()
    topic = F.when(F.col("cluster") == NOISE, UNCATEGORIZED).otherwise(F.coalesce("topic", F.lit("")))
    return clusters.join(keywords, [*by, "cluster"], "left").withColumn("topic", topic)


def name_topics(cluster_topics: DataFrame) -> DataFrame:
    """(topic, clean_topic): first keyword in title case; a topic without words has no name."""
    first = F.get(F.split("topic", r" \| "), F.lit(0))
    return (
        cluster_topics.select("topic")
        .filter(F.col("topic").isNotNull() & (F.col("topic") != UNCATEGORIZED))
        .distinct()
        .select("topic", F.nullif(F.initcap(first), F.lit("")).alias("clean_topic"))
    )
