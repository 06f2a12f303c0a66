"""Term statistics and TF-IDF features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    ElementwiseProduct,
    Normalizer,
    SQLTransformer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echoloom.constants import MAX_TERMS
from echoloom.functions.text import ngrams, tokenize
from echoloom.operators.grams import TermCounts, counted_terms, frequent_terms
from echoloom.operators.keyed import counted_lookup_join
from echoloom.workspace import materialize


def with_grams(reviews: DataFrame, content: str, longest: int) -> DataFrame:
    """Add ``grams``, the 1- to ``longest``-word terms of the text."""
    words = reviews.withColumn("_words", tokenize(F.col(content)))
    return words.withColumn("grams", ngrams("_words", longest)).drop("_words")


def term_statistics(
    reviews: DataFrame, content: str = "content", longest: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """Uses and containing documents of every term, as (by, term, uses, documents).

    One pass and one shuffle: batches of texts are counted where they are read, so
    frequent terms do not pile up.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    if by:
        grams = with_grams(reviews, content, longest).select(*by, "grams")

        def entry(term, uses, documents):
            return F.struct(term.alias("term"), uses.alias("uses"), documents.alias("documents"))

        entries = F.concat(
            F.transform("grams", lambda t: entry(t, one, zero)),
            F.transform(F.array_distinct("grams"), lambda t: entry(t, zero, one)),
        )
        counted = grams.select(*by, F.inline(entries))
    else:
        words = reviews.select(tokenize(F.col(content)).alias("_words"))
        counted = counted_terms(words, "_words", longest)
    return counted.groupBy(*by, "term").agg(
        F.sum("uses").alias("uses"), F.sum("documents").alias("documents")
    )


def vocabulary(statistics: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """The ``max_terms`` most used terms, ties by term."""
    return statistics.orderBy(F.col("uses").desc(), F.col("term")).limit(max_terms)


def tfidf_model(
    train: DataFrame,
    content: str = "content",
    features: str = "features",
    longest: int = 2,
    max_terms: int = MAX_TERMS,
) -> PipelineModel:
    """TF-IDF with unit rows, fitted on ``train`` only.

    The size of the vocabulary is the bound on what reaches the driver.  Weights are ``tf * (ln((1 + n) / (1 + df)) + 1)``.
    """
    documents = train.filter(F.col(content).isNotNull())
    n = documents.count()
    words = documents.select(F.lower(F.col(content)).alias("_words"))
    terms = vocabulary(frequent_terms(words, "_words", longest, max_terms), max_terms).collect()
    if not terms:
        raise ValueError("the training texts hold no words")
    weights = [math.log((1 + n) / (1 + row["documents"])) + 1 for row in terms]
    stages = [
        TermCounts(inputCol=content, outputCol="_counts", vocabulary=[row["term"] for row in terms]),
        ElementwiseProduct(
            scalingVec=Vectors.dense(weights), inputCol="_counts", outputCol="_weighted"
        ),
        Normalizer(p=2.0, inputCol="_weighted", outputCol=features),
        SQLTransformer(
            statement="SELECT * EXCEPT (_counts, _weighted) FROM __THIS__"
        ),
    ]
    return PipelineModel(stages)


def term_counts(
    reviews: DataFrame, keep: Sequence[str], content: str = "content", longest: int = 1
) -> DataFrame:
    """One row per text and distinct term: the columns of ``keep``, term, tf.

    Counted within the row, from the runs of its sorted terms: no shuffle.
    """
    ordered = F.array_sort(F.array_compact("grams"))
    starts = F.array_compact(
        F.transform(
            "_sorted", lambda t, i: F.when(~t.eqNullSafe(F.get("_sorted", i - 1)), i)
        )
    )
    runs = F.transform(
        "_starts",
        lambda start, i: F.struct(
            F.get("_sorted", start).alias("term"),
            (F.coalesce(F.get("_starts", i + 1), F.size("_sorted")) - start)
            .cast("bigint")
            .alias("tf"),
        ),
    )
    return (
        with_grams(reviews, content, longest)
        .select(*keep, ordered.alias("_sorted"))
        .select(*keep, "_sorted", starts.alias("_starts"))
        .select(*keep, F.inline(runs))
    )


def tfidf_terms(
    reviews: DataFrame, key: str = "review_id", content: str = "content", longest: int = 1
) -> DataFrame:
    """The same weights as a long table over the whole vocabulary.

    Texts are read once, each row of ``key`` being one text: its counts are
    stored, frequencies and weights derive from them.
    Columns: key, term, tf, df, weight (unit length per document).
    """
    documents = reviews.filter(F.col(content).isNotNull())
    counts = materialize(term_counts(documents, [key], content, longest), "counts")
    documents_with = F.count(F.lit(1))
    frequencies = counts.groupBy("term").agg(
        documents_with.alias("df"), documents_with.alias("_rows")
    )
    n = documents.agg(F.count(F.lit(1))).scalar()
    raw = F.col("tf") * (F.ln((1.0 + n) / (1.0 + F.col("df"))) + 1.0)
    # A document's terms are bounded by its own text, so its window is too.
    length = F.sqrt(F.sum(F.pow("_raw", F.lit(2.0))).over(Window.partitionBy(key)))
    return (
        counted_lookup_join(
            counts, materialize(frequencies, "frequencies"), ["term"], [key], "_rows", how="inner"
        )
        .withColumn("_raw", raw)
        .withColumn("weight", F.col("_raw") / length)
        .drop("_raw")
    )
