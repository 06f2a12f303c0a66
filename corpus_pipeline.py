"""From raw documents to token ids: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.llm import bpe, exact, golay, machine, mixing, sampling
from echoloom.llm.queries import VOCABULARY
from echoloom.workspace import materialize

# Of a stored file's name: the number of the part, and that of the file within the part.
PART, FILE = r"^part-(\d+)", r"-c(\d+)\."
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not reject; see ``machine.drop_toxic`` for odd rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    usable = ~sampling.held_out(F.col("doc_id"), 5, 0)
    return machine.drop_toxic(docs, machine.fit_toxicity(docs, labels, usable))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, null ones counting as empty, the document with the largest id."""
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of four-word shingles at most four bits apart, directly or
    through others, the one with the smallest id; rows without id stay."""
    return golay.drop_near_duplicates(docs, shingle=golay.SHINGLE, most=golay.MOST_BITS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which their sources take turns by their weights.

    The order is that of the stored files' numbers and of the rows in each file.  A null
    source is one of the sources.
    """
    return mixing.in_mixed_order(docs, mixing.tempered_weights(docs))


def placed(docs: DataFrame, out: str = "position") -> DataFrame:
    """Stored ``docs`` with ``out``: rising, not gapless numbers in the order in which rows were written.

    A reader may take files in any order, but every row tells its file and place.  A
    column called ``out`` is replaced.
    """
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    part = F.regexp_extract(name, PART, 1).cast("bigint")
    file = F.regexp_extract(name, FILE, 1).cast("bigint")
    # 24 bits of parts, 8 of files within a part, 31 of rows within a file.
    number = F.shiftleft(part, 39) + F.shiftleft(file, 31) + row
    return docs.select(*(c for c in docs.columns if c != out), number.alias(out))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, digests of ids and decoded text and place in the mixture of every document."""
    return bpe.encoded_digests(
        placed(docs), bpe.read_vocabulary(spark, VOCABULARY), carried=["position"]
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix),
    ("bpe", encode),
]

# Fitted models and token ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet for the next one; rows in the order of the mixture."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir).orderBy("position")
