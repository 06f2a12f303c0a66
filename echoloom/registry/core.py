"""Collects the queries the driver runs and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# SQL twins of echoloom.sources.fixtures and the column functions.
REVIEWS = """reviews AS (
  SELECT d.doc_id AS review_id, d.source AS app_id, d.lang, d.text AS content,
         CASE WHEN l.toxic = 1 THEN 1 WHEN l.quality = 0 THEN 3 WHEN l.quality = 1 THEN 5 END AS score
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def sentiment(score: str) -> str:
    return (
        f"CASE WHEN {score} <= 2 THEN 'Negative' WHEN {score} = 3 THEN 'Neutral' "
        f"WHEN {score} >= 4 THEN 'Positive' ELSE 'Unknown' END"
    )


LABELLED = f"""{REVIEWS},
labelled AS (SELECT *, {sentiment('score')} AS sentiment FROM reviews)"""

CLUSTERED = f"""{LABELLED},
clustered AS (
  SELECT review_id, app_id, content, sentiment,
         CASE WHEN review_id % 5 = 0 THEN -1 WHEN lang = 'de' THEN 0 WHEN lang = 'en' THEN 1
              WHEN lang = 'es' THEN 2 ELSE 3 END AS cluster,
         CASE WHEN review_id % 5 = 0 THEN 'Uncategorized' ELSE lang END AS clean_topic
  FROM labelled)"""


def replace_all(text: str, *rules: tuple[str, str]) -> str:
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


def clean(text: str) -> str:
    return "trim(" + replace_all(
        text, ("<.*?>", ""), (r"http\S+|www\S+", ""), (r"\s+", " ")
    ) + ")"


def words(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"
