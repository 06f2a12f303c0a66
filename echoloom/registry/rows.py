"""Queries for scans, sinks, projections, filters, expressions and lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echoloom.constants import Warehouse
from echoloom.functions import labels, text
from echoloom.operators import rows
from echoloom.plans import layers
from echoloom.registry.core import (
    CLUSTERED,
    LABELLED,
    REVIEWS,
    clean,
    query,
    replace_all,
    sentiment,
    words,
)
from echoloom.sources import fixtures, readers, writers
from echoloom.workspace import materialize, scratch_path

SOURCE = "parquet.documents"
BATCH_DATE = "2024-01-31"
GOLD_SQL = f"SELECT review_id, app_id, {clean('content')} AS content, sentiment FROM labelled"


def _new_warehouse() -> Warehouse:
    return Warehouse(prefix=f"w{uuid.uuid4().hex[:12]}_")


def _stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table of a fresh schema and read it back by name."""
    warehouse = _new_warehouse()
    writers.create_schemas(spark, warehouse, ["bronze"], scratch_path(spark, "tables"))
    return writers.sink_table(df, warehouse.table("bronze", name))


# --- scans and sinks ---------------------------------------------------------


@query("scan_table", f"WITH {REVIEWS} SELECT review_id, app_id, content, score FROM reviews")
def scan_table(spark, sf_dir):
    warehouse = _new_warehouse()
    writers.create_schemas(spark, warehouse, ["bronze"], scratch_path(spark, "tables"))
    name = warehouse.table("bronze", "raw_reviews")
    writers.sink_table(fixtures.reviews(spark, sf_dir).drop("lang"), name)
    return readers.scan_table(spark, name)


@query(
    "sink_table",
    f"WITH {LABELLED} SELECT sentiment, count(*) AS reviews, "
    "CAST(sum(length(content)) AS BIGINT) AS characters FROM labelled GROUP BY sentiment",
)
def sink_table(spark, sf_dir):
    stored = _stored(spark, fixtures.reviews_with_sentiment(spark, sf_dir), "raw_reviews")
    return stored.groupBy("sentiment").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum(F.length("content")).alias("characters")
    )


@query("scan_csv", f"WITH {REVIEWS} SELECT review_id, app_id, content, score FROM reviews")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    writers.sink_csv(
        fixtures.reviews(spark, sf_dir), path, ("review_id", "app_id", "content", "score")
    )
    return readers.scan_csv(spark, path)


@query(
    "sink_csv",
    f"WITH {CLUSTERED} SELECT content, sentiment, cluster, clean_topic AS topic FROM clustered",
)
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    exported = fixtures.clustered(spark, sf_dir).withColumnRenamed("clean_topic", "topic")
    writers.sink_csv(exported, path)
    schema = exported.select("content", "sentiment", "cluster", "topic").schema
    return readers.scan_csv(spark, path, schema)


@query(
    "scan_json_pages",
    """WITH turns AS (
      SELECT CAST(conv_id AS VARCHAR) AS app_id, turn // 2 AS page, turn % 2 AS position, text AS content
      FROM conversations WHERE text <> ''),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY page, position) AS review_no FROM turns)
    SELECT app_id, CAST(page AS BIGINT) AS page, CAST(position AS INT) AS position, content,
           CAST(review_no AS INT) AS review_no
    FROM ranked WHERE review_no <= 5""",
)
def scan_json_pages(spark, sf_dir):
    turns = fixtures.table(spark, sf_dir, "conversations")
    page = F.floor(F.col("turn") / 2)
    last = turns.groupBy("conv_id").agg(F.floor(F.max("turn") / 2).alias("last_page"))
    pages = (
        turns.groupBy("conv_id", page.alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("turn", F.col("text").alias("snippet")))).alias("r"))
        .join(last, "conv_id")
        .select(
            F.col("conv_id").cast("string").alias("app_id"),
            "page",
            F.to_json(
                F.struct(
                    F.transform("r", lambda t: F.struct(t["snippet"].alias("snippet"))).alias("reviews"),
                    F.when(
                        F.col("page") < F.col("last_page"),
                        F.struct(F.concat(F.lit("p"), F.col("page") + 1).alias("next_page_token")),
                    ).alias("serpapi_pagination"),
                )
            ).alias("body"),
        )
    )
    return readers.scan_json_pages(pages, max_reviews=5)


@query(
    "scan_html_reviews",
    """WITH nodes AS (SELECT page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)[1:50] AS found FROM pages),
    flat AS (SELECT page_id, generate_subscripts(found, 1) AS n, unnest(found) AS content FROM nodes)
    SELECT page_id, CAST(n - 1 AS INT) AS position, regexp_replace(content, '<[^>]*>', '', 'g') AS content FROM flat""",
)
def scan_html_reviews(spark, sf_dir):
    return readers.scan_html_reviews(fixtures.table(spark, sf_dir, "pages"), "page_id")


@query(
    "scan_html_class",
    """WITH nodes AS (SELECT page_id, regexp_extract_all(html, '(?s)<div[^>]*class="ad"[^>]*>(.*?)</div>', 1)[1:50] AS found FROM pages),
    flat AS (SELECT page_id, generate_subscripts(found, 1) AS n, unnest(found) AS content FROM nodes)
    SELECT page_id, CAST(n - 1 AS INT) AS position, regexp_replace(content, '<[^>]*>', '', 'g') AS content FROM flat""",
)
def scan_html_class(spark, sf_dir):
    return readers.scan_html_reviews(
        fixtures.table(spark, sf_dir, "pages"), "page_id", tag="div", css_class="ad"
    )


@query(
    "verify_count",
    f"""WITH {LABELLED} SELECT layer, (SELECT count(*) FROM labelled) AS row_count
    FROM (VALUES ('bronze'), ('silver'), ('gold')) AS t(layer)""",
)
def verify_count(spark, sf_dir):
    _, counts = layers.run_medallion(
        spark,
        fixtures.reviews(spark, sf_dir).drop("lang"),
        SOURCE,
        BATCH_DATE,
        _new_warehouse(),
        scratch_path(spark, "tables"),
    )
    return spark.createDataFrame(list(counts.items()), "layer string, row_count bigint")


@query(
    "row_shape",
    f"WITH {REVIEWS} SELECT count(*) AS row_count, 5 AS column_count FROM reviews",
)
def row_shape(spark, sf_dir):
    return rows.row_shape(fixtures.reviews(spark, sf_dir))


# --- projections and expressions ---------------------------------------------


@query("project_columns", f"WITH {REVIEWS} SELECT content, score FROM reviews")
def project_columns(spark, sf_dir):
    return rows.project_columns(fixtures.reviews(spark, sf_dir), "content", "score")


@query("drop_columns", f"WITH {LABELLED} SELECT review_id, app_id, lang, content, sentiment FROM labelled")
def drop_columns(spark, sf_dir):
    return rows.drop_columns(fixtures.reviews_with_sentiment(spark, sf_dir), "score")


@query(
    "rename_columns",
    f"WITH {LABELLED} SELECT review_id, content AS review, sentiment AS label FROM labelled",
)
def rename_columns(spark, sf_dir):
    df = fixtures.reviews_with_sentiment(spark, sf_dir).select("review_id", "content", "sentiment")
    return rows.rename_columns(df, {"content": "review", "sentiment": "label"})


@query(
    "add_ingest_metadata",
    f"WITH {REVIEWS} SELECT review_id, score, '{SOURCE}' AS _source, '{BATCH_DATE}' AS _batch_date FROM reviews",
)
def add_ingest_metadata(spark, sf_dir):
    df = fixtures.reviews(spark, sf_dir).select("review_id", "score")
    return rows.add_ingest_metadata(df, SOURCE, BATCH_DATE).drop("_ingested_at")


@query(
    "score_to_sentiment",
    f"""WITH {REVIEWS}, scored AS (
      SELECT review_id, score FROM reviews
      UNION ALL SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INT) FROM orders)
    SELECT review_id, score, {sentiment('score')} AS sentiment FROM scored""",
)
def score_to_sentiment(spark, sf_dir):
    scored = (
        fixtures.reviews(spark, sf_dir)
        .select("review_id", "score")
        .unionByName(fixtures.scored_orders(spark, sf_dir).drop("o_custkey"))
    )
    return scored.withColumn("sentiment", labels.sentiment_from_score(F.col("score")))


DIRTY = """dirty AS (
  SELECT 'document' AS kind, doc_id AS id, text AS content FROM documents
  UNION ALL SELECT 'page', page_id, html FROM pages
  UNION ALL SELECT 'url', page_id, url || ' ' || url || ' x' FROM pages)"""


def _dirty(spark, sf_dir) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("content")
    )
    pages = fixtures.table(spark, sf_dir, "pages")
    html = pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("content"))
    urls = pages.select(
        F.lit("url").alias("kind"),
        F.col("page_id").alias("id"),
        F.concat_ws(" ", "url", "url", F.lit("x")).alias("content"),
    )
    return documents.unionByName(html).unionByName(urls)


@query("clean_text", f"WITH {DIRTY} SELECT kind, id, {clean('content')} AS content FROM dirty")
def clean_text(spark, sf_dir):
    return _dirty(spark, sf_dir).withColumn("content", text.clean_text(F.col("content")))


NORMALIZED = "trim(" + replace_all(
    "lower(content)",
    (r"http\S+", ""),
    (r"\d+", ""),
    (r"[!-/:-@\[-`{-~]", ""),
    (r"\s+", " "),
) + ")"


@query("normalize_for_scoring", f"WITH {DIRTY} SELECT kind, id, {NORMALIZED} AS content FROM dirty")
def normalize_for_scoring(spark, sf_dir):
    return _dirty(spark, sf_dir).withColumn("content", text.normalize_for_scoring(F.col("content")))


@query(
    "encode_label",
    f"""WITH {LABELLED} SELECT review_id, CASE sentiment WHEN 'Negative' THEN 0 WHEN 'Neutral' THEN 1
    WHEN 'Positive' THEN 2 END AS label FROM labelled""",
)
def encode_label(spark, sf_dir):
    df = fixtures.reviews_with_sentiment(spark, sf_dir)
    return df.select("review_id", labels.encode_label(F.col("sentiment")).alias("label"))


@query(
    "decode_label",
    """SELECT o_orderkey AS review_id, CASE CAST(substr(o_orderpriority, 1, 1) AS INT) - 1
      WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' WHEN 2 THEN 'Positive' ELSE 'Unknown' END AS sentiment
    FROM orders""",
)
def decode_label(spark, sf_dir):
    return fixtures.scored_orders(spark, sf_dir).select(
        "review_id", labels.decode_label(F.col("score") - 1).alias("sentiment")
    )


@query(
    "extract_app_id",
    """SELECT page_id,
      coalesce(nullif(regexp_extract(url, 'id=([^&]+)', 1), ''), 'unknown') AS app_id,
      coalesce(nullif(regexp_extract(url, 'ref=([^&]+)', 1), ''), 'unknown') AS ref,
      coalesce(nullif(regexp_extract(url, 'utm_source=([^&]+)', 1), ''), 'unknown') AS utm_source
    FROM pages""",
)
def extract_app_id(spark, sf_dir):
    url = F.col("url")
    return fixtures.table(spark, sf_dir, "pages").select(
        "page_id",
        text.url_parameter(url).alias("app_id"),
        text.url_parameter(url, "ref").alias("ref"),
        text.url_parameter(url, "utm_source").alias("utm_source"),
    )


@query(
    "cast_types",
    """SELECT o_orderkey AS review_id, TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority
      ELSE substr(o_orderpriority, 1, 1) END AS DOUBLE) AS score FROM orders""",
)
def cast_types(spark, sf_dir):
    textual = fixtures.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderpriority"))
        .otherwise(F.substring("o_orderpriority", 1, 1))
        .alias("score"),
    )
    return rows.cast_types(textual)


@query(
    "tokenize_reviews",
    f"WITH {REVIEWS} SELECT review_id, array_to_string({words('content')}, ' ') AS words FROM reviews",
)
def tokenize_reviews(spark, sf_dir):
    tokens = rows.tokenize_reviews(fixtures.reviews(spark, sf_dir))
    return tokens.select("review_id", F.array_join("words", " ").alias("words"))


# --- filters and profiling ---------------------------------------------------


@query(
    "filter_eq",
    """SELECT o_orderkey AS review_id, o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INT) AS score
    FROM orders WHERE CAST(substr(o_orderpriority, 1, 1) AS INT) = 2""",
)
def filter_eq(spark, sf_dir):
    return rows.filter_eq(fixtures.scored_orders(spark, sf_dir), "score", 2)


@query("filter_noise", f"WITH {CLUSTERED} SELECT review_id, cluster, clean_topic FROM clustered WHERE cluster <> -1")
def filter_noise(spark, sf_dir):
    df = fixtures.clustered(spark, sf_dir).select("review_id", "cluster", "clean_topic")
    return rows.filter_noise(df)


@query(
    "drop_nulls",
    f"WITH {REVIEWS} SELECT review_id, score FROM reviews WHERE content IS NOT NULL AND score IS NOT NULL",
)
def drop_nulls(spark, sf_dir):
    return rows.drop_nulls(fixtures.reviews(spark, sf_dir), "content", "score").select("review_id", "score")


@query(
    "profile_nulls",
    f"WITH {REVIEWS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM reviews"
        for c in ("review_id", "app_id", "lang", "content", "score")
    ),
)
def profile_nulls(spark, sf_dir):
    return rows.profile_nulls(fixtures.reviews(spark, sf_dir))


@query("distinct_values", f"WITH {CLUSTERED} SELECT DISTINCT sentiment, cluster, clean_topic FROM clustered")
def distinct_values(spark, sf_dir):
    return rows.distinct_values(fixtures.clustered(spark, sf_dir), "sentiment", "cluster", "clean_topic")


@query("preview", f"WITH {REVIEWS} SELECT review_id, app_id, content FROM reviews ORDER BY review_id LIMIT 5")
def preview(spark, sf_dir):
    return rows.preview(fixtures.reviews(spark, sf_dir).select("review_id", "app_id", "content"))


@query("sort_rows", "SELECT o_orderkey AS review_id, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_rows(spark, sf_dir):
    df = fixtures.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("review_id"), "o_totalprice")
    return rows.sort_rows(df, F.col("o_totalprice").desc(), F.col("review_id"))


@query(
    "top_k",
    """SELECT o_custkey, o_orderkey AS review_id, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
)
def top_k(spark, sf_dir):
    df = fixtures.table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderkey").alias("review_id"), "o_totalprice"
    )
    return rows.top_k(df, [F.col("o_totalprice").desc(), F.col("review_id")], 3, ["o_custkey"])


@query(
    "dedup_reviews",
    f"""WITH {REVIEWS} SELECT review_id, app_id, content FROM reviews
    QUALIFY row_number() OVER (PARTITION BY app_id, content ORDER BY review_id) = 1""",
)
def dedup_reviews(spark, sf_dir):
    return rows.dedup_reviews(fixtures.reviews(spark, sf_dir).select("review_id", "app_id", "content"))


# --- lookups -----------------------------------------------------------------


@query(
    "join_cluster_topic",
    f"""WITH {CLUSTERED}, topics AS (
      SELECT cluster, min(clean_topic) || ' | ' || max(clean_topic) AS topic
      FROM clustered WHERE cluster <> 2 GROUP BY cluster)
    SELECT c.review_id, c.cluster, t.topic FROM clustered c LEFT JOIN topics t ON c.cluster = t.cluster""",
)
def join_cluster_topic(spark, sf_dir):
    df = fixtures.clustered(spark, sf_dir)
    topics = (
        df.filter(F.col("cluster") != 2)
        .groupBy("cluster")
        .agg(F.concat_ws(" | ", F.min("clean_topic"), F.max("clean_topic")).alias("topic"))
    )
    stored = materialize(df.select("review_id", "cluster"), "clustered")
    return rows.join_cluster_topic(stored, topics)


@query(
    "join_clean_topic",
    f"""WITH {CLUSTERED}, topics AS (
      SELECT review_id, CASE WHEN cluster = 3 THEN NULL ELSE clean_topic END AS topic FROM clustered),
    names AS (SELECT topic, upper(topic) || ' issues' AS name FROM topics
      WHERE topic IN ('de', 'en') GROUP BY topic)
    SELECT t.review_id, t.topic, CASE WHEN t.topic IS NULL THEN NULL WHEN t.topic = 'Uncategorized' THEN t.topic
      ELSE coalesce(n.name, 'Unknown Topic') END AS clean_topic
    FROM topics t LEFT JOIN names n ON t.topic = n.topic""",
)
def join_clean_topic(spark, sf_dir):
    topics = fixtures.clustered(spark, sf_dir).select(
        "review_id", F.when(F.col("cluster") != 3, F.col("clean_topic")).alias("topic")
    )
    names = (
        topics.filter(F.col("topic").isin("de", "en"))
        .select("topic")
        .distinct()
        .withColumn("clean_topic", F.concat(F.upper("topic"), F.lit(" issues")))
    )
    return rows.join_clean_topic(topics, names)


@query(
    "stale_apps",
    """WITH apps AS (SELECT DISTINCT user_id AS app_id FROM events),
    results AS (SELECT user_id AS app_id, max(ts) AS computed_at FROM events
      WHERE event_type = 'click' GROUP BY user_id)
    SELECT app_id FROM apps WHERE app_id NOT IN (
      SELECT app_id FROM results WHERE epoch_us(TIMESTAMP '2024-01-30 23:59:00') - epoch_us(computed_at) < 172800000000)""",
)
def stale_apps(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").withColumnRenamed("user_id", "app_id")
    results = (
        events.filter(F.col("event_type") == "click")
        .groupBy("app_id")
        .agg(F.max("ts").cast("timestamp").alias("computed_at"))
    )
    now = F.lit("2024-01-30 23:59:00").cast("timestamp")
    return rows.stale_apps(events.select("app_id").distinct(), results, now, ttl_seconds=172_800)


# --- layers ------------------------------------------------------------------


def _raw(spark, sf_dir) -> DataFrame:
    return fixtures.reviews(spark, sf_dir).drop("lang")


@query(
    "bronze_layer",
    f"""WITH {REVIEWS} SELECT review_id, app_id, content, score, '{SOURCE}' AS _source,
      '{BATCH_DATE}' AS _batch_date FROM reviews""",
)
def bronze_layer(spark, sf_dir):
    bronze = layers.bronze_layer(_raw(spark, sf_dir), SOURCE, BATCH_DATE)
    return _stored(spark, bronze, "bronze_reviews").drop("_ingested_at")


@query("silver_layer", f"WITH {LABELLED} SELECT review_id, app_id, content, sentiment FROM labelled")
def silver_layer(spark, sf_dir):
    return _stored(spark, layers.silver_layer(_raw(spark, sf_dir)), "silver_reviews")


@query("gold_layer", f"WITH {LABELLED} {GOLD_SQL}")
def gold_layer(spark, sf_dir):
    gold = layers.gold_layer(layers.silver_layer(_raw(spark, sf_dir)))
    return _stored(spark, gold, "gold_reviews")


@query("medallion", f"WITH {LABELLED} {GOLD_SQL}")
def medallion(spark, sf_dir):
    gold, _ = layers.run_medallion(
        spark, _raw(spark, sf_dir), SOURCE, BATCH_DATE, _new_warehouse(), scratch_path(spark, "tables")
    )
    return gold


@query(
    "medallion_options",
    f"""WITH {LABELLED}, gold AS ({GOLD_SQL}), one AS (
      SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY app_id, content ORDER BY review_id) = 1)
    SELECT review_id, app_id, content, sentiment, array_to_string({words('content')}, ' ') AS words FROM one""",
)
def medallion_options(spark, sf_dir):
    gold = layers.medallion(_raw(spark, sf_dir), SOURCE, BATCH_DATE, dedup=True, tokens=True)
    return gold.withColumn("words", F.array_join("words", " "))
