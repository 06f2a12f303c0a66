"""Readers, writers, layers and streaming."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from echoloom.constants import Warehouse
from echoloom.plans import layers
from echoloom.sources import readers, writers
from echoloom.streaming.layers import stream_medallion

URL = "postgres://me:p%40ss@db.example.com:6543/reviews?sslmode=require"


@pytest.fixture()
def warehouse():
    return Warehouse(prefix=f"t{uuid.uuid4().hex[:8]}_")


@pytest.fixture()
def raw(spark):
    rows = [
        (1, "a", "<b>Good</b>, really\n good", 5),
        (2, "a", 'say "no", http://x.y  ok', 1),
        (3, "b", " spaced ", 3),
        (4, "b", None, None),
    ]
    return spark.createDataFrame(rows, "review_id bigint, app_id string, content string, score int")


def test_jdbc_options():
    options = readers.jdbc_scan_options(URL, lower_bound=1, upper_bound=10_000, partitions=16)
    assert options["url"] == "jdbc:postgresql://db.example.com:6543/reviews?sslmode=require"
    assert (options["user"], options["password"]) == ("me", "p@ss")
    assert options["dbtable"] == '"raw_reviews"'
    assert options["prepareThreshold"] == "0"
    assert (options["partitionColumn"], options["numPartitions"]) == ("review_id", "16")
    assert "partitionColumn" not in readers.jdbc_scan_options(URL)
    assert writers.jdbc_write_options(URL)["batchsize"] == "500"
    assert writers.jdbc_write_options(URL, connections=4)["numPartitions"] == "4"
    bounds = readers.jdbc_bounds_options(URL, partition_column="id")
    assert bounds["query"] == 'SELECT min("id") AS low, max("id") AS high FROM "raw_reviews"'
    assert "dbtable" not in bounds
    with pytest.raises(ValueError):
        readers.jdbc_options("mysql://me:x@db/reviews")


class Reader:
    """Stands in for Spark's reader: notes the options and answers the query for bounds."""

    def __init__(self, seen, answer):
        self.read, self.seen, self.answer = self, seen, answer

    def format(self, name):
        return self

    def options(self, **options):
        self.seen.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.answer


@pytest.mark.parametrize(
    "answer, given, lower, upper",
    [((3, 900), {}, "3", "900"), ((7, 7), {}, "7", "8"), ((None, None), {}, None, None),
     ((None, None), {"upper_bound": 9}, None, None),
     ((3, 900), {"lower_bound": 10}, "10", "900"), (None, {"lower_bound": 1, "upper_bound": 5}, "1", "5"),
     (None, {"partition_column": None}, None, None)],
)
def test_jdbc_bounds_come_from_the_database(answer, given, lower, upper):
    seen = []
    readers.scan_jdbc(Reader(seen, answer), URL, **given)
    assert len(seen) == (1 if answer is None else 2)
    assert (seen[-1].get("lowerBound"), seen[-1].get("upperBound")) == (lower, upper)
    assert ("partitionColumn" in seen[-1]) == (lower is not None)


def test_csv_round_trip(spark, raw, tmp_path):
    path = str(tmp_path / "csv")
    writers.sink_csv(raw, path, raw.columns)
    assert sorted(readers.scan_csv(spark, path).collect()) == sorted(raw.collect())


def test_sink_table_replaces_schema_and_counts(spark, raw, warehouse, tmp_path):
    writers.create_schemas(spark, warehouse, ["bronze"], str(tmp_path))
    assert f"{warehouse.prefix}bronze" in [r[0] for r in spark.sql("SHOW SCHEMAS").collect()]
    name = warehouse.table("bronze", "reviews")
    writers.sink_table(raw, name)
    counted = Observation("load")
    stored = writers.sink_table(raw.drop("score"), name, counted=counted)
    assert counted.get["row_count"] == 4
    assert "score" not in stored.columns and readers.scan_table(spark, name).count() == 4


def page(*snippets, token=True):
    body = {"reviews": [{"snippet": s, "rating": 5} for s in snippets]}
    if token:
        body["serpapi_pagination"] = {"next_page_token": "t"}
    return json.dumps(body)


def test_json_pages(spark):
    pages = [
        ("a", 0, page("a1", "", "a2")),
        ("a", 1, page("a3", None)),
        ("a", 2, page("a4", token=False)),
        ("a", 3, page("after the last token")),
        ("b", 0, page("b1")),
        ("b", 1, json.dumps({})),
        ("b", 2, page("after the empty page")),
        ("c", 0, page(*(f"c{i}" for i in range(9)))),
    ]
    df = spark.createDataFrame(pages, "app_id string, page int, body string")
    got = {}
    for r in readers.scan_json_pages(df, max_reviews=5).orderBy("app_id", "review_no").collect():
        got.setdefault(r["app_id"], []).append(r["content"])
    assert got == {"a": ["a1", "a2", "a3", "a4"], "b": ["b1"], "c": ["c0", "c1", "c2", "c3", "c4"]}


def test_html_reviews_are_limited(spark):
    df = spark.createDataFrame([(1, "<p>x</p>" * 60)], "page_id int, html string")
    assert readers.scan_html_reviews(df, "page_id").count() == 50


def test_medallion_tables(spark, raw, warehouse, tmp_path):
    gold, counts = layers.run_medallion(spark, raw, "csv.reviews", "2024-01-31", warehouse, str(tmp_path))
    assert counts == {"bronze": 4, "silver": 4, "gold": 4}
    got = {r["review_id"]: (r["content"], r["sentiment"]) for r in gold.collect()}
    assert got == {
        1: ("Good, really good", "Positive"),
        2: ('say "no", ok', "Negative"),
        3: ("spaced", "Neutral"),
        4: (None, "Unknown"),
    }
    bronze = spark.read.table(warehouse.table("bronze", "bronze_reviews"))
    assert {"_ingested_at", "_source", "_batch_date"} <= set(bronze.columns)


def test_one_plan_prunes_columns(spark, raw, tmp_path):
    path = str(tmp_path / "wide")
    raw.withColumn("unused", F.lit("x")).write.parquet(path)
    plan = layers.medallion(spark.read.parquet(path), "s", "2024-01-31")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in text and "Exchange" not in text


def test_silver_casts_text_scores(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", "5"), (2, "a", "x", "bad")],
        "review_id bigint, app_id string, content string, score string",
    )
    got = [r["sentiment"] for r in layers.silver_layer(df, cast=True).orderBy("review_id").collect()]
    assert got == ["Positive", "Unknown"]


def test_stream_equals_batch(spark, raw, tmp_path):
    landing, gold = str(tmp_path / "in"), str(tmp_path / "gold")
    raw.repartition(2).write.parquet(landing)
    stream_medallion(spark, landing, gold, str(tmp_path / "cp"), "s", "2024-01-31").awaitTermination(120)
    batch = layers.medallion(raw, "s", "2024-01-31").collect()
    assert sorted(spark.read.parquet(gold).collect(), key=str) == sorted(batch, key=str)


def test_csv_keeps_rows_that_do_not_parse(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text("review_id,app_id,content,score\n1,a,good,5\n2,a,bad,five\n")
    rows = readers.scan_csv(spark, str(path), multi_line=False, corrupt="_corrupt").cache()
    found = {r["review_id"]: (r["score"], r["_corrupt"]) for r in rows.collect()}
    assert found == {1: (5, None), 2: (None, "2,a,bad,five")}
