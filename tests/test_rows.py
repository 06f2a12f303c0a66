"""Traps of the row-level functions, on hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from echoloom.functions.labels import decode_label, encode_label, sentiment_from_score
from echoloom.functions.text import (
    clean_text,
    html_nodes,
    ngrams,
    normalize_for_scoring,
    tokenize,
    url_parameter,
)
from echoloom.operators import keyed, rows


def one(spark, value, function, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(function(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "score, kind, label",
    [
        (None, "double", "Unknown"),
        (2.5, "double", "Unknown"),
        (3.5, "double", "Unknown"),
        (float("nan"), "double", "Unknown"),
        ("abc", "string", "Unknown"),
        ("4", "string", "Positive"),
        (0, "int", "Negative"),
        (2, "int", "Negative"),
        (3, "int", "Neutral"),
        (9, "int", "Positive"),
    ],
)
def test_sentiment(spark, score, kind, label):
    assert one(spark, score, sentiment_from_score, kind) == label


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("a<b\nc> x", "a<b c> x"),
        ("<br>good <b>app</b> http://a.b/c?d www.x.y end ", "good app end"),
        ("ht<i>tp://gone</i> x", "x"),
        ("HTTP://z http://q", "HTTP://z"),
        ("x y", "x y"),
        ("", ""),
        (None, None),
    ],
)
def test_clean_text(spark, text, cleaned):
    assert one(spark, text, clean_text) == cleaned


@pytest.mark.parametrize(
    "text, normalized",
    [
        ("HTTP://z http://q", ""),
        ("Great!! App, 5 stars (v2.0)", "great app stars v"),
        ("it's [ok] ^_^ ~`{}|", "its ok"),
        ("x y", "x y"),
    ],
)
def test_normalize(spark, text, normalized):
    assert one(spark, text, normalize_for_scoring) == normalized


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("Größe a_1 x ok",), ("solo",), ("",)], "t string")
    df = df.select(tokenize(F.col("t")).alias("w"))
    got = [r["g"] for r in df.select(ngrams("w", 2).alias("g")).collect()]
    assert got[0] == ["größe", "a_1", "ok", "größe a_1", "a_1 ok"]
    assert got[1:] == [["solo"], []]
    assert [r["g"] for r in df.select(ngrams("w", 3).alias("g")).collect()][0][-1] == "größe a_1 ok"


def test_url_parameter(spark):
    assert one(spark, "https://x/details?id=com.a.b&hl=en", url_parameter) == "com.a.b"
    assert one(spark, "https://x/?pid=7", url_parameter) == "7"
    assert one(spark, "https://x/?id=", url_parameter) == "unknown"
    assert one(spark, "https://x/", url_parameter) == "unknown"


def test_html_nodes(spark):
    html = '<div class="a h3 b">one <b>1</b></div><div class="h30">no</div><div class="h3">two\n2</div>'
    assert one(spark, html, lambda c: html_nodes(c, "div", "h3")) == ["one 1", "two\n2"]


def test_labels_round_trip(spark):
    assert [one(spark, s, encode_label) for s in ("Negative", "Neutral", "Positive", "Unknown", None)] == [0, 1, 2, None, None]
    assert [one(spark, i, decode_label, "int") for i in (0, 1, 2, 3, None)] == [
        "Negative",
        "Neutral",
        "Positive",
        "Unknown",
        "Unknown",
    ]


def test_dedup_keeps_lowest_id_and_null_group(spark):
    data = [(3, "a", "t"), (1, "a", "t"), (2, "b", "t"), (5, "a", None), (4, "a", None)]
    df = spark.createDataFrame(data, "review_id bigint, app_id string, content string")
    assert sorted(r["review_id"] for r in rows.dedup_reviews(df).collect()) == [1, 2, 4]


def test_profile_and_shape(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert {r["column_name"]: r["nulls"] for r in rows.profile_nulls(df).collect()} == {"a": 0, "b": 1}
    assert rows.row_shape(df).first().asDict() == {"row_count": 2, "column_count": 2}


def test_join_clean_topic(spark):
    df = spark.createDataFrame(
        [(1, "a | b"), (2, "Uncategorized"), (3, "c"), (4, None)], "review_id bigint, topic string"
    )
    names = spark.createDataFrame([("a | b", " Crashes "), ("Uncategorized", "no")], "topic string, clean_topic string")
    got = {r["review_id"]: r["clean_topic"] for r in rows.join_clean_topic(df, names).collect()}
    assert got == {1: "Crashes", 2: "Uncategorized", 3: "Unknown Topic", 4: None}


def test_stale_apps(spark):
    apps = spark.createDataFrame([("a",), ("b",), ("c",)], "app_id string")
    results = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP '2024-01-01 11:30:00'), ('b', TIMESTAMP '2024-01-01 11:00:00') AS t(app_id, computed_at)"
    )
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    assert sorted(r[0] for r in rows.stale_apps(apps, results, now).collect()) == ["b", "c"]


# --- hot keys ----------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97)
    return spark.range(20_000).select(F.col("id"), hot.alias("k"))


def test_lookup_joins_agree_with_plain_join(spark, skewed):
    dim = skewed.groupBy("k").agg(F.max("id").alias("v"), F.count("*").alias("n")).filter("k <> 5")
    plain = sorted(skewed.join(dim.drop("n"), "k", "left").collect(), key=str)
    salted = keyed.lookup_join(skewed, dim.drop("n"), ["k"], ["id"])
    counted = keyed.counted_lookup_join(skewed, dim, ["k"], ["id"], "n", hot_rows=150)
    order = ["k", "id", "v"]
    assert sorted(salted.select(order).collect(), key=str) == plain
    assert sorted(counted.select(order).collect(), key=str) == plain


def test_more_heavy_keys_than_a_thousand(spark):
    facts = spark.range(6_000).select("id", (F.col("id") % 2_000).alias("k"))
    dim = facts.groupBy("k").agg(F.max("id").alias("v"), F.count("*").alias("n"))
    joined = keyed.counted_lookup_join(facts, dim, ["k"], ["id"], "n", hot_rows=1)
    assert joined.count() == 6_000
    assert joined.filter("v % 2000 <> k or v < 4000").count() == 0


def test_rows_without_a_key_are_spread(spark):
    facts = spark.range(8_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("k"))
    dim = spark.range(7).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = keyed.lookup_join(facts, dim, ["k"], ["id"], salts=1)
        missing = joined.filter("v is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in missing) == 4_000
    assert len(missing) == 8 and max(r["count"] for r in missing) < 1_000


def test_hot_key_is_spread(spark, skewed):
    dim = skewed.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = keyed.counted_lookup_join(skewed, dim, ["k"], ["id"], "n", hot_rows=1000)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # The hot key has a third of the rows, yet no partition holds as many.
    assert max(r["count"] for r in sizes) < 20_000 * 0.25


@pytest.mark.parametrize("n", [3, 1500])
def test_first_per_group(spark, skewed, n):
    got = keyed.first_per_group(skewed, ["k"], [F.col("id")], n, rank="r")
    counts = {r["k"]: r["count"] for r in skewed.groupBy("k").count().collect()}
    kept = {r["k"]: (r["count"], r["m"]) for r in got.groupBy("k").agg(F.count("*").alias("count"), F.max("r").alias("m")).collect()}
    assert kept == {k: (min(c, n), min(c, n)) for k, c in counts.items()}
    lowest = got.filter("r = 1 and k = 0").first()["id"]
    assert lowest == 0


def test_top_k_is_cut_before_the_shuffle(skewed):
    plan = keyed.first_per_group(skewed, ["k"], [F.col("id")], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_dense_numbers(spark, skewed):
    keys = skewed.select((F.col("id") % 2).alias("g"), "id")
    got = keyed.dense_numbers(keys, ["g"], "id", "n").collect()
    for g in (0, 1):
        assert sorted(r["n"] for r in got if r["g"] == g) == list(range(10_000))
