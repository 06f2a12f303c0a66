"""Counting terms by batches against a plain count."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from echoloom.functions.text import CLEANING_RULES, SCORING_RULES, clean_text, normalize_for_scoring, tokenize
from echoloom.operators import features, grams, train


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(2)
    made = [[f"w{n}" for n in rng.integers(0, 9, size)] for size in rng.integers(0, 30, 60)]
    return [*made, None, [], ["w1"], ["ä", "ä", "ä"]]


def runs(words, longest):
    words = words or []
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_uses_and_documents(texts, longest):
    found = pa.Table.from_batches(grams.term_uses(pa.array(texts, pa.list_(pa.string())), longest)).to_pylist()
    uses = Counter(t for words in texts for t in runs(words, longest))
    documents = Counter(t for words in texts for t in set(runs(words, longest)))
    assert {r["term"]: (r["uses"], r["documents"]) for r in found} == {t: (n, documents[t]) for t, n in uses.items()}
    assert len(found) == len(uses)


def test_vectors_of_a_vocabulary(texts):
    # Runs whose own words or shorter runs are not in the vocabulary count as well.
    vocabulary = ["w3 w4", "w1", "w5 w6 w7", "w1 w1", "ä", "absent", "ä ä", "w8 absent"]
    found = grams.Lookup(vocabulary).counts(pa.array(texts, pa.list_(pa.string()))).to_pylist()
    for words, vector in zip(texts, found, strict=True):
        count = Counter(runs(words, 3))
        wanted = {i: float(count[t]) for i, t in enumerate(vocabulary) if count[t]}
        assert dict(zip(vector["indices"], vector["values"])) == wanted
        assert (vector["type"], vector["size"], vector["indices"]) == (0, 8, sorted(wanted))


def test_statistics_are_counted_before_the_exchange(spark):
    """Each use of a term and each text with it was a row of its own."""
    docs = spark.createDataFrame([("aa bb aa",)] * 50, "content string").coalesce(1)
    found = features.term_statistics(docs, longest=2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    assert {tuple(r) for r in found.collect()} == {("aa", 100, 50), ("bb", 50, 50), ("aa bb", 50, 50), ("bb aa", 50, 50)}


@pytest.mark.parametrize("most, longest, buckets", [(5, 2, 16), (12, 3, 1 << 12), (10_000, 2, 1 << 12)])
def test_most_used_terms_are_those_of_all_statistics(spark, monkeypatch, most, longest, buckets):
    rng = np.random.default_rng(4)
    rows = [(" ".join(f"w{n}" for n in rng.zipf(1.6, 40) % 500),) for _ in range(60)]
    docs = spark.createDataFrame([*rows, (None,), ("",)], "content string").repartition(3)
    monkeypatch.setattr(grams, "BUCKETS", buckets)
    words = docs.selectExpr("regexp_extract_all(content, 'w[0-9]+', 0) AS words")
    statistics = features.term_statistics(docs, longest=longest)
    wanted = features.vocabulary(statistics, most).collect()
    assert features.vocabulary(grams.frequent_terms(words, "words", longest, most), most).collect() == wanted
    if most == 12:
        assert grams.frequent_terms(words, "words", longest, most).count() < statistics.count()


def odd_texts():
    rng = np.random.default_rng(5)
    letters = [*map(chr, range(0x250)), *"a_1 " * 60, *"一𐐀😀𝐀١Ⅰ²〇\u0300İ\ufffd"]
    made = ["".join(rng.choice(letters, size)) for size in rng.integers(0, 50, 300)]
    codes = [i for i in range(0x80, 0x110000, 997) if not 0xD800 <= i < 0xE000]
    return [*made, *(f"a{chr(i)}B {chr(i)}{chr(i)} {chr(i)}" for i in codes), None, "", "a", "ab", "é", "éé", "ab", "cd"]


@pytest.mark.parametrize("piece", [1 << 22, 40])
def test_words_cut_from_batches_are_those_of_the_pattern(spark, monkeypatch, piece):
    monkeypatch.setattr(grams, "PIECE", piece)
    numbered = spark.createDataFrame([*enumerate(odd_texts())], "n int, content string")
    rows = numbered.select("n", F.lower("content").alias("low"), tokenize(F.col("content")).alias("words")).orderBy("n").collect()
    texts = pa.array([None, *(r["low"] for r in rows)], pa.string())
    wanted = [r["words"] or [] for r in rows]
    assert grams.split_words(texts[1:], grams.word_characters(spark)).to_pylist() == wanted
    assert grams.split_words(texts[:0], grams.word_characters(spark)).to_pylist() == []


def test_texts_give_the_terms_of_their_words(spark):
    """Words were cut by the pattern row by row and sent one by one, in each of four passes."""
    docs = spark.createDataFrame([(t,) for t in odd_texts()] * 3, "content string").repartition(3)
    low, lists = docs.select(F.lower("content").alias("words")), docs.select(tokenize(F.col("content")).alias("words"))
    found, wanted = (features.vocabulary(grams.frequent_terms(x, "words", 2, 50), 50).collect() for x in (low, lists))
    assert found == wanted
    terms = [r["term"] for r in wanted]
    counted = grams.TermCounts(inputCol="content", outputCol="counts", vocabulary=terms).transform(docs)
    assert "regexp_extract_all" not in counted._jdf.queryExecution().optimizedPlan().toString()
    for row in counted.withColumn("words", tokenize(F.col("content"))).collect():
        count = Counter(runs(row["words"], 2))
        assert dict(zip(row["counts"].indices, row["counts"].values)) == {i: count[t] for i, t in enumerate(terms) if count[t]}


def test_rules_skip_only_texts_they_do_not_change(spark):
    """Every rule searched every text, with a new text made each time."""
    texts = ["a <b>c</b>  d", "<a\nb>", "<a <b> c>", "wwwx y", "ww w http", "http://a b", "HTTP://a", " a\t\nb ", "", None, "plain, 12 text!"]
    docs = spark.createDataFrame([(t,) for t in texts], "content string")

    def plainly(text, rules):
        for rule in rules:
            text = F.regexp_replace(text, *map(F.lit, rule))
        return F.trim(text)

    content = F.col("content")
    pairs = ((clean_text(content), plainly(content, CLEANING_RULES)), (normalize_for_scoring(content), plainly(F.lower(content), SCORING_RULES)))
    for found, wanted in pairs:
        assert docs.filter(~found.eqNullSafe(wanted)).collect() == []
        assert "contains" in docs.select(found)._jdf.queryExecution().analyzed().toString().lower()


def test_a_regression_does_not_pass_over_small_files_one_by_one(spark, monkeypatch):
    """Each of its some hundred passes started a task for every part of the stored split."""

    class Counting:
        def fit(self, rows):
            return rows.rdd.getNumPartitions()

    monkeypatch.setitem(train.FAMILIES, "LogisticRegression", lambda rows, **params: Counting())
    monkeypatch.setattr(train, "PACKED_ROWS", 50)
    small = spark.range(0, 600, 1, 40)
    assert train._fit("LogisticRegression", small, 600, {}) == 12
    assert train._fit("LogisticRegression", small, 100, {}) == spark.sparkContext.defaultParallelism
    assert train._fit("LogisticRegression", spark.range(0, 600, 1, 3), 600, {}) == 3
