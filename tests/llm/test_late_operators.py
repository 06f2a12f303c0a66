"""Norm buckets, fill-in-the-middle and collocations against brute force, and odd rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from echoloom.llm import collocations, fill_middle, norm_topk, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, n string, codes int, route string, _text int"
ODD = [
    (1, "the same text here again", "en", "a", 1, None, 1),
    (2, "the same text here again", "en", None, 1, "x", 1),
    (2, "the same text here again", "en", None, 1, "x", 1),
    (3, None, None, None, None, None, None),
    (4, "", "en", "b", 2, "y", 2),
    (5, " \t\n", "xx", "b", None, "y", 2),
    (None, "no key at all", "en", None, None, None, None),
    (6, "word " * 30_000, "en", "b", 3, "z", 3),
    (7, "é, " * 70_000, "fr", "b", 3, "z", 3),
    (8, "holds a <M> mark", None, "b", 3, "z", 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).cache()


@pytest.mark.parametrize("name", ["op11_norm_buckets", "op12_fill_middle", "op13_suffix_collocations"])
def test_queries_equal_sql(spark, name):
    from oracle import compare, connect

    assert compare(spark, connect(SF), queries.QUERIES[name], queries.ORACLES[name], SF) is None


# --- fill in the middle ---


@pytest.mark.parametrize(
    ("kind", "offsets"),
    [
        (fill_middle.ArrayContainer, np.arange(0, 60_000, 37)),
        (fill_middle.BitmapContainer, np.flatnonzero(np.random.default_rng(1).random(65_536) < 0.4)),
        (fill_middle.RunContainer, np.concatenate((np.arange(5, 9000), np.arange(20_000, 65_536)))),
    ],
)
def test_containers_select_what_a_list_has(kind, offsets):
    found = fill_middle.container(offsets)
    assert isinstance(found, kind)
    assert [found.select(i) for i in range(0, len(offsets), 7)] == offsets[::7].tolist()


def test_boundaries_over_several_containers():
    text = "ab, " * 20_000 + "x" * 140_000 + "€𝄞" * 40_000 + "y"
    ends = [0, *(m.end() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text, re.S))]
    found = fill_middle.boundaries(text)
    assert len(found) == len(ends) and len({type(c) for c in found.containers}) > 1
    step = range(0, len(ends), 997)
    assert [found.select(i) for i in step] == [ends[i] for i in step] and found.select(len(ends) - 1) == len(text)
    assert len(fill_middle.boundaries("")) == 1 and fill_middle.boundaries("").select(0) == 0


def by_hand(key, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_of_odd_rows(odd):
    found = fill_middle.fill_in_middle(odd)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = Counter(map(tuple, found.collect()))
    assert rows == Counter((r[0], *by_hand(r[0], r[1])) for r in ODD)
    assert fill_middle.fill_in_middle(odd.filter("false")).count() == 0


def test_restored_texts(spark):
    marks = ["", "<", "<P", "P>", "<<", ">", "ab<S", "<M<", "a", "\n"]
    rows = [(i, a + b + c) for i, (a, b, c) in enumerate((a, b, c) for a in marks for b in marks for c in marks)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = fill_middle.fill_in_middle(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert {r["doc_id"]: r["back"] for r in found.collect()} == dict(rows)
    assert {r["form"] for r in found.select("form").distinct().collect()} == {"plain", "psm", "spm"}


# --- largest products ---


def brute(vectors, asks, k):
    width = max((len(v) for v in vectors.values()), default=0)
    whole = {i: np.array([*v, *[0] * (width - len(v))]).astype(object) for i, v in vectors.items()}
    found = []
    for q in filter(asks, whole):
        scores = sorted((-int(sum(whole[q] * v)), i) for i, v in whole.items() if i != q)[:k]
        found += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(found)


@pytest.mark.parametrize("cosine", [0.0, 0.9, 2.0])
def test_search_equals_all_products(cosine):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 12)) * rng.lognormal(0, 1, (8, 1)) * 200
    rows = np.concatenate([c + rng.normal(size=(60, 12)) * 5 for c in centres])
    rows = np.floor(rows * rng.lognormal(0, 0.5, (len(rows), 1))).astype(np.int64)
    rows[100:160] = rows[100]
    rows[200] = 0
    ids = rng.permutation(len(rows))
    asking = np.flatnonzero(ids % 5 == 0)
    known = np.full(len(asking), np.iinfo(np.int64).min)
    found = norm_topk.search(rows[asking], ids[asking], known, rows, ids, 4, bucket_rows=50, coordinate_cosine=cosine)
    expected = brute(dict(zip(ids.tolist(), rows.tolist())), lambda i: i % 5 == 0, 4)
    assert sorted(zip(*(x.tolist() for x in found))) == sorted((q, i, s) for q, _, i, s in expected)


def test_coordinates_leave_few_candidates():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(2000, 16))
    bucket = norm_topk.Bucket(np.arange(2000), vectors, np.sqrt((vectors**2).sum(1)))
    unit = bucket.units()[7]
    near = bucket.candidates(unit, 0.95)
    assert 7 in near and len(near) < 400
    cosine = bucket.units() @ unit
    assert set(np.flatnonzero(cosine >= 0.95)) <= set(near.tolist())


def test_products_are_exact_beyond_doubles():
    a = np.array([[2**31 - 1, 2**30 + 1]])
    assert norm_topk.products(a, a)[0, 0] == (2**31 - 1) ** 2 + (2**30 + 1) ** 2
    with pytest.raises(OverflowError):
        norm_topk.products(a * 4, a)


def test_top_products_of_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(5).integers(-9, 9, (90, 3)).tolist())]
    rows += [(i, [1.0, 1.0, 1.0]) for i in range(90, 150)]
    odd = [(200, None), (201, [1.0, None, 2.0]), (202, [inf, 0.0, 0.0]), (203, [nan, 0.0, 0.0]), (None, [9.0, 9.0, 9.0])]
    short = [(210, []), (211, [4.0]), (100, [1.0, 1.0, 1.0])]
    data = spark.createDataFrame([(*r, 0, 0.0) for r in rows + odd + short], "vec_id bigint, embedding array<double>, part int, length double")
    for sizes in ({}, {"part_rows": 16, "query_rows": 4, "bucket_rows": 5, "seed_rows": 3}):
        found = norm_topk.top_products(data, F.col("vec_id") % 10 == 0, 5, **sizes)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        taking = {**dict(rows), 210: [], 211: [4.0]}
        whole = {i: [int(x) for x in v] for i, v in taking.items()}
        assert sorted(map(tuple, found.collect())) == brute(whole, lambda i: i % 10 == 0, 5)
    few = norm_topk.top_products(data.filter("vec_id in (0, 3)"), F.col("vec_id") == 0, 5)
    assert [r["vec_id"] for r in few.collect()] == [3]
    assert norm_topk.top_products(data.filter("false"), F.col("vec_id") == 0, 5).count() == 0


# --- collocations ---


def collocations_by_hand(rows, least, listed):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    found = {}
    for (lang, *words), a in counts.items():
        if len(words) < 2 or a < least:
            continue
        longer = [
            b for (other, *more), b in counts.items()
            if other == lang and len(more) > len(words) and b >= max(a, least)
            and any(more[i : i + len(words)] == words for i in range(len(more)))
        ]
        if longer:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, i + 1, p.decode(), -a, left, right, totals[lang], -score)
        for lang, every in found.items()
        for i, (score, a, p, left, right) in enumerate(sorted(every)[:listed])
    }


def random_texts(n):
    rng = np.random.default_rng(6)
    words = ["The", "of", "a\x0bb", "İs", "and", "ß", "x" * 70, "x" * 69 + "y", "tail", "\x1cq"]
    breaks = [" ", " ", "  ", "\t", " ", ", ", ".\r\n", "; "]
    weights = np.array([30, 25, 8, 8, 10, 5, 3, 3, 5, 3]) / 100
    for _ in range(n):
        size = int(rng.integers(0, 60))
        chosen, gaps = rng.choice(len(words), size, p=weights), rng.choice(len(breaks), size)
        yield "".join(words[w] + breaks[g] for w, g in zip(chosen, gaps))


def test_collocations_equal_plain_counts(spark, monkeypatch):
    langs = ["en", None, "und", "de"]
    rows = [(langs[i % 4], text) for i, text in enumerate(random_texts(300))]
    rows += [("en", "the same passage of many words stands here again"), ("en", None), ("fr", "")] * 40
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("w1", F.lit(1)).repartition(5)
    for segment in (200, 2_000_000):
        monkeypatch.setattr(collocations, "SEGMENT_BYTES", segment)
        found = collocations.collocations(docs, least=12, listed=60)
        assert set(map(tuple, found.collect())) == collocations_by_hand(rows, 12, 60)


def test_heavy_pairs_are_spread_and_routes_cut(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SORTED_TOGETHER", 7)
    monkeypatch.setattr(collocations, "PAIRS_HELD", 50)
    rows = [("en", f"of the {a} {b}") for a in "abcdefg" for b in "hijklmn"] * 3
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    found = collocations.collocations(docs, least=3, listed=500)
    assert set(map(tuple, found.collect())) == collocations_by_hand(rows, 3, 500)


def test_collocations_of_odd_rows(odd):
    found = collocations.collocations(odd)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(r[2], r[1]) for r in ODD]
    assert set(map(tuple, found.collect())) == collocations_by_hand(rows, 100, 2000)
    assert collocations.collocations(odd.filter("false")).count() == 0


def test_sorted_suffixes_equal_a_counter():
    rng = np.random.default_rng(8)
    rows = rng.integers(1, 4, (500, 5))
    cut = rng.integers(2, 6, 500)
    rows = np.where(np.arange(5)[None, :] < cut[:, None], rows, 0)
    weights = rng.integers(1, 4, 500)
    counts = Counter()
    for row, size, n in zip(rows.tolist(), cut.tolist(), weights.tolist()):
        for m in range(2, size + 1):
            counts[tuple(row[:m] + [0] * (5 - m))] += n
    for least in (1, 9):
        phrases, found = collocations.sort_suffixes(rows, weights, least)
        assert {tuple(p): n for p, n in zip(phrases.tolist(), found.tolist())} == {
            p: n for p, n in counts.items() if n >= least
        }


def test_words_that_share_a_code_get_another_seed(spark, monkeypatch):
    real = collocations.Words.cut

    def colliding(self, lang, text):
        starts, ends, codes, pieces = real(self, lang, text)
        return starts, ends, codes % 7 + 1 if self.seed == 0 else codes, pieces

    narrow = spark.createDataFrame([("en", b"a b c d e f g h i j k l"), ("en", b"m n o p q r s")], "lang string, text binary")
    table, seed = collocations.word_table(narrow)
    assert seed == 0 and table.count() == 19
    monkeypatch.setattr(collocations.Words, "cut", colliding)
    table, seed = collocations.word_table(narrow.repartition(2))
    assert seed == 10 and table.count() == 19
