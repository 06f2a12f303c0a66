"""Brute force, round trips and odd inputs for the training-text operators."""

from __future__ import annotations

import hashlib
import itertools
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from echoloom.llm import (
    bpe,
    cross_entropy,
    divergence,
    exact,
    golay,
    html_blocks,
    machine,
    mixing,
    nbsvm,
    queries,
    ring,
    sampling,
)
from echoloom.operators import components

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, slot string, _key int"
ODD = [
    (1, "the same text here again", "en", "a", "x", 1),
    (2, "the same text here again", "en", "a", None, 1),
    (2, "the same text here again", "en", "a", None, 1),
    (3, None, None, None, "y", None),
    (4, "", "en", "b", "y", 2),
    (5, " \t\n", "xx", "b", None, 2),
    (None, "no key at all", "en", None, None, None),
    (6, "word " * 30_000, "en", "b", "z", 3),
    (7, "é" * 70_000, "fr", "b", "z", 3),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


# --- mixing ---


def test_weights_follow_the_sizes_of_sources(spark):
    rows = [(i, "large") for i in range(900)] + [(i, None) for i in range(100)] + [(1, "small")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string")
    assert mixing.tempered_weights(docs) == {"large": 1, None: Fraction(33, 100), "small": Fraction(3, 100)}
    assert mixing.tempered_weights(docs, exponent=0.0) == {"large": 1, None: 1, "small": 1}
    assert mixing.tempered_weights(docs.filter("false")) == {}
    slots = mixing.mix_sources(docs, mixing.tempered_weights(docs), block_rows=1).collect()
    assert len({r["slot"] for r in slots}) == 1001
    early = [r["source"] for r in slots if r["slot"] < 136]
    assert (early.count("large"), early.count(None)) == (100, 33)


def test_mix_keeps_all_rows_and_cuts_whole_blocks(docs):
    rows = mixing.mix_sources(docs, {"src0": 3.0}, block_rows=8).select(
        "doc_id", "source", "block", "release", "deadline", "slot", "row_in_block"
    ).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1000))
    slots = {(r["source"], r["block"]): r["slot"] for r in rows}
    assert len(set(slots.values())) == len(slots)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    assert len({(r["slot"], r["row_in_block"]) for r in rows}) == 1000


def test_mixed_order_odd_rows(odd, none):
    got = mixing.in_mixed_order(odd)
    assert got.columns == odd.columns
    assert sorted(got.collect(), key=repr) == sorted(odd.collect(), key=repr)
    assert mixing.in_mixed_order(none).count() == 0
    assert mixing.mix_sources(odd).columns.count("slot") == 1


# --- language models ---


def test_losses_equal_a_plain_count(spark):
    texts = [(i, t) for i, t in enumerate(["a b a b c", "b c b", "", None, "a a a", "z"])]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    target = spark.createDataFrame([("a b",), ("a b c",)], "text string")
    models = cross_entropy.fit_models(frame, target, least_share=0.15)
    got = {r["doc_id"]: r for r in cross_entropy.score_documents(frame, models).collect()}
    every = [(t or "").split() for _, t in texts]
    wanted = ["a b".split(), "a b c".split()]
    uses = [w for t in every + wanted for w in t]
    known = sorted(w for w in set(uses) if uses.count(w) >= 0.15 * len(uses))
    assert set(models.numbers) == {w.encode() for w in known}

    def loss(text, corpus, scale):
        def as_known(t):
            return [w if w in known else "?" for w in t]

        pairs = [p for t in corpus for p in zip(["^", *as_known(t)], as_known(t))]
        words = [w for t in corpus for w in as_known(t)]
        total = 0.0
        for v, w in zip(["^", *as_known(text)], as_known(text)):
            one = (words.count(w) * scale + 0.1) / (len(words) * scale + 0.1 * (len(known) + 2))
            context = sum(a == v for a, _ in pairs) * scale
            total -= np.log2((pairs.count((v, w)) * scale + 50 * one) / (context + 50))
        return total / len(text)

    small, large = sum(map(len, wanted)), sum(map(len, every))
    for i, text in enumerate(every):
        if not text:
            assert (got[i]["n_tokens"], got[i]["difference"]) == (0, 0.0)
            continue
        near = loss(text, wanted, min(small, large) / small)
        far = loss(text, every[:i] + every[i + 1 :], min(small, large) / large)
        assert got[i]["difference"] == pytest.approx(near - far, abs=1e-9)


def test_language_models_on_odd_rows(odd, none):
    models = cross_entropy.fit_models(odd, odd)
    assert cross_entropy.score_documents(odd, models).count() == len(ODD)
    models = cross_entropy.fit_models(none, none)
    assert cross_entropy.score_documents(none, models).count() == 0


# --- classifiers ---


@pytest.mark.parametrize(
    "fit, score, label, folds, fold, least",
    [
        (nbsvm.fit_quality, nbsvm.score_quality, "quality", 3, 1, 0.95),
        (machine.fit_toxicity, machine.score_toxicity, "toxic", 5, 0, 0.9),
    ],
)
def test_held_out_accuracy(spark, fit, score, label, folds, fold, least):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = sampling.held_out(F.col("doc_id"), folds, fold)
    model = fit(docs, labels, ~out)
    held = score(docs, model).join(labels, "doc_id").filter(out).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % folds == fold for r in held)
    classes = {c: [r["predicted"] == c for r in held if r[label] == c] for c in (0, 1)}
    # Mean over the classes, so that a constant gets a half.
    assert np.mean([np.mean(hits) for hits in classes.values()]) > least
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in held)


@pytest.mark.parametrize("module, fit, score", [
    (nbsvm, nbsvm.fit_quality, nbsvm.score_quality), (machine, machine.fit_toxicity, machine.score_toxicity)
])
def test_classifiers_on_odd_rows(spark, odd, none, module, fit, score):
    no_labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    one_class = spark.createDataFrame([(1, 1, 1), (4, 1, 1), (None, 0, 0)], no_labels.schema)
    assert {r["score"] for r in score(odd, fit(odd, no_labels, F.lit(True))).collect()} == {0.5}
    model = fit(odd, one_class, F.lit(True))
    assert {r["predicted"] for r in score(odd, model).collect()} == {1}
    assert score(none, model).count() == 0


def test_machine_learns_a_pair():
    """Neither word alone is toxic, the two together are."""
    rng = random.Random(0)
    rows, labels = [], []
    for _ in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.array(sorted([1] * a + [2] * b + rng.sample(range(10, 200), 5))))
        labels.append(int(a and b))
    model = machine.fit(rows, labels)
    both, one, other = (model.margin(np.array(x)) for x in ([1, 2], [1], [2]))
    assert both > 0 > max(one, other)
    assert both - one - other + model.bias != 0


@pytest.mark.parametrize("together", [True, False])
def test_machine_learns_a_pair_of_neutral_words(together):
    """Each word occurs as often in clean as in toxic texts; only the two of them tell."""
    rng = random.Random(1)
    rows, labels = [], []
    for _ in range(2500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.array([1] * a + [2] * b + sorted(rng.sample(range(10, 2000), 40))))
        labels.append(int((a == b) == together))
    model = machine.fit(rows[:2000], labels[:2000])
    right = [(model.margin(r) >= 0) == label for r, label in zip(rows[2000:], labels[2000:])]
    assert sum(right) >= 0.95 * len(right)


def test_pairs_without_more_than_their_terms_are_not_learned():
    rng = random.Random(2)
    rows = [np.array(sorted(rng.sample(range(1, 300), 30))) for _ in range(1000)]
    y = np.array([int(1 in r) for r in rows])
    assert not machine.interacting(rows + rows, np.concatenate([y, y]), np.arange(300)).any()


def test_toxic_rows_go_with_their_columns_kept(odd):
    model = machine.FactorModel(
        np.array([zlib.crc32(b"same") % machine.DIMENSIONS]), np.array([9.0]), np.zeros((1, machine.FACTORS)), -1.0
    )
    left = machine.drop_toxic(odd, model)
    assert left.columns == odd.columns
    assert sorted(left.collect(), key=repr) == sorted((r for r in odd.collect() if "same" not in (r["text"] or "")), key=repr)


# --- pages ---


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p", ""), ("<!-- x", ""),
    ("<script>var a='<p>x</p>'</script><p>ok", "ok"),
    ("<nav>Home</nav><article><h1>A&amp;B</h1><p>one\n two<br>three<p><a href=x>more</a></article><footer>end</footer>",
     "A&B one two three more"),
    ("<article><p>kept</p><div class='comments'><p>I agree</p></div><aside>side</aside></article>", "kept"),
    ("<div class='cookie-notice'>We use cookies</div><main><p>x &lt;b&gt; y</p></main>", "x <b> y"),
])
def test_pages(page, text):
    assert html_blocks.main_text(page) == text


def test_deep_pages_take_time_by_their_length():
    def seconds(n):
        start = time.perf_counter()
        assert html_blocks.main_text("<div><b>word " * n).count("word") == n
        return time.perf_counter() - start

    # With n open elements around each, 16 times as many would take 256 times as long.
    assert seconds(16_000) < 80 * max(seconds(1_000), 0.005)


def test_block_rules_without_an_article():
    long = "This is the story of a man who was in the city and had not been there for years. " * 4
    page = f"<div><a href=a>Home</a></div><p>{long}</p><p>Yes.</p><p>{long}</p><div><a href=b>Next</a> one</div>"
    assert html_blocks.main_text(page) == f"{long.strip()} Yes. {long.strip()}"


# --- shards ---


def test_shards_are_even_and_gapless(docs):
    rows = ring.assign_shards(docs.select("doc_id"), 7).collect()
    sizes = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(7)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    points = ring.ring_points(7)
    for r in rows:
        place = int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:15], 16)
        assert r["home_shard"] == next((s for p, s in points if p >= place), points[0][1])
    moved = sum(r["shard"] != r["home_shard"] for r in rows)
    excess = sum(max(0, sum(r["home_shard"] == s for r in rows) - len(sizes[s])) for s in range(7))
    assert moved == excess  # nobody moves whose shard has room


def test_overflow_goes_clockwise():
    spans = ring.fill([(10, 0), (20, 1), (30, 2)], [5, 0, 1], [2, 2, 2])
    assert [(s.arc, s.start, s.stop, s.shard) for s in spans] == [(0, 0, 2, 0), (2, 0, 1, 2), (0, 2, 4, 1), (0, 4, 5, 2)]


def test_shards_of_odd_rows(odd, none):
    got = ring.assign_shards(odd, 4)
    assert sorted(got.groupBy("shard").count().toPandas()["count"]) == [2, 2, 2, 3]
    assert ring.assign_shards(none, 4).count() == 0


# --- near duplicates ---


def test_golay_code_is_perfect():
    words = np.arange(1 << 23)
    index, times = np.unique(golay.decode(words), return_counts=True)
    assert len(index) == 4096 and set(times) == {2048}


def test_close_fingerprints_share_a_key():
    rng = np.random.default_rng(5)
    for spread in itertools.chain(itertools.product(range(5), repeat=3)):
        if sum(spread) > 4:
            continue
        a = rng.integers(0, 2**63, size=200, dtype=np.uint64)
        b = a.copy()
        for errors, (at, bits) in zip(spread, golay.SEGMENTS):
            for i in range(200):
                for bit in rng.choice(bits, size=errors, replace=False):
                    b[i] ^= np.uint64(1 << int(at + bit))
        sets = []
        for prints in (a, b):
            row, key = golay.fuzzy_keys(prints.view(np.int64))
            sets.append([set(key[row == i].tolist()) for i in range(200)])
        assert all(x & y for x, y in zip(*sets))


def _components(prints):
    nodes = sorted(set(prints.values()))
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
            parent[find(b)] = find(a)
    first = {}
    for doc, n in sorted(prints.items()):
        first.setdefault(find(n), doc)
    return {doc: first[find(n)] for doc, n in prints.items()}


def test_near_duplicates_equal_all_pairs(docs):
    found = golay.near_duplicates(docs).collect()
    prints = {r["doc_id"]: r["fingerprint"] for r in found}
    assert {r["doc_id"]: r["component_id"] for r in found} == _components(prints)


def test_large_buckets_are_compared_in_blocks(spark):
    rng = random.Random(1)
    prints = {}
    for i in range(400):
        value = 0x0123456789ABCDEF
        for bit in rng.sample(range(64), rng.randint(0, 5)):
            value ^= 1 << bit
        prints[i] = value - (value >> 63 << 64)  # signed
    frame = spark.createDataFrame([(v,) for v in set(prints.values())], "fingerprint bigint")
    roots = {r["node"]: r["root"] for r in components.component_roots(golay.links(frame, block=20)).collect()}
    want = _components(prints)
    for a, b in itertools.combinations(prints, 2):
        same = roots.get(prints[a], prints[a]) == roots.get(prints[b], prints[b])
        assert same == (want[a] == want[b])


def test_near_duplicates_of_odd_rows(odd, none):
    rows = golay.near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    by_text = {r["doc_id"]: r["component_id"] for r in rows}
    assert by_text[1] == by_text[2] == 1 and by_text[3] == by_text[4] == by_text[5] == 3
    assert golay.near_duplicates(none).count() == 0
    kept = golay.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "6", "7", "None"]


# --- exact duplicates ---


def test_exact_duplicates_of_odd_rows(odd, none):
    rows = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(odd).collect()}
    assert rows == {
        (1, 2, 3, False), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True),
        (None, None, 1, True), (6, 6, 1, True), (7, 7, 1, True),
    }
    assert exact.exact_duplicates(none).count() == 0
    kept = exact.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "2", "4", "5", "6", "7", "None"]


def test_only_candidates_are_hashed_whole(docs):
    found = exact.exact_duplicates(docs)
    assert found.filter("group_size > 1 AND digest IS NULL").count() == 0
    assert found.filter("group_size = 1 AND digest IS NOT NULL").count() < 50


# --- tokens ---


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(queries.VOCABULARY)


def test_tokens_equal_the_library(spark, docs, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op9_bpe_prefix"](spark, SF).collect()}
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[row["doc_id"]]["n_tokens"] == len(ids)
        assert got[row["doc_id"]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[row["doc_id"]]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_a_worker_remembers_a_bounded_number_of_things(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_CHUNKS", 3_000)
    monkeypatch.setattr(bpe, "MOST_CACHED", 2_000)
    monkeypatch.setattr(bpe, "MOST_SHORTCUTS", 3_000)
    coder = bpe.WordBpe(open(queries.VOCABULARY, encoding="utf-8").read())
    rng, most = random.Random(9), 0
    for i in range(60_000):
        word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(1, 12)))
        made = coder.chunk(f"{word}{i}".encode())
        most = max(most, coder.remembered())
        if i % 2000 == 0:
            assert list(made) == library.encode(f"{word}{i}", add_special_tokens=False).ids
    assert 6_000 < most <= 2 * 3_000 + 3 * 2_000 + 3_000


def test_tokens_of_odd_texts_equal_the_library(library):
    coder = bpe.WordBpe(open(queries.VOCABULARY, encoding="utf-8").read())
    rng = random.Random(3)
    letters = "ab cdeéΣσςİıßǅ̧́̈‍日本語한가각ᄀ\t\n\x0b\x1c\x85\xa0 'sSrRlLvVmM'0½٣#$%<|>endoftext!?.,"
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        if rng.random() < 0.1:
            text += "<|endoftext|>" + text[::-1] + "<|startoftext|><|endof"
        ids = library.encode(text, add_special_tokens=False).ids
        assert coder.encode(text) == ids
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_documents_and_digests_agree(spark, odd, none):
    vocabulary = bpe.read_vocabulary(spark, queries.VOCABULARY)
    whole = bpe.encode_documents(odd, vocabulary).collect()
    digests = bpe.encoded_digests(odd, vocabulary).collect()
    want = sorted((len(r["ids"]), hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()) for r in whole)
    assert sorted((r["n_tokens"], r["ids_sha256"]) for r in digests) == want
    assert bpe.encoded_digests(none, vocabulary).count() == 0


# --- quality rules ---


def test_repeated_words_equal_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        covered = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(5)}
        assert divergence.repeated_words(words) == len(covered)


def test_base_counts(spark):
    text = "a #b\n\na #b\n \n a #b\né| c"
    frame = spark.createDataFrame([(1, text, "en")], "doc_id bigint, text string, lang string")
    row = divergence.judge(frame, divergence.references(frame)).first()
    assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"]) == (8, 12, 4, 1)
    assert row["base_failed"] and not row["kept"]


def test_distance():
    a, b = np.array([1.0, 0.0]), np.array([0.0, 3.0])
    assert divergence.distance(a, a * 5) == 0 and divergence.distance(a, b) == pytest.approx(1)
    assert divergence.distance(a, a * 0) == 0


def test_rules_drop_junk_and_keep_clean(spark, docs, labels):
    found = divergence.judge(docs, divergence.references(docs)).filter("NOT base_failed").join(labels, "doc_id").collect()
    clean = [r["kept"] for r in found if r["quality"] == 1]
    junk = [r["kept"] for r in found if r["quality"] == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.1


def test_rules_on_odd_rows(odd, none):
    known = divergence.references(odd)
    assert divergence.judge(odd, known).count() == len(ODD)
    assert divergence.judge(none, divergence.references(none)).count() == 0
