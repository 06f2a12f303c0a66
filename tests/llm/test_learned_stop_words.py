"""Block rules without a marked article, by stop words learned from the pages."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from echoloom.llm import html_blocks

ITALIAN = ("Il gatto che viveva nella casa di mio padre era molto vecchio e non voleva uscire, "
           "ma quando il sole tornava sulla collina andava con me fino al fiume. ") * 2
RUSSIAN = ("Старый кот жил в доме моего отца и не хотел выходить на улицу, но когда солнце "
           "вставало над рекой, он шёл со мной до самого берега и смотрел на воду. ") * 2
CHINESE = "那只老猫住在我父亲的房子里,它不想出门,但是当太阳升起在河上的时候,它就和我一起走到岸边看水。" * 3
FRAME = (
    "<html lang='{lang}'><nav><a href=x>Home</a></nav><div class='ad'>{other}</div><div><a href=1>One more</a></div>"
    "<div><h1>Title</h1>"
    "<p>{text}</p><p>{text}</p><p>End.</p></div><div class='comments'><p>{text}</p></div>"
    "<footer>{other}</footer></html>"
)


@pytest.mark.parametrize("lang, text", [("it", ITALIAN), ("ru", RUSSIAN), ("zh", CHINESE)])
def test_languages_without_a_list(lang, text):
    page = FRAME.format(lang=lang, text=text, other="Buy now!")
    text = text.strip()
    assert html_blocks.main_text(page) == f"Title {text} {text} End."


@pytest.mark.parametrize("names", ["long-form", "entry-header", "search-results", "market share"])
@pytest.mark.parametrize("element", ["article", "div"])
def test_class_words_never_drop_dense_text(names, element):
    story = ITALIAN.strip()
    page = f"<{element}><h1>Title</h1><div class='{names}'><p>{story}</p><p>Short.</p></div></{element}>"
    assert html_blocks.main_text(page) == f"Title {story} Short."


@pytest.mark.parametrize("names", ["comments", "comment-list", "site-footer", "cookie-notice", "sidebar", "share", "search-form"])
def test_class_words_drop_surroundings(names):
    story = ITALIAN.strip()
    page = f"<div><p>{story}</p><div class='{names}'><p>I like this very much.</p></div><p>{story}</p></div>"
    assert html_blocks.main_text(page) == f"{story} {story}"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


def test_renaming_the_article_keeps_the_text(pages):
    div = pages.withColumn("html", F.regexp_replace("html", "(?i)(</?)article", "$1div"))
    before, after = (
        html_blocks.extract_text(p).agg(F.sum("n_chars")).first()[0] for p in (pages, div)
    )
    assert after >= 0.95 * before


def test_learned_words_equal_a_plain_count(pages):
    spread, uses = defaultdict(Counter), defaultdict(Counter)
    for row in pages.collect():
        found = [b for b in html_blocks.blocks(row["html"]) if html_blocks.running(b)]
        for block in found:
            words = [w for w in block.words if len(w) <= html_blocks.LONGEST_WORD]
            language = html_blocks.group_of(row["html"], found)
            spread[language].update(set(words))
            uses[language].update(words)
    plain = {(g, w) for g in spread for w in html_blocks.most_widespread(spread[g], uses[g])}
    assert {tuple(r) for r in html_blocks.learn_stop_words(pages).collect()} == plain


def test_odd_rows(spark):
    long = f"<p>{ITALIAN * 2000}</p>"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>one", None), (3, "u", long, "x"), (3, "u", long, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = sorted((tuple(r) for r in html_blocks.extract_text(pages).collect()), key=repr)
    whole = (ITALIAN * 2000).strip()
    assert found == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (None, "u", "one", 3)] + [(3, "u", whole, len(whole))] * 2, key=repr
    )
    assert html_blocks.extract_text(pages.limit(0)).count() == 0
