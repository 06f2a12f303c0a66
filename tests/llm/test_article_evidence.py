"""Block rules on pages whose article element does not hold just the main text."""

from __future__ import annotations

from echoloom.llm import html_blocks

LONG = ("This is the story of a man who was in the city and had not been there for years. " * 4).strip()


def test_story_outside_a_teaser_article():
    teaser = "<article><h2><a href=x>Another story of the week</a></h2><p>In short: more to come.</p></article>"
    page = f"<div><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div>{teaser}"
    assert html_blocks.main_text(page) == f"{LONG} Yes. {LONG}"


def test_dense_text_outside_is_kept_beside_the_article():
    page = f"<article><p>{LONG}</p><p>{LONG}</p></article><div><p>{LONG}</p></div><div><a href=x>Home</a></div>"
    assert html_blocks.main_text(page) == f"{LONG} {LONG} {LONG}"


def test_unclassed_link_list_inside_the_article_goes():
    links = "".join(f"<li><a href={i}>Read number {i} too</a></li>" for i in range(5))
    page = f"<article><h1>Title</h1><p>{LONG}</p><p>The end.</p><h3>See as well</h3><ul>{links}</ul></article>"
    assert html_blocks.main_text(page).startswith(f"Title {LONG} The end.")
    assert "Read number" not in html_blocks.main_text(page)


def test_long_block_of_links_inside_the_article_goes():
    links = " ".join(f"<a href={i}>An offer that you must see, number {i}</a>" for i in range(6))
    assert html_blocks.main_text(f"<main><p>{LONG}</p><p>{links}</p><p>{LONG}</p></main>") == f"{LONG} {LONG}"


def test_single_short_link_between_text_stays():
    page = f"<article><p>{LONG}</p><p><a href=x>A source</a></p><p>{LONG}</p></article>"
    assert html_blocks.main_text(page) == f"{LONG} A source {LONG}"
