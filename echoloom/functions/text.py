"""Text columns: cleaning, tokenising and pulling parts out of URLs and HTML.

Everything here is a built-in Spark expression, so it stays in the JVM and
works on batch and streaming frames alike.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacement rules, applied in this order.
CLEANING_RULES = (
    (r"<.*?>", ""),
    (r"http\S+|www\S+", ""),
    (r"\s+", " "),
)
SCORING_RULES = (
    (r"http\S+", ""),
    (r"\d+", ""),
    (r"[!-/:-@\[-`{-~]", ""),
    (r"\s+", " "),
)
# What a text must hold for a rule to find anything; others need not be searched for it.
MARKS = {r"<.*?>": ("<",), r"http\S+|www\S+": ("http", "www"), r"http\S+": ("http",)}
# Words of two or more letters, digits or underscores, in any script.
WORD_CHARACTERS = r"\p{L}\p{N}_"
WORD_PATTERN = rf"[{WORD_CHARACTERS}]{{2,}}"


def _rewrite(text: Column, rules) -> Column:
    return reduce(_replace, rules, text)


def _replace(text: Column, rule: tuple[str, str]) -> Column:
    marks = [F.lit(mark) for mark in MARKS.get(rule[0], ())]
    if not marks:
        return F.regexp_replace(text, *map(F.lit, rule))

    def replaced(known: Column) -> Column:
        found = reduce(or_, (F.contains(known, mark) for mark in marks))
        return F.when(found, F.regexp_replace(known, *map(F.lit, rule))).otherwise(known)

    # Within an array the text has a name, so what it comes from is worked out once.
    return F.get(F.transform(F.array(text), replaced), F.lit(0))


def clean_text(content: Column) -> Column:
    """Drop tags and links, collapse white space, trim spaces."""
    return F.trim(_rewrite(content.cast("string"), CLEANING_RULES))


def normalize_for_scoring(content: Column) -> Column:
    """Lower case without links, digits and ASCII punctuation."""
    return F.trim(_rewrite(F.lower(content), SCORING_RULES))


def tokenize(content: Column) -> Column:
    """Lower-case words of a text, in reading order."""
    return F.regexp_extract_all(F.lower(content), F.lit(WORD_PATTERN), F.lit(0))


def ngrams(words: str, longest: int) -> Column:
    """All runs of 1 to ``longest`` words of a column of words, joined by a space.

    Takes a column name: an expression would be worked out again for every word.
    """
    column = F.col(words)

    def runs_of(n: int) -> Column:
        def run(word, start):
            rest = (F.get(column, start + F.lit(k)) for k in range(1, n))
            return F.concat_ws(" ", word, *rest)

        whole = F.greatest(F.size(column) - F.lit(n - 1), F.lit(0))
        return F.slice(F.transform(column, run), F.lit(1), whole)

    if longest == 1:
        return column
    return F.concat(column, *(runs_of(n) for n in range(2, longest + 1)))


def url_parameter(url: Column, name: str = "id", default: str = "unknown") -> Column:
    """Value after ``name=`` up to the next ``&``; ``default`` where there is none."""
    value = F.regexp_extract(url, re.escape(name) + "=([^&]+)", 1)
    return F.when(value != "", value).otherwise(F.lit(default))


def html_nodes(html: Column, tag: str, css_class: str | None = None) -> Column:
    """Texts of all nodes of one tag (and class), nested tags removed."""
    attributes = rf'[^>]*\bclass="[^"]*\b{re.escape(css_class)}\b[^"]*"[^>]*' if css_class else ""
    pattern = rf"(?s)<{tag}{attributes}>(.*?)</{tag}>"
    return F.transform(
        F.regexp_extract_all(html, F.lit(pattern), F.lit(1)),
        lambda node: F.regexp_replace(node, F.lit("<[^>]*>"), F.lit("")),
    )
