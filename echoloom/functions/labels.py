"""Sentiment labels and their numeric codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from echoloom.constants import LABEL_CODES, NEGATIVE, NEUTRAL, POSITIVE, UNKNOWN


def _literal_map(pairs) -> Column:
    return F.create_map(*map(F.lit, chain.from_iterable(pairs)))


def sentiment_from_score(score: Column) -> Column:
    """Star rating to label; anything off the scale, NaN or not a number is Unknown."""
    number = score.try_cast("double")
    stars = F.when(~F.isnan(number), number)
    return (
        F.when(stars <= 2, NEGATIVE)
        .when(stars == 3, NEUTRAL)
        .when(stars >= 4, POSITIVE)
        .otherwise(UNKNOWN)
    )


def encode_label(sentiment: Column) -> Column:
    """Label to code; null for a label without code."""
    return F.try_element_at(_literal_map(LABEL_CODES.items()), sentiment)


def decode_label(code: Column) -> Column:
    """Code to label; Unknown for any other code."""
    names = _literal_map((code_, name) for name, code_ in LABEL_CODES.items())
    return F.coalesce(F.try_element_at(names, code.cast("int")), F.lit(UNKNOWN))
