"""Classification metrics from one pass over (actual, predicted) labels.

All figures come from the confusion counts, which are combined on the map side:
nine counters per result, whatever the number of predictions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echoloom.constants import LABELS

DIGITS = 4


def _cell(actual, predicted) -> str:
    return f"_{actual}_{predicted}"


def _confusion_cells(
    predictions: DataFrame, by: Sequence[str], labels: Sequence, actual: str, predicted: str
) -> DataFrame:
    cells = [
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(_cell(a, p))
        for a in labels
        for p in labels
    ]
    return predictions.groupBy(*by).agg(*cells)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _total(columns) -> Column:
    return reduce(add, columns)


def _scores(labels: Sequence, label) -> dict[str, Column]:
    hit = F.col(_cell(label, label))
    support = _total(F.col(_cell(label, p)) for p in labels)
    claimed = _total(F.col(_cell(a, label)) for a in labels)
    return {
        "precision": _ratio(hit, claimed),
        "recall": _ratio(hit, support),
        "f1": _ratio(2 * hit, support + claimed),
        "support": support,
    }


def confusion_matrix(
    predictions: DataFrame,
    by: Sequence[str] = (),
    labels: Sequence = LABELS,
    actual: str = "actual_sentiment",
    predicted: str = "predicted_sentiment",
) -> DataFrame:
    """One row per actual label and one column per predicted label."""
    cells = _confusion_cells(predictions, by, labels, actual, predicted)
    rows = F.array(
        *(
            F.struct(
                F.lit(a).alias("actual"),
                *(F.col(_cell(a, p)).alias(f"predicted_{p}") for p in labels),
            )
            for a in labels
        )
    )
    return cells.select(*by, F.inline(rows))


def classification_report(
    predictions: DataFrame,
    by: Sequence[str] = (),
    labels: Sequence = LABELS,
    actual: str = "actual_sentiment",
    predicted: str = "predicted_sentiment",
) -> DataFrame:
    """Precision, recall, F1 and support per label, plus both averages."""
    cells = _confusion_cells(predictions, by, labels, actual, predicted)
    scores = {str(label): _scores(labels, label) for label in labels}
    support = _total(s["support"] for s in scores.values())
    measures = ("precision", "recall", "f1")
    lines = dict(scores)
    lines["macro avg"] = {
        m: _total(s[m] for s in scores.values()) / len(labels) for m in measures
    } | {"support": support}
    lines["weighted avg"] = {
        m: _ratio(_total(s[m] * s["support"] for s in scores.values()), support) for m in measures
    } | {"support": support}
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("label"),
                *(F.round(line[m], DIGITS).alias(m) for m in measures),
                line["support"].alias("support"),
            )
            for name, line in lines.items()
        )
    )
    return cells.select(*by, F.inline(rows))


def eval_metrics(
    predictions: DataFrame,
    by: Sequence[str] = (),
    labels: Sequence = LABELS,
    actual: str = "actual_sentiment",
    predicted: str = "predicted_sentiment",
) -> DataFrame:
    """Accuracy and weighted F1, precision and recall; 0 where undefined."""
    cells = _confusion_cells(predictions, by, labels, actual, predicted)
    scores = [_scores(labels, label) for label in labels]
    support = _total(s["support"] for s in scores)
    hits = _total(F.col(_cell(label, label)) for label in labels)

    def weighted(measure: str) -> Column:
        return _ratio(_total(s[measure] * s["support"] for s in scores), support)

    return cells.select(
        *by,
        F.round(weighted("f1"), DIGITS).alias("f1_weighted"),
        F.round(_ratio(hits, support), DIGITS).alias("accuracy"),
        F.round(weighted("precision"), DIGITS).alias("precision"),
        F.round(weighted("recall"), DIGITS).alias("recall"),
    )
