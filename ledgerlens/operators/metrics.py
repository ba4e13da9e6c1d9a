"""Binary classification metrics of a score column.

Every metric starts from the score table: positives and negatives of each distinct score. It is all a threshold can
see, it combines before the shuffle, and tied scores are one row in it. ``by`` columns give one result a group, such
as a model or a feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.labels import DECISION_THRESHOLD
from ledgerlens.functions.numeric import ratio, rounded
from ledgerlens.operators.ordered import running_totals
from ledgerlens.operators.small import bounded, settled

CLASS_NAMES = {0: "Legitimate", 1: "Fraud"}


def score_table(df: DataFrame, by: list[str] | None = None, score: str = "score", label: str = "is_fraud") -> DataFrame:
    """``(*by, score, pos, neg)``."""
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return known.groupBy(*(by or []), F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def _with_totals(df: DataFrame, scores: DataFrame, by: list[str]) -> DataFrame:
    totals = scores.groupBy(*by).agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    if by:
        return df.join(bounded(totals), by)
    return df.withColumn("_t", totals.select(F.struct("*").alias("t")).scalar()).select(
        *df.columns, F.col("_t.all_pos").alias("all_pos"), F.col("_t.all_neg").alias("all_neg")
    )


def _curve(df: DataFrame, by: list[str], following: dict[str, str] | None = None) -> DataFrame:
    """The score table with true and false positives at each score as the threshold, and the class totals.

    The score table is written once, so the scored rows are read once however often the curve is.
    """
    scores = settled(score_table(df, by))
    placed = running_totals(scores, "score", {"pos": "tp", "neg": "fp"}, by, descending=True, following=following)
    return _with_totals(placed, scores, by)


def roc_points(df: DataFrame, by: list[str] | None = None, drop_intermediate: bool = True, digits: int = 6) -> DataFrame:
    """``(*by, threshold, fpr, tpr)``; the start of the curve has an infinite threshold.

    ``drop_intermediate`` leaves out points on a straight line: those whose next score brings the same counts. The
    first and the last score always stay.
    """
    by = by or []
    curve = _curve(df, by, {"pos": "next_pos", "neg": "next_neg"})
    rates = [
        rounded(ratio(F.col("fp"), F.col("all_neg")), digits).alias("fpr"),
        rounded(ratio(F.col("tp"), F.col("all_pos")), digits).alias("tpr"),
    ]
    start = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
    if drop_intermediate:
        same = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
        curve = curve.where(start | F.col("next_pos").isNull() | ~same)
    points = curve.select(*by, F.col("score").alias("threshold"), *rates)
    origin = curve.where(start).select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_points(df: DataFrame, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """``(*by, threshold, prec, recall)``; the end of the curve (precision 1, recall 0) has no threshold."""
    by = by or []
    curve = _curve(df, by)
    points = curve.select(
        *by,
        F.col("score").alias("threshold"),
        rounded(ratio(F.col("tp"), F.col("tp") + F.col("fp")), digits).alias("prec"),
        rounded(ratio(F.col("tp"), F.col("all_pos")), digits).alias("recall"),
    )
    start = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
    end = curve.where(start).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("prec"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def roc_auc(df: DataFrame, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Area under the ROC curve as a tie-aware rank sum; NULL if a class is absent."""
    by = by or []
    # A positive outranks the negatives scored lower, and half of those tied with it.
    below = F.col("all_neg") - F.col("fp") + F.col("neg") / F.lit(2.0)
    return _curve(df, by).groupBy(*by).agg(
        rounded(
            ratio(F.sum(F.col("pos") * below), F.max("all_pos").cast("double") * F.max("all_neg").cast("double")),
            digits,
        ).alias("roc_auc")
    )


def average_precision(df: DataFrame, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Step-wise sum of precision over recall steps (not the trapezoid under the curve)."""
    by = by or []
    step = F.col("pos") * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return _curve(df, by).groupBy(*by).agg(
        rounded(ratio(F.sum(step), F.max("all_pos")), digits).alias("average_precision")
    )


def ranking_metrics(df: DataFrame, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """ROC area and average precision from one pass over the curve."""
    by = by or []
    below = F.col("all_neg") - F.col("fp") + F.col("neg") / F.lit(2.0)
    step = F.col("pos") * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg").cast("double")
    return _curve(df, by).groupBy(*by).agg(
        rounded(ratio(F.sum(F.col("pos") * below), pairs), digits).alias("roc_auc"),
        rounded(ratio(F.sum(step), F.max("all_pos")), digits).alias("average_precision"),
    )


def curve_point_at(points: DataFrame, thresholds: list[float], curve: str, by: list[str] | None = None) -> DataFrame:
    """The curve point nearest to each wanted threshold.

    A tie goes to the higher threshold on a ROC curve (which runs downwards) and to the lower on a precision-recall
    curve (which runs upwards).
    """
    by = by or []
    x, y = ("fpr", "tpr") if curve == "roc" else ("prec", "recall")
    direction = -F.col("threshold") if curve == "roc" else F.col("threshold")
    wanted = points.where(F.col("threshold").isNotNull()).select(
        "*", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("wanted")
    )
    nearest = F.min_by(F.struct("threshold", x, y), F.struct(F.abs(F.col("threshold") - F.col("wanted")), direction))
    return wanted.groupBy(*by, "wanted").agg(nearest.alias("p")).select(
        *by, "wanted", F.col("p.threshold").alias("threshold"), F.col(f"p.{x}").alias(x), F.col(f"p.{y}").alias(y)
    )


def confusion_counts(df: DataFrame, thresholds: list[float], by: list[str] | None = None) -> DataFrame:
    """``(*by, threshold, tp, fp, fn, tn)`` for every threshold from one pass, without repeating rows."""
    by = by or []
    aggregates, entries = [], []
    pos, neg = F.col("is_fraud") == 1, F.col("is_fraud") == 0
    for i, t in enumerate(thresholds):
        above = F.col("score") >= F.lit(float(t))
        parts = {"tp": above & pos, "fp": above & neg, "fn": ~above & pos, "tn": ~above & neg}
        aggregates += [F.count_if(cond).alias(f"{name}_{i}") for name, cond in parts.items()]
        entries.append(
            F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{n}_{i}").alias(n) for n in parts])
        )
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*entries)))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _prf(tp: Column, predicted: Column, actual: Column) -> dict[str, Column]:
    """Precision, recall and F1; 0 where a denominator is 0."""
    return {
        "prec": _or_zero(ratio(tp, predicted)),
        "recall": _or_zero(ratio(tp, actual)),
        "f1": _or_zero(ratio(2 * tp, predicted + actual)),
    }


def threshold_sweep(df: DataFrame, thresholds: list[float], by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Counts, accuracy, precision, recall and F1 at every threshold."""
    by = by or []
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    scores = _prf(tp, tp + fp, tp + fn)
    return confusion_counts(df, thresholds, by).select(
        *by,
        "threshold",
        "tp",
        "fp",
        "fn",
        "tn",
        rounded(_or_zero(ratio(tp + tn, tp + fp + fn + tn)), digits).alias("accuracy"),
        *[rounded(v, digits).alias(n) for n, v in scores.items()],
    )


def metrics_at_threshold(
    df: DataFrame, threshold: float = DECISION_THRESHOLD, by: list[str] | None = None, digits: int = 6
) -> DataFrame:
    return threshold_sweep(df, [threshold], by, digits)


def confusion_matrix(df: DataFrame, threshold: float = DECISION_THRESHOLD, digits: int = 6) -> DataFrame:
    """``(actual, predicted, rows, share)``; the share is of the actual class. All four cells are listed."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def cell(actual: int, predicted: int, rows: Column, whole: Column) -> Column:
        return F.struct(
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            rows.alias("rows"),
            rounded(_or_zero(ratio(rows, whole)), digits).alias("share"),
        )

    cells = [
        cell(0, 0, tn, tn + fp),
        cell(0, 1, fp, tn + fp),
        cell(1, 0, fn, fn + tp),
        cell(1, 1, tp, fn + tp),
    ]
    return confusion_counts(df, [threshold]).select(F.inline(F.array(*cells)))


def classification_report(df: DataFrame, threshold: float = DECISION_THRESHOLD, digits: int = 6) -> DataFrame:
    """``(class, prec, recall, f1, support)``: both classes, their plain and weighted means, and the accuracy."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    fraud, legit = _prf(tp, tp + fp, tp + fn), _prf(tn, tn + fn, tn + fp)
    n_fraud, n_legit = tp + fn, tn + fp
    total = n_fraud + n_legit

    def line(name: str, values: dict[str, Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[rounded(v, digits).alias(k) for k, v in values.items()],
            support.alias("support"),
        )

    macro = {k: (fraud[k] + legit[k]) / 2 for k in fraud}
    weighted = {k: _or_zero(ratio(fraud[k] * n_fraud + legit[k] * n_legit, total)) for k in fraud}
    accuracy = _or_zero(ratio(tp + tn, total))
    lines = [
        line(CLASS_NAMES[0], legit, n_legit),
        line(CLASS_NAMES[1], fraud, n_fraud),
        line("accuracy", {k: accuracy for k in fraud}, total),
        line("macro avg", macro, total),
        line("weighted avg", weighted, total),
    ]
    return confusion_counts(df, [threshold]).select(F.inline(F.array(*lines)))


def best_f1_threshold(df: DataFrame, by: list[str] | None = None, digits: int = 6) -> DataFrame:
    """The threshold with the highest F1 over all scores; a tie goes to the lowest threshold."""
    by = by or []
    predicted = F.col("tp") + F.col("fp")
    curve = _curve(df, by).withColumn("f1", _prf(F.col("tp"), predicted, F.col("all_pos"))["f1"])
    best = F.min_by(F.struct("score", "f1"), F.struct(-F.col("f1"), F.col("score")))
    return curve.groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b.score").alias("threshold"), rounded(F.col("b.f1"), digits).alias("f1")
    )


def evaluation_report(df: DataFrame, thresholds: list[float], digits: int = 4) -> DataFrame:
    """All of the above as one long table ``(threshold, class, metric, value)``; ranking metrics have no threshold."""
    ranking = ranking_metrics(df, digits=digits).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit("all").alias("class"),
        F.inline(
            F.array(
                *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in ("roc_auc", "average_precision")]
            )
        ),
    )
    names = ["tp", "fp", "fn", "tn", "accuracy", "prec", "recall", "f1"]
    sweep = threshold_sweep(df, thresholds, digits=digits).select(
        "threshold",
        F.lit("Fraud").alias("class"),
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
        ),
    )
    return ranking.unionByName(sweep)


def batch_summary(df: DataFrame, digits: int = 4) -> DataFrame:
    """Rows, flagged and legitimate rows, flagged rate and mean score of scored rows."""
    flagged = F.coalesce(F.sum("predicted_fraud"), F.lit(0)).cast("bigint")
    return df.agg(
        F.count("*").alias("total"),
        flagged.alias("flagged"),
        (F.count("*") - flagged).alias("legitimate"),
        rounded(ratio(flagged, F.count("*")), digits).alias("fraud_rate"),
        rounded(F.avg("score"), digits).alias("avg_score"),
    )
