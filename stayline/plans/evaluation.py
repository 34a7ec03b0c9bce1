"""Exact evaluation of binary scores, as DataFrame queries.

Input is any table with a 0/1 ``label`` and a ``score`` column; ``by`` evaluates
several models or folds at once. Equal scores are counted together first, so ties
are exact and the sorted part holds one row per distinct score.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.scalars import f1_of, numpy_round, ratio
from stayline.operators.ordering import attach, running_totals

# Products of two counts pass the range of a bigint on large tables.
_WIDE = "decimal(38,0)"


def score_counts(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """Positives and negatives per distinct score."""
    positive = F.col(label) == 1
    return scores.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )


def cumulative_counts(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """True and false positives when everything from a score upwards is flagged, and
    the sizes of both classes."""
    counts = score_counts(scores, label, score, by)
    running = {"tp": "pos", "fp": "neg"}
    return running_totals(counts, [F.desc("threshold")], running, by, {"n_pos": "tp", "n_neg": "fp"})


def _groups(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group, or one row in all."""
    return curve.select(*by).distinct() if by else curve.sparkSession.range(1).drop("id")


def roc_curve(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """fpr and tpr per distinct score, after the point (0, 0) that flags nothing."""
    curve = cumulative_counts(scores, label, score, by)
    points = curve.select(
        *by,
        F.col("threshold").cast("double").alias("threshold"),
        ratio(F.col("fp"), F.col("n_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    origin = _groups(curve, by).select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(
    scores: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    closing_point: bool = True,
) -> DataFrame:
    """Precision and recall per distinct score, and the closing point (1, 0)."""
    curve = cumulative_counts(scores, label, score, by)
    points = curve.select(
        *by,
        F.col("threshold").cast("double").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("n_pos")).alias("recall"),
    )
    if not closing_point:
        return points
    end = _groups(curve, by).select(
        *by,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def f1_by_threshold(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    return pr_curve(scores, label, score, by, closing_point=False).withColumn(
        "f1", f1_of(F.col("precision"), F.col("recall"))
    )


def _pairs_won(tp: Column, pos: Column, neg: Column) -> Column:
    """Twice the positive-negative pairs in which the positive ranks higher, ties half."""
    return neg.cast(_WIDE) * (2 * (tp - pos) + pos).cast(_WIDE)


def _sums(curve: DataFrame, by: Sequence[str], *more: Column) -> DataFrame:
    """What ranking figures are made of, per group."""
    steps = F.col("pos").cast("double") * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return curve.groupBy(*by).agg(
        F.sum(_pairs_won(F.col("tp"), F.col("pos"), F.col("neg"))).alias("won"),
        F.sum(steps).alias("steps"),
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        *more,
    )


def _ranking_figures() -> list[Column]:
    pairs = 2 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return [
        ratio(F.col("won"), pairs).alias("roc_auc"),
        ratio(F.col("steps"), F.col("n_pos")).alias("average_precision"),
    ]


def ranking_quality(
    scores: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """ROC-AUC by pair counting and average precision as the step sum, in one pass."""
    sums = _sums(cumulative_counts(scores, label, score, by), by)
    return sums.select(*by, *_ranking_figures())


def roc_auc(scores, label="label", score="score", by=()) -> DataFrame:
    return ranking_quality(scores, label, score, by).drop("average_precision")


def average_precision(scores, label="label", score="score", by=()) -> DataFrame:
    return ranking_quality(scores, label, score, by).drop("roc_auc")


def confusion(
    scores: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    cut: float = 0.5,
    strictly_above: bool = False,
) -> DataFrame:
    """Counts of the four outcomes at a cut."""
    flagged = F.col(score) > cut if strictly_above else F.col(score) >= cut
    return confusion_of(scores.withColumn("_flagged", flagged.cast("int")), label, "_flagged", by)


def confusion_of(
    predictions: DataFrame, label: str = "label", predicted: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    actual, called = F.col(label) == 1, F.col(predicted) == 1
    return predictions.groupBy(*by).agg(
        F.count_if(~actual & ~called).alias("tn"),
        F.count_if(~actual & called).alias("fp"),
        F.count_if(actual & ~called).alias("fn"),
        F.count_if(actual & called).alias("tp"),
    )


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def _class_scores(hit: Column, called: Column, actual: Column, prefix: str = "") -> dict[str, Column]:
    """Precision, recall and F1 of one class; 0 where undefined."""
    return {
        f"{prefix}precision": _or_zero(hit, called),
        f"{prefix}recall": _or_zero(hit, actual),
        f"{prefix}f1": _or_zero(2 * hit, called + actual),
    }


def positive_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 of the positive class from confusion counts."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    figures = _class_scores(tp, tp + fp, tp + fn)
    return counts.select(*by, *[c.alias(n) for n, c in figures.items()])


def class_report(counts: DataFrame, names: Sequence[str] = ("Active", "Churned")) -> DataFrame:
    """Per-class figures, accuracy, macro and weighted means, as rows.

    ``counts`` is one row of confusion counts.
    """
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    both = counts.withColumns(
        {
            **_class_scores(tn, tn + fn, tn + fp, "a_"),
            **_class_scores(tp, tp + fp, tp + fn, "b_"),
            "a_n": tn + fp,
            "b_n": tp + fn,
            "n": tn + fp + fn + tp,
            "accuracy": _or_zero(tn + tp, tn + fp + fn + tp),
        }
    )
    measures = ("precision", "recall", "f1")

    def row(name: str, figures: dict[str, Column], support: str) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[figures[m].alias(m) for m in measures],
            F.col(support).alias("support"),
        )

    def mixed(combine) -> dict[str, Column]:
        return {m: combine(F.col(f"a_{m}"), F.col(f"b_{m}")) for m in measures}

    nothing = F.lit(None).cast("double")
    rows = [
        row(names[0], {m: F.col(f"a_{m}") for m in measures}, "a_n"),
        row(names[1], {m: F.col(f"b_{m}") for m in measures}, "b_n"),
        row("accuracy", {"precision": nothing, "recall": nothing, "f1": F.col("accuracy")}, "n"),
        row("macro avg", mixed(lambda a, b: (a + b) / 2), "n"),
        row(
            "weighted avg",
            mixed(lambda a, b: _or_zero(a * F.col("a_n") + b * F.col("b_n"), F.col("n"))),
            "n",
        ),
    ]
    return both.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def model_metrics(
    scores: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    cut: float = 0.5,
    strictly_above: bool = False,
) -> DataFrame:
    """One row per group: roc_auc, average_precision, f1, precision, recall.

    The counts at the cut are read off the cumulative counts, so the scores are read
    once for all figures.
    """
    flagged = F.col("threshold") > cut if strictly_above else F.col("threshold") >= cut

    def at_cut(name: str) -> Column:
        return F.coalesce(F.max(F.when(flagged, F.col(name))), F.lit(0))

    curve = cumulative_counts(scores, label, score, by)
    sums = _sums(curve, by, at_cut("tp").alias("hit"), (at_cut("tp") + at_cut("fp")).alias("called"))
    cutting = _class_scores(F.col("hit"), F.col("called"), F.col("n_pos"))
    return sums.select(
        *by, *_ranking_figures(), *[cutting[m].alias(m) for m in ("f1", "precision", "recall")]
    )


def majority_baseline(df: DataFrame, label: str = "label") -> DataFrame:
    """What calling everyone negative would score."""
    share = ratio(F.sum(label), F.count(label))
    return df.agg((1 - share).alias("accuracy"), F.lit(0.0).alias("recall"))


def class_balance(df: DataFrame, label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """Class counts, negatives per positive to two decimals, and the positive rate."""
    positive = F.col(label) == 1
    return (
        df.groupBy(*by)
        .agg(F.count_if(~positive).alias("neg"), F.count_if(positive).alias("pos"))
        .withColumns(
            {
                "neg_per_pos": numpy_round(ratio(F.col("neg"), F.col("pos")), 2),
                "positive_rate": ratio(F.col("pos"), F.col("neg") + F.col("pos")),
            }
        )
    )


def balanced_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Weight n / (classes * n_class) per class."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    # One row per class: two for a 0/1 label.
    every = sizes.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("classes"))
    return attach(sizes, every).select(
        label,
        "n_class",
        ratio(F.col("n"), F.col("classes") * F.col("n_class")).alias("class_weight"),
    )
