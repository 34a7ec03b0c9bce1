import random

import pytest

from stayline.plans import evaluation as E


def frame(spark, rows):
    return spark.createDataFrame([(int(l), float(s)) for l, s in rows], "label int, score double").repartition(3)


def brute_auc(rows):
    pos = [s for l, s in rows if l]
    neg = [s for l, s in rows if not l]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg))


def brute_ap(rows):
    n_pos = sum(l for l, _ in rows)
    total, before = 0.0, 0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(l for l, s in rows if s >= t)
        called = sum(s >= t for _, s in rows)
        total += (tp - before) / n_pos * tp / called
        before = tp
    return total


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_ap_against_all_pairs(spark, many_partitions, seed):
    random.seed(seed)
    # one score holds a third of the rows
    rows = [(random.random() < 0.3, 0.5 if random.random() < 0.33 else round(random.random(), 2)) for _ in range(300)]
    got = E.ranking_quality(frame(spark, rows)).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(rows), abs=1e-12)
    assert got["average_precision"] == pytest.approx(brute_ap(rows), abs=1e-12)


def test_perfect_reversed_and_tied(spark):
    ascending = [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)]
    reversed_ = [(1 - l, s) for l, s in ascending]
    tied = [(l, 0.5) for l, _ in ascending]
    assert E.roc_auc(frame(spark, ascending)).first()[0] == 1.0
    assert E.roc_auc(frame(spark, reversed_)).first()[0] == 0.0
    assert E.roc_auc(frame(spark, tied)).first()[0] == 0.5
    assert E.average_precision(frame(spark, ascending)).first()[0] == 1.0
    assert E.average_precision(frame(spark, tied)).first()[0] == 0.5


def test_one_class_only_is_undefined(spark):
    assert E.roc_auc(frame(spark, [(1, 0.2), (1, 0.4)])).first()[0] is None
    assert E.average_precision(frame(spark, [(0, 0.2), (0, 0.4)])).first()[0] is None


ROWS = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)]


def test_known_curves(spark):
    pr = E.pr_curve(frame(spark, ROWS)).collect()
    points = {(r["threshold"], round(r["precision"], 4), r["recall"]) for r in pr}
    assert points == {
        (0.1, 0.5, 1.0), (0.35, 0.6667, 1.0), (0.4, 0.5, 0.5), (0.8, 1.0, 0.5), (None, 1.0, 0.0),
    }
    roc = {(r["threshold"], r["fpr"], r["tpr"]) for r in E.roc_curve(frame(spark, ROWS)).collect()}
    assert roc == {
        (float("inf"), 0, 0), (0.8, 0, 0.5), (0.4, 0.5, 0.5), (0.35, 0.5, 1.0), (0.1, 1.0, 1.0),
    }
    assert E.average_precision(frame(spark, ROWS)).first()[0] == pytest.approx(0.8333333333)


def test_f1_by_threshold(spark):
    got = {r["threshold"]: r["f1"] for r in E.f1_by_threshold(frame(spark, ROWS)).collect()}
    assert got[0.35] == pytest.approx(2 * (2 / 3) / (5 / 3 + 1e-9))
    assert len(got) == 4


def test_confusion_and_report(spark):
    rows = [(0, 0.2)] * 5 + [(0, 0.5)] * 2 + [(1, 0.9)] * 3 + [(1, 0.1)]
    counts = E.confusion(frame(spark, rows))
    assert counts.first().asDict() == {"tn": 5, "fp": 2, "fn": 1, "tp": 3}
    strict = E.confusion(frame(spark, rows), strictly_above=True).first().asDict()
    assert strict == {"tn": 7, "fp": 0, "fn": 1, "tp": 3}
    report = {r["class"]: r for r in E.class_report(counts).collect()}
    assert report["Churned"]["precision"] == 0.6 and report["Churned"]["recall"] == 0.75
    assert report["Churned"]["f1"] == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    assert report["Active"]["support"] == 7 and report["accuracy"]["f1"] == pytest.approx(8 / 11)
    assert report["macro avg"]["recall"] == pytest.approx((5 / 7 + 0.75) / 2)
    assert report["weighted avg"]["precision"] == pytest.approx((5 / 6 * 7 + 0.6 * 4) / 11)


def test_undefined_precision_is_zero(spark):
    figures = E.positive_scores(E.confusion(frame(spark, [(1, 0.1), (0, 0.2)]))).first()
    assert tuple(figures) == (0.0, 0.0, 0.0)


def test_groups_are_evaluated_apart(spark, many_partitions):
    random.seed(9)
    data = {m: [(random.random() < 0.4, round(random.random(), 2)) for _ in range(120)] for m in "abc"}
    rows = [(m, int(l), s) for m, each in data.items() for l, s in each]
    df = spark.createDataFrame(rows, "model string, label int, score double").repartition(5)
    for row in E.model_metrics(df, by=["model"]).collect():
        each = data[row["model"]]
        assert row["roc_auc"] == pytest.approx(brute_auc(each))
        assert row["average_precision"] == pytest.approx(brute_ap(each))
        called = [l for l, s in each if s >= 0.5]
        assert row["precision"] == pytest.approx(sum(called) / len(called))


def test_baseline_balance_weights(spark):
    df = frame(spark, [(0, 0)] * 7 + [(1, 0)] * 3)
    assert tuple(E.majority_baseline(df).first()) == (0.7, 0.0)
    assert E.class_balance(df).first().asDict() == {"neg": 7, "pos": 3, "neg_per_pos": 2.33, "positive_rate": 0.3}
    weights = {r["label"]: r["class_weight"] for r in E.balanced_weights(df).collect()}
    assert weights == {0: 10 / 14, 1: 10 / 6}
