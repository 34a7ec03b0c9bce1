import random
from decimal import Decimal

import pytest

import micro
from stayline.plans import scoring


@pytest.fixture()
def scores(spark):
    random.seed(8)
    rows = [
        dict(
            account_id=f"A{i:03d}",
            plan_tier=random.choice(["starter", "professional", "enterprise"]),
            arr=Decimal(random.choice([1200, 1200, 5000, 80000])),
        )
        for i in range(120)
    ]
    probabilities = [(f"A{i:03d}", random.choice([0.25, 0.5, 0.75, 0.15, random.random()]), int(i % 4 == 0)) for i in range(120)]
    predicted = spark.createDataFrame(probabilities, "account_id string, churn_proba double, churned int")
    return scoring.score_table(predicted, micro.accounts(spark, rows).drop("churned"))


def test_score_table(scores):
    for r in scores.collect():
        assert r["churn_proba"] == round(r["churn_proba"], 4)
        assert r["arr_at_risk"] == round(r["churn_proba"] * float(r["arr"]))
    assert scores.count() == 120


def test_action_list(scores, many_partitions):
    rows = scoring.action_list(scores).collect()
    assert [c for c in scoring.ACTION_COLUMNS] == list(rows[0].asDict())
    rows.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    keys = [(-r["arr_at_risk"], r["account_id"]) for r in rows]
    assert keys == sorted(keys)
    assert all(r["churn_proba"] >= 0.5 for r in rows)
    assert len(rows) == scores.where("churn_proba >= 0.5").count()


def test_exclude_churned(spark):
    predicted = spark.createDataFrame([("a", 0.9, 1), ("b", 0.8, 0)], "account_id string, churn_proba double, churned int")
    details = micro.accounts(spark, [dict(account_id="a"), dict(account_id="b")]).drop("churned")
    kept = scoring.score_table(predicted, details, exclude_churned=True)
    assert [r["account_id"] for r in kept.collect()] == ["b"]


def test_sweep_against_rescans(scores):
    table = scores.collect()
    rows = sorted(scoring.threshold_sweep(scores).collect(), key=lambda r: r["threshold"])
    assert [r["threshold"] for r in rows] == list(scoring.THRESHOLDS) and len(rows) == 16
    lost = sum(r["arr"] for r in table if r["churned"])
    for row in rows:
        flagged = [r for r in table if r["churn_proba"] >= row["threshold"]]
        assert row["accounts_flagged"] == len(flagged)
        caught = sum(r["arr"] for r in flagged if r["churned"])
        assert row["arr_coverage"] == pytest.approx(float(caught) / float(lost))
    flagged = [r["accounts_flagged"] for r in rows]
    assert flagged == sorted(flagged, reverse=True)
    assert all(0 <= r["arr_coverage"] <= 1 for r in rows)


def test_sweep_without_churners(scores):
    rows = scoring.threshold_sweep(scores.where("churned = 0")).collect()
    assert {r["arr_coverage"] for r in rows} == {0.0}


def test_tiers_and_portfolio(scores):
    tiers = {r["risk_tier"]: r for r in scoring.tier_summary(scores).collect()}
    whole = scoring.portfolio_summary(scores).first()
    assert sum(r["accounts"] or 0 for r in tiers.values()) == whole["total_accounts"] == 120
    assert tiers["Critical"]["accounts"] == whole["critical_accounts"]
    assert whole["listed_accounts"] == whole["critical_accounts"] + whole["high_accounts"]
    assert whole["arr_at_risk"] == tiers["Critical"]["arr_at_risk"] + tiers["High"]["arr_at_risk"]
    assert max(r["relative_risk"] for r in tiers.values()) == 1.0
    low = scoring.tier_summary(scores.where("risk_tier = 'Low'")).orderBy("position").collect()
    assert [r["risk_tier"] for r in low] == ["Critical", "High", "Moderate", "Low"]
    assert low[0]["accounts"] is None


def test_thresholds_are_those_of_arange(spark):
    import numpy as np

    assert list(scoring.THRESHOLDS) == np.arange(0.1, 0.9, 0.05).tolist()
    # The ninth threshold is a little above one half.
    one = spark.createDataFrame([("a", 0.5, 1, 10.0)], "account_id string, churn_proba double, churned int, arr double")
    flagged = {r["threshold"]: r["accounts_flagged"] for r in scoring.threshold_sweep(one).collect()}
    assert flagged[scoring.THRESHOLDS[8]] == 0 and flagged[scoring.THRESHOLDS[7]] == 1
