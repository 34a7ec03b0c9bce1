import datetime as dt
import glob
import random
from decimal import Decimal

import pytest

import micro
from stayline import workflow
from stayline.session import ensure_checkpoint_dir, leaves_results_only
from stayline.sources.tables import write_table


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    """Raw CSV tables of 120 accounts; churners log in less and score lower."""
    random.seed(21)
    raw = str(tmp_path_factory.mktemp("raw"))
    out = str(tmp_path_factory.mktemp("out"))
    accounts, usage, tickets, nps = [], [], [], []
    for i in range(120):
        name, gone = f"A{i:03d}", i % 5 == 0
        accounts.append(
            dict(
                account_id=name,
                company_name=f"Company {i}",
                plan_tier=random.choice(["starter", "professional", "enterprise"]),
                region=random.choice(["NA", "EMEA", "APAC"]),
                arr=Decimal(1000 + 37 * i),
                mrr=Decimal(83 + 3 * i),
                churned=int(gone),
                churn_date=dt.date(2025, 2, 1) if gone else None,
            )
        )
        for month in range(6, 12):
            usage.append((name, f"2024-{month:02d}-01", random.randrange(0, 40) + (0 if gone else 30)))
        for _ in range(random.randrange(0, 4)):
            tickets.append((name, f"2024-{random.randrange(5, 13):02d}-15", random.choice(["low", "high", "critical"]), random.randrange(1, 40), random.choice([None, 1.0, 3.0, 5.0])))
        if i % 3:
            nps.append((name, "2024-06-30", random.randrange(0, 5) if gone else random.randrange(5, 11)))
    tables = {
        "accounts": micro.accounts(spark, accounts),
        "usage_metrics": micro.usage(spark, usage),
        "support_tickets": micro.tickets(spark, tickets),
        "nps_surveys": micro.nps(spark, nps),
    }
    for name, table in tables.items():
        write_table(table, f"{raw}/{name}.csv", "csv")
    return raw, out


def test_jobs_hand_over(spark, folders):
    raw, out = folders
    features = workflow.build(spark, raw, out, micro.SNAPSHOT)
    assert features.count() == 120 and len(features.columns) == 32
    comparison = workflow.train(
        spark,
        out,
        forest_grid={"numTrees": [3], "maxDepth": [2, 3]},
        boost_grid={"maxIter": [3], "maxDepth": [2]},
        folds=2,
    )
    names = {r["model"] for r in comparison.collect()}
    assert names == {workflow.LOGISTIC, workflow.FOREST, workflow.BOOSTED}
    assert comparison.where("roc_auc < 0.7").count() == 0
    assert workflow.winner(comparison).first()["model"] in names
    tables = workflow.act(spark, raw, out)
    scores = tables["scores"]
    assert scores.count() == 120
    listed = spark.read.option("header", True).csv(f"{out}/cs_action_list")
    flagged = scores.where("churn_proba >= 0.5").count()
    assert listed.count() == flagged > 0
    assert sorted(int(r["rank"]) for r in listed.collect()) == list(range(1, flagged + 1))
    assert tables["threshold_sweep"].count() == 16
    assert tables["portfolio_summary"].first()["listed_accounts"] == flagged


def test_describe(spark, folders):
    raw, out = folders
    workflow.describe(spark, raw, out)
    rate = spark.read.parquet(f"{out}/eda/churn_overview").collect()
    assert {r["churn_label"]: r["accounts"] for r in rate} == {"Active": 96, "Churned": 24}
    assert spark.read.parquet(f"{out}/eda/accounts_nulls").first().asDict() == {"column_name": "churn_date", "n_null": 96}


def test_checkpoints_live_as_long_as_their_job(spark):
    ensure_checkpoint_dir(spark)
    outside = spark.range(5).checkpoint()
    base = spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0].removeprefix("file:")
    seen = []

    @leaves_results_only
    def job(session):
        session.range(9).checkpoint()
        seen.extend(glob.glob(f"{base}/job-*/**/part-*", recursive=True))
        raise RuntimeError("half-way")

    with pytest.raises(RuntimeError, match="half-way"):
        job(spark)
    assert seen and not glob.glob(f"{base}/job-*")
    assert outside.count() == 5 and spark.range(3).checkpoint().count() == 3
