import pytest

import micro
from stayline.plans import eda


@pytest.fixture()
def accounts(spark):
    return micro.accounts(
        spark,
        [
            dict(account_id="a", churned=1, plan_tier="starter", industry="X"),
            dict(account_id="b", churned=0, plan_tier="starter", industry="X"),
            dict(account_id="c", churned=0, plan_tier="enterprise", industry="Y"),
        ],
    )


def test_tier_order_and_absent_tier(accounts):
    rows = eda.churn_by_tier(accounts).orderBy("position").collect()
    assert [(r["plan_tier"], r["churn_rate"]) for r in rows] == [
        ("starter", 0.5), ("professional", None), ("enterprise", 0.0),
    ]


def test_overview_and_industry(accounts):
    assert {r["churn_label"]: r["share"] for r in eda.churn_overview(accounts).collect()} == {
        "Active": 2 / 3, "Churned": 1 / 3,
    }
    assert [r["industry"] for r in eda.churn_by_industry(accounts).collect()] == ["Y", "X"]


def test_api_flag_leaves_out_accounts_without_usage(spark, accounts):
    usage = micro.usage(
        spark,
        [
            ("a", "2024-06-01", 1),
            ("b", "2024-06-01", 1, {"has_api_integration": 1}),
            ("b", "2024-07-01", 1),
        ],
    )
    got = {r["integration"]: (r["accounts"], r["churn_rate"]) for r in eda.churn_by_api(accounts, usage).collect()}
    assert got == {"No API": (1, 1.0), "Has API": (1, 0.0)}


def test_means_are_row_weighted_or_account_weighted(spark, accounts):
    tickets = micro.tickets(
        spark,
        [("b", "2024-06-01", "high", 1, 5.0)] * 9
        + [("c", "2024-06-01", "low", 1, 1.0), ("c", "2024-06-01", "low", 1, None)],
    )
    got = {r["churn_label"]: r for r in eda.support_by_label(tickets, accounts).collect()}
    assert got["Active"]["avg_csat"] == 3.0 and got["Active"]["pct_high_critical"] == 50.0
    usage = micro.usage(spark, [("b", "2024-06-01", 10)] * 3 + [("c", "2024-06-01", 2)])
    means = {r["churn_label"]: r["avg_logins"] for r in eda.logins_by_month(usage, accounts).collect()}
    assert means == {"Active": 8.0}


def test_logins_by_month_groups_by_month_and_label_only(spark, accounts):
    """A second grouping by account and month held all its groups twice in the memory of a task."""
    usage = micro.usage(spark, [("b", "2024-06-01", 10), ("b", "2024-06-01", None), ("c", "2024-06-01", 2), ("c", "2024-07-01", None)])
    means = eda.logins_by_month(usage, accounts)
    assert means._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert {(str(r["month"]), r["churn_label"]): r["avg_logins"] for r in means.collect()} == {("2024-06-01", "Active"): 6.0, ("2024-07-01", "Active"): None}


def test_priority_mix_sums_to_one_hundred(spark, accounts):
    tickets = micro.tickets(
        spark, [("a", "2024-06-01", p, 1, None) for p in ("low", "low", "critical", "high")]
    )
    row = eda.priority_mix(tickets, accounts).first()
    assert (row["low"], row["critical"], row["high"], row["medium"]) == (50.0, 25.0, 25.0, 0.0)


def test_nps_tables(spark, accounts):
    nps = micro.nps(spark, [("a", "2024-06-30", 3), ("a", "2024-09-30", 3), ("b", "2024-06-30", 10)])
    spread = {r["nps_score"]: (r["active"], r["churned"]) for r in eda.nps_distribution(nps, accounts).collect()}
    assert len(spread) == 11 and spread[3] == (0, 2) and spread[10] == (1, 0) and spread[0] == (0, 0)
    quarters = eda.nps_by_quarter(nps, accounts).collect()
    assert {(r["quarter"], r["churn_label"], r["avg_nps"]) for r in quarters} == {
        ("Q1_2024", "Churned", 3.0), ("Q1_2024", "Active", 10.0),
    }


def test_every_quarter_that_occurs_in_time_order(spark, accounts):
    named = [("a", "Q2_2030", 1), ("a", "Q4_2029", 2), ("b", "Q4_2029", 3)]
    nps = spark.createDataFrame(named, "account_id string, quarter string, nps_score int")
    rows = eda.nps_by_quarter(nps, accounts).collect()
    assert {(r["position"], r["quarter"], r["avg_nps"]) for r in rows} == {
        (0, "Q4_2029", 2.0), (0, "Q4_2029", 3.0), (1, "Q2_2030", 1.0),
    }
    listed = eda.nps_by_quarter(nps, accounts, ["Q2_2030", "Q1_2000"]).collect()
    assert [(r["position"], r["quarter"]) for r in listed] == [(0, "Q2_2030")]


def test_histogram_of_one_value(accounts):
    rows = [r for r in eda.mrr_histogram(accounts).collect() if r["accounts"]]
    assert {(r["churn_label"], r["bin"], r["accounts"]) for r in rows} == {("Active", 20, 2), ("Churned", 20, 1)}
    assert {r["bin_from"] for r in rows} == {100.0}


def test_priority_mix_has_every_priority_that_occurs(spark):
    people = spark.createDataFrame([(1, 0)], "account_id long, churned int")
    tickets = spark.createDataFrame([(1, 1, "urgent"), (2, 1, "high")], "ticket_id long, account_id long, priority string")
    row = eda.priority_mix(tickets, people).first()
    assert (row["high"], row["urgent"]) == (50.0, 50.0)
