import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest

import micro
from stayline.plans import features as P
from stayline.sources.schemas import feature_names

SNAPSHOT = micro.SNAPSHOT


def months(account, logins, start=(2024, 6)):
    year, month = start
    rows = []
    for value in logins:
        rows.append((account, f"{year}-{month:02d}-01", value))
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return rows


def test_usage_edges(spark):
    rows = (
        months("one", [5])
        + months("two", [5, 9])
        + months("three", [1, 2, 3])
        + months("four", [10, 20, 30, 40])
        + months("five", [1, 2, 3, 4, 6])
        + months("zero", [0, 0, 0, 5])
        + months("gap", [7, 7, 7], (2024, 6))
        + [("gap", "2025-02-01", 14), ("future", "2025-04-01", 99), ("edge", "2025-03-31", 3)]
    )
    got = micro.by_id(P.usage_features(micro.usage(spark, rows), SNAPSHOT))
    trend = {k: v["login_trend_pct"] for k, v in got.items()}
    change = {k: v["logins_mom_change"] for k, v in got.items()}
    assert "future" not in got
    assert trend["one"] == trend["two"] == trend["three"] == trend["zero"] == trend["edge"] == 0.0
    assert trend["four"] == 0.5  # (30 - 20) / 20, the halves overlap
    assert trend["five"] == round((13 / 3 - 2) / 2, 4)
    assert trend["gap"] == round((28 / 3 - 7) / 7, 4)
    assert change == {
        "one": 0, "two": 4, "three": 1, "four": 10, "five": 2, "zero": 5, "gap": 7, "edge": 0,
    }
    assert got["five"]["avg_monthly_logins"] == 3.2
    assert got["four"]["months_observed"] == 4
    assert got["four"]["total_api_calls"] == 40


def test_usage_means_skip_nulls(spark):
    rows = [
        ("a", "2024-06-01", 1, {"data_processed_gb": None, "has_api_integration": None}),
        ("a", "2024-07-01", None, {"data_processed_gb": Decimal("3.0"), "has_api_integration": 1}),
    ]
    got = micro.by_id(P.usage_features(micro.usage(spark, rows), SNAPSHOT))["a"]
    assert got["avg_monthly_logins"] == 1.0
    assert got["avg_data_processed_gb"] == 3.0
    assert got["has_api_integration"] == 1
    assert got["months_observed"] == 2
    assert got["logins_mom_change"] == 0.0  # an unknown month has no change


def test_rows_that_share_a_month_are_interchangeable(spark):
    rows = [("a", "2024-06-01", v) for v in (1, 2, 3, 4)] + [("a", "2024-07-01", v) for v in (8, 10)]
    forward = micro.by_id(P.usage_features(micro.usage(spark, rows), SNAPSHOT))["a"]
    backward = micro.by_id(P.usage_features(micro.usage(spark, rows[::-1]), SNAPSHOT))["a"]
    assert forward == backward
    # first three: three rows of a month with mean 2.5; last three: 8, 10 and one of that month
    assert forward["login_trend_pct"] == round(((18 + 2.5) / 3 - 2.5) / 2.5, 4)
    assert forward["months_observed"] == 6


def test_an_account_with_most_rows(spark, many_partitions):
    """One account owns most of the usage table; figures equal a direct computation."""
    random.seed(5)
    rows = []
    for month in range(1, 13):
        rows += [("big", f"2024-{month:02d}-01", random.randrange(50)) for _ in range(40)]
    rows += months("small", [3, 4, 5, 6])
    got = micro.by_id(P.usage_features(micro.usage(spark, rows), SNAPSHOT))
    logins = [r[2] for r in rows if r[0] == "big"]
    assert got["big"]["months_observed"] == 480
    assert got["big"]["avg_monthly_logins"] == round(sum(logins) / 480, 4)
    first, last = sum(logins[:40]) / 40, sum(logins[-40:]) / 40
    assert got["big"]["login_trend_pct"] == pytest.approx(round((last - first) / first, 4))
    assert got["small"]["logins_mom_change"] == 1.0


def test_monthly_tables_need_no_combining(spark):
    rows = months("a", [10, 20, 30, 40]) + months("b", [5]) + [("c", "2024-06-01", None)]
    table = micro.usage(spark, rows)
    combined = micro.by_id(P.usage_features(table, SNAPSHOT))
    assert micro.by_id(P.usage_features(table, SNAPSHOT, one_row_per_month=True)) == combined


def test_ticket_edges(spark):
    cutoff = SNAPSHOT - dt.timedelta(days=90)
    rows = [
        ("a", cutoff.isoformat(), "low", 4, 3.0),
        ("a", (cutoff - dt.timedelta(days=1)).isoformat(), "critical", 8, None),
        ("a", SNAPSHOT.isoformat(), "high", 3, 4.0),
        ("a", "2025-04-01", "critical", 100, 1.0),
        ("b", "2025-01-31", "medium", 1, None),
        ("c", "2025-01-31", None, 1, 5.0),
    ]
    got = micro.by_id(P.ticket_features(micro.tickets(spark, rows), SNAPSHOT))
    a = got["a"]
    assert (a["total_tickets"], a["tickets_last_90d"]) == (3, 2)
    assert a["avg_resolution_hours"] == 5.0 and a["avg_csat_score"] == 3.5
    assert a["pct_high_critical_tickets"] == 0.667
    assert (a["days_since_last_ticket"], a["days_since_critical_ticket"]) == (0, 91)
    assert got["b"]["avg_csat_score"] is None and got["b"]["days_since_critical_ticket"] is None
    assert got["c"]["pct_high_critical_tickets"] == 0.0


def test_nps_edges(spark):
    rows = [
        ("one", "2024-06-30", 8),
        ("many", "2024-06-30", 3),
        ("many", "2024-12-31", 9),
        ("many", "2024-09-30", 10),
        ("late", "2025-04-01", 1),
        ("unknown", "2024-06-30", 4),
        ("unknown", "2024-09-30", None),
        ("same", "2024-06-30", 2),
        ("same", "2024-06-30", 7),
    ]
    table = micro.nps(spark, rows)
    got = micro.by_id(P.nps_features(table, SNAPSHOT))
    assert "late" not in got
    assert (got["one"]["last_nps_score"], got["one"]["nps_trend"]) == (8, 0.0)
    assert (got["many"]["last_nps_score"], got["many"]["nps_trend"]) == (9, 6.0)
    assert got["many"]["avg_nps_score"] == 7.33
    # the latest known score; a change to an unknown score stays unknown until it is filled
    assert (got["unknown"]["last_nps_score"], got["unknown"]["nps_trend"]) == (4, None)
    assert got["unknown"]["nps_response_count"] == 2
    assert (got["same"]["last_nps_score"], got["same"]["nps_trend"]) == (7, 5.0)
    assert micro.by_id(P.nps_features(table.orderBy("nps_score"), SNAPSHOT)) == got


def full(spark, accounts, usage=(), tickets=(), nps=()):
    return P.build_features(
        micro.accounts(spark, accounts),
        micro.usage(spark, list(usage)),
        micro.tickets(spark, list(tickets)),
        micro.nps(spark, list(nps)),
        SNAPSHOT,
    )


def test_account_edges_and_defaults(spark):
    rows = [
        dict(account_id="new", contract_start_date=micro.day("2025-05-01")),
        dict(account_id="ended", contract_end_date=micro.day("2025-03-01")),
        dict(account_id="empty", seats_licensed=0, region=None, plan_tier="trial", churned=1),
    ]
    table = full(spark, rows)
    assert table.columns == ["account_id", *feature_names(), "churned"]
    assert len(table.columns) == 32
    got = micro.by_id(table)
    assert got["new"]["tenure_days"] == 0
    assert got["ended"]["days_until_renewal"] == -30
    empty = got["empty"]
    assert empty["mrr_per_seat"] == 100.0 and empty["plan_tier_encoded"] is None
    assert (empty["region_APAC"], empty["region_EMEA"], empty["region_NA"]) == (0, 0, 0)
    assert empty["avg_monthly_logins"] is None and empty["login_trend_pct"] == 0
    assert empty["ticket_velocity_ratio"] is None
    assert (empty["tickets_last_90d"], empty["pct_high_critical_tickets"]) == (0, 0)
    assert (empty["days_since_last_ticket"], empty["days_since_critical_ticket"]) == (999, 999)
    assert (empty["last_nps_score"], empty["nps_trend"], empty["avg_nps_score"]) == (5, 0, 5)
    assert empty["nps_response_count"] == 0
    assert empty["avg_csat_score"] is None and empty["avg_resolution_hours"] is None


def test_csat_fill_is_the_median_of_account_means(spark):
    rows = [dict(account_id=i) for i in ("a", "b", "none", "blank")]
    tickets = [
        ("a", "2025-01-01", "low", 1, 1.0),
        ("a", "2025-01-02", "low", 1, 2.0),
        ("b", "2025-01-01", "low", 1, 4.0),
        ("blank", "2025-01-01", "low", 1, None),
        ("stranger", "2025-01-01", "low", 1, 5.0),
    ]
    got = micro.by_id(full(spark, rows, tickets=tickets))
    assert got["a"]["avg_csat_score"] == 1.5
    assert got["none"]["avg_csat_score"] == got["blank"]["avg_csat_score"] == 2.75


def test_velocity(spark):
    rows = [dict(account_id="a"), dict(account_id="idle")]
    usage = months("a", [1, 1, 1, 1]) + months("idle", [1])
    tickets = [("a", "2025-03-01", "low", 1, None), ("a", "2024-07-01", "low", 1, None)]
    got = micro.by_id(full(spark, rows, usage, tickets))
    assert got["a"]["ticket_velocity_ratio"] == round(1 / ((2 / 4) * 3 + 0.001), 3)
    assert got["idle"]["ticket_velocity_ratio"] == 0.0


def test_one_row_per_account(spark):
    rows = [dict(account_id=f"A{i}") for i in range(20)]
    usage = [r for i in range(0, 20, 2) for r in months(f"A{i}", [i, i + 1])]
    tickets = [(f"A{i % 7}", "2025-01-01", "high", i, float(1 + i % 5)) for i in range(50)]
    table = full(spark, rows, usage, tickets, [("A1", "2025-01-01", 4)] * 3)
    assert table.count() == 20 and table.select("account_id").distinct().count() == 20


def test_impute(spark):
    rows = [dict(account_id=i) for i in ("a", "b", "c")]
    tickets = [("a", "2025-01-01", "low", 2, 3.0), ("b", "2025-01-01", "low", 5, 3.0)]
    table = full(spark, rows, tickets=tickets)
    fills = P.fit_fills(table)
    assert fills["avg_resolution_hours"] == 3.5
    got = micro.by_id(P.impute(table, fills))
    assert got["c"]["avg_resolution_hours"] == 3.5
    assert all(got["c"][c] == 0 for c in P.ZERO_FILLED)


def test_random_tables_against_direct_computation(spark, many_partitions):
    random.seed(11)
    ids = [f"A{i}" for i in range(25)]
    used = [
        (a, f"2024-{m:02d}-01", random.randrange(0, 30))
        for a in ids
        for m in range(1, 13)
        if random.random() < 0.5
    ]
    got = micro.by_id(P.usage_features(micro.usage(spark, used), SNAPSHOT))
    for account in ids:
        values = [r[2] for r in sorted(used) if r[0] == account]
        if not values:
            assert account not in got
            continue
        expected = 0.0
        if len(values) >= 4 and sum(values[:3]):
            head, tail = np.mean(values[:3]), np.mean(values[-3:])
            expected = float(np.round((tail - head) / head, 4))
        assert got[account]["login_trend_pct"] == expected
        assert got[account]["logins_mom_change"] == (values[-1] - values[-2] if len(values) > 1 else 0)
        assert got[account]["avg_monthly_logins"] == float(np.round(np.mean(values), 4))
