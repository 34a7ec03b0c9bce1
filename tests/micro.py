"""Hand-made raw tables, one account per edge case. The snapshot is 2025-03-31."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from stayline.sources.schemas import ACCOUNTS, NPS_SURVEYS, SUPPORT_TICKETS, USAGE_METRICS

SNAPSHOT = dt.date(2025, 3, 31)


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def accounts(spark, rows):
    """rows: dicts with what differs from a plain account."""
    plain = dict(
        company_name="C",
        plan_tier="starter",
        mrr=Decimal("100.00"),
        arr=Decimal("1200.00"),
        seats_licensed=4,
        employee_count=10,
        contract_start_date=day("2024-04-01"),
        contract_end_date=day("2025-04-30"),
        renewal_months=12,
        industry="Fintech",
        region="NA",
        csm_assigned="S",
        churned=0,
        churn_date=None,
    )
    data = [tuple({**plain, **r}[f.name] for f in ACCOUNTS) for r in rows]
    return spark.createDataFrame(data, ACCOUNTS)


def usage(spark, rows):
    """rows: (account, month, logins[, other columns as dict])."""
    data = []
    for account, month, logins, *more in rows:
        row = dict(
            account_id=account,
            month=day(month),
            logins=logins,
            active_users=1,
            seats_licensed=1,
            active_user_ratio=Decimal("0.5"),
            features_used=1,
            total_features=2,
            feature_adoption_pct=Decimal("0.25"),
            data_processed_gb=Decimal("1.5"),
            api_calls=10,
            has_api_integration=0,
        )
        row.update(more[0] if more else {})
        data.append(tuple(row[f.name] for f in USAGE_METRICS))
    return spark.createDataFrame(data, USAGE_METRICS)


def tickets(spark, rows):
    """rows: (account, date, priority, hours, csat)."""
    data = [
        (f"T{i}", account, day(date), "Billing", priority, hours, csat)
        for i, (account, date, priority, hours, csat) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SUPPORT_TICKETS)


def nps(spark, rows):
    """rows: (account, date, score)."""
    data = [(account, day(date), "Q1_2024", score, "Admin") for account, date, score in rows]
    return spark.createDataFrame(data, NPS_SURVEYS)


def by_id(df):
    return {r["account_id"]: r.asDict() for r in df.collect()}
