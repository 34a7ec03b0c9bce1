"""Queries for the feature table, joins and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline.checks.registry import check
from stayline.checks.shared import SWEEP, feature_table, predictions, survey_features, usage_features
from stayline.checks.sql import big, dbl, query
from stayline.functions import scalars as S
from stayline.operators.quantiles import exact_median
from stayline.operators.shapes import on_spine
from stayline.plans import eda
from stayline.plans import features as P
from stayline.plans import scoring
from stayline.session import ensure_checkpoint_dir
from stayline.sources.warehouse import REGIONS, SNAPSHOT


def _accounts(w):
    return P.account_features(w.accounts, SNAPSHOT, REGIONS)


def _usage(w):
    return usage_features(w)


def _tickets(w):
    return P.ticket_features(w.tickets, SNAPSHOT)


def _spread(w, block, fill, columns):
    """A block of figures for every account, absent ones filled."""
    joined = w.account_base.select("account_id").join(block, "account_id", "left")
    return fill(joined).select("account_id", *columns)


# --- one query per feature (or group of like features) -----------------------


def _account_check(name: str, columns: dict[str, str]) -> None:
    items = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())

    @check(name, query(f"SELECT account_id, {items} FROM account_feats"))
    def _(w):
        return _accounts(w).select("account_id", *[F.col(c) for c in columns])


_account_check(
    "d1_pass_through",
    {
        "mrr": dbl("mrr"),
        "arr": dbl("arr"),
        "seats_licensed": big("seats_licensed"),
        "employee_count": big("employee_count"),
    },
)
_account_check("d2_tenure_days", {"tenure_days": big("tenure_days")})
_account_check("d3_days_until_renewal", {"days_until_renewal": big("days_until_renewal")})
_account_check("d4_mrr_per_seat", {"mrr_per_seat": "mrr_per_seat"})
_account_check("d5_plan_tier_encoded", {"plan_tier_encoded": big("plan_tier_encoded")})


@check(
    "d6_region_dummies",
    query("SELECT account_id, " + ", ".join(f'"region_{r}"' for r in REGIONS) + " FROM account_feats"),
)
def _(w):
    return _accounts(w).select("account_id", *[f"region_{r}" for r in REGIONS])


def _block_check(name: str, source: str, block, fill, columns: dict[str, str]) -> None:
    """Oracle: left join of the account list with one block, defaults by coalesce."""
    items = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())

    @check(
        name,
        query(f"SELECT b.account_id, {items} FROM base b LEFT JOIN {source} f ON b.account_id = f.account_id"),
    )
    def _(w):
        return _spread(w, block(w), fill, columns)


_block_check(
    "d7_usage_means",
    "usage_feats",
    _usage,
    P.fill_usage,
    {
        c: c
        for c in (
            "avg_monthly_logins",
            "avg_active_user_ratio",
            "avg_feature_adoption_pct",
            "avg_data_processed_gb",
        )
    },
)
_block_check(
    "d8_usage_totals",
    "usage_feats",
    _usage,
    P.fill_usage,
    {c: c for c in ("total_api_calls", "has_api_integration", "months_observed")},
)
_block_check(
    "d9_login_trend_pct",
    "usage_feats",
    _usage,
    P.fill_usage,
    {"login_trend_pct": "coalesce(login_trend_pct, 0)"},
)
_block_check(
    "d10_logins_mom_change",
    "usage_feats",
    _usage,
    P.fill_usage,
    {"logins_mom_change": "coalesce(logins_mom_change, 0)"},
)
_block_check(
    "d11_ticket_means",
    "ticket_feats",
    _tickets,
    P.fill_tickets,
    {
        "avg_resolution_hours": "avg_resolution_hours",
        "avg_csat_score": "avg_csat_score",
        "total_tickets": "coalesce(total_tickets, 0)",
    },
)
_block_check(
    "d12_pct_high_critical_tickets",
    "ticket_feats",
    _tickets,
    P.fill_tickets,
    {"pct_high_critical_tickets": "coalesce(pct_high_critical_tickets, 0)"},
)
_block_check(
    "d13_tickets_last_90d",
    "ticket_feats",
    _tickets,
    P.fill_tickets,
    {"tickets_last_90d": "coalesce(tickets_last_90d, 0)"},
)
_block_check(
    "d14_days_since_last_ticket",
    "ticket_feats",
    _tickets,
    P.fill_tickets,
    {"days_since_last_ticket": "coalesce(days_since_last_ticket, 999)"},
)
_block_check(
    "d15_days_since_critical_ticket",
    "ticket_feats",
    _tickets,
    P.fill_tickets,
    {"days_since_critical_ticket": "coalesce(days_since_critical_ticket, 999)"},
)


def _ticket_means(w):
    """Mean ticket figures of every account, written once: the medians are taken from them."""
    ensure_checkpoint_dir(w.spark)
    means = _tickets(w).select("account_id", "avg_resolution_hours", "avg_csat_score")
    return w.account_base.select("account_id").join(means, "account_id", "left").checkpoint()


@check(
    "d16_csat_median_fill",
    query(
        """SELECT b.account_id, coalesce(avg_csat_score, (SELECT median(avg_csat_score) FROM ticket_feats
        WHERE account_id IN (SELECT account_id FROM base))) AS avg_csat_score
        FROM base b LEFT JOIN ticket_feats t ON b.account_id = t.account_id"""
    ),
)
def _(w):
    joined = _ticket_means(w)
    return joined.select("account_id", F.coalesce("avg_csat_score", P.csat_median(joined)).alias("avg_csat_score"))


@check("d17_ticket_velocity_ratio", query("SELECT account_id, ticket_velocity_ratio FROM features"))
def _(w):
    return feature_table(w).select("account_id", "ticket_velocity_ratio")


_block_check(
    "d18_last_nps_score",
    "nps_feats",
    survey_features,
    P.fill_nps,
    {"last_nps_score": "coalesce(last_nps_score, 5)"},
)
_block_check("d19_nps_trend", "nps_feats", survey_features, P.fill_nps, {"nps_trend": "coalesce(nps_trend, 0)"})
_block_check(
    "d20_avg_nps_score",
    "nps_feats",
    survey_features,
    P.fill_nps,
    {"avg_nps_score": "coalesce(avg_nps_score, 5)"},
)
_block_check(
    "d21_nps_response_count",
    "nps_feats",
    survey_features,
    P.fill_nps,
    {"nps_response_count": "coalesce(nps_response_count, 0)"},
)


@check("d22_feature_table", query("SELECT * FROM features"))
def _(w):
    return feature_table(w)


# --- joins and imputation ----------------------------------------------------


@check(
    "e1_left_join_blocks",
    query(
        """SELECT account_id, months_observed, avg_monthly_logins, total_tickets, avg_csat_score,
        last_nps_score, avg_nps_score FROM joined"""
    ),
)
def _(w):
    return (
        _accounts(w)
        .join(_usage(w), "account_id", "left")
        .join(_tickets(w), "account_id", "left")
        .join(survey_features(w), "account_id", "left")
        .select(
            "account_id",
            "months_observed",
            "avg_monthly_logins",
            "total_tickets",
            "avg_csat_score",
            "last_nps_score",
            "avg_nps_score",
        )
    )


@check(
    "e2_fact_account_join",
    query(
        """SELECT u.account_id, CAST(u.month AS VARCHAR) AS month, u.logins, l.churn_label
        FROM usage u JOIN labelled l ON u.account_id = l.account_id"""
    ),
)
def _(w):
    labels = eda.with_label(w.labels).select("account_id", "churn_label")
    return w.usage.select("account_id", "month", "logins").join(labels, "account_id")


@check(
    "e3_one_to_one_join",
    query(
        f"""SELECT b.account_id, plan_tier, {big('max(has_api_integration)')} AS has_api FROM base b
        JOIN usage u ON b.account_id = u.account_id GROUP BY 1, 2"""
    ),
)
def _(w):
    flags = w.usage.groupBy("account_id").agg(F.max("has_api_integration").alias("has_api"))
    return w.account_base.select("account_id", "plan_tier").join(flags, "account_id")


@check(
    "e4_median_imputation",
    query(
        """SELECT account_id, coalesce(avg_resolution_hours, (SELECT median(avg_resolution_hours) FROM features))
        AS avg_resolution_hours, avg_csat_score FROM features"""
    ),
)
def _(w):
    joined = _ticket_means(w)
    middle = exact_median(joined, "avg_resolution_hours").scalar()
    return joined.select(
        "account_id",
        F.coalesce("avg_resolution_hours", middle).alias("avg_resolution_hours"),
        F.coalesce("avg_csat_score", P.csat_median(joined)).alias("avg_csat_score"),
    )


@check(
    "e5_zero_imputation",
    query(
        "SELECT account_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in P.ZERO_FILLED) + " FROM features"
    ),
)
def _(w):
    fills = {c: 0.0 for c in P.ZERO_FILLED}
    return P.impute(feature_table(w), fills).select("account_id", *P.ZERO_FILLED)


_STEPS = ", ".join(f"({t}::DOUBLE)" for t in SWEEP)


@check(
    "e6_threshold_join",
    query(
        f"""SELECT t.threshold, count(s.account_id) AS accounts_flagged
        FROM (VALUES {_STEPS}) t(threshold) LEFT JOIN scored s ON s.churn_proba >= t.threshold GROUP BY 1"""
    ),
)
def _(w):
    table = predictions(w).withColumn("arr", F.lit(0))
    return scoring.threshold_sweep(table).select("threshold", "accounts_flagged")


@check(
    "e7_spine_join",
    query(
        """SELECT t.position, t.plan_tier, s.accounts
        FROM (VALUES (0, 'starter'), (1, 'professional'), (2, 'enterprise'), (3, 'trial')) t(position, plan_tier)
        LEFT JOIN (SELECT plan_tier, count(*) AS accounts FROM base GROUP BY 1) s ON s.plan_tier = t.plan_tier"""
    ).replace("t.position,", "CAST(t.position AS BIGINT) AS position,"),
)
def _(w):
    counts = w.account_base.groupBy("plan_tier").agg(F.count(F.lit(1)).alias("accounts"))
    return on_spine(counts, "plan_tier", [*S.PLAN_TIERS, "trial"])


@check(
    "e8_anti_join",
    query("SELECT account_id, company_name FROM base WHERE account_id NOT IN (SELECT account_id FROM nps)"),
)
def _(w):
    # One row per account on the right, combined before the shuffle.
    answered = w.nps.select("account_id").distinct()
    return w.account_base.select("account_id", "company_name").join(answered, "account_id", "left_anti")
