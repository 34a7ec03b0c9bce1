"""The per-account feature table at a snapshot date.

Each fact table is aggregated to one row per account and the results are left
joined on ``account_id``; all of them are hash-partitioned by that key already.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.scalars import (
    clip_lower,
    days_between,
    flag,
    is_one_of,
    mean_of,
    numpy_round,
    one_hot,
    plan_tier_code,
    ratio,
    URGENT_PRIORITIES,
)
from stayline.operators.quantiles import exact_median
from stayline.session import ensure_checkpoint_dir
from stayline.sources.schemas import REGIONS, feature_names

# What stands in for an absent fact.
NO_TICKET_DAYS = 999
NEUTRAL_NPS = 5
# Columns set to zero before modelling.
ZERO_FILLED = (
    "avg_monthly_logins",
    "avg_active_user_ratio",
    "avg_feature_adoption_pct",
    "avg_data_processed_gb",
    "total_api_calls",
    "has_api_integration",
    "ticket_velocity_ratio",
)
MEDIAN_FILLED = "avg_resolution_hours"
HELPERS = (
    "contract_start_date",
    "contract_end_date",
    "renewal_months",
    "industry",
    "plan_tier",
    "region",
    "months_observed",
    "total_tickets",
)


def account_features(
    accounts: DataFrame, snapshot: dt.date, regions: Sequence[str] = REGIONS, carried: Sequence[str] = ()
) -> DataFrame:
    """Account columns with tenure, renewal, price per seat, tier code and region dummies."""
    today = F.lit(snapshot)
    kept = accounts.select(
        "account_id",
        "churned",
        "plan_tier",
        "mrr",
        "arr",
        "seats_licensed",
        "employee_count",
        "industry",
        "region",
        "contract_start_date",
        "contract_end_date",
        "renewal_months",
        *carried,
    )
    return kept.withColumns(
        {
            "tenure_days": clip_lower(days_between(today, F.col("contract_start_date")), 0),
            "days_until_renewal": days_between(F.col("contract_end_date"), today),
            "mrr_per_seat": numpy_round(ratio(F.col("mrr"), clip_lower(F.col("seats_licensed"), 1)), 2),
            "plan_tier_encoded": plan_tier_code(F.col("plan_tier")),
            **one_hot(F.col("region"), regions, "region"),
        }
    )


def _by_month(usage: DataFrame, columns: Sequence[str], one_row_per_month: bool, carried: Sequence[str]) -> DataFrame:
    """Rows, sums and known values per account and month.

    A table that has one row per account and month already needs no shuffle for it.
    """
    if one_row_per_month:
        return usage.select(
            *carried,
            "account_id",
            "month",
            F.lit(1).cast("bigint").alias("rows"),
            "api_calls",
            "has_api_integration",
            *[F.col(c).alias(f"sum_{c}") for c in columns],
            *[flag(F.col(c).isNotNull()).alias(f"n_{c}") for c in columns],
        )
    return usage.groupBy("account_id", "month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("api_calls").alias("api_calls"),
        F.max("has_api_integration").alias("has_api_integration"),
        *[F.sum(c).alias(f"sum_{c}") for c in columns],
        *[F.count(c).alias(f"n_{c}") for c in columns],
    )


def usage_features(
    usage: DataFrame,
    snapshot: dt.date,
    one_row_per_month: bool = False,
    carried: Sequence[str] = (),
    more: dict[str, Column] | None = None,
) -> DataFrame:
    """Means, totals, login trend and last monthly change per account.

    Rows are first combined per account and month. After that an account has at most
    one row per calendar month, so the ordered step by account stays small even for
    an account that owns a third of the table. Rows that share a month are
    interchangeable: where "the last three rows" cuts through a month, the month's
    mean stands for each of its rows. ``one_row_per_month`` skips the combining; set
    it only where the table is known to be at that grain, as a grouped view is. Such a
    table may carry other columns, and ``more`` aggregates them in the same grouping.
    """
    more = more or {}
    if carried and not one_row_per_month:
        raise ValueError("columns can be carried along by one row per month only")
    means = {
        "avg_monthly_logins": "logins",
        "avg_active_user_ratio": "active_user_ratio",
        "avg_feature_adoption_pct": "feature_adoption_pct",
        "avg_data_processed_gb": "data_processed_gb",
    }
    seen = usage.where(F.col("month") <= F.lit(snapshot))
    monthly = _by_month(seen, list(means.values()), one_row_per_month, carried)
    account = Window.partitionBy("account_id")
    so_far = account.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = monthly.withColumns(
        {"seen": F.sum("rows").over(so_far), "total": F.sum("rows").over(account)}
    )
    earlier = F.col("seen") - F.col("rows")
    later = F.col("total") - F.col("seen")

    def rows_taken(passed: Column, wanted: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("rows"), F.lit(wanted) - passed))

    def part(taken: Column, amount: str) -> Column:
        return F.sum(taken * ratio(F.col(amount), F.col("rows")))

    first, last = rows_taken(earlier, 3), rows_taken(later, 3)
    last_two, newest = rows_taken(later, 2), rows_taken(later, 1)
    grouped = ordered.groupBy("account_id").agg(
        *[
            numpy_round(ratio(F.sum(f"sum_{c}"), F.sum(f"n_{c}")), 4).alias(name)
            for name, c in means.items()
        ],
        F.coalesce(F.sum("api_calls"), F.lit(0)).alias("total_api_calls"),
        F.max("has_api_integration").alias("has_api_integration"),
        F.sum("rows").alias("months_observed"),
        ratio(part(first, "sum_logins"), part(first, "n_logins")).alias("first_mean"),
        ratio(part(last, "sum_logins"), part(last, "n_logins")).alias("last_mean"),
        part(last_two, "sum_logins").alias("two_sum"),
        part(last_two, "n_logins").alias("two_known"),
        part(newest, "sum_logins").alias("newest_sum"),
        *[column.alias(name) for name, column in more.items()],
    )
    trend = F.when(
        (F.col("months_observed") < 4) | (F.col("first_mean") == 0), F.lit(0.0)
    ).otherwise(numpy_round(ratio(F.col("last_mean") - F.col("first_mean"), F.col("first_mean")), 4))
    change = F.when(F.col("months_observed") < 2, F.lit(0.0)).when(
        F.col("two_known") == 2, 2 * F.col("newest_sum") - F.col("two_sum")
    )
    return grouped.select(
        "account_id",
        *means,
        "total_api_calls",
        "has_api_integration",
        "months_observed",
        F.coalesce(trend, F.lit(0.0)).alias("login_trend_pct"),
        F.coalesce(change, F.lit(0.0)).alias("logins_mom_change"),
        *more,
    )


def ticket_figures(snapshot: dt.date, recent_days: int = 90) -> dict[str, Column]:
    """Aggregates of the tickets created up to the snapshot; the conditions sit inside, so the
    same grouping can look at later rows for something else."""
    today = F.lit(snapshot)
    created = F.when(F.col("created_date") <= today, F.col("created_date"))

    def seen(value: Column) -> Column:
        return F.when(created.isNotNull(), value)

    urgent = flag(is_one_of(F.col("priority"), URGENT_PRIORITIES))
    return {
        "total_tickets": F.count(seen(F.col("ticket_id"))),
        "avg_resolution_hours": numpy_round(mean_of(seen(F.col("resolution_hours"))), 3),
        "avg_csat_score": numpy_round(mean_of(seen(F.col("csat_score"))), 3),
        "pct_high_critical_tickets": numpy_round(mean_of(seen(urgent)), 3),
        "tickets_last_90d": F.count_if(created >= F.date_sub(today, recent_days)),
        "days_since_last_ticket": days_between(today, F.max(created)),
        "days_since_critical_ticket": days_between(today, F.max(F.when(F.col("priority") == "critical", created))),
    }


def ticket_features(tickets: DataFrame, snapshot: dt.date, recent_days: int = 90) -> DataFrame:
    """All ticket figures in one grouping."""
    figures = ticket_figures(snapshot, recent_days)
    seen = tickets.where(F.col("created_date") <= F.lit(snapshot))
    return seen.groupBy("account_id").agg(*[column.alias(name) for name, column in figures.items()])


def nps_features(nps: DataFrame, snapshot: dt.date) -> DataFrame:
    """Latest score, change from the first to the latest answer, mean and count.

    Answers are ordered by date and, within a day, by score, which leaves no tie that
    could change a result. The order is one whole number (scores go from 0 to 10), so
    ``max_by`` and ``min_by`` run as hash aggregates: one answer per account and task,
    and no account's answers have to be sorted.
    """
    score = F.col("nps_score")
    place = F.unix_date("survey_date").cast("bigint") * 100 + F.coalesce(score, F.lit(-1))
    answers = F.count(F.lit(1))
    change = F.max_by(score, place) - F.min_by(score, place)
    return (
        nps.where(F.col("survey_date") <= F.lit(snapshot))
        .groupBy("account_id")
        .agg(
            F.max_by(score, F.when(score.isNotNull(), place)).alias("last_nps_score"),
            F.when(answers < 2, F.lit(0)).otherwise(change).cast("double").alias("nps_trend"),
            numpy_round(mean_of(score), 2).alias("avg_nps_score"),
            answers.alias("nps_response_count"),
        )
    )


# What a month has to keep of its survey answers so that months can be put together.
SURVEY_STATE = ("answers", "scores_known", "score_sum", "last_known", "first_answer", "last_answer")


def survey_state(asked: Column, day: Column, score: Column) -> dict[str, Column]:
    """Aggregates over the answers among any rows; ``asked`` says which rows are answers."""
    place = F.unix_date(day).cast("bigint") * 100 + F.coalesce(score, F.lit(-1))
    answer = F.when(asked, F.struct(place.alias("place"), score.alias("score")))
    known = F.when(asked & score.isNotNull(), F.struct(place.alias("place"), score.alias("score")))
    return {
        "answers": F.count(answer),
        "scores_known": F.count(F.when(asked, score)),
        "score_sum": F.sum(F.when(asked, score)),
        "last_known": F.max(known),
        "first_answer": F.min(answer),
        "last_answer": F.max(answer),
    }


def survey_figures() -> dict[str, Column]:
    """The survey features from the states of an account's months; NULL where nobody answered."""
    answers = F.sum("answers")
    some = answers > 0
    change = F.max("last_answer")["score"] - F.min("first_answer")["score"]
    return {
        "last_nps_score": F.max("last_known")["score"],
        "nps_trend": F.when(some, F.when(answers < 2, F.lit(0)).otherwise(change).cast("double")),
        "avg_nps_score": numpy_round(ratio(F.sum("score_sum"), F.sum("scores_known")), 2),
        "nps_response_count": F.when(some, answers),
    }


def ticket_velocity(recent: Column, total: Column, months: Column) -> Column:
    """Recent tickets against what three average months would bring."""
    monthly = total.cast("double") / clip_lower(months, 1).cast("double")
    return numpy_round(recent.cast("double") / (monthly * 3 + F.lit(0.001)), 3)


def fill_usage(df: DataFrame) -> DataFrame:
    return df.na.fill({"login_trend_pct": 0.0, "logins_mom_change": 0.0})


def fill_tickets(df: DataFrame) -> DataFrame:
    return df.na.fill(
        {
            "total_tickets": 0,
            "tickets_last_90d": 0,
            "pct_high_critical_tickets": 0.0,
            "days_since_last_ticket": NO_TICKET_DAYS,
            "days_since_critical_ticket": NO_TICKET_DAYS,
        }
    )


def fill_nps(df: DataFrame) -> DataFrame:
    return df.na.fill(
        {
            "last_nps_score": NEUTRAL_NPS,
            "nps_trend": 0.0,
            "avg_nps_score": float(NEUTRAL_NPS),
            "nps_response_count": 0,
        }
    )


def csat_median(figures: DataFrame) -> Column:
    """Median over accounts of their mean score, as a scalar subquery.

    The means are scores from 1 to 5 with three decimals: at most 4,001 distinct
    values, which is what the built-in exact median keeps.
    """
    return figures.agg(F.median("avg_csat_score").alias("middle")).scalar()


def build_features(
    accounts: DataFrame,
    usage: DataFrame,
    tickets: DataFrame,
    nps: DataFrame,
    snapshot: dt.date,
    regions: Sequence[str] = REGIONS,
    one_usage_row_per_month: bool = False,
) -> DataFrame:
    """One row per account: id, features in fixed order, label.

    Features without a fact to rest on stay NULL where the definition gives no
    default; ``impute`` fills them before modelling.
    """
    joined = (
        account_features(accounts, snapshot, regions)
        .join(usage_features(usage, snapshot, one_usage_row_per_month), "account_id", "left")
        .join(ticket_features(tickets, snapshot), "account_id", "left")
        .join(nps_features(nps, snapshot), "account_id", "left")
    )
    return finished(joined, regions)


def finished(joined: DataFrame, regions: Sequence[str] = REGIONS) -> DataFrame:
    """Defaults, the median score and the ticket velocity for accounts with all their figures.

    The rows (one per account) are written once: the median is taken from what was
    joined, so no fact table is read again for it.
    """
    ensure_checkpoint_dir(joined.sparkSession)
    written = joined.checkpoint()
    filled = fill_nps(fill_tickets(fill_usage(written))).withColumns(
        {
            "avg_csat_score": F.coalesce("avg_csat_score", csat_median(written)),
            "ticket_velocity_ratio": ticket_velocity(
                F.col("tickets_last_90d"), F.col("total_tickets"), F.col("months_observed")
            ),
        }
    )
    return filled.drop(*HELPERS).select("account_id", *feature_names(regions), "churned")


def fit_fills(features: DataFrame) -> dict[str, float]:
    """Replacement values learnt from a table: zeros, and one median (a single number)."""
    middle = exact_median(features, MEDIAN_FILLED).first()
    fills = {name: 0.0 for name in ZERO_FILLED}
    if middle is not None and middle["median"] is not None:
        fills[MEDIAN_FILLED] = middle["median"]
    return fills


def impute(features: DataFrame, fills: dict[str, float]) -> DataFrame:
    return features.na.fill(fills)
