"""Descriptive churn breakdowns.

Facts are reduced to a few rows per account before they meet the accounts, so an
account that owns a large part of a fact table sends no more rows into the join
than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.scalars import (
    PLAN_TIERS,
    URGENT_PRIORITIES,
    category_position,
    churn_label,
    flag,
    is_one_of,
    mean_of,
    numpy_round,
    ratio,
)
from stayline.operators.quantiles import exact_median
from stayline.operators.shapes import equal_width_bin, on_spine, pivot_shares, share_within

# Priorities in column order.
PRIORITIES = ("critical", "high", "low", "medium")
MRR_BINS = 40
NPS_SCORES = tuple(range(11))


def with_label(accounts: DataFrame) -> DataFrame:
    return accounts.withColumn("churn_label", churn_label(F.col("churned")))


def _labels(accounts: DataFrame) -> DataFrame:
    return with_label(accounts).select("account_id", "churned", "churn_label")


def churn_overview(accounts: DataFrame) -> DataFrame:
    """Accounts and share per label."""
    counts = with_label(accounts).groupBy("churn_label").agg(F.count(F.lit(1)).alias("accounts"))
    # Two rows: one per label.
    return share_within(counts, "accounts", [], "share")


def churn_rate(accounts: DataFrame) -> DataFrame:
    return accounts.agg(mean_of(F.col("churned")).alias("churn_rate"))


def churn_rate_by(accounts: DataFrame, column: str) -> DataFrame:
    return accounts.groupBy(column).agg(
        F.count("churned").alias("accounts"), mean_of(F.col("churned")).alias("churn_rate")
    )


def churn_by_tier(accounts: DataFrame, tiers: Sequence[str] = PLAN_TIERS) -> DataFrame:
    return on_spine(churn_rate_by(accounts, "plan_tier"), "plan_tier", tiers)


def churn_by_region(accounts: DataFrame) -> DataFrame:
    return churn_rate_by(accounts, "region").select("region", "churn_rate")


def churn_by_industry(accounts: DataFrame) -> DataFrame:
    return churn_rate_by(accounts, "industry").orderBy("churn_rate", "industry")


def churn_by_api(accounts: DataFrame, usage: DataFrame) -> DataFrame:
    """Churn of accounts with and without an integration; accounts without usage drop out."""
    flags = usage.groupBy("account_id").agg(F.max("has_api_integration").alias("has_api"))
    joined = accounts.select("account_id", "churned").join(flags, "account_id")
    named = F.when(F.col("has_api") == 1, "Has API").otherwise("No API")
    return (
        churn_rate_by(joined, "has_api")
        .where(F.col("has_api").isNotNull())
        .select(
            named.alias("integration"),
            "accounts",
            numpy_round(F.col("churn_rate"), 3).alias("churn_rate"),
        )
    )


def median_mrr_by_tier(accounts: DataFrame, tiers: Sequence[str] = PLAN_TIERS) -> DataFrame:
    medians = exact_median(with_label(accounts), "mrr", ["plan_tier", "churn_label"], "median_mrr")
    return medians.withColumn("tier_position", category_position(F.col("plan_tier"), tiers)).orderBy(
        "tier_position", "churn_label"
    )


def median_mrr(accounts: DataFrame) -> DataFrame:
    return exact_median(with_label(accounts), "mrr", ["churn_label"], "median_mrr")


def arr_lost(accounts: DataFrame) -> DataFrame:
    lost = F.sum(F.when(F.col("churned") == 1, F.col("arr")))
    sums = accounts.agg(F.sum("arr").alias("total_arr"), F.coalesce(lost, F.lit(0)).alias("lost_arr"))
    return sums.withColumn("lost_share", ratio(F.col("lost_arr"), F.col("total_arr")))


def mrr_histogram(accounts: DataFrame, bins: int = MRR_BINS) -> DataFrame:
    """Equal-width bins over each label's own range; empty bins count 0."""
    money = with_label(accounts).select("churn_label", F.col("mrr").cast("double").alias("mrr")).dropna()
    # One row per label; a single value widens the range by a half on either side.
    spans = money.groupBy("churn_label").agg(F.min("mrr").alias("lo"), F.max("mrr").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    spans = spans.select(
        "churn_label",
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("low"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("high"),
    )
    placed = money.join(F.broadcast(spans), "churn_label").groupBy(
        "churn_label",
        equal_width_bin(F.col("mrr"), F.col("low"), F.col("high"), bins).alias("bin"),
    )
    counts = placed.agg(F.count(F.lit(1)).alias("n"))
    grid = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    step = (F.col("high") - F.col("low")) / bins
    return grid.join(counts, ["churn_label", "bin"], "left").select(
        "churn_label",
        "bin",
        (F.col("low") + F.col("bin") * step).alias("bin_from"),
        F.coalesce("n", F.lit(0)).alias("accounts"),
    )


def _label_means(per_account: DataFrame, accounts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row-weighted means from per-account sums (``total``, ``n``)."""
    return (
        per_account.join(_labels(accounts), "account_id")
        .groupBy(*keys)
        .agg(ratio(F.sum("total"), F.sum("n")).alias("mean_value"))
    )


def _account_sums(facts: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return facts.groupBy("account_id", *keys).agg(
        F.sum(value).alias("total"), F.count(value).alias("n")
    )


def logins_by_month(usage: DataFrame, accounts: DataFrame) -> DataFrame:
    # A row per account and month would be grouped into as many groups, held twice per task; rows of an account that owns
    # many are split by the join.
    rows = usage.select("account_id", "month", F.col("logins").alias("total"), F.col("logins").isNotNull().cast("int").alias("n"))
    means = _label_means(rows, accounts, ["month", "churn_label"])
    return means.withColumnRenamed("mean_value", "avg_logins")


def adoption_by_label(usage: DataFrame, accounts: DataFrame) -> DataFrame:
    means = _label_means(_account_sums(usage, "feature_adoption_pct"), accounts, ["churn_label"])
    return means.withColumnRenamed("mean_value", "avg_feature_adoption")


def logins_by_churned(usage: DataFrame, accounts: DataFrame) -> DataFrame:
    means = _label_means(_account_sums(usage, "logins"), accounts, ["churned"])
    return means.select("churned", numpy_round(F.col("mean_value"), 1).alias("avg_logins"))


def nps_by_churned(nps: DataFrame, accounts: DataFrame) -> DataFrame:
    means = _label_means(_account_sums(nps, "nps_score"), accounts, ["churned"])
    return means.select("churned", numpy_round(F.col("mean_value"), 2).alias("avg_nps"))


def nps_by_quarter(nps: DataFrame, accounts: DataFrame, quarters: Sequence[str] | None = None) -> DataFrame:
    """Mean score per quarter; the quarter is the stored text.

    Every quarter that occurs, by year and then by name; with a list, those of the
    list that occur, in list order. ``position`` counts from 0.
    """
    if quarters is None:
        listed = nps
        # A row per quarter and label.
        place = F.dense_rank().over(Window.orderBy(F.substring_index("quarter", "_", -1), "quarter")) - 1
    else:
        listed = nps.where(F.col("quarter").isin(list(quarters)))
        place = category_position(F.col("quarter"), quarters)
    sums = _account_sums(listed, "nps_score", ["quarter"])
    means = _label_means(sums, accounts, ["quarter", "churn_label"])
    return means.select(
        place.alias("position"),
        "quarter",
        "churn_label",
        F.col("mean_value").alias("avg_nps"),
    )


def nps_distribution(nps: DataFrame, accounts: DataFrame) -> DataFrame:
    """Answers per score 0..10 and label; scores nobody gave count 0."""
    per_account = nps.groupBy("account_id", "nps_score").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        per_account.join(_labels(accounts), "account_id")
        .groupBy("nps_score")
        .pivot("churn_label", ["Active", "Churned"])
        .agg(F.sum("n"))
    )
    full = on_spine(counts, "nps_score", NPS_SCORES).na.fill(0, ["Active", "Churned"])
    return full.select("nps_score", F.col("Active").alias("active"), F.col("Churned").alias("churned"))


def _priority_counts(tickets: DataFrame, accounts: DataFrame) -> DataFrame:
    per_account = tickets.groupBy("account_id", "priority").agg(F.count("ticket_id").alias("n"))
    return (
        per_account.join(_labels(accounts), "account_id")
        .groupBy("churn_label", "priority")
        .agg(F.sum("n").alias("tickets"))
    )


def priority_share(tickets: DataFrame, accounts: DataFrame) -> DataFrame:
    """Share of each priority within a label, long form."""
    return share_within(_priority_counts(tickets, accounts), "tickets", ["churn_label"], "share")


def priority_mix(tickets: DataFrame, accounts: DataFrame) -> DataFrame:
    """Priority percentages per label, one column per priority; others that occur follow the usual ones."""
    return pivot_shares(
        _priority_counts(tickets, accounts), "churn_label", "priority", "tickets", PRIORITIES
    )


def ticket_profile(tickets: DataFrame) -> DataFrame:
    """Unrounded ticket figures per account over the whole history."""
    urgent = flag(is_one_of(F.col("priority"), URGENT_PRIORITIES))
    return tickets.groupBy("account_id").agg(
        F.count("ticket_id").alias("total_tickets"),
        mean_of(F.col("resolution_hours")).alias("avg_resolution_h"),
        mean_of(F.col("csat_score")).alias("avg_csat"),
        mean_of(urgent).alias("pct_high_crit"),
    )


def support_by_label(tickets: DataFrame, accounts: DataFrame) -> DataFrame:
    """Means of per-account means: every account counts once, whatever its ticket count."""
    return (
        ticket_profile(tickets)
        .join(_labels(accounts), "account_id")
        .groupBy("churn_label")
        .agg(
            F.avg("avg_csat").alias("avg_csat"),
            (F.avg("pct_high_crit") * 100).alias("pct_high_critical"),
        )
    )
