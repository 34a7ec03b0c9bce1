"""Scored accounts, the ranked action list, the threshold sweep and portfolio figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.scalars import (
    ACTION_TIERS,
    RISK_TIERS,
    expected_loss,
    is_one_of,
    numpy_round,
    ratio,
    recommended_action,
    risk_tier,
)
from stayline.operators.ordering import rank_rows
from stayline.operators.shapes import on_spine, spine

DETAILS = (
    "company_name",
    "plan_tier",
    "mrr",
    "arr",
    "csm_assigned",
    "region",
    "industry",
    "contract_end_date",
)
ACTION_COLUMNS = (
    "rank",
    "account_id",
    "company_name",
    "plan_tier",
    "csm_assigned",
    "region",
    "mrr",
    "arr",
    "churn_proba",
    "risk_tier",
    "arr_at_risk",
    "contract_end_date",
    "recommended_action",
)
# 0.10, 0.15 .. 0.85 as numpy's arange gives them: it goes by the rounded difference of the first two values.
_START, _STEP = 0.1, (0.1 + 0.05) - 0.1
THRESHOLDS = tuple(_START + i * _STEP for i in range(16))


def score_table(
    predictions: DataFrame, accounts: DataFrame, exclude_churned: bool = False
) -> DataFrame:
    """Probabilities (``account_id, churn_proba, churned``) with details, tier and loss.

    The probability is rounded first; tier and loss use the rounded one.
    """
    if exclude_churned:
        predictions = predictions.where("churned = 0")
    rounded = predictions.select(
        "account_id", numpy_round(F.col("churn_proba"), 4).alias("churn_proba"), "churned"
    )
    return rounded.join(accounts.select("account_id", *DETAILS), "account_id").withColumns(
        {
            "risk_tier": risk_tier(F.col("churn_proba")),
            "arr_at_risk": expected_loss(F.col("churn_proba"), F.col("arr")),
        }
    )


def action_list(scores: DataFrame) -> DataFrame:
    """Critical and High accounts by expected loss, with what to do; one row per account."""
    flagged = scores.where(is_one_of(F.col("risk_tier"), ACTION_TIERS))
    ranked = rank_rows(flagged, [F.desc("arr_at_risk"), F.asc("account_id")], key="account_id")
    return ranked.withColumn(
        "recommended_action", recommended_action(F.col("risk_tier"), F.col("plan_tier"))
    ).select(*ACTION_COLUMNS)


def threshold_sweep(scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Accounts flagged and churner revenue covered at each threshold, in one pass.

    Every account is counted once, under the number of thresholds it passes; the
    table of those counts has one row per threshold and is summed from the top.
    """
    steps = sorted(thresholds)
    probability = F.col("churn_proba")
    passed = sum(((probability >= t).cast("int") for t in steps), F.lit(0))
    churner_arr = F.when(F.col("churned") == 1, F.col("arr"))
    levels = scores.groupBy(passed.alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(churner_arr).alias("amount")
    )
    grid = spine(scores.sparkSession, "threshold", [float("-inf"), *steps], "level")
    # One row per threshold, so one task is enough for the window.
    downward = Window.orderBy(F.desc("level")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    whole = Window.partitionBy()
    amount = F.coalesce("amount", F.lit(0))
    return (
        grid.join(levels, "level", "left")
        .withColumns(
            {
                "accounts_flagged": F.sum(F.coalesce("n", F.lit(0))).over(downward),
                "caught": F.sum(amount).over(downward),
                "all_arr": F.sum(amount).over(whole),
            }
        )
        .where("level > 0")
        .select(
            "threshold",
            "accounts_flagged",
            F.coalesce(ratio(F.col("caught"), F.col("all_arr")), F.lit(0.0)).alias("arr_coverage"),
        )
    )


def tier_summary(scores: DataFrame) -> DataFrame:
    """Figures per risk tier, in tier order; the mean probability is left unrounded."""
    sums = scores.groupBy("risk_tier").agg(
        F.count("account_id").alias("accounts"),
        F.sum("arr").alias("total_arr"),
        F.sum("arr_at_risk").alias("arr_at_risk"),
        F.avg("churn_proba").alias("avg_churn_proba"),
    )
    largest = Window.partitionBy()
    # Four rows.
    return on_spine(sums, "risk_tier", RISK_TIERS).select(
        "risk_tier",
        "position",
        "accounts",
        numpy_round(F.col("total_arr"), 0).alias("total_arr"),
        "arr_at_risk",
        "avg_churn_proba",
        ratio(F.col("arr_at_risk"), F.max("arr_at_risk").over(largest)).alias("relative_risk"),
    )


def portfolio_summary(scores: DataFrame) -> DataFrame:
    """The whole portfolio in one row and one pass."""
    tier, loss = F.col("risk_tier"), F.col("arr_at_risk")
    acted = is_one_of(tier, ACTION_TIERS)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, loss)), F.lit(0.0))

    return scores.agg(
        F.count(F.lit(1)).alias("total_accounts"),
        F.sum("arr").alias("total_arr"),
        F.count_if(tier == "Critical").alias("critical_accounts"),
        F.count_if(tier == "High").alias("high_accounts"),
        total(acted).alias("arr_at_risk"),
        total(tier == "Critical").alias("critical_arr_at_risk"),
        F.count_if(acted).alias("listed_accounts"),
    )
