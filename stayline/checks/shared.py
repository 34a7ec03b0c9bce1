"""Inputs the queries share: closed-form scores in place of a trained model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.scalars import numpy_round
from stayline.plans import features as P
from stayline.plans import modeling as M
from stayline.plans.evaluation import model_metrics
from stayline.plans.scoring import score_table
from stayline.session import ensure_checkpoint_dir
from stayline.sources.warehouse import REGIONS, SNAPSHOT, Warehouse

# The thresholds of the sweep, written out so that SQL doesn't take them from the code under test.
SWEEP = (
    "0.1, 0.15000000000000002, 0.20000000000000004, 0.25000000000000006, 0.30000000000000004, 0.3500000000000001, 0.40000000000000013, 0.45000000000000007, "
    "0.5000000000000001, 0.5500000000000002, 0.6000000000000002, 0.6500000000000001, 0.7000000000000002, 0.7500000000000002, 0.8000000000000002, 0.8500000000000002"
).split(", ")

RIVALS = {"alpha": 7919, "beta": 6271, "gamma": 4523}


def score_of(multiplier: int) -> Column:
    """A fixed pattern of the account number with four decimals."""
    return ((F.col("account_id") * multiplier) % 10000).cast("double") / 10000.0


def predictions(w: Warehouse) -> DataFrame:
    return w.labels.withColumn("churn_proba", score_of(7919))


def scores(w: Warehouse) -> DataFrame:
    """The score table. Label and details come from the same accounts view."""
    return score_table(predictions(w), w.accounts.drop("churned"))


def evaluated(w: Warehouse) -> DataFrame:
    return w.labels.select("account_id", F.col("churned").alias("label"), score_of(7919).alias("score"))


def rivals(w: Warehouse) -> DataFrame:
    """Label and score per account under three scores, one pass over the accounts."""
    each = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.lit(place).alias("position"), score_of(m).alias("score"))
            for place, (name, m) in enumerate(RIVALS.items(), start=1)
        ]
    )
    return w.labels.select(F.col("churned").alias("label"), F.explode(each).alias("rival")).select(
        "label", "rival.*"
    )


def rival_figures(w: Warehouse) -> DataFrame:
    figures = model_metrics(rivals(w), by=["model", "position"])
    names = ("roc_auc", "f1", "precision", "recall")
    return figures.select("model", "position", *[numpy_round(F.col(c), 3).alias(c) for c in names])


def comparison(w: Warehouse) -> DataFrame:
    """The comparison table of the three closed-form scores: test figures over all accounts, folds over the training rows."""
    ensure_checkpoint_dir(w.spark)
    split = M.stratified_split(w.labels).checkpoint()
    folds = M.stratified_folds(split.where("not is_test").drop("is_test")).checkpoint()
    rows = []
    for name, multiplier in RIVALS.items():
        figures = model_metrics(split.withColumn("p", score_of(multiplier)), "churned", "p", strictly_above=True)
        summary = M.cv_summary(M.fold_metrics(folds.withColumn("churn_proba", score_of(multiplier))))
        rows.append(M.comparison_row(name, figures, summary))
    return reduce(DataFrame.unionByName, rows)


def account_figures(w: Warehouse) -> DataFrame:
    """Accounts with all figures that features are made of, one pass over each fact table.

    Tickets and contract span come from one grouping of the orders, usage and survey from one join of lines and orders:
    a month of an account keeps the state of its survey answers next to its usage.
    """
    asked, day, score = w.survey()
    months = w.usage_until(SNAPSHOT, P.survey_state(asked & (day <= F.lit(SNAPSHOT)), day, score))
    used = P.usage_features(months, SNAPSHOT, one_row_per_month=True, carried=P.SURVEY_STATE, more=P.survey_figures())
    tickets = P.ticket_figures(SNAPSHOT)
    accounts = w.accounts_with(w.order_figures(tickets))
    return P.account_features(accounts, SNAPSHOT, REGIONS, carried=list(tickets)).join(used, "account_id", "left")


def feature_table(w: Warehouse) -> DataFrame:
    return P.finished(account_figures(w), REGIONS)


def usage_features(w: Warehouse) -> DataFrame:
    """The usage view is grouped by account and month."""
    return P.usage_features(w.usage_until(SNAPSHOT), SNAPSHOT, one_row_per_month=True)


def survey_features(w: Warehouse) -> DataFrame:
    return P.nps_features(w.nps, SNAPSHOT)
