"""The three jobs: build the feature table, train and compare models, score and act.

    python -m stayline build --raw RAW --out OUT --snapshot 2025-03-31
    python -m stayline train --out OUT
    python -m stayline act   --raw RAW --out OUT
    python -m stayline describe --raw RAW --out OUT

Jobs hand over through tables under OUT, so each can be run again by itself. What a job checkpoints on the way is
deleted when it ends.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.scalars import category_position
from stayline.operators.profile import null_counts, profile
from stayline.operators.shapes import best_row
from stayline.plans import eda, evaluation, modeling, scoring
from stayline.plans.features import build_features
from stayline.session import leaves_results_only
from stayline.sources.metric_store import read_metrics, upsert_metrics
from stayline.sources.schemas import ACCOUNTS, REGIONS, feature_names, features_schema
from stayline.sources.tables import read_raw, read_table, write_table

# Model names of the comparison table.
LOGISTIC, FOREST, BOOSTED = "Logistic Regression", "Random Forest", "Boosted Trees"
MODELS = (LOGISTIC, FOREST, BOOSTED)


@leaves_results_only
def build(
    spark: SparkSession,
    raw: str,
    out: str,
    snapshot: dt.date,
    format: str = "csv",
    regions: Sequence[str] = REGIONS,
) -> DataFrame:
    """Raw tables to ``OUT/churn_features`` (Parquet)."""
    tables = read_raw(spark, raw, format)
    features = build_features(
        tables["accounts"],
        tables["usage_metrics"],
        tables["support_tickets"],
        tables["nps_surveys"],
        snapshot,
        regions,
    )
    schema = features_schema(regions)
    typed = features.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    write_table(typed, f"{out}/churn_features")
    return read_features(spark, out, regions)


def read_features(spark: SparkSession, out: str, regions: Sequence[str] = REGIONS) -> DataFrame:
    return read_table(spark, f"{out}/churn_features", features_schema(regions), "parquet")


@leaves_results_only
def train(
    spark: SparkSession,
    out: str,
    regions: Sequence[str] = REGIONS,
    forest_grid: dict[str, list] = modeling.FOREST_GRID,
    boost_grid: dict[str, list] = modeling.BOOST_GRID,
    folds: int = modeling.FOLDS,
    fit_on: str = "train",
    parallelism: int = 8,
) -> DataFrame:
    """Fit, tune and evaluate the three models; store them and their figures.

    Returns the comparison table. Every model leaves ``models/NAME``, its ROC and
    precision-recall curves, and its coefficients or importances.
    """
    ready = modeling.prepare(read_features(spark, out, regions), feature_names(regions), fit_on=fit_on)
    folded = modeling.stratified_folds(ready.train, k=folds).checkpoint()
    balanced = modeling.with_balanced_weight(folded).checkpoint()
    weighed_on = ready.train if fit_on == "train" else ready.everyone
    weighted = modeling.with_positive_weight(folded, modeling.positive_weight(weighed_on))

    plain = modeling.logistic(ready.n_train)
    # The first model starts the comparison anew.
    _keep(spark, out, LOGISTIC, plain, plain.fit(balanced), balanced, ready, parallelism, reset=True)
    tuned = modeling.grid_search(modeling.forest(), forest_grid, balanced, parallelism=parallelism)
    best = modeling.forest(**tuned.best)
    _keep(spark, out, FOREST, best, tuned.model, balanced, ready, parallelism, tuned.trials)
    tuned = modeling.grid_search(modeling.boosted(), boost_grid, weighted, parallelism=parallelism)
    best = modeling.boosted(**tuned.best)
    _keep(spark, out, BOOSTED, best, tuned.model, weighted, ready, parallelism, tuned.trials)
    return read_metrics(spark, f"{out}/model_comparison")


def _keep(spark, out, name, estimator, model, rows, ready, parallelism, trials=None, reset=False) -> None:
    """Store a fitted model with its test figures, curves and feature table."""
    place = f"{out}/models/{slug(name)}"
    modeling.save_model(modeling.bundle(ready.vectors, model, ready.fills), f"{place}/model")
    held = modeling.predict(model, ready.test).select("churned", "churn_proba", "prediction").checkpoint()
    scored = dict(label="churned", score="churn_proba")
    summary = modeling.cv_summary(modeling.fold_metrics(modeling.out_of_fold(estimator, rows, parallelism=parallelism)))
    figures = evaluation.model_metrics(held, **scored, strictly_above=True)
    upsert_metrics(spark, f"{out}/model_comparison", modeling.comparison_row(name, figures, summary), reset)
    counts = evaluation.confusion_of(held, "churned", "prediction")
    tables = {
        "confusion": counts,
        "report": evaluation.class_report(counts),
        "roc_curve": evaluation.roc_curve(held, **scored),
        "pr_curve": evaluation.pr_curve(held, **scored),
        "features": (
            modeling.coefficient_table(model, ready.names)
            if name == LOGISTIC
            else modeling.importance_table(model, ready.names)
        ),
    }
    if trials is not None:
        tables["trials"] = trials
    for table, df in tables.items():
        write_table(df, f"{place}/{table}")


def slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def winner(comparison: DataFrame) -> DataFrame:
    """The model with the best F1; on a tie the one that was trained first."""
    place = F.coalesce(category_position(F.col("model"), MODELS), F.lit(len(MODELS)))
    return best_row(comparison.withColumn("position", place), "f1", "position", "model")


@leaves_results_only
def act(
    spark: SparkSession,
    raw: str,
    out: str,
    model: str = BOOSTED,
    format: str = "csv",
    regions: Sequence[str] = REGIONS,
    exclude_churned: bool = False,
) -> dict[str, DataFrame]:
    """Score every account with a stored model and write the business tables."""
    stored = modeling.load_model(f"{out}/models/{slug(model)}/model")
    scored = modeling.predict(stored, read_features(spark, out, regions))
    accounts = read_table(spark, f"{raw}/accounts.{format}", ACCOUNTS, format).drop("churned")
    predictions = scored.select("account_id", "churn_proba", "churned")
    write_table(scoring.score_table(predictions, accounts, exclude_churned), f"{out}/scores")
    scores = spark.read.parquet(f"{out}/scores")
    write_table(scoring.action_list(scores), f"{out}/cs_action_list", "csv")
    # Quality is measured on every account and on probabilities that aren't rounded.
    evaluated = dict(label="churned", score="churn_proba")
    tables = {
        "tier_summary": scoring.tier_summary(scores),
        "portfolio_summary": scoring.portfolio_summary(scores),
        "threshold_sweep": scoring.threshold_sweep(scores),
        "f1_by_threshold": evaluation.f1_by_threshold(predictions, **evaluated),
        "ranking_quality": evaluation.ranking_quality(predictions, **evaluated),
    }
    for name, df in tables.items():
        write_table(df, f"{out}/{name}")
    return {"scores": scores, **{n: spark.read.parquet(f"{out}/{n}") for n in tables}}


@leaves_results_only
def describe(
    spark: SparkSession, raw: str, out: str, format: str = "csv", quarters: Sequence[str] | None = None
) -> None:
    """Write every descriptive breakdown as a small table; all quarters unless some are listed."""
    t = read_raw(spark, raw, format)
    accounts, usage = t["accounts"], t["usage_metrics"]
    tickets, nps = t["support_tickets"], t["nps_surveys"]
    tables = {
        "accounts_profile": profile(
            accounts,
            ["mrr", "arr", "seats_licensed", "employee_count", "renewal_months", "churned"],
            ["account_id", "company_name", "plan_tier", "industry", "region", "csm_assigned"],
            ["contract_start_date", "contract_end_date", "churn_date"],
        ),
        "accounts_nulls": null_counts(accounts),
        "churn_overview": eda.churn_overview(accounts),
        "churn_by_tier": eda.churn_by_tier(accounts),
        "churn_by_region": eda.churn_by_region(accounts),
        "churn_by_industry": eda.churn_by_industry(accounts),
        "churn_by_api": eda.churn_by_api(accounts, usage),
        "median_mrr_by_tier": eda.median_mrr_by_tier(accounts),
        "median_mrr": eda.median_mrr(accounts),
        "mrr_histogram": eda.mrr_histogram(accounts),
        "arr_lost": eda.arr_lost(accounts),
        "logins_by_month": eda.logins_by_month(usage, accounts),
        "adoption_by_label": eda.adoption_by_label(usage, accounts),
        "logins_by_churned": eda.logins_by_churned(usage, accounts),
        "priority_mix": eda.priority_mix(tickets, accounts),
        "priority_share": eda.priority_share(tickets, accounts),
        "support_by_label": eda.support_by_label(tickets, accounts),
        "nps_distribution": eda.nps_distribution(nps, accounts),
        "nps_by_quarter": eda.nps_by_quarter(nps, accounts, quarters),
        "nps_by_churned": eda.nps_by_churned(nps, accounts),
    }
    for name, df in tables.items():
        write_table(df, f"{out}/eda/{name}")
