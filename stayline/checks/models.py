"""Queries for training, evaluation and the business outputs.

SQL can't fit the models. Queries that return what a fitted model says have none; next to them stand queries with SQL
for what must hold of any such fit: slopes are zero, tables of coefficients and nodes give the model's probabilities,
importances are the gains of the nodes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.checks.registry import check
from stayline.checks.shared import SWEEP, comparison, evaluated, feature_table, rival_figures, score_of, scores
from stayline.checks.sql import big, query, rnd
from stayline.functions import scalars as S
from stayline.operators.ordering import attach
from stayline.operators.shapes import best_row, upsert
from stayline.plans import evaluation as E
from stayline.plans import modeling as M
from stayline.plans import scoring, trees
from stayline.session import ensure_checkpoint_dir
from stayline.sources.schemas import feature_names
from stayline.sources.warehouse import REGIONS

# Settings of the single fits: points of M.FOREST_GRID and M.BOOST_GRID with most trees and depth. i9 searches both grids.
FOREST = {"numTrees": 200, "maxDepth": 30, "minInstancesPerNode": 1}
BOOSTED = {"maxIter": 200, "maxDepth": 7, "stepSize": 0.1, "subsamplingRate": 0.8}


def prepared(w) -> M.Prepared:
    return M.prepare(feature_table(w), feature_names(REGIONS))


def fitted_logistic(ready: M.Prepared):
    return M.logistic(ready.n_train).fit(M.with_balanced_weight(ready.train))


def fitted_forest(ready: M.Prepared):
    return M.forest(**FOREST).fit(M.with_balanced_weight(ready.train))


def fitted_boosted(ready: M.Prepared):
    weight = M.positive_weight(ready.train)
    return M.boosted(**BOOSTED).fit(M.with_positive_weight(ready.train, weight))


def _figures_of(model, ready: M.Prepared):
    """Test figures of a fitted model."""
    held = M.predict(model, ready.test)
    return E.model_metrics(held, "churned", "churn_proba", strictly_above=True)


# --- splits, scaling, weights ------------------------------------------------


@check("i1_stratified_split", query(f"SELECT account_id, {big('churned')} AS churned, is_test FROM split"))
def _(w):
    return M.stratified_split(w.labels)


@check(
    "i2_stratified_folds",
    query(
        f"""SELECT account_id, {big('churned')} AS churned,
        CAST((row_number() OVER (ORDER BY churned, md5(account_id || ':43'), account_id) - 1) % 5 AS BIGINT) AS fold
        FROM split WHERE NOT is_test"""
    ),
)
def _(w):
    # The split is fixed once; the folds read it twice.
    ensure_checkpoint_dir(w.spark)
    split = M.stratified_split(w.labels).checkpoint()
    return M.stratified_folds(split.where("not is_test").drop("is_test"))


_SCALED = ("tenure_days", "avg_monthly_logins", "nps_response_count")


@check(
    "i3_standard_scaling",
    query(
        "SELECT f.account_id, "
        + ", ".join(f"{rnd(f'({c} - m_{c}) / s_{c}', 6)} AS {c}" for c in _SCALED)
        + " FROM features f CROSS JOIN (SELECT "
        + ", ".join(f"avg(coalesce({c}, 0)) AS m_{c}, stddev_pop(coalesce({c}, 0)) AS s_{c}" for c in _SCALED)
        + " FROM features f2 JOIN split s ON f2.account_id = s.account_id WHERE NOT is_test) z"
    ).replace("(avg_monthly_logins - m", "(coalesce(avg_monthly_logins, 0) - m").replace(
        "(tenure_days - m", "(coalesce(tenure_days, 0) - m"
    ),
)
def _(w):
    """The vector that the models are fitted on."""
    ready = prepared(w)
    values = vector_to_array("features")
    return ready.everyone.select("account_id", *[S.numpy_round(values[ready.names.index(c)], 6).alias(c) for c in _SCALED])


@check(
    "i4_balanced_weights",
    query(
        f"""SELECT {big('churned')} AS churned, count(*) AS n_class,
        (SELECT count(*) FROM accounts)::DOUBLE / (2 * count(*)) AS class_weight FROM accounts GROUP BY churned"""
    ),
)
def _(w):
    return E.balanced_weights(w.labels, "churned")


@check(
    "i5_positive_weight",
    query(
        f"""SELECT account_id, CASE WHEN churned = 1 THEN
        (SELECT {rnd("count(*) FILTER (churned = 0)::DOUBLE / count(*) FILTER (churned = 1)", 2)} FROM accounts)
        ELSE 1.0::DOUBLE END AS weight FROM accounts"""
    ),
)
def _(w):
    weighted = M.with_positive_weight(w.labels, M.positive_weight(w.labels))
    return weighted.select("account_id", "weight")


# --- fits --------------------------------------------------------------------


def _test_scores(model, ready: M.Prepared):
    return M.predict(model, ready.test).select("account_id", "churned", "churn_proba", "prediction")


@check("i6_logistic_regression")
def _(w):
    ready = prepared(w)
    return _test_scores(fitted_logistic(ready), ready)


def _names_sql() -> str:
    return ", ".join(f"('{name}')" for name in feature_names(REGIONS))


@check(
    "i6_logistic_gradient",
    query(f"SELECT feature, 0.0::DOUBLE AS gradient FROM (VALUES {_names_sql()}, ('intercept')) n(feature) WHERE (SELECT count(*) FROM accounts) > 0"),
)
def _(w):
    """The fit stands where the loss has no slope (to three decimals; one is the weighted mean of a row's pull at most)."""
    ready = prepared(w)
    train = M.with_balanced_weight(ready.train)
    slopes = M.penalised_gradient(fitted_logistic(ready), train, ready.names)
    return slopes.select("feature", (S.numpy_round(F.col("gradient"), 3) + 0.0).alias("gradient"))


@check("i7_random_forest")
def _(w):
    ready = prepared(w)
    return _test_scores(fitted_forest(ready), ready)


@check("i8_boosted_trees")
def _(w):
    ready = prepared(w)
    return _test_scores(fitted_boosted(ready), ready)


_SAME_SQL = query(f"SELECT account_id, {big('churned')} AS churned, true AS same FROM split WHERE is_test")


def _same(found, model, ready: M.Prepared):
    """Whether probabilities (account_id, p) computed by other means are those of the model, per test account."""
    scored = M.predict(model, ready.test).select("account_id", "churned", "churn_proba")
    return scored.join(found, "account_id").select("account_id", "churned", (F.abs(F.col("p") - F.col("churn_proba")) < 1e-9).alias("same"))


def _reached(model, ready: M.Prepared):
    nodes = trees.node_table(model)
    depth = max(tree.depth for tree in model.trees)
    return trees.leaves(ready.test, nodes, model.getNumTrees, depth, "account_id", vector_to_array("features"))


@check("i7_forest_nodes", _SAME_SQL)
def _(w):
    """The stored nodes, gone through level by level, give the forest's probabilities."""
    ready = prepared(w)
    model = fitted_forest(ready)
    return _same(trees.votes(_reached(model, ready), "account_id"), model, ready)


@check("i8_boosted_nodes", _SAME_SQL)
def _(w):
    """The stored nodes, gone through level by level, give the boosted model's probabilities."""
    ready = prepared(w)
    model = fitted_boosted(ready)
    rounds = BOOSTED["maxIter"]
    found = trees.margins(_reached(model, ready), "account_id", [rounds]).withColumnRenamed(f"p_{rounds}", "p")
    return _same(found, model, ready)


_GRID_SQL = f"""SELECT 'Random Forest' AS model, {big('row_number() OVER () - 1')} AS trial, a::DOUBLE AS "numTrees", b::DOUBLE AS "maxDepth",
    c::DOUBLE AS "minInstancesPerNode", NULL::DOUBLE AS "maxIter", NULL::DOUBLE AS "stepSize", NULL::DOUBLE AS "subsamplingRate",
    true AS in_range, true AS winner_is_best
    FROM (SELECT * FROM (VALUES (1, 100), (2, 200)) t(i, a), (VALUES (1, 30), (2, 10), (3, 20)) u(j, b), (VALUES (1, 1), (2, 5)) v(k, c) ORDER BY i, j, k)
    UNION ALL
    SELECT 'Boosted Trees', {big('row_number() OVER () - 1')}, NULL, b::DOUBLE, NULL, a::DOUBLE, c::DOUBLE, d::DOUBLE, true, true
    FROM (SELECT * FROM (VALUES (1, 100), (2, 200)) t(i, a), (VALUES (1, 3), (2, 5), (3, 7)) u(j, b), (VALUES (1, 0.05), (2, 0.1)) v(k, c),
          (VALUES (1, 0.8), (2, 1.0)) x(l, d) ORDER BY i, j, k, l)"""


@check("i9_grid_search", _GRID_SQL)
def _(w):
    """All points of both grids over five folds. AUCs depend on the fits, so the rows say that they are AUCs and that
    the winner has the highest."""
    ready = prepared(w)
    parts = []
    for name, estimator, grid, train in (
        ("Random Forest", M.forest(), M.FOREST_GRID, M.with_balanced_weight(ready.train)),
        ("Boosted Trees", M.boosted(), M.BOOST_GRID, M.with_positive_weight(ready.train, M.positive_weight(ready.train))),
    ):
        tuned = M.grid_search(estimator, grid, M.stratified_folds(train))
        # One row per point.
        top = attach(tuned.trials, tuned.trials.agg(F.max("cv_roc_auc").alias("top")))
        at_top = reduce(Column.__and__, [F.col(k) == F.lit(float(v)) for k, v in tuned.best.items()])
        parts.append(
            top.select(
                F.lit(name).alias("model"),
                "trial",
                *grid,
                F.col("cv_roc_auc").between(0, 1).alias("in_range"),
                (~at_top | (F.col("cv_roc_auc") == F.col("top"))).alias("winner_is_best"),
            )
        )
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def _fold_figures_sql() -> str:
    """Mean and population deviation over folds of the figures of the closed-form score, on the training rows."""
    folds = """(SELECT s.account_id, s.churned AS label, e.score,
        (row_number() OVER (ORDER BY s.churned, md5(s.account_id || ':43'), s.account_id) - 1) % 5 AS fold
        FROM split s JOIN evaluated e ON s.account_id = e.account_id WHERE NOT is_test)"""
    counts = f"""SELECT fold, count(*) FILTER (label = 1 AND score > 0.5) AS tp, count(*) FILTER (label = 0 AND score > 0.5) AS fp,
        count(*) FILTER (label = 1 AND score <= 0.5) AS fn FROM {folds} GROUP BY fold"""
    auc = f"""SELECT fold, (sum(mid) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2e0)
        / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS auc
        FROM (SELECT fold, label, rank() OVER (PARTITION BY fold ORDER BY score) + (count(*) OVER (PARTITION BY fold, score) - 1) / 2e0 AS mid
              FROM {folds}) GROUP BY fold"""
    figures = {"roc_auc": "auc", "f1": "2e0 * tp / (2 * tp + fp + fn)", "precision": "tp::DOUBLE / (tp + fp)", "recall": "tp::DOUBLE / (tp + fn)"}
    rows = [f"SELECT '{n}' AS metric, {rnd(f'avg({v})', 9)} AS mean, {rnd(f'stddev_pop({v})', 9)} AS std FROM fold_figures" for n, v in figures.items()]
    blocks = query("SELECT 1 FROM split JOIN evaluated ON true").rsplit("\n", 1)[0]
    return f"{blocks}, fold_figures AS (SELECT * FROM ({counts}) JOIN ({auc}) USING (fold))\n" + " UNION ALL ".join(rows)


@check("i10_fold_figures", _fold_figures_sql())
def _(w):
    """The figures over folds that cross-validation reports, of a score that SQL can compute."""
    ensure_checkpoint_dir(w.spark)
    split = M.stratified_split(w.labels).checkpoint()
    folds = M.stratified_folds(split.where("not is_test").drop("is_test"))
    summary = M.cv_summary(M.fold_metrics(folds.withColumn("churn_proba", score_of(7919))))
    return summary.select("metric", *[S.numpy_round(F.col(c), 9).alias(c) for c in ("mean", "std")])


@check("i10_cross_validation")
def _(w):
    ready = prepared(w)
    balanced = M.with_balanced_weight(ready.train)
    positive = M.with_positive_weight(ready.train, M.positive_weight(ready.train))
    parts = []
    for name, estimator, train in (
        ("Logistic Regression", M.logistic(ready.n_train), balanced),
        ("Random Forest", M.forest(**FOREST), balanced),
        ("Boosted Trees", M.boosted(**BOOSTED), positive),
    ):
        summary = M.cv_summary(M.fold_metrics(M.out_of_fold(estimator, M.stratified_folds(train))))
        parts.append(summary.select(F.lit(name).alias("model"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("i11_predict_everyone")
def _(w):
    ready = prepared(w)
    scored = M.predict(fitted_logistic(ready), ready.everyone)
    return scored.select("account_id", "churned", "churn_proba", "prediction", "is_test")


@check(
    "i11_prediction_rules",
    query(
        f"""SELECT model, account_id, {big('churned')} AS churned, is_test, true AS in_range, true AS follows FROM split
        CROSS JOIN (VALUES ('Logistic Regression'), ('Random Forest'), ('Boosted Trees')) m(model)"""
    ),
)
def _(w):
    """What holds for the predictions of any fitted model: who is scored, and how the class follows."""
    ready = prepared(w)
    probability = F.col("churn_proba")
    parts = []
    for name, fit in (("Logistic Regression", fitted_logistic), ("Random Forest", fitted_forest), ("Boosted Trees", fitted_boosted)):
        parts.append(
            M.predict(fit(ready), ready.everyone).select(
                F.lit(name).alias("model"),
                "account_id",
                "churned",
                "is_test",
                probability.between(0, 1).alias("in_range"),
                (F.col("prediction") == (probability > 0.5).cast("int")).alias("follows"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- evaluation --------------------------------------------------------------

_COUNTS = """(SELECT count(*) FILTER (label = 0 AND score < 0.5) AS tn, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
    count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 1 AND score >= 0.5) AS tp FROM evaluated)"""


@check("i12_confusion_matrix", query(f"SELECT tn, fp, fn, tp FROM {_COUNTS}"))
def _(w):
    return E.confusion(evaluated(w))


def _report_sql() -> str:
    p0, r0 = "tn::DOUBLE / (tn + fn)", "tn::DOUBLE / (tn + fp)"
    p1, r1 = "tp::DOUBLE / (tp + fp)", "tp::DOUBLE / (tp + fn)"
    f0, f1 = "2e0 * tn / (2 * tn + fn + fp)", "2e0 * tp / (2 * tp + fp + fn)"
    n0, n1, n = "(tn + fp)", "(fn + tp)", "(tn + fp + fn + tp)"

    def row(name, p, r, f, support):
        return (
            f"SELECT '{name}' AS class, {rnd(p, 9)} AS \"precision\", {rnd(r, 9)} AS recall, {rnd(f, 9)} AS f1, "
            f"{big(support)} AS support FROM counts"
        )

    rows = [
        row("Active", p0, r0, f0, n0),
        row("Churned", p1, r1, f1, n1),
        row("accuracy", "NULL", "NULL", f"(tn + tp)::DOUBLE / {n}", n),
        row("macro avg", f"({p0} + {p1}) / 2", f"({r0} + {r1}) / 2", f"({f0} + {f1}) / 2", n),
        row(
            "weighted avg",
            f"({p0} * {n0} + {p1} * {n1}) / {n}",
            f"({r0} * {n0} + {r1} * {n1}) / {n}",
            f"({f0} * {n0} + {f1} * {n1}) / {n}",
            n,
        ),
    ]
    body = " UNION ALL ".join(rows)
    # "counts" is put in front as one more block.
    return query(f"SELECT * FROM evaluated").rsplit("\n", 1)[0] + f", counts AS {_COUNTS}\n{body}"


@check("i13_class_report", _report_sql())
def _(w):
    report = E.class_report(E.confusion(evaluated(w)))
    measures = ("precision", "recall", "f1")
    return report.select("class", "support", *[S.numpy_round(F.col(m), 9).alias(m) for m in measures])


@check(
    "i14_roc_auc",
    query(
        f"""SELECT {rnd("(sum(mid) FILTER (label = 1) - np * (np + 1) / 2e0) / (np * nn)", 12)} AS roc_auc
        FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2e0 AS mid,
              count(*) FILTER (label = 1) OVER () AS np, count(*) FILTER (label = 0) OVER () AS nn FROM evaluated)
        GROUP BY np, nn"""
    ),
)
def _(w):
    return E.roc_auc(evaluated(w)).select(S.numpy_round(F.col("roc_auc"), 12).alias("roc_auc"))


@check(
    "i15_average_precision",
    query(f"SELECT {rnd('sum(pos::DOUBLE / n_pos * tp / (tp + fp))', 12)} AS average_precision FROM curve"),
)
def _(w):
    value = S.numpy_round(F.col("average_precision"), 12)
    return E.average_precision(evaluated(w)).select(value.alias("average_precision"))


@check(
    "i16_roc_curve",
    query(
        """SELECT threshold, fp::DOUBLE / n_neg AS fpr, tp::DOUBLE / n_pos AS tpr FROM curve
        UNION ALL SELECT 'inf'::DOUBLE, 0, 0"""
    ),
)
def _(w):
    return E.roc_curve(evaluated(w))


@check(
    "i17_pr_curve",
    query(
        """SELECT threshold, tp::DOUBLE / (tp + fp) AS "precision", tp::DOUBLE / n_pos AS recall FROM curve
        UNION ALL SELECT NULL, 1, 0"""
    ),
)
def _(w):
    return E.pr_curve(evaluated(w))


@check(
    "i18_f1_by_threshold",
    query(
        """SELECT threshold, "precision", recall, 2 * ("precision" * recall) / ("precision" + recall + 1e-9) AS f1
        FROM (SELECT threshold, tp::DOUBLE / (tp + fp) AS "precision", tp::DOUBLE / n_pos AS recall FROM curve)"""
    ),
)
def _(w):
    return E.f1_by_threshold(evaluated(w))


@check("i19_coefficient_table")
def _(w):
    ready = prepared(w)
    table = M.coefficient_table(fitted_logistic(ready), ready.names)
    return M.strongest(table)


@check("i19_coefficient_margins", _SAME_SQL)
def _(w):
    """The coefficient table and the population-scaled features give the model's probabilities."""
    ready = prepared(w)
    model = fitted_logistic(ready)
    table = M.coefficient_table(model, ready.names)
    found = M.margins_from_table(ready.test, table, float(model.intercept), M.scaling_figures(ready.train, ready.names), ready.names)
    return _same(found, model, ready)


#: How many features the importance tables of the two ensembles name.
STRONGEST = {"Random Forest": 15, "Boosted Trees": 5}


@check("i20_importance_table")
def _(w):
    ready = prepared(w)
    parts = []
    for name, fit in (("Random Forest", fitted_forest), ("Boosted Trees", fitted_boosted)):
        table = M.importance_table(fit(ready), ready.names)
        parts.append(table.orderBy(F.desc("importance"), "feature").limit(STRONGEST[name]).select(F.lit(name).alias("model"), "*"))
    return parts[0].unionByName(parts[1])


@check(
    "i20_importances_from_nodes",
    query(
        f"""SELECT model, feature, true AS same FROM (VALUES {_names_sql()}) n(feature)
        CROSS JOIN (VALUES ('Random Forest'), ('Boosted Trees')) m(model) WHERE (SELECT count(*) FROM accounts) > 0"""
    ),
)
def _(w):
    """The weighted gains of the stored nodes add up to the importances that the models report."""
    ready = prepared(w)
    parts = []
    for name, fit in (("Random Forest", fitted_forest), ("Boosted Trees", fitted_boosted)):
        model = fit(ready)
        reported = M.importance_table(model, ready.names)
        found = trees.importances(trees.node_table(model), ready.names, per_tree=name == "Random Forest")
        both = reported.join(found.withColumnRenamed("importance", "summed"), "feature")
        parts.append(both.select(F.lit(name).alias("model"), "feature", (F.abs(F.col("importance") - F.col("summed")) < 1e-9).alias("same")))
    return parts[0].unionByName(parts[1])


@check(
    "i21_model_comparison",
    query(
        """SELECT model, roc_auc, f1, "precision", recall,
        model = (SELECT model FROM rival_figures ORDER BY f1 DESC, position LIMIT 1) AS is_best FROM rival_figures"""
    ),
)
def _(w):
    figures = rival_figures(w)
    table = upsert(figures.where("model != 'gamma'"), figures.where("model = 'gamma'"), "model")
    winner = best_row(figures, "f1", "position", "model").select("model").scalar()
    return table.withColumn("is_best", F.col("model") == winner).drop("position")


@check(
    "i21_comparison_rows",
    query(
        """SELECT model, roc_auc, average_precision, f1, "precision", recall, cv_roc_auc_mean, cv_roc_auc_std,
        f1 = (SELECT max(f1) FROM comparison) AS is_best FROM comparison"""
    ),
)
def _(w):
    """All seven figures of a comparison row."""
    ensure_checkpoint_dir(w.spark)
    rows = comparison(w).checkpoint()
    return rows.withColumn("is_best", F.col("f1") == rows.agg(F.max("f1").alias("top")).scalar())


@check("i21_trained_comparison")
def _(w):
    ready = prepared(w)
    models = {
        "Logistic Regression": fitted_logistic(ready),
        "Random Forest": fitted_forest(ready),
        "Boosted Trees": fitted_boosted(ready),
    }
    table = None
    for name, model in models.items():
        row = _figures_of(model, ready).select(F.lit(name).alias("model"), "*")
        table = row if table is None else upsert(table, row, "model")
    return table


@check(
    "i22_majority_baseline",
    query("SELECT 1 - sum(churned)::DOUBLE / count(*) AS accuracy, 0.0::DOUBLE AS recall FROM accounts"),
)
def _(w):
    return E.majority_baseline(w.labels, "churned")


# --- business outputs --------------------------------------------------------


@check(
    "j1_score_table",
    query(
        f"""SELECT account_id, churn_proba, {big('churned')} AS churned, company_name, plan_tier,
        CAST(mrr AS DOUBLE) AS mrr, CAST(arr AS DOUBLE) AS arr, csm_assigned, region, industry,
        CAST(contract_end_date AS VARCHAR) AS contract_end_date, risk_tier, arr_at_risk FROM scores"""
    ),
)
def _(w):
    return scores(w)


@check("j2_action_list", query("SELECT * FROM actions"))
def action_list(w):
    return scoring.action_list(scores(w))


@check(
    "j3_threshold_sweep",
    query(
        f"""SELECT t.threshold, count(s.account_id) AS accounts_flagged,
        coalesce(CAST(sum(s.arr) FILTER (s.churned = 1) AS DOUBLE), 0)
        / (SELECT CAST(sum(arr) FILTER (churned = 1) AS DOUBLE) FROM scored) AS arr_coverage
        FROM (VALUES {', '.join(f'({t}::DOUBLE)' for t in SWEEP)}) t(threshold)
        LEFT JOIN scored s ON s.churn_proba >= t.threshold GROUP BY 1"""
    ),
)
def _(w):
    return scoring.threshold_sweep(scores(w))


@check(
    "j4_tier_portfolio",
    query(
        f"""SELECT risk_tier, count(*) AS accounts, sum(arr_at_risk) AS arr_at_risk,
        count(*)::DOUBLE / (SELECT count(*) FROM scores) AS account_share,
        sum(arr_at_risk) / (SELECT sum(arr_at_risk) FROM scores) AS risk_share FROM scores GROUP BY 1"""
    ),
)
def _(w):
    table = scores(w)
    rows = scoring.tier_summary(table)
    total = table.agg(F.count(F.lit(1)).alias("n"), F.sum("arr_at_risk").alias("risk"))
    return rows.select(
        "risk_tier",
        "accounts",
        "arr_at_risk",
        S.ratio(F.col("accounts"), total.select("n").scalar()).alias("account_share"),
        S.ratio(F.col("arr_at_risk"), total.select("risk").scalar()).alias("risk_share"),
    )


@check("j2_trained_action_list")
def _(w):
    """The action list of a model fitted on the feature table."""
    ready = prepared(w)
    scored = M.predict(fitted_boosted(ready), ready.everyone)
    # Ranking reads the scores three times (bounds, sort, join); the trees are gone through once.
    predictions = scored.select("account_id", "churn_proba", "churned").checkpoint()
    return scoring.action_list(scoring.score_table(predictions, w.accounts.drop("churned")))
