import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline.plans import evaluation as E
from stayline.plans import modeling as M
from stayline.plans import trees as Trees
from stayline.sources.schemas import features_schema, feature_names

NAMES = feature_names()


@pytest.fixture(scope="module")
def planted(spark):
    """400 accounts; two features carry the label, the others are noise, some are NULL."""
    i = F.col("id")
    churned = (i * 37 % 100 < 15).cast("int")
    noise = {n: ((i * (17 + 6 * k)) % (31 + k)).cast("double") for k, n in enumerate(NAMES)}
    noise["days_since_last_ticket"] = 20 + churned * 60 + (i * 13 % 41).cast("double")
    noise["avg_monthly_logins"] = F.when(i % 50 != 0, 90 - churned * 55 + (i * 29 % 37).cast("double"))
    noise["avg_resolution_hours"] = F.when(i % 40 != 0, (i % 24).cast("double"))
    noise["plan_tier_encoded"] = F.when(i % 97 != 0, (i % 3).cast("double"))
    table = spark.range(400).select(
        F.format_string("A%03d", i).alias("account_id"), *[c.alias(n) for n, c in noise.items()], churned.alias("churned")
    )
    assert table.columns == features_schema().names
    return table.repartition(4).cache()


@pytest.fixture(scope="module")
def ready(planted):
    return M.prepare(planted, NAMES)


def test_split_has_exact_quotas(planted, many_partitions):
    split = M.stratified_split(planted)
    counts = {(r["churned"], r["is_test"]): r["count"] for r in split.groupBy("churned", "is_test").count().collect()}
    assert counts == {(0, True): 68, (0, False): 272, (1, True): 12, (1, False): 48}
    again = M.stratified_split(planted.repartition(7))
    ids = lambda df: {r[0] for r in df.where("is_test").select("account_id").collect()}
    assert ids(split) == ids(again)
    assert ids(split) != ids(M.stratified_split(planted, seed=7))


@pytest.mark.parametrize("n0, n1", [(7, 4), (13, 5), (101, 22), (3, 3)])
def test_quotas_use_largest_remainders(spark, n0, n1):
    df = spark.range(n0 + n1).select(F.col("id").alias("account_id"), (F.col("id") < n1).cast("int").alias("churned"))
    quotas = {r["churned"]: r["quota"] for r in M.quotas(M.class_sizes(df, "churned"), "churned").collect()}
    assert sum(quotas.values()) == math.ceil((n0 + n1) * 0.2)
    for label, size in ((0, n0), (1, n1)):
        assert abs(quotas[label] - size * math.ceil((n0 + n1) * 0.2) / (n0 + n1)) < 1


def test_folds_are_even(planted, many_partitions):
    folds = M.stratified_folds(planted.limit(397))
    counts = folds.groupBy("fold").agg(F.count("*").alias("n"), F.sum("churned").alias("p")).collect()
    assert len(counts) == 5
    for column in ("n", "p"):
        sizes = [r[column] for r in counts]
        assert max(sizes) - min(sizes) <= 1


def test_scaler_is_fitted_on_the_training_rows_only(ready):
    scaler = ready.vectors.stages[-1]
    mean = ready.train.agg(F.avg("days_since_last_ticket")).first()[0]
    assert scaler.mean[NAMES.index("days_since_last_ticket")] == pytest.approx(mean)


def test_population_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = M.standardize(df, M.scaling_figures(df, ["a", "b"]), ["a", "b"]).collect()
    assert sorted(tuple(r) for r in scaled) == [(-1.0, 0.0), (1.0, 0.0)]


def test_stored_scaler_is_the_one_that_was_checked(ready, tmp_path):
    figures = M.scaling_figures(ready.train, NAMES)
    want = {r["account_id"]: [r[n] for n in NAMES] for r in M.standardize(ready.everyone, figures, NAMES).select("account_id", *NAMES).collect()}
    M.save_model(ready.vectors, f"{tmp_path}/vectors")
    vectors = M.load_model(f"{tmp_path}/vectors").transform(ready.everyone.drop("raw_features", "features"))
    for df in (ready.everyone, vectors):
        for r in df.select("account_id", vector_to_array("features").alias("x")).collect():
            assert r.x == pytest.approx(want[r.account_id], abs=1e-12)


def test_imputation_learns_from_the_training_rows(planted, ready):
    split = M.stratified_split(planted)
    hours = [r[0] for r in split.where("not is_test").select("avg_resolution_hours").dropna().collect()]
    assert ready.fills["avg_resolution_hours"] == pytest.approx(sorted(hours)[len(hours) // 2], abs=0.51)
    assert ready.everyone.where(" or ".join(f"{c} is null" for c in NAMES)).count() == 0
    assert ready.everyone.count() == 400


def _auc(model, ready):
    held = M.predict(model, ready.test)
    return E.roc_auc(held, "churned", "churn_proba").first()[0]


def test_logistic_matches_a_direct_solution(ready):
    """The penalty is sklearn's: gradient of 0.5 |w|^2 + C * weighted log-loss is zero."""
    import numpy as np

    weighted = M.with_balanced_weight(ready.train)
    model = M.logistic(ready.n_train).fit(weighted)
    assert _auc(model, ready) > 0.9
    coefficients = {r["feature"]: r["coefficient"] for r in M.coefficient_table(model, NAMES).collect()}
    rows = weighted.select(*NAMES, "churned", "weight").toPandas()
    x = rows[NAMES].to_numpy(float)
    spread = x.std(axis=0)
    x = (x - x.mean(axis=0)) / np.where(spread == 0, 1, spread)
    w = np.array([coefficients[n] for n in NAMES])
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    gradient = w + x.T @ (rows["weight"] * (p - rows["churned"])).to_numpy()
    assert np.abs(gradient).max() < 0.05
    assert abs((rows["weight"] * (p - rows["churned"])).sum()) < 0.05


def test_trees_find_the_signal(ready):
    forest = M.forest(numTrees=10, maxDepth=4).fit(M.with_balanced_weight(ready.train))
    assert _auc(forest, ready) > 0.9
    weight = M.positive_weight(ready.train)
    assert weight == round(272 / 48, 2)
    boosted = M.boosted(maxIter=5, maxDepth=3).fit(M.with_positive_weight(ready.train, weight))
    assert _auc(boosted, ready) > 0.9
    top = M.importance_table(forest, NAMES).orderBy(F.desc("importance")).limit(2).collect()
    assert {r["feature"] for r in top} <= {"days_since_last_ticket", "avg_monthly_logins"}


def test_grid_search_refits_the_best(ready):
    train = M.stratified_folds(M.with_balanced_weight(ready.train), k=3)
    tuned = M.grid_search(M.forest(), {"numTrees": [3], "maxDepth": [1, 4]}, train)
    trials = tuned.trials.collect()
    assert [r["trial"] for r in trials] == [0, 1]
    best = max(trials, key=lambda r: r["cv_roc_auc"])
    assert tuned.best["maxDepth"] == int(best["maxDepth"])
    assert tuned.model.getNumTrees == 3


def test_cross_validation(spark, ready):
    train = M.stratified_folds(M.with_balanced_weight(ready.train), k=3)
    held = M.out_of_fold(M.logistic(ready.n_train), train).cache()
    assert held.count() == ready.n_train
    per_fold = M.fold_metrics(held).collect()
    assert len(per_fold) == 3
    summary = {r["metric"]: r for r in M.cv_summary(M.fold_metrics(held)).collect()}
    aucs = [r["roc_auc"] for r in per_fold]
    mean = sum(aucs) / 3
    assert summary["roc_auc"]["mean"] == pytest.approx(mean)
    assert summary["roc_auc"]["std"] == pytest.approx((sum((a - mean) ** 2 for a in aucs) / 3) ** 0.5)
    test = E.model_metrics(held, "churned", "churn_proba", strictly_above=True)
    row = M.comparison_row("Logistic", test, M.cv_summary(M.fold_metrics(held))).first()
    assert row["model"] == "Logistic" and row["cv_roc_auc_mean"] == round(mean, 3)


def test_stored_model_scores_the_same(planted, ready, tmp_path):
    model = M.forest(numTrees=3, maxDepth=3).fit(M.with_balanced_weight(ready.train))
    whole = M.bundle(ready.vectors, model, ready.fills)
    M.save_model(whole, str(tmp_path / "model"))
    loaded = M.load_model(str(tmp_path / "model"))
    scored = lambda m, df: {r[0]: r[1] for r in M.predict(m, df).select("account_id", "churn_proba").collect()}
    # the stored model takes the feature table as it is, NULLs included
    assert scored(loaded, planted) == scored(model, ready.everyone)


def test_strongest_coefficients(spark):
    df = spark.createDataFrame([(f"f{i}", float(i - 2)) for i in range(5)], "feature string, coefficient double")
    assert M.strongest(df, 3).count() == 5
    assert {r["feature"] for r in M.strongest(df, 1).collect()} == {"f0", "f4"}


def test_grids_have_the_full_size():
    assert len(M.param_grid(M.forest(), M.FOREST_GRID)) == 12
    assert len(M.param_grid(M.boosted(), M.BOOST_GRID)) == 24


# --- ensembles as tables -------------------------------------------------------


@pytest.fixture(scope="module")
def weighted(ready):
    train = M.with_positive_weight(ready.train, M.positive_weight(ready.train))
    return M.stratified_folds(train, k=3).select("account_id", "features", "churned", "weight", "fold").checkpoint()


@pytest.fixture(scope="module")
def ensembles(weighted):
    boosted = M.boosted(maxIter=6, maxDepth=3, stepSize=0.1, subsamplingRate=0.8).fit(weighted)
    return {"boosted": boosted, "forest": M.forest(numTrees=7, maxDepth=12).fit(weighted)}


def scored(model, rows):
    return {r.account_id: r.churn_proba for r in M.predict(model, rows).select("account_id", "churn_proba").collect()}


def test_first_rounds_are_a_shorter_fit(weighted, ensembles):
    shorter = Trees.first_rounds(ensembles["boosted"], 4)
    separate = M.boosted(maxIter=4, maxDepth=3, stepSize=0.1, subsamplingRate=0.8).fit(weighted)
    assert shorter.getNumTrees == 4 and scored(shorter, weighted) == scored(separate, weighted)
    assert Trees.first_rounds(separate, 4) is separate


def test_grid_scores_are_those_of_separate_fits(weighted):
    grid = {"maxIter": [2, 5], "maxDepth": [2, 3], "stepSize": [0.3], "subsamplingRate": [0.8]}
    trials = M.grid_search(M.boosted(), grid, weighted).trials.collect()
    judge = BinaryClassificationEvaluator(labelCol="churned", metricName="areaUnderROC", numBins=0)
    rows = Trees.gathered(weighted)
    for r in trials:
        one = M.boosted(maxIter=int(r.maxIter), maxDepth=int(r.maxDepth), stepSize=0.3, subsamplingRate=0.8)
        parts = [judge.evaluate(one.fit(rows.where(f"fold != {k}")).transform(rows.where(f"fold = {k}"))) for k in range(3)]
        assert r.cv_roc_auc == pytest.approx(sum(parts) / 3, abs=1e-12)


def test_kept_nodes_change_no_prediction(weighted, ensembles):
    plain = M.forest(numTrees=7, maxDepth=12, cacheNodeIds=False, maxMemoryInMB=256).fit(weighted)
    assert scored(plain, weighted) == scored(ensembles["forest"], weighted)


@pytest.mark.parametrize("name", ["boosted", "forest"])
def test_importances_from_nodes(ensembles, name):
    model = ensembles[name]
    found = {r.feature: r.importance for r in Trees.importances(Trees.node_table(model), NAMES, name == "forest").collect()}
    assert found == pytest.approx(dict(zip(NAMES, model.featureImportances.toArray())), abs=1e-12)


@pytest.mark.parametrize("name", ["boosted", "forest"])
def test_probabilities_from_nodes(weighted, ensembles, name):
    model = ensembles[name]
    nodes = Trees.node_table(model)
    depth = Trees.depth_of(nodes)
    assert depth == max(t.depth for t in model.trees)
    reached = Trees.leaves(weighted, nodes, model.getNumTrees, depth, "account_id", vector_to_array("features"))
    if name == "forest":
        assert {r.account_id: r.p for r in Trees.votes(reached, "account_id").collect()} == pytest.approx(scored(model, weighted), abs=1e-12)
        return
    found = Trees.margins(reached, "account_id", [3, 6]).collect()
    for k in (3, 6):
        assert {r.account_id: r[f"p_{k}"] for r in found} == pytest.approx(scored(Trees.first_rounds(model, k), weighted), abs=1e-12)


def test_a_tree_without_splits(weighted):
    same = weighted.withColumn("churned", F.lit(1))
    nodes = Trees.node_table(M.forest(numTrees=2, maxDepth=3).fit(same))
    assert Trees.depth_of(nodes) == 0
    assert {r.importance for r in Trees.importances(nodes, NAMES, True).collect()} == {0.0}
