"""Boosted trees over binned blocks: Spark's trees, in few jobs, the same however the rows are dealt."""

import pytest
from pyspark.ml.classification import GBTClassifier as SparkBoosted
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayline.plans import boosting
from stayline.plans import modeling as M
from stayline.plans import trees as Trees

SHAPE = {"maxIter": 4, "maxDepth": 4, "stepSize": 0.1}


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    noise = [((i * (37 + 12 * k)) % (23 + k)).cast("double") for k in range(5)]
    y = ((i * 7919 % 1000 < 200) != (noise[0] > 19)).cast("int")
    table = spark.range(2000).select(F.format_string("A%04d", i).alias("account_id"), y.alias("churned"), array_to_vector(F.array(*noise)).alias("features"))
    return table.withColumn("weight", F.lit(0.5) + F.col("churned") * 2).repartition(3).checkpoint()


def scored(model, rows):
    return {r.account_id: r.churn_proba for r in M.predict(model, rows).select("account_id", "churn_proba").collect()}


@pytest.mark.parametrize("least", [1, 40])
def test_trees_are_those_of_spark(rows, least):
    """With all rows in every round and a bin per value nothing is drawn or estimated, so both fits must agree."""
    ours = M.boosted(minInstancesPerNode=least, **SHAPE).fit(rows)
    spark_s = SparkBoosted(labelCol="churned", weightCol="weight", seed=42, minInstancesPerNode=least, **SHAPE).fit(rows)
    assert ours.treeWeights == spark_s.treeWeights and ours.numFeatures == 5
    assert scored(ours, rows) == pytest.approx(scored(spark_s, rows), abs=1e-6)
    figures = lambda m: [(r.tree, round(r.weight, 6), r.rows) for r in Trees.node_table(m).where("node = 0").orderBy("tree").collect()]
    assert figures(ours) == figures(spark_s)


def test_tasks_change_nothing(rows, monkeypatch):
    whole = M.boosted(subsamplingRate=0.8, **SHAPE).fit(rows)
    monkeypatch.setattr(Trees, "ROWS_PER_TASK", 700)
    monkeypatch.setattr(boosting, "_WRITTEN_EVERY", 2)
    dealt = M.boosted(subsamplingRate=0.8, **SHAPE).fit(rows)
    assert scored(dealt, rows) == scored(whole, rows) and dealt.featureImportances == whole.featureImportances
    assert Trees.node_table(dealt).orderBy("tree", "node").collect() == Trees.node_table(whole).orderBy("tree", "node").collect()


def test_jobs_do_not_grow_with_rounds(spark, rows):
    def jobs(rounds):
        group = f"rounds-{rounds}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            M.boosted(maxIter=rounds, maxDepth=5).fit(rows)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs(12) == jobs(2) > 0


def test_jobs_do_not_grow_with_rounds_above_a_task_of_rows(spark, rows, monkeypatch):
    """72,000 rows used to be dealt over two tasks, with a job per level of each tree."""
    monkeypatch.setattr(Trees, "ROWS_PER_TASK", 900)
    test_jobs_do_not_grow_with_rounds(spark, rows)


def test_a_level_per_job_changes_nothing(rows, monkeypatch):
    whole = M.boosted(subsamplingRate=0.8, minInstancesPerNode=3, **SHAPE).fit(rows)
    monkeypatch.setattr(boosting, "ALONE_ROWS", 0)
    monkeypatch.setattr(boosting, "_PASS", 100)
    monkeypatch.setattr(boosting, "_CELLS", 64)
    test_tasks_change_nothing(rows, monkeypatch)
    dealt = M.boosted(subsamplingRate=0.8, minInstancesPerNode=3, **SHAPE).fit(rows)
    assert Trees.node_table(dealt).orderBy("tree", "node").collect() == Trees.node_table(whole).orderBy("tree", "node").collect()


def test_fits_of_a_large_table_are_one_job_each(spark, rows, monkeypatch):
    """720,000 rows used to be dealt over all cores, with a job per level of each tree, also where five fits run side by side."""
    monkeypatch.setattr(Trees, "ROWS_PER_TASK", 2)
    test_jobs_do_not_grow_with_rounds(spark, rows)


def test_tasks_of_a_fit_run_at_once():
    assert [boosting._tasks(n, 12) for n in (72_000, 125_000, 125_001, 720_000, 7_200_000)] == [1, 1, 3, 12, 12]
    assert boosting._tasks(720_000, 1) == 2


def test_equal_features_and_one_class(rows):
    same = rows.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    assert [t.depth for t in M.boosted(maxIter=2, maxDepth=3).fit(same).trees] == [0, 0]
    one = M.boosted(maxIter=3, maxDepth=3).fit(rows.withColumn("churned", F.lit(1)))
    assert [t.depth for t in one.trees] == [0, 0, 0] and min(scored(one, rows).values()) > 0.8


def test_stored_boosted_model(rows, tmp_path):
    model = M.boosted(**SHAPE).fit(rows)
    model.write().save(f"{tmp_path}/boosted")
    loaded = type(model).load(f"{tmp_path}/boosted")
    assert scored(loaded, rows) == scored(model, rows) and loaded.getLabelCol() == "churned"


def test_what_is_not_fitted_is_refused(rows):
    with pytest.raises(ValueError, match="logistic loss"):
        M.boosted(featureSubsetStrategy="sqrt").fit(rows)
