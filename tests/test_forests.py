"""Forests in parts: the same trees however they are cut, scored without the driver."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from stayline.plans import binned, forests
from stayline.plans import modeling as M
from stayline.plans import trees as Trees


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    noise = [((i * (37 + 12 * k)) % (101 + k)).cast("double") for k in range(5)]
    y = ((i * 7919 % 1000 < 200) != (noise[0] > 90)).cast("int")
    table = spark.range(900).select(F.format_string("A%04d", i).alias("account_id"), y.alias("churned"), array_to_vector(F.array(*noise)).alias("features"))
    return table.withColumn("weight", F.lit(0.5) + F.col("churned") * 2).repartition(3).checkpoint()


def scored(model, rows):
    return {r.account_id: r.churn_proba for r in M.predict(model, rows).select("account_id", "churn_proba").collect()}


SHAPES = [{"maxDepth": 30}, {"maxDepth": 4, "minInstancesPerNode": 5}]


@pytest.mark.parametrize("shape", SHAPES)
def test_parts_change_nothing(rows, monkeypatch, shape):
    whole = M.forest(numTrees=3, **shape).fit(rows)
    monkeypatch.setattr(forests, "PART_ROWS", 200)
    monkeypatch.setattr(forests, "PAIRS", 4000)
    cut = M.forest(numTrees=3, **shape).fit(rows)
    assert all(len(top.nodes) == 1 for top in whole.tops.values()) and all(len(top.nodes) > 3 for top in cut.tops.values())
    assert scored(cut, rows) == pytest.approx(scored(whole, rows), abs=1e-12)
    if shape["maxDepth"] > 4:
        assert max(t.depth for t in cut.trees) > 8
    assert cut.featureImportances.toArray() == pytest.approx(whole.featureImportances.toArray(), abs=1e-12)
    assert [t.depth for t in cut.trees] == [t.depth for t in whole.trees]
    nodes = Trees.node_table(cut).checkpoint()
    assert nodes.count() == Trees.node_table(whole).count()
    reached = Trees.leaves(rows, nodes, 3, Trees.depth_of(nodes), "account_id", vector_to_array("features"))
    assert {r.account_id: r.p for r in Trees.votes(reached, "account_id").collect()} == pytest.approx(scored(cut, rows), abs=1e-12)


def test_a_tree_is_grown_to_the_end(rows):
    """Rows in a leaf of an unlimited tree can't be split further, unless its children said the same."""
    nodes = Trees.node_table(M.forest(numTrees=4, maxDepth=30).fit(rows)).toPandas()
    leaves = nodes[nodes.left.isna()]
    assert (nodes[nodes.node == 0].rows.sub(900).abs() < 150).all()
    assert leaves.groupby("tree").rows.sum().tolist() == nodes[nodes.node == 0].sort_values("tree").rows.tolist()
    assert leaves.positive.isin([0, 1]).mean() > 0.5 and nodes.gain.dropna().gt(0).all()


def test_first_trees_are_a_smaller_fit(rows):
    many, few = M.forest(numTrees=5, maxDepth=8).fit(rows), M.forest(numTrees=3, maxDepth=8).fit(rows)
    assert scored(many.first_trees(3), rows) == scored(few, rows)
    assert many.first_trees(3).featureImportances == few.featureImportances


def test_stored_forest_in_parts(rows, monkeypatch, tmp_path):
    monkeypatch.setattr(forests, "PART_ROWS", 300)
    model = M.forest(numTrees=3, maxDepth=12).fit(rows)
    model.write().save(f"{tmp_path}/forest")
    loaded = forests.ForestModel.load(f"{tmp_path}/forest")
    assert scored(loaded, rows) == scored(model, rows) and loaded.featureImportances == model.featureImportances


def test_rows_that_repeat_and_equal_features(spark, rows):
    same = rows.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    model = M.forest(numTrees=3, maxDepth=5).fit(same)
    assert [t.depth for t in model.trees] == [0, 0, 0] and not np.any(model.featureImportances.toArray())
    assert M.predict(model, same.unionByName(same)).count() == 1800
    assert M.predict(model, same.limit(0)).count() == 0


def test_grid_of_trees_shares_fits(rows, monkeypatch):
    fits, whole = [], forests.fit_forest
    monkeypatch.setattr(forests, "fit_forest", lambda e, df: fits.append(e.getNumTrees()) or whole(e, df))
    folded = rows.withColumn("fold", (F.crc32("account_id") % 2).cast("int"))
    tuned = M.grid_search(M.forest(), {"numTrees": [1, 3], "maxDepth": [3]}, folded)
    assert tuned.trials.count() == 2 and fits == [3, 3, tuned.best["numTrees"]]


def test_rows_are_sent_to_tasks_not_from_level_to_level(rows, monkeypatch):
    """Each level of all trees used to be a join over (tree, node) that moved all rows with all their values."""
    monkeypatch.setattr(Trees, "HELD_NODES", 50)
    model = M.forest(numTrees=6, maxDepth=20).fit(rows)
    two = rows.where("account_id in ('A0000', 'A0001')")
    odd = rows.union(two.select(F.nullif("account_id", F.lit("A0000")), "churned", F.when(F.lit(False), F.col("features")), "weight"))
    nodes = Trees.node_table(model).checkpoint()
    found = Trees.leaves(odd, nodes, 6, Trees.depth_of(nodes), "account_id", F.when(F.col("features").isNotNull(), vector_to_array(F.coalesce("features", array_to_vector(F.array(F.lit(0.0)))))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert found.count() == 6 * 902 and found.where("account_id is null").count() == 6
    usual = found.groupBy("account_id").agg(F.count("*").alias("n"), F.avg("positive").alias("p")).where("n = 6 and account_id is not null")
    scores = scored(model, rows)
    assert {r.account_id: r.p for r in usual.collect()} == pytest.approx({k: v for k, v in scores.items() if k != "A0001"}, abs=1e-12)


@pytest.mark.parametrize("part_rows", [1 << 17, 100])
def test_first_levels_are_a_fit_of_less_depth(rows, monkeypatch, part_rows):
    monkeypatch.setattr(forests, "PART_ROWS", part_rows)
    deep = M.forest(numTrees=3, maxDepth=30).fit(rows)
    for depth in (2, 7):
        flat, cut = M.forest(numTrees=3, maxDepth=depth).fit(rows), deep.first_levels(depth)
        assert scored(cut, rows) == scored(flat, rows) and [t.depth for t in cut.trees] == [t.depth for t in flat.trees]
        assert cut.featureImportances.toArray() == pytest.approx(flat.featureImportances.toArray(), abs=1e-12)
        assert Trees.node_table(cut).count() == Trees.node_table(flat).count()


def test_grid_of_depths_shares_fits_and_bins(rows, monkeypatch):
    """Each depth used to be a fit of its own, and each fit binned its rows anew."""
    fits, bins, whole, cut = [], [], forests.fit_forest, binned.cut_points
    monkeypatch.setattr(forests, "fit_forest", lambda e, df: fits.append((e.getNumTrees(), e.getMaxDepth())) or whole(e, df))
    monkeypatch.setattr(binned, "cut_points", lambda *a: bins.append(a) or cut(*a))
    folded = rows.withColumn("fold", (F.crc32("account_id") % 2).cast("int"))
    grid = {"numTrees": [2, 3], "maxDepth": [9, 3], "minInstancesPerNode": [1, 5]}
    tuned = M.grid_search(M.forest(), grid, folded)
    assert fits[:-1] == [(3, 9)] * 4 and len(bins) == 3
    one = M.grid_search(M.forest(), {k: [v[-1]] for k, v in grid.items()}, folded)
    assert one.trials.first().cv_roc_auc == tuned.trials.orderBy("trial").collect()[-1].cv_roc_auc
