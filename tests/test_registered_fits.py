"""The registered fits are those of the reference: whole grids, five folds, all three models."""

from types import SimpleNamespace

import pytest

from stayline.checks import CHECKS
from stayline.checks import models as C
from stayline.plans import modeling as M

MODELS = ["Boosted Trees", "Logistic Regression", "Random Forest"]


@pytest.fixture()
def ready(spark, monkeypatch):
    rows = spark.range(60).selectExpr("format_string('A%02d', id) AS account_id", "cast(id % 4 = 0 AS int) AS churned", "0.5D AS features")
    found = SimpleNamespace(train=rows, n_train=60)
    monkeypatch.setattr(C, "prepared", lambda w: found)
    return found


def test_single_fits_are_points_of_the_grids():
    assert C.FOREST.keys() == M.FOREST_GRID.keys() and C.BOOSTED.keys() == M.BOOST_GRID.keys()
    assert all(v in M.FOREST_GRID[k] for k, v in C.FOREST.items())
    assert all(v in M.BOOST_GRID[k] for k, v in C.BOOSTED.items())


def test_search_tries_both_grids_over_five_folds(spark, ready, monkeypatch):
    tried = {}

    def search(estimator, grid, train):
        tried[type(estimator).__name__] = (grid, train.select("fold").distinct().count())
        first = {k: float(v[0]) for k, v in grid.items()}
        columns = ", ".join(f"{k} double" for k in grid)
        return M.Tuned(None, first, spark.createDataFrame([(0, *first.values(), 0.5)], f"trial int, {columns}, cv_roc_auc double"))

    monkeypatch.setattr(M, "grid_search", search)
    rows = CHECKS["i9_grid_search"].build(None).collect()
    assert tried == {"RandomForestClassifier": (M.FOREST_GRID, 5), "GBTClassifier": (M.BOOST_GRID, 5)}
    assert sorted((r.model, r.numTrees, r.maxIter) for r in rows) == [("Boosted Trees", None, 100.0), ("Random Forest", 100.0, None)]


def test_all_three_models_are_cross_validated(spark, ready, monkeypatch):
    used = []

    def held_out(estimator, train):
        used.append((estimator, train.select("fold").distinct().count()))
        return train.selectExpr("account_id", "churned", "fold", "0.3D + 0.4D * churned AS churn_proba", "0 AS prediction")

    monkeypatch.setattr(M, "out_of_fold", held_out)
    rows = CHECKS["i10_cross_validation"].build(None).collect()
    assert [k for _, k in used] == [5, 5, 5]
    forest, boosted = used[1][0], used[2][0]
    assert (forest.getNumTrees(), forest.getMaxDepth(), boosted.getMaxIter(), boosted.getMaxDepth()) == (200, 30, 200, 7)
    assert sorted({r.model for r in rows}) == MODELS and len(rows) == 12
