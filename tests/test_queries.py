import collections
import itertools
import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import connect, difference  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from stayline.checks import models  # noqa: E402
from stayline.checks.shared import account_figures  # noqa: E402
from stayline.plans import modeling  # noqa: E402
from stayline.sources.warehouse import Warehouse  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()
# Fits take a while; the modelling tests cover them.
OPERATORS = {n for n in QUERIES if n == "pipeline" or n.startswith("op")}
FITTED = {n for n in QUERIES if n not in SQL} - OPERATORS


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(autouse=True)
def small_fits(monkeypatch):
    """What SQL says of fitted models holds for any settings."""
    monkeypatch.setattr(models, "FOREST", {"numTrees": 6, "maxDepth": 9, "minInstancesPerNode": 1})
    monkeypatch.setattr(models, "BOOSTED", {"maxIter": 5, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.8})


def test_grids_are_those_of_the_sql(con):
    rows = con.execute(SQL["i9_grid_search"]).df()
    for name, grid in (("Random Forest", modeling.FOREST_GRID), ("Boosted Trees", modeling.BOOST_GRID)):
        mine = rows[rows.model == name].sort_values("trial")
        assert list(mine[[*grid]].itertuples(index=False, name=None)) == list(itertools.product(*grid.values()))


@pytest.mark.parametrize("name", sorted(set(SQL) - OPERATORS - {"i9_grid_search"}))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = _plan(df)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert word not in plan
    assert difference(df, con, SQL[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and rows[0]["rank"] >= 1


def test_every_row_of_the_inventory_is_registered():
    wanted = (
        [f"a{i}" for i in (6, 7, 8)]
        + [f"b{i}" for i in range(1, 15)]
        + [f"c{i}" for i in range(1, 11)]
        + [f"d{i}" for i in range(1, 23)]
        + [f"e{i}" for i in range(1, 9)]
        + [f"f{i}" for i in range(1, 29)]
        + [f"g{i}" for i in range(1, 7)]
        + [f"h{i}" for i in range(1, 6)]
        + [f"i{i}" for i in range(1, 23)]
        + [f"j{i}" for i in range(1, 5)]
    )
    present = {n.split("_")[0] for n in QUERIES}
    assert not [w for w in wanted if w not in present]
    assert FITTED == {
        "i6_logistic_regression",
        "i7_random_forest",
        "i8_boosted_trees",
        "i10_cross_validation",
        "i11_predict_everyone",
        "i19_coefficient_table",
        "i20_importance_table",
        "i21_trained_comparison",
        "j2_trained_action_list",
    }


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(QUERIES["d14_days_since_last_ticket"](spark, FOLDER))
    scan = next(part for part in plan.split("\n\n") if "orders.parquet" in part)
    assert "LessThan(o_orderdate" in scan
    assert "o_totalprice" not in scan and "o_orderstatus" not in scan
    plan = _plan(QUERIES["d9_login_trend_pct"](spark, FOLDER))
    scan = next(part for part in plan.split("\n\n") if "lineitem.parquet" in part)
    assert "LessThan(l_shipdate" in scan


def _scans(df):
    """How often the plan reads each table."""
    return collections.Counter(re.findall(r"Location: InMemoryFileIndex \[\S*?/(\w+)\.parquet\]", _plan(df)))


def test_features_pass_over_the_facts_once(spark):
    scans = _scans(account_figures(Warehouse(spark, FOLDER)))
    assert scans["lineitem"] == 1 and scans["orders"] == 2
    # What is left reads the written rows.
    assert not _scans(QUERIES["d22_feature_table"](spark, FOLDER))
    for name in ("d16_csat_median_fill", "e4_median_imputation"):
        assert not _scans(QUERIES[name](spark, FOLDER))
