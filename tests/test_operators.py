import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import ordering, profile, quantiles, shapes


@pytest.fixture(params=[False, True], ids=["one block", "many blocks"])
def blocks(request):
    if request.param:
        request.getfixturevalue("many_partitions")
    return request.param


def test_rank_with_heavy_ties(spark, blocks):
    random.seed(1)
    # a third of all rows share one value
    rows = [(i, 7.0 if i % 3 == 0 else float(random.randrange(20))) for i in range(600)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "id int, v double").repartition(6)
    ranked = ordering.rank_rows(df, [F.desc("v"), F.asc("id")])
    got = {r["id"]: r["rank"] for r in ranked.collect()}
    expected = {r[0]: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1)}
    assert got == expected


def test_rank_of_keys_alone(spark, blocks):
    rows = [(i, float(i % 4), "x" * i) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, v double, wide string").repartition(6)
    ranked = ordering.rank_rows(df, [F.desc("v"), F.asc("id")], key="id")
    expected = {r[0]: (i, r[2]) for i, r in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), start=1)}
    assert {r["id"]: (r["rank"], r["wide"]) for r in ranked.collect()} == expected
    written = ordering.sorted_blocks(df, [F.desc("v"), F.asc("id")], "id")
    assert written.columns == ["id", "_block", "_place"]


def test_running_totals_by_group(spark, blocks):
    random.seed(2)
    rows = [(random.choice("aab"), i, random.randrange(10)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, n int").repartition(5)
    got = {
        r["o"]: r["upto"] for r in ordering.running_totals(df, [F.desc("o")], {"upto": "n"}, ["g"]).collect()
    }
    for group in "ab":
        total = 0
        for _, o, n in sorted((r for r in rows if r[0] == group), key=lambda r: -r[1]):
            total += n
            assert got[o] == total


def test_running_totals_without_groups(spark, blocks):
    df = spark.range(1, 301).withColumnRenamed("id", "o")
    got = ordering.running_totals(df, ["o"], {"upto": "o"}).collect()
    assert all(r["upto"] == r["o"] * (r["o"] + 1) // 2 for r in got) and len(got) == 300


@pytest.mark.parametrize("size", [1, 2, 3, 10, 11, 250])
def test_quantiles_match_numpy(spark, size, blocks):
    generator = np.random.default_rng(size)
    values = np.round(generator.random(size) * 40, 1).tolist()
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    wanted = {"a": 0.0, "q1": 0.25, "m": 0.5, "q3": 0.75, "z": 1.0}
    row = quantiles.exact_quantiles(df, "v", wanted).first()
    for name, p in wanted.items():
        assert row[name] == pytest.approx(np.quantile(values, p))


def test_median_by_group_skips_nulls(spark, blocks):
    rows = [("x", 1.0), ("x", 2.0), ("x", None), ("y", 5.0), (None, 9.0), ("y", 5.0), ("z", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["median"] for r in quantiles.exact_median(df, "v", ["g"]).collect()}
    assert got == {"x": 1.5, "y": 5.0}


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_median(df, "v").first()["median"] is None


def test_spine_keeps_order_and_absent_categories(spark):
    df = spark.createDataFrame([("b", 2), ("c", 3)], "k string, n int")
    rows = [tuple(r) for r in shapes.on_spine(df, "k", ["a", "b"]).orderBy("position").select("k", "n").collect()]
    assert rows == [("a", None), ("b", 2)]


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "model string, v int")
    new = spark.createDataFrame([("b", 9), ("c", 3)], "model string, v int")
    got = {tuple(r) for r in shapes.upsert(old, new, "model").collect()}
    assert got == {("a", 1), ("b", 9), ("c", 3)}


def test_best_row_takes_the_first_on_ties(spark):
    df = spark.createDataFrame([("x", 1, 0.5), ("y", 2, 0.9), ("z", 3, 0.9)], "model string, p int, f1 double")
    assert shapes.best_row(df, "f1", "p", "model").first()["model"] == "y"


def test_bins_match_numpy(spark):
    generator = np.random.default_rng(4)
    values = np.round(generator.random(2000) * 97.3, 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    low, high = float(values.min()), float(values.max())
    counted = (
        df.groupBy(shapes.equal_width_bin(F.col("v"), F.lit(low), F.lit(high), 40).alias("b")).count().collect()
    )
    expected, _ = np.histogram(values, bins=40)
    assert {r["b"]: r["count"] for r in counted} == {i: int(n) for i, n in enumerate(expected) if n}


def test_pivot_shares(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 3), ("y", "b", 2)], "l string, p string, n int")
    got = {r["l"]: (r["a"], r["b"], r["c"]) for r in shapes.pivot_shares(df, "l", "p", "n", ["a", "b", "c"]).collect()}
    assert got == {"x": (25.0, 75.0, 0.0), "y": (0.0, 100.0, 0.0)}


def test_profile_and_nulls(spark, blocks):
    rows = [(1, "x", None), (2, "y", None), (2, "y", None), (None, "x", None), (9, None, None)]
    df = spark.createDataFrame(rows, "n int, c string, e double")
    got = {r["column_name"]: r.asDict() for r in profile.profile(df, ["n", "e"], ["c"]).collect()}
    assert got["e"]["non_null"] == got["e"]["n_distinct"] == 0 and got["e"]["q50"] is None
    numbers = [1, 2, 2, 9]
    assert got["n"]["non_null"] == 4 and got["n"]["n_distinct"] == 3 and got["n"]["top_frequency"] == 2
    assert got["n"]["q50"] == 2.0 and got["n"]["q75"] == np.quantile(numbers, 0.75)
    assert got["n"]["std"] == pytest.approx(np.std(numbers, ddof=1))
    assert got["c"]["top_value"] == "x" and got["c"]["n_distinct"] == 2 and got["c"]["mean"] is None
    assert {tuple(r) for r in profile.null_counts(df).collect()} == {("n", 1), ("c", 1), ("e", 5)}
    assert tuple(profile.shape(df).first()) == (5, 3)
