import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.functions import scalars as S


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


@pytest.mark.parametrize("digits", [0, 2, 3, 4])
def test_rounding_is_numpys(spark, digits):
    generator = np.random.default_rng(3)
    values = [*(generator.random(500) * 100).tolist(), 0.5, 1.5, 2.5, -2.5, 1.005, 2.675, 0.00005, 0.12345, 1e9 + 0.5]
    values += [k / 8 for k in range(-40, 40)] + [k / 1000 for k in range(0, 400, 7)]
    got = column(spark, values, "double", lambda v: S.numpy_round(v, digits))
    assert got == [float(np.round(v, digits)) for v in values]


def test_clip_keeps_null(spark):
    assert column(spark, [None, -3, 0, 1, 7], "int", lambda v: S.clip_lower(v, 1)) == [None, 1, 1, 1, 7]


def test_ratio_guards_zero(spark):
    assert column(spark, [0, 4, None], "int", lambda v: S.ratio(F.lit(2), v)) == [None, 0.5, None]


def test_membership_and_flags_treat_null_as_no(spark):
    values = ["high", "low", None, "critical"]
    assert column(spark, values, "string", lambda v: S.is_one_of(v, S.URGENT_PRIORITIES)) == [True, False, False, True]
    assert column(spark, values, "string", lambda v: S.flag(v == "high")) == [1, 0, 0, 0]


def test_lookups(spark):
    tiers = ["starter", "professional", "enterprise", "trial", None]
    assert column(spark, tiers, "string", S.plan_tier_code) == [0, 1, 2, None, None]
    assert column(spark, [0, 1, 2, None], "int", S.churn_label) == ["Active", "Churned", None, None]
    assert column(spark, tiers, "string", lambda v: S.category_position(v, S.PLAN_TIERS)) == [0, 1, 2, None, None]


def test_one_hot_is_alphabetical_and_null_sets_none(spark):
    df = spark.createDataFrame([("NA",), ("APAC",), (None,)], "region string")
    flags = S.one_hot(F.col("region"), ["NA", "EMEA", "APAC"], "region")
    assert list(flags) == ["region_APAC", "region_EMEA", "region_NA"]
    rows = [tuple(r) for r in df.select(*flags.values()).collect()]
    assert rows == [(0, 0, 1), (1, 0, 0), (0, 0, 0)]


def test_an_unlisted_category_is_an_error(spark):
    df = spark.createDataFrame([("NA",), ("LATAM",)], "region string")
    with pytest.raises(Exception, match="not among the listed ones: LATAM"):
        df.select(*S.one_hot(F.col("region"), ["NA", "EMEA"], "region").values()).collect()


def test_risk_bands_have_inclusive_lower_bounds(spark):
    values = [0.0, 0.2499, 0.25, 0.4999, 0.5, 0.7499, 0.75, 1.0]
    got = column(spark, values, "double", S.risk_tier)
    assert got == ["Low", "Low", "Moderate", "Moderate", "High", "High", "Critical", "Critical"]


def test_actions(spark):
    df = spark.createDataFrame(
        [("Critical", "enterprise"), ("Critical", "starter"), ("High", "enterprise"), ("High", None)],
        "risk string, tier string",
    )
    got = [r[0] for r in df.select(S.recommended_action(F.col("risk"), F.col("tier"))).collect()]
    assert got == [S.CRITICAL_ENTERPRISE, S.CRITICAL_OTHER, S.HIGH_ENTERPRISE, S.HIGH_OTHER]


def test_expected_loss_rounds_to_units(spark):
    df = spark.createDataFrame([(0.5, 5.0), (0.5, 7.0), (0.1234, 1000.0)], "p double, a double")
    got = [r[0] for r in df.select(S.expected_loss(F.col("p"), F.col("a"))).collect()]
    assert got == [2.0, 4.0, 123.0]


def test_f1_and_presentation(spark):
    row = (
        spark.range(1)
        .select(
            S.f1_of(F.lit(0.5), F.lit(1.0)).alias("f1"),
            S.f1_of(F.lit(0.0), F.lit(0.0)).alias("none"),
            S.dollars(F.lit(1234567.4)).alias("d"),
            S.percent(F.lit(0.1234)).alias("p"),
            S.millions(F.lit(99500000.0)).alias("m"),
        )
        .first()
    )
    assert math.isclose(row["f1"], 2 * 0.5 / (1.5 + 1e-9))
    assert row["none"] == 0.0
    assert (row["d"], row["p"], row["m"]) == ("$1,234,567", "12.3%", "$99.50M")
