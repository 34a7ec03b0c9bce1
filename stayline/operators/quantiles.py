"""Exact quantiles of large columns.

``F.median`` keeps every distinct value of a group in one task. That is fine where
the values are known to be few; for money columns it is not. Here equal values are
counted first (combined on the map side, so a value held by a third of all rows is
one row), and running totals of the counts locate the wanted positions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.ordering import running_totals


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per distinct value; NULL values and NULL groups are left out."""
    return (
        df.select(*by, F.col(value).alias("_value"))
        .dropna()
        .groupBy(*by, "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per group with the interpolated quantiles, named by ``probabilities``."""
    return quantiles_of_counts(value_counts(df, value, by), probabilities, by)


def quantiles_of_counts(
    counts: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles from ``_value`` / ``_n`` pairs."""
    return quantiles_of_running(running_counts(counts, by), probabilities, by)


def running_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add ``_upto``, rows of the group up to and including each value, and ``_total``."""
    return running_totals(counts, ["_value"], {"_upto": "_n"}, by, {"_total": "_upto"})


def quantiles_of_running(
    reached: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Pick the values at the wanted positions out of running counts."""
    picks = []
    for name, probability in probabilities.items():
        position = (F.col("_total") - 1) * F.lit(float(probability))
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.min(F.when(F.col("_upto") > index, F.col("_value"))).alias(f"_{side}_{name}"))
        picks.append(F.max(position - F.floor(position)).alias(f"_part_{name}"))
    found = reached.groupBy(*by).agg(*picks)
    results = []
    for name in probabilities:
        low = F.col(f"_lo_{name}").cast("double")
        high = F.col(f"_hi_{name}").cast("double")
        part = F.col(f"_part_{name}")
        middle = F.when(part == 0.5, (low + high) / 2).otherwise(low + (high - low) * part)
        results.append(middle.alias(name))
    return found.select(*by, *results)


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by)
