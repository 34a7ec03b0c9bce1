"""Small result-shaping operators: forced category lists, pivots, shares, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def spine(spark: SparkSession, column: str, values: Sequence, position: str = "position") -> DataFrame:
    """A literal list as a table with its order."""
    return spark.range(1).select(
        F.posexplode(F.array(*[F.lit(v) for v in values])).alias(position, column)
    )


def on_spine(df: DataFrame, column: str, values: Sequence, position: str = "position") -> DataFrame:
    """Force a category list and its order; categories without a row get NULLs."""
    return spine(df.sparkSession, column, values, position).join(df, column, "left")


def share_within(df: DataFrame, amount: str, by: Sequence[str], name: str) -> DataFrame:
    """Each row's part of its group's sum. For aggregated tables (few rows per group)."""
    whole = F.sum(amount).over(Window.partitionBy(*by))
    return df.withColumn(name, F.try_divide(F.col(amount).cast("double"), whole.cast("double")))


def pivot_shares(df: DataFrame, row: str, column: str, amount: str, values: Sequence[str]) -> DataFrame:
    """Counts laid out by ``column`` and turned into percentages of each row.

    ``values`` come first, whether they occur or not; others that occur follow in order.
    For counted tables (few rows per value).
    """
    others = df.select(column).dropna().distinct().where(~F.col(column).isin(list(values)))
    values = [*values, *(r[0] for r in others.orderBy(column).collect())]
    wide = df.groupBy(row).pivot(column, list(values)).agg(F.sum(amount)).na.fill(0)
    total = sum((F.col(v) for v in values[1:]), F.col(values[0]))
    return wide.select(
        row, *[(F.try_divide(F.col(v).cast("double"), total.cast("double")) * 100).alias(v) for v in values]
    )


def upsert(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Replace the rows whose key comes again, add the others."""
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def best_row(df: DataFrame, score: str, position: str, wanted: str) -> DataFrame:
    """The ``wanted`` value of the row with the highest score, the first one on ties."""
    order = F.struct(F.col(score), -F.col(position))
    return df.agg(F.max_by(wanted, order).alias(wanted), F.max(score).alias(score))


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based histogram bin over [low, high], the last bin closed.

    The quotient can fall on the wrong side of an edge by one rounding step, so the
    bin is compared with its edges once more.
    """
    step = (high - low) / bins
    index = F.least(F.floor((value - low) / (high - low) * bins).cast("int"), F.lit(bins - 1))
    left = low + index * step
    right = low + (index + 1) * step
    return (
        F.when((value < left) & (index > 0), index - 1)
        .when((value >= right) & (index < bins - 1), index + 1)
        .otherwise(index)
    )
