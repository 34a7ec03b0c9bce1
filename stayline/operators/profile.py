"""Table profile: shape, types, non-null counts, distinct values, most frequent value, spread, first and last day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.operators.ordering import attach
from stayline.operators.quantiles import quantiles_of_running, running_counts
from stayline.operators.shapes import spine
from stayline.session import ensure_checkpoint_dir

QUARTILES = {"q25": 0.25, "q50": 0.50, "q75": 0.75}


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that hold NULLs, with how many. One pass, one row, then turned on its side."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _melt(one, df.columns, "n_null").where("n_null > 0")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def profile(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], dates: Sequence[str] = ()
) -> DataFrame:
    """One row per column: its type, the shape of the table, and what its values are like.

    Each row becomes (column, value) pairs that are counted on the map side, so the
    shuffle carries distinct values, not rows. The counts are written once; all figures
    come from them, so the table is read once.
    """
    by = ["column_name"]
    ensure_checkpoint_dir(df.sparkSession)
    counts = _counts(df, numeric, categorical, dates).checkpoint()
    numbers = running_counts(counts.where("_value is not null").select(*by, "_value", "_n"), by)
    of_numbers = (
        numbers.groupBy(*by)
        .agg(
            F.max("_upto").alias("non_null"),
            F.count(F.lit(1)).alias("n_distinct"),
            F.max("_n").alias("top_frequency"),
            F.min("_value").alias("min"),
            F.max("_value").alias("max"),
        )
        .withColumn("top_value", F.lit(None).cast("string"))
        .join(_moments(numbers, by), by)
        .join(quantiles_of_running(numbers, QUARTILES, by), by)
    )
    is_date = F.col("column_name").isin(list(dates))
    moments = ("mean", "std", "min", "max", *QUARTILES)
    day = {name: F.when(is_date, F.date_from_unix_date(F.col(side).cast("int")).cast("string")) for name, side in (("first_date", "min"), ("last_date", "max"))}
    of_numbers = of_numbers.withColumns(day).withColumns({c: F.when(~is_date, F.col(c)) for c in moments})
    # Values of one frequency first; on a tie in frequency the smallest text is the top.
    levels = (
        counts.where("_text is not null")
        .groupBy(*by, "_n")
        .agg(F.count(F.lit(1)).alias("_values"), F.min("_text").alias("_first"))
    )
    of_texts = levels.groupBy(*by).agg(
        F.sum(F.col("_n") * F.col("_values")).alias("non_null"),
        F.sum("_values").alias("n_distinct"),
        F.max("_n").alias("top_frequency"),
        F.max_by("_first", "_n").alias("top_value"),
    )
    found = of_numbers.unionByName(of_texts, allowMissingColumns=True)
    # Every row has a pair for each column, NULLs too: their number is that of the rows.
    columns = [*numeric, *categorical, *dates]
    sizes = counts.groupBy(*by).agg(F.sum("_n").alias("n_rows")).where(F.col("column_name") == columns[0])
    # Columns without a single value keep their row.
    every = spine(df.sparkSession, "column_name", columns).drop("position")
    kinds = dict(df.dtypes)
    listed = attach(every, sizes.agg(F.coalesce(F.max("n_rows"), F.lit(0)).alias("n_rows"))).withColumns(
        {
            "n_columns": F.lit(len(df.columns)),
            "data_type": F.element_at(F.create_map(*[F.lit(x) for c in columns for x in (c, kinds[c])]), F.col("column_name")),
        }
    )
    return listed.join(found, "column_name", "left").na.fill(0, ["non_null", "n_distinct"])


def _counts(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], dates: Sequence[str]
) -> DataFrame:
    """Rows per column and distinct value (``_value`` of numbers and days, ``_text`` of texts; both NULL for NULLs)."""

    def pair(name: str, value: Column | None, text: Column | None) -> Column:
        missing = {"_value": F.lit(None).cast("double"), "_text": F.lit(None).cast("string")}
        here = {"_value": value, "_text": text}
        sides = [(missing[k] if here[k] is None else here[k]).alias(k) for k in missing]
        return F.struct(F.lit(name).alias("column_name"), *sides)

    pairs = [pair(c, F.col(c).cast("double"), None) for c in numeric]
    pairs += [pair(c, None, F.col(c).cast("string")) for c in categorical]
    pairs += [pair(c, F.unix_date(c).cast("double"), None) for c in dates]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .groupBy("column_name", "_value", "_text")
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _moments(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and sample deviation per column; the deviation is taken around the mean, which costs no digits."""
    n = F.sum("_n")
    means = counts.groupBy(*by).agg((F.sum(F.col("_value") * F.col("_n")) / n).alias("mean"))
    # One row per column.
    off = counts.join(F.broadcast(means), by).withColumn("_off", F.pow(F.col("_value") - F.col("mean"), 2) * F.col("_n"))
    return off.groupBy(*by).agg(F.max("mean").alias("mean"), F.sqrt(F.try_divide(F.sum("_off"), n - 1)).alias("std"))


def _melt(one: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    return one.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(name)) for c in columns]
            )
        ).alias("entry")
    ).select("entry.*")
