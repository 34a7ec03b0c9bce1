"""Ranks and running totals over a whole table without putting it into one task.

A window without PARTITION BY moves every row to one task. Here the table is
sorted across the cluster instead. Each sorted partition is a block; only one
total per block has to be brought together, so the part that runs in one task
has as many rows as the sort has partitions, whatever the size of the table.

The sorted table is checkpointed: block numbers come from sampled range bounds,
and a retry or a second evaluation could draw other bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import ensure_checkpoint_dir

# Layout of monotonically_increasing_id: partition number above 33 bits of position.
_POSITION_BITS = 33


def sorted_blocks(df: DataFrame, order: Sequence[Column | str], key: str | None = None) -> DataFrame:
    """Sort, then fix the block and the position of every row; of ``key`` alone if it is given."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.orderBy(*order)
    rows = rows if key is None else rows.select(key)
    frozen = rows.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    return frozen.withColumns(
        {
            "_block": F.shiftright("_at", _POSITION_BITS),
            "_place": F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    ).drop("_at")


def rank_rows(
    df: DataFrame, order: Sequence[Column | str], name: str = "rank", key: str | None = None
) -> DataFrame:
    """Rank 1..n by a total order (give a tiebreak that makes it total).

    With ``key``, a column that no two rows share and that is never NULL, only the key
    and the order are sorted and written; the ranks are then joined to the rows. Without
    it whole rows are.
    """
    if key is not None:
        return df.join(_ranked(df, order, name, key), key)
    return _ranked(df, order, name)


def _ranked(df: DataFrame, order: Sequence[Column | str], name: str, key: str | None = None) -> DataFrame:
    blocks = sorted_blocks(df, order, key)
    # One row per sort partition, so both the window and the broadcast are bounded.
    sizes = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("_size"))
    before = sizes.select(
        "_block",
        (F.sum("_size").over(Window.orderBy("_block")) - F.col("_size")).alias("_before"),
    )
    return (
        blocks.join(F.broadcast(before), "_block")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_block", "_place", "_before")
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column | str],
    totals: dict[str, str],
    by: Sequence[str] = (),
    whole: dict[str, str] | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``totals`` (new name -> column), within ``by``.

    The rows of one group may lie in many blocks. Blocks are summed by themselves
    and shifted by what the earlier blocks of the group hold. ``whole`` (new name ->
    name of a running sum) also adds the group's total to each row; it travels with
    the block sums, as a join on the group alone would put a group into one task.
    """
    by, whole = list(by), whole or {}
    blocks = sorted_blocks(df, [*by, *order])
    inside = Window.partitionBy(*by, "_block").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # At most one row per block, plus one per group that starts inside a block.
    block_sums = blocks.groupBy(*by, "_block").agg(
        *[F.sum(column).alias(f"_sum_{name}") for name, column in totals.items()]
    )
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = block_sums.select(
        *by,
        "_block",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_shift_{name}")
            for name in totals
        ],
        *[
            F.sum(f"_sum_{name}").over(Window.partitionBy(*by)).alias(new)
            for new, name in whole.items()
        ],
    )
    summed = blocks.withColumns(
        {f"_in_{name}": F.sum(column).over(inside) for name, column in totals.items()}
    )
    return (
        summed.join(shifts, [*by, "_block"])
        .withColumns({name: F.col(f"_in_{name}") + F.col(f"_shift_{name}") for name in totals})
        .drop(
            "_block",
            "_place",
            *[f"_in_{name}" for name in totals],
            *[f"_shift_{name}" for name in totals],
        )
    )


def attach(df: DataFrame, summary: DataFrame) -> DataFrame:
    """Put the figures of a one-row table next to every row, as one scalar subquery."""
    row = summary.select(F.struct(*summary.columns)).scalar()
    return df.withColumns({c: row.getField(c) for c in summary.columns})


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """First k rows of an order; each task keeps k rows, no full sort."""
    return df.orderBy(*order).limit(k)
