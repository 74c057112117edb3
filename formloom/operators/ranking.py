"""Ranks, neighbours and running values inside groups of any size.

A plain ``row_number() over (partition by form)`` sorts a whole form in one
task.  These helpers cut each group along its order first, so a form or page
holding a large share of all rows is worked on by many tasks; only one small
row per slice meets in the group's own window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK = 4096


def rank_in_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slices: Sequence[Column],
    name: str = "rank",
) -> DataFrame:
    """``row_number`` (from 1) over ``keys`` by ``order``.

    ``slices`` must not decrease along ``order`` and must not be null; rows are
    ranked inside each slice and shifted by the sizes of the slices before it.
    """
    cuts = [f"_cut{i}" for i in range(len(slices))]
    marked = df.withColumns(dict(zip(cuts, slices)))
    sizes = marked.groupBy(*keys, *cuts).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(*cuts).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, *cuts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*keys, *cuts).orderBy(*order)
    return (
        marked.withColumn(name, F.row_number().over(inside).cast("bigint"))
        .join(offsets, [*keys, *cuts])
        .withColumn(name, F.col(name) + F.col("_off"))
        .drop(*cuts, "_off")
    )


def with_halo(df: DataFrame, keys: Sequence[str], rank: str = "rank", behind: int = 0, ahead: int = 0) -> DataFrame:
    """Rows in blocks of consecutive ranks, each block holding copies of up to
    ``behind`` / ``ahead`` rows of its neighbours.  Windows go over
    ``(*keys, _block)``; ``_own`` marks the rows to keep afterwards."""
    home = F.floor((F.col(rank) - 1) / BLOCK)
    at = F.pmod(F.col(rank) - 1, F.lit(BLOCK))
    blocks = F.array_compact(
        F.array(
            home,
            F.when((at < ahead) & (home > 0), home - 1),
            F.when(at >= BLOCK - behind, home + 1),
        )
    )
    return df.withColumn("_block", F.explode(blocks)).withColumn("_own", F.col("_block") == home)


def block_window(keys: Sequence[str], rank: str = "rank"):
    return Window.partitionBy(*keys, "_block").orderBy(rank)


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    values: dict[str, Column],
    rank: str = "rank",
    behind: int = 0,
    ahead: int = 0,
) -> DataFrame:
    """Add window expressions over a block with a halo, such as
    ``F.lag("y0").over(block_window(keys))``."""
    return (
        with_halo(df, keys, rank, behind, ahead)
        .withColumns(values)
        .where("_own")
        .drop("_own", "_block")
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    name: str,
    how: str = "sum",
    rank: str = "rank",
    exclusive: bool = False,
) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` along ``rank``, in two levels:
    inside blocks, then over one row per block."""
    fold = {"sum": F.sum, "max": F.max}[how]
    marked = df.withColumn("_v", value).withColumn("_block", F.floor((F.col(rank) - 1) / BLOCK))
    totals = marked.groupBy(*keys, "_block").agg(fold("_v").alias("_t"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, "_block", fold("_t").over(before).alias("_carry"))
    last = -1 if exclusive else 0
    inside = Window.partitionBy(*keys, "_block").orderBy(rank).rowsBetween(Window.unboundedPreceding, last)
    local = marked.withColumn("_local", fold("_v").over(inside)).join(carried, [*keys, "_block"])
    if how == "sum":
        merged = F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    else:
        merged = F.greatest("_local", "_carry")
    return local.withColumn(name, merged).drop("_v", "_block", "_local", "_carry")
