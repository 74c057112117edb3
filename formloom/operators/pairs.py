"""The spatial pair builder behind every layout join.

``page_pairs`` joins two rectangle tables on ``(form_id, page)`` **and** a grid
cell, so that one page holding a large share of all rectangles is spread over
many join keys instead of meeting in one task.  Each side is copied into the
cells it touches (the left one grown by ``reach``); a pair that meets in several
cells is kept only in the cell of the top-left corner of the shared area, so no
``distinct`` is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = ("form_id", "page")
RIGHT = "r_"


class Reach(NamedTuple):
    """How far, in points, the left rectangle looks on each side; None to the
    left or right: across the whole page, whatever its width."""

    left: float | None = 0.0
    up: float = 0.0
    right: float | None = 0.0
    down: float = 0.0

    @classmethod
    def all_round(cls, d: float) -> Reach:
        return cls(d, d, d, d)


def prefixed(df: DataFrame, prefix: str = RIGHT) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def by_shuffle(df: DataFrame) -> DataFrame:
    """A side of a join that Spark must not broadcast.  The size of what comes
    out of an ``explode`` is guessed from the file it was read from, which may
    be thousands of times smaller."""
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt to all tasks by ``keys``, for small files (one split) whose
    rows each give many."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _span(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(F.greatest(low, high) / size))


def page_pairs(
    left: DataFrame,
    right: DataFrame,
    predicate: Column | None = None,
    *,
    reach: Reach = Reach(),
    cell: tuple[float, float] = (256.0, 64.0),
    keys: Sequence[str] = PAGE,
) -> DataFrame:
    """All (left, right) rectangles of one page within ``reach`` that satisfy
    ``predicate``.  Right-hand columns carry the prefix ``r_``.

    ``reach`` must cover what ``predicate`` accepts: pairs whose grown boxes do
    not touch are not looked at.
    """
    cw, ch = cell
    across = reach.left is None or reach.right is None
    grown_y0, grown_y1 = F.col("y0") - reach.up, F.col("y1") + reach.down
    lhs = left.withColumn("_cy", F.explode(_span(grown_y0, grown_y1, ch)))
    rhs = prefixed(right)
    rhs = rhs.withColumn("_rcy", F.explode(_span(F.col("r_y0"), F.col("r_y1"), ch)))
    on = [F.col(k) == F.col(RIGHT + k) for k in keys] + [F.col("_cy") == F.col("_rcy")]
    touches = (grown_y0 <= F.col("r_y1")) & (grown_y1 >= F.col("r_y0"))
    owner = F.col("_cy") == F.floor(F.greatest(grown_y0, F.col("r_y0")) / ch)
    if not across:
        grown_x0, grown_x1 = F.col("x0") - reach.left, F.col("x1") + reach.right
        lhs = lhs.withColumn("_cx", F.explode(_span(grown_x0, grown_x1, cw)))
        rhs = rhs.withColumn("_rcx", F.explode(_span(F.col("r_x0"), F.col("r_x1"), cw)))
        on.append(F.col("_cx") == F.col("_rcx"))
        touches = touches & (grown_x0 <= F.col("r_x1")) & (grown_x1 >= F.col("r_x0"))
        owner = owner & (F.col("_cx") == F.floor(F.greatest(grown_x0, F.col("r_x0")) / cw))
    condition = on[0]
    for part in [*on[1:], touches, owner]:
        condition = condition & part
    if predicate is not None:
        condition = condition & predicate
    return lhs.join(rhs, condition).drop("_cx", "_cy", "_rcx", "_rcy")


def page_pairs_within(
    df: DataFrame, predicate: Column, reach: float = 0.0, cell: tuple[float, float] = (256.0, 64.0), corners: bool = False
) -> DataFrame:
    """``page_pairs`` of a table with itself, for a ``reach`` that is the same on
    all sides.  Both sides are grown by half of it, so they lie in the same cells
    and are shuffled once for both.  With ``corners`` the top left corners have to
    be within reach, not just the boxes, so most boxes lie in one cell."""
    cw, ch = cell
    half = reach / 2 + 0.01 if reach else 0.0  # a little more: the predicate decides
    end = "0" if corners else "1"
    cells = df.withColumn("_cy", F.explode(_span(F.col("y0") - half, F.col("y" + end) + half, ch)))
    cells = cells.withColumn("_cx", F.explode(_span(F.col("x0") - half, F.col("x" + end) + half, cw)))
    keys = [*PAGE, "_cy", "_cx"]
    cells = cells.repartition(*keys)
    condition = predicate
    for k in keys:
        condition = condition & (F.col(k) == F.col(RIGHT + k))
    for axis, size in (("x", cw), ("y", ch)):
        low, other_low = F.col(f"{axis}0") - half, F.col(f"{RIGHT}{axis}0") - half
        condition = condition & (low <= F.col(f"{RIGHT}{axis}{end}") + half) & (other_low <= F.col(f"{axis}{end}") + half)
        condition = condition & (F.col(f"_c{axis}") == F.floor(F.greatest(low, other_low) / size))
    return cells.join(prefixed(cells), condition).drop("_cy", "_cx", "r__cy", "r__cx")


def nearest(
    pairs: DataFrame,
    by: Sequence[str],
    value: dict[str, Column],
    order: Sequence[Column | str],
) -> DataFrame:
    """For each key, the values of the pair that sorts first.

    ``min_by`` combines map-side, so a key with many candidates costs one
    record per map task in the shuffle.  An order given by names of values is
    shuffled with them, not beside them.
    """
    if all(isinstance(o, str) for o in order):
        names = [*order, *(n for n in value if n not in order)]
        first = F.min(F.struct(*[value[n].alias(n) for n in names])).alias("_pick")
        return pairs.groupBy(*by).agg(first).select(*by, *[F.col(f"_pick.{name}").alias(name) for name in value])
    picked = F.struct(*[col.alias(name) for name, col in value.items()])
    return (
        pairs.groupBy(*by)
        .agg(F.min_by(picked, F.struct(*order)).alias("_pick"))
        .select(*by, *[F.col(f"_pick.{name}").alias(name) for name in value])
    )


def matched_keys(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    return pairs.select(*by).distinct()


def on_y_axis(df: DataFrame) -> DataFrame:
    """Flatten boxes onto the y axis, for predicates that ignore x."""
    return df.withColumn("x0", F.lit(0.0)).withColumn("x1", F.lit(0.0))


BOX = ("x0", "y0", "x1", "y1")


def places(df: DataFrame, keys: Sequence[str] = PAGE, **aggs: Column) -> DataFrame:
    """One row per distinct box of a page.

    A page has room for only so many distinct boxes.  Where the answer depends
    on where things stand, looking at places instead of rows keeps the number
    of candidate pairs linear even when one page holds a large share of all
    rows, most of them on top of one another.
    """
    named = [c.alias(name) for name, c in aggs.items()] or [F.count("*").alias("n_here")]
    return df.groupBy(*keys, *BOX).agg(*named)


def page_semi(
    left: DataFrame, right: DataFrame, predicate: Column, *, id_cols: Sequence[str], reads: Sequence[str] = (), **kw
) -> DataFrame:
    """Left rows with at least one partner on their page.

    ``reads`` names the right-hand columns, besides the box, that the
    predicate looks at.
    """
    return left.join(_hits(left, right, predicate, id_cols, reads, kw), list(id_cols), "left_semi")


def page_anti(
    left: DataFrame, right: DataFrame, predicate: Column, *, id_cols: Sequence[str], reads: Sequence[str] = (), **kw
) -> DataFrame:
    """Left rows with no partner on their page."""
    return left.join(_hits(left, right, predicate, id_cols, reads, kw), list(id_cols), "left_anti")


def _hits(left, right, predicate, id_cols, reads, kw) -> DataFrame:
    seen = right.select(*kw.get("keys", PAGE), *BOX, *reads).distinct()
    return matched_keys(page_pairs(left, seen, predicate, **kw), id_cols)
