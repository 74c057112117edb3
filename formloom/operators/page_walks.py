"""Pages worked on whole, many to a batch.

A page has some dozens of boxes, so all of them can be compared in one task
after one shuffle by page, without copies in grid cells and without storing
what conflicts.  Pages of more than ``PAGE_BOXES`` rows, and those with blank
or inverted boxes, go the way of ``page_pairs``, which spreads one page
over many tasks; both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from formloom.operators.pairs import BOX, PAGE
from formloom.session import cut_lineage

#: Rows of a page up to which one task compares all of them.
PAGE_BOXES = 500
#: Crowded pages up to which their list is broadcast.
BROADCAST_PAGES = 100_000
#: Pairs looked at in one go.
PAIRS_AT_ONCE = 1_000_000
#: Coordinates beyond this could make areas overflow.
FAR = 1e100


def by_crowd(tables: Sequence[DataFrame], *needed: str) -> tuple[list[DataFrame], list[DataFrame], bool]:
    """The tables' rows on ordinary pages, those on crowded or odd ones, and
    whether there are any of these.  ``needed`` names columns besides the page
    and the box that must not be blank."""
    known = F.lit(True)
    for c in (*PAGE, *needed):
        known = known & F.col(c).isNotNull()
    far = sum((F.abs(F.col(c)) for c in BOX[1:]), F.abs(F.col(BOX[0])))
    fine = known & F.coalesce((far < FAR) & (F.col("x0") <= F.col("x1")) & (F.col("y0") <= F.col("y1")), F.lit(False))
    rows = [t.select(*PAGE, F.when(fine, 1).otherwise(PAGE_BOXES + 1).alias("n")) for t in tables]
    crowd = reduce(DataFrame.unionByName, rows).groupBy(*PAGE).agg(F.sum("n").alias("n")).where(F.col("n") > PAGE_BOXES)
    crowd = cut_lineage(crowd.select(*PAGE))
    n = crowd.limit(BROADCAST_PAGES + 1).count()
    listed = F.broadcast(crowd) if n <= BROADCAST_PAGES else crowd
    placed = [t.where(F.col(PAGE[0]).isNotNull() & F.col(PAGE[1]).isNotNull()) for t in tables]
    ordinary = [t.join(listed, list(PAGE), "left_anti") for t in placed] if n else list(tables)
    return ordinary, [t.join(listed, list(PAGE), "left_semi") for t in placed], n > 0


def each_page(rows: DataFrame, order: Sequence[str | Column], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: StructType | str) -> DataFrame:
    """What ``work`` makes of whole pages: it gets some pages at a time, their
    rows in ``order``, and where each page starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            starts = _page_starts(table)
            yield from work(table.slice(0, starts[-1]), starts[:-1]).to_batches() if len(starts) > 1 else ()
            rest = table.slice(starts[-1])
        if rest is not None:
            yield from work(rest, np.zeros(1, int)).to_batches()

    return rows.repartition(*PAGE).sortWithinPartitions(*PAGE, *order).mapInArrow(run, schema)


def _page_starts(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in PAGE:
        column = table.column(key).combine_chunks()
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def page_of_row(table: pa.Table, starts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(starts)), np.diff(starts, append=table.num_rows))


def boxes_of(table: pa.Table) -> np.ndarray:
    return np.stack([table.column(c).to_numpy() for c in BOX])


def same_id(table: pa.Table, page: np.ndarray, *ids: str) -> np.ndarray:
    """For each row the first one of its page with the same ids."""
    codes = {c: table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy() for c in ids}
    frame = pd.DataFrame({"page": page, **codes})
    rows = np.arange(len(frame))
    if not frame.duplicated().any():
        return rows
    return frame.assign(row=rows).groupby(["page", *ids], sort=False)["row"].transform("min").to_numpy()


def ranges(left: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows ``left`` paired with the rows from ``low`` to ``high`` (left out) of
    each, some ``PAIRS_AT_ONCE`` at a time, in the order of ``left``."""
    sizes = np.maximum(high - low, 0)
    share = np.cumsum(sizes) // PAIRS_AT_ONCE
    for cut in np.split(np.arange(len(left)), np.flatnonzero(np.diff(share)) + 1):
        n = sizes[cut]
        before = np.cumsum(n) - n
        yield np.repeat(left[cut], n), np.arange(n.sum()) - np.repeat(before - low[cut], n)


def overlap(a: np.ndarray, b: np.ndarray, axis: int) -> np.ndarray:
    """Shared extent of boxes along x (0) or y (1), as in ``geometry``."""
    return np.minimum(a[axis + 2], b[axis + 2]) - np.maximum(a[axis], b[axis])


def area(a: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, a[2] - a[0]) * np.maximum(0.0, a[3] - a[1])


def iou(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``geometry.rect_iou``, to the same bit."""
    shared = np.maximum(0.0, overlap(a, b, 0)) * np.maximum(0.0, overlap(a, b, 1))
    union = area(a) + area(b) - shared
    return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)


def kept_on_pages(
    rows: DataFrame, id_col: str, order: Sequence[str | Column], conflict: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> DataFrame:
    """The rows that stay when each, in ``order`` and then by id, drops the
    later ones of its page that conflict with it."""

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        page, at, boxes = page_of_row(table, starts), np.arange(table.num_rows), boxes_of(table)
        first, gone = same_id(table, page, id_col), np.zeros(table.num_rows, bool)
        for left, right in ranges(at, at + 1, np.append(starts, table.num_rows)[page + 1]):
            hit = conflict(boxes[:, left], boxes[:, right])
            # the earlier rows of each were all judged before it
            for a, b in zip(first[left[hit]].tolist(), first[right[hit]].tolist()):
                if a != b and not gone[a]:
                    gone[b] = True
        return table.filter(pa.array(~gone[first]))

    return each_page(rows, [*order, id_col], work, rows.schema)


def matches_on_pages(a: DataFrame, b: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Pairs of boxes of ``a`` and ``b`` (prefix ``r_``) that a greedy walk by
    IoU, then ids, takes at any of ``thresholds``; bit i of ``at`` is set for
    threshold i."""
    cols = [*PAGE, "rect_id", *BOX]
    sides = a.select(*cols, F.lit(0).alias("side")).unionByName(b.select(*cols, F.lit(1).alias("side")))
    least = min(thresholds)

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        page, boxes = page_of_row(table, starts), boxes_of(table)
        first, of_a = same_id(table, page, "rect_id", "side"), table.column("side").to_numpy() == 0
        left = np.flatnonzero(of_a)
        low, high = starts + np.add.reduceat(of_a.astype(int), starts), np.append(starts[1:], table.num_rows)
        near = []
        for i, j in ranges(left, low[page[left]], high[page[left]]):
            shared = iou(boxes[:, i], boxes[:, j])
            hit = shared >= least
            near.append((shared[hit], i[hit], j[hit]))
        shared, i, j = (np.concatenate(c) for c in zip(*near)) if near else (np.zeros(0), np.zeros(0, int), np.zeros(0, int))
        best = np.lexsort((j, i, -shared))
        shared, i, j = shared[best], i[best], j[best]
        at = np.zeros(len(i), np.int32)
        for bit, threshold in enumerate(thresholds):
            taken = set()
            for n, (p, q) in enumerate(zip(first[i].tolist(), first[j][: np.count_nonzero(shared >= threshold)].tolist())):
                if p not in taken and q not in taken:
                    taken.update((p, q))
                    at[n] |= 1 << bit
        i, j, at = i[at > 0], j[at > 0], at[at > 0]
        one, other = table.take(pa.array(i)), table.take(pa.array(j))
        columns = {**{c: one.column(c) for c in cols}, **{"r_" + c: other.column(c) for c in cols[2:]}, "at": pa.array(at)}
        return pa.table(columns)

    types = {f.name: f.dataType.simpleString() for f in sides.schema}
    schema = ", ".join([f"{c} {types[c]}" for c in cols] + [f"r_{c} {types[c]}" for c in cols[2:]] + ["at int"])
    return each_page(sides, ["side", "rect_id"], work, schema)
