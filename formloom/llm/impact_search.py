"""Exact top-k inner products over an impact-ordered index (operator 6).

Method: within a block of candidates each dimension is turned to impacts
(distance from the least useful end for the sign of the query's component),
quantised to levels, and kept as posting segments.  A query takes the segments
of all dimensions by descending quantised impact and adds them to accumulators.
What the open segments may still add is bounded, so every candidate has a lower
and an upper bound; processing stops once the candidates that can still be
among the best are few, and those are scored exactly.  Blocks are independent;
the best of all blocks are ranked at the end.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Candidates and queries of a block; both bound the memory of a task.
CANDIDATES, QUERIES = 8192, 512
LEVELS = 16
#: Segments between two looks at the bounds, and the candidates that may be
#: left for exact scoring when processing stops.
LOOK, FEW = 64, 128


class Index:
    """Posting segments of one block, for both signs of a query component."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.low, self.high = vectors.min(0), vectors.max(0)
        self.steps = np.maximum(1, -(-(self.high - self.low + 1) // LEVELS))
        rise = (vectors - self.low) // self.steps
        fall = (self.high - vectors) // self.steps
        self.segments = [[self.postings(levels[:, d]) for d in range(vectors.shape[1])] for levels in (fall, rise)]

    @staticmethod
    def postings(levels: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(levels, kind="stable")
        cuts = np.searchsorted(levels[order], np.arange(LEVELS + 1))
        return [order[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def search(self, query: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and exact scores of all that can be among the best ``k``;
        ``own`` marks the candidates that are left out."""
        weight, up = np.abs(query), query > 0
        used = np.flatnonzero(weight)
        # Impact of each (dimension, level) and the level's largest rest.
        dims, levels = (a.ravel() for a in np.meshgrid(used, np.arange(1, LEVELS), indexing="ij"))
        impact = weight[dims] * levels * self.steps[dims]
        lower = np.zeros(len(self.vectors), np.int64)
        lower[own] = np.iinfo(np.int64).min // 2
        open_level = np.full(len(query), LEVELS - 1)
        found = np.flatnonzero(~own)
        if len(found) > k:
            for n, s in enumerate(np.argsort(-impact, kind="stable").tolist(), 1):
                d, level = dims[s], levels[s]
                lower[self.segments[int(up[d])][d][level]] += impact[s]
                open_level[d] = level - 1
                if n % LOOK == 0 or n == len(impact):
                    rest = int((weight * ((open_level + 1) * self.steps - 1)).sum())
                    least = np.partition(lower, len(lower) - k)[len(lower) - k]
                    found = np.flatnonzero((lower + rest >= least) & ~own)
                    if len(found) <= FEW:
                        break
        return found, self.vectors[found] @ query


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``vec_id, v``: floor(scale * x); rows that hold anything else than
    finite numbers (or no id) are left out."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf")))
    return vectors.where(x.isNotNull() & finite & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long")).alias("v")
    )


def top_k(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` greatest integer inner
    products of each query, ties to the smaller id.

    A query's own id is never its partner.  Shorter vectors count as padded
    with zeros.  Null vectors, vectors with null or non-finite components and
    null ids take no part; an empty table gives an empty table; extra columns
    are ignored.  Repeated rows are candidates of their own, repeated queries
    are answered once.
    """
    points = written(quantised(vectors, id_col, vec_col, scale), "points")
    asked = points.where(is_query(F.col("vec_id"))).dropDuplicates(["vec_id", "v"])
    n_blocks = max(1, -(-points.count() // CANDIDATES))
    n_asked = max(1, -(-asked.count() // QUERIES))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
    group = F.pmod(F.xxhash64("vec_id"), F.lit(n_asked))
    left = points.select("vec_id", "v", block.alias("block"), F.explode(F.expr(f"sequence(0L, {n_asked - 1}L)")).alias("part"))
    right = asked.select("vec_id", "v", group.alias("part"), F.explode(F.expr(f"sequence(0L, {n_blocks - 1}L)")).alias("block"))
    names = ["query_id", "query", "vec_id", "score"]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]

    def matrix(rows: list[list[int]], width: int) -> np.ndarray:
        out = np.zeros((len(rows), width), np.int64)
        for i, row in enumerate(rows):
            out[i, : len(row)] = row
        return out

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if candidates.num_rows and queries.num_rows:
            rows, asks = candidates["v"].to_pylist(), queries["v"].to_pylist()
            width = max(map(len, rows + asks))
            ids = np.array(candidates["vec_id"].to_pylist(), np.int64)
            index = Index(matrix(rows, width)) if width else None
            for query_id, ask in zip(queries["vec_id"].to_pylist(), asks):
                own = ids == query_id
                if index:
                    found, scores = index.search(matrix([ask], width)[0], k, own)
                else:
                    found, scores = np.flatnonzero(~own), np.zeros(int((~own).sum()), np.int64)
                best = np.lexsort((ids[found], -scores))[:k]
                out[0] += [query_id] * len(best)
                out[1] += [ask] * len(best)
                out[2] += ids[found[best]].tolist()
                out[3] += scores[best].tolist()
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds)], names=names)

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(search, "query_id long, query array<long>, vec_id long, score long")
    order = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
