"""Merkle manifest of a data set over retained SHA-256 states (operator 11).

Method: every parent is the SHA-256 of its children's digests (as hex text).
While a parent is built, the hash state before each child slot is copied and
kept.  Folding a changed child resumes the state before its slot, takes the
replacement and the right siblings only, and goes on with the parent: nothing
left of the slot is hashed again.

Leaves are hashed by Spark's ``sha2``.  Each group of leaves (a language, say)
is one tree; the roots of the groups are the leaves of a last tree.  Leaves are
dealt by ranges of group and key, so ranks need one small row per range, and a
tree is built in blocks of whole levels: a block of ``fan_out ** k`` consecutive
nodes (at most ``BLOCK``) becomes one node, blocks are built by many tasks, and
their tops are the nodes of the next round.  A group of any size is spread over
its blocks.  Proofs go down the same way: a block gets the siblings above it in
one row, not one row per leaf.  The driver sees the number of rounds only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_written, written

FAN_OUT = 2
#: Most nodes of a block.
BLOCK = 4096
#: Rows of a range of leaves, about.
RANGE_ROWS = 1 << 16

#: The siblings left and right of each step, as texts of joined digests.
Siblings = tuple[list[str], list[str]]


def field(column: Column) -> Column:
    """A value with its length in bytes before it; null is a dash."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    """SHA-256, as lowercase hex, of the columns in their order."""
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


class Tree:
    """Some levels over consecutive nodes, with the states of each parent.

    ``before[level][i]`` is the state of node ``i``'s parent before its slot.
    """

    def __init__(self, nodes: list[str], fan_out: int, levels: int | None):
        self.fan_out = fan_out
        self.levels, self.before = [nodes], []
        while len(self.levels[-1]) > 1 if levels is None else len(self.before) < levels:
            below, parents, states = self.levels[-1], [], []
            for i, node in enumerate(below):
                if i % fan_out == 0:
                    state = hashlib.sha256()
                    parents.append(state)
                states.append(state.copy())
                state.update(node.encode())
            self.before.append(states)
            self.levels.append([p.hexdigest() for p in parents])
        self.top = self.levels[-1][0]

    def siblings(self, at: int) -> Siblings:
        """What stands beside the path of a node, level by level."""
        lefts, rights = [], []
        for level in self.levels[:-1]:
            first = at - at % self.fan_out
            lefts.append("".join(level[first:at]))
            rights.append("".join(level[at + 1 : first + self.fan_out]))
            at //= self.fan_out
        return lefts, rights

    def fold(self, at: int, digest: str) -> str:
        """The top, if the node ``at`` had this digest."""
        for level, states in zip(self.levels, self.before):
            state = states[at].copy()
            state.update(digest.encode())
            for right in level[at + 1 : at - at % self.fan_out + self.fan_out]:
                state.update(right.encode())
            digest, at = state.hexdigest(), at // self.fan_out
        return digest


def beside(lefts: Sequence[str], rights: Sequence[str]) -> str:
    return "".join(left + right for left, right in zip(lefts, rights))


class Path:
    """The way from the top of a block to the root: the states before the slots
    are made once from the left siblings and copied for each fold."""

    def __init__(self, lefts: Sequence[str], rights: Sequence[str]):
        self.text = beside(lefts, rights)
        self.steps = [(hashlib.sha256(left.encode()), right.encode()) for left, right in zip(lefts, rights)]

    def fold(self, digest: str) -> str:
        for before, right in self.steps:
            state = before.copy()
            state.update(digest.encode() + right)
            digest = state.hexdigest()
        return digest


@dataclass(frozen=True)
class Shape:
    """Children of a parent, and the levels and nodes of a block."""

    fan_out: int
    levels: int
    span: int

    @staticmethod
    def of(fan_out: int, block: int) -> Shape:
        """As many levels as ``block`` nodes hold, one at least."""
        levels = 1
        while fan_out ** (levels + 1) <= block:
            levels += 1
        return Shape(fan_out, levels, fan_out**levels)


def ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``at``, the place in the group from zero, and ``size``,
    the number of the group's leaves.

    The order is ``grp, key, digest``, nulls first.  Equal rows are alike to the
    tree; ``salt`` deals them to different ranges.
    """
    order = "grp", "key", "digest", "salt"
    ranges = leaves.repartitionByRange(leaves.count() // RANGE_ROWS + 1, *order)
    cut = written(ranges.withColumn("cut", F.spark_partition_id()), "ranges")
    group = Window.partitionBy("grp")
    before = group.orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("grp", "cut").agg(F.count("*").alias("n"))
    offsets = sizes.select("grp", "cut", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"), F.sum("n").over(group).alias("size"))
    inside = Window.partitionBy("grp", "cut").orderBy(*order[1:])
    placed = cut.withColumn("at", F.row_number().over(inside) - 1).join(offsets, ["grp", "cut"])
    placed = written(placed.withColumn("at", F.col("at") + F.col("off")).drop("cut", "off", "salt"), "placed")
    drop_written(cut)
    return placed


def _blocks(nodes: DataFrame, shape: Shape) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / shape.span))


def _tree(part: pd.DataFrame, shape: Shape) -> tuple[pd.DataFrame, Tree]:
    """A block in its order and the levels over it.  The only block of a group
    ends at its root; one of several makes all its levels, so that a lone node
    is hashed as often as the others."""
    part = part.sort_values("at", kind="stable")
    alone = part["size"].iloc[0] <= shape.span
    return part, Tree(part["digest"].tolist(), shape.fan_out, None if alone else shape.levels)


def _up(nodes: DataFrame, shape: Shape) -> DataFrame:
    """The tops of the blocks, as nodes of the next round."""

    def top(part: pd.DataFrame) -> pd.DataFrame:
        part, tree = _tree(part, shape)
        first = part.iloc[0]
        return pd.DataFrame({"grp": [first["grp"]], "at": [first["block"]], "size": [-(-first["size"] // shape.span)], "digest": [tree.top]})

    plain = _blocks(nodes, shape).select("grp", "block", "at", "size", "digest")
    return plain.groupBy("grp", "block").applyInPandas(top, "grp string, at long, size long, digest string")


PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def _with_blocks(nodes: DataFrame, tops: DataFrame, shape: Shape, work: Callable, schema: str) -> DataFrame:
    """``work(block, tree, top)`` for every block and the row of its top."""

    def run(part: pd.DataFrame, top: pd.DataFrame) -> pd.DataFrame:
        return work(*_tree(part, shape), top.iloc[0])

    above = tops.withColumnRenamed("at", "block").groupBy("grp", "block")
    return _blocks(nodes, shape).groupBy("grp", "block").cogroup(above).applyInPandas(run, schema)


def _down(nodes: DataFrame, tops: DataFrame, shape: Shape) -> DataFrame:
    """The ways up from the nodes, from the ways up from their blocks' tops."""

    def paths(part: pd.DataFrame, tree: Tree, top: pd.Series) -> pd.DataFrame:
        own = [tree.siblings(i) for i in range(len(part))]
        lefts, rights = [a + list(top["lefts"]) for a, _ in own], [b + list(top["rights"]) for _, b in own]
        return pd.DataFrame({"grp": part["grp"], "at": part["at"], "lefts": lefts, "rights": rights, "subroot": top["subroot"], "root": top["root"]})

    plain = nodes.select("grp", "at", "size", "digest")
    return _with_blocks(plain, tops, shape, paths, f"grp string, at long, {PATH}")


def _rounds(nodes: DataFrame, shape: Shape) -> Iterator[DataFrame]:
    """The nodes of each round, up to one node a group."""
    while True:
        yield nodes
        if (nodes.agg(F.max("size")).first()[0] or 0) <= 1:
            return
        nodes = written(_up(nodes, shape), "nodes")


def _ways_up(rounds: list[DataFrame], tops: DataFrame, shape: Shape, lowest: int) -> DataFrame:
    """From the ways up from the last round's nodes to those of a lower round."""
    for k in range(len(rounds) - 2, lowest - 1, -1):
        below = written(_down(rounds[k], tops, shape), "paths")
        drop_written(tops)
        tops = below
    return tops


def manifest(docs: DataFrame, group: Column, key: Column, columns: Sequence[Column], changed: Column | None = None, fan_out: int = FAN_OUT) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row.

    ``columns`` make the leaf (null: a dash, so that null and empty differ).
    Leaves of a ``group`` are in the order of ``key``, nulls first and equal
    keys by digest; groups are in bytewise order, null first.  ``changed`` is a
    digest that stands in for the leaf when it is folded (null: the leaf
    itself); ``verified`` tells whether the folded root equals the root.
    ``proof_sha256`` is the SHA-256 of all siblings on the way up, left to
    right.  A group of one leaf is its own root; repeated rows are leaves of
    their own; an empty table gives an empty table.  Columns that are not named
    play no part.
    """
    shape = Shape.of(fan_out, BLOCK)
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    other = F.lit(None).cast("string") if changed is None else changed
    leaves = docs.select(name.alias("grp"), key.alias("key"), leaf_digest(*columns).alias("digest"), other.alias("changed"))
    # Told apart by files that stay as they are, so a repeated task repeats it.
    leaves = written(leaves, "leaves").withColumn("salt", F.xxhash64(F.input_file_name(), F.monotonically_increasing_id()))
    placed = ranked(leaves)
    drop_written(leaves)
    rounds = list(_rounds(placed, shape))
    # The groups' roots are the leaves of the last tree.
    subroots = ranked(rounds[-1].select(F.lit("").alias("grp"), F.col("grp").alias("key"), "digest", F.lit(0).alias("salt")))
    last = list(_rounds(subroots, shape))
    none = F.array().cast("array<string>")
    tops = written(last[-1].select("grp", "at", none.alias("lefts"), none.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root")), "paths")
    tops = _ways_up(last, tops, shape, 0)
    named = subroots.join(tops.drop("subroot"), ["grp", "at"])
    tops = written(named.select(F.col("key").alias("grp"), F.lit(0).cast("long").alias("at"), "lefts", "rights", F.col("digest").alias("subroot"), "root"), "paths")
    tops = _ways_up(rounds, tops, shape, 1)
    for nodes in [*rounds[1:], *last]:
        drop_written(nodes)

    def fold(part: pd.DataFrame, tree: Tree, top: pd.Series) -> pd.DataFrame:
        path = Path(top["lefts"], top["rights"])
        proofs, folded = [], []
        for i, (own, new) in enumerate(zip(part["digest"], part["changed"])):
            proofs.append(hashlib.sha256((beside(*tree.siblings(i)) + path.text).encode()).hexdigest())
            folded.append(path.fold(tree.fold(i, new or own)))
        out = part[["key"]].assign(leaf=part["digest"], subroot=top["subroot"], root=top["root"], proof_sha256=proofs, folded_root=folded)
        return out.assign(verified=out["folded_root"] == out["root"])

    kind = placed.schema["key"].dataType.simpleString()
    return _with_blocks(placed, tops, shape, fold, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def documents_manifest(docs: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """The manifest of ``documents``: one tree a language, leaves by doc_id.

    Where 7 divides the CRC-32 of the id, the leaf is folded with one more in
    ``n_chars`` (a null stays null, and null ids are left alone), so that the
    root must not be met.
    """
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    named = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    more = [F.col("n_chars") + 1 if i == 3 else c for i, c in enumerate(named)]
    found = manifest(docs, F.col("lang"), F.col("doc_id").cast("long"), named, F.when(chosen, leaf_digest(*more)), fan_out)
    return found.withColumnRenamed("key", "doc_id")


_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
#: CRC-32 by bits: each byte of the id, then eight shifts.
_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
_STEPS = f"flatten(list_transform({_BYTES}, lambda b: [b] || list_resize([-1], 8, -1)))"
_CRC = f"xor(list_reduce([4294967295] || {_STEPS}, lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"


def _levels(name: str, base: str) -> str:
    return f"""{name}(g, lv, i, n, h) AS (
  {base}
  UNION ALL
  SELECT g, lv + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM {name} WHERE n > 1 GROUP BY g, lv, i // 2, n
)"""


def _folds(name: str, nodes: str, base: str) -> str:
    return f"""{name}(doc_id, leaf, g, lv, i, n, h, cur, sibs) AS (
  {base}
  UNION ALL
  SELECT f.doc_id, f.leaf, f.g, f.lv + 1, f.i // 2, (f.n + 1) // 2, p.h,
    sha256(CASE WHEN f.i % 2 = 1 THEN s.h || f.cur ELSE f.cur || coalesce(s.h, '') END), f.sibs || coalesce(s.h, '')
  FROM {name} f JOIN {nodes} p ON p.g = f.g AND p.lv = f.lv + 1 AND p.i = f.i // 2
  LEFT JOIN {nodes} s ON s.g = f.g AND s.lv = f.lv AND s.i = xor(f.i, 1)
  WHERE f.n > 1
)"""


#: DuckDB: both trees level by level, then every leaf folded up through them.
ORACLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({_LEAF}) AS leaf,
    CASE WHEN {_CRC} % 7 = 0 THEN sha256({_LEAF.replace("n_chars", "(n_chars + 1)")}) END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves
), {_levels("nodes", "SELECT g, 0, i, n, leaf FROM placed")}, tops AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), {_levels("top_nodes", "SELECT '', 0, i, n, h FROM tops")},
{_folds("up", "nodes", "SELECT doc_id, leaf, g, 0, i, n, leaf, coalesce(changed, leaf), '' FROM placed")},
{_folds("over", "top_nodes", "SELECT u.doc_id, u.leaf || u.h, '', 0, t.i, t.n, t.h, u.cur, u.sibs FROM up u JOIN tops t ON t.g = u.g WHERE u.n = 1")}
SELECT doc_id, left(leaf, 64) AS leaf, right(leaf, 64) AS subroot, h AS root, sha256(sibs) AS proof_sha256, cur AS folded_root, cur = h AS verified
FROM over WHERE n = 1
"""
