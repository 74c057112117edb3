"""Benchmark decontamination by spaced seeds (operator 8), DataFrame only.

Method: a window of ``WINDOW`` tokens is cut into four blocks; a mask ignores
two of them and hashes the tokens of the others.  Two windows that differ in at
most two tokens differ in at most two blocks, so one of the six masks sees none
of the differences: joining the hashes of test and training windows finds every
such overlap.  Each hit is verified token by token.

Tokens are runs of letters and digits in lower case, so punctuation and case
do not hide a leak.  Token hashes, windows, seeds, the join and the
verification run in one generated stage over the documents; only verified
windows leave it, already gathered by document and item.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, text_of

WINDOW = 13
#: Tokens of a window that may be substituted.
SUBSTITUTED = 2
BLOCKS = ((0, 1, 2, 3), (4, 5, 6), (7, 8, 9), (10, 11, 12))
MASKS = tuple(combinations(range(4), 2))  # the blocks that count
#: Seeds (rows of about 150 bytes) up to which the test side is broadcast;
#: beyond it both sides are shuffled by seed.
BROADCAST_SEEDS = 1 << 20

TOKEN_GAPS = r"[^\p{L}\p{N}]+"


def token_hashes(text: Column) -> Column:
    tokens = F.array_remove(F.split(F.lower(text), TOKEN_GAPS), "")
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _windows(hashed: DataFrame, *keep: str) -> DataFrame:
    """One row per window position; ``h`` is referred to, not copied."""
    last = F.size("h") - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    return hashed.select(*keep, "h", F.explode_outer(places).alias("at")).where("at is not null")


def _at(offset: int) -> Column:
    return F.get("h", F.col("at") + offset)


def _with_seeds(windows: DataFrame, *keep: str) -> DataFrame:
    """One row per window and mask.  Tokens are hashed to blocks once and the
    masks hash blocks, which keeps the generated code small enough to compile."""
    blocks = windows.select(*keep, "h", "at", *[F.xxhash64(*[_at(o) for o in block]).alias(f"b{i}") for i, block in enumerate(BLOCKS)])
    seeds = F.array(*[F.xxhash64(F.lit(m), *[F.col(f"b{i}") for i in mask]) for m, mask in enumerate(MASKS)])
    return blocks.select(*keep, "h", "at", F.explode(seeds).alias("seed"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", keys: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, item_id, first_token, last_token, best_match``: documents that
    share with an item a window of 13 tokens of which at least 11 are equal.

    ``first_token`` and ``last_token`` bound the matching windows in the
    document, ``best_match`` is the most equal tokens of one window.  Items and
    documents of fewer than 13 tokens (null and empty ones too) give no rows:
    so few words are no evidence.  Repeated documents or items give one row a
    pair.  Null ids are kept as null; extra columns are ignored.  ``keys``
    replaces ``doc_id`` by other columns of ``docs``.
    """
    keys = keys or {"doc_id": F.col(id_col).cast("long")}
    item = F.col("item_id").cast("long").alias("item_id")
    tests = _windows(benchmark.select(item, token_hashes(text_of("text")).alias("h")), "item_id")
    tests = _with_seeds(tests, "item_id").select("item_id", "seed", F.slice("h", F.col("at") + 1, WINDOW).alias("window"))
    # Items are few next to the corpus; their number decides how to join.
    if benchmark.select(F.coalesce(F.sum(F.greatest(F.size(token_hashes(text_of("text"))) - WINDOW + 1, F.lit(0))), F.lit(0))).first()[0] * len(MASKS) <= BROADCAST_SEEDS:
        tests = F.broadcast(tests)
    train = _windows(docs.select(*[c.alias(k) for k, c in keys.items()], token_hashes(text_of(text_col)).alias("h")), *keys)
    train = _with_seeds(train, *keys)
    # Plain comparisons: a lambda would end the generated stage here, and every
    # window would be copied out of it together with the whole document.
    same = reduce(add, [(_at(o) == F.get("window", F.lit(o))).cast("int") for o in range(WINDOW)])
    return (
        train.join(tests, "seed")
        .select(*keys, "item_id", "at", same.alias("same"))
        .where(F.col("same") >= WINDOW - SUBSTITUTED)
        .groupBy(*keys, "item_id")
        .agg(
            F.min("at").cast("long").alias("first_token"),
            (F.max("at") + WINDOW - 1).cast("long").alias("last_token"),
            F.max("same").cast("long").alias("best_match"),
        )
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``leaks`` finds; a row with a null id is
    judged by its own text as well."""
    doc, code = fresh(docs, "_id", "_sha")
    keys = {doc: F.col(id_col).cast("long"), code: F.sha1(text_of(text_col))}
    found = leaks(docs, benchmark, id_col, text_col, keys).select(*keys).distinct()
    match = F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.sha1(text_of(text_col)) == F.col(code))
    return docs.join(found, match, "left_anti")


#: DuckDB: the same masks over token strings.
ORACLE = f"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') FROM benchmark
), places AS (
  SELECT side, id, w, unnest(range(0, len(w) - {WINDOW - 1})) AS p FROM words WHERE len(w) >= {WINDOW}
), windows AS (
  SELECT side, id, p, w[p + 1 : p + {WINDOW}] AS t FROM places
), seeds AS (
  SELECT side, id, p, t, unnest([{", ".join("'" + str(m) + " ' || " + " || ' ' || ".join(f"t[{o + 1}]" for k in mask for o in BLOCKS[k]) for m, mask in enumerate(MASKS))}]) AS seed FROM windows
), hits AS (
  SELECT DISTINCT d.id AS doc_id, b.id AS item_id, d.p, {" + ".join(f"(d.t[{o + 1}] = b.t[{o + 1}])::BIGINT" for o in range(WINDOW))} AS same
  FROM seeds d JOIN seeds b ON d.seed = b.seed AND d.side = 'd' AND b.side = 'b'
)
SELECT doc_id, item_id, min(p)::BIGINT AS first_token, (max(p) + {WINDOW - 1})::BIGINT AS last_token, max(same)::BIGINT AS best_match
FROM hits WHERE same >= {WINDOW - SUBSTITUTED} GROUP BY doc_id, item_id
"""
