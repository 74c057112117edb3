"""SimHash near-duplicates by a byte-position index (operator 2).

Method: a 64-bit fingerprint is eight positional bytes.  Two fingerprints that
differ in at most two bits share at least six of them.  Postings are keyed by
four positional bytes, chosen so that any two with six shared bytes meet under
a key (the bytes form four pairs of positions; at most two pairs differ).
Pairs that meet have their shared bytes tallied, those that reach six stay, and
the differing bits are counted.

Only distinct fingerprints are posted: copies cost one row.  A key with more
than ``HOT`` fingerprints is not paired.  There each fingerprint is posted
under itself and its one-bit neighbours in the open bytes; two fingerprints
meet exactly where they differ in at most two bits, every bucket holds at most
33 fingerprints and the work stays in proportion to the rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, fresh, map_batches, small_batches, text_of, written
from .components import components

SEED = 42
#: Fingerprints under a key up to which they are paired directly.
HOT = 24
PAIRS = ((0, 1), (2, 3), (4, 5), (6, 7))
KEYS = [(*a, *b) for a, b in combinations(PAIRS, 2)]


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words; of all words, if they are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    runs = zip(*(words[i:] for i in range(size)))
    return np.fromiter((digest(b" ".join(run), SEED) for run in runs), np.uint64, len(words) - size + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit by bit the majority (over half) of the hashes; zero for none."""
    count = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo : lo + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * count > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` (signed long) of every whole text; null texts are empty."""

    def work(batch):
        found = [fingerprint(shingle_hashes(words_of(t), shingle)) for t in batch["text"]]
        return {"doc_id": pa.array(batch["doc_id"], pa.int64()), "fp": pa.array(found, pa.int64())}

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return map_batches(plain, "doc_id long, fp long", work)


def _mask(positions) -> int:
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes are equal."""
    differ = a.bitwiseXOR(b)
    return sum((F.when(differ.bitwiseAND(F.lit(_mask([p]))) == 0, 1).otherwise(0) for p in range(1, 8)), F.when(differ.bitwiseAND(F.lit(_mask([0]))) == 0, 1).otherwise(0))


def links(distinct: DataFrame) -> DataFrame:
    """``u, v``: links between distinct fingerprints ``fp`` at two or fewer
    differing bits.  All of them for keys of up to ``HOT`` fingerprints; within
    hotter keys one star per shared one-bit neighbour, which joins the same
    fingerprints without listing their pairs."""
    postings = distinct.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(k))).alias("value")) for i, k in enumerate(KEYS)])).alias("key"),
    ).select("fp", "key.part", "key.value")
    sizes = postings.groupBy("part", "value").agg(F.count("*").alias("n")).where("n > 1")
    live = written(postings.join(sizes, ["part", "value"]), "postings")

    small = live.where(F.col("n") <= HOT)
    left, right = small.select("part", "value", F.col("fp").alias("u")), small.select("part", "value", F.col("fp").alias("v"))
    u, v = F.col("u"), F.col("v")
    paired = (
        left.join(right, ["part", "value"])
        .where(u < v)
        .where(shared_bytes(u, v) >= 6)
        .where(F.bit_count(u.bitwiseXOR(v)) <= 2)
        .select("u", "v")
    )
    hot = live.where(F.col("n") > HOT)
    flips = F.create_map(*[x for i, k in enumerate(KEYS) for x in (F.lit(i), F.array(F.lit(0), *[F.lit(_bit(8 * p + b)) for p in range(8) if p not in k for b in range(8)]))])
    near = (
        hot.select("fp", F.explode(F.element_at(flips, F.col("part"))).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"))
        .groupBy("middle")
        .agg(F.collect_set("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )
    stars = near.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v")).where("u != v")
    return paired.union(stars)


def _bit(i: int) -> int:
    return 1 << i if i < 63 else -(1 << 63)


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per row of ``docs``.

    ``component_id`` is the least doc_id among all documents reachable over
    fingerprints at two or fewer differing bits (null ids count only where a
    component has no other).  Empty and null texts have fingerprint zero.
    Repeated rows and extra columns change nothing; an empty table gives an
    empty table.
    """
    prints = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes.select("fp")))
    member = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = member.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = member.join(best, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Near copies at a similarity of word shingles.
#
# The byte-position index goes first: fingerprints that it links at two or fewer
# bits are candidates, checked on whole shingle sets.  One fingerprint of a whole
# text is too blunt for all pairs at a similarity of 0.8 (such a pair differs in
# some ten of 64 bits), so a prefix filter on whole shingle sets finds the pairs
# that are left.  In any one order of all shingles, two sets at 0.8 or more
# share one of the first ``prefix_length`` shingles of each.  The order (cold
# shingles first, then by hash) decides the cost, never the result.

SHINGLE, SIMILARITY = 5, 0.8
#: Postings beyond which a shingle is put behind the others in the order, how
#: many such shingles are sent to the tasks, and rounds of looking for them.
COMMON, MOST_COMMON, LOOKS = 64, 1 << 20, 8
#: Two sets at 4/5 share 4/9 (m + n) shingles, all of them at or behind the first
#: one shared; i and j are the shingles left there.
MEETS = "9 * least({i}, {j}) >= 4 * ({m} + {n})"
#: Nodes up to which the list of wanted sets is broadcast.
BROADCAST_NODES = 1 << 20


def alike(a: bytes, b: bytes) -> bool:
    """Whether two whole sorted sets have a Jaccard similarity of 4/5 or more."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if 5 * min(len(x), len(y)) < 4 * max(len(x), len(y)):
        return False
    both = int(_among(x, y).sum())
    return 5 * both >= 4 * (len(x) + len(y) - both)


def _among(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``y``."""
    if not len(y):
        return np.zeros(len(x), bool)
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x


def prefix_length(size: int) -> int:
    """A set at 4/5 or more shares at least ceil(4/5 size) shingles."""
    return size - (4 * size + 4) // 5 + 1 if size else 0


def prefix_of(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set, the common ones behind the others."""
    behind = _among(shingles, common)
    return np.concatenate([shingles[~behind], shingles[behind]])[: prefix_length(len(shingles))]


def shingle_set(text: str) -> np.ndarray:
    """The sorted set of a text's shingles."""
    return np.unique(shingle_hashes(words_of(text), SHINGLE))


def node_of(shingles: np.ndarray) -> int:
    """The number of a set; texts of equal sets are one node."""
    node = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return node - (1 << 64) if node >= 1 << 63 else node


def _common_shingles(rows: DataFrame, texts: DataFrame) -> np.ndarray:
    """Sorted shingles with more than ``COMMON`` postings.  Where they are put
    back, other shingles come to the front and are looked at in turn, in the
    sets that the first look changes.  ``rows`` has the first prefixes."""

    def keys(batch):
        return {"key": pa.array(np.frombuffer(b"".join(batch["prefix"]), np.int64))}

    def frequent(found: DataFrame, room: int) -> np.ndarray:
        counted = found.groupBy("key").count().where(F.col("count") > COMMON).orderBy(F.desc("count"), "key").limit(room)
        return np.sort(np.array([r.key for r in counted.collect()], np.int64).view(np.uint64))

    none = np.zeros(0, np.uint64)
    first = common = frequent(map_batches(rows.select("prefix"), "key long", keys), MOST_COMMON)
    if not len(common):
        return common

    def changed(batch):
        sets = [x for x in map(shingle_set, batch["text"]) if _among(prefix_of(x, none), first).any()]
        return {"shingles": pa.array([x.tobytes() for x in sets], pa.binary())}

    sets = written(map_batches(texts, "shingles binary", changed), "changed")
    before = none
    for _ in range(LOOKS):

        def work(batch, before=before, common=common):
            out = [np.zeros(0, np.int64)]
            for s in batch["shingles"]:
                x = np.frombuffer(s, np.uint64)
                if (_among((old := prefix_of(x, before)), common) & ~_among(old, before)).any():
                    new = prefix_of(x, common)
                    out.append(new[~_among(new, common)].view(np.int64))
            return {"key": pa.array(np.concatenate(out), pa.int64())}

        room = MOST_COMMON - len(common)
        found = frequent(map_batches(sets, "key long", work), room) if room > 0 else none
        if not len(found):
            break
        before, common = common, np.union1d(common, found)
    drop_written(sets)
    return common


def low_part(shingles: np.ndarray) -> np.ndarray:
    """The size of a sorted set and its shingles in the lowest quarter of hashes."""
    return np.concatenate([np.array([len(shingles)], np.uint64), shingles[: np.searchsorted(shingles, np.uint64(1 << 62))]])


def may_be_alike(a: bytes, b: bytes) -> bool:
    """False only where the low parts leave too little for 4/5, whatever the rest."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    m, n = int(x[0]), int(y[0])
    most = int(_among(x[1:], y[1:]).sum()) + min(m - len(x) + 1, n - len(y) + 1)
    return 9 * most >= 4 * (m + n)


def _alike_pairs(pairs: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``u, v`` whose whole sets are alike.  Low parts of the sets go
    first, so whole sets travel only with pairs that these cannot rule out.

    Whole sets are made anew from the texts: kept, they would take more room
    than the texts themselves.
    """

    def whole(batch):
        sets = [shingle_set(t) for t in batch["text"]]
        return {"node": pa.array(list(map(node_of, sets)), pa.int64()), "shingles": pa.array([x.tobytes() for x in sets], pa.binary())}

    def those(pairs, test, name, sets):
        wanted = written(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "wanted")
        few = F.broadcast(wanted) if wanted.count() <= BROADCAST_NODES else wanted
        own = written(sets.join(few, "node", "left_semi").dropDuplicates(["node"]), "sets")
        passes = F.pandas_udf(lambda a, b: a.combine(b, test), "boolean")
        out = written(
            pairs.join(own.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
            .join(own.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
            .where(passes("a", "b"))
            .select("u", "v"),
            name,
        )
        drop_written(own)
        drop_written(wanted)
        return out

    possible = those(pairs, may_be_alike, "possible", rows.select("node", F.col("low").alias("shingles")))
    found = those(possible, alike, "alike", map_batches(texts, "node long, shingles binary", whole))
    drop_written(possible)
    return found


def index_pairs(rows: DataFrame) -> DataFrame:
    """``u, v``: nodes whose fingerprints the byte-position index links, each
    fingerprint standing for the least of its nodes, and the other nodes of a
    fingerprint with that least one.  ``rows`` has node and fp."""
    owned = rows.select("node", "fp").distinct()
    least = owned.groupBy("fp").agg(F.min("node").alias("least"))
    found = links(least.select("fp")).distinct()
    of = lambda fp, node: least.select(F.col("fp").alias(fp), F.col("least").alias(node))
    across = found.withColumnsRenamed({"u": "fu", "v": "fv"}).join(of("fu", "u"), "fu").join(of("fv", "v"), "fv").select("u", "v")
    within = owned.join(least, "fp").select(F.col("least").alias("u"), F.col("node").alias("v"))
    pairs = across.union(within).where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return pairs.distinct()


def _near_roots(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, root`` of the shingle sets of ``texts`` (column ``text``) that are
    reachable over pairs at 0.8 or more; ``rows`` has node, fingerprint, first
    prefix and low part of each.

    First the pairs that the byte-position index links are compared.  Then the
    sets of a posting of the prefix filter are compared with two leaders of it
    that are in other groups, which settles most groups.  Then all pairs of a
    posting that are still in different groups are compared, so every pair at 0.8
    ends in one group.
    """
    first = written(index_pairs(rows), "first")
    indexed = components(_alike_pairs(first, rows, texts))
    drop_written(first)
    common = _common_shingles(rows, texts)

    def work(batch):
        nodes, sizes, scores, keys, rest = [], [], [], [], [np.zeros(0, np.int32)]
        for x in map(shingle_set, batch["text"]):
            nodes.append(node_of(x))
            sizes.append(len(x))
            scores.append(float(_among(x, common).mean()) if len(x) else 0.0)
            keys.append(prefix_of(x, common).view(np.int64))
            rest.append(len(x) - np.arange(len(keys[-1]), dtype=np.int32))
        reps = [len(k) for k in keys]
        spread = lambda v, t: np.repeat(np.array(v, t), reps)
        return {
            "key": pa.array(np.concatenate([np.zeros(0, np.int64), *keys]), pa.int64()), "node": pa.array(spread(nodes, np.int64)),
            "size": pa.array(spread(sizes, np.int32)), "rest": pa.array(np.concatenate(rest), pa.int32()), "score": pa.array(spread(scores, np.float32)),
        }

    posted = map_batches(texts, "key long, node long, size int, rest int, score float", work).repartition("key")
    # The set with most common shingles is the likely original of its copies.
    leader = F.struct("node", "size", "rest")
    live = posted.groupBy("key").agg(
        F.min("node").alias("lo"), F.max("node").alias("hi"),
        F.max_by(leader, F.struct("score", "node")).alias("l0"), F.min_by(leader, F.xxhash64("node")).alias("l1"),
    ).where("lo != hi")
    postings = written(posted.join(live, "key").select("key", "node", "size", "rest", "l0", "l1").distinct(), "postings")
    root_of = lambda end, root: indexed.select(F.col("node").alias(end), F.col("root").alias(root))
    led = written(
        postings.select("node", "size", "rest", F.explode(F.array("l0", "l1")).alias("o"))
        .where(f"node != o.node AND {MEETS.format(m='size', n='o.size', i='rest', j='o.rest')}")
        .select(F.least("node", "o.node").alias("u"), F.greatest("node", "o.node").alias("v"))
        .distinct()
        .join(root_of("u", "ru"), "u", "left")
        .join(root_of("v", "rv"), "v", "left")
        .where("coalesce(ru, u) != coalesce(rv, v)")
        .select("u", "v"),
        "led",
    )
    grouped_by_index = indexed.select(F.col("node").alias("u"), F.col("root").alias("v"))
    roots = components(_alike_pairs(led, rows, texts).union(grouped_by_index))

    grouped = written(postings.drop("l0", "l1").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "grouped")
    drop_written(postings)
    mixed = grouped.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key")
    left = written(grouped.join(mixed, "key"), "open")
    drop_written(grouped)
    right = left.select("key", *[F.col(c).alias(f"{c}2") for c in ("node", "size", "rest", "root")])
    rest = (
        left.join(right, "key")
        .where(f"root < root2 AND {MEETS.format(m='size', n='size2', i='rest', j='rest2')}")
        .select(F.least("node", "node2").alias("u"), F.greatest("node", "node2").alias("v"))
        .distinct()
        .join(led, ["u", "v"], "left_anti")
    )
    rest = written(rest, "rest")
    edges = _alike_pairs(rest, rows, texts)
    for table in (left, led, rest):
        drop_written(table)
    if edges.isEmpty():
        return roots
    return components(edges.union(roots.select(F.col("node").alias("u"), F.col("root").alias("v"))))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the least id.

    Texts are near copies at a Jaccard similarity of 0.8 or more of their whole
    sets of five-word shingles, and groups are what is reachable over such
    pairs; no pair is left out.  Documents of equal sets are one node.  Empty
    texts are copies of one another.  Null ids come before others; of repeated
    rows one stays.  All columns are returned as they are.
    """

    def work(batch):
        sets, prints, none = [], [], np.zeros(0, np.uint64)
        for words in map(words_of, batch["text"]):
            sets.append(np.unique(shingle_hashes(words, SHINGLE)))
            prints.append(fingerprint(shingle_hashes(words, 3)))
        return {
            "doc_id": pa.array(batch["doc_id"], pa.int64()), "sha": pa.array(batch["sha"], pa.string()), "node": pa.array(list(map(node_of, sets)), pa.int64()),
            "fp": pa.array(prints, pa.int64()),
            "prefix": pa.array([prefix_of(x, none).tobytes() for x in sets], pa.binary()), "low": pa.array([low_part(x).tobytes() for x in sets], pa.binary()),
        }

    small_batches(docs.sparkSession)
    text = text_of(text_col)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha1(text).alias("sha"), text.alias("text"))
    rows = written(map_batches(plain, "doc_id long, sha string, node long, fp long, prefix binary, low binary", work), "nodes")
    roots = _near_roots(rows, plain.select("text"))
    owned = rows.select("doc_id", "sha", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    doc, code = fresh(docs, "_id", "_sha")
    kept = written(owned.groupBy("root").agg(F.min(F.struct("doc_id", "sha")).alias("d")).select(F.col("d.doc_id").alias(doc), F.col("d.sha").alias(code)), "kept")
    match = F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.sha1(text) == F.col(code))
    result = docs.join(kept, match, "left_semi")
    if not rows.groupBy("doc_id", "sha").count().where("count > 1").isEmpty():
        result = result.dropDuplicates([id_col, text_col])  # rows given twice
    return result
