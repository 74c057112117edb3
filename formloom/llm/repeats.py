"""Repeated byte windows by depth-limited radix sort (operator 7).

Suffixes are ordered only through ``length`` bytes, most significant digits
first, and leave as soon as their group holds one suffix; the groups that are
left at full depth are exactly the windows that occur more than once.

The first digit is content-defined: the least hash of the window's 32-byte
grams.  Equal windows have equal digits, and neighbouring windows mostly share
theirs, so that the first pass moves one row per *run* of windows (about one in
85) and no text.  Runs whose digit occurs once leave.  Runs that are equal as a
whole are settled by their hash.  For the rest one example of each different
run is fetched, and its windows are sorted by 8-byte digits, bucket by bucket.
A bucket with too many different runs for one task is settled by counting
window hashes instead, which Spark spreads over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, fresh, map_batches, text_of, written

LENGTH = 200
GRAM = 32
#: Windows of one run; longer runs (periodic text) are cut.
LONGEST_RUN = 1024
#: Different runs of a digit up to which they are sorted in one task.
HOT = 4096
#: Windows sorted together.
SORT_BATCH = 1 << 19

DOC = "doc_id long, crc long"
RUN = f"digit long, body long, {DOC}, start int, n int, inside boolean"


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed hashes of the 32-byte grams, by doubling."""
    h, size, base = data.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while size < GRAM:
        h = h[:-size] * np.uint64(base) + h[size:]
        size, base = 2 * size, base * base & 0xFFFFFFFFFFFFFFFF
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def least_of_windows(h: np.ndarray, windows: int, length: int) -> np.ndarray:
    """The least gram hash of each window, by doubling."""
    wide, span = length - GRAM + 1, 1
    while 2 * span <= wide:
        h, span = np.minimum(h[:-span], h[span:]), 2 * span
    return np.minimum(h[:windows], h[wide - span :])


def occurring_twice(hashes: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """Those digits that are the hash of two or more grams of the text.  Only
    they can stand for two equal windows of one run."""
    low = np.zeros(1 << 16, bool)
    low[digits & np.uint64(0xFFFF)] = True
    maybe = hashes[low[hashes & np.uint64(0xFFFF)]]
    value, count = np.unique(maybe, return_counts=True)
    return np.isin(digits, value[count > 1])


def runs_of(data: bytes, length: int) -> list[tuple[int, int, int, int, bool]]:
    """``digit, body, start, n, inside`` of each run of windows with one digit;
    ``inside`` says that the run itself may hold equal windows."""
    if len(data) < length:
        return []
    hashes = gram_hashes(np.frombuffer(data, np.uint8))
    digits = least_of_windows(hashes, len(data) - length + 1, length)
    cuts = np.concatenate([[0], np.flatnonzero(digits[1:] != digits[:-1]) + 1, [len(digits)]])
    if np.diff(cuts).max() > LONGEST_RUN:
        cuts = np.unique(np.concatenate([cuts, *(np.arange(a, b, LONGEST_RUN) for a, b in zip(cuts[:-1], cuts[1:]) if b - a > LONGEST_RUN)]))
    found, edges = digits[cuts[:-1]], cuts.tolist()
    inside = occurring_twice(hashes, found).tolist()
    return [
        (d, _signed(xxhash.xxh3_64_intdigest(data[a : b + length - 1])), a, b - a, twice)
        for d, a, b, twice in zip(found.view(np.int64).tolist(), edges[:-1], edges[1:], inside)
    ]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.crc32(text).alias("crc"))


def window_runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per run of windows of ``doc_id, text, crc``."""

    def work(batch):
        out = [[] for _ in range(7)]
        for doc_id, text, crc in zip(batch["doc_id"], batch["text"], batch["crc"]):
            for digit, body, start, n, inside in runs_of(text.encode(), length):
                for column, value in zip(out, (digit, body, doc_id, crc, start, n, inside)):
                    column.append(value)
        kinds = (*[pa.int64()] * 4, pa.int32(), pa.int32(), pa.bool_())
        return {f.split()[0]: pa.array(v, t) for f, v, t in zip(RUN.split(", "), out, kinds)}

    return map_batches(docs, RUN, work)


def sort_windows(bodies: list[bytes], groups: list[int], length: int) -> list[np.ndarray]:
    """Which windows of each body occur again in a body of the same group (or
    in its own): radix passes over 8-byte digits, singles leave early."""
    text = np.frombuffer(b"".join(bodies) + bytes(8), np.uint8)
    sizes = np.array([len(b) for b in bodies])
    counts = sizes - length + 1
    first = np.cumsum(sizes) - sizes
    place = np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    group = np.repeat(np.array(groups, np.int64), counts)
    digit = np.lib.stride_tricks.sliding_window_view(text, 8).copy().view(">u8").ravel().astype(np.uint64)
    for depth in (*range(0, length - 7, 8), *([length - 8] if length % 8 else [])):
        key = digit[place + depth]
        order = np.lexsort((key, group))
        key, sorted_group = key[order], group[order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (sorted_group[1:] != sorted_group[:-1])])
        single = new & np.append(new[1:], True)
        place, group = place[order][~single], (np.cumsum(new) - 1)[~single]
        if not len(place):
            break
    again = np.zeros(len(text), bool)
    again[place] = True
    return [again[a : a + n] for a, n in zip(first.tolist(), counts.tolist())]


def intervals(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and (open) ends of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, crc, spans array<struct<lo,hi>>``: for documents that hold
    repeated windows, the windows' first starts and last ends.  Spans may touch
    or overlap.  ``docs`` has ``doc_id, text, crc``."""
    runs = written(window_runs(docs, length), "runs")
    # Digits that occur once leave; kinds counts the different runs of a digit.
    bodies = runs.groupBy("digit", "body").agg(F.count("*").alias("c"), F.max("inside").alias("inside"))
    digits = bodies.groupBy("digit").agg(F.count("*").alias("kinds"), F.sum("c").alias("all"), F.max("inside").alias("inside")).where("`all` > 1 or inside")
    equal = ((F.col("kinds") == 1) & (F.col("all") > 1)).alias("equal")
    live = written(runs.drop("inside").join(digits.select("digit", "kinds", equal), "digit"), "live-runs")
    drop_written(runs)

    mixed = live.where("not equal")
    examples = mixed.groupBy("digit", "body").agg(
        F.count("*").alias("c"), F.min(F.struct("doc_id", "crc", "start", "n")).alias("at"), F.first("kinds").alias("kinds")
    )
    wanted = examples.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.crc").alias("crc")).agg(
        F.collect_list(F.struct("digit", "body", "c", "kinds", F.col("at.start").alias("start"), F.col("at.n").alias("n"))).alias("wanted")
    )
    bodies = written(_fetch(_with_text(docs, wanted, "wanted"), length), "run-bodies")
    few, many = bodies.where(F.col("kinds") <= HOT), bodies.where(F.col("kinds") > HOT)
    settled = written(_sorted(few, length).unionByName(_counted(many, length)), "settled-runs")
    drop_written(bodies)

    whole = live.where("equal").select("doc_id", "crc", F.col("start").alias("lo"), (F.col("start") + F.col("n") + (length - 1)).alias("hi"))
    part = mixed.join(settled, ["digit", "body"]).select("doc_id", "crc", "start", F.explode(F.arrays_zip("los", "his")).alias("s"))
    part = part.select("doc_id", "crc", (F.col("start") + F.col("s.los")).alias("lo"), (F.col("start") + F.col("s.his") + (length - 1)).alias("hi"))
    return whole.unionByName(part).groupBy("doc_id", "crc").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def _with_text(docs: DataFrame, found: DataFrame, column: str, how: str = "inner") -> DataFrame:
    renamed = found.select(F.col("doc_id").alias("_id"), F.col("crc").alias("_crc"), column)
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("crc") == F.col("_crc"))
    return docs.join(renamed, match, how).drop("_id", "_crc")


def _fetch(docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted runs.  Of repeated rows each gives its bytes;
    they meet again in one bucket and are told apart by ``body``."""

    def work(batch):
        out = {"digit": [], "body": [], "c": [], "kinds": [], "data": []}
        for text, wanted in zip(batch["text"], batch["wanted"]):
            data = text.encode()
            for w in wanted:
                for k in ("digit", "body", "c", "kinds"):
                    out[k].append(w[k])
                out["data"].append(data[w["start"] : w["start"] + w["n"] + length - 1])
        return {k: pa.array(v, pa.binary() if k == "data" else pa.int64()) for k, v in out.items()}

    return map_batches(docs.select("text", "wanted"), "digit long, body long, c long, kinds long, data binary", work)


SETTLED = "digit long, body long, los array<int>, his array<int>"


def _sorted(bodies: DataFrame, length: int) -> DataFrame:
    """Buckets of up to ``HOT`` runs: several are sorted at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, bytes]] = {}
        windows, last = 0, None

        def flush():
            keys, found = list(held), list(held.values())
            flags = sort_windows([d for _, d in found], [k[0] for k in keys], length)
            cuts = [intervals(f | (c > 1)) for f, (c, _) in zip(flags, found)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([a for a, _ in cuts], pa.list_(pa.int32())),
                    pa.array([b for _, b in cuts], pa.list_(pa.int32())),
                ],
                names=["digit", "body", "los", "his"],
            )

        for batch in batches:
            for digit, body, c, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if digit != last and windows >= SORT_BATCH:
                    yield flush()
                    held, windows = {}, 0
                last = digit
                if (digit, body) not in held:
                    held[digit, body] = (c, data)
                    windows += len(data) - length + 1
        if held:
            yield flush()

    dealt = bodies.select("digit", "body", "c", "data").repartition("digit").sortWithinPartitions("digit")
    return dealt.mapInArrow(run, SETTLED)


def _counted(bodies: DataFrame, length: int) -> DataFrame:
    """Buckets with more runs: window hashes (128 bits) are counted."""

    def work(batch):
        out = {"digit": [], "body": [], "at": [], "c": [], "hi": [], "lo": []}
        for digit, body, c, data in zip(*(batch[k] for k in ("digit", "body", "c", "data"))):
            for at in range(len(data) - length + 1):
                h = xxhash.xxh3_128_intdigest(data[at : at + length])
                for k, v in zip(out, (digit, body, at, c, _signed(h >> 64), _signed(h & 0xFFFFFFFFFFFFFFFF))):
                    out[k].append(v)
        return {k: pa.array(v, pa.int64()) for k, v in out.items()}

    once = bodies.dropDuplicates(["digit", "body"])
    windows = map_batches(once.select("digit", "body", "c", "data"), "digit long, body long, at long, c long, hi long, lo long", work)
    often = windows.groupBy("hi", "lo").agg(F.sum("c").alias("n")).where("n > 1").select("hi", "lo")
    starts = windows.join(often, ["hi", "lo"]).groupBy("digit", "body").agg(F.collect_set(F.col("at").cast("int")).alias("los"))
    return starts.select("digit", "body", "los", F.transform("los", lambda x: x + 1).alias("his"))


def merge_spans(spans) -> list[list[int]]:
    """Sorted, maximal spans."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def kept_bytes(data: bytes, spans: list[list[int]]) -> bytes:
    at, parts = 0, []
    for lo, hi in spans:
        parts.append(data[at:lo])
        at = hi
    return b"".join([*parts, data[at:]])


def whole_characters(data: bytes, spans: list[list[int]]) -> list[list[int]]:
    """Spans narrowed to characters that they cover as a whole."""
    out = []
    for lo, hi in spans:
        while lo < hi and data[lo] & 0xC0 == 0x80:
            lo += 1
        while hi > lo and hi < len(data) and data[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append([lo, hi])
    return out


def removal_digests(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: bytes, removed bytes, maximal removed runs, and the SHA-256 of
    what is left when every byte of a repeated window is removed.

    Null texts are empty; texts shorter than ``length`` lose nothing.  A
    repeated row counts as another document, so both lose everything that is
    long enough.  Null ids and extra columns are fine, an empty table too.
    """
    plain = _bytes(docs, id_col, text_col)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def work(batch):
        size, removed, spans_n, digest = [], [], [], []
        for text, spans in zip(batch["text"], batch["spans"]):
            data, cut = text.encode(), merge_spans(spans or [])
            size.append(len(data))
            removed.append(sum(hi - lo for lo, hi in cut))
            spans_n.append(len(cut))
            digest.append(hashlib.sha256(kept_bytes(data, cut)).hexdigest())
        numbers = (batch["doc_id"], size, removed, spans_n)
        names = schema.replace(" long", "").replace(" string", "").split(", ")
        return dict(zip(names, (*(pa.array(v, pa.int64()) for v in numbers), pa.array(digest, pa.string()))))

    spans = written(repeated_spans(plain, length), "repeat-spans")
    return map_batches(_with_text(plain, spans, "spans", "left").select("doc_id", "text", "spans"), schema, work)


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every repeated window cut out of the text.

    The text stays valid: a character goes only if all of its bytes are in
    repeated windows.  ``n_chars``, where there is one, follows the text; all
    other columns stay as they are; a null text stays null; every row is kept.
    """
    names = docs.columns
    doc, code, found = fresh(docs, "_id", "_crc", "_spans")
    keyed = _bytes(docs, id_col, text_col)
    spans = written(repeated_spans(keyed, length), "repeat-spans").withColumnsRenamed({"doc_id": doc, "crc": code, "spans": found})

    @F.pandas_udf("string")
    def cut(texts, spans):
        def one(text, cuts):
            if text is None or cuts is None or not len(cuts):
                return text
            data = text.encode()
            return kept_bytes(data, whole_characters(data, merge_spans(cuts))).decode()

        return texts.combine(spans, one)

    match = F.col(id_col).cast("long").eqNullSafe(F.col(doc)) & (F.crc32(text_of(text_col)) == F.col(code))
    shorter = docs.join(spans, match, "left").withColumn(text_col, cut(F.col(text_col), F.col(found)))
    if "n_chars" in names:
        shorter = shorter.withColumn("n_chars", F.coalesce(F.char_length(text_col), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return shorter.select(*names)
