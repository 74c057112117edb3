"""Token ids in grammar-compressed binary shards (operator 1).

Method: Re-Pair per segment.  Each round counts the pairs of neighbouring
symbols, makes rules for the most frequent ones and replaces their occurrences
from left to right; a pair that starts with the end id is never replaced, so no
rule spans two documents.  Rules and their expansion lengths are stored, so any
range of ids is decoded without the rest.

A segment is one binary value::

    magic "RPT1" | uint32 n_docs, n_rules, n_symbols, first_rule
    int64 doc_ids[n_docs] | uint8 id_null[n_docs] | int64 ends[n_docs]   ids up to and with each document
    uint32 left[n_rules], right[n_rules], length[n_rules]
    uint32 symbols[n_symbols]                        narrow (uint16) if first_rule + n_rules <= 65536

Segments hold whole documents in ascending ``doc_id`` order (null ids first)
and are rows ``shard, segment, n_docs, n_ids, payload`` of Parquet files, so
they are written through Spark's committer and outlive lost executors.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.operators.ranking import running

from .bpe import Memo
from .common import WorkerStore, map_batches, shared_path, text_of

WORD_BPE = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"RPT1"
HEAD = struct.Struct("<4s4I")

#: A segment is closed at the first document end past so many ids.
SEGMENT_IDS = 1 << 20
#: Documents of one shard (a range of doc_id), and the most shards: beyond
#: that shards hold more documents, since each is sorted and streamed.
SHARD_DOCS, MOST_SHARDS = 2048, 1 << 16
#: Grammar: rules made in a round, and occurrences that a rule needs; rounds go
#: on until no pair has as many.
RULES_A_ROUND, LEAST = 4096, 8


#: A stop or comma that stands with another sign, where it is no word of its own.
SIGN_RUN = re.compile(r"(?:[^\w \n]|_)[.,]|[.,](?:[^\w \n]|_)")
#: The same for Latin-1 text, of which each byte is put in lower case and told
#: apart: stop or comma ("."), other sign ("!"), letter, digit or gap ("a").
LATIN = bytes(range(256)).decode("latin-1")
LOWER = LATIN.lower().encode("latin-1")
KINDS = "".join("." if c in ".," else "!" if re.match(r"[^\w \n]|_", c) else "a" for c in LATIN).encode()
SIGN_RUNS = (b"..", b".!", b"!.")


def pieces_of(text: str) -> list[str]:
    """Pieces between blanks or line ends, which the tokenizer drops and never
    merges across.  Two steps make more pieces alike and change no id: Latin-1
    text is put in lower case (as the tokenizer does, character by character),
    and a stop or comma after a word, which it takes as a word, is cut off."""
    if "<|" not in text:  # special tokens are taken as written
        try:
            latin = text.encode("latin-1").translate(LOWER)
            text, kinds = latin.decode("latin-1"), latin.translate(KINDS)
            run = any(r in kinds for r in SIGN_RUNS)
        except UnicodeEncodeError:
            # Some letters become a letter and a mark when they are normalised or
            # put in lower case, and the mark joins a stop that follows.
            run = SIGN_RUN.search(unicodedata.normalize("NFC", text).lower())
        if not run:
            text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " . ")
    return text.replace("\n", " ").split(" ")


class WordEncoder:
    """The ``tokenizers`` library over pieces, which are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark fills the cores
        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        self.memo = Memo(lambda piece: array("I", self.lib.encode(piece, add_special_tokens=False).ids).tobytes(), limit=600_000)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed uint32 ids of whole texts; new pieces go to the library in
        one call."""
        split = list(map(pieces_of, texts))
        known = [list(map(self.memo.get, pieces)) for pieces in split]
        gaps = list(map(_gaps, known))
        new = {pieces[i] for pieces, gap in zip(split, gaps) for i in gap}
        new = [p for p in new if p not in self.memo.old]
        if len(self.memo) + len(new) > self.memo.limit:  # as the store does piece by piece
            self.memo.old = dict(self.memo)
            self.memo.clear()
        for piece, ids in zip(new, self.lib.encode_batch_fast(new, add_special_tokens=False)):
            self.memo[piece] = array("I", ids.ids).tobytes()
        for pieces, found, gap in zip(split, known, gaps):
            for i in gap:
                found[i] = self.memo[pieces[i]]
        return list(map(b"".join, known))


def _gaps(found: list) -> list[int]:
    out, at = [], -1
    try:
        while True:
            at = found.index(None, at + 1)
            out.append(at)
    except ValueError:
        return out


@WorkerStore
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def repair(ids: np.ndarray, first_rule: int, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """``symbols, rules`` of a sequence: rule ``r`` stands for symbol
    ``first_rule + r`` and is a row (left, right)."""
    symbols, rules = ids.astype(np.uint32), []
    # A pair's count only falls, so after the first round those with a symbol of
    # the round before are counted, and the frequent ones that were left over.
    last, over = 0, None
    while True:
        narrow = first_rule + len(rules) <= 1 << 16
        shift, kind = (16, np.uint32) if narrow else (32, np.uint64)
        fresh = symbols >= last
        asked = fresh[:-1] | fresh[1:]
        if over is not None:
            asked |= over[0][symbols[:-1]] & over[1][symbols[1:]]
        asked = np.flatnonzero(asked & (symbols[:-1] != end_id))
        first, second = symbols[asked], symbols[asked + 1]
        pairs = (first.astype(kind) << kind(shift)) | second
        ordered = np.sort(pairs)
        if not len(ordered):
            break
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(starts, len(ordered)))
        often = np.flatnonzero(counts >= LEAST)
        if not len(often):
            break
        order = often[np.argsort(-counts[often], kind="stable")]
        best, others = order[:RULES_A_ROUND], ordered[starts[order[RULES_A_ROUND:]]]
        chosen = np.sort(ordered[starts[best]])
        sides = lambda p: ((p >> kind(shift)).astype(np.int64), (p & kind((1 << shift) - 1)).astype(np.int64))
        left, right = sides(chosen)
        last, over = first_rule + len(rules), None
        if len(others):
            over = np.zeros((2, last + len(chosen)), bool)
            for side, of_others in zip(over, sides(others)):
                side[of_others] = True
        is_left, is_right = (np.zeros(first_rule + len(rules) + 1, bool) for _ in range(2))
        is_left[left], is_right[right] = True, True
        may = np.flatnonzero(is_left[first] & is_right[second])
        where, pairs = asked[may], pairs[may]
        at = np.searchsorted(chosen, pairs)
        at[at == len(chosen)] = 0
        hit = chosen[at] == pairs
        where, at = where[hit], at[hit]
        # Of overlapping occurrences the first, third, ... of each run are taken.
        new_run = np.concatenate([[True], np.diff(where) > 1])
        run_start = where[np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))]
        odd = (where - run_start) % 2 == 0
        taken = where[odd]
        symbols[taken] = first_rule + len(rules) + at[odd]
        keep = np.ones(len(symbols), bool)
        keep[taken + 1] = False
        symbols = symbols[keep]
        rules += zip(left.tolist(), right.tolist())
    return symbols, np.array(rules, np.uint32).reshape(-1, 2)


def expansion_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids that each rule stands for; a rule only uses earlier ones."""
    length: list[int] = []
    for left, right in rules.tolist():
        length.append(
            (length[left - first_rule] if left >= first_rule else 1)
            + (length[right - first_rule] if right >= first_rule else 1)
        )
    return np.array(length, np.uint32)


def pack_segment(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray, first_rule: int) -> bytes:
    symbols, rules = repair(ids, first_rule)
    width = np.uint16 if first_rule + len(rules) <= 1 << 16 else np.uint32
    return b"".join((
        HEAD.pack(MAGIC, len(doc_ids), len(rules), len(symbols), first_rule),
        np.array([d or 0 for d in doc_ids], np.int64).tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.cumsum(np.array(sizes, np.int64)).tobytes(),
        rules[:, 0].tobytes(),
        rules[:, 1].tobytes(),
        expansion_lengths(rules, first_rule).tobytes(),
        symbols.astype(width).tobytes(),
    ))


class Segment:
    """Reads one segment; ``ids(lo, hi)`` expands that range alone."""

    def __init__(self, payload: bytes):
        self._flat = None
        magic, docs, rules, symbols, self.first_rule = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = HEAD.size

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        doc_ids, null = take(np.int64, docs), take(np.uint8, docs)
        self.doc_ids = [None if n else int(d) for d, n in zip(doc_ids, null)]
        self.ends = take(np.int64, docs)
        self.left, self.right, self.length = (take(np.uint32, rules) for _ in range(3))
        self.symbols = take(np.uint16 if self.first_rule + rules <= 1 << 16 else np.uint32, symbols)
        sizes = np.ones(symbols, np.int64)
        made = self.symbols >= self.first_rule
        sizes[made] = self.length[self.symbols[made].astype(np.int64) - self.first_rule]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])

    def ids(self, lo: int, hi: int) -> np.ndarray:
        if hi <= lo:
            return np.zeros(0, np.uint32)
        a = np.searchsorted(self.offsets, lo, "right") - 1
        b = np.searchsorted(self.offsets, hi, "left")
        out = self.symbols[a:b]
        flat, base, sizes = self.expansions()
        size = sizes[out]
        place = np.cumsum(size) - size
        grown = flat[np.repeat(base[out] - place, size) + np.arange(int(size.sum()))]
        skip = lo - int(self.offsets[a])
        return grown[skip : skip + hi - lo]

    def expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all symbols one after the other, where each symbol's begin,
        and how many they are."""
        if self._flat is None:
            flat = np.stack([self.left, self.right], axis=1).reshape(-1)
            while len(at := np.flatnonzero(flat >= self.first_rule)):
                rule, size = flat[at] - self.first_rule, np.ones(len(flat), np.int64)
                size[at] = 2
                start = (np.cumsum(size) - size)[at]
                flat = np.repeat(flat, size)
                flat[start], flat[start + 1] = self.left[rule], self.right[rule]
            sizes = np.concatenate([np.ones(self.first_rule, np.int64), self.length.astype(np.int64)])
            self._flat = np.concatenate([np.arange(self.first_rule, dtype=np.uint32), flat]), np.cumsum(sizes) - sizes, sizes
        return self._flat

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def write_shards(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text, append ``end_id``, and write segments.

    Texts are encoded where they are read; only packed ids are shuffled, to
    shards cut by ranges of doc_id (null ids lead).  A shard is streamed, so a
    task holds one segment.  Repeated doc_ids stay in one shard, ordered by
    their ids.  Null texts are empty documents: they hold the end id alone.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    shards = min(MOST_SHARDS, max(1, -(-plain.count() // SHARD_DOCS)))
    cuts = np.array(sorted(set(plain.select("doc_id").approxQuantile("doc_id", [i / shards for i in range(1, shards)], 0.1 / shards))) if shards > 1 else [])
    first_rule = _vocabulary_size(path)

    def encode(batch):
        ids = [b + struct.pack("<I", end_id) for b in encoder(path).encode(batch["text"])]
        if first_rule <= 1 << 16:
            ids = [np.frombuffer(b, np.uint32).astype(np.uint16).tobytes() for b in ids]
        shard = np.searchsorted(cuts, [-np.inf if d is None else d for d in batch["doc_id"]], "right")
        return {
            "shard": pa.array(shard, pa.int32()),
            "doc_id": pa.array(batch["doc_id"], pa.int64()),
            "ids": pa.array(ids, pa.binary()),
        }

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.uint16 if first_rule <= 1 << 16 else np.uint32
        at, segment, docs_, sizes, parts, total = None, 0, [], [], [], 0

        def close():
            nonlocal segment, docs_, sizes, parts, total
            payload = pack_segment(docs_, sizes, np.frombuffer(b"".join(parts), width), first_rule)
            row = [[at], [segment], [len(docs_)], [total], [payload]]
            segment, docs_, sizes, parts, total = segment + 1, [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["shard", "segment", "n_docs", "n_ids", "payload"])

        for batch in batches:
            for shard, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != at:
                    if docs_:
                        yield close()
                    at, segment = shard, 0
                docs_.append(doc_id)
                sizes.append(len(ids) // np.dtype(width).itemsize)
                parts.append(ids)
                total += sizes[-1]
                if total >= SEGMENT_IDS:
                    yield close()
        if docs_:
            yield close()

    encoded = map_batches(plain, "shard int, doc_id long, ids binary", encode)
    (
        encoded.repartition(shards, "shard")
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
        .mapInArrow(compress, "shard int, segment int, n_docs long, n_ids long, payload binary")
        .write.parquet(folder)
    )


def read_shards(segments: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files.

    ``start`` counts the ids of all documents before: one sum per segment is
    run along the segments, in two levels.
    """
    sizes = segments.select("shard", "segment", "n_ids")
    starts = segment_starts(sizes)

    def work(batch):
        out = {"shard": [], "segment": [], "doc_id": [], "offset": [], "n_tokens": [], "ids_crc32": []}
        for shard, number, payload in zip(batch["shard"], batch["segment"], batch["payload"]):
            segment = Segment(payload)
            ids, lo = segment.ids(0, int(segment.ends[-1])).astype("<u4"), 0
            for doc_id, hi in zip(segment.doc_ids, segment.ends.tolist()):
                for k, v in zip(out, (shard, number, doc_id, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()))):
                    out[k].append(v)
                lo = hi
        kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 4)
        return {k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)}

    found = map_batches(
        segments.select("shard", "segment", "payload"),
        "shard int, segment int, doc_id long, offset long, n_tokens long, ids_crc32 long",
        work,
    )
    return found.join(starts.hint("merge"), ["shard", "segment"]).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def segment_starts(sizes: DataFrame) -> DataFrame:
    """``shard, segment, before``: ids of all segments before.

    Segments are summed up to shards and shards (one row for some thousand
    documents) are run along in blocks.
    """
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = running(shards.withColumn("rank", F.col("shard") + 1).withColumn("all", F.lit(0)), ["all"], F.col("n"), "before", exclusive=True)
    inside = F.sum("n_ids").over(_along())
    return (
        sizes.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(before.select("shard", "before"), "shard")
        .select("shard", "segment", (F.col("before") + F.col("inside")).alias("before"))
    )


def _along():
    return Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)


def tokenise_to_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards into the shared folder, and read them back."""
    spark = docs.sparkSession
    folder = shared_path(spark, "token-shards")
    write_shards(docs, folder, path, id_col, text_col)
    schema = "shard int, segment int, n_docs long, n_ids long, payload binary"
    return read_shards(spark.read.schema(schema).parquet(folder))


def _vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab().values()) + 1


def default_path() -> str:
    return public_tokenizers.path(WORD_BPE)
