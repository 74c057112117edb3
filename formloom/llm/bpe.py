"""BPE encoding and decoding of whole texts (operator 9).

Method: the symbols of a word form a doubly linked list; a heap holds
``(merge rank, left symbol)``; entries whose symbols have changed since they
were pushed are stale and skipped.  Decoding concatenates vocabulary strings.
The vocabulary comes from a ``tokenizers`` JSON file; nothing is trained.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WorkerStore, map_batches, text_of

BYTE_BPE = "byte_bpe_50k.json"

# How byte-level BPE cuts a text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: White space other than blank and line end, which only the pattern above cuts.
OTHER_SPACE = re.compile(r"[^\S \n]")

#: The same cut for blanks and line ends alone; letters, digits and signs that
#: stand together stay together here and are parted by the pattern above.
CHUNKS = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]")

#: Words kept by a worker, so that memory does not follow the corpus.
REMEMBERED = 400_000
LONGEST_KEPT = 64


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level BPE."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Memo(dict):
    """A word store of bounded size: ``make`` fills in what is missing.  When
    it is full it becomes the old generation, from which used words return.
    Words of more than ``longest`` characters are not kept (0: keys have no
    length), so the store is bounded in bytes as well."""

    def __init__(self, make, limit: int = REMEMBERED, longest: int = LONGEST_KEPT):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, word):
        if self.longest and len(word) > self.longest:
            return self.make(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        found = self.old.get(word)
        self[word] = found = self.make(word) if found is None else found
        return found


class ByteBPE:
    """A byte-level BPE vocabulary and its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.id_of = {to_bytes(token): i for token, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.decimal = {i: str(i) for i in self.bytes_of}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {}
        for rank, (a, b) in enumerate(merges):
            pair = (vocab[a], vocab[b])
            self.merges.setdefault(pair, (rank, vocab[a + b]))
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        self.words = regex.compile(WORDS)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.longest = max(map(len, self.id_of))

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word, by a queue of merge ranks."""
        if word in self.id_of and len(word) == 1:
            return [self.id_of[word]]
        symbol = [self.single[b] for b in word]
        n = len(symbol)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            if found := self.merges.get((symbol[i], symbol[i + 1])):
                queue.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, made = heapq.heappop(queue)
            j = after[i] if symbol[i] == left else n
            if j >= n or symbol[j] != right:
                continue  # stale: a symbol has been merged since
            symbol[i], symbol[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if found := self.merges.get((made, symbol[k])):
                    heapq.heappush(queue, (found[0], i, made, symbol[k], found[1]))
            h = before[i]
            if h >= 0 and (found := self.merges.get((symbol[h], made))):
                heapq.heappush(queue, (found[0], h, symbol[h], made, found[1]))
        return [s for s in symbol if s >= 0]

    def pieces(self, text: str) -> list[tuple[str, int]]:
        """Ordinary stretches (id -1) and special tokens, in text order."""
        out, at = [], 0
        if self.specials and "<" in text:
            for hit in self.specials.finditer(text):
                out += [(text[at : hit.start()], -1), (hit[0], self.special[hit[0]])]
                at = hit.end()
        return [*out, (text[at:], -1)]

    def chunks(self, text: str) -> list[str]:
        """Cut an ordinary stretch where two words always part, so that each
        chunk can be encoded alone (and remembered)."""
        if OTHER_SPACE.search(text):
            return self.words.findall(text)
        return CHUNKS.findall(text)

    def encode(self, text: str, memo: Memo) -> np.ndarray:
        """Ids of a whole text; ``memo`` maps words to packed ids."""
        parts = []
        for piece, special in self.pieces(text):
            if special >= 0:
                parts.append(np.uint32(special).tobytes())
            else:
                parts += map(memo.__getitem__, self.chunks(piece))
        return np.frombuffer(b"".join(parts), np.uint32)

    def encode_chunk(self, chunk: str) -> list[int]:
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):  # one word, the common case
            return self.merge(chunk.encode())
        return [i for word in self.words.findall(chunk) for i in self.merge(word.encode())]

    def pack(self, chunk: str) -> bytes:
        return array("I", self.encode_chunk(chunk)).tobytes()

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@WorkerStore
def vocabulary(path: str) -> ByteBPE:
    """One per worker process and file."""
    return ByteBPE(path)


@WorkerStore
def packed_words(path: str) -> Memo:
    return Memo(vocabulary(path).pack)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text.

    Null and empty texts have no ids.  A null id, repeated rows and extra
    columns are carried as they are (extra columns are dropped); an empty
    table gives an empty table.  Strings of special tokens inside a text become
    those tokens.
    """

    def work(batch):
        bpe, memo = vocabulary(path), packed_words(path)
        ids = [bpe.encode(text, memo).tolist() for text in batch["text"]]
        return {"doc_id": _long(batch["doc_id"]), "ids": _ints(ids)}

    return map_batches(_texts(docs, id_col, text_col), "doc_id long, ids array<int>", work)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, text`` from ``ids``; ids outside the vocabulary are an error."""

    def work(batch):
        bpe = vocabulary(path)
        return {"doc_id": _long(batch["doc_id"]), "text": _strings([bpe.decode(ids or []) for ids in batch["ids"]])}

    return map_batches(encoded.select(F.col(id_col).cast("long").alias("doc_id"), "ids"), "doc_id long, text string", work)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``n_tokens``, SHA-256 of the decimal ids joined by commas,
    and SHA-256 of the text decoded from them.

    Encodes and decodes in one pass, so ids (several times the size of the
    text as numbers) never leave the task.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def work(batch):
        bpe, memo = vocabulary(path), packed_words(path)
        counts, ids_digest, text_digest = [], [], []
        for text in batch["text"]:
            ids = bpe.encode(text, memo).tolist()
            counts.append(len(ids))
            ids_digest.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
            text_digest.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return {
            "doc_id": _long(batch["doc_id"]), "n_tokens": _long(counts),
            "ids_sha256": _strings(ids_digest), "decoded_sha256": _strings(text_digest),
        }

    return map_batches(_texts(docs, id_col, text_col), schema, work)


def default_path() -> str:
    return public_tokenizers.path(BYTE_BPE)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))


def _long(values):
    return pa.array(values, pa.int64())


def _ints(values):
    return pa.array(values, pa.list_(pa.int32()))


def _strings(values):
    return pa.array(values, pa.string())
