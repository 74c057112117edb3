"""Exact token counts of every prefix (operator 4).

Method: a byte-level BPE encoding of a word's prefix is the encoding of a
shorter prefix plus one token.  Going along the word, ``last[i]`` is the only
vocabulary string that ends at ``i`` and whose pair with the last token before
it encodes to those two tokens; ``count[i] = count[i - len] + 1``.  Word counts
are then added up along the text, so that each prefix of the document has its
exact count and questions about budgets need no second encoding.
"""

from __future__ import annotations

import struct
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteBPE, Memo, vocabulary
from .common import WorkerStore, map_batches, text_of

SPACES = regex.compile(r"\s{2,}(?=\S)")
SIZES, LAST = struct.Struct("=qq"), struct.Struct("=i")
ENDINGS = ("'re", "'ve", "'ll")


class PrefixCounter:
    def __init__(self, bpe: ByteBPE):
        self.bpe = bpe
        self.fits = Memo(self._fits, longest=0)
        self.memo_words = Memo(self._word)
        self.memo = Memo(self._chunk)

    def _fits(self, pair: int) -> bool:
        """Do two tokens side by side stay as they are?  0 stands for none."""
        left, right = (pair >> 20) - 1, pair & 0xFFFFF
        data = self.bpe.bytes_of[left] if left >= 0 else b""
        return self.bpe.merge(data + self.bpe.bytes_of[right]) == ([left, right] if left >= 0 else [right])

    def _word(self, word: str) -> bytes:
        """Token counts of the prefixes of one word, by characters (packed)."""
        data, find, fits, longest = word.encode(), self.bpe.id_of.get, self.fits, self.bpe.longest
        last, count = [0], [0]  # of the last token: its id plus one, shifted
        for end in range(1, len(data) + 1):
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                token = find(data[start:end])
                if token is not None and fits[last[start] | token]:
                    last.append((token + 1) << 20)
                    count.append(count[start] + 1)
                    break
        if word in ENDINGS:  # cut short, the sign and the letter are two words
            count[2] = 2
        if len(data) != len(word):
            count = [c for i, c in enumerate(count) if i in (0, len(data)) or data[i] & 0xC0 != 0x80]
        return array("i", count[1:]).tobytes()

    def word(self, word: str) -> list[int]:
        return array("i", self.memo_words[word]).tolist()

    def _chunk(self, chunk: str) -> tuple[bytes, bytes]:
        if chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()):  # one word, the common case
            counts = self._word(chunk)
            return counts, SIZES.pack(len(chunk), *LAST.unpack(counts[-4:]))
        counts, before = array("i"), 0
        for word in self.bpe.words.findall(chunk):
            counts.extend([before + c for c in self.word(word)])
            before = counts[-1]
        return counts.tobytes(), SIZES.pack(len(counts), before)

    def ordinary(self, text: str) -> np.ndarray:
        """Counts of the prefixes of a stretch without special tokens."""
        chunks = list(map(self.memo.__getitem__, self.bpe.chunks(text)))
        inside = np.frombuffer(b"".join([c for c, _ in chunks]), np.int32)
        sizes = np.frombuffer(b"".join([s for _, s in chunks]), np.int64).reshape(-1, 2)
        counts = inside + np.repeat(np.cumsum(sizes[:, 1]) - sizes[:, 1], sizes[:, 0])
        for run in SPACES.finditer(text):
            # A prefix that ends in this run has all of the run as one word.
            start, end = run.span()
            counts[end - 1] = (counts[start - 1] if start else 0) + self.word(run[0])[-1]
        return counts

    def counts(self, text: str) -> np.ndarray:
        """``counts[i]``: tokens of the first ``i`` characters, for every ``i``."""
        parts, before = [np.zeros(1, np.int64)], 0
        pieces = self.bpe.pieces(text)
        for k, (piece, special) in enumerate(pieces):
            if special < 0:
                if piece:
                    parts.append(self.ordinary(piece) + before)
                    before = int(parts[-1][-1])
            else:
                # Inside the special string a prefix holds it as ordinary text,
                # which may join the last word before it.
                tail = pieces[k - 1][0]
                words = self.bpe.words.findall(tail)
                start = len(tail) - len(words[-1]) if words else 0
                base = before - (self.word(words[-1])[-1] if words else 0)
                cut = [base + int(self.ordinary(tail[start:] + piece[:j])[-1]) for j in range(1, len(piece))]
                before += 1
                parts.append(np.array([*cut, before], np.int64))
        return np.concatenate(parts)


@WorkerStore
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(vocabulary(path))


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, counts array<int>``: the number of tokens of each prefix of
    the text by characters, from 0 (empty prefix) to the whole text.

    Null and empty texts have the one count 0.  Repeated rows and null ids are
    kept; extra columns are dropped; an empty table gives an empty table.
    """

    def work(batch):
        counts = [counter(path).counts(t) for t in batch["text"]]
        ends = np.cumsum([0, *map(len, counts)])
        flat = np.concatenate([np.zeros(0, np.int32), *counts]).astype(np.int32)
        return {
            "doc_id": pa.array(batch["doc_id"], pa.int64()),
            "counts": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
        }

    return map_batches(_texts(docs, id_col, text_col), "doc_id long, counts array<int>", work)


def fit_to_budget(counts: DataFrame, limit: int) -> DataFrame:
    """From stored prefix counts, without the texts: the tokens of the whole
    text and the longest prefix of at most ``limit`` tokens (in characters)."""
    fits = F.expr(f"size(counts) - 1 - coalesce(array_position(transform(reverse(counts), c -> c <= {int(limit)}), true) - 1, 0)")
    return counts.select("doc_id", F.element_at("counts", -1).cast("long").alias("n_tokens"), fits.cast("long").alias("chars_within"))


def token_budget(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: bytes, tokens, whether it is over ``limit``, and the
    longest prefix (in characters) of at most ``limit`` tokens, read off the
    prefix counts inside the task, so that only answers leave it."""
    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, chars_within long"

    def work(batch):
        size, total, fits = [], [], []
        for text in batch["text"]:
            counts = counter(path).counts(text)
            size.append(len(text.encode()))
            total.append(int(counts[-1]))
            fits.append(int(np.flatnonzero(counts <= limit)[-1]))
        return {
            "doc_id": pa.array(batch["doc_id"], pa.int64()), "n_bytes": pa.array(size, pa.int64()),
            "n_tokens": pa.array(total, pa.int64()), "over_limit": pa.array([n > limit for n in total], pa.bool_()),
            "chars_within": pa.array(fits, pa.int64()),
        }

    return map_batches(_texts(docs, id_col, text_col), schema, work)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
