"""Phrase collocation mining over broadcast double-array tries (operator 12).

Method: level by level, a phrase can be frequent only if its parts are.

1. Words are counted by language; the frequent ones become a bitmap of hashes.
2. For two words and more, each shard counts the hashes of those phrases whose
   two shorter parts are in the bitmap of the level before; hashes that reach
   the least count make the next bitmap.  A hash shared by several phrases only
   lets too many through, so every frequent phrase stays.
3. The phrases behind those hashes are the Apriori-safe candidates.  They are
   dealt evenly (by a hash of the whole phrase, so a common first word is no hot
   key) to tries of at most ``TRIE_PHRASES`` phrases, each built by a task as a
   double array.
4. Tries are broadcast, ``TRIES_A_PASS`` at a time.  Each shard moves the states
   of all text positions at once through a trie with numpy, one word after the
   other, and counts accepting states; the vectors of counts are summed over
   shards and are exact.

A word is a transition of two digits, so the alphabet of the array stays small.
What is broadcast is bounded: a bitmap has ``2 ** BITMAP_BITS`` bits, and a pass
holds so many tries.  Texts are worked on in chunks of whole words, so one very
long text needs no more memory than many short ones.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_written, small_batches, text_of, written

LEAST, MOST_WORDS, TOP = 10, 3, 2000
#: A phrase is dropped if a longer one has at least this share (in percent).
INSIDE_PERCENT = 50
BITMAP_BITS = 26
TRIE_PHRASES, TRIES_A_PASS = 1 << 20, 4
#: Bytes of a chunk, hashes or words held by a task, words a worker remembers.
CHUNK, HELD, REMEMBERED = 1 << 22, 1 << 22, 1 << 18
NO_LANG = "und"

# What ends a piece, and what parts words.
PIECE_ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
#: Stands for the end of a piece; no UTF-8 text holds this byte.
END = b"\xff"
TABLE = bytes(0xFF if b in PIECE_ENDS else 0x20 if b in GAPS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def chunks(text: bytes, halo: int) -> Iterator[tuple[list[bytes], int]]:
    """Words (and ends of pieces) of a translated text, a chunk at a time, with
    the number of those that begin there: the others, ``halo`` at most, are
    the beginning of the next chunk."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + CHUNK)
        end = len(text) if end < 0 else end
        own = text[at:end].split()
        after, stop = [], end
        while len(after) < halo and stop < len(text):
            stop = text.find(b" ", stop + 1)
            stop = len(text) if stop < 0 else stop
            after = text[end:stop].split()
        yield own + after[:halo], len(own)
        at = end


def by_language(batches: Iterator[pa.RecordBatch], halo: int) -> Iterator[tuple[str, list[bytes], int]]:
    """Chunks of the texts of each language; columns are language and text."""
    held: dict[str, list[bytes]] = {}
    sizes: Counter = Counter()

    def flush(lang):
        joined = END.join(held.pop(lang)).translate(TABLE).replace(END, b" " + END + b" ")
        del sizes[lang]
        for words, own in chunks(joined, halo):
            yield lang, words, own

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            lang, data = lang.as_py(), text.as_buffer().to_pybytes()
            held.setdefault(lang, []).append(data)
            sizes[lang] += len(data) + 1
            if sizes[lang] >= CHUNK:
                yield from flush(lang)
    for lang in list(held):
        yield from flush(lang)


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def texts_of(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(text_col).alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of single words, summed over shards."""

    def count(batches):
        held: dict[str, Counter] = {}

        def flush():
            for lang, counter in held.items():
                counter.pop(END, None)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counter), pa.string()), _strings(list(counter)), pa.array(list(counter.values()), pa.int64())], names=["lang", "phrase", "n"])
            held.clear()

        for lang, words, own in by_language(batches, 0):
            held.setdefault(lang, Counter()).update(words[:own])
            if sum(map(len, held.values())) > HELD:
                yield from flush()
        yield from flush()

    return texts.mapInArrow(count, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def bitmap(hashes: DataFrame) -> np.ndarray:
    """One bit for every residue of column ``h``, as bytes: at most
    ``2 ** BITMAP_BITS`` bits reach the driver, whatever the table."""
    bit = F.col("h").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)) + 1
    grouped = hashes.select(bit.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("at"))
    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for row in grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("bits")).toLocalIterator():
        bits = np.frombuffer(row["bits"], np.uint8)
        first = (row["at"] - 1) * len(bits)
        out[first : first + len(bits)] = bits[: len(out) - first]
    return out


def _in(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.int64((1 << BITMAP_BITS) - 1)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Words(dict):
    """Numbers of words in the order of their first use, with their hashes; as
    many as ``REMEMBERED``, after which a chunk starts anew."""

    def __init__(self, lang: str):
        super().__init__()
        self.seed, self.hashes = lang.encode() + b" ", array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.hashes)
        self.hashes.append(xxhash.xxh64_intdigest(self.seed + word, 42))
        return at


class Numbered:
    """The word numbers of chunks, language by language."""

    def __init__(self):
        self.langs: dict[str, Words] = {}

    def __call__(self, lang: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and hashes of the words; the end of a piece has number 0."""
        if sum(map(len, self.langs.values())) > REMEMBERED:
            self.langs.clear()
        known = self.langs.get(lang)
        if known is None:
            known = self.langs[lang] = Words(lang)
            known[END]
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return ids, np.array(known.hashes).view(np.int64)[ids]


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase that has one word more."""
    mixed = h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + word.view(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def levels(ids: np.ndarray, words: np.ndarray, bitmaps: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For two words and more: hashes of the phrases at all positions, and
    whether both parts that are a word shorter are in the bitmap before."""
    h, safe = words, (ids != 0) & _in(bitmaps[0], words)
    for k, bits in enumerate([*bitmaps[1:], None], start=2):
        h = _longer(h[:-1], words[k - 1 :])
        both = safe[:-1] & safe[1:]
        yield h, both
        if bits is not None:
            safe = both & _in(bits, h)


def _hash_counts(texts: DataFrame, bitmaps: list[np.ndarray]) -> DataFrame:
    """``h, n``: counts of the hashes of safe phrases, one word longer than the
    last bitmap's."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmaps)
    size = len(bitmaps) + 1

    def count(batches):
        held, numbered = [], Numbered()

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n.astype(np.int64))], names=["h", "n"])

        for lang, words, own in by_language(batches, size - 1):
            if len(words) >= size:
                h, safe = list(levels(*numbered(lang, words), shared.value))[-1]
                held.append(h[:own][safe[:own]])
                if sum(map(len, held)) > HELD:
                    yield flush()
        if held:
            yield flush()

    return texts.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _first_places(h: np.ndarray, ids: np.ndarray, size: int, places: np.ndarray) -> np.ndarray:
    """One place of each different phrase.  Equal hashes are compared word by
    word, and what differs goes another round."""
    out = []
    while len(places):
        group, kinds = pd.factorize(h[places])
        first = np.empty(len(kinds), np.int64)
        first[group[::-1]] = places[::-1]
        out.append(first)
        lead = first[group]
        same = np.ones(len(places), bool)
        for k in range(size):
            same &= ids[places + k] == ids[lead + k]
        places = places[~same]
    return np.concatenate(out) if out else places


def _phrases(texts: DataFrame, bitmaps: list[np.ndarray]) -> DataFrame:
    """``h, lang, phrase`` of phrases that all bitmaps let through, in which
    every frequent one is found; repeats are left to the caller."""
    shared = texts.sparkSession.sparkContext.broadcast(bitmaps)
    most = len(bitmaps)

    def find(batches):
        numbered = Numbered()
        for lang, words, own in by_language(batches, most - 1):
            ids, hashes = numbered(lang, words)
            for size, (h, safe) in enumerate(levels(ids, hashes, shared.value[:-1]), start=2):
                safe = safe & _in(shared.value[size - 1], h) if len(h) else safe
                places = _first_places(h, ids, size, np.flatnonzero(safe[:own]))
                if len(places):
                    texts_ = _strings([b" ".join(words[p : p + size]) for p in places.tolist()])
                    yield pa.RecordBatch.from_arrays([pa.array(h[places]), pa.array([lang] * len(places), pa.string()), texts_], names=["h", "lang", "phrase"])

    return texts.mapInArrow(find, "h long, lang string, phrase string")


class Trie:
    """A double array over words of two digits; the language is the first word.

    ``base[s] + digit`` is the slot of a state's child, and ``check`` of that
    slot names the state if the child exists.
    """

    def __init__(self, langs: list[str], words: list[bytes], bits: int, base: np.ndarray, check: np.ndarray, accept: np.ndarray):
        self.langs = {name: i for i, name in enumerate(langs, start=1)}
        self.symbols = {w: i for i, w in enumerate(words, start=1 + len(langs))}
        self.bits, self.base, self.check, self.accept = bits, base, check, accept

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """States after a word, -1 where there is none."""
        out = np.full(len(state), -1, np.int64)
        half = self.base[state] + (symbol >> self.bits)
        on = np.flatnonzero(self.check[half] == state)
        half = half[on]
        whole = self.base[half] + (symbol[on] & ((1 << self.bits) - 1))
        found = self.check[whole] == half
        out[on[found]] = whole[found]
        return out

    def first(self, lang: str, symbols: np.ndarray) -> np.ndarray:
        """States after the language and each of these words."""
        start = self.langs.get(lang, 0)
        state = self.step(np.zeros(1, np.int64), np.full(1, start, np.int64))
        return self.step(np.repeat(state, len(symbols)), symbols) if state[0] >= 0 else np.full(len(symbols), -1, np.int64)

    def matches(self, first: np.ndarray, symbols: np.ndarray, ids: np.ndarray, own: int, most: int) -> Iterator[np.ndarray]:
        """Numbers of the phrases that begin at the first ``own`` positions, one
        array for each length.  ``ids`` are word numbers, ``symbols`` and
        ``first`` the symbol and the first state of each number."""
        states = first[ids[:own]]
        places = np.flatnonzero(states >= 0)
        states = states[places]
        padded = np.append(symbols[ids], np.zeros(most, np.int64))
        for k in range(1, most):
            states = self.step(states, padded[places + k])
            alive = states >= 0
            places, states = places[alive], states[alive]
            found = self.accept[states]
            yield found[found >= 0]


def _digits(codes: np.ndarray, bits: int) -> np.ndarray:
    """Two digits a word, -1 beyond a phrase's end."""
    out = np.empty((len(codes), 2 * codes.shape[1]), np.int64)
    out[:, ::2] = np.where(codes < 0, -1, codes >> bits)
    out[:, 1::2] = np.where(codes < 0, -1, codes & ((1 << bits) - 1))
    return out


def _codes(langs: list[str], phrases: list[bytes]) -> tuple[np.ndarray, list[str], list[bytes]]:
    """Symbols of each phrase (its language first, -1 beyond its end), and what
    they stand for: languages, then words from the most common one down."""
    sizes = np.array([p.count(b" ") + 1 for p in phrases])
    of_word, words = pd.factorize(np.array(b" ".join(phrases).split(b" "), object))
    of_lang, names = pd.factorize(np.array(langs, object))
    order = np.argsort(-np.bincount(of_word), kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(names) + 1, len(names) + 1 + len(order))
    codes = np.full((len(phrases), 1 + int(sizes.max())), -1, np.int64)
    codes[:, 0] = of_lang + 1
    starts = np.cumsum(sizes) - sizes
    for k in range(int(sizes.max())):
        on = np.flatnonzero(sizes > k)
        codes[on, k + 1] = number[of_word[starts[on] + k]]
    return codes, list(names), words[order].tolist()


def _edges(digits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parent, digit and child of every edge, in the order of parent and digit
    within a depth, and the last node of each row.  Node 0 is the root."""
    order = np.lexsort(digits.T[::-1])
    rows = digits[order]
    node, nodes = np.zeros(len(rows), np.int64), 1
    new = np.zeros(len(rows), bool)
    new[0] = True
    parents, labels, children = [], [], []
    for depth in range(rows.shape[1]):
        new = new.copy()
        new[1:] |= rows[1:, depth] != rows[:-1, depth]
        here = rows[:, depth] >= 0
        first = here & new
        number = nodes - 1 + np.cumsum(first)
        parents.append(node[first])
        labels.append(rows[first, depth])
        children.append(number[first])
        node = np.where(here, number, node)
        nodes += int(first.sum())
    last = np.empty(len(rows), np.int64)
    last[order] = node
    return np.concatenate(parents), np.concatenate(labels), np.concatenate(children), last


def build(langs: list[str], phrases: list[bytes]) -> Trie:
    """The double array of the phrases (words between blanks) of languages; a
    phrase is known by its place.

    Parents of many children are placed first, each at the first offset where
    all its slots are free; parents of one child fill what is left.
    """
    codes, names, words = _codes(langs, phrases)
    bits = max(1, (int(codes.max()).bit_length() + 1) // 2)
    radix = 1 << bits
    parent, label, child, last = _edges(_digits(codes, bits))
    by_parent = np.argsort(parent, kind="stable")
    parent, label, child = parent[by_parent], label[by_parent], child[by_parent]
    starts = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
    sizes = np.diff(np.append(starts, len(parent)))
    nodes = len(child) + 1
    offset, slot = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    used = np.zeros(4 * nodes + 4 * radix, bool)
    used[:radix] = True  # leaves lead here, where nothing is ever found
    at = radix
    for i in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())]:
        own = label[starts[i] : starts[i] + sizes[i]]
        while True:
            if at + 512 + radix >= len(used):
                used = np.append(used, np.zeros(len(used), bool))
            free = at + np.flatnonzero(~used[at : at + 512]) - own[0]
            fits = np.flatnonzero(~used[free[:, None] + own].any(axis=1))
            if len(fits):
                break
            at += 512
        base = free[fits[0]]
        offset[parent[starts[i]]] = base
        slot[child[starts[i] : starts[i] + sizes[i]]] = base + own
        used[base + own] = True
    single = starts[sizes == 1]
    while (free := np.flatnonzero(~used)).size < len(single):
        used = np.append(used, np.zeros(len(used), bool))
    offset[parent[single]] = free[: len(single)] - label[single]
    slot[child[single]] = free[: len(single)]
    end = int(max(slot.max(), offset.max())) + radix + 1
    base, check, accept = np.zeros(end, np.int32), np.full(end, -1, np.int32), np.full(end, -1, np.int32)
    base[slot] = offset
    check[slot[child]] = slot[parent]
    accept[slot[last]] = np.arange(len(phrases))
    return Trie(names, words, bits, base, check, accept)


TRIE = "trie long, langs array<string>, words binary, bits int, base binary, check binary, accept binary"


def _build_rows(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("number")
    made = build(part["lang"].tolist(), [p.encode() for p in part["phrase"]])
    packed = {"langs": list(made.langs), "words": b" ".join(made.symbols), "bits": made.bits, "base": made.base.tobytes(), "check": made.check.tobytes(), "accept": made.accept.tobytes()}
    return pd.DataFrame([{"trie": part["trie"].iloc[0], **packed}])


def _trie_of(row) -> Trie:
    arrays = [np.frombuffer(row[c], np.int32) for c in ("base", "check", "accept")]
    return Trie(row["langs"], bytes(row["words"]).split(b" "), row["bits"], *arrays)


#: Phrases whose counts travel together.
SEGMENT = 4096


def _trie_counts(texts: DataFrame, tries: list, most: int) -> DataFrame:
    """``trie, number, n`` of the phrases of these tries, summed over shards.

    A shard gives one vector of counts for each segment of a trie; a task takes
    the vectors of some segments in turn and adds them up.
    """
    shared = texts.sparkSession.sparkContext.broadcast(tries)

    def count(batches):
        numbered, opened = Numbered(), {row["trie"]: _trie_of(row) for row in shared.value}
        sums = {name: np.zeros(int(t.accept.max()) + 1, np.int64) for name, t in opened.items()}
        known: dict = {}
        for lang, words, own in by_language(batches, most - 1):
            ids, _ = numbered(lang, words)
            vocabulary = numbered.langs[lang]
            for name, trie in opened.items():
                # Words are looked up once for each trie; chunks take the rest.
                store, symbols, first = known.get((name, lang), (None, None, None))
                if store is not vocabulary:
                    symbols = first = np.zeros(0, np.int64)
                new = np.array([trie.symbols.get(w, 0) for w in islice(vocabulary, len(symbols), None)], np.int64)
                symbols, first = np.append(symbols, new), np.append(first, trie.first(lang, new))
                known[name, lang] = vocabulary, symbols, first
                for found in trie.matches(first, symbols, ids, own, most):
                    sums[name] += np.bincount(found, minlength=len(sums[name]))
        rows = [(name, at // SEGMENT, total[at : at + SEGMENT]) for name, total in sums.items() for at in range(0, len(total), SEGMENT)]
        rows = [r for r in rows if r[2].any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2].tobytes() for r in rows], pa.binary())], names=["trie", "segment", "counts"])

    def add(batches):
        last, total = None, None

        def row():
            at = np.flatnonzero(total)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), last[0], np.int64)), pa.array(at + last[1] * SEGMENT), pa.array(total[at])], names=["trie", "number", "n"])

        for batch in batches:
            for key, data in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2)):
                counts = np.frombuffer(data.as_buffer(), np.int64)
                if key != last:
                    if last is not None:
                        yield row()
                    last, total = key, np.zeros(len(counts), np.int64)
                total += counts
        if last is not None:
            yield row()

    vectors = texts.mapInArrow(count, "trie long, segment long, counts binary").repartition("trie", "segment").sortWithinPartitions("trie", "segment")
    return vectors.mapInArrow(add, "trie long, number long, n long")


def phrase_counts(texts: DataFrame, words: DataFrame, least: int, most: int) -> DataFrame:
    """``lang, phrase, n`` of phrases of 2 to ``most`` words that occur
    ``least`` times or more, by levels, candidates and tries."""
    spark = texts.sparkSession
    frequent = words.where(F.col("n") >= least)
    bitmaps = [bitmap(frequent.select(F.xxhash64(F.concat_ws(" ", "lang", "phrase")).alias("h")))]
    safe = []
    for _ in range(2, most + 1):
        safe.append(written(_hash_counts(texts, bitmaps).where(F.col("n") >= least).select("h"), "safe-hashes"))
        bitmaps.append(bitmap(safe[-1]))
    hashes = safe[0]
    for more in safe[1:]:
        hashes = hashes.union(more)
    found = _phrases(texts, bitmaps).join(hashes.distinct(), "h", "left_semi").select("lang", "phrase").distinct()
    candidates = written(found, "candidates")
    tries = -(-candidates.count() // TRIE_PHRASES) or 1
    dealt = candidates.withColumn("trie", F.pmod(F.xxhash64("phrase", "lang"), F.lit(tries)))
    number = F.row_number().over(Window.partitionBy("trie").orderBy("lang", "phrase")).cast("long") - 1
    numbered = written(dealt.withColumn("number", number), "numbered")
    made = written(numbered.groupBy("trie").applyInPandas(_build_rows, TRIE), "tries")
    counted = None
    for first in range(0, tries, TRIES_A_PASS):
        part = made.where(F.col("trie").between(first, first + TRIES_A_PASS - 1)).collect()  # bounded
        sums = written(_trie_counts(texts, part, most), "phrase-counts") if part else None
        counted = sums if counted is None or sums is None else counted.unionByName(sums)
    for table in (*safe, candidates, made):
        drop_written(table)
    if counted is None:
        return spark.createDataFrame([], "lang string, phrase string, n long")
    return numbered.join(counted.where(F.col("n") >= least), ["trie", "number"]).select("lang", "phrase", "n")


def _exact(*factors: Column) -> Column:
    out = F.lit(1).cast("decimal(38,0)")
    for factor in factors:
        out = (out * factor.cast("decimal(20,0)")).cast("decimal(38,0)")
    return out


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, size, a, l, r, score`` of every candidate by its lowest
    cut; of equal ones the first.  Products are exact up to 38 digits."""
    counts = phrases.select("lang", "phrase", "n").unionByName(words.select("lang", "phrase", "n"))
    split = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = split.withColumn("size", F.size("w")).withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "size", "cut", F.array_join(F.slice("w", 1, F.col("cut")), " ").alias("left"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("size")), " ").alias("right"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    both = both.withColumns({"up": _exact(F.lit(1_000_000), F.col("a"), F.col("a")), "down": _exact(F.col("l"), F.col("r"))})
    best = both.groupBy("lang", "phrase").agg(F.min(F.struct(F.expr("up div down").alias("score"), "cut", "l", "r", "a", "size")).alias("b"))
    return best.select("lang", "phrase", "b.size", "b.a", "b.l", "b.r", "b.score")


def collocations(
    docs: DataFrame, least: int = LEAST, most: int = MOST_WORDS, top: int = TOP, inside_percent: int = INSIDE_PERCENT, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of
    each language.

    A phrase is 2 to ``most`` words of one piece of a text, with ``a`` of at
    least ``least`` occurrences (overlaps count).  ``score`` is the least of
    ``1000000 a a / (l r)`` (floored) over its cuts into a left and a right
    part; ``n`` is the number of all words of the language.  Phrases inside a
    longer candidate with at least ``inside_percent`` of their occurrences are
    dropped.  Ranks go by score, ``a`` and the phrase.  Null languages count as
    ``und``, null texts as empty; repeated rows count as often as they stand;
    other columns play no part; an empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    texts = texts_of(docs, text_col, lang_col)
    words = written(word_counts(texts), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    found = written(phrase_counts(texts, words, least, most), "phrases")
    ranked = scored(found, words)
    long_ones = found.withColumn("w", F.split("phrase", " ")).withColumn("size", F.size("w")).where("size > 2")
    spans = F.expr("flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i -> array_join(slice(w, i, k), ' '))))")
    inside = long_ones.select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    left = ranked.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = left.withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_AHEAD = " || ' ' || ".join(["x", *[f"lead(x, {k}) OVER piece" for k in range(1, MOST_WORDS)]])
_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS k, {' || '.join(_AHEAD.split(' || ')[: 2 * k - 1])} AS phrase FROM words WINDOW piece AS (PARTITION BY p ORDER BY i)" for k in range(1, MOST_WORDS + 1))
#: DuckDB: all phrases counted, products in 128 bits.
ORACLE = rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w FROM (
    SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), words AS (
  SELECT lang, p, unnest(w) AS x, unnest(range(len(w))) AS i FROM pieces
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM ({_GRAMS}) WHERE phrase IS NOT NULL GROUP BY ALL
), totals AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= {LEAST}
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, l.n AS l, r.n AS r, ((1000000::HUGEINT * c.a * c.a) // (l.n::HUGEINT * r.n))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1 :], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (SELECT lang, a, array_to_string(w[i : i + 1], ' ') AS phrase FROM (SELECT lang, a, w, unnest(range(1, k)) AS i FROM cand WHERE k = 3)) GROUP BY ALL
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.longer IS NULL OR 100 * i.longer < {INSIDE_PERCENT} * b.a
)
SELECT lang, rank::INTEGER AS rank, phrase, a, l, r, t.n, score FROM ranked JOIN totals t USING (lang) WHERE rank <= {TOP}
"""
