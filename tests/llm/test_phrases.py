"""Collocations against plain counting; tries, chunks and bitmaps on their own."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from edge import DOCS, docs, sorted_rows
from pyspark.sql import functions as F

from formloom.llm import phrases


def plain(rows, least, most, top, inside):
    """``lang, rank, phrase, a, l, r, n, score`` by definition."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = Counter()
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inner[p[i : i + k]] = max(inner[p[i : i + k]], a)
        ranked = []
        for p, a in found.items():
            if 100 * inner[p] >= inside * a and inner[p]:
                continue
            score, cut = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], start=1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out, key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "of", "New", "York", "city", "É", "é", "\x00", " ", "a\x1fb", "x-y", "🙂", "zu", "end"]
    gaps = [" ", "  ", "\t", " ", " ", ", ", ". ", "\n", ":", "\r\n", " ! "]
    return [(rng.choice(["en", "de", None, "und", ""]), "".join(rng.choice(vocabulary[: rng.randint(2, 15)]) + rng.choice(gaps) for _ in range(rng.randrange(60)))) for _ in range(n)]


@pytest.mark.parametrize(("least", "most", "trie", "a_pass"), [(10, 3, 1 << 20, 4), (3, 3, 40, 2), (4, 4, 100, 1), (2, 2, 1 << 20, 4)])
def test_collocations_are_the_plain_count(spark, monkeypatch, least, most, trie, a_pass):
    monkeypatch.setattr(phrases, "TRIE_PHRASES", trie)
    monkeypatch.setattr(phrases, "TRIES_A_PASS", a_pass)
    rows = texts(least, 220)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5).withColumns({c: F.lit(7) for c in ("phrase", "n", "h", "w", "trie", "doc_id")})
    assert sorted_rows(phrases.collocations(df, least, most, 50, 50)) == plain(rows, least, most, 50, 50)


def test_edge_rows(spark):
    rows = [("en", t) for _, t in DOCS]
    df = docs(spark).withColumn("lang", F.lit("en"))
    assert sorted_rows(phrases.collocations(df)) == plain(rows, 10, 3, 2000, 50)
    assert phrases.collocations(docs(spark, []).withColumn("lang", F.lit("en"))).count() == 0
    assert phrases.collocations(docs(spark, [(1, None), (2, ""), (3, "one two")]).withColumn("lang", F.lit(None))).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_a_double_array_holds_its_phrases_only(seed):
    rng = random.Random(seed)
    words = [f"w{i}".encode() for i in range(rng.choice([3, 40, 900]))]
    held = sorted({tuple(rng.choice(words) for _ in range(rng.randint(2, 4))) for _ in range(rng.choice([1, 60, 3000]))})
    trie = phrases.build(["en"] * len(held), [b" ".join(p) for p in held])
    used = trie.accept[trie.accept >= 0]
    assert sorted(used.tolist()) == list(range(len(held)))
    stream = [rng.choice([*words, b"unknown"]) for _ in range(4000)]
    vocabulary = [*words, b"unknown"]
    ids = np.array([vocabulary.index(w) for w in stream])
    symbols = np.array([trie.symbols.get(w, 0) for w in vocabulary], np.int64)
    got = Counter(np.concatenate(list(trie.matches(trie.first("en", symbols), symbols, ids, 3000, 4))).tolist())
    place = {p: i for i, p in enumerate(held)}
    want = Counter(place[t] for i in range(3000) for k in range(2, 5) if (t := tuple(stream[i : i + k])) in place)
    assert got == want
    assert not any(len(x) for x in trie.matches(trie.first("de", symbols), symbols, ids, 3000, 4))


@pytest.mark.parametrize("size", [1, 7, 30, 1 << 22])
def test_chunks_begin_every_word_once(monkeypatch, size):
    monkeypatch.setattr(phrases, "CHUNK", size)
    rng = random.Random(size)
    text = b" ".join(rng.choice([b"a", b"bb", b"", phrases.END, b"c" * 50]) for _ in range(400))
    want, at = text.split(), 0
    for words, own in phrases.chunks(text, 2):
        assert words == want[at : at + own + 2]
        at += own
    assert at == len(want)


def test_words_start_anew_without_a_change(monkeypatch):
    rows = texts(9, 80)
    batch = pa.RecordBatch.from_arrays([pa.array([x or "und" for x, _ in rows]), pa.array([t for _, t in rows])], names=["lang", "text"])
    numbered = phrases.Numbered()
    want = [numbered(lang, words)[1].tolist() for lang, words, _ in phrases.by_language([batch] * 3, 2)]
    monkeypatch.setattr(phrases, "REMEMBERED", 3)
    numbered = phrases.Numbered()
    assert want == [numbered(lang, words)[1].tolist() for lang, words, _ in phrases.by_language([batch] * 3, 2)]


def test_a_bitmap_has_the_bits_of_its_hashes(spark):
    rng = random.Random(1)
    h = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)] + [0, -1, (1 << phrases.BITMAP_BITS) - 1]
    bits = phrases.bitmap(spark.createDataFrame([(x,) for x in h], "h long"))
    assert phrases._in(bits, np.array(h)).all()
    assert int(np.unpackbits(bits).sum()) == len({x & ((1 << phrases.BITMAP_BITS) - 1) for x in h})


def test_equal_hashes_of_different_phrases_stay_apart():
    ids = np.array([1, 2, 1, 3, 1, 2, 4, 4])
    got = phrases._first_places(np.zeros(7, np.int64), ids, 2, np.arange(7))
    assert sorted(tuple(ids[p : p + 2].tolist()) for p in got) == sorted({tuple(ids[p : p + 2].tolist()) for p in range(7)})


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000
    pairs = spark.createDataFrame([("en", "a b", big - 1)], "lang string, phrase string, n long")
    words = spark.createDataFrame([("en", "a", big), ("en", "b", big + 7)], "lang string, phrase string, n long")
    assert phrases.scored(pairs, words).first()["score"] == 1_000_000 * (big - 1) ** 2 // (big * (big + 7))
