"""BPE, prefix counts and token files against the library."""

import hashlib
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import DOCS, docs
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from formloom.llm import bpe, prefix_counts, token_files

PATH = bpe.default_path()
LIB = Tokenizer.from_file(PATH)
WORD_LIB = Tokenizer.from_file(token_files.default_path())
TEXT = st.one_of(
    st.text(max_size=40),
    st.text(alphabet=" \n\tabthe'relvsdm.,!1½é\x1c\x85<|>", max_size=40),
    st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", "'re", "'", "word", "!!", "ΑΣ", "<|ENDOFTEXT|>"]), max_size=10).map("".join),
)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_bpe_is_the_library(text):
    found = bpe.vocabulary(PATH).encode(text, bpe.packed_words(PATH)).tolist()
    assert found == LIB.encode(text, add_special_tokens=False).ids
    assert bpe.vocabulary(PATH).decode(found) == LIB.decode(found, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_counts_of_all_prefixes(text):
    prefixes = [text[:i] for i in range(len(text) + 1)]
    want = [len(e.ids) for e in LIB.encode_batch(prefixes, add_special_tokens=False)]
    assert prefix_counts.counter(PATH).counts(text).tolist() == want


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_word_pieces_are_the_library(text):
    found = np.frombuffer(token_files.encoder(token_files.default_path()).encode([text])[0], np.uint32).tolist()
    assert found == WORD_LIB.encode(text, add_special_tokens=False).ids


def test_letters_that_normalisation_changes():
    """Every code point that becomes another one, before a stop and a comma
    (a full run over all code points was made once, with no difference)."""
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}. b{c}, {c}. .{c} " for c in points if unicodedata.normalize("NFC", c).lower() != c and not "\uac00" <= c <= "\ud7a3"]
    assert len(texts) > 2000 and any("İ" in t for t in texts)
    found = token_files.encoder(token_files.default_path()).encode(texts)
    for text, ids, want in zip(texts, found, WORD_LIB.encode_batch_fast(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, np.uint32).tolist() == want.ids, text


def test_long_words_are_not_kept():
    memo = bpe.Memo(len)
    assert memo["x" * 1000] == 1000 and memo["y"] == 1 and list(memo) == ["y"]


def test_memo_keeps_its_bound():
    memo = bpe.Memo(lambda w: w * 2, limit=3)
    for w in "abcdefabc":
        assert memo[w] == w * 2
    assert len(memo) <= 3 and len(memo.old) <= 3


def test_round_trip_of_edge_rows(spark):
    rows = bpe.round_trip_digests(docs(spark), PATH).collect()
    assert len(rows) == len(DOCS)
    want = []
    for doc_id, text in DOCS:
        ids = LIB.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    encoded = bpe.encode_documents(docs(spark), PATH)
    assert sorted(r.text for r in bpe.decode_documents(encoded, PATH).collect()) == sorted(t or "" for _, t in DOCS)


@pytest.mark.parametrize("limit", [0, 5, 1024])
def test_budget_from_stored_counts(spark, limit):
    stored = prefix_counts.fit_to_budget(prefix_counts.prefix_counts(docs(spark), PATH), limit)
    direct = prefix_counts.token_budget(docs(spark), PATH, limit)
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(((r.doc_id, r.n_tokens, r.chars_within) for r in direct.collect()), key=repr)
    by_text = {r.doc_id: r for r in sorted(direct.collect(), key=key)}
    assert by_text[2].n_bytes == by_text[3].n_tokens == 0
    assert all(r.over_limit == (r.n_tokens > limit) for r in direct.collect())


def test_segment_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    ids = np.concatenate([np.append(rng.integers(3, 40, n), 2) for n in (0, 1, 500, 20_000)]).astype(np.uint16)
    payload = token_files.pack_segment([7, None, 8, 9], [1, 2, 501, 20_001], ids, 49_408)
    segment = token_files.Segment(payload)
    assert segment.doc_ids == [7, None, 8, 9] and len(segment.left) > 100
    assert (segment.ids(0, len(ids)) == ids).all()
    for lo, hi in ((0, 1), (3, 3), (5, 400), (1234, 9876)):
        assert (segment.ids(lo, hi) == ids[lo:hi]).all()
    assert (segment.document(2) == ids[3:504]).all()
    assert len(payload) < ids.nbytes  # forty symbols in sixteen bits


@pytest.mark.parametrize("first_rule", [50, 65_530])
def test_rules_are_made_until_no_pair_is_frequent(first_rule):
    rng = np.random.default_rng(2)
    copy = rng.integers(3, 50, 3000)
    ids = np.concatenate([np.append(rng.integers(3, 50, 4000), 2), *[np.append(copy, 2)] * 9, np.append(np.full(700, 7), 2)]).astype(np.uint16)
    symbols, rules = token_files.repair(ids, first_rule)
    pairs = Counter((a, b) for a, b in zip(symbols.tolist(), symbols[1:].tolist()) if a != token_files.END_ID)
    assert max(pairs.values()) < token_files.LEAST
    assert token_files.expansion_lengths(rules, first_rule).max() > 100
    segment = token_files.Segment(token_files.pack_segment([1], [len(ids)], ids, first_rule))
    assert (segment.ids(0, len(ids)) == ids).all() and (segment.ids(5000, 9000) == ids[5000:9000]).all()


def test_overlapping_pairs_are_replaced_from_the_left():
    ids = np.array([5] * 65 + [2], np.uint16)
    segment = token_files.Segment(token_files.pack_segment([1], [66], ids, 100))
    assert (segment.ids(0, 66) == ids).all()


def test_files_of_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_DOCS", 3)
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 10)
    found = sorted(token_files.tokenise_to_files(docs(spark), token_files.default_path()).collect(), key=lambda r: r.start)
    assert len(found) == len(DOCS)
    at = 0
    order = sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0))
    for row, (doc_id, text) in zip(found, order):
        ids = np.array([*WORD_LIB.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_empty_tables(spark):
    none = docs(spark, [])
    assert bpe.round_trip_digests(none, PATH).count() == 0
    assert prefix_counts.token_budget(none, PATH, 5).count() == 0
    assert token_files.tokenise_to_files(none, token_files.default_path()).count() == 0
