"""The pipeline against a walk over the same documents, and its queries."""

import hashlib
import re
import zlib

import numpy as np
import pytest
import regex
from check_queries import compare, duck
from test_copies import brute_windows, reach

import corpus_pipeline
from formloom.llm import bpe, quality, queries, repeats
from formloom.llm.common import read

SMALL = "/root/testdata/sf0.001"


def shingles(text):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall("[^\x20\x09-\x0d]+", words)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def windows(text):
    tokens = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    return np.array([[zlib.crc32(t.encode()) for t in tokens[i : i + 13]] for i in range(len(tokens) - 12)])


def leaks(document, item):
    """Whether any two windows agree in 11 tokens of 13, all pairs looked at."""
    return len(document) and len(item) and any(((document == w).sum(axis=1) >= 11).any() for w in item)


def test_pipeline_is_the_walk(spark):
    docs, labels = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    weights = quality.train(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    rows = [(i, t) for i, t in rows if quality._sigmoid(float(weights[(f := quality.features(t))[0]].astype("float32").astype(float) @ f[1])) >= quality.THRESHOLD]
    sets = [shingles(t) for _, t in rows]
    root = reach(len(rows), lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    cut = []
    again: dict[bytes, bool] = {}
    data = [t.encode() for _, t in rows]
    for d in data:
        for i in range(len(d) - 199):
            h = d[i : i + 200]
            again[h] = h in again
    for (doc_id, _), d in zip(rows, data):
        spans = [{"lo": i, "hi": i + 200} for i in range(len(d) - 199) if again[d[i : i + 200]]]
        cut.append((doc_id, repeats.kept_bytes(d, repeats.whole_characters(d, repeats.merge_spans(spans))).decode()))
    items = [windows(r.text) for r in read(spark, SMALL, "benchmark").collect()]
    leaky = {doc_id for doc_id, t in cut if any(leaks(windows(t), item) for item in items)}
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in cut if i not in leaky}
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: r.decoded_sha256 for r in found} == want and len(found) == len(want)


def test_stages_return_the_columns_of_documents(spark):
    docs = read(spark, SMALL, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    _, differences = compare(name, queries.QUERIES[name](spark, SMALL), queries.ORACLES[name], duck(SMALL))
    assert not differences, "\n".join(differences)


def test_whole_tables(spark):
    """Each query has a row for every row of its table, whatever the id."""
    for name, table in (("op1_token_files", "documents"), ("op2_simhash", "documents"), ("op3_quality", "documents"), ("op5_main_text", "pages"), ("op10_warc", "pages")):
        assert queries.QUERIES[name](spark, SMALL).count() == read(spark, SMALL, table).count()


def test_windows_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SMALL, "documents").orderBy("doc_id").collect()]
    want = [(d, *w) for (d, _), w in zip(rows, brute_windows([t for _, t in rows], 200))]
    assert sorted(map(tuple, queries.QUERIES["op7_repeated_windows"](spark, SMALL).collect())) == want


def test_bpe_path_is_a_parameter():
    assert bpe.default_path().endswith("byte_bpe_50k.json")
