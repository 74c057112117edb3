"""The manifest against a plain Merkle tree, for several sizes and fan-outs."""

import hashlib
import zlib

import pytest
from edge import sorted_rows
from pyspark.sql import functions as F

from formloom.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def build(nodes, fan_out):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + fan_out])) for i in range(0, len(below), fan_out)])
    return levels


def climb(levels, at, digest, fan_out):
    """Siblings on the way up and the root with ``digest`` in place."""
    siblings = ""
    for level in levels[:-1]:
        first = at - at % fan_out
        left, right = level[first:at], level[at + 1 : first + fan_out]
        siblings += "".join(left + right)
        digest, at = sha("".join([*left, digest, *right])), at // fan_out
    return siblings, digest


def brute(rows, fan_out):
    """What the manifest of documents has to be."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], leaf(row), row))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = build([x[1] for x in groups[g]], fan_out)
    top = build([trees[g][-1][0] for g in order], fan_out)
    out = []
    for k, g in enumerate(order):
        for i, (doc_id, own, row) in enumerate(groups[g]):
            new = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and row[3] is not None:
                new = leaf((*row[:3], row[3] + 1, row[4]))
            below, folded = climb(trees[g], i, new, fan_out)
            above, folded = climb(top, k, folded, fan_out)
            out.append((doc_id, own, trees[g][-1][0], top[-1][0], sha(below + above), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def some(n):
    langs = [None, "", "de", "en", "en", "en", "é", "\U0001f642", "￮"]
    rows = [(i * 37 % 1009, f"s{i % 3}", langs[i * i % len(langs)], i if i % 5 else None, "text ü " * (i % 4) if i % 11 else None) for i in range(n)]
    return [*rows, (None, None, "en", None, None), (None, "s", "en", 3, ""), (5, "s", "en", 3, "same"), (5, "s", "en", 3, "same")]


@pytest.mark.parametrize(("fan_out", "block", "n"), [(2, 4096, 300), (2, 4, 300), (3, 9, 120), (2, 2, 40), (16, 16, 300)])
def test_manifest_is_the_plain_tree(spark, monkeypatch, fan_out, block, n):
    monkeypatch.setattr(merkle, "BLOCK", block)
    monkeypatch.setattr(merkle, "RANGE_ROWS", 50)
    rows = some(n)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in ("grp", "key", "at", "size", "digest", "salt", "cut", "leaf", "root")})
    found = merkle.documents_manifest(df, fan_out)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted_rows(found) == brute(rows, fan_out)


def test_one_row_and_none(spark):
    rows = [(7, "s", "en", 1, "x")]
    assert sorted_rows(merkle.documents_manifest(spark.createDataFrame(rows, SCHEMA))) == brute(rows, 2)
    assert merkle.documents_manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_parent_resumes_the_state_before_the_slot():
    nodes = [sha(str(i)) for i in range(11)]
    tree = merkle.Tree(nodes, 4, None)
    assert tree.before[0][2].hexdigest() == sha("".join(nodes[:2]))
    assert tree.fold(2, nodes[2]) == tree.top != tree.fold(2, nodes[3])
    assert tree.fold(9, "f" * 64) == build([*nodes[:9], "f" * 64, nodes[10]], 4)[-1][0]
