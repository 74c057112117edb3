"""Near copies, repeated windows and leaks against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from edge import DOCS, docs, sorted_rows

from formloom.llm import components, decontaminate, repeats, simhash


def reach(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(n)]


def varied(seed, n, words=60):
    """Texts in families of copies with a few words replaced."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    while len(out) < n:
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(words)] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    return out[:n]


@pytest.mark.parametrize("hot", [24, 1])
def test_simhash_components(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT", hot)  # 1: every key goes by neighbours
    rng = random.Random(5)
    prints = []
    for _ in range(40):
        base = rng.getrandbits(64)
        prints += [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(6)]
    prints = sorted({p - (1 << 64) if p >= 1 << 63 else p for p in prints})
    linked = lambda i, j: ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= 2
    want = reach(len(prints), linked)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    root = {r.node: r.root for r in components.components(edges).collect()}
    assert [root.get(p, p) for p in prints] == [prints[w] for w in want]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(5, 5), (1000, 999)], "u long, v long")
    root = {r.node: r.root for r in components.components(edges).collect()}
    assert root == {**{i: 0 for i in range(1, 201)}, 1000: 999}


def plain_fingerprint(text):
    """By definition, bit by bit."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return f"{sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)):016x}"


def test_fingerprints_are_the_definition(spark):
    texts = [*varied(6, 40), *(t for _, t in DOCS if t is None or len(t) < 1000), "A b", "É É é", "one\x0btwo\x1cthree  four", "x " * 31]
    found = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs(spark, list(enumerate(texts)))).collect()}
    assert found == {i: plain_fingerprint(t) for i, t in enumerate(texts)}


def test_equal_ids_are_judged_by_their_own_texts(spark):
    rows = [(None, "a first text of some words that is quite unlike the other one"), (None, "and this is another text with words of its own, as one can see"), (1, "and this is another text with words of its own, as one can see")]
    kept = sorted((repr(r.doc_id), r.text) for r in simhash.one_of_each(docs(spark, rows)).collect())
    assert kept == [("None", rows[0][1]) if k == 0 else ("None", rows[1][1]) for k in range(2)]


def test_near_duplicates_of_edge_rows(spark):
    found = simhash.near_duplicates(docs(spark))
    rows = found.collect()
    assert found.columns == ["doc_id", "fingerprint", "component_id"] and len(rows) == len(DOCS)
    zero = {r.doc_id: r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert zero == {2: 2, 3: 2}
    assert [r.component_id for r in rows if r.doc_id == 1] == [1, 1]
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_one_of_each_near_copy(spark):
    texts = varied(3, 150)
    sets = [set(simhash.shingle_hashes(simhash.words_of(t), 5).tolist()) for t in texts]
    want = reach(len(texts), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    kept = {r.doc_id for r in simhash.one_of_each(docs(spark, list(enumerate(texts)))).collect()}
    assert kept == set(want)


def brute_kept(texts):
    """Least row of each group over all pairs, by exact Jaccard."""
    sets = [np.unique(simhash.shingle_hashes(simhash.words_of(t), 5)) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    of_shingle = {}
    for i, s in enumerate(sets):
        for h in s.tolist():
            of_shingle.setdefault(h, []).append(i)
    for i, s in enumerate(sets):
        shared = np.bincount(np.concatenate([np.array(of_shingle[h]) for h in s.tolist()]), minlength=len(sets))
        for j in np.flatnonzero(5 * shared >= 4 * (len(s) + np.array(list(map(len, sets))) - shared)).tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i for i in range(len(texts)) if find(i) == i}


def star(seed, n, words=200, replaced=3, original=True):
    """An original and copies that are close to it, but less so to each other."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    texts = [" ".join(base)] if original else []
    for k in range(n):
        copy = list(base)
        for j, at in enumerate(rng.sample(range(words), replaced)):
            copy[at] = f"new{k}x{j}"
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("original", [True, False])
def test_a_star_of_edited_copies(spark, original):
    texts = star(11, 2000 if original else 300, original=original)
    kept = {r.doc_id for r in simhash.one_of_each(docs(spark, list(enumerate(texts)))).collect()}
    assert kept == brute_kept(texts)


def test_without_leaders_all_pairs_are_settled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "COMMON", 1 << 30)  # no order by frequency, no original found
    texts = star(12, 150) + varied(6, 150)
    kept = {r.doc_id for r in simhash.one_of_each(docs(spark, list(enumerate(texts)))).collect()}
    assert kept == brute_kept(texts)


def test_long_texts_are_judged_whole(spark):
    """Pairs just under and just over 0.8 of 2,000 shingles."""
    texts = []
    for k in range(24):
        rng = random.Random(k)
        words = [f"w{rng.randrange(10**6)}" for _ in range(2000)]
        texts += [" ".join(words), " ".join(words[: 1790 if k % 2 else 1770] + [f"n{k}x{i}" for i in range(210 if k % 2 else 230)])]
    kept = {r.doc_id for r in simhash.one_of_each(docs(spark, list(enumerate(texts)))).collect()}
    assert kept == brute_kept(texts) and len(kept) == 36


def test_pairs_at_the_bound_meet():
    """Isolated pairs at 0.8 share a posting that passes the size and position filter."""
    rng = np.random.default_rng(7)
    for k in range(3000):
        m = int(rng.integers(5, 200))
        n = int(rng.integers(-(-4 * m // 5), m + 1))
        both = -(-4 * (m + n) // 9)
        if both > n:
            continue
        x = rng.integers(0, 1 << 63, m + n - both, dtype=np.uint64) * np.uint64(2)
        a, b = np.sort(x[:m]), np.sort(x[m - both :])
        common = np.sort(x[rng.random(len(x)) < 0.1 * (k % 10)])
        assert simhash.alike(a.tobytes(), b.tobytes()) and simhash.may_be_alike(simhash.low_part(a).tobytes(), simhash.low_part(b).tobytes())
        left, right = ({h: len(s) - i for i, h in enumerate(simhash.prefix_of(s, common).tolist())} for s in (a, b))
        assert any(9 * min(left[h], right[h]) >= 4 * (len(a) + len(b)) for h in left.keys() & right.keys())


def test_one_of_each_of_edge_rows(spark):
    found = simhash.one_of_each(docs(spark))
    assert found.columns == docs(spark).columns
    # Both empty texts are copies of one another, and so are the repeated rows.
    assert sorted((r.doc_id for r in found.collect()), key=repr) == [1, 2, 4, 5, 6, None]
    assert simhash.one_of_each(docs(spark, [])).count() == 0


def brute_windows(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("hot", "length"), [(4096, 200), (0, 200), (4096, 203)])
def test_repeated_windows(spark, monkeypatch, hot, length):
    monkeypatch.setattr(repeats, "HOT", hot)  # 0: every bucket is counted
    texts = [t + " é" * (i % 7) for i, t in enumerate(varied(4, 60, words=110))]
    texts += ["ab" * 300, "x" * 1500, "abc " * 90, "short", texts[0], "ü" * 250]
    rows = [(i, t) for i, t in enumerate(texts)]
    want = [(i, *w) for i, w in enumerate(brute_windows(texts, length))]
    assert sorted(map(tuple, repeats.removal_digests(docs(spark, rows), length).collect())) == want


def test_repeated_windows_of_edge_rows(spark):
    rows = [*DOCS, (7, "y" * 260 + "tail"), (7, "y" * 260 + "tail"), (None, "z" * 199)]
    want = sorted(((d, *w) for (d, _), w in zip(rows, brute_windows([t for _, t in rows], 200))), key=repr)
    assert sorted_rows(repeats.removal_digests(docs(spark, rows))) == want
    cut = repeats.without_repeats(docs(spark, rows))
    assert cut.columns == docs(spark).columns and cut.count() == len(rows)
    assert [r.text for r in cut.where("doc_id = 3").collect()] == [None]
    assert repeats.removal_digests(docs(spark, [])).count() == 0


def test_cuts_leave_whole_characters():
    data = "aéb".encode()
    assert repeats.whole_characters(data, [[2, 4]]) == [[3, 4]]
    assert repeats.whole_characters(data, [[0, 2]]) == [[0, 1]]


def leak_texts():
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen".split()
    swapped = list(item)
    swapped[3], swapped[9] = "XXX", "YYY"
    thrice = [w if i % 4 else "zzz" for i, w in enumerate(item)]
    return item, [
        (1, "Before it, " + " ".join(item) + " and after."),
        (2, "noise " * 20 + ", ".join(swapped).upper() + "!"),
        (3, "noise " + " ".join(thrice)),
        (4, " ".join(item[:12])),
        (None, " ".join(item)),
        (6, ""),
        (7, None),
        (1, "Before it, " + " ".join(item) + " and after."),
    ]


def test_leaks_stand_substitutions(spark):
    item, rows = leak_texts()
    tests = spark.createDataFrame([(10, " ".join(item)), (11, "too short"), (12, None), (None, "")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): (r.first_token, r.last_token, r.best_match) for r in decontaminate.leaks(docs(spark, rows), tests).collect()}
    assert found == {(1, 10): (2, 16, 13), (2, 10): (20, 34, 11), (None, 10): (0, 14, 13)}
    kept = decontaminate.without_leaks(docs(spark, rows), tests)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6, 7] and kept.columns == docs(spark).columns
    assert decontaminate.leaks(docs(spark, []), tests).count() == 0
    assert decontaminate.leaks(docs(spark, rows), tests.limit(0)).count() == 0


def test_shuffled_seeds_give_the_same(spark, monkeypatch):
    item, rows = leak_texts()
    tests = spark.createDataFrame([(10, " ".join(item))], "item_id long, text string")
    want = sorted_rows(decontaminate.leaks(docs(spark, rows), tests))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    assert sorted_rows(decontaminate.leaks(docs(spark, rows), tests)) == want


def test_every_two_substitutions_leave_a_mask():
    for a in range(13):
        for b in range(13):
            blocks = {k for k, block in enumerate(decontaminate.BLOCKS) if a in block or b in block}
            assert any(blocks.isdisjoint(mask) for mask in decontaminate.MASKS)


def test_the_byte_index_gives_the_first_pairs(spark, monkeypatch):
    """Near copies are looked for by the byte-position index first; pairs in one
    group by it are not compared by the prefix filter again."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    texts = [" ".join(base), " ".join([*base[:1500], "other", *base[1501:]]), " ".join(base[::-1]), "", "one two"]
    compared = []
    whole = simhash._alike_pairs

    def seen(pairs, rows, own):
        compared.append(pairs.count())
        return whole(pairs, rows, own)

    monkeypatch.setattr(simhash, "_alike_pairs", seen)
    kept = {r.doc_id for r in simhash.one_of_each(docs(spark, list(enumerate(texts)))).collect()}
    assert kept == {0, 2, 3, 4} and compared == [1, 0, 0]


def test_indexed_pairs_are_all_links(spark):
    rng = random.Random(6)
    prints = [rng.randrange(-(1 << 63), 1 << 63) for _ in range(40)]
    prints += [p ^ (1 << rng.randrange(63)) for p in prints[:20]] + prints[:10]
    rows = spark.createDataFrame(list(enumerate(prints)), "node long, fp long")
    found = reach_of = list(range(len(prints)))
    for r in simhash.index_pairs(rows).collect():
        reach_of = [min(reach_of[r.u], reach_of[r.v]) if x in (reach_of[r.u], reach_of[r.v]) else x for x in reach_of]
    want = reach(len(prints), lambda i, j: bin((prints[i] ^ prints[j]) & ((1 << 64) - 1)).count("1") <= 2)
    assert reach_of == want and want != found
