"""Citation variants, look-alikes, page text and model output."""

import hashlib

from pyspark.sql import functions as F

from formloom.functions import values as V
from formloom.functions.html import html_to_text
from formloom.operators import citations, logs

HOME = "12-B"


def scan(spark, text, names=None):
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    rows = citations.scan_mentions(docs, citations.families(HOME), names).collect()
    return sorted((r.start, r.cite) for r in rows)


def cites(spark, text, names=None):
    return [c for _, c in scan(spark, text, names)]


def test_surface_forms(spark):
    for text in ("12-b section 3-401", "SECTION 3-401 OF TITLE 12-B", "12-B m.r.s.a. SEC. 3-401", "12-B §3-401", "12-B M.R.S.A. § 3-401(2)", "12-B section 3-401", "Section 3-401 of Title 12-B", "§3-401", "12-B, § 3-401"):
        assert cites(spark, text) == ["12-B §3-401"], text
    assert cites(spark, "36 M.R.S. §4107 and 19-A M.R.S.") == ["36 M.R.S. §4107", "19-A M.R.S."]
    assert cites(spark, "2000 ME 17; 457 A.2d 1123; 12 A.3d 34") == ["2000 ME 17", "457 A.2d 1123", "12 A.3d 34"]
    assert cites(spark, "§§ 5-301, 5-302 and 9-999") == ["12-B §5-301", "12-B §5-302", "12-B §9-999"]
    assert cites(spark, "no citation at all") == []


def test_lookalikes_cannot_hide(spark):
    assert cites(spark, "12‑B §9‑999") == ["12-B §9-999"]
    assert cites(spark, "12-B §9-9​99") == ["12-B §9-999"]


def test_spans_do_not_overlap_and_text_is_read_to_its_end(spark):
    text = "x " * 200_000 + "see 12-B §3-401"
    assert scan(spark, text) == [(400_004, "12-B §3-401")]


def test_names_and_placeholders(spark):
    assert cites(spark, "As ESTATE OF REED held", {"Estate of Reed": "1999 ME 5"}) == ["1999 ME 5"]
    assert cites(spark, "as in re reed and REED say", {"In re Reed": "1999 ME 6"}) == ["1999 ME 6"] * 2
    docs = spark.createDataFrame([(1, "a [[REF: 12-B §3-401]] b §3-402")], "doc_id bigint, text string")
    got = {r.cite: r.in_placeholder for r in citations.scan_mentions(docs, citations.families(HOME)).collect()}
    assert got == {"12-B §3-401": True, "12-B §3-402": False}


def test_page_text(spark):
    page = "<html><head><title>T</title></head><body><nav>menu <nav>deep</nav> more</nav><p>One&nbsp;two</p><form><p>hidden</p></form><div>three<br>four</div><script>var t='</p>';</script></body></html>"
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(html_to_text("html")).collect()[0][0] == "One two\nthree\nfour"


def test_truncated_model_output(spark):
    df = spark.createDataFrame([('```json\n[{"name": "a", "n": 1,}, {"name": "b", "n": 2}, {"name": "c", "n"',)], "t string")
    got = df.select(V.recover_json_objects(F.col("t"), "name string, n int").alias("o")).collect()[0].o
    assert [(o.name, o.n) for o in got] == [("a", 1), ("b", 2)]


def test_hedged_renames_are_ignored(spark):
    df = spark.createDataFrame([("should be 'date_signed'",), ("should be 'x_y' or something like it",), ("fine",)], "t string")
    got = [r[0] for r in df.select(V.extract_rename(F.col("t"), [r"should be '([a-z_]+)'"])).collect()]
    assert got == ["date_signed", None, None]


def test_tampering_flags_the_line_and_its_successor(spark):
    entries = spark.createDataFrame([(k, i, f"p{i}") for k in (1, 2) for i in range(6)], "log_key bigint, seq bigint, payload string")
    chained = logs.append_chain(entries).withColumn("receipt_hash", V.digest(F.col("payload")))
    assert logs.verify_chain(chained).where("problems <> ''").count() == 0
    hit = (F.col("log_key") == 1) & (F.col("seq") == 3)
    bad = logs.verify_chain(chained.withColumn("payload", F.when(hit, "forged").otherwise(F.col("payload"))))
    got = {(r.log_key, r.seq): r.problems for r in bad.where("problems <> ''").collect()}
    assert got == {(1, 3): "receipt_mismatch", (1, 4): "chain_break"}


def test_signatures_depend_on_the_key(spark):
    df = spark.createDataFrame([("text",)], "t string")
    a = df.select(logs.signature(b"one")("t")).collect()[0][0]
    b = df.select(logs.signature(b"two")("t")).collect()[0][0]
    assert a != b and len(a) == len(hashlib.sha256(b"").hexdigest())


def common_letters(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b, start=1):
            new.append(row[j - 1] + 1 if c == d else max(row[j], new[-1]))
        row = new
    return row[-1]


def plain_token_set(a, b):
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    shared, only_a, only_b = (" ".join(sorted(x)) for x in (one & two, one - two, two - one))
    if shared and (not only_a or not only_b):
        return 100.0
    ratio = lambda p, q: 200.0 * common_letters(p, q) / (len(p) + len(q))
    with_a, with_b = f"{shared} {only_a}".strip(), f"{shared} {only_b}".strip()
    return max([ratio(with_a, with_b), *([ratio(shared, with_a), ratio(shared, with_b)] if shared else [])])


def test_token_set_similarity(spark):
    import random

    from formloom.functions import values as V

    rng = random.Random(3)
    words = ["high", "hihg", "low", "not", "specified", "speciffied", "é", "a", "urgent"]
    pairs = [(" ".join(rng.choices(words, k=rng.randint(0, 4))), " ".join(rng.choices(words, k=rng.randint(0, 4)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", V.token_set_ratio(F.col("a"), F.col("b")).alias("s"), V.shared_letters(F.col("a"), F.col("b")).alias("n"))
    for row in df.collect():
        assert row.n == common_letters(row.a, row.b)
        assert abs(row.s - plain_token_set(row.a, row.b)) < 1e-9, row
