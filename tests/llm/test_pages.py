"""Main text, archives, search and quality."""

import base64
import gzip
import hashlib
import io
import math
import random
import re
import zlib

import numpy as np
import pytest
from edge import docs

from formloom.llm import impact_search, quality, tag_paths, warc
from formloom.llm.common import read

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies.</div>
<article><h1>Head &amp; line</h1><p>First  paragraph,
with <b>bold</b> and an <a href="x">inner link</a>. It is long enough.<p>Short.</p>
<div class="ad">Buy!</div><ul><li>one<li>two</ul><form>Name <input></form></article>
<div id="comments"><p>Nice article, thanks. I liked it very much, really.</p></div><aside>Side</aside><footer>&copy; me</footer></body></html"""


def test_main_text():
    assert tag_paths.main_text(PAGE).split("\n") == ["Head & line", "First paragraph, with bold and an inner link. It is long enough.", "Short.", "one", "two"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("just words &lt;3", "just words <3"),
        ("<p>cut off in a ta<b", "cut off in a ta"),
        ("<p>a<p>b&nbsp; c</div></p>", "a\nb c"),
        ("<nav><p>menu</p></nav>", ""),
        ('<div id="content"><div><h2>H</h2><p>' + "Long text, more. " * 9 + "</p><p>x</p></div></div>", "H\n" + ("Long text, more. " * 9).strip() + "\nx"),
    ],
)
def test_main_text_of_fragments(html, text):
    assert tag_paths.main_text(html) == text


LONG = "A sentence of the article, with its commas, and an end. " * 4
MENU = "".join(f'<div><a href="/{i}">Section {i}</a></div>' for i in range(6))
#: Pages that only ratios can tell apart: no article, menus and notes as divs.
BY_RATIO = [
    (f"<body><div>{MENU}</div><div><h1>Title</h1><p>{LONG}</p><p>Short.</p></div><div>© me</div></body>", ["Title", LONG, "Short."]),
    (f"<body><ul>{MENU.replace('div', 'li')}</ul><h2>Title</h2><p>{LONG}</p><ol><li>one</li><li>two, three</li></ol></body>", ["Title", LONG, "one", "two, three"]),
    (f'<body><article><h1>T</h1><p>{LONG}</p><div><a href="x">More like this</a></div><p>End.</p><div class="ad">Buy!</div></article></body>', ["T", LONG, "End."]),
    (f'<body><div class="post has-sidebar"><p>{LONG}</p><p>Short.</p></div><div class="sidebar">Latest news</div></body>', [LONG, "Short."]),
    (f'<body><article><p>{LONG}</p><p class="share-price">The share price rose, and then it fell again, by some two per cent, on the day.</p></article></body>', [LONG, "The share price rose, and then it fell again, by some two per cent, on the day."]),
    (f'<body><div>{MENU}</div><main><section id="related-work"><p>{LONG}</p></section></main></body>', [LONG]),
    ("<p>3 < 4, and then the rest", ["3 < 4, and then the rest"]),
    ("<p>a <", ["a <"]),
]


@pytest.mark.parametrize(("html", "lines"), BY_RATIO)
def test_ratios_tell_content_from_the_rest(html, lines):
    assert tag_paths.main_text(html) == "\n".join(x.strip() for x in lines)


def test_without_ratios_the_menus_stay(monkeypatch):
    monkeypatch.setattr(tag_paths, "path_ratios", lambda found: {path: 1.0 for path, _, _ in found})
    assert sum(tag_paths.main_text(html) == "\n".join(x.strip() for x in lines) for html, lines in BY_RATIO[:6]) <= 2


def test_equal_weights_are_settled_by_the_path():
    one, two = "<section><p>Equal, text.</p></section>", "<div><p>Equal, text.</p></div>"
    assert tag_paths.main_text(one + two) == tag_paths.main_text(two + one) == "Equal, text.\nEqual, text."


def test_given_pages_keep_their_articles(spark):
    """Every block of the one article of each given page, and nothing else."""
    for row in read(spark, "/root/testdata/sf0.01", "pages").collect():
        article = re.search("<article>(.*)</article>", row.html, re.S)[1]
        assert tag_paths.main_text(row.html) == "\n".join(text for path, text, _ in tag_paths.blocks(article) if not path[-1:] == ("div~",))


PAGES = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None), (4, "http://c/", ""), (None, "http://d/", "<p>x</p>"), (5, "u v", "é" * 50_000), (1, "http://a/", "<p>x</p>"), (None, "http://e/", "only")]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS sha1", "2 AS payload", "3 AS text")


def test_extract_edge_rows(spark):
    rows = tag_paths.extract(pages(spark, PAGES)).collect()
    assert len(rows) == len(PAGES) and {r.text for r in rows if r.page_id == 3} == {""}
    assert all(r.n_chars == len(r.text) for r in rows)
    assert tag_paths.extract(pages(spark, [])).count() == 0


def test_archives_of_edge_rows(spark):
    found = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_and_read(pages(spark, PAGES)).collect()), key=repr)
    want = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == data and p is not None]
        first = min(same, default=page_id)
        revisit = page_id != first
        want.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    assert found == sorted(want, key=repr)
    assert warc.archive_and_read(pages(spark, [])).count() == 0


def test_captures_are_nested(spark):
    files = warc.write_archives(pages(spark, PAGES[:2]), warc.shared_path(spark, "nested"))
    rows = {r.metadata.page_id: r for r in warc.assemble(warc.read_archives(files)).collect()}
    assert rows[1].response.record_type == "response" and rows[2].response.record_type == "revisit"
    assert rows[2].response.refers_to == rows[1].capture_id and rows[1].request.record_id


def test_records_are_members_of_their_own():
    raw = b"".join(warc.capture_records(3, "http://a/b?c", b"body\r\n\r\n", warc.base32_digest(b"body\r\n\r\n"), None))
    heads = [(h["warc-type"], len(b)) for h, b in warc.parse(io.BytesIO(raw))]
    assert [k for k, _ in heads] == ["response", "request", "metadata"]
    assert gzip.decompress(raw).count(b"WARC/1.1") == 3
    with pytest.raises((ValueError, EOFError)):
        list(warc.parse(io.BytesIO(raw[: len(raw) // 3])))


def brute_top(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % 100 == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize(("candidates", "few"), [(8192, 128), (64, 10)])
def test_top_k(spark, monkeypatch, candidates, few):
    monkeypatch.setattr(impact_search, "CANDIDATES", candidates)
    monkeypatch.setattr(impact_search, "FEW", few)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)]) for i in range(500)]
    rows[7] = (7, rows[8][1])  # a tie
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (None, [1.0] * 12), (1000, [0.5] * 12), (1100, [0.25] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS block", "2 AS v")
    found = impact_search.top_k(df, lambda i: i % 100 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, 10)
    assert impact_search.top_k(df.limit(0), lambda i: i % 100 == 0).count() == 0


def test_search_stops_early_on_proof():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-200, 200, (2000, 16))
    vectors[5] = 900
    index = impact_search.Index(vectors)
    found, scores = index.search(np.full(16, 700), 1, np.zeros(2000, bool))
    assert len(found) < 2000 and found[scores.argmax()] == 5


def test_held_out_quality(spark):
    docs_, labels = read(spark, "/root/testdata/sf0.1", "documents"), read(spark, "/root/testdata/sf0.1", "labels")
    rows = quality.classify(docs_, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    good, bad = [r.predicted for r in rows if r.quality == 1], [r.predicted for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_quality_of_edge_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (None, 1, 0), (4, None, 0), (5, 3, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs(spark), labels).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert quality.classify(docs(spark, []), labels).count() == 0
    none = quality.classify(docs(spark), labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.keep_good(docs(spark), labels).columns == docs(spark).columns


def test_ftrl_learns_a_sign():
    rows = [quality.features("good words here" if i % 2 else "bad ||| signs") for i in range(200)]
    w = quality.ftrl(rows, [i % 2 for i in range(200)])
    score = lambda t: quality._sigmoid(float(w[quality.features(t)[0]] @ quality.features(t)[1]))
    assert score("good words") > 0.7 > 0.3 > score("||| signs")


