"""Citations planted in the given documents, and links of the given pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.operators import citations as C
from formloom.plans.registry import query
from formloom.sources.testdata import Tables

HOME = "12-B"
# What is appended to a document, by doc_id modulus, and the cites it holds.
PLANTED = (
    ("See 12-B §3-401.", ("12-B §3-401",)),
    ("See 12-B M.R.S.A. § 3-402(2).", ("12-B §3-402",)),
    ("Section 9-999 of Title 12-B applies.", ("12-B §9-999",)),
    ("Cf. 36 M.R.S. §4107.", ("36 M.R.S. §4107",)),
    ("As in 2000 ME 17 and 457 A.2d 1123.", ("2000 ME 17", "457 A.2d 1123")),
    ("Under §§ 5-301 and 9-998.", ("12-B §5-301", "12-B §9-998")),
    ("Hidden 12‑B §9‑9​97.", ("12-B §9-997",)),
    ("Use [[REF: 12-B §3-401]] but §3-403 too.", ("12-B §3-401", "12-B §3-403")),
    ("Nothing is cited here.", ()),
    ("SECTION 9-996 OF TITLE 12-B, and 12-b section 3-401.", ("12-B §9-996", "12-B §3-401")),
)
KINDS = len(PLANTED)
KNOWN = (
    ("12-B §3-401", "statute"), ("12-B §3-402", "statute"), ("36 M.R.S. §4107", "crossref"),
    ("2000 ME 17", "case"), ("12-B §5-301", "statute"), ("12-B §3-403", "statute"),
)
FOLDED = [(text.translate({0x2011: "-", 0x200B: None}), cites) for text, cites in PLANTED]


def _sql_rows(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


# Every seventh document belongs to no form.
FORM = "CASE WHEN doc_id % 7 <> 6 THEN 'F' || (doc_id % 3) END"
DOCS = (
    "WITH plant(m, cite, inside) AS (VALUES "
    + _sql_rows([(m, c, "true" if "REF" in text and c.endswith("401") else "false") for m, (text, cites) in enumerate(PLANTED) for c in cites]).replace("'true'", "true").replace("'false'", "false")
    + "), known(cite, kind) AS (VALUES " + _sql_rows(KNOWN)
    + f"), m AS (SELECT doc_id, {FORM} AS form_id, cite, inside AS in_placeholder FROM documents JOIN plant ON doc_id % {KINDS} = m),"
    + " vocab AS (SELECT cite, f FROM known, (VALUES ('F0'), ('F1')) v(f) WHERE f = 'F0' OR kind = 'statute'),"
    + " r AS (SELECT m.*, m.cite IN (SELECT cite FROM known) AS resolves, CASE WHEN form_id IS NOT NULL THEN (m.cite, form_id) IN (SELECT (cite, f) FROM vocab) END AS in_vocab FROM m)"
)


def docs(t: Tables) -> DataFrame:
    k = F.col("doc_id") % KINDS
    plant = F.element_at(F.array(*[F.lit(text) for text, _ in PLANTED]), (k + 1).cast("int"))
    return t.raw("documents").select(
        "doc_id", F.expr(FORM).alias("form_id"), F.concat_ws("\n", "text", plant).alias("text")
    )


def authorities(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(list(KNOWN), "cite string, kind string")


def vocabulary(t: Tables) -> DataFrame:
    forms = F.when(F.col("kind") == "statute", F.array(F.lit("F0"), F.lit("F1"))).otherwise(F.array(F.lit("F0")))
    return authorities(t).select("cite", F.explode(forms).alias("form_id"))


def _mentions(t: Tables) -> DataFrame:
    return C.scan_mentions(docs(t), C.families(HOME))


def _resolved(t: Tables) -> DataFrame:
    return C.resolve_mentions(_mentions(t), docs(t).where("form_id IS NOT NULL").select("doc_id", "form_id"), authorities(t), vocabulary(t))


@query(sql=f"{DOCS} SELECT DISTINCT doc_id, cite, in_placeholder FROM m")
def mention_cites(t: Tables):
    """Which document cites what; spans are checked in the tests."""
    return _mentions(t).select("doc_id", "cite", "in_placeholder").distinct()


@query()
def scan_mentions(t: Tables):
    return _mentions(t)


@query(sql=f"{DOCS} SELECT doc_id, cite FROM m WHERE doc_id % {KINDS} = 5")
def expand_section_lists(t: Tables):
    return C.expand_section_lists(docs(t), HOME)


@query(sql=f"{DOCS} SELECT doc_id, cite, resolves FROM r")
def closed_index_lookup(t: Tables):
    return C.closed_index_lookup(_mentions(t), authorities(t)).select("doc_id", "cite", "resolves")


@query(sql=f"{DOCS} SELECT doc_id, form_id, cite, resolves, in_vocab FROM r")
def resolve_mentions(t: Tables):
    return _resolved(t).select("doc_id", "form_id", "cite", "resolves", "in_vocab")


@query(sql=f"{DOCS} SELECT DISTINCT cite FROM r WHERE resolves AND form_id IN ('F1', 'F2')")
def used_authorities(t: Tables):
    found = _mentions(t).join(docs(t).select("doc_id", "form_id"), "doc_id")
    return C.used_authorities([found.where("form_id = 'F1'"), found.where("form_id = 'F2'")], authorities(t))


@query(sql=f"SELECT doc_id, 0 AS pos, '12-B §3-401' AS key FROM documents WHERE doc_id % {KINDS} = 7")
def placeholder_refs(t: Tables):
    return C.placeholder_refs(docs(t))


# Placeholders of every status, three per document.
REF_KEYS = ("good", "gone", "lost", "fake")


def _drafts(t: Tables) -> DataFrame:
    key = lambda i: F.element_at(F.array(*[F.lit(k) for k in REF_KEYS]), ((F.col("doc_id") + i) % 4 + 1).cast("int"))
    ref = lambda i: F.concat(F.lit("[[REF: "), key(i), F.lit("]]"))
    return t.raw("documents").select("doc_id", F.lit("F0").alias("form_id"), F.concat("text", F.lit(" A "), ref(0), F.lit(" B "), ref(1), ref(0)).alias("text"))


def _ref_tables(t: Tables):
    auth = t.spark.createDataFrame(
        [("good", "12-B §1", "Title One", " The text. ", False), ("gone", "12-B §2", None, None, True), ("lost", None, None, None, False)],
        "key string, cite string, title string, text string, dead_link boolean",
    )
    vocab = t.spark.createDataFrame([("F0", k) for k in ("good", "gone", "lost")], "form_id string, key string")
    return vocab, auth


SHOW = "CASE {} WHEN 'good' THEN chr(10) || '=== AUTHORITY [12-B §1] ===' || chr(10) || 'Title: Title One' || chr(10) || 'The text.' || chr(10) || '=== END [12-B §1] ===' || chr(10) WHEN 'gone' THEN '[[DEAD LINK: gone]]' WHEN 'lost' THEN '[[UNRESOLVED: lost]]' ELSE '[[INVENTED: fake]]' END"
DRAFT = "WITH d AS (SELECT doc_id, text, list_extract(['good', 'gone', 'lost', 'fake'], doc_id % 4 + 1) AS a, list_extract(['good', 'gone', 'lost', 'fake'], (doc_id + 1) % 4 + 1) AS b FROM documents)"


@query(sql=f"{DRAFT} SELECT doc_id, text || ' A ' || {SHOW.format('a')} || ' B ' || {SHOW.format('b')} || {SHOW.format('a')} AS text FROM d")
def substitute_refs(t: Tables):
    return C.substitute_refs(_drafts(t), *_ref_tables(t))[0]


@query(
    sql=f"""{DRAFT} SELECT doc_id, k AS key, CASE k WHEN 'good' THEN 'resolved' WHEN 'gone' THEN 'dead_link' WHEN 'lost' THEN 'unresolved' ELSE 'invented' END AS status, n
FROM (SELECT doc_id, a AS k, 2::BIGINT AS n FROM d UNION ALL SELECT doc_id, b, 1 FROM d)""",
)
def reference_statuses(t: Tables):
    return C.substitute_refs(_drafts(t), *_ref_tables(t))[1]


def _page_docs(t: Tables) -> DataFrame:
    """Pages as texts holding their own address and one of two others."""
    extra = F.when(F.col("page_id") % 2 == 0, " https://laws.site/unlisted.").otherwise(" http://localhost/x)")
    return t.raw("pages").select(F.col("page_id").alias("doc_id"), F.concat(F.lit("See "), "url", F.lit(" and https://laws.site/known,"), extra).alias("text"))


def _known_urls(t: Tables) -> DataFrame:
    listed = t.raw("pages").where("page_id % 3 = 0").select("url")
    return listed.unionByName(t.spark.createDataFrame([("https://laws.site/known",)], "url string"))


URLS = r"""WITH u AS (SELECT page_id AS doc_id, regexp_replace(regexp_extract(url, 'https?://[^\s)>\]"''}]+'), '[.,);\]''"]+$', '') AS url FROM pages UNION ALL SELECT page_id, 'https://laws.site/known' FROM pages
  UNION ALL SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'https://laws.site/unlisted' ELSE 'http://localhost/x' END FROM pages),
h AS (SELECT DISTINCT doc_id, url, lower(string_split(regexp_replace(url, '^https?://', ''), '/')[1]) AS host FROM u),
cls AS (SELECT doc_id, url, CASE WHEN host IN ('example.com', 'example.org', 'example.net', 'example.edu', 'example', 'localhost') OR regexp_matches(host, '\.(test|example|invalid)$') THEN 'placeholder'
  WHEN url = 'https://laws.site/known' OR url IN (SELECT url FROM pages WHERE page_id % 3 = 0) THEN 'known' WHEN host = 'laws.site' THEN 'fabricated' ELSE 'unknown' END AS class FROM h)"""


@query(sql=f"{URLS} SELECT doc_id, url, class FROM cls")
def classify_urls(t: Tables):
    return C.classify_urls(C.scan_urls(_page_docs(t)), _known_urls(t), ["laws.site"])


def _doc_urls(t: Tables) -> DataFrame:
    """Documents that share an id with a page carry that page's links."""
    return C.classify_urls(C.scan_urls(_page_docs(t)), _known_urls(t), ["laws.site"])


BUCKETS = f"""{DOCS}, {URLS[5:]},
cb AS (SELECT doc_id, coalesce(string_agg(DISTINCT cite, ',' ORDER BY cite) FILTER (doc_id % {KINDS} = 7 AND NOT in_placeholder), '') AS leaked, coalesce(string_agg(DISTINCT cite, ',' ORDER BY cite) FILTER (NOT resolves), '') AS unresolvable,
  coalesce(string_agg(DISTINCT cite, ',' ORDER BY cite) FILTER (resolves AND NOT in_vocab), '') AS out_of_vocab FROM r GROUP BY doc_id),
ub AS (SELECT doc_id, coalesce(string_agg(DISTINCT url, ',' ORDER BY url) FILTER (class IN ('placeholder', 'fabricated')), '') AS bad_urls FROM cls GROUP BY doc_id),
du AS (SELECT doc_id, string_agg(DISTINCT url, ',' ORDER BY url) AS dead_urls FROM cls WHERE url IN (SELECT url FROM pages WHERE page_id % 9 = 1) GROUP BY doc_id),
bk AS (SELECT d.doc_id, coalesce(leaked, '') AS leaked, coalesce(unresolvable, '') AS unresolvable, coalesce(out_of_vocab, '') AS out_of_vocab, coalesce(bad_urls, '') AS bad_urls,
  CASE WHEN d.doc_id % 4 IN (2, 3) THEN 'fake' ELSE '' END AS invented_refs, CASE WHEN d.doc_id % 4 IN (0, 1) THEN 'gone' ELSE '' END AS dead_refs, coalesce(dead_urls, '') AS dead_urls,
  CASE WHEN d.doc_id % 6 = 2 THEN 'c' || CAST(d.doc_id AS VARCHAR) ELSE '' END AS failed_verdicts
  FROM documents d LEFT JOIN cb ON d.doc_id = cb.doc_id LEFT JOIN ub ON d.doc_id = ub.doc_id LEFT JOIN du ON d.doc_id = du.doc_id)"""


def _buckets(t: Tables) -> DataFrame:
    dead = t.raw("pages").where("page_id % 9 = 1").select("url").distinct()
    statuses = C.substitute_refs(_drafts(t), *_ref_tables(t))[1]
    cites = F.concat(F.lit("c"), F.col("doc_id").cast("string"))
    verdicts = t.raw("documents").select("doc_id", cites.alias("cite"), F.expr("CASE WHEN doc_id % 6 = 2 THEN 'fail' ELSE 'pass' END").alias("verdict"))
    return C.bucket_report(_resolved(t), _doc_urls(t), docs(t), statuses, dead.withColumn("status", F.lit("dead")), verdicts)


@query(sql=f"{BUCKETS} SELECT * FROM bk")
def bucket_report(t: Tables):
    return _buckets(t)


@query(
    sql=f"""{BUCKETS}, s AS (SELECT doc_id, concat_ws('; ', CASE WHEN leaked <> '' THEN 'citations written outside the protocol: ' || leaked END, CASE WHEN unresolvable <> '' THEN 'citations not in the trusted index: ' || unresolvable END,
  CASE WHEN out_of_vocab <> '' THEN 'citations outside the form''s scope: ' || out_of_vocab END, CASE WHEN bad_urls <> '' THEN 'made-up URLs: ' || bad_urls END,
  CASE WHEN invented_refs <> '' THEN 'placeholders that name no authority: ' || invented_refs END, CASE WHEN dead_refs <> '' THEN 'authorities whose link is dead: ' || dead_refs END,
  CASE WHEN dead_urls <> '' THEN 'URLs that are dead: ' || dead_urls END, CASE WHEN failed_verdicts <> '' THEN 'authorities that failed review: ' || failed_verdicts END) AS said FROM bk)
SELECT doc_id, said <> '' AS block, CASE WHEN said <> '' THEN 'Blocked: ' || said || '.' ELSE '' END AS reason FROM s""",
)
def guard_decision(t: Tables):
    return C.guard_decision(_buckets(t))


@query(
    sql=r"""WITH a AS (SELECT doc_id, 'c' || CAST(doc_id AS VARCHAR) AS cite, text FROM documents),
v AS (SELECT doc_id, cite, CASE doc_id % 4 WHEN 0 THEN 'pass' WHEN 1 THEN 'pass' WHEN 2 THEN 'fail' END AS verdict, doc_id % 4 <> 1 AS real FROM a WHERE doc_id % 4 < 3)
SELECT a.doc_id, a.cite, CASE WHEN v.verdict IS NULL THEN 'unclear' WHEN verdict = 'pass' AND NOT real THEN 'unclear' ELSE verdict END AS verdict, coalesce(real, false) AS grounded, v.verdict IS NULL AS unreviewed
FROM a LEFT JOIN v ON a.doc_id = v.doc_id""",
)
def quote_grounding(t: Tables):
    d = t.raw("documents").withColumn("cite", F.concat(F.lit("c"), F.col("doc_id").cast("string")))
    k = F.col("doc_id") % 4
    quote = F.when(k == 1, F.concat("text", F.lit(" never said"))).otherwise(F.regexp_replace("text", r"\s+", "  "))
    verdicts = d.where(k < 3).select("doc_id", "cite", F.when(k == 2, "fail").otherwise("pass").alias("verdict"), quote.alias("quote"))
    return C.quote_grounding(verdicts, d.select("doc_id", "cite"), d.select("cite", "text"))


LINKS = """WITH l AS (SELECT url, 'c' || CAST(page_id % 5 AS VARCHAR) AS cite FROM pages UNION ALL SELECT url, 'x' FROM pages WHERE page_id % 2 = 0),
s AS (SELECT url, min(CASE page_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 ELSE 503 END) AS code FROM pages WHERE page_id % 7 <> 0 GROUP BY url),
au AS (SELECT l.url, count(*) AS n_uses, string_agg(DISTINCT cite, ',' ORDER BY cite) AS cites, coalesce(any_value(CASE code WHEN 200 THEN 'live' WHEN 404 THEN 'dead' WHEN 403 THEN 'blocked' WHEN 503 THEN 'error' END), 'inconclusive') AS status
  FROM l LEFT JOIN s ON l.url = s.url GROUP BY l.url)"""


def _links(t: Tables) -> tuple[DataFrame, DataFrame]:
    p = t.raw("pages")
    links = p.select("url", F.concat(F.lit("c"), (F.col("page_id") % 5).cast("string")).alias("cite")).unionByName(p.where("page_id % 2 = 0").select("url", F.lit("x").alias("cite")))
    code = F.expr("CASE page_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 ELSE 503 END")
    status = p.where("page_id % 7 <> 0").groupBy("url").agg(F.min(code).alias("http_code"))
    return links, status


def _audit(t: Tables) -> DataFrame:
    return C.link_audit(*_links(t))


@query(sql=f"{LINKS}, uu AS (SELECT url, cite, count(*) AS n_uses FROM l GROUP BY ALL) SELECT uu.*, au.status FROM uu JOIN au ON uu.url = au.url")
def link_uses(t: Tables):
    return C.link_uses(*_links(t))


@query(sql=f"{LINKS} SELECT * FROM au")
def link_audit(t: Tables):
    return _audit(t)


@query(sql=f"{LINKS} SELECT status, count(*) AS n, CAST(sum(n_uses) AS BIGINT) AS n_uses FROM au GROUP BY status")
def link_counts(t: Tables):
    return C.link_counts(_audit(t))
