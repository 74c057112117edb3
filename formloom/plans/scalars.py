"""Column functions over whole texts, records and widgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.functions import schema_rules as S
from formloom.functions import text as X
from formloom.functions import values as V
from formloom.functions.html import html_to_text as read_html
from formloom.operators.pairs import prefixed
from formloom.plans.joins import IOU, OX, OY
from formloom.plans.registry import query
from formloom.sources.testdata import Tables


@query(
    uses="rect rect_b",
    sql=f"""SELECT a.form_id, a.page, a.rect_id, round({IOU}, 6) AS iou, (a.x1 - a.x0) * (a.y1 - a.y0) AS area, {OX} AS ox, {OY} AS oy,
  round(sqrt(((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2) ** 2 + ((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2) ** 2), 6) AS dist,
  (b.x0 + b.x1) / 2 BETWEEN a.x0 AND a.x1 AND (b.y0 + b.y1) / 2 BETWEEN a.y0 AND a.y1 AS inside
FROM rect a JOIN rect_b b ON a.form_id = b.form_id AND a.page = b.page AND a.rect_id = b.rect_id""",
)
def rect_functions(t: Tables):
    a, b = G.box(), G.box("r_")
    key = ["form_id", "page", "rect_id"]
    other = prefixed(t.rect_b)
    joined = t.rect.join(other, [F.col(k) == F.col("r_" + k) for k in key])
    return joined.select(
        *key, F.round(G.rect_iou(a, b), 6).alias("iou"), G.rect_area(a).alias("area"), G.overlap_x(a, b).alias("ox"),
        G.overlap_y(a, b).alias("oy"), F.round(G.center_dist(a, b), 6).alias("dist"),
        G.contains_point(a, G.center_x(b), G.center_y(b)).alias("inside"),
    )


SNAKE = r"regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(trim(text), '[:.\s]+$', ''))), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '^([0-9])', 'f_\1')"


@query(sql=f"SELECT doc_id, {SNAKE} AS name FROM documents")
def to_snake_case(t: Tables):
    return t.raw("documents").select("doc_id", X.to_snake_case(F.col("text")).alias("name"))


@query(
    uses="field",
    sql=f"""SELECT form_id, seq, CASE WHEN regexp_matches(trim(regexp_replace(text, '[:. ]+$', '')), '^[a-z][a-z0-9_]*$') THEN trim(regexp_replace(text, '[:. ]+$', '')) ELSE {SNAKE} END AS name
FROM (SELECT form_id, seq, CASE WHEN size % 2 = 0 THEN field_id || ':' ELSE CAST(size AS VARCHAR) || '. ' || label || ' .' END AS text FROM field)""",
)
def clean_label(t: Tables):
    text = F.when(F.col("size") % 2 == 0, F.concat("field_id", F.lit(":"))).otherwise(
        F.concat(F.col("size").cast("string"), F.lit(". "), "label", F.lit(" ."))
    )
    return t.field.select("form_id", "seq", X.clean_label(text).alias("name"))


@query(
    sql="""SELECT doc_id, CASE WHEN s = '' THEN 'field' ELSE s END AS slug FROM (SELECT doc_id,
  left(regexp_replace(regexp_replace(regexp_replace(trim(lower(text)), '[:.,?#]+$', ''), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 45) AS s FROM documents)""",
)
def slugify(t: Tables):
    return t.raw("documents").select("doc_id", X.slugify(F.col("text")).alias("slug"))


CATS = ("case_constant", "party_attr", "computed", "signature", "external", "narrative_derived", "legal_choice", "other")
CAT_SQL = "CASE size % 8 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CATS)) + " END"


def _classified(t: Tables):
    cat = F.element_at(F.array(*[F.lit(c) for c in CATS]), F.col("size") % 8 + 1)
    return t.field.select(
        "form_id", "seq", "field_id", "size", cat.alias("category"),
        F.when(F.col("seq") % 4 == 0, "repeating_slot").otherwise(F.col("label")).alias("subcategory"),
        (F.col("seq") % 3).cast("int").alias("wrong"), (F.col("seq") % 4).cast("int").alias("over"), (F.col("seq") % 2).cast("int").alias("mis"),
    )


RISK = f"""WITH c AS (SELECT form_id, seq, {CAT_SQL} AS category, seq % 4 = 0 AS slot, seq % 3 AS w, seq % 4 AS o, seq % 2 AS m FROM field),
s AS (SELECT form_id, seq, CAST(least(100, greatest(0, CASE category WHEN 'signature' THEN 5 WHEN 'external' THEN 5 WHEN 'narrative_derived' THEN 5 WHEN 'legal_choice' THEN 20 WHEN 'other' THEN 30 ELSE 0 END
  + CASE WHEN slot THEN 15 ELSE 0 END + w * 20 + o * 8 + m * 12)) AS INTEGER) AS score FROM c)"""


@query(
    uses="field",
    sql=f"{RISK} SELECT *, CASE WHEN score <= 15 THEN 'green' WHEN score <= 35 THEN 'yellow' WHEN score <= 65 THEN 'orange' ELSE 'red' END AS tier FROM s",
)
def risk_score(t: Tables):
    score = S.risk_score(F.col("category"), F.col("subcategory"), F.col("wrong"), F.col("over"), F.col("mis"))
    return _classified(t).select("form_id", "seq", score.alias("score")).withColumn("tier", S.risk_tier(F.col("score")))


SUFFIXES = ("value", "date", "phone", "email", "address", "bar_no", "name_address", "note", "street", "fee")
SUF_SQL = "CASE seq % 10 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUFFIXES)) + " END"


@query(
    uses="field",
    sql=rf"""WITH c AS (SELECT form_id, seq, replace(label, ' ', '_') || '_' || {SUF_SQL} AS name, {CAT_SQL} AS category FROM field)
SELECT form_id, seq, CASE WHEN category = 'signature' THEN 'signature' WHEN category = 'computed' THEN 'currency'
  WHEN regexp_matches(name, '_(name_address(_email|_phone|_email_phone)?|address_email_phone|email_phone)$') THEN 'text' WHEN regexp_matches(name, '_(val|value|amount|enc|encumbrance|fee|cost|price)$') THEN 'currency'
  WHEN regexp_matches(name, '_(date|dated|on)$') THEN 'date' WHEN regexp_matches(name, '_(phone|fax|telephone)$') THEN 'phone' WHEN regexp_matches(name, '_email$') THEN 'email'
  WHEN regexp_matches(name, '_(address|street)$') THEN 'address' WHEN regexp_matches(name, '_bar(_no|_number|)?$') THEN 'bar_number' WHEN category = 'legal_choice' THEN 'checkbox' ELSE 'text' END AS data_type FROM c""",
)
def data_type_by_name(t: Tables):
    suffix = F.element_at(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("seq") % 10 + 1).cast("int"))
    name = F.concat_ws("_", F.regexp_replace("label", " ", "_"), suffix)
    cat = F.element_at(F.array(*[F.lit(c) for c in CATS]), F.col("size") % 8 + 1)
    return t.field.select("form_id", "seq", S.data_type_by_name(name, cat).alias("data_type"))


NAME_CLASSES = (("^red_", "case_constant"), ("ring", "party_attr"), ("_[3-6]$", "narrative_derived"))


@query(
    uses="field",
    sql="""SELECT form_id, seq, CASE WHEN regexp_matches(field_id, '^red_') THEN 'case_constant' WHEN regexp_matches(field_id, 'ring') THEN 'party_attr'
  WHEN regexp_matches(field_id, '_[3-6]$') THEN 'narrative_derived' ELSE 'other' END AS category FROM field""",
)
def classify_by_name(t: Tables):
    return t.field.select("form_id", "seq", S.first_match(F.col("field_id"), NAME_CLASSES, "other").alias("category"))


@query(
    uses="field",
    sql=f"""WITH c AS (SELECT form_id, seq, {CAT_SQL} AS category, CASE WHEN seq % 4 = 0 THEN 'repeating_slot' ELSE label END AS sub FROM field)
SELECT form_id, seq, CASE category WHEN 'case_constant' THEN 'case_dict.' || sub WHEN 'party_attr' THEN 'heir_record.' || sub WHEN 'computed' THEN 'recompute_from_dependencies' WHEN 'signature' THEN 'wet_ink'
  WHEN 'external' THEN 'left_blank' WHEN 'legal_choice' THEN 'human_decision' WHEN 'narrative_derived' THEN 'llm_over_narrative' ELSE 'triage' END AS source,
  CASE WHEN category IN ('case_constant', 'party_attr', 'computed') THEN 'rules' WHEN category IN ('signature', 'legal_choice') THEN 'person' WHEN category = 'external' THEN 'nobody'
  WHEN category = 'narrative_derived' THEN 'model' ELSE 'model_then_person' END AS actor FROM c""",
)
def fill_strategy(t: Tables):
    return _classified(t).select(
        "form_id", "seq", S.fill_source(F.col("category"), F.col("subcategory"), F.lit("heir")).alias("source"), S.fill_actor(F.col("category")).alias("actor")
    )


SOURCES = ("case_dict.county", "heir_record.heir.phone", "wet_ink", "llm_over_narrative", "recompute_from_dependencies", "triage", "left_blank", "other.key")
SRC_SQL = "CASE size % 8 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SOURCES)) + " END"


def _bound(t: Tables):
    source = F.element_at(F.array(*[F.lit(s) for s in SOURCES]), F.col("size") % 8 + 1)
    ftype = F.when(F.col("seq") % 3 == 0, "select_one").when(F.col("seq") % 3 == 1, "select_many").otherwise("text")
    return t.field.withColumns({"source": source, "field_type": ftype})


BOUND = f"""WITH f AS (SELECT *, {SRC_SQL} AS source, CASE seq % 3 WHEN 0 THEN 'select_one' WHEN 1 THEN 'select_many' ELSE 'text' END AS field_type FROM field),
h AS (SELECT *, string_split(source, '.')[1] AS head, CASE WHEN contains(source, '.') THEN regexp_replace(source, '^[^.]*\\.', '') ELSE field_id END AS attr,
  CASE field_type WHEN 'select_one' THEN 'choice' WHEN 'select_many' THEN 'choice_multi' END AS ch FROM f),
k AS (SELECT *, CASE head WHEN 'wet_ink' THEN 'signature' WHEN 'left_blank' THEN 'manual' WHEN 'llm_over_narrative' THEN 'narrative' WHEN 'recompute_from_dependencies' THEN 'computed' WHEN 'triage' THEN 'routing' ELSE 'data' END AS kind,
  CASE WHEN head = 'case_dict' THEN 'matter' WHEN ends_with(head, '_record') THEN regexp_replace(head, '_record$', '') ELSE head END AS role,
  CASE data_type WHEN 'currency' THEN 'currency' WHEN 'date' THEN 'date' WHEN 'boolean' THEN coalesce(ch, 'boolean') ELSE coalesce(ch, 'string') END AS canonical_type FROM h),
b AS (SELECT form_id, seq, field_id, label, data_type, size, canonical_type, kind, CASE WHEN kind = 'data' THEN role END AS role, CASE WHEN kind = 'data' THEN attr END AS key,
  CASE WHEN kind = 'data' THEN CASE WHEN ends_with(head, '_record') THEN role || '_' || attr ELSE attr END END AS token, source FROM k)"""


@query(uses="field", sql=f"{BOUND} SELECT form_id, seq, canonical_type, kind, role, key, token FROM b")
def binding(t: Tables):
    b = S.binding(F.col("source"), F.col("field_id"), F.col("data_type"))
    return _bound(t).select("form_id", "seq", S.canonical_type(F.col("data_type"), F.col("field_type")).alias("canonical_type"), b.alias("b")).select(
        "form_id", "seq", "canonical_type", "b.*"
    )


@query(
    uses="rect",
    sql="""SELECT form_id, page, rect_id, CASE WHEN contains(field_id, '3') THEN 'center' WHEN kind = 'currency' THEN 'right' ELSE 'left' END AS declared,
  CASE WHEN abs((x0 + x1) / 2 - 306) <= 10 THEN 'center' WHEN x0 > 306 THEN 'right' ELSE 'left' END AS suggested FROM rect""",
)
def alignment(t: Tables):
    name = F.when(F.col("field_id").contains("3"), "case_caption").otherwise(F.col("field_id"))
    return t.rect.select(
        "form_id", "page", "rect_id", S.alignment(name, F.col("kind")).alias("declared"),
        S.layout_alignment(F.col("x0"), F.col("x1"), 612.0).alias("suggested"),
    )


@query(
    sql="""SELECT o_orderkey AS record_id, array_to_string(list_filter([trim(o_orderpriority), CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END, 'c' || CAST(o_custkey % 7 AS VARCHAR)], lambda x: x <> ''), '; ') AS rendered,
  o_orderpriority || ', ' || o_orderstatus || '; ' || 'x, y' AS records FROM orders""",
)
def render_value(t: Tables):
    items = F.array(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderstatus")), F.concat(F.lit("c"), (F.col("o_custkey") % 7).cast("string")))
    recs = F.array(F.struct(F.col("o_orderpriority").alias("a"), F.col("o_orderstatus").alias("b")), F.struct(F.lit("x").alias("a"), F.lit("y").alias("b")))
    return t.raw("orders").select(F.col("o_orderkey").alias("record_id"), V.render_list(items).alias("rendered"), V.render_records(recs, ["a", "b"]).alias("records"))


@query(
    sql="""SELECT event_id, CASE event_type WHEN 'signup' THEN true WHEN 'error' THEN false WHEN 'click' THEN true WHEN 'view' THEN false END AS answer FROM events""",
)
def truthy(t: Tables):
    word = F.expr("CASE event_type WHEN 'signup' THEN ' Yes' WHEN 'error' THEN 'OFF' WHEN 'click' THEN 'x' WHEN 'view' THEN '' ELSE 'perhaps' END")
    return t.raw("events").select("event_id", V.truthy(word).alias("answer"))


WRITTEN = """WITH w AS (SELECT o_orderkey AS record_id, CASE o_orderkey % 9 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN strftime(o_orderdate, '%-m/%-d/%y')
  WHEN 3 THEN strftime(o_orderdate, '%B %d, %Y') WHEN 4 THEN strftime(o_orderdate, '%b %d, %Y') WHEN 5 THEN strftime(o_orderdate, '%B %d %Y') WHEN 6 THEN strftime(o_orderdate, '%d %B %Y')
  WHEN 7 THEN '2024-02-31' ELSE 'soon' END AS value, CAST(o_orderdate AS DATE) AS truth FROM orders),
p AS (SELECT *, CASE WHEN record_id % 9 < 7 THEN truth END AS parsed FROM w)"""


def _written(t: Tables):
    f = lambda fmt: F.date_format("o_orderdate", fmt)
    k = F.col("o_orderkey") % 9
    forms = ["yyyy-MM-dd", "MM/dd/yyyy", "M/d/yy", "MMMM dd, yyyy", "MMM dd, yyyy", "MMMM dd yyyy", "dd MMMM yyyy"]
    value = F.when(k == 7, "2024-02-31").when(k == 8, "soon")
    for i, fmt in enumerate(forms):
        value = value.when(k == i, f(fmt))
    return t.raw("orders").select(F.col("o_orderkey").alias("record_id"), value.alias("value"))


@query(sql=f"{WRITTEN} SELECT record_id, parsed FROM p")
def parse_date_any(t: Tables):
    return _written(t).select("record_id", V.parse_date_any(F.col("value")).alias("parsed"))


@query(
    sql=f"""{WRITTEN} SELECT record_id, strftime(parsed, '%B %-d') AS month_day, strftime(parsed, '%y') AS year2, strftime(parsed, '%-d') AS day, strftime(parsed, '%B') AS month FROM p""",
)
def split_date(t: Tables):
    s, w = V.split_date(F.col("value")), V.date_words(F.col("value"))
    return _written(t).select("record_id", s.alias("s"), w.alias("w")).select("record_id", "s.month_day", "s.year2", "w.day", "w.month")


@query(
    uses="answer",
    sql="""SELECT record_id, field_id, TRY_CAST(nullif(replace(replace(regexp_replace(trim(value), '[$,%]', '', 'g'), '(', '-'), ')', ''), '') AS DECIMAL(18,2)) AS number FROM answer""",
)
def parse_number(t: Tables):
    return t.answer.select("record_id", "field_id", V.parse_number(F.col("value")).alias("number"))


@query(
    uses="answer",
    sql=r"""SELECT record_id, field_id, regexp_replace(regexp_extract(value, '\$?\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?|\$\d+(?:\.\d{1,2})?'), '^\$+', '') AS amount FROM answer""",
)
def extract_currency(t: Tables):
    return t.answer.select("record_id", "field_id", V.extract_currency(F.col("value")).alias("amount"))


@query(
    sql="""SELECT o_orderkey AS record_id, CASE WHEN a BETWEEN 1 AND 119 THEN a END AS age, CAST(d + INTERVAL 30 DAY AS DATE) AS later, CAST(d + INTERVAL 5 YEAR AS DATE) AS anniversary
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(2024 - year(o_orderdate) - CASE WHEN 615 < month(o_orderdate) * 100 + day(o_orderdate) THEN 1 ELSE 0 END AS INTEGER) AS a FROM orders)""",
)
def age_on(t: Tables):
    d = F.col("o_orderdate").cast("date")
    return t.raw("orders").select(
        F.col("o_orderkey").alias("record_id"), V.age_on(d, F.lit("2024-06-15").cast("date")).alias("age"),
        V.shift_date(d, days=30).alias("later"), V.shift_date(d, years=5).alias("anniversary"),
    )


@query(
    sql="""SELECT c_custkey AS case_id, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE concat_ws(' ', c_mktsegment, nullif('', ''), 'N' || CAST(c_nationkey AS VARCHAR)) END AS name,
  concat_ws(' ', concat_ws(', ', c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN c_name END, 'ME'), CASE WHEN c_custkey % 5 <> 0 THEN '04' || CAST(c_nationkey AS VARCHAR) END) AS address FROM customer""",
)
def full_name(t: Tables):
    k = F.col("c_custkey")
    n = F.col("c_nationkey").cast("string")
    return t.raw("customer").select(
        k.alias("case_id"),
        V.full_name(F.when(k % 3 == 0, F.col("c_name")), F.col("c_mktsegment"), F.lit(""), F.concat(F.lit("N"), n)).alias("name"),
        V.address_line(F.col("c_mktsegment"), F.when(k % 2 == 0, F.col("c_name")).otherwise(" "), F.lit("ME"), F.when(k % 5 != 0, F.concat(F.lit("04"), n))).alias("address"),
    )


@query(sql="SELECT doc_id, text || '-1 2' AS folded FROM (SELECT doc_id, translate(text, chr(8208) || chr(8209) || chr(8210) || chr(8211) || chr(8722), '-----') AS text FROM documents)")
def fold_lookalikes(t: Tables):
    planted = F.concat("text", F.lit("\u20111\u00a0\u200b2"))
    return t.raw("documents").select("doc_id", V.fold_lookalikes(planted).alias("folded"))


@query()
def html_to_text(t: Tables):
    return t.raw("pages").select("page_id", read_html("html").alias("text"))


@query(
    sql=r"""WITH p AS (SELECT doc_id, text, 'Intro' || chr(10) || '§ ' || CAST(doc_id % 3 AS VARCHAR) || '-101 Head' || chr(10) || text || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '§ 9-999 Next' || chr(10) || 'tail' ELSE 'Data for this page' END AS body FROM documents)
SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN trim('§ 1-101 Head' || chr(10) || text || CASE WHEN doc_id % 2 = 0 THEN '' ELSE chr(10) END, ' ') ELSE body END AS section FROM p""",
)
def extract_section(t: Tables):
    k = F.col("doc_id")
    body = F.concat(
        F.lit("Intro\n§ "), (k % 3).cast("string"), F.lit("-101 Head\n"), "text", F.lit("\n"),
        F.when(k % 2 == 0, "§ 9-999 Next\ntail").otherwise("Data for this page"),
    )
    return t.raw("documents").select("doc_id", V.extract_section(body, "§ 1-101", r"\n§\s*[0-9]", ["Data for this page"]).alias("section"))


@query(
    sql="""SELECT event_id, CASE WHEN c BETWEEN 200 AND 399 THEN 'live' WHEN c IN (404, 410) THEN 'dead' WHEN c IN (401, 403, 405, 429) THEN 'blocked' WHEN c BETWEEN 500 AND 599 THEN 'error' ELSE 'inconclusive' END AS status
FROM (SELECT event_id, 190 + event_id % 420 AS c FROM events)""",
)
def link_status(t: Tables):
    return t.raw("events").select("event_id", V.link_status(190 + F.col("event_id") % 420).alias("status"))


@query(
    sql="""SELECT event_id, sha256('{"event_type":"' || event_type || '","id":' || CAST(event_id AS VARCHAR) || ',"user":' || CAST(user_id AS VARCHAR) || '}') AS digest FROM events""",
)
def canonical_json(t: Tables):
    text = V.canonical_json(id=F.col("event_id"), user=F.col("user_id"), event_type=F.col("event_type"))
    return t.raw("events").select("event_id", V.digest(text).alias("digest"))


@query(
    sql="""SELECT c_custkey AS case_id, CAST(('0x' || substr(sha256(c_name), 1, 8))::BIGINT % 7 AS INTEGER) AS pick,
  list_extract(['ash', 'birch', 'cedar'], 1 + CAST(('0x' || substr(sha256(c_name), 1, 8))::BIGINT % 3 AS INTEGER)) AS choice FROM customer""",
)
def seeded_pick(t: Tables):
    return t.raw("customer").select(
        F.col("c_custkey").alias("case_id"), V.seeded_pick(F.col("c_name"), 7).alias("pick"), V.seeded_choice(F.col("c_name"), ["ash", "birch", "cedar"]).alias("choice")
    )


@query()
def wrap_lines(t: Tables):
    """Whole document texts over three widgets each, with the words left over."""
    caps = F.array(V.capacity(F.lit(400.0), 5.0), V.capacity(300.0 + F.col("doc_id") % 50, 5.0), F.lit(60))
    wrapped = V.wrap_lines(F.col("text"), caps)
    return t.raw("documents").select("doc_id", wrapped.alias("w")).select("doc_id", F.array_join("w.lines", "|").alias("lines"), "w.rest")


@query(
    sql="""WITH a AS (SELECT c_custkey AS case_id, CASE c_custkey % 4 WHEN 0 THEN c_name ELSE concat_ws(', ', c_mktsegment, c_name, CASE WHEN c_custkey % 4 = 2 THEN 'ME 04' || CAST(c_nationkey AS VARCHAR) END, CASE WHEN c_custkey % 4 = 3 THEN 'X' END) END AS v FROM customer),
s AS (SELECT case_id, v, string_split(v, ', ') AS p FROM a)
SELECT case_id, CASE WHEN len(p) < 2 THEN v || '|' ELSE p[1] || '|' || array_to_string(p[2:], ', ') END AS two,
  CASE WHEN len(p) < 2 THEN v || '||' ELSE p[1] || '|' || coalesce(p[2], '') || '|' || array_to_string(p[3:], ', ') END AS three FROM s""",
)
def split_address(t: Tables):
    k = F.col("c_custkey")
    v = F.when(k % 4 == 0, F.col("c_name")).otherwise(
        F.concat_ws(", ", "c_mktsegment", "c_name", F.when(k % 4 == 2, F.concat(F.lit("ME 04"), F.col("c_nationkey").cast("string"))), F.when(k % 4 == 3, "X"))
    )
    return t.raw("customer").select(
        k.alias("case_id"), F.array_join(V.split_address(v, 2), "|").alias("two"), F.array_join(V.split_address(v, 3), "|").alias("three")
    )


@query(
    uses="rect",
    sql="""WITH o AS (SELECT form_id, field_id, page, y0, x0, x1, lag(page) OVER w AS pp, lag(y0) OVER w AS py, lag(x1) OVER w AS px FROM rect WINDOW w AS (PARTITION BY form_id, field_id ORDER BY page, y0, x0, rect_id))
SELECT form_id, field_id, count(*) AS n, CASE WHEN count(*) < 2 THEN 'single' WHEN bool_or(page <> pp OR y0 - py > 60) THEN 'replicate' WHEN bool_or(abs(y0 - py) < 5 AND x0 < px + 5) THEN 'first_only' ELSE 'wrap' END AS mode FROM o GROUP BY ALL""",
)
def widget_mode(t: Tables):
    from formloom.operators.records import widget_mode as mode

    return mode(t.rect)


@query(
    sql="""WITH r AS (SELECT event_id, event_type, CAST(value AS VARCHAR) AS v FROM events)
SELECT event_id, event_type AS name, event_id % 10 AS n FROM r UNION ALL SELECT event_id, 'next', event_id % 3 FROM r WHERE event_id % 2 = 0""",
)
def recover_json_objects(t: Tables):
    k = F.col("event_id")
    first = F.concat(F.lit('```json\n[{"name": "'), "event_type", F.lit('", "n": '), (k % 10).cast("string"), F.lit(",}"))
    second = F.when(k % 2 == 0, F.concat(F.lit(', {"name": "next", "n": '), (k % 3).cast("string"), F.lit("}"))).otherwise("")
    text = F.concat(first, second, F.lit(', {"name": "cut", "n": '))
    found = V.recover_json_objects(text, "name STRING, n BIGINT")
    return t.raw("events").select("event_id", F.explode(found).alias("o")).select("event_id", "o.name", "o.n")


@query(
    uses="field",
    sql="""SELECT form_id, seq, CASE seq % 4 WHEN 0 THEN field_id WHEN 1 THEN field_id WHEN 2 THEN NULL ELSE NULL END AS suggested FROM field""",
)
def extract_rename(t: Tables):
    k = F.col("seq") % 4
    text = (
        F.when(k == 0, F.concat(F.lit("name should be '"), "field_id", F.lit("'")))
        .when(k == 1, F.concat(F.lit("rename to "), "field_id", F.lit(" please")))
        .when(k == 2, F.concat(F.lit("perhaps rename to "), "field_id"))
        .otherwise("label is wrong")
    )
    patterns = [r"(?i)should be ['\"`]([a-z][a-z0-9_]+)['\"`]", r"(?i)rename to ([a-z][a-z0-9_]+)"]
    return t.field.select("form_id", "seq", V.extract_rename(text, patterns).alias("suggested"))


@query(
    uses="answer",
    sql="""SELECT record_id, field_id FROM answer WHERE field_id = 'priority' AND record_id % 3 < 2""",
)
def repr_leaks(t: Tables):
    v = F.col("value")
    k = F.col("record_id") % 3
    shown = F.when(k == 0, F.concat(F.lit("['"), v, F.lit("']"))).when(k == 1, F.concat(F.lit("{'a': '"), v, F.lit("'}"))).otherwise(v)
    return t.answer.where("field_id = 'priority'").withColumn("value", shown).where(X.is_repr_leak(F.col("value"))).select("record_id", "field_id")
