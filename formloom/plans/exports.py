"""Readers and exports over tables packed the way files hold them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom import contracts
from formloom.operators.reports import field_catalog
from formloom.plans.registry import query
from formloom.plans.scalars import BOUND, _bound
from formloom.sources import readers, writers
from formloom.sources.testdata import Tables
from formloom.streaming.jobs import run_folder


@query(
    uses="span",
    sql="SELECT form_id, page, text, x0, y0, x1, y1 FROM span",
)
def read_layout(t: Tables):
    """Spans packed into nested layouts, one document a page, and read back."""
    rect = F.struct("x0", "y0", "x1", "y1")
    line = F.struct(rect.alias("bbox"), F.array(F.struct("text", rect.alias("bbox"))).alias("spans"))
    page = t.span.groupBy("form_id", "page").agg(F.array_sort(F.collect_list(F.struct("span_id", line.alias("line")))).alias("ls"))
    lines = F.transform("ls", lambda x: x["line"])
    packed = page.select(
        F.to_json(
            F.struct(
                F.col("form_id").cast("string").alias("form_id"),
                F.array(F.struct(F.col("page").alias("page_number"), F.lit(612.0).alias("width"), F.lit(792.0).alias("height"), F.array(F.struct(lines.alias("lines"))).alias("text_blocks"))).alias("pages"),
            )
        ).alias("doc")
    )
    layout = readers.flatten_layout(packed.select(F.from_json("doc", contracts.LAYOUT).alias("d")).select("d.*"))
    return layout.spans.select(F.col("form_id").cast("bigint").alias("form_id"), "page", "text", "x0", "y0", "x1", "y1")


@query(
    uses="rect",
    sql="""WITH n AS (SELECT *, CAST(row_number() OVER (PARTITION BY form_id, field_id, kind = 'choice' ORDER BY page, rect_id) - 1 AS INTEGER) AS idx FROM rect)
SELECT form_id, field_id, CASE WHEN kind = 'choice' THEN 'choice' ELSE 'text' END AS kind, idx, page, x0, y0, x1, y1, CASE WHEN kind = 'choice' THEN 'o' || CAST(rect_id AS VARCHAR) END AS option_value FROM n""",
)
def explode_geometry(t: Tables):
    rect = F.array("x0", "y0", "x1", "y1")
    item = F.struct("page", "rect_id", rect.alias("rect"))
    chosen = F.col("kind") == "choice"
    fields = t.rect.groupBy("form_id", "field_id").agg(
        F.array_sort(F.collect_list(F.when(~chosen, item))).alias("ws"), F.array_sort(F.collect_list(F.when(chosen, item))).alias("os")
    )
    spec = F.struct(
        F.lit("text").alias("type"),
        F.transform("ws", lambda w: F.struct(w["page"].alias("page"), w["rect"].alias("rect"))).alias("widgets"),
        F.transform("os", lambda w: F.struct(w["page"].alias("page"), w["rect"].alias("rect"), F.concat(F.lit("o"), w["rect_id"].cast("string")).alias("value"))).alias("options"),
    )
    packed = fields.groupBy("form_id").agg(F.map_from_entries(F.collect_list(F.struct("field_id", spec.alias("spec")))).alias("fields"))
    return readers.explode_geometry(packed)


@query(
    uses="answer",
    sql="SELECT record_id, field_id, value FROM answer",
)
def flatten_answers(t: Tables):
    """Records packed in the three accepted shapes, by key, and flattened."""
    pair = F.struct("field_id", "value")
    packed = t.answer.groupBy("record_id").agg(F.collect_list(pair).alias("ps"))
    k = F.col("record_id") % 3
    as_map = F.map_from_entries(F.transform("ps", lambda p: F.struct(p["field_id"], F.struct(p["value"].alias("value"), F.lit(0.5).alias("confidence")))))
    body = (
        F.when(k == 0, F.to_json(F.struct(as_map.alias("answers"))))
        .when(k == 1, F.to_json(F.struct(F.col("ps").alias("fields"))))
        .otherwise(F.to_json(F.map_from_entries("ps")))
    )
    return readers.flatten_answers(packed.select("record_id", body.alias("body")))


def _log_lines(t: Tables) -> DataFrame:
    """Events as JSON lines, every seventh cut short."""
    line = F.to_json(F.struct("event_id", F.col("event_type").alias("verdict")))
    cut = F.when(F.col("event_id") % 7 == 0, line.substr(F.lit(1), F.length(line) - 3)).otherwise(line)
    return t.raw("events").select(F.col("event_id").alias("line_no"), cut.alias("line"))


@query(sql="SELECT event_id AS line_no, event_id, event_type AS verdict FROM events WHERE event_id % 7 <> 0")
def read_jsonl_log(t: Tables):
    return readers.parse_log_lines(_log_lines(t), "event_id bigint, verdict string")[0]


@query(sql="SELECT event_id AS line_no FROM events WHERE event_id % 7 = 0")
def malformed_log_lines(t: Tables):
    return readers.parse_log_lines(_log_lines(t), "event_id bigint, verdict string")[1].select("line_no")


@query(
    sql=r"""WITH u AS (SELECT page_id, regexp_replace(url, '^https?://[^/]+', '') AS rest FROM pages), p AS (SELECT page_id, regexp_extract(rest, '^([^?#]*)', 1) AS path FROM u),
s AS (SELECT page_id, string_split(path, '/') AS ps FROM p),
f AS (SELECT page_id, 'AA' || CAST(page_id % 9 AS VARCHAR) || ' Notice_ x and y ' || ps[-1] || '.pdf' AS file_name, ps[-2] AS seg FROM s)
SELECT page_id, file_name, 'AA' || CAST(page_id % 9 AS VARCHAR) AS form_id, CASE seg WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' ELSE 'other' END AS category FROM f""",
)
def inventory_urls(t: Tables):
    """Page addresses given encoded file names."""
    base = F.regexp_extract("url", r"^(https?://[^/]+/(?:[^?#]*/)?)[^/?#]*", 1)
    last = F.regexp_extract("url", r"^https?://[^/]+/(?:[^?#]*/)?([^/?#]*)", 1)
    name = F.concat(F.lit("AA"), (F.col("page_id") % 9).cast("string"), F.lit("%20Notice,%20%20x%20%26%20y%20"), last, F.lit(".pdf"))
    urls = t.raw("pages").select("page_id", F.concat(base, name).alias("url"))
    categories = t.spark.createDataFrame([("en", "english"), ("fr", "french")], "segment string, category string")
    return readers.inventory_urls(urls, categories).drop("url")


@query(
    sql="""SELECT 'D' || CAST(doc_id AS VARCHAR) AS form_id, 'Title ' || CAST(doc_id AS VARCHAR) AS title, CASE WHEN doc_id % 4 = 0 THEN 'forced' WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS anchor,
  CASE WHEN doc_id % 4 <> 0 AND doc_id % 3 = 0 THEN 'anchor' ELSE '' END AS missing FROM documents WHERE doc_id % 5 <> 0""",
)
def front_matter_index(t: Tables):
    """Documents given a header, except every fifth."""
    k = F.col("doc_id")
    anchor = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit('"'), "lang", F.lit('"')))
    head = F.concat(F.lit("---\ntitle: Title "), k.cast("string"), F.lit("\nanchor: "), anchor, F.lit("\n---\n"))
    form = F.concat(F.lit("D"), k.cast("string"))
    texts = t.raw("documents").select(form.alias("form_id"), F.when(k % 5 == 0, F.col("text")).otherwise(F.concat(head, "text")).alias("text"))
    overrides = t.raw("documents").where("doc_id % 4 = 0").select(form.alias("form_id"), F.lit("forced").alias("anchor"))
    return readers.front_matter_index(texts, ["title", "anchor"], ["title", "anchor"], overrides)


def _exportable(t: Tables) -> DataFrame:
    tree = F.when(F.col("size") % 3 == 0, F.lit('{"all_of": [{"field": "a", "equals": "yes"}, {"field": "b", "equals": "2"}]}')).when(
        F.col("size") % 3 == 1, F.lit('{"any_of": [{"field": "c", "equals": "no"}]}')
    )
    return _bound(t).withColumn("required_when", tree)


@query(
    uses="field",
    sql=f"""{BOUND} SELECT form_id, seq, field_id, label, canonical_type, data_type, coalesce(role, '') AS role, coalesce(key, '') AS key, coalesce(token, '') AS token, kind AS binding_kind,
  CASE size % 3 WHEN 0 THEN '(a == yes AND b == 2)' WHEN 1 THEN 'c == no' ELSE '' END AS required_when FROM b""",
)
def export_dictionary(t: Tables):
    return writers.export_dictionary(_exportable(t))


VARS = f"""{BOUND}, v AS (SELECT form_id, coalesce(token, field_id) AS name, field_id, label, canonical_type, role, kind, seq FROM b WHERE kind NOT IN ('manual', 'signature', 'routing')),
w AS (SELECT *, count(*) OVER (PARTITION BY form_id, name) AS n_fields, row_number() OVER (PARTITION BY form_id, name ORDER BY seq, field_id) AS k FROM v)"""


@query(uses="field", sql=f"{VARS} SELECT form_id, name, field_id, label, canonical_type, role, kind, n_fields FROM w WHERE k = 1")
def export_variables(t: Tables):
    return writers.export_variables(_exportable(t))


#: Conditions of all branches and leaves, by the size of the part.
TREES = (
    '{"all_of":[{"field":"a","equals":"yes"},{"field":"b","equals":2},{"field":"a","equals":true}]}',
    '{"any_of":[{"field":"c","in":["x","y"]},{"field":"d","gte":1.5}]}',
    '{"none_of":[{"field":"e","ne":"no \\"quote\\""},{"field":"f","exists":true}]}',
    '{"all_of":[{"field":"g","odd":1}]}',
)
TREE_SCHEMAS = (
    '{"properties":{"b":{"const":2},"a":{"const":true}},"required":["b","a"]}',
    '{"anyOf":[{"properties":{"c":{"enum":["x","y"]}},"required":["c"]},{"properties":{"d":{"minimum":1.5}},"required":["d"]}]}',
    '{"not":{"anyOf":[{"properties":{"e":{"not":{"const":"no \\"quote\\""}}},"required":["e"]},{"properties":{"f":{}},"required":["f"]}]}}',
)


@query(
    uses="field",
    sql=f"""{BOUND}, x AS (SELECT b.*, coalesce(b.token, b.field_id) AS name, CASE WHEN size % 7 = 0 THEN 'g' || CAST(seq % 4 AS VARCHAR) END AS grp, CASE WHEN size % 2 = 0 THEN 'v' || CAST(seq AS VARCHAR) END AS val,
  CASE WHEN size % 6 < 4 THEN CAST(size % 6 AS INTEGER) END AS tree FROM b),
o AS (SELECT form_id, grp, '[' || string_agg('"' || coalesce(val, label) || '"', ',' ORDER BY seq, field_id) || ']' AS options FROM x WHERE grp IS NOT NULL GROUP BY ALL),
w AS (SELECT * FROM x WHERE kind NOT IN ('manual', 'signature', 'routing') QUALIFY row_number() OVER (PARTITION BY form_id, name ORDER BY seq, field_id) = 1),
p AS (SELECT w.form_id, name, '"' || name || '":{{' || CASE canonical_type WHEN 'currency' THEN '"type":"number"' WHEN 'date' THEN '"type":"string","format":"date"' WHEN 'boolean' THEN '"type":"boolean"'
    WHEN 'choice' THEN '"type":"string"' || coalesce(',"enum":' || options, '') WHEN 'choice_multi' THEN '"type":"array","items":{{"type":"string"' || coalesce(',"enum":' || options, '') || '}}' ELSE '"type":"string"' END
    || ',"description":"' || label || '"' || CASE WHEN kind = 'computed' THEN ',"readOnly":true' ELSE '' END || '}}' AS prop,
  CASE WHEN kind = 'data' AND tree IS NULL AND size % 5 > 0 THEN '"' || name || '"' END AS req,
  '{{"if":' || [{", ".join(f"'{s}'" for s in TREE_SCHEMAS)}][tree + 1] || ',"then":{{"required":["' || name || '"]}}}}' AS rule FROM w LEFT JOIN o ON w.form_id = o.form_id AND w.grp = o.grp)
SELECT form_id, '{{"$schema":"https://json-schema.org/draft/2020-12/schema","title":"' || form_id || ' \u2014 The ' || form_id || '","type":"object","properties":{{' || string_agg(prop, ',' ORDER BY name) || '}}'
  || coalesce(',"required":[' || string_agg(req, ',' ORDER BY name) || ']', '') || coalesce(',"allOf":[' || string_agg(rule, ',' ORDER BY name) || ']', '') || '}}' AS schema FROM p GROUP BY form_id""",
)
def export_json_schema(t: Tables):
    size = F.col("size")
    tree = F.element_at(F.array(*[F.lit(x) for x in TREES]), (size % 6 + 1).cast("int"))
    fields = _bound(t).withColumns({
        "choice_group": F.when(size % 7 == 0, F.concat(F.lit("g"), (F.col("seq") % 4).cast("string"))), "choice_value": F.when(size % 2 == 0, F.concat(F.lit("v"), F.col("seq").cast("string"))),
        "required_when": F.when(size % 6 < 4, tree), "writable_when": F.when(size % 5 == 0, F.lit(TREES[0])),
    })
    titles = fields.select("form_id").distinct().withColumn("title", F.concat(F.lit("The "), "form_id"))
    return writers.export_json_schema(fields, titles)


@query(
    uses="rect",
    sql="""SELECT form_id, rect_id, field_id, page + 1 AS page_no, CAST(round(x0) AS INTEGER) AS x, CAST(round(y0) AS INTEGER) AS y, CAST(round(x1 - x0) AS INTEGER) AS w, CAST(round(y1 - y0) AS INTEGER) AS h FROM rect""",
)
def export_placements(t: Tables):
    return writers.export_placements(t.rect)


@query(
    uses="field",
    sql=f"""{VARS}, e AS (SELECT DISTINCT form_id, name FROM w), d AS (SELECT form_id, nullif(coalesce(token, ''), '') AS name FROM b),
have AS (SELECT form_id, name, count(*) AS n FROM d WHERE name IS NOT NULL GROUP BY ALL),
j AS (SELECT coalesce(have.form_id, e.form_id) AS form_id, coalesce(have.name, e.name) AS name, CASE WHEN have.n IS NULL THEN 'missing' WHEN e.name IS NULL THEN 'unexpected' WHEN have.n > 1 THEN 'duplicate' END AS problem
  FROM have FULL JOIN e ON have.form_id = e.form_id AND have.name = e.name)
SELECT form_id, name, problem, 'dictionary' AS artefact FROM j WHERE problem IS NOT NULL UNION ALL SELECT DISTINCT form_id, NULL, 'null_name', 'dictionary' FROM d WHERE name IS NULL""",
)
def export_contract(t: Tables):
    f = _exportable(t)
    expected = writers.export_variables(f).select("form_id", "name")
    dictionary = writers.export_dictionary(f).select("form_id", F.nullif("token", F.lit("")).alias("name"))
    return writers.export_contract(expected, {"dictionary": dictionary, "variables": expected})


PACKED = """WITH f AS (SELECT replace(form_id, '#', '-') || '(I)' AS form_id, field_id, label || CASE WHEN seq % 5 = 0 THEN ', "so called"' ELSE '' END AS label, data_type, seq, size FROM field)"""


def _packed(t: Tables):
    """Form packages written from the given tables, and read again."""
    form = F.concat(F.regexp_replace("form_id", "#", "-"), F.lit("(I)"))
    label = F.concat("label", F.when(F.col("seq") % 5 == 0, ', "so called"').otherwise(""))
    fields = t.field.withColumns({"form_id": form, "label": label, "risk_score": F.col("size")})
    metadata = fields.groupBy("form_id").agg(F.concat(F.lit("The "), F.first("form_id")).alias("title"), F.count("*").cast("int").alias("n_fields"))
    rect = F.array(*[F.col("size").cast("double") + i for i in range(4)])
    spec = F.struct(F.lit("text").alias("type"), F.array(F.struct((F.col("seq") % 3).cast("int").alias("page"), rect.alias("rect"))).alias("widgets"))
    geometry = fields.groupBy("form_id", "field_id").agg(F.min_by(spec, "seq").alias("s")).groupBy("form_id").agg(F.map_from_entries(F.collect_list(F.struct("field_id", "s"))).alias("fields"))
    root = run_folder(t.spark, "packages")
    writers.write_form_packages(metadata, fields, geometry, root).count()
    return readers.read_form_packages(t.spark, root)


@query(uses="field", sql=f"{PACKED} SELECT form_id, field_id, label, data_type, CAST(size AS INTEGER) AS risk_score FROM f")
def read_form_packages(t: Tables):
    return _packed(t).fields.select("form_id", "field_id", "label", "data_type", "risk_score")


@query(uses="field", sql=f"{PACKED} SELECT form_id, 'The ' || form_id AS title, CAST(count(*) AS INTEGER) AS n_fields FROM f GROUP BY form_id")
def read_form_metadata(t: Tables):
    return _packed(t).metadata.select("form_id", "title", "n_fields")


@query(uses="field", sql=f"{PACKED} SELECT form_id, field_id, CAST(arg_min(seq, seq) % 3 AS INTEGER) AS page, CAST(arg_min(size, seq) AS DOUBLE) AS x0 FROM f GROUP BY form_id, field_id")
def read_form_geometry(t: Tables):
    return readers.explode_geometry(_packed(t).geometry).select("form_id", "field_id", "page", "x0")


@query(
    uses="rect",
    sql="SELECT form_id, page, rect_id, field_id, kind, round(x0, 1) AS x0, round(y0, 1) AS y0, round(x1, 1) AS x1, round(y1, 1) AS y1 FROM rect",
)
def write_catalog(t: Tables):
    """The field catalogue as TSV files, one per task, read again."""
    catalog, path = field_catalog(t.rect), run_folder(t.spark, "catalog")
    writers.write_catalog(catalog, path, sep="\t")
    return t.spark.read.schema(catalog.schema).option("sep", "\t").csv(path, header=True)
