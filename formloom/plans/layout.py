"""Layout filters and field detection over the derived pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.functions import text as X
from formloom.operators import detect, layout
from formloom.plans.joins import IOU, OX, OY, PAIR
from formloom.plans.registry import query
from formloom.sources.testdata import PAGE_H, Tables

XOV = "(a.x0 < b.x1 AND a.x1 > b.x0)"

HEADER = r"""(length(trim(text)) >= 5 AND NOT contains(text, '___') AND NOT contains(text, '§')
  AND regexp_matches(lower(text), 'information|petitioner|co-petitioner|respondent|minor|decedent|guardian|conservator|heir|devisee|fiduciary|attorney|applicant|ward|estate|interested person')
  AND ((regexp_matches(trim(text), '^\d+[a-z]?\.\s+\S')
        AND NOT regexp_matches(trim(regexp_replace(trim(text), '^\d+[a-z]?\.\s*', '')), '[?.]$')
        AND len(regexp_split_to_array(trim(regexp_replace(trim(text), '^\d+[a-z]?\.\s*', '')), '\s+')) BETWEEN 2 AND 7)
    OR (regexp_matches(trim(text), '[A-Z]') AND upper(trim(text)) = trim(text)
        AND len(regexp_split_to_array(trim(text), '\s+')) BETWEEN 2 AND 6)
    OR (ends_with(trim(text), ':') AND len(regexp_split_to_array(trim(regexp_replace(trim(text), '^\d+[a-z]?\.\s*', '')), '\s+')) >= 2
        AND len(regexp_split_to_array(trim(text), '\s+')) <= 6)))"""


@query(
    uses="drawing page",
    sql="""SELECT d.form_id, d.page, draw_id, kind, x0, y0, x1, y1 FROM drawing d JOIN page p ON d.form_id = p.form_id AND d.page = p.page
WHERE kind IN ('line', 'rect') AND x1 - x0 >= 50 AND y1 - y0 <= 3 AND x1 - x0 < p.width - 40""",
)
def horizontal_rules(t: Tables):
    return layout.horizontal_rules(t.drawing, t.page)


@query(
    uses="drawing",
    sql="SELECT * FROM drawing WHERE kind IN ('line', 'rect') AND y1 - y0 >= 50 AND x1 - x0 <= 3",
)
def vertical_rules(t: Tables):
    return layout.vertical_rules(t.drawing)


@query(
    uses="drawing",
    sql="""SELECT * FROM drawing WHERE kind = 'rect' AND x1 - x0 BETWEEN 8 AND 16 AND y1 - y0 BETWEEN 8 AND 16
  AND greatest(x1 - x0, y1 - y0) / least(x1 - x0, y1 - y0) <= 1.3""",
)
def checkbox_rects(t: Tables):
    return layout.checkbox_rects(t.drawing)


UNDERSCORE = """WITH pieces AS (SELECT form_id, page, span_id, text, x0, y0, x1, y1, regexp_extract_all(text, '_+|[^_]+') AS ps FROM span),
walk AS (SELECT *, unnest(range(1, len(ps) + 1)) AS i FROM pieces),
run AS (SELECT form_id, page, span_id, ps[i] AS piece, length(array_to_string(ps[1:i - 1], '')) AS "start", text, x0 AS sx0,
  (x1 - x0) / length(text) AS cw, y0, y1 FROM walk WHERE regexp_matches(ps[i], '^_{5,}$')),
pos AS (SELECT form_id, page, span_id, CAST("start" AS INTEGER) AS "start", sx0 + "start" * cw AS x0, y0,
  sx0 + ("start" + length(piece)) * cw AS x1, y1 FROM run)
SELECT * FROM pos a WHERE x1 - x0 >= 50 AND NOT EXISTS (SELECT 1 FROM rule b WHERE a.form_id = b.form_id AND a.page = b.page
  AND abs(b.y0 - a.y1) < 4 AND NOT (b.x1 < a.x0 - 5 OR a.x1 + 5 < b.x0))"""


@query(uses="span rule", sql=UNDERSCORE)
def underscore_runs(t: Tables):
    return layout.underscore_runs(t.span, t.rule)


@query(
    uses="rule word",
    sql="""WITH o AS (SELECT *, lag(y0) OVER w AS py, lag(x1) OVER w AS px FROM rule WINDOW w AS (PARTITION BY form_id, page ORDER BY y0, x0, rule_id)),
g AS (SELECT *, sum(CASE WHEN py IS NULL OR abs(y0 - py) >= 3 OR x0 > px + 5 THEN 1 ELSE 0 END)
  OVER (PARTITION BY form_id, page ORDER BY y0, x0, rule_id) AS run_id FROM o),
m AS (SELECT form_id, page, CAST(run_id AS BIGINT) AS run_id, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM g
  GROUP BY form_id, page, run_id HAVING max(x1) - min(x0) >= 50),
f AS (SELECT m.form_id, m.page, run_id, arg_min(text, (b.y0, b.x0, line_id)) AS first_word FROM m JOIN word b
  ON m.form_id = b.form_id AND m.page = b.page AND m.x0 < 90 AND b.x1 > m.x0 - 5 AND b.x0 < m.x0 + 80 AND b.y1 > m.y1 AND b.y0 < m.y1 + 14
  WHERE NOT regexp_matches(text, '^[_ \t]*$') GROUP BY ALL)
SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.form_id = m.form_id AND f.page = m.page AND f.run_id = m.run_id
  AND regexp_matches(first_word, '^[0-9]'))""",
)
def merge_adjacent_runs(t: Tables):
    return layout.merge_adjacent_runs(t.rule.withColumnRenamed("rule_id", "hit_id"), t.word)


@query(
    uses="span",
    sql="""WITH s AS (SELECT * FROM span WHERE x1 - x0 BETWEEN 4 AND 14 AND y1 - y0 BETWEEN 4 AND 14
  AND greatest(x1 - x0, y1 - y0) <= 1.6 * least(x1 - x0, y1 - y0) AND trim(text) IN ('', '☐', '☒', '✓', '✗', '❑', '❒', '□', '■', '◇', '◆'))
SELECT form_id, page, span_id, x0, y0, x1, y1 FROM s
QUALIFY row_number() OVER (PARTITION BY form_id, page, round(x0 / 2), round(y0 / 2) ORDER BY y0, x0, span_id) = 1""",
)
def glyph_boxes(t: Tables):
    return layout.glyph_boxes(t.span)


@query(
    "is_section_header",
    uses="word",
    sql=f"SELECT form_id, page, line_id, {HEADER} AS is_header FROM word",
)
def section_header_flags(t: Tables):
    return t.word.select("form_id", "page", "line_id", X.is_section_header(F.col("text")).alias("is_header"))


@query(
    sql=r"""SELECT doc_id, text <> '' AND (length(s) > 50 OR regexp_matches(s, '[.,;]$')
  OR greatest(len(regexp_split_to_array(s, '\s+')), length(s) - length(replace(s, '_', '')) + 1) >= 5) AS is_body
FROM (SELECT doc_id, text, trim(text) AS s FROM documents)""",
)
def looks_like_body_text(t: Tables):
    return t.raw("documents").select("doc_id", X.looks_like_body_text(F.col("text")).alias("is_body"))


@query(
    uses="word",
    sql=r"""SELECT form_id, page, line_id FROM word WHERE length(trim(text)) >= 5
  AND regexp_matches(lower(trim(text)), ':$|name of\b|address of\b|date of\b|telephone\b|phone\b|email\b')""",
)
def is_prompt_label(t: Tables):
    return t.word.where(X.is_prompt_label(F.col("text"))).select("form_id", "page", "line_id")


@query(
    uses="rect page",
    sql="""SELECT r.form_id, r.page, rect_id, greatest(x0, 12.0::DOUBLE) AS x0, greatest(y0, 18.0::DOUBLE) AS y0,
  least(x1, p.width - 12) AS x1, least(y1, p.height - 18) AS y1
FROM rect r JOIN page p ON r.form_id = p.form_id AND r.page = p.page
WHERE (y0 + y1) / 2 BETWEEN 18 AND p.height - 18 AND (x0 + x1) / 2 BETWEEN 12 AND p.width - 12
  AND least(x1, p.width - 12) - greatest(x0, 12) >= 6 AND least(y1, p.height - 18) - greatest(y0, 18) >= 6""",
)
def clamp_to_margins(t: Tables):
    return layout.clamp_to_margins(t.rect, t.page)


@query(
    uses="field",
    sql="""WITH s AS (SELECT *, CASE size % 4 WHEN 0 THEN 'wet_ink' WHEN 1 THEN 'left_blank' ELSE 'record' END AS fill_source,
  data_type = 'boolean' AS suppress, size > 45 AS court_only, seq % 10 = 3 AS locked FROM field),
bad AS (SELECT DISTINCT form_id, field_id FROM s WHERE suppress OR fill_source = 'wet_ink'
  OR (category = 'signature' AND data_type = 'signature') OR (fill_source = 'left_blank' AND regexp_matches(field_id, '^red_')) OR court_only)
SELECT s.form_id, s.field_id, s.seq FROM s SEMI JOIN bad b ON s.form_id = b.form_id AND s.field_id = b.field_id WHERE NOT locked""",
)
def suppress_fields(t: Tables):
    schema = t.field.select(
        "form_id",
        "field_id",
        "seq",
        "category",
        F.col("data_type").alias("field_type"),
        F.expr("CASE size % 4 WHEN 0 THEN 'wet_ink' WHEN 1 THEN 'left_blank' ELSE 'record' END").alias("fill_source"),
        (F.col("data_type") == "boolean").alias("suppress"),
        (F.col("size") > 45).alias("court_only"),
        (F.col("seq") % 10 == 3).alias("locked"),
    )
    widgets = schema.select("form_id", "field_id", "seq", "locked")
    return layout.suppress_fields(widgets, schema, court_only="^red_").select("form_id", "field_id", "seq")


@query(
    uses="rect",
    sql="""WITH one AS (SELECT form_id, field_id, max(y1 - y0) AS tallest, count(*) AS n_widgets FROM rect GROUP BY ALL HAVING max(y1 - y0) <= 16),
s AS (SELECT form_id, field_id, min(part) % 2 = 0 AS open_text FROM rect GROUP BY ALL)
SELECT one.* FROM one JOIN s ON one.form_id = s.form_id AND one.field_id = s.field_id WHERE open_text AND NOT regexp_matches(one.field_id, '[13]$')""",
)
def narrative_single_lines(t: Tables):
    source = F.when(F.min("part") % 2 == 0, "llm_over_narrative").otherwise("record")
    schema = t.rect.groupBy("form_id", "field_id").agg(source.alias("fill_source"))
    return layout.narrative_single_lines(t.rect, schema, short_fact="[13]$")


PROMPTS = r"""WITH m AS (SELECT form_id, page, line_id, text, x0, y0, x0 > 115 AND length(trim(text)) < 80 AS is_option,
  x0 <= 200 AND regexp_matches(trim(text), '^(red|blue)\b') AS is_sub,
  regexp_matches(trim(text), '(?i):\s*$|\?\s*$|^\s*\d{1,2}[a-z]?[.)]\s|explain') AND NOT (x0 > 115 AND length(trim(text)) < 60) AS is_prompt FROM word),
s AS (SELECT *, count(*) OVER w AS n_ahead, count(*) FILTER (is_option) OVER w AS n_options, count(*) FILTER (is_sub) OVER w AS n_sublabels
  FROM m WINDOW w AS (PARTITION BY form_id, page ORDER BY y0, x0, line_id ROWS BETWEEN 1 FOLLOWING AND 8 FOLLOWING)),
z AS (SELECT form_id, page, min(y0) AS stop_y FROM word WHERE regexp_matches(text, '^20__') GROUP BY ALL)
SELECT s.form_id, s.page, line_id, text, n_ahead, n_options, n_sublabels FROM s LEFT JOIN z ON s.form_id = z.form_id AND s.page = z.page
WHERE is_prompt AND NOT (n_ahead > 0 AND n_options * 2 >= n_ahead) AND n_sublabels < 2 AND (stop_y IS NULL OR s.y0 < stop_y)"""


def _prompts(t: Tables):
    return layout.prompt_lines(t.word, sub_indent=200.0, sublabel=r"^(red|blue)\b", stop="^20__")


@query(uses="word", sql=PROMPTS)
def prompt_lines(t: Tables):
    return _prompts(t)


@query(
    uses="word",
    sql=f"""WITH pl AS ({PROMPTS}),
lab AS (SELECT w.* FROM word w SEMI JOIN pl ON w.form_id = pl.form_id AND w.page = pl.page AND w.line_id = pl.line_id
  WHERE ends_with(rtrim(w.text), ':') AND NOT starts_with(trim(w.text), '(')),
f AS (SELECT a.form_id, a.page, a.line_id, a.x1 + 2 AS x0, a.y0,
  coalesce((SELECT min(b.x0) FROM word b WHERE {PAIR} AND b.x0 >= a.x1 AND {OY} > 0), 540) - 2 AS x1, a.y1 FROM lab a)
SELECT * FROM f WHERE x1 - x0 >= 40""",
)
def inline_labels(t: Tables):
    return layout.inline_labels(_prompts(t), t.word, right_margin=540.0)


NEAREST_LABEL = r"""WITH c AS (SELECT a.form_id, a.page, a.rect_id, b.line_id, trim(b.text) AS label, b.x0 AS bx, b.y0 AS bz,
  CASE WHEN b.x1 <= a.x0 + 5 AND a.x0 - b.x1 <= 150 AND b.y0 < a.y1 + 10 AND b.y1 > a.y0 - 10 THEN 'left'
    WHEN b.y1 <= a.y0 + 2 AND a.y0 - b.y1 <= 30 AND b.x0 < a.x1 AND b.x1 > a.x0 THEN 'above'
    WHEN b.y0 >= a.y1 - 2 AND b.y0 - a.y1 <= 20 AND b.x0 < a.x1 AND b.x1 > a.x0 THEN 'below'
    WHEN b.x0 >= a.x1 - 5 AND b.x0 - a.x1 <= 100 AND b.y0 < a.y1 + 5 AND b.y1 > a.y0 - 5 THEN 'right' END AS side,
  a.x0, a.y0, a.x1, a.y1, b.x0 AS lx0, b.y0 AS ly0, b.x1 AS lx1, b.y1 AS ly1
  FROM rect a JOIN word b ON a.form_id = b.form_id AND a.page = b.page
  WHERE length(trim(b.text)) >= 2 AND NOT regexp_matches(trim(b.text), '^\d+[a-z]?\.?$')),
d AS (SELECT *, CASE side WHEN 'left' THEN greatest(0, x0 - lx1) WHEN 'above' THEN greatest(0, y0 - ly1) + CAST(0.1 AS DOUBLE)
  WHEN 'below' THEN greatest(0, ly0 - y1) + 5 ELSE greatest(0, lx0 - x1) + CAST(0.5 AS DOUBLE) END AS cost FROM c WHERE side IS NOT NULL)
SELECT form_id, page, rect_id, label, side, cost FROM d
QUALIFY row_number() OVER (PARTITION BY form_id, page, rect_id ORDER BY cost, bz, bx, line_id) = 1"""


@query(uses="rect word", sql=NEAREST_LABEL)
def nearest_label(t: Tables):
    return detect.nearest_label(t.rect, t.word)


@query(
    uses="rect word",
    sql=f"""WITH l AS ({NEAREST_LABEL}), f AS (SELECT r.form_id, r.page, r.rect_id, coalesce(label, '') AS label, x1 - x0 AS w
  FROM rect r LEFT JOIN l ON r.form_id = l.form_id AND r.page = l.page AND r.rect_id = l.rect_id)
SELECT form_id, page, rect_id, label, CASE
  WHEN regexp_matches(lower(label), 'signature|sign|subscribed|sworn') AND w >= 200 THEN 'signature'
  WHEN regexp_matches(lower(label), 'date|dob|dod|mm/dd/yyyy|mm/dd/yy|month|day|year') THEN 'date'
  WHEN regexp_matches(lower(label), '\\$|amount|value|total|balance|dollars') THEN 'currency' ELSE 'text' END AS field_type FROM f""".replace("\\\\", "\\"),
)
def classify_field_type(t: Tables):
    return detect.classified_fields(t.rect, detect.nearest_label(t.rect, t.word))


@query(
    uses="rect word",
    sql=f"""WITH h AS (SELECT form_id, page, line_id, trim(text) AS text, y0, y1 FROM word WHERE {HEADER})
SELECT a.form_id, a.page, a.rect_id, arg_max(b.text, (b.y0, b.line_id)) AS section FROM rect a JOIN h b ON {PAIR}
  AND b.y1 <= a.y0 AND a.y0 - b.y1 <= 120 GROUP BY ALL""",
)
def section_header_asof(t: Tables):
    return detect.section_header_asof(t.rect, t.word)


@query(
    uses="rect word",
    sql=r"""WITH h AS (SELECT form_id, page, y0, arg_min(text, (x0, line_id)) AS text FROM word
  WHERE length(trim(text)) <= 80 AND ((ends_with(trim(text), ':') AND length(trim(text)) > 4) OR regexp_matches(trim(text), '^\d{1,2}[a-z]?[.)]\s'))
  GROUP BY ALL),
s AS (SELECT *, coalesce(lead(y0) OVER (PARTITION BY form_id, page ORDER BY y0), 1e9) AS end_y,
  left(regexp_replace(regexp_replace(regexp_replace(lower(trim(text)), '[:.,?#]+$', ''), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 45) AS prefix FROM h)
SELECT a.form_id, a.page, a.rect_id, prefix FROM rect a JOIN s ON a.form_id = s.form_id AND a.page = s.page AND s.y0 <= a.y0 AND a.y0 < s.end_y""",
)
def section_span_prefix(t: Tables):
    return detect.section_span_prefix(t.rect, t.word)


COLUMN_HEADER = f"""SELECT a.form_id, a.page, a.rect_id, trim(b.text) AS header,
  a.y0 - b.y1 + CASE WHEN b.x0 <= (a.x0 + a.x1) / 2 AND (a.x0 + a.x1) / 2 <= b.x1 THEN 0 ELSE 50 END AS cost
FROM rect a JOIN word b ON {PAIR} WHERE length(trim(b.text)) >= 2 AND b.y1 <= a.y0 + 5 AND a.y0 - b.y0 <= 200
  AND ((b.x0 <= (a.x0 + a.x1) / 2 AND (a.x0 + a.x1) / 2 <= b.x1) OR {XOV})
QUALIFY row_number() OVER (PARTITION BY a.form_id, a.page, a.rect_id ORDER BY cost, b.y0, b.x0, b.line_id) = 1"""


@query(uses="rect word", sql=COLUMN_HEADER)
def column_header(t: Tables):
    return detect.column_header(t.rect, t.word, by=("form_id", "page", "rect_id"))


GRID = f"""SELECT a.form_id, a.page, a.rule_id, a.x0, a.y0, a.x1, a.y1, count(*) AS n_crossings FROM rule a JOIN vrule b ON {PAIR}
  AND b.x0 BETWEEN a.x0 - 5 AND a.x1 + 5 AND b.y0 <= a.y0 + 5 AND b.y1 >= a.y1 - 5 GROUP BY ALL HAVING count(*) >= 3"""


@query(uses="rule vrule", sql=GRID)
def grid_lines(t: Tables):
    return detect.grid_lines(t.rule, t.vrule)


@query(
    uses="rule vrule word",
    sql=f"""WITH g AS ({GRID}),
e AS (SELECT form_id, page, y0, arg_max(y1, (x0, rule_id)) AS ey, count(*) AS n FROM g GROUP BY ALL),
r AS (SELECT form_id, page, CAST(sum(n) OVER w AS BIGINT) AS row_no, ey AS y0, lead(y0) OVER w AS y1 FROM e
  WINDOW w AS (PARTITION BY form_id, page ORDER BY y0)),
x AS (SELECT DISTINCT r.form_id, r.page, row_no, r.y0, r.y1, round(b.x0, 1) AS vx FROM r JOIN vrule b ON r.form_id = b.form_id AND r.page = b.page
  AND b.y0 <= r.y0 + 5 AND b.y1 >= r.y1 - 5 WHERE r.y1 - r.y0 >= 5),
c AS (SELECT form_id, page, row_no, vx + 1 AS x0, y0 + 1 AS y0, lead(vx) OVER (PARTITION BY form_id, page, row_no ORDER BY vx) - 1 AS x1, y1 - 1 AS y1 FROM x),
a AS (SELECT * FROM c WHERE x1 - x0 >= 10 AND y1 - y0 >= 5),
ins AS (SELECT a.form_id, a.page, a.row_no, a.x0, arg_min(trim(b.text), (b.y0, b.x0, b.line_id)) AS t FROM a JOIN word b ON {PAIR}
  AND b.x0 >= a.x0 - 5 AND b.x1 <= a.x1 + 5 AND b.y0 >= a.y0 - 2 AND b.y1 <= a.y1 + 2 GROUP BY ALL),
hd AS (SELECT a.form_id, a.page, a.row_no, a.x0, trim(b.text) AS t FROM a JOIN word b ON {PAIR}
  WHERE length(trim(b.text)) >= 2 AND b.y1 <= a.y0 + 5 AND a.y0 - b.y0 <= 200
  AND ((b.x0 <= (a.x0 + a.x1) / 2 AND (a.x0 + a.x1) / 2 <= b.x1) OR {XOV})
  QUALIFY row_number() OVER (PARTITION BY a.form_id, a.page, a.row_no, a.x0 ORDER BY
    a.y0 - b.y1 + CASE WHEN b.x0 <= (a.x0 + a.x1) / 2 AND (a.x0 + a.x1) / 2 <= b.x1 THEN 0 ELSE 50 END, b.y0, b.x0, b.line_id) = 1)
SELECT a.form_id, a.page, a.row_no, a.x0, a.y0, a.x1, a.y1, coalesce(ins.t, hd.t) || ' (row ' || CAST(a.row_no AS VARCHAR) || ')' AS label FROM a
LEFT JOIN ins ON ins.form_id = a.form_id AND ins.page = a.page AND ins.row_no = a.row_no AND ins.x0 = a.x0
LEFT JOIN hd ON hd.form_id = a.form_id AND hd.page = a.page AND hd.row_no = a.row_no AND hd.x0 = a.x0""",
)
def table_cells(t: Tables):
    return detect.table_cells(detect.grid_lines(t.rule, t.vrule), t.vrule, t.word)


CELLS = """WITH yo AS (SELECT form_id, page, y0, lag(y0) OVER w AS p FROM (SELECT DISTINCT form_id, page, y0 FROM rule) WINDOW w AS (PARTITION BY form_id, page ORDER BY y0)),
yg AS (SELECT *, sum(CASE WHEN p IS NULL OR y0 - p > 1 THEN 1 ELSE 0 END) OVER (PARTITION BY form_id, page ORDER BY y0) AS k FROM yo),
ys AS (SELECT r.form_id, r.page, k, avg(r.y0) AS y FROM rule r JOIN yg ON r.form_id = yg.form_id AND r.page = yg.page AND r.y0 = yg.y0 GROUP BY ALL),
rw AS (SELECT form_id, page, y AS y0, lead(y) OVER (PARTITION BY form_id, page ORDER BY y) AS y1 FROM ys),
sp AS (SELECT DISTINCT rw.form_id, rw.page, rw.y0, rw.y1, v.x0 AS x FROM rw JOIN vrule v ON rw.form_id = v.form_id AND rw.page = v.page
  AND v.y0 <= rw.y0 + 1.5 AND v.y1 >= rw.y1 - 1.5 WHERE rw.y1 - rw.y0 BETWEEN 8 AND 50),
cl AS (SELECT form_id, page, x AS x0, y0, lead(x) OVER (PARTITION BY form_id, page, y0 ORDER BY x) AS x1, y1 FROM sp),
cells AS (SELECT * FROM cl WHERE x1 - x0 >= 30)"""


@query(uses="rule vrule", sql=f"{CELLS} SELECT * FROM cells")
def cells_from_line_grid(t: Tables):
    return detect.cells_from_line_grid(t.rule, t.vrule)


HEADS = f"""{CELLS}, heads AS (SELECT a.* FROM cells a WHERE EXISTS (SELECT 1 FROM word b WHERE {PAIR} AND length(trim(b.text)) >= 2
  AND (b.x0 + b.x1) / 2 BETWEEN a.x0 AND a.x1 AND (b.y0 + b.y1) / 2 BETWEEN a.y0 AND a.y1))"""
IN_B = f"EXISTS (SELECT 1 FROM %s b WHERE {PAIR} AND (a.x0 + a.x1) / 2 BETWEEN b.x0 AND b.x1 AND (a.y0 + a.y1) / 2 BETWEEN b.y0 AND b.y1)"


def _cells(t: Tables):
    cells = detect.cells_from_line_grid(t.rule, t.vrule)
    return cells, detect.header_cells(cells, t.word)


@query(uses="rule vrule word", sql=f"{HEADS} SELECT * FROM heads")
def header_cells(t: Tables):
    return _cells(t)[1]


@query(
    uses="rect rule vrule word",
    sql=f"{HEADS} SELECT form_id, page, rect_id FROM rect a WHERE kind <> 'text' OR NOT {IN_B % 'heads'}",
)
def drop_in_header_cells(t: Tables):
    return detect.drop_in_header_cells(t.rect, _cells(t)[1]).select("form_id", "page", "rect_id")


@query(
    uses="rect_b rule vrule word",
    sql=f"""{HEADS} SELECT form_id, page, rect_id FROM rect_b a WHERE kind <> 'text'
  OR NOT EXISTS (SELECT 1 FROM cells b WHERE {PAIR}) OR ({IN_B % 'cells'} AND NOT {IN_B % 'heads'})""",
)
def drop_outside_tables(t: Tables):
    return detect.drop_outside_tables(t.rect_b, *_cells(t)).select("form_id", "page", "rect_id")


@query(
    uses="word rule",
    sql=f"""WITH a AS (SELECT * FROM word WHERE y0 <= 100 AND regexp_matches(lower(text), 'date of|ring'))
SELECT a.form_id, a.page, a.line_id, b.rule_id, CASE WHEN a.y0 < b.y1 + 10 AND a.y1 > b.y0 - 10 AND b.x0 >= a.x1 - 10 THEN b.x0 - a.x1 ELSE b.y0 - a.y1 END AS cost
FROM a JOIN rule b ON {PAIR} WHERE b.y0 <= 150 AND ((a.y0 < b.y1 + 10 AND a.y1 > b.y0 - 10 AND b.x0 >= a.x1 - 10)
  OR (b.y0 >= a.y1 AND b.y0 - a.y1 < 20 AND {XOV}))
QUALIFY row_number() OVER (PARTITION BY a.form_id, a.page, a.line_id ORDER BY cost, b.y0, b.x0, b.rule_id) = 1""",
)
def case_number_line(t: Tables):
    return detect.case_number_line(t.word, t.rule, keywords=("date of", "ring"))


@query(
    uses="word rule rect page",
    sql=rf"""WITH a AS (SELECT form_id, page, line_id, text, x0, y0, x1, y1 FROM word WHERE length(trim(text)) >= 5
    AND regexp_matches(lower(trim(text)), ':$|name of\b|address of\b|date of\b|telephone\b|phone\b|email\b')),
o AS (SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM rect b WHERE b.kind = 'choice' AND {PAIR} AND ((abs(b.y0 - a.y1) < 25 AND b.x0 < a.x1 AND b.x1 > a.x0)
  OR (b.y0 < a.y1 + 5 AND b.y1 > a.y0 - 5 AND b.x0 > a.x1 - 10 AND b.x0 - a.x1 < 150)))),
things AS (SELECT form_id, page, x0, y0, x1 FROM word UNION ALL SELECT form_id, page, x0, y0, x1 FROM rule),
n AS (SELECT a.*, p.width, coalesce((SELECT min(b.y0) FROM things b WHERE {PAIR} AND b.y0 > a.y1 + 5 AND b.x0 < a.x1 AND b.x1 > a.x0), p.height) AS ny
  FROM o a JOIN page p ON a.form_id = p.form_id AND a.page = p.page)
SELECT form_id, page, line_id, x0, y1 + 2 AS y0, x0 + least(400, width - x0 - 40) AS x1, ny - 2 AS y1,
  regexp_replace(trim(regexp_replace(trim(text), '^\d+[a-z]?\.\s*', '')), ':+$', '') AS label FROM n WHERE ny - y1 BETWEEN 20 AND 50""",
)
def implied_fields(t: Tables):
    return detect.implied_fields(t.word, t.rule, t.rect.where("kind = 'choice'"), t.page)


@query(
    uses="word",
    sql=r"""WITH s AS (SELECT *, lead(y0) OVER w AS ny, lead(text) OVER w AS nt FROM word WINDOW w AS (PARTITION BY form_id, page ORDER BY y0, x0, line_id))
SELECT form_id, page, line_id, CAST(72 AS DOUBLE) AS x0, y1 + (ny - y1 - least(ny - y1 - 4, 18)) / 2 AS y0, CAST(540 AS DOUBLE) AS x1,
  y1 + (ny - y1 - least(ny - y1 - 4, 18)) / 2 + least(ny - y1 - 4, 18) AS y1 FROM s
WHERE ny - y1 BETWEEN 20 AND 50 AND ((regexp_matches(trim(text), '(?i):\s*$|\?\s*$|^\s*\d{1,2}[a-z]?[.)]\s|explain') AND NOT (x0 > 115 AND length(trim(text)) < 60))
  OR regexp_matches(nt, '^\s*\d{1,2}[a-z]?[.)]\s'))""",
)
def gap_fields(t: Tables):
    return detect.gap_fields(t.word)


@query(
    uses="word rect",
    sql=rf"""WITH a AS (SELECT form_id, page, line_id, text, x0, y0, x1, y1 FROM word WHERE regexp_matches(trim(text), '[:?]$|^\d+[a-z]?[.)]\s')),
f AS (SELECT *, CASE WHEN part % 2 = 0 THEN 'red ring' ELSE 'date ' || kind END AS label FROM rect),
h AS (SELECT a.form_id, a.page, a.line_id, b.rect_id, list_has_any(list_filter(string_split(lower(regexp_replace(a.text, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda x: x <> ''),
   list_filter(string_split(lower(regexp_replace(b.label, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '')) AS shares_word
  FROM a JOIN f b ON {PAIR} WHERE ({OY} > 0 AND b.x0 >= a.x1 - 10 AND b.x0 - a.x1 <= 150)
    OR (b.y0 >= a.y1 - 2 AND b.y0 - a.y1 <= 25 AND {XOV}))
SELECT form_id, page, line_id, rect_id, 'mapped' AS status, shares_word FROM h
UNION ALL SELECT a.form_id, a.page, a.line_id, NULL, 'prompt_without_field', NULL FROM a ANTI JOIN h ON a.form_id = h.form_id AND a.page = h.page AND a.line_id = h.line_id
UNION ALL SELECT f.form_id, f.page, NULL, f.rect_id, 'field_without_prompt', NULL FROM f ANTI JOIN h ON f.form_id = h.form_id AND f.page = h.page AND f.rect_id = h.rect_id""",
)
def question_mapping(t: Tables):
    label = F.when(F.col("part") % 2 == 0, "red ring").otherwise(F.concat(F.lit("date "), "kind"))
    return detect.question_mapping(t.word, t.rect.withColumn("label", label))


@query(
    uses="word rule rect",
    sql=r"""WITH r AS (SELECT form_id, page, y0, arg_min(line_id, (x0, line_id)) AS line_id FROM word WHERE regexp_matches(trim(text), '^\d+[a-z]?[.)]\s') GROUP BY ALL),
b AS (SELECT *, coalesce(lead(y0) OVER (PARTITION BY form_id, page ORDER BY y0), 792) AS y1 FROM r)
SELECT form_id, page, line_id, y0, y1 FROM b WHERE EXISTS (SELECT 1 FROM rule x WHERE x.form_id = b.form_id AND x.page = b.page AND x.y0 >= b.y0 AND x.y0 < b.y1)
  AND NOT EXISTS (SELECT 1 FROM rect w WHERE w.kind = 'choice' AND w.form_id = b.form_id AND w.page = b.page AND (w.y0 + w.y1) / 2 >= b.y0 AND (w.y0 + w.y1) / 2 < b.y1)""",
)
def uncovered_questions(t: Tables):
    return detect.uncovered_questions(t.word, t.rule, t.rect.where("kind = 'choice'"), PAGE_H)


@query(
    uses="rect word",
    sql=f"""SELECT a.form_id, a.page, a.rect_id, b.line_id FROM rect a JOIN word b ON {PAIR} AND b.x0 > a.x0 + 2 AND b.x1 < a.x1 - 2
  AND (b.y0 + b.y1) / 2 > a.y0 AND (b.y0 + b.y1) / 2 < a.y1""",
)
def symbol_splits(t: Tables):
    return detect.symbol_splits(t.rect, t.word)


@query(
    uses="rect word",
    sql=f"""WITH p AS (SELECT a.form_id, a.page, a.rect_id, a.x0 - b.x1 AS l, b.x0 - a.x1 AS r FROM rect a JOIN word b ON {PAIR}
  AND (b.y0 + b.y1) / 2 > a.y0 AND (b.y0 + b.y1) / 2 < a.y1 WHERE a.x0 - b.x1 BETWEEN 0 AND 40 OR b.x0 - a.x1 BETWEEN 0 AND 40)
SELECT form_id, page, rect_id, min(l) FILTER (l >= 0) AS gap_left, min(r) FILTER (r >= 0) AS gap_right FROM p GROUP BY ALL
HAVING min(l) FILTER (l >= 0) < 1 OR min(r) FILTER (r >= 0) < 1""",
)
def tight_buffers(t: Tables):
    return detect.tight_buffers(t.rect, t.word)


@query(
    uses="word",
    sql=f"""WITH a AS (SELECT * FROM word WHERE regexp_matches(text, 'information$'))
SELECT a.form_id, a.page, a.line_id, b.line_id AS above_id, a.y0 - b.y1 AS gap FROM a JOIN word b ON {PAIR}
  AND b.y1 <= a.y0 AND a.y0 - b.y1 <= 30 AND {XOV}
QUALIFY row_number() OVER (PARTITION BY a.form_id, a.page, a.line_id ORDER BY a.y0 - b.y1, b.x0, b.line_id) = 1""",
)
def signature_line_text(t: Tables):
    return detect.signature_line_text(t.word, t.word, marker="information$")
