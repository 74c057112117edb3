"""Geometry audits over the derived layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.operators import audit
from formloom.plans.registry import query
from formloom.sources.testdata import PAGE_H, PAGE_W, Tables

PAIR = "a.form_id = b.form_id AND a.page = b.page"
OX = "(least(a.x1, b.x1) - greatest(a.x0, b.x0))"
OY = "(least(a.y1, b.y1) - greatest(a.y0, b.y0))"
OA = f"(greatest(0, {OX}) * greatest(0, {OY}))"
IOU = f"({OA} / ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {OA}))"

COLLISIONS = f"""
SELECT a.form_id, a.page, a.rect_id, b.rect_id AS other_id, a.field_id, b.field_id AS other_field_id,
  {OX} * {OY} AS overlap
FROM rect a JOIN rect b ON {PAIR} AND a.rect_id < b.rect_id
WHERE {OX} > 2 AND {OY} > 2 AND {OX} * {OY} >= 12
  AND NOT (a.field_id = b.field_id AND a.kind = 'choice' AND b.kind = 'choice')"""


@query(uses="rect", sql=COLLISIONS)
def widget_collisions(t: Tables):
    return audit.widget_collisions(t.rect)


@query(
    uses="rect",
    sql=f"""SELECT form_id, 'widget_widget_collision' AS code, 'high' AS severity, count(*) AS n
FROM ({COLLISIONS}) GROUP BY form_id""",
)
def findings_by_code(t: Tables):
    from formloom.operators.reports import findings_by_code as roll_up

    found = audit.widget_collisions(t.rect).select(
        "form_id", F.lit("widget_widget_collision").alias("code"), F.lit("high").alias("severity")
    )
    return roll_up(found)


@query(
    uses="rect",
    sql=f"""SELECT a.form_id, a.page, a.rect_id, b.rect_id AS other_id, round({OA}, 1) AS overlap
FROM rect a JOIN rect b ON {PAIR} AND a.rect_id < b.rect_id AND a.field_id <> b.field_id
WHERE {OY} >= 1.5 AND {OA} >= 4""",
)
def same_row_overlaps(t: Tables):
    return audit.same_row_overlaps(t.rect)


@query(
    uses="rect",
    sql="""SELECT form_id, page, x0, y0, x1, y1, string_agg(DISTINCT field_id, ',' ORDER BY field_id) AS targets,
  count(*) AS n_widgets FROM rect GROUP BY ALL HAVING count(DISTINCT field_id) > 1""",
)
def shared_rects(t: Tables):
    return audit.shared_rects(t.rect)


@query(
    uses="rect",
    sql="""WITH h AS (SELECT form_id, page, x0, y0, x1, y1, field_id, count(*) AS n_widgets FROM rect GROUP BY ALL)
SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY form_id, page, x0, y0, x1, y1) AS n_fields FROM h) WHERE n_fields > 1""",
)
def shared_rect_fields(t: Tables):
    return audit.shared_rect_fields(t.rect)


@query(
    uses="rect",
    sql=f"""SELECT a.form_id, a.page, a.rect_id, b.rect_id AS other_id, a.field_id, round({IOU}, 6) AS iou
FROM rect a JOIN rect b ON {PAIR} AND a.field_id = b.field_id AND a.rect_id < b.rect_id
WHERE a.kind = 'choice' AND b.kind = 'choice' AND {IOU} > 0.3""",
)
def overlapping_options(t: Tables):
    return audit.overlapping_options(t.rect)


@query(
    uses="rect word",
    sql=f"""SELECT a.form_id, a.page, a.rect_id, a.field_id, b.line_id, b.text, {OA} AS overlap
FROM rect a JOIN word b ON {PAIR}
WHERE a.kind IN ('text', 'date') AND length(trim(b.text)) >= 2
  AND NOT regexp_matches(trim(b.text), '^_+$')
  AND length(b.text) - length(replace(b.text, '_', '')) <= length(b.text) / 2
  AND (b.x0 + b.x1) / 2 BETWEEN a.x0 AND a.x1 AND (b.y0 + b.y1) / 2 BETWEEN a.y0 AND a.y1 AND {OA} >= 8""",
)
def covers_printed_text(t: Tables):
    return audit.covers_printed_text(t.rect, t.word)


@query(
    uses="rect word",
    sql="""WITH w AS (SELECT *, CASE part % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'center' ELSE 'right' END AS align FROM rect
  WHERE x1 - x0 > 16 OR y1 - y0 > 16),
core AS (SELECT *, CASE WHEN align = 'left' THEN x0 ELSE x0 + CAST(0.2 AS DOUBLE) * (x1 - x0) END AS cx0,
  CASE WHEN align = 'left' THEN x1 ELSE x1 - CAST(0.2 AS DOUBLE) * (x1 - x0) END AS cx1 FROM w),
p AS (SELECT a.form_id, a.page, a.rect_id,
  greatest(0, least(a.cx1, b.x1) - greatest(a.cx0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))
    > CAST(0.3 AS DOUBLE) * ((b.x1 - b.x0) * (b.y1 - b.y0)) AS covered,
  a.align = 'left' AND least(a.y1, b.y1) - greatest(a.y0, b.y0) > 0.5 * (b.y1 - b.y0)
    AND b.x1 > a.x0 + 3 AND b.x1 <= a.x0 + CAST(0.4 AS DOUBLE) * (a.x1 - a.x0) AS under
  FROM core a JOIN word b ON a.form_id = b.form_id AND a.page = b.page)
SELECT form_id, page, rect_id, count(*) FILTER (covered) AS overlaps, count(*) FILTER (under) AS under_label
FROM p WHERE covered OR under GROUP BY ALL""",
)
def label_intrusion(t: Tables):
    align = F.expr("CASE part % 3 WHEN 0 THEN 'left' WHEN 1 THEN 'center' ELSE 'right' END")
    return audit.label_intrusion(t.rect.withColumn("align", align), t.word)


@query(
    uses="rect rule",
    sql=f"""WITH p AS (SELECT a.form_id, a.page, a.rect_id, b.x0 - a.x0 AS left_overrun, a.x1 - b.x1 AS right_overrun,
  row_number() OVER (PARTITION BY a.form_id, a.page, a.rect_id ORDER BY {OX} DESC, b.y0, b.x0, b.rule_id) AS rn
  FROM rect a JOIN rule b ON {PAIR}
  WHERE a.kind IN ('text', 'date') AND a.y1 - a.y0 <= 20 AND abs(b.y0 - a.y1) <= 7 AND {OX} >= 15)
SELECT form_id, page, rect_id, left_overrun, right_overrun FROM p WHERE rn = 1 AND (left_overrun > 5 OR right_overrun > 5)""",
)
def overruns_rule(t: Tables):
    return audit.overruns_rule(t.rect, t.rule)


@query(
    uses="rect rule word",
    sql=f"""WITH span AS (SELECT a.form_id, a.page, a.rect_id, a.x0, a.x1, min(b.x0) AS sx0, max(b.x1) AS sx1, min(b.y0) AS row_y
  FROM rect a JOIN rule b ON {PAIR}
  WHERE a.kind IN ('text', 'date') AND a.y1 - a.y0 <= 20 AND b.x1 - b.x0 >= 18 AND abs(b.y0 - a.y1) < 6 AND {OX} > 15
  GROUP BY ALL),
edges AS (SELECT form_id, page, rect_id, row_y, 'right' AS edge, x1 - sx1 AS overrun, sx1 AS lo, x1 AS hi FROM span
  UNION ALL SELECT form_id, page, rect_id, row_y, 'left', sx0 - x0, x0, sx0 FROM span),
over AS (SELECT * FROM edges WHERE overrun > 6),
hit AS (SELECT o.form_id, o.page, o.rect_id, o.edge, count(*) AS n FROM over o JOIN word w
  ON o.form_id = w.form_id AND o.page = w.page AND abs((w.y0 + w.y1) / 2 - (o.row_y - 5)) < 7
  AND w.x0 < o.hi - 2 AND w.x1 > o.lo + 2 AND NOT regexp_matches(trim(w.text), '^_+$') GROUP BY ALL)
SELECT o.form_id, o.page, o.rect_id, o.edge, o.overrun, coalesce(n, 0) AS n_crossed,
  CASE WHEN n > 0 THEN 'high' ELSE 'medium' END AS severity
FROM over o LEFT JOIN hit h ON o.form_id = h.form_id AND o.page = h.page AND o.rect_id = h.rect_id AND o.edge = h.edge""",
)
def overruns_blank(t: Tables):
    return audit.overruns_blank(t.rect, t.rule, t.word)


NEAREST_BOX = f"""WITH p AS (SELECT a.form_id, a.page, a.rect_id, b.box_id, b.x0 AS bx, b.y0 AS bz,
  greatest(abs((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2), abs((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2)) AS d
  FROM rect a JOIN box b ON {PAIR} WHERE a.kind = 'choice'),
claimed AS (SELECT DISTINCT form_id, page, box_id FROM p WHERE d <= 4.5),
best AS (SELECT *, row_number() OVER (PARTITION BY form_id, page, rect_id ORDER BY d, bz, bx, box_id) AS rn FROM p)
SELECT form_id, page, rect_id, box_id, d AS "offset" FROM best WHERE rn = 1 AND d > 4.5 AND d <= 40
  AND (form_id, page, box_id) NOT IN (SELECT (form_id, page, box_id) FROM claimed)"""


@query(uses="rect box", sql=NEAREST_BOX)
def nearest_box(t: Tables):
    return audit.nearest_box(t.rect.where("kind = 'choice'"), t.box)


@query(
    uses="rule rect",
    sql=f"""SELECT a.form_id, a.page, a.rule_id, a.x0, a.x1, a.y0 AS y FROM rule a
WHERE a.x1 - a.x0 >= 65 AND a.y0 <= 747 AND NOT EXISTS (SELECT 1 FROM rect b WHERE {PAIR} AND abs(b.y1 - a.y0) <= 8
  AND {OX} >= CAST(0.55 AS DOUBLE) * (a.x1 - a.x0))""",
)
def uncovered_rules(t: Tables):
    return audit.uncovered_rules(t.rule, t.rect, PAGE_H)


@query(
    uses="rect word",
    sql=f"""SELECT a.form_id, a.page, a.rect_id, a.field_id, b.line_id FROM rect a JOIN word b ON {PAIR}
WHERE a.kind = 'date' AND regexp_matches(trim(b.text), '^(19|20)_+')
  AND (b.y0 + b.y1) / 2 - (a.y0 + a.y1) / 2 BETWEEN -4 AND 20""",
)
def split_date_stubs(t: Tables):
    return audit.split_date_stubs(t.rect.where("kind = 'date'"), t.word)


@query(
    uses="rect",
    sql="""WITH g AS (SELECT form_id, page, rect_id, field_id,
  y0 - lag(y1) OVER (PARTITION BY form_id, page, field_id ORDER BY rect_id) AS gap FROM rect)
SELECT * FROM g WHERE gap > 22""",
)
def chain_gaps(t: Tables):
    return audit.chain_gaps(t.rect)


@query(
    uses="rect",
    sql="""WITH c AS (SELECT form_id, page, rect_id, field_id, CASE
  WHEN kind = 'choice' AND (x1 - x0 > 24 OR y1 - y0 > 24) THEN 'choice_not_checkbox_sized'
  WHEN kind IN ('text', 'date') AND x1 - x0 <= 18 AND y1 - y0 <= 18 THEN 'text_is_checkbox_sized' END AS code FROM rect)
SELECT * FROM c WHERE code IS NOT NULL""",
)
def odd_sizes(t: Tables):
    return audit.odd_sizes(t.rect)


@query(
    uses="rect",
    sql="""WITH m AS (SELECT form_id, quantile_cont(x1 - x0, 0.5) AS median FROM rect GROUP BY form_id)
SELECT r.form_id, page, rect_id, x1 - x0 AS width, median FROM rect r JOIN m ON r.form_id = m.form_id
WHERE x1 - x0 > 1.5 * median""",
)
def wide_outliers(t: Tables):
    return audit.wide_outliers(t.rect)


@query(
    uses="rect box",
    sql="""SELECT r.form_id, r.page, rect_id, CASE WHEN p.width IS NULL THEN 'page out of range'
  WHEN x1 <= x0 OR y1 <= y0 THEN 'degenerate'
  WHEN x0 < -1 OR y0 < -1 OR x1 > p.width + 1 OR y1 > p.height + 1 THEN 'outside page' END AS reason
FROM rect r LEFT JOIN (SELECT DISTINCT form_id, page, CAST(612 AS DOUBLE) AS width, CAST(792 AS DOUBLE) AS height FROM box) p ON r.form_id = p.form_id AND r.page = p.page""",
)
def valid_rects(t: Tables):
    # only pages with a printed box are listed, so "page out of range" occurs too
    listed = t.box.select("form_id", "page").distinct()
    return audit.valid_rects(t.rect, listed.withColumns({"width": F.lit(PAGE_W), "height": F.lit(PAGE_H)}))


@query(
    uses="rect word",
    sql=f"""SELECT a.form_id, a.page, a.rect_id FROM rect a WHERE a.kind = 'text' AND NOT EXISTS (
  SELECT 1 FROM word b WHERE {PAIR} AND length(trim(b.text)) >= 3
  AND greatest(0, b.y0 - a.y1, a.y0 - b.y1) <= 60
  AND CASE WHEN {OX} > 0 THEN -{OX} ELSE least(abs(b.x0 - a.x1), abs(a.x0 - b.x1)) END <= 80)""",
)
def orphan_widgets(t: Tables):
    # the derived pages are dense, so a smaller radius than the default
    return audit.orphan_widgets(t.rect, t.word, radius=60.0, side=80.0)


@query(
    uses="rect rule word",
    sql=f"""WITH cited AS (SELECT * FROM word WHERE regexp_matches(text, '^2 ') OR regexp_matches(text, 'date of')),
sep AS (SELECT * FROM rule WHERE x1 - x0 >= 100)
SELECT DISTINCT a.form_id, a.page, a.rect_id FROM rect a WHERE a.kind = 'text' AND (
  EXISTS (SELECT 1 FROM cited b WHERE {PAIR} AND (b.x0 BETWEEN a.x0 AND a.x1 OR b.x1 BETWEEN a.x0 AND a.x1)
    AND b.y0 BETWEEN a.y0 AND a.y1)
  OR EXISTS (SELECT 1 FROM sep b JOIN cited c ON b.form_id = c.form_id AND b.page = c.page WHERE {PAIR} AND {OX} > 0
    AND ((b.y0 BETWEEN a.y1 + 2 AND a.y1 + 30 AND c.y0 > b.y0 AND c.y0 <= b.y0 + 40)
      OR (b.y0 BETWEEN a.y0 - 30 AND a.y0 - 2 AND c.y0 BETWEEN b.y0 - 40 AND b.y0))))""",
)
def near_footer(t: Tables):
    return audit.near_footer(t.rect, t.rule, t.word, citation="^2 |date of")
