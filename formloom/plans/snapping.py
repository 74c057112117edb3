"""Snapping and alignment over the derived pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.operators import snap
from formloom.plans.joins import OA, OX, OY, PAIR
from formloom.plans.layout import CELLS, HEADS, IN_B, _cells
from formloom.plans.registry import query
from formloom.sources.testdata import PAGE_W, Tables

D = "CAST(%s AS DOUBLE)"
KEY = "a.form_id, a.page, a.rect_id"
BY_KEY = f"PARTITION BY {KEY}"


def _near(rule: str = "rule") -> str:
    return f"""SELECT {KEY}, a.x0, a.y0, a.x1, a.y1, b.rule_id, b.x0 AS rule_x0, b.x1 AS rule_x1, b.y0 AS rule_y,
  abs(b.y0 - a.y1) + CASE WHEN b.y0 - a.y1 BETWEEN 0 AND 4 THEN 0 ELSE 0.5 END + CAST(0.05 AS DOUBLE) * greatest(0, (a.x1 - a.x0) - (b.x1 - b.x0)) AS cost
FROM rect a JOIN {rule} b ON {PAIR} WHERE abs(b.y0 - a.y1) <= 15 AND b.x1 >= a.x0 - 12 AND b.x0 <= a.x1 + 12
QUALIFY row_number() OVER ({BY_KEY} ORDER BY cost, b.y0, b.x0, b.rule_id) = 1"""


NEAR = _near()


@query(uses="rect rule", sql=NEAR)
def nearest_rule(t: Tables):
    return snap.nearest_rule(t.rect, t.rule)


@query(
    uses="rect rule",
    sql=f"""WITH m AS ({NEAR}), k AS (SELECT * FROM m WHERE rule_x1 - rule_x0 >= CAST(0.3 AS DOUBLE) * (x1 - x0)),
o AS (SELECT k.form_id, k.page, k.rect_id, count(w.rect_id) FILTER (w.rect_id <> k.rect_id) AS others,
  greatest(any_value(k.rule_x0), any_value(k.x0) - 8) AS c0, least(any_value(k.rule_x1), any_value(k.x1) + 8) AS c1,
  any_value(k.rule_id) AS rule_id, any_value(k.rule_x0) AS rx0, any_value(k.rule_x1) AS rx1, any_value(k.rule_y) AS ry
  FROM k LEFT JOIN rect w ON w.form_id = k.form_id AND w.page = k.page AND abs(w.y1 - k.rule_y) <= 3 AND w.x1 >= k.rule_x0 AND w.x0 <= k.rule_x1
  GROUP BY ALL)
SELECT form_id, page, rect_id, rule_id, CASE WHEN others = 0 OR c1 - c0 < 5 THEN rx0 ELSE c0 END AS x0, ry - 12 AS y0,
  CASE WHEN others = 0 OR c1 - c0 < 5 THEN rx1 ELSE c1 END AS x1, ry AS y1, others = 0 AS sole_owner FROM o""",
)
def snap_to_rule(t: Tables):
    return snap.snap_to_rule(snap.nearest_rule(t.rect, t.rule), t.rect)


@query(
    uses="rect word rule",
    sql=f"""WITH h AS (SELECT {KEY}, a.x0, a.y0, a.x1, a.y1, b.x1 AS gx FROM rect a JOIN word b ON {PAIR} WHERE a.field_id IN ('f1', 'f2', 'f3', 'f4')
  AND b.text = '$' AND a.x0 BETWEEN b.x0 - 1 AND b.x1 + 1 AND b.y1 >= a.y0 AND b.y0 <= a.y1
  QUALIFY row_number() OVER ({BY_KEY} ORDER BY b.y0, b.x0, b.line_id) = 1),
u AS (SELECT {KEY}, b.y0 AS ry FROM h a JOIN rule b ON {PAIR} WHERE abs(b.y0 - a.y1) <= 3 AND b.x1 >= a.x0 AND b.x0 <= a.x1
  QUALIFY row_number() OVER ({BY_KEY} ORDER BY abs(b.y0 - a.y1), b.y0, b.x0, b.rule_id) = 1)
SELECT {KEY}, gx + 2 AS x0, coalesce(ry, y1) - (y1 - y0) AS y0, x1, coalesce(ry, y1) AS y1 FROM h a
LEFT JOIN u b ON {PAIR} AND a.rect_id = b.rect_id""",
)
def currency_glyph_overlap(t: Tables):
    return snap.currency_glyph_overlap(t.rect, t.word.where("text = '$'"), t.rule, money_names="^f[1-4]$")


@query(
    uses="rect rule word",
    sql=f"""WITH s AS (SELECT {KEY}, a.x0, a.y0, a.x1, a.y1, count(*) AS n, count(*) FILTER ({OX} > CAST(0.4 AS DOUBLE) * (a.x1 - a.x0)) AS ns,
  min(b.x0) AS sx0, min(b.x1) AS sx1, min(b.y0) AS sy FROM rect a JOIN rule b ON {PAIR} AND b.y0 BETWEEN a.y0 - 3 AND a.y1 + 9 AND {OX} > 8 GROUP BY ALL),
l AS (SELECT * FROM s WHERE n = 1 AND ns = 1 AND sx1 - sx0 BETWEEN 25 AND CAST(0.8 AS DOUBLE) * 612 AND sx0 - x0 <= 30 AND x1 - sx1 <= 30),
m AS (SELECT a.*, greatest(sx0, coalesce((SELECT max(b.x1) + 1.5 FROM word b WHERE {PAIR} AND {OY} > CAST(0.4 AS DOUBLE) * (b.y1 - b.y0)
  AND b.x1 BETWEEN a.sx0 - 2 AND a.x0 + 0.5 * (a.x1 - a.x0)), sx0)) AS nx0 FROM l a)
SELECT {KEY}, nx0 AS x0, y0, least(sx1, coalesce((SELECT min(b.x0) - 1.5 FROM word b WHERE {PAIR} AND {OY} > CAST(0.4 AS DOUBLE) * (b.y1 - b.y0)
  AND b.x0 > a.nx0 + 6 AND b.x0 <= a.sx1 + 4), sx1)) AS x1, y1, sy FROM m a""",
)
def lone_segment_snap(t: Tables):
    return snap.lone_segment_snap(t.rect, t.rule, t.word, page_width=PAGE_W)


CLASH = f"(a.field_id <> b.field_id AND {OX} > 2 AND {OY} > 2)"


@query(
    uses="rect rule word",
    sql=f"""WITH c AS (SELECT {KEY}, a.field_id, a.x0, a.y0, a.x1, a.y1, count(*) FILTER (abs(b.y0 - a.y1) < 5 AND {OX} > 25) AS n_row,
  min((abs(b.y0 - a.y1), b.x0, b.x1, b.y0)) FILTER (abs(b.y0 - a.y1) < 9 AND {OX} > CAST(0.4 AS DOUBLE) * least(a.x1 - a.x0, b.x1 - b.x0)) AS s
  FROM rect a JOIN rule b ON {PAIR} AND b.x1 - b.x0 >= 20 AND abs(b.y0 - a.y1) < 9 WHERE a.kind = 'text' AND a.y1 - a.y0 <= 20 GROUP BY ALL),
g AS (SELECT *, s[2] AS bx0, s[3] AS bx1, s[4] AS bz FROM c WHERE s IS NOT NULL AND n_row <= 1 AND s[3] - s[2] >= 0.75 * (x1 - x0)),
p AS (SELECT a.*, greatest(bx0, coalesce((SELECT max(b.x1) + 3.5 FROM word b WHERE {PAIR} AND abs((b.y0 + b.y1) / 2 - a.bz) < 6 AND b.x1 <= a.bx0 + 2
  AND a.bx0 - b.x1 < 3.5 AND NOT regexp_matches(trim(b.text), '^_*$')), bx0)) AS lx FROM g a),
t AS (SELECT form_id, page, rect_id, field_id, x0 AS ox0, y0 AS oy0, x1 AS ox1, y1 AS oy1, round(lx, 1) AS x0, round(bz + 1 - (y1 - y0), 1) AS y0,
  round(bx1, 1) AS x1, round(bz + 1, 1) AS y1 FROM p),
n AS (SELECT * FROM t WHERE abs(x0 - ox0) >= 1 OR abs(x1 - ox1) >= 1 OR abs(y1 - oy1) >= 1),
e AS (SELECT form_id, page, field_id, x0, y0, x1, y1 FROM n UNION ALL SELECT form_id, page, field_id, x0, y0, x1, y1 FROM rect r
  WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.form_id = r.form_id AND n.page = r.page AND n.rect_id = r.rect_id)),
bump AS (SELECT DISTINCT {KEY} FROM n a JOIN e b ON {PAIR} AND {CLASH}),
o AS (SELECT form_id, page, rect_id, field_id, ox0 AS x0, oy0 AS y0, ox1 AS x1, oy1 AS y1 FROM n),
busy AS (SELECT DISTINCT {KEY} FROM o a JOIN rect b ON {PAIR} AND {CLASH})
SELECT form_id, page, rect_id, field_id, x0, y0, x1, y1 FROM n WHERE NOT (
  EXISTS (SELECT 1 FROM bump q WHERE q.form_id = n.form_id AND q.page = n.page AND q.rect_id = n.rect_id)
  AND NOT EXISTS (SELECT 1 FROM busy q WHERE q.form_id = n.form_id AND q.page = n.page AND q.rect_id = n.rect_id))""",
)
def blank_snap(t: Tables):
    return snap.blank_snap(t.rect, t.rule, t.word)


@query(
    uses="rect word rule",
    sql=f"""WITH w AS (SELECT {KEY}, max(b.x1) FILTER (b.x0 < a.x0 + CAST(0.6 AS DOUBLE) * (a.x1 - a.x0) AND b.x1 > a.x0 - 1) AS lx,
  min(b.x0) FILTER (b.x0 > a.x0 + CAST(0.3 AS DOUBLE) * (a.x1 - a.x0) AND b.x0 < a.x1) AS tx
  FROM rect a JOIN word b ON {PAIR} AND {OY} > 0.5 * (b.y1 - b.y0) GROUP BY ALL),
r AS (SELECT {KEY}, min(b.y0) FILTER (b.y0 > a.y1 AND b.y0 <= a.y1 + 34) AS bz,
  (min((abs(b.y0 - a.y1), b.y0)) FILTER (b.y0 BETWEEN a.y0 - 4 AND a.y1 + 8))[2] AS uy
  FROM rect a JOIN rule b ON {PAIR} AND {OX} > CAST(0.3 AS DOUBLE) * (a.x1 - a.x0) GROUP BY ALL),
j AS (SELECT {KEY}, a.x0, a.y0, a.x1, a.y1, lx, tx, bz, uy, least(a.y1 - uy - 0.5, 6) AS lift FROM rect a
  LEFT JOIN w ON w.form_id = a.form_id AND w.page = a.page AND w.rect_id = a.rect_id
  LEFT JOIN r ON r.form_id = a.form_id AND r.page = a.page AND r.rect_id = a.rect_id),
tr AS (SELECT form_id, page, rect_id, 1 AS n, 'past_label' AS trial, lx + 3 AS x0, y0, x1, y1 FROM j WHERE x1 - lx - 3 >= 20
  UNION ALL SELECT form_id, page, rect_id, 2, 'before_text', x0, y0, tx - 3, y1 FROM j WHERE tx - 3 - x0 >= 20
  UNION ALL SELECT form_id, page, rect_id, 3, 'down_to_line', x0, y0 + bz - 2 - y1, x1, bz - 2 FROM j WHERE bz IS NOT NULL
  UNION ALL SELECT form_id, page, rect_id, 4, 'up_to_line', x0, y0 - lift, x1, y1 - lift FROM j WHERE uy IS NOT NULL AND lift > 1.5),
rd AS (SELECT form_id, page, rect_id, n, trial, round(x0, 1) AS x0, round(y0, 1) AS y0, round(x1, 1) AS x1, round(y1, 1) AS y1 FROM tr),
dd AS (SELECT * FROM rd QUALIFY row_number() OVER (PARTITION BY form_id, page, rect_id, x0, y0, x1, y1 ORDER BY n) = 1),
nn AS (SELECT *, CAST(row_number() OVER (PARTITION BY form_id, page, rect_id ORDER BY n) AS INTEGER) AS choice_no FROM dd)
SELECT form_id, page, rect_id, choice_no, trial, x0, y0, x1, y1 FROM nn WHERE choice_no <= 3""",
)
def fix_candidates(t: Tables):
    return snap.fix_candidates(t.rect, t.word, t.rule)


@query(
    uses="rect word rect_b",
    sql=f"""WITH bad AS (SELECT {KEY}, a.x0, a.y0, a.x1, a.y1 FROM rect a WHERE a.kind = 'text' AND EXISTS (SELECT 1 FROM word b WHERE {PAIR}
  AND length(trim(b.text)) >= 2 AND regexp_matches(b.text, '[A-Za-z]') AND b.x1 - b.x0 >= 10
  AND (b.y0 + b.y1) / 2 BETWEEN a.y0 - 1 AND a.y1 + 1 AND b.x0 BETWEEN a.x0 + 5 AND a.x1 - 10)),
h AS (SELECT {KEY}, b.rect_id AS old_id, b.x0, b.y0, b.x1, b.y1 FROM bad a JOIN rect_b b ON {PAIR} AND b.kind = 'text'
  AND (a.x0 + a.x1) / 2 BETWEEN b.x0 AND b.x1 AND (a.y0 + a.y1) / 2 BETWEEN b.y0 AND b.y1
  QUALIFY row_number() OVER ({BY_KEY} ORDER BY b.rect_id) = 1)
SELECT {KEY}, CASE WHEN old_id IS NULL THEN 'dropped' ELSE 'replaced' END AS action, old_id, b.x0, b.y0, b.x1, b.y1 FROM bad a
LEFT JOIN h b ON {PAIR} AND a.rect_id = b.rect_id""",
)
def swallowed_labels(t: Tables):
    return snap.swallowed_labels(t.rect, t.word, t.rect_b)


@query(
    uses="rect rule",
    sql=f"""WITH tall AS (SELECT DISTINCT {KEY}, a.x0, a.y0, a.x1, a.y1 FROM rect a JOIN rect b ON {PAIR} AND a.field_id <> b.field_id
  AND {OY} >= 2 AND {OX} > 0 AND {OA} >= 100 AND (a.y1 - a.y0) - (b.y1 - b.y0) >= 4),
near AS (SELECT {KEY}, b.rule_id, b.x0, b.x1, b.y1 FROM tall a JOIN rule b ON {PAIR} AND b.x1 - b.x0 >= 20 AND b.y0 BETWEEN a.y0 - 20 AND a.y1 + 5
  AND (greatest(0, {OX}) >= CAST(0.05 AS DOUBLE) * (a.x1 - a.x0) OR greatest(0, {OX}) >= 0.5 * (b.x1 - b.x0)) AND b.x1 - b.x0 <= 1.5 * (a.x1 - a.x0)),
free AS (SELECT * FROM near a WHERE NOT EXISTS (SELECT 1 FROM rect b WHERE {PAIR} AND b.rect_id <> a.rect_id AND abs(b.y1 - a.y1) < 2))
SELECT form_id, page, rect_id, min(x0) AS x0, min(y1) - 12 AS y0, min(x1) AS x1, min(y1) AS y1 FROM free GROUP BY ALL HAVING count(*) = 1""",
)
def shrink_tall(t: Tables):
    # derived widgets differ by 8 pt at most and rules are long, so both limits are set for them
    return snap.shrink_tall(t.rect, t.rule, min_taller=4.0, max_share=1.5)


@query()
def shrink_tall_in_order(t: Tables):
    """Every third widget stands 30 pt higher, over its neighbours above."""
    tall = t.rect.withColumn("y0", F.when(F.col("rect_id") % 3 == 0, F.col("y0") - 30).otherwise(F.col("y0")))
    return snap.shrink_tall_in_order(tall, t.rule, max_share=1.5)


@query(
    uses="box",
    sql="""WITH c AS (SELECT form_id, round(x1 - x0) AS v, count(*) AS n FROM box GROUP BY ALL)
SELECT form_id, arg_max(v, (n, -v)) AS mode, max(n) AS n FROM c GROUP BY form_id""",
)
def modal_value(t: Tables):
    return snap.modal_value(t.box, ["form_id"], F.rint(F.col("x1") - F.col("x0")))


@query(
    uses="box",
    sql="""WITH w AS (SELECT form_id, arg_max(v, (n, -v)) AS mw FROM (SELECT form_id, round(x1 - x0) AS v, count(*) AS n FROM box GROUP BY ALL) GROUP BY form_id),
h AS (SELECT form_id, arg_max(v, (n, -v)) AS mh, sum(n) AS n FROM (SELECT form_id, round(y1 - y0) AS v, count(*) AS n FROM box GROUP BY ALL) GROUP BY form_id),
s AS (SELECT b.*, CASE WHEN abs(mw - mh) <= 1.5 THEN greatest(mw, mh) ELSE mw END AS cw, CASE WHEN abs(mw - mh) <= 1.5 THEN greatest(mw, mh) ELSE mh END AS ch
  FROM box b JOIN w ON b.form_id = w.form_id JOIN h ON b.form_id = h.form_id AND h.n >= 2)
SELECT form_id, page, box_id, (x0 + x1) / 2 - cw / 2 AS x0, (y0 + y1) / 2 - ch / 2 AS y0, (x0 + x1) / 2 + cw / 2 AS x1, (y0 + y1) / 2 + ch / 2 AS y1 FROM s""",
)
def canonical_checkboxes(t: Tables):
    return snap.canonical_checkboxes(t.box)


PEAKS = "SELECT form_id, page, round(x0) AS peak_x, count(*) AS n FROM word GROUP BY ALL HAVING count(*) >= 3"


@query(uses="word", sql=PEAKS)
def indent_peaks(t: Tables):
    return snap.indent_peaks(t.word)


MARGINS = """SELECT form_id, page, (list_sort(list(x0)))[1 + count(*) // 20] AS left_x,
  (list_sort(list(x1)))[1 + least(count(*) - 1, CAST(floor(count(*) * CAST(0.95 AS DOUBLE)) AS BIGINT))] AS right_x FROM word GROUP BY ALL"""


@query(uses="word", sql=MARGINS)
def body_margins(t: Tables):
    return snap.body_margins(t.word)


@query(
    uses="rect word",
    sql=f"""WITH p AS (SELECT DISTINCT {KEY}, a.x1 - a.x0 AS w, greatest(a.x0, b.x0) AS lo, least(a.x1, b.x1) AS hi FROM rect a JOIN word b ON {PAIR}
  WHERE {OY} > CAST(0.4 AS DOUBLE) * (b.y1 - b.y0) AND {OX} > 0),
f AS (SELECT *, greatest(0, hi - greatest(lo, max(hi) OVER (PARTITION BY form_id, page, rect_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))) AS fresh FROM p)
SELECT form_id, page, rect_id, round(sum(fresh) / greatest(1, max(w)), 2) AS cover FROM f GROUP BY ALL""",
)
def word_cover(t: Tables):
    return snap.word_cover(t.rect, t.word)


@query(
    uses="rect word",
    sql=f"""WITH m AS ({MARGINS}),
r AS (SELECT {KEY}, a.x0, a.y0, a.x1, a.y1, count(*) + 1 AS n_columns, count(*) FILTER (b.x0 < a.x0) AS slot FROM rect a JOIN rect b ON {PAIR} AND a.rect_id <> b.rect_id
  AND {OY} > 0.5 * least(a.y1 - a.y0, b.y1 - b.y0) GROUP BY ALL),
t AS (SELECT {KEY} FROM rect a JOIN rect b ON {PAIR} AND abs(a.x0 - b.x0) < 8 AND abs(a.x1 - b.x1) < 8
  AND abs((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2) > a.y1 - a.y0 GROUP BY ALL HAVING count(*) >= 2)
SELECT r.form_id, r.page, r.rect_id, n_columns, slot, round(left_x + slot * ((right_x - left_x - (n_columns - 1) * 14) / n_columns + 14), 6) AS col_x0,
  round(left_x + slot * ((right_x - left_x - (n_columns - 1) * 14) / n_columns + 14) + (right_x - left_x - (n_columns - 1) * 14) / n_columns, 6) AS col_x1
FROM r JOIN m ON r.form_id = m.form_id AND r.page = m.page WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.form_id = r.form_id AND t.page = r.page AND t.rect_id = r.rect_id)""",
)
def equal_columns(t: Tables):
    return snap.equal_columns(t.rect, snap.body_margins(t.word))


@query(
    uses="rect rule vrule word",
    sql=f"""{HEADS}, p AS (SELECT {KEY}, a.y1 - a.y0 AS h, b.x0, b.y0, b.x1, b.y1 FROM rect a JOIN cells b ON {PAIR}
  WHERE a.kind = 'text' AND (a.x0 + a.x1) / 2 BETWEEN b.x0 AND b.x1 AND (a.y0 + a.y1) / 2 BETWEEN b.y0 AND b.y1
  AND NOT EXISTS (SELECT 1 FROM heads c WHERE a.form_id = c.form_id AND a.page = c.page AND (a.x0 + a.x1) / 2 BETWEEN c.x0 AND c.x1 AND (a.y0 + a.y1) / 2 BETWEEN c.y0 AND c.y1)
  QUALIFY row_number() OVER ({BY_KEY} ORDER BY (b.x1 - b.x0) * (b.y1 - b.y0) DESC, b.y0, b.x0) = 1)
SELECT form_id, page, rect_id, x0, y0, x1, y1 FROM p WHERE h <= 1.5 * (y1 - y0)""",
)
def cell_fit(t: Tables):
    return snap.cell_fit(t.rect, *_cells(t))


def _clusters(table: str, value: str, tol: float) -> str:
    """Cluster CTEs: ``cv`` maps each distinct value to its cluster ``k``."""
    return f"""WITH o AS (SELECT form_id, page, {value} AS v, count(*) AS c, lag({value}) OVER (PARTITION BY form_id, page ORDER BY {value}) AS p
  FROM {table} GROUP BY form_id, page, {value}),
cv AS (SELECT *, sum(CASE WHEN p IS NULL OR v - p > {tol} THEN 1 ELSE 0 END) OVER (PARTITION BY form_id, page ORDER BY v) AS k FROM o),
cs AS (SELECT t.form_id, t.page, k, count(*) AS size, avg(t.{value}) AS mean, max(t.{value}) AS high,
  (list_sort(list(t.{value})))[1 + count(*) // 2] AS median FROM {table} t JOIN cv ON cv.form_id = t.form_id AND cv.page = t.page AND cv.v = t.{value} GROUP BY ALL)"""


@query(
    uses="rect",
    sql=f"""{_clusters('rect', 'x0', 3)}
SELECT cv.form_id, cv.page, CAST(cv.k AS BIGINT) AS cluster, cv.v AS x0, size, round(mean, 6) AS mean, median, high
FROM cv JOIN cs ON cv.form_id = cs.form_id AND cv.page = cs.page AND cv.k = cs.k""",
)
def axis_clusters(t: Tables):
    from formloom.operators.detect import clustered_positions

    return clustered_positions(t.rect, ["form_id", "page"], "x0", 3.0).withColumn("mean", F.round("mean", 6))


@query(
    uses="rect rule",
    sql=f"""{_clusters('rule', 'y0', 1.5)},
b AS (SELECT DISTINCT form_id, page, mean AS y FROM cs),
e AS (SELECT {KEY}, min((abs(b.y - a.y0), b.y)) FILTER (abs(b.y - a.y0) <= 3) AS t, min((abs(b.y - a.y1), b.y)) FILTER (abs(b.y - a.y1) <= 3) AS u
  FROM rect a JOIN b ON {PAIR} WHERE a.kind = 'text' GROUP BY ALL)
SELECT form_id, page, rect_id, t[2] AS y0, u[2] AS y1 FROM e WHERE u[2] - t[2] >= 8""",
)
def snap_rows(t: Tables):
    return snap.snap_rows(t.rect, t.rule)


TEXT = "(SELECT * FROM rect_b WHERE kind = 'text')"


@query(
    uses="rect_b",
    sql=f"""{_clusters(TEXT, 'x0', 18)}
SELECT r.form_id, r.page, rect_id, median AS x0, x1 + median - x0 AS x1 FROM {TEXT} r JOIN cv ON cv.form_id = r.form_id AND cv.page = r.page AND cv.v = r.x0
JOIN cs ON cv.form_id = cs.form_id AND cv.page = cs.page AND cv.k = cs.k WHERE size >= 2 AND abs(median - x0) > 0.01""",
)
def align_left_clusters(t: Tables):
    return snap.align_left_clusters(t.rect_b)


WIDE = "(SELECT * FROM rect WHERE kind = 'text' AND x1 - x0 >= 100)"


@query(
    uses="rect",
    sql=f"""{_clusters(WIDE, 'x1', 20)}
SELECT r.form_id, r.page, rect_id, high AS x1 FROM {WIDE} r JOIN cv ON cv.form_id = r.form_id AND cv.page = r.page AND cv.v = r.x1
JOIN cs ON cv.form_id = cs.form_id AND cv.page = cs.page AND cv.k = cs.k WHERE size >= 2 AND x1 <> high""",
)
def align_right_clusters(t: Tables):
    return snap.align_right_clusters(t.rect)


@query(
    uses="rect word",
    sql="""WITH c AS (SELECT form_id, page, round(x1) AS v, count(*) AS n FROM word WHERE x1 > 400 GROUP BY ALL),
m AS (SELECT form_id, page, arg_max(v, (n, -v)) AS x FROM c GROUP BY ALL)
SELECT r.form_id, r.page, rect_id, x AS x1 FROM rect r JOIN m ON r.form_id = m.form_id AND r.page = m.page WHERE kind = 'text' AND abs(x1 - x) <= 8""",
)
def align_right_margin(t: Tables):
    return snap.align_right_margin(t.rect, t.word)


@query(
    uses="rect word",
    sql=f"""WITH p AS ({PEAKS}), k AS (SELECT form_id, page FROM p GROUP BY ALL HAVING count(*) <= 4),
b AS (SELECT {KEY}, a.x0, a.x1, p.peak_x, abs(p.peak_x - a.x0) AS d FROM rect a JOIN p ON a.form_id = p.form_id AND a.page = p.page SEMI JOIN k ON a.form_id = k.form_id AND a.page = k.page
  WHERE a.kind = 'text' QUALIFY row_number() OVER ({BY_KEY} ORDER BY d, p.peak_x) = 1)
SELECT form_id, page, rect_id, peak_x AS x0, x1 + peak_x - x0 AS x1 FROM b WHERE d <= 6""",
)
def align_to_indents(t: Tables):
    return snap.align_to_indents(t.rect, t.word)


@query(
    uses="rect vrule",
    sql=f"""{_clusters('vrule', 'x0', 1.5)},
b AS (SELECT DISTINCT form_id, page, mean AS x FROM cs),
e AS (SELECT {KEY}, a.x0, a.x1, min((abs(b.x - a.x0), b.x)) FILTER (abs(b.x - a.x0) <= 8) AS l, min((abs(b.x - a.x1), b.x)) FILTER (abs(b.x - a.x1) <= 8) AS r
  FROM rect a JOIN b ON {PAIR} WHERE a.kind = 'text' GROUP BY ALL)
SELECT form_id, page, rect_id, coalesce(l[2], x0) AS x0, coalesce(r[2], x1) AS x1, l IS NOT NULL AND r IS NOT NULL AS anchored FROM e
WHERE (l IS NOT NULL OR r IS NOT NULL) AND coalesce(r[2], x1) - coalesce(l[2], x0) >= 8""",
)
def align_to_separators(t: Tables):
    return snap.align_to_separators(t.rect, t.vrule)


@query(
    uses="rect",
    sql="""SELECT form_id, page, rect_id, round(x0, 1) AS x0, round(y1 - 13, 1) AS y0, round(x1, 1) AS x1, round(y1, 1) AS y1 FROM rect
WHERE y1 - y0 BETWEEN 9 AND 24 AND abs(y1 - y0 - 13) > 0.6""",
)
def normalize_heights(t: Tables):
    return snap.normalize_heights(t.rect)


@query(
    uses="rect",
    sql=f"""WITH p AS (SELECT {KEY}, a.x0, a.x1, (b.x0 + b.x1) / 2 > (a.x0 + a.x1) / 2 AS to_right, b.x0 AS bx0, b.x1 AS bx1 FROM rect a JOIN rect b ON {PAIR}
  AND a.rect_id <> b.rect_id AND a.field_id <> b.field_id AND {OY} / least(a.y1 - a.y0, b.y1 - b.y0) >= 0.5 AND {OX} * least(a.y1 - a.y0, b.y1 - b.y0) >= 4
  AND (a.x1 - a.x0 > b.x1 - b.x0 OR (a.x1 - a.x0 = b.x1 - b.x0 AND a.rect_id < b.rect_id))),
c AS (SELECT form_id, page, rect_id, x0, x1, max(bx1 + 2) FILTER (NOT to_right AND bx1 + 2 < x1) AS c0, min(bx0 - 2) FILTER (to_right AND bx0 - 2 > x0) AS c1 FROM p GROUP BY ALL)
SELECT form_id, page, rect_id, coalesce(c0, x0) AS x0, coalesce(c1, x1) AS x1 FROM c WHERE c0 IS NOT NULL OR c1 IS NOT NULL""",
)
def shrink_overlaps(t: Tables):
    return snap.shrink_overlaps(t.rect)


@query(
    uses="rect word",
    sql=f"""WITH low AS (SELECT form_id, page, line_id, x0, y0 + 7 AS y0, x1, y1 + 7 AS y1 FROM word),
s AS (SELECT {KEY}, a.y0, min(b.y0) - 2 AS stop FROM rect a JOIN low b ON {PAIR} AND b.y0 > a.y0 + 4 AND b.y0 < a.y1
  AND ({OX} >= 8 OR a.x1 - a.x0 >= 150) WHERE a.y1 - a.y0 > 12 GROUP BY ALL)
SELECT form_id, page, rect_id, CASE WHEN stop - y0 >= 13 THEN stop ELSE y0 + 13 END AS y1 FROM s""",
)
def avoid_following_text(t: Tables):
    # derived widgets are at most 18 high and tops share a 20-pt grid, so words move down by 7
    low = t.word.withColumns({"y0": F.col("y0") + 7, "y1": F.col("y1") + 7})
    return snap.avoid_following_text(t.rect, low, tall=12.0, page_wide=150.0)


@query(
    uses="rect rule",
    sql=f"""WITH rule_b AS (SELECT form_id, page, rule_id, x0 + rule_id % 7 AS x0, y0 + rule_id % 2 AS y0, x1 - rule_id % 5 AS x1 FROM rule),
ma AS ({NEAR}), mb AS ({_near('rule_b')}),
j AS (SELECT ma.form_id, abs(ma.rule_x0 - mb.rule_x0) AS d0, abs(ma.rule_x1 - mb.rule_x1) AS d1 FROM ma JOIN mb ON ma.form_id = mb.form_id AND ma.page = mb.page AND ma.rect_id = mb.rect_id)
SELECT form_id, count(*) AS n, round(avg(d0), 6) AS mean_dx0, round(avg(d1), 6) AS mean_dx1,
  round(avg(CASE WHEN d0 > 5 OR d1 > 5 THEN 1 ELSE 0 END), 6) AS share_moved FROM j GROUP BY form_id""",
)
def drift_stats(t: Tables):
    other = t.rule.select(
        "form_id",
        "page",
        "rule_id",
        (F.col("x0") + F.col("rule_id") % 7).alias("x0"),
        (F.col("y0") + F.col("rule_id") % 2).alias("y0"),
        (F.col("x1") - F.col("rule_id") % 5).alias("x1"),
        (F.col("y0") + F.col("rule_id") % 2).alias("y1"),
    )
    return snap.drift_stats(t.rect, t.rule, other)


@query(
    uses="rect rule",
    sql=f"""WITH m AS ({NEAR}), o AS (SELECT *, greatest(0, x0 - rule_x0) AS l, greatest(0, rule_x1 - x1) AS r FROM m)
SELECT form_id, count(*) AS n, sum(l) AS left_overhang, sum(r) AS right_overhang, count(*) FILTER (l + r > 25 AND l + r <= 75) AS creep,
  count(*) FILTER (l + r > 75) AS big_creep FROM o GROUP BY form_id""",
)
def anchor_overhang(t: Tables):
    return snap.anchor_overhang(snap.nearest_rule(t.rect, t.rule))
