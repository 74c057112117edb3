"""Names, reading order and sections over the derived layouts and schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.operators import naming
from formloom.plans.joins import IOU, PAIR
from formloom.plans.registry import query
from formloom.sources.testdata import Tables

STANDARD = {"red ring date of": "date_signed", "blue ring": "ring"}
ALIASES = {"small_ring": "ring", "large_ring_date_of": "date_signed"}

CLEAN = r"""CASE WHEN regexp_matches(trim(regexp_replace(l, '[:. ]+$', '')), '^[a-z][a-z0-9_]*$') THEN trim(regexp_replace(l, '[:. ]+$', ''))
  ELSE regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(l, '[:.\s]+$', ''))), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), '^([0-9])', 'f_\1') END"""


def _labelled(t: Tables):
    kind = F.when(F.col("q") % 6 == 0, "checkbox").when(F.col("q") % 6 == 1, "signature").otherwise("text")
    label = F.when(F.col("q") % 7 == 0, "").otherwise(F.col("text"))
    return t.word.select("form_id", "page", F.col("line_id").alias("rect_id"), "x0", "y0", label.alias("label"), kind.alias("field_type"))


@query(
    uses="word",
    sql=f"""WITH f AS (SELECT form_id, page, line_id AS rect_id, x0, y0, CASE WHEN q % 7 = 0 THEN '' ELSE trim(text) END AS l,
  CASE q % 6 WHEN 0 THEN 'checkbox' WHEN 1 THEN 'signature' ELSE 'text' END AS field_type FROM word),
n AS (SELECT *, coalesce(CASE regexp_replace(lower(l), '[:. ]+$', '') WHEN 'red ring date of' THEN 'date_signed' WHEN 'blue ring' THEN 'ring' END,
  nullif({CLEAN}, ''), CASE WHEN field_type = 'signature' THEN 'signature' END) AS own FROM f),
k AS (SELECT *, CASE WHEN own IS NULL THEN CASE WHEN field_type = 'checkbox' THEN 'checkbox' ELSE 'field' END END AS kind FROM n),
p AS (SELECT *, CASE WHEN kind IS NOT NULL THEN kind || '_' || CAST(row_number() OVER (PARTITION BY form_id, kind ORDER BY page, y0, x0, rect_id) AS VARCHAR) ELSE own END AS b0 FROM k),
b AS (SELECT *, CASE b0 WHEN 'small_ring' THEN 'ring' WHEN 'large_ring_date_of' THEN 'date_signed' ELSE b0 END AS base_name FROM p),
u AS (SELECT *, row_number() OVER (PARTITION BY form_id, base_name ORDER BY page, y0, x0, rect_id) AS c FROM b),
g AS (SELECT *, CASE WHEN c = 1 OR regexp_matches(base_name, '^(checkbox|field)_\\d+$') THEN base_name ELSE base_name || '_' || CAST(c AS VARCHAR) END AS field_name FROM u)
SELECT form_id, page, rect_id, base_name, field_name, count(*) OVER (PARTITION BY form_id, field_name) > 1 AS clash FROM g""",
)
def assign_names(t: Tables):
    return naming.assign_names(_labelled(t), STANDARD, ALIASES)


SLUG = "left(regexp_replace(regexp_replace(regexp_replace(lower(trim({})), '[:.,?#]+$', ''), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 45)"


@query(
    uses="word",
    sql=f"""WITH f AS (SELECT form_id, page, line_id AS rect_id, x0, y0, CASE WHEN q % 7 = 0 THEN '' ELSE text END AS l,
  CASE WHEN q % 3 = 0 THEN 'red_ring' WHEN q % 3 = 1 THEN 'owner' ELSE '' END AS prefix FROM word),
s AS (SELECT *, CASE WHEN l = '' THEN 'text' ELSE coalesce(nullif({SLUG.format('l')}, ''), 'field') END AS slug FROM f),
b AS (SELECT *, CASE WHEN prefix <> '' AND NOT starts_with(slug, left(prefix, 8)) THEN prefix || '_' || slug ELSE slug END AS base FROM s),
u AS (SELECT *, row_number() OVER (PARTITION BY form_id, base ORDER BY page, y0, x0, rect_id) AS c FROM b)
SELECT form_id, page, rect_id, CASE WHEN c = 1 THEN base ELSE base || '_' || CAST(c AS VARCHAR) END AS field_name FROM u""",
)
def assign_prefixed_names(t: Tables):
    fields = t.word.select(
        "form_id", "page", F.col("line_id").alias("rect_id"), "x0", "y0", F.lit("text").alias("kind"),
        F.when(F.col("q") % 7 == 0, "").otherwise(F.col("text")).alias("label"),
        F.when(F.col("q") % 3 == 0, "red_ring").when(F.col("q") % 3 == 1, "owner").otherwise("").alias("prefix"),
    )
    return naming.assign_prefixed_names(fields)


@query(
    uses="rect rect_b",
    sql=f"""WITH h AS (SELECT a.form_id, a.page, a.rect_id, b.field_id || '_' || b.kind AS old_name FROM rect a JOIN rect_b b ON {PAIR} AND {IOU} >= CAST(0.3 AS DOUBLE)
  QUALIFY row_number() OVER (PARTITION BY a.form_id, a.page, a.rect_id ORDER BY {IOU} DESC, b.rect_id) = 1),
b AS (SELECT r.form_id, r.page, r.rect_id, r.x0, r.y0, coalesce(old_name, CASE WHEN r.kind = 'text' THEN r.field_id || '_' || r.kind ELSE r.field_id END) AS base, old_name IS NOT NULL AS reused
  FROM rect r LEFT JOIN h ON r.form_id = h.form_id AND r.page = h.page AND r.rect_id = h.rect_id),
u AS (SELECT *, row_number() OVER (PARTITION BY form_id, base ORDER BY page, y0, x0, rect_id) AS c FROM b)
SELECT form_id, page, rect_id, CASE WHEN c = 1 THEN base ELSE base || '_' || CAST(c AS VARCHAR) END AS field_name, reused FROM u""",
)
def reuse_names(t: Tables):
    section = F.when(F.col("kind") == "text", F.col("field_id"))
    label = F.when(F.col("kind") == "text", F.col("kind")).otherwise(F.col("field_id"))
    widgets = t.rect.withColumns({"section": section, "label": label})
    older = t.rect_b.withColumn("field_name", F.concat_ws("_", "field_id", "kind"))
    return naming.reuse_names(widgets, older)


@query(
    uses="rect",
    sql="""WITH w AS (SELECT form_id, 0 AS page, page * 1000000 + rect_id AS rect_id, round(x0 / 100) AS b0, y0, field_id || CASE WHEN q % 3 = 0 THEN '_row' || CAST(q AS VARCHAR) ELSE '' END AS nm FROM rect),
st AS (SELECT form_id, page, b0, regexp_extract(nm, '^(.+)_row\\d+(?:_\\d+)?$', 1) AS stem, count(*) AS n FROM w WHERE regexp_matches(nm, '^(.+)_row\\d+(?:_\\d+)?$') GROUP BY ALL),
m AS (SELECT form_id, page, b0, arg_min(stem, (-n, stem)) AS prefix FROM st GROUP BY ALL),
z AS (SELECT form_id, page, b0 FROM w GROUP BY ALL HAVING count(*) >= 3)
SELECT w.form_id, w.page, w.rect_id, prefix || '_row' || CAST(row_number() OVER (PARTITION BY w.form_id, w.page, w.b0 ORDER BY y0, w.rect_id) AS VARCHAR) AS field_name
FROM w JOIN m ON w.form_id = m.form_id AND w.page = m.page AND w.b0 = m.b0 SEMI JOIN z ON w.form_id = z.form_id AND w.page = z.page AND w.b0 = z.b0""",
)
def renumber_rows(t: Tables):
    # derived widgets seldom share both edges: fold columns onto a coarse grid
    col = F.rint(F.col("x0") / 100)
    name = F.concat("field_id", F.when(F.col("q") % 3 == 0, F.concat(F.lit("_row"), F.col("q").cast("string"))).otherwise(""))
    widgets = t.rect.select(
        "form_id", F.lit(0).alias("page"), (F.col("page") * F.lit(1000000).cast("bigint") + F.col("rect_id")).alias("rect_id"),
        col.alias("x0"), col.alias("x1"), "y0", name.alias("field_name"),
    )
    return naming.renumber_rows(widgets)


@query(
    uses="rect",
    sql="""SELECT form_id, page, rect_id, row_number() OVER (PARTITION BY form_id ORDER BY page, floor(y0 / 4), x0, rect_id) AS position FROM rect""",
)
def reading_order(t: Tables):
    return naming.reading_order(t.rect)


BANDS = """WITH o AS (SELECT *, max(y1) OVER (PARTITION BY form_id, page ORDER BY y0 RANGE BETWEEN UNBOUNDED PRECEDING AND 0.5 PRECEDING) AS reach FROM rect),
n AS (SELECT *, CASE WHEN y0 - reach <= 12 THEN 0 ELSE 1 END AS fresh FROM o),
d AS (SELECT form_id, page, y0, max(fresh) AS fresh FROM n GROUP BY ALL),
k AS (SELECT form_id, page, y0, CAST(sum(fresh) OVER (PARTITION BY form_id, page ORDER BY y0) AS BIGINT) AS band FROM d),
banded AS (SELECT r.form_id, r.page, r.rect_id, r.x0, r.y0, r.x1, r.y1, k.band FROM rect r JOIN k ON r.form_id = k.form_id AND r.page = k.page AND r.y0 = k.y0)"""


@query(uses="rect", sql=f"{BANDS} SELECT form_id, page, rect_id, band FROM banded")
def vertical_bands(t: Tables):
    return naming.vertical_bands(t.rect).select("form_id", "page", "rect_id", "band")


@query(
    uses="rect",
    sql=f"""{BANDS},
g AS (SELECT form_id, page, band, (x1 + nx) / 2 AS c FROM (SELECT *, lead(x0) OVER (PARTITION BY form_id, page, band, floor(y0 / 4) ORDER BY x0, rect_id) AS nx FROM banded) WHERE nx - x1 >= 25),
m AS (SELECT form_id, page, band, (list_sort(list(c)))[1 + count(*) // 2] AS gutter FROM g GROUP BY ALL),
j AS (SELECT b.*, gutter FROM banded b JOIN m ON b.form_id = m.form_id AND b.page = m.page AND b.band = m.band),
ok AS (SELECT form_id, page, band FROM j GROUP BY form_id, page, band, gutter HAVING NOT bool_or(x0 < gutter - 1 AND x1 > gutter + 1)
  AND (gutter - min(x0)) / greatest(max(x1) - min(x0), 1) BETWEEN 0.2 AND 0.8 AND bool_or(x1 <= gutter) AND bool_or(x0 >= gutter)),
s AS (SELECT j.form_id, j.page, rect_id, j.band, gutter, CASE WHEN x1 <= gutter THEN 'left' WHEN x0 >= gutter THEN 'right' END AS side
  FROM j SEMI JOIN ok ON j.form_id = ok.form_id AND j.page = ok.page AND j.band = ok.band)
SELECT * FROM s WHERE side IS NOT NULL""",
)
def band_columns(t: Tables):
    return naming.band_columns(t.rect)


def _nested_names(t: Tables):
    """Names of three depths per form, some gates of each kind."""
    name = F.regexp_replace("label", " ", "_")
    first = F.substring_index("label", " ", 1)
    make = lambda c: t.field.select("form_id", c.alias("field_id"))
    out = make(F.col("field_id")).unionByName(make(name))
    out = out.unionByName(t.field.where("size < 25").select("form_id", first.alias("field_id")))
    return out.unionByName(t.field.where("size >= 40").select("form_id", F.concat(first, F.lit("_enabler")).alias("field_id")))


NESTED = """WITH ids AS (SELECT DISTINCT form_id, field_id FROM (
  SELECT form_id, field_id FROM field UNION ALL SELECT form_id, replace(label, ' ', '_') FROM field
  UNION ALL SELECT form_id, string_split(label, ' ')[1] FROM field WHERE size < 25
  UNION ALL SELECT form_id, string_split(label, ' ')[1] || '_enabler' FROM field WHERE size >= 40)),
g AS (SELECT form_id, field_id AS gate, field_id AS prefix FROM ids UNION ALL SELECT form_id, field_id, regexp_replace(field_id, '_enabler$', '') FROM ids WHERE ends_with(field_id, '_enabler')),
p AS (SELECT g.form_id, gate, c.field_id AS child FROM g JOIN ids c ON g.form_id = c.form_id AND starts_with(c.field_id, g.prefix || '_') AND NOT ends_with(c.field_id, '_enabler') AND gate <> c.field_id),
cand AS (SELECT *, count(*) OVER (PARTITION BY form_id, gate) AS n FROM p)"""


@query(uses="field", sql=f"{NESTED} SELECT form_id, gate, child FROM cand WHERE n >= 2")
def section_candidates(t: Tables):
    return naming.section_candidates(_nested_names(t).distinct())


@query()
def conditional_sections(t: Tables):
    return naming.conditional_sections(_nested_names(t))


@query(
    uses="rule word",
    sql=f"""WITH o AS (SELECT *, lag(y1) OVER w AS py, lag(x0) OVER w AS px0, lag(x1) OVER w AS px1 FROM rule WINDOW w AS (PARTITION BY form_id, page ORDER BY y0, x0, rule_id)),
g AS (SELECT *, sum(CASE WHEN y0 - py > 0 AND y0 - py < 30 AND least(x1, px1) - greatest(x0, px0) > 50 THEN 0 ELSE 1 END) OVER (PARTITION BY form_id, page ORDER BY y0, x0, rule_id) AS block FROM o),
b AS (SELECT form_id, page, CAST(block AS BIGINT) AS block, count(*) AS n_rules, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM g
  GROUP BY form_id, page, block HAVING count(*) >= 2 AND max(y1) - min(y0) <= 80)
SELECT a.* FROM b a WHERE EXISTS (SELECT 1 FROM word b WHERE {PAIR} AND contains(b.text, 'ring') AND abs(b.y1 - a.y0) < 40 AND b.x0 < a.x1 AND b.x1 > a.x0)""",
)
def stacked_blocks(t: Tables):
    return naming.stacked_blocks(t.rule, t.word.where("text LIKE '%ring%'"))
