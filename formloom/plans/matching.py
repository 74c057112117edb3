"""Detector matching, ordered picks, diffs and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.operators import diffs, greedy
from formloom.plans.joins import IOU, PAIR
from formloom.plans.registry import query
from formloom.sources.testdata import Tables

CANDIDATES = f"""SELECT a.form_id, a.page, a.rect_id AS a_id, b.rect_id AS b_id, {IOU} AS iou,
  sqrt(((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2) ** 2 + ((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2) ** 2) AS d
FROM rect a JOIN rect_b b ON {PAIR} WHERE {IOU} >= CAST(%s AS DOUBLE)"""


@query(
    uses="rect rect_b",
    sql=f"""WITH c AS ({CANDIDATES % 0.3}) SELECT form_id, page, a_id, b_id, round(iou, 6) AS iou,
  row_number() OVER (PARTITION BY form_id, page, a_id ORDER BY iou DESC, a_id, b_id) = 1
  AND row_number() OVER (PARTITION BY form_id, page, b_id ORDER BY iou DESC, a_id, b_id) = 1 AS chosen FROM c""",
)
def iou_candidates(t: Tables):
    """Candidate pairs with the mutual-best ones marked."""
    pairs = greedy.mutual_best(greedy.candidate_matches(t.rect, t.rect_b, 0.3))
    return pairs.select("form_id", "page", "a_id", "b_id", F.round("iou", 6).alias("iou"), "chosen")


@query()
def iou_match(t: Tables):
    return greedy.iou_match(t.rect, t.rect_b, 0.3)


@query()
def precision_recall(t: Tables):
    matches = greedy.iou_matches(t.rect, t.rect_b, (0.3, 0.5))
    return greedy.precision_recall(t.rect, t.rect_b, matches)


@query()
def match_stats(t: Tables):
    return greedy.match_stats(t.rect, t.rect_b, greedy.iou_match(t.rect, t.rect_b, 0.3))


@query(
    uses="rect rect_b",
    sql=f"""WITH s1 AS (SELECT DISTINCT form_id, page, a_id FROM ({CANDIDATES % 0.3})), s2 AS (SELECT DISTINCT form_id, page, a_id FROM ({CANDIDATES % 0.7})),
r AS (SELECT form_id, page, rect_id, CASE WHEN s1.a_id IS NOT NULL AND s2.a_id IS NULL THEN 'lost_in_second' WHEN s1.a_id IS NULL AND s2.a_id IS NULL THEN 'never_matched' END AS reason
  FROM rect LEFT JOIN s1 ON rect.form_id = s1.form_id AND rect.page = s1.page AND rect_id = s1.a_id
  LEFT JOIN s2 ON rect.form_id = s2.form_id AND rect.page = s2.page AND rect_id = s2.a_id)
SELECT rect_id, form_id, page, reason FROM r WHERE reason IS NOT NULL""".replace("SELECT form_id, page, rect_id, CASE", "SELECT rect.form_id, rect.page, rect_id, CASE"),
)
def dropped_truth(t: Tables):
    loose = greedy.candidate_matches(t.rect, t.rect_b, 0.3)
    strict = greedy.candidate_matches(t.rect, t.rect_b, 0.7)
    return greedy.dropped_truth(t.rect, loose, strict)


@query()
def nms(t: Tables):
    both = t.rect.withColumn("source_rank", F.lit(0)).select("form_id", "page", "rect_id", "x0", "y0", "x1", "y1", "source_rank")
    second = t.rect_b.select("form_id", "page", (F.col("rect_id") + 1000000).alias("rect_id"), "x0", "y0", "x1", "y1", F.lit(1).alias("source_rank"))
    return greedy.nms(both.unionByName(second))


@query()
def dedupe_fields(t: Tables):
    first = t.rect.select("form_id", "page", "rect_id", "x0", "y0", "x1", "y1", ((F.col("q") % 10) / 10).alias("confidence"))
    second = t.rect_b.select("form_id", "page", (F.col("rect_id") + 1000000).alias("rect_id"), "x0", "y0", "x1", "y1", F.lit(0.55).alias("confidence"))
    return greedy.dedupe_fields(first.unionByName(second))


@query()
def radio_groups(t: Tables):
    return greedy.radio_groups(t.box)


@query(
    uses="box",
    sql="""WITH m AS (SELECT *, CAST(floor(y0 / 60) AS BIGINT) AS leader_id FROM box),
g AS (SELECT form_id, page, leader_id, count(*) AS n, string_agg(lower(label), ' ' ORDER BY y0, x0, box_id) AS joined,
  bool_or(contains(lower(label), 'yes')) AND bool_or(contains(lower(label), 'no')) AS yes_no,
  bool_and(length(label) < 30) AND count(*) FILTER (label <> '') >= 2 AND count(*) <= 3 AS short FROM m GROUP BY ALL HAVING count(*) BETWEEN 2 AND 5)
SELECT m.form_id, m.page, m.leader_id, box_id, left(replace(trim(lower(label)), ' ', '_'), 32) AS group_option FROM m JOIN g
  ON m.form_id = g.form_id AND m.page = g.page AND m.leader_id = g.leader_id
WHERE yes_no OR short OR regexp_matches(joined, 'yes|no|male|female|formal|informal|petitioner|respondent|check one|select one')""",
)
def promote_groups(t: Tables):
    """The promotion test on given groups (boxes of one 60-point band)."""
    members = t.box.select("form_id", "page", "box_id", F.floor(F.col("y0") / 60).cast("bigint").alias("leader_id"))
    return greedy.promote_groups(members, t.box)


def _group_members(t: Tables):
    return t.box.withColumnRenamed("label", "group_id").withColumn("group_option", F.concat(F.lit("o"), (F.col("box_id") % 4).cast("string")))


COMPONENTS = """WITH RECURSIVE p AS (SELECT form_id, label AS group_id, page, box_id, (x0 + x1) / 2 AS cx, page_y + (y0 + y1) / 2 AS cy, page_y + y0 AS global_y, x0, y0, x1, y1
  FROM box JOIN (SELECT form_id AS f, page AS g, coalesce(sum(height) OVER (PARTITION BY form_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS page_y FROM page) o
  ON form_id = f AND page = g),
n AS (SELECT *, row_number() OVER (ORDER BY form_id, group_id, page, box_id) AS id FROM p),
e AS (SELECT a.id AS u, b.id AS v FROM n a JOIN n b ON a.form_id = b.form_id AND a.group_id = b.group_id AND a.id <> b.id
  AND sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2) < 300),
r AS (SELECT id AS u, id AS v FROM n UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u, min(v) AS root FROM r GROUP BY u),
comp AS (SELECT n.form_id, n.group_id, n.page, n.box_id, n.global_y, k.page AS root_page, k.box_id AS root_box, n.x0, n.y0, n.x1, n.y1
  FROM n JOIN c ON n.id = c.u JOIN n k ON c.root = k.id)"""


@query(uses="box page", sql=COMPONENTS + " SELECT form_id, group_id, page, box_id, global_y, root_page, root_box FROM comp")
def proximity_components(t: Tables):
    return greedy.proximity_components(_group_members(t), t.page)


@query(
    uses="box page",
    sql=COMPONENTS
    + """, tops AS (SELECT form_id, group_id, root_page, root_box, min(global_y) AS top FROM comp GROUP BY ALL),
num AS (SELECT *, row_number() OVER (PARTITION BY form_id, group_id ORDER BY top, root_page, root_box) AS k, count(*) OVER (PARTITION BY form_id, group_id) AS ng FROM tops),
best AS (SELECT form_id, group_id, root_page, root_box, 'o' || CAST(box_id % 4 AS VARCHAR) AS group_option, page, box_id FROM comp
  QUALIFY row_number() OVER (PARTITION BY form_id, group_id, root_page, root_box, box_id % 4 ORDER BY (x1 - x0) * (y1 - y0), page, box_id) = 1),
sized AS (SELECT *, count(*) OVER (PARTITION BY form_id, group_id, root_page, root_box) AS no FROM best)
SELECT s.form_id, CASE WHEN ng = 1 THEN s.group_id ELSE s.group_id || '_' || CAST(k AS VARCHAR) END AS group_name, group_option, page, box_id
FROM sized s JOIN num ON s.form_id = num.form_id AND s.group_id = num.group_id AND s.root_page = num.root_page AND s.root_box = num.root_box WHERE no >= 2""",
)
def split_groups(t: Tables):
    members = _group_members(t)
    return greedy.split_groups(greedy.proximity_components(members, t.page), members)


@query(
    uses="rule",
    sql="""WITH h AS (SELECT form_id, page, list_sort(list(DISTINCT y0)) AS ys FROM rule GROUP BY ALL),
f AS (SELECT form_id, page, ys, list_reduce(list_transform(ys, lambda y: [y]), lambda acc, y: list_append(acc, CASE WHEN y[1] - acc[-1] <= 2 THEN acc[-1] ELSE y[1] END)) AS tops FROM h)
SELECT form_id, page, unnest(ys) AS y0, unnest(tops) AS row_y FROM f""",
)
def row_groups(t: Tables):
    return greedy.row_leaders(t.rule)


@query()
def drawn_tables(t: Tables):
    # derived rules of a page seldom repeat a signature: fold x onto a coarse grid
    coarse = t.rule.select(
        "form_id", "page", "rule_id", (F.floor(F.col("x0") / 300) * 300).alias("x0"), "y0",
        (F.floor(F.col("x0") / 300) * 300 + 200).alias("x1"), "y1",
    )
    return greedy.drawn_tables(coarse)


@query(
    uses="rect rect_b",
    sql=f"""SELECT form_id, page, rect_id, x0, y0, x1, y1, 'base' AS source FROM rect_b
UNION ALL SELECT form_id, page, rect_id, x0, y0, x1, y1, 'extra' FROM rect a WHERE NOT EXISTS (SELECT 1 FROM rect_b b WHERE {PAIR} AND {IOU} >= CAST(0.3 AS DOUBLE))""",
)
def add_unmatched(t: Tables):
    return diffs.add_unmatched(t.rect_b, t.rect)


@query(
    uses="rect rect_b",
    sql="""SELECT 'lines' AS detector, form_id, page, rect_id, x0, y0, x1, y1 FROM rect
UNION ALL SELECT 'model', form_id, page, rect_id, x0, y0, x1, y1 FROM rect_b""",
)
def union_detectors(t: Tables):
    cols = ["form_id", "page", "rect_id", "x0", "y0", "x1", "y1"]
    return diffs.union_detectors(lines=t.rect.select(cols), model=t.rect_b.select(cols))


@query(
    uses="snap_a snap_b",
    sql="""SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'only_a' WHEN a.id IS NULL THEN 'only_b' ELSE 'both' END AS side
FROM snap_a a FULL JOIN snap_b b ON a.id = b.id""",
)
def key_sets(t: Tables):
    return diffs.key_sets(t.snap_a, t.snap_b, ["id"])


@query(
    uses="rect rect_b",
    sql="""WITH a AS (SELECT form_id, page, round(x0, 1) AS px, round(y0, 1) AS py, arg_max(field_id, rect_id) AS v FROM rect GROUP BY ALL),
b AS (SELECT form_id, page, round(x0, 1) AS px, round(y0, 1) AS py, arg_max(field_id || kind, rect_id) AS v FROM rect_b GROUP BY ALL),
j AS (SELECT coalesce(a.form_id, b.form_id) AS form_id, coalesce(a.page, b.page) AS page, coalesce(a.px, b.px) AS px, coalesce(a.py, b.py) AS py,
  a.v AS value_a, b.v AS value_b, CASE WHEN b.px IS NULL THEN 'only_a' WHEN a.px IS NULL THEN 'only_b' WHEN a.v IS DISTINCT FROM b.v THEN 'changed' END AS status
  FROM a FULL JOIN b ON a.form_id = b.form_id AND a.page = b.page AND a.px = b.px AND a.py = b.py)
SELECT * FROM j WHERE status IS NOT NULL""",
)
def diff_by_position(t: Tables):
    other = t.rect_b.withColumn("field_id", F.concat("field_id", "kind"))
    return diffs.diff_by_position(t.rect, other, "field_id")


@query(
    uses="rect rect_b",
    sql=f"""WITH e AS (SELECT form_id, page, rect_id, x0, y0, x1, y1 FROM rect_b UNION ALL SELECT form_id, page, box_id + 5000, x0, y0, x1, y1 FROM
  (SELECT form_id, page, rect_id AS box_id, x0, y0, x1, y1 FROM rect WHERE kind = 'choice')),
j AS (SELECT coalesce(a.form_id, b.form_id) AS form_id, coalesce(a.page, b.page) AS page, coalesce(a.rect_id, b.rect_id) AS rect_id,
  CASE WHEN a.rect_id IS NULL THEN 'added' WHEN b.rect_id IS NULL THEN 'removed'
    WHEN greatest(abs(b.x0 - a.x0), abs(b.y0 - a.y0), abs(b.x1 - a.x1), abs(b.y1 - a.y1)) > 0.5 THEN 'moved' END AS action,
  round(b.x0 - a.x0, 1) AS d_x0, round(b.y0 - a.y0, 1) AS d_y0, round(b.x1 - a.x1, 1) AS d_x1, round(b.y1 - a.y1, 1) AS d_y1,
  CASE WHEN a.rect_id IS NOT NULL AND b.rect_id IS NOT NULL THEN round({IOU}, 6) END AS iou
  FROM rect a FULL JOIN e b ON a.form_id = b.form_id AND a.page = b.page AND a.rect_id = b.rect_id)
SELECT * FROM j WHERE action IS NOT NULL""",
)
def edit_geometry_diff(t: Tables):
    cols = ["form_id", "page", "rect_id", "x0", "y0", "x1", "y1"]
    added = t.rect.where("kind = 'choice'").withColumn("rect_id", F.col("rect_id") + 5000)
    edited = t.rect_b.select(cols).unionByName(added.select(cols))
    return diffs.edit_geometry_diff(t.rect, edited, ["form_id", "page", "rect_id"])


GOLD = """WITH p AS (SELECT form_id, seq, data_type AS v FROM field WHERE data_type <> 'text'),
g AS (SELECT form_id, seq, CASE WHEN size > 40 THEN 'currency' ELSE data_type END AS v FROM field WHERE category <> 'identity'),
c AS (SELECT coalesce(p.form_id, g.form_id) AS form_id, coalesce(p.seq, g.seq) AS seq, p.v AS predicted, g.v AS gold,
  CASE WHEN p.seq IS NULL THEN 'missing' WHEN g.seq IS NULL THEN 'extra' WHEN p.v = g.v THEN 'match' ELSE 'mismatch' END AS verdict
  FROM p FULL JOIN g ON p.form_id = g.form_id AND p.seq = g.seq)"""


def _gold(t: Tables):
    predicted = t.field.where("data_type <> 'text'").select("form_id", "seq", F.col("data_type").alias("v"))
    gold = t.field.where("category <> 'identity'").select(
        "form_id", "seq", F.when(F.col("size") > 40, "currency").otherwise(F.col("data_type")).alias("v")
    )
    return diffs.compare_keyed(predicted, gold, ["form_id", "seq"], "v")


@query(uses="field", sql=f"{GOLD} SELECT * FROM c")
def gold_compare(t: Tables):
    return _gold(t)


@query(
    uses="field",
    sql=f"""{GOLD}, k AS (SELECT form_id, count(*) FILTER (verdict = 'match') AS n_match, count(*) FILTER (verdict = 'mismatch') AS n_mismatch,
  count(*) FILTER (verdict = 'missing') AS n_missing, count(*) FILTER (verdict = 'extra') AS n_extra FROM c GROUP BY form_id)
SELECT *, round((n_match + n_mismatch) / (n_match + n_mismatch + n_missing), 6) AS coverage, round(n_match / (n_match + n_mismatch + n_missing), 6) AS accuracy FROM k""",
)
def gold_coverage(t: Tables):
    return diffs.coverage_of(_gold(t), ["form_id"])


@query(
    uses="rect rect_b",
    sql="""WITH o AS (SELECT form_id, page, rect_id, x0, y0, x1, y1 FROM rect_b WHERE kind = 'choice'
  UNION ALL SELECT form_id, page, rect_id + 9000, x0, y0, x1, y1 FROM rect_b WHERE kind = 'date')
SELECT coalesce(w.form_id, o.form_id) AS form_id, coalesce(w.page, o.page) AS page, coalesce(w.rect_id, o.rect_id) AS rect_id,
  CASE WHEN w.rect_id IS NULL THEN 'unmatched' WHEN o.rect_id IS NOT NULL THEN 'overridden' ELSE 'kept' END AS status,
  coalesce(o.x0, w.x0) AS x0, coalesce(o.y0, w.y0) AS y0, coalesce(o.x1, w.x1) AS x1, coalesce(o.y1, w.y1) AS y1,
  CASE WHEN o.rect_id IS NOT NULL THEN w.x0 END AS old_x0, CASE WHEN o.rect_id IS NOT NULL THEN w.y0 END AS old_y0,
  CASE WHEN o.rect_id IS NOT NULL THEN w.x1 END AS old_x1, CASE WHEN o.rect_id IS NOT NULL THEN w.y1 END AS old_y1
FROM rect w FULL JOIN o ON w.form_id = o.form_id AND w.page = o.page AND w.rect_id = o.rect_id""",
)
def apply_overrides(t: Tables):
    cols = ["form_id", "page", "rect_id", "x0", "y0", "x1", "y1"]
    stray = t.rect_b.where("kind = 'date'").withColumn("rect_id", F.col("rect_id") + 9000)
    overrides = t.rect_b.where("kind = 'choice'").select(cols).unionByName(stray.select(cols))
    return diffs.apply_overrides(t.rect, overrides, ["form_id", "page", "rect_id"])


@query(
    uses="rect",
    sql="""WITH t AS (SELECT form_id, page, rect_id, 1 + rect_id % 3 AS ref_id, CASE rect_id % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'y' ELSE 'both' END AS axis, x0, y0, x1, y1 FROM rect),
n AS (SELECT t.form_id, t.page, t.rect_id, CASE WHEN axis IN ('x', 'both') THEN r.x0 ELSE t.x0 END AS x0, CASE WHEN axis IN ('y', 'both') THEN r.y0 ELSE t.y0 END AS y0,
  t.x1 - t.x0 AS w, t.y1 - t.y0 AS h FROM t JOIN rect r ON t.form_id = r.form_id AND t.page = r.page AND t.ref_id = r.rect_id)
SELECT form_id, page, rect_id, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM n""",
)
def align_to_reference(t: Tables):
    targets = t.rect.select(
        "form_id", "page", "rect_id", (1 + F.col("rect_id") % 3).alias("ref_id"),
        F.expr("CASE rect_id % 3 WHEN 0 THEN 'x' WHEN 1 THEN 'y' ELSE 'both' END").alias("axis"),
    )
    return diffs.align_to_reference(t.rect, targets)


@query(
    uses="snap_a snap_b",
    sql="SELECT * FROM snap_b UNION ALL SELECT * FROM snap_a WHERE id NOT IN (SELECT id FROM snap_b)",
)
def merge_snapshot(t: Tables):
    return diffs.merge_snapshot(t.snap_a, t.snap_b, ["id"])


@query(
    uses="snap_a snap_b",
    sql="""SELECT id, url, digest, size, false AS added FROM snap_a UNION ALL SELECT id, url, digest, size, true FROM snap_b WHERE id NOT IN (SELECT id FROM snap_a)""",
)
def insert_missing(t: Tables):
    return diffs.insert_missing(t.snap_a, t.snap_b, ["id"])


@query(
    uses="snap_a snap_b",
    sql="""SELECT count(*) FILTER (id NOT IN (SELECT id FROM snap_a)) AS added, count(*) FILTER (id IN (SELECT id FROM snap_a)) AS skipped FROM snap_b""",
)
def insert_counts(t: Tables):
    return diffs.insert_counts(t.snap_a, t.snap_b, ["id"])


@query(uses="snap_a snap_b", sql="SELECT * FROM snap_a WHERE id NOT IN (SELECT id FROM snap_b)")
def pending_work(t: Tables):
    return diffs.pending_work(t.snap_a, t.snap_b, ["id"])


@query(
    uses="snap_a snap_b",
    sql="""SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'GONE' WHEN a.id IS NULL THEN 'NEW' WHEN a.size <> b.size OR a.digest <> b.digest THEN 'CHANGED' ELSE 'SAME' END AS status
FROM snap_a a FULL JOIN snap_b b ON a.id = b.id""",
)
def snapshot_drift(t: Tables):
    return diffs.snapshot_drift(t.snap_a, t.snap_b)


@query(
    uses="answer field",
    sql="""SELECT DISTINCT form_id, field_id FROM answer WHERE value = '' AND (form_id, field_id) NOT IN (SELECT (form_id, field_id) FROM answer WHERE value = 'O')""",
)
def gaps_within_baseline(t: Tables):
    gaps = t.answer.where("value = ''")
    known = t.answer.where("value = 'O'").select("form_id", "field_id").distinct()
    return diffs.gaps_within_baseline(gaps, known, ["form_id", "field_id"])


@query(
    uses="issue",
    sql="""WITH c AS (SELECT form_id, code, count(*) AS n FROM issue WHERE variant = 1 GROUP BY ALL),
b AS (SELECT form_id, code, count(*) AS n FROM issue WHERE variant = 0 GROUP BY ALL)
SELECT c.form_id, c.code, c.n, coalesce(b.n, 0) AS allowed FROM c LEFT JOIN b ON c.form_id = b.form_id AND c.code = b.code WHERE c.n > coalesce(b.n, 0)""",
)
def baseline_regressions(t: Tables):
    counts = lambda v: t.issue.where(F.col("variant") == v).groupBy("form_id", "code").agg(F.count("*").alias("n"))
    return diffs.baseline_regressions(counts(1), counts(0), ["form_id", "code"])
