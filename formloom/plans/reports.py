"""Catalogues, roll-ups, votes and evaluations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.functions import text as X
from formloom.operators import reports
from formloom.plans.layout import CELLS, HEADER
from formloom.plans.registry import query
from formloom.sources.testdata import Tables


@query(
    uses="rect",
    sql="SELECT form_id, page, rect_id, field_id, kind, round(x0, 1) AS x0, round(y0, 1) AS y0, round(x1, 1) AS x1, round(y1, 1) AS y1 FROM rect",
)
def field_catalog(t: Tables):
    return reports.field_catalog(t.rect)


INDEX = r"""SELECT regexp_replace(field_id, '_\d+$', '') AS base, count(DISTINCT form_id) AS n_forms, string_agg(DISTINCT form_id, ',' ORDER BY form_id) AS forms FROM field GROUP BY 1"""


def _more_forms(t: Tables):
    """Fields of forms that grow in number with the table."""
    return t.field.withColumn("form_id", F.concat_ws("-", "form_id", F.expr("seq DIV 40").cast("string")))


FORMS = r"""WITH n AS (SELECT DISTINCT regexp_replace(field_id, '_\d+$', '') AS base, form_id || '-' || CAST(seq // 40 AS VARCHAR) AS form_id, field_id FROM field),
u AS (SELECT base, form_id, count(*) AS n_names FROM n GROUP BY ALL), r AS (SELECT base, count(*) AS n_forms, CAST(sum(n_names) AS BIGINT) AS n_names FROM u GROUP BY base)"""


@query(uses="field", sql=f"{FORMS} SELECT * FROM u")
def name_uses(t: Tables):
    return reports.name_uses(_more_forms(t))


@query(uses="field", sql=f"{FORMS} SELECT * FROM r")
def name_reach(t: Tables):
    return reports.name_reach(_more_forms(t))


@query(uses="field", sql=f"{FORMS} SELECT n.* FROM n JOIN r ON n.base = r.base WHERE n_forms > 1")
def cross_form_names(t: Tables):
    return reports.cross_form_names(_more_forms(t))


@query(uses="field", sql=INDEX)
def field_name_index(t: Tables):
    return reports.field_name_index(t.field)


@query(
    uses="field",
    sql=r"""WITH b AS (SELECT regexp_replace(field_id, '_\d+$', '') AS base, form_id, string_agg(DISTINCT field_id, ',' ORDER BY field_id) AS names FROM field GROUP BY ALL)
SELECT base, form_id, names FROM b""",
)
def cross_form_map(t: Tables):
    packed = reports.cross_form_map(t.field)
    return packed.select("base", F.explode("forms").alias("form_id", "names"))


@query(
    uses="field",
    sql="""WITH c AS (SELECT data_type, category, CASE WHEN size >= 45 THEN 'high' WHEN size >= 35 THEN 'medium' ELSE 'low' END AS band, size % 5 <> 0 AS lab FROM field),
u AS (SELECT 'all' AS scope, NULL AS value, lab FROM c UNION ALL SELECT 'type', data_type, lab FROM c UNION ALL SELECT 'category', category, lab FROM c UNION ALL SELECT 'confidence', band, lab FROM c)
SELECT scope, value, count(*) AS total, count(*) FILTER (lab) AS labelled, round(count(*) FILTER (lab) * 100 / count(*), 1) AS pct FROM u GROUP BY ALL""",
)
def quality_report(t: Tables):
    catalog = t.field.select(
        F.col("data_type").alias("field_type"), "category", (F.col("size") / 50).alias("confidence"),
        F.when(F.col("size") % 5 == 0, " ").otherwise(F.col("label")).alias("label"),
    )
    return reports.quality_report(catalog)


@query(uses="field", sql=f"SELECT base, n_forms FROM ({INDEX}) WHERE n_forms >= 3")
def reused_names(t: Tables):
    return reports.reused_names(t.field)


@query(uses="field", sql="SELECT form_id, count(*) AS n FROM field GROUP BY form_id ORDER BY n DESC, form_id LIMIT 10")
def top_forms_by_fields(t: Tables):
    return reports.top_forms_by_fields(t.field)


@query(
    uses="rect",
    sql="""WITH c AS (SELECT CASE WHEN regexp_matches(field_id, '[01]$') THEN 'court_or_sig' WHEN regexp_matches(field_id, '2$') THEN 'likely_static' ELSE 'blank' END AS category,
  x1 - x0 AS w, y1 - y0 AS h FROM rect),
d AS (SELECT category, CASE WHEN category <> 'blank' THEN 'leave_unmapped' WHEN w < 18 AND h < 18 THEN 'review_marker' ELSE 'candidate_input' END AS hint FROM c)
SELECT category, hint, count(*) AS n FROM d GROUP BY ROLLUP (category, hint)""",
)
def coverage_rollup(t: Tables):
    return reports.coverage_rollup(t.rect, court="[01]$", static="2$")


COUNTS = """SELECT form_id, variant, count(*) FILTER (code = 'alignment') AS alignment, count(*) FILTER (code = 'naming') AS naming,
  count(*) FILTER (code = 'missing') AS missing, count(*) FILTER (code IN ('alignment', 'naming', 'missing')) AS total FROM issue GROUP BY ALL"""


@query(uses="issue", sql=COUNTS)
def issue_counts(t: Tables):
    return reports.issue_counts(t.issue)


WINNERS = f"""WITH c AS ({COUNTS}), f AS (SELECT form_id, count(*) AS n_issues, count(DISTINCT severity) AS n_severities FROM issue GROUP BY form_id),
w AS (SELECT a.form_id, a.total AS base, b.total AS fused, b.total - a.total AS delta, CASE WHEN b.total - a.total <= -5 THEN 'fused' WHEN b.total - a.total >= 5 THEN 'base' ELSE 'wash' END AS bucket
  FROM c a JOIN c b ON a.form_id = b.form_id AND a.variant = 0 AND b.variant = 1)"""


def _winners(t: Tables):
    features = t.issue.groupBy("form_id").agg(F.count("*").alias("n_issues"), F.count_distinct("severity").alias("n_severities"))
    return reports.winner_table(reports.issue_counts(t.issue), features)


@query(uses="issue", sql=f"{WINNERS} SELECT w.*, n_issues, n_severities FROM w JOIN f ON w.form_id = f.form_id")
def winner_table(t: Tables):
    return _winners(t)


@query(
    uses="issue",
    sql=f"""{WINNERS} SELECT bucket, count(*) AS n, round(avg(n_issues), 6) AS mean_n_issues, round(avg(n_severities), 6) AS mean_n_severities
FROM w JOIN f ON w.form_id = f.form_id GROUP BY bucket""",
)
def bucket_means(t: Tables):
    return reports.bucket_means(_winners(t), ["n_issues", "n_severities"])


EVALS = """WITH e AS (SELECT form_id, CASE variant WHEN 0 THEN 'a' ELSE 'b' END AS model, CASE event_id % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' WHEN 2 THEN 'edge_case' ELSE 'sparse' END AS complexity,
  CASE WHEN code = 'naming' THEN 1 ELSE 0 END AS wrong, CASE WHEN severity = 'high' THEN 1 ELSE 0 END AS oc FROM issue)"""


def _evals(t: Tables):
    return t.issue.select(
        "form_id",
        F.when(F.col("variant") == 0, "a").otherwise("b").alias("model"),
        F.expr("CASE event_id % 4 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' WHEN 2 THEN 'edge_case' ELSE 'sparse' END").alias("complexity"),
        (F.col("code") == "naming").cast("bigint").alias("wrong"),
        (F.col("severity") == "high").cast("bigint").alias("overconfident"),
    )


@query(
    uses="issue",
    sql=f"""{EVALS}, s AS (SELECT form_id, coalesce(sum(wrong) FILTER (model = 'a'), 0)::BIGINT AS wrong_a, coalesce(sum(oc) FILTER (model = 'a'), 0)::BIGINT AS overconfident_a,
  coalesce(sum(wrong) FILTER (model = 'b'), 0)::BIGINT AS wrong_b, coalesce(sum(oc) FILTER (model = 'b'), 0)::BIGINT AS overconfident_b,
  count(*) FILTER (model = 'a') AS n_a, count(*) FILTER (model = 'b') AS n_b FROM e GROUP BY form_id)
SELECT *, CASE WHEN n_a = 0 OR n_b = 0 THEN 'partial' WHEN abs(wrong_a + 0.5 * overconfident_a - wrong_b - 0.5 * overconfident_b) < 0.6 THEN 'tie'
  WHEN wrong_b + 0.5 * overconfident_b < wrong_a + 0.5 * overconfident_a THEN 'b' ELSE 'a' END AS verdict FROM s""",
)
def compare_models(t: Tables):
    return reports.compare_models(_evals(t))


@query(
    uses="issue",
    sql=f"""{EVALS} SELECT complexity, model, count(*) AS n, sum(wrong)::BIGINT AS wrong, sum(oc)::BIGINT AS overconfident FROM e
WHERE form_id IN (SELECT form_id FROM e GROUP BY form_id HAVING count(DISTINCT model) = 2) GROUP BY ALL""",
)
def compare_models_by_band(t: Tables):
    return reports.compare_models_by_band(_evals(t))


@query(
    uses="word rule vrule rect",
    sql=f"""{CELLS}, w AS (SELECT form_id, count(DISTINCT page) AS n_pages, count(DISTINCT round(x0)) AS n_indents, bool_or(contains(text, '$')) AS has_symbols,
  count(*) FILTER ({HEADER}) AS n_banners FROM word GROUP BY form_id),
c AS (SELECT form_id, count(*) AS n FROM cells GROUP BY form_id),
f AS (SELECT form_id, round(avg(CASE WHEN regexp_matches(field_id, '^[a-z][a-z0-9_]*$') THEN 1 ELSE 0 END), 6) AS clean_share FROM rect GROUP BY form_id)
SELECT w.form_id, n_pages, n_indents, has_symbols, n_banners, clean_share, coalesce(c.n, 0) AS n_cells FROM w LEFT JOIN c ON w.form_id = c.form_id LEFT JOIN f ON w.form_id = f.form_id""",
)
def page_features(t: Tables):
    from formloom.operators.detect import cells_from_line_grid

    return reports.page_features(t.word, cells_from_line_grid(t.rule, t.vrule), t.rect, X.is_section_header(F.col("text")), r"\$")


FAMILIES = {"red_ring_1": "ring", "red_ring_2": "ring", "blue_ring_1": "ring", "small_ring_3": "small", "small_ring_4": "small"}


@query(
    uses="field",
    sql="""WITH n AS (SELECT form_id, CASE WHEN size % 11 = 0 THEN 'X-' || field_id ELSE field_id END AS field_id FROM field),
fam AS (SELECT DISTINCT form_id, field_id, CASE WHEN field_id IN ('red_ring_1', 'red_ring_2', 'blue_ring_1') THEN 'ring' WHEN field_id IN ('small_ring_3', 'small_ring_4') THEN 'small' END AS family FROM n),
pn AS (SELECT family, field_id, count(*) AS n FROM fam WHERE family IS NOT NULL GROUP BY ALL)
SELECT 'not_snake_case' AS problem, form_id, field_id, count(*) AS n FROM n WHERE NOT regexp_matches(field_id, '^[a-z][a-z0-9_]*$') GROUP BY ALL
UNION ALL SELECT 'duplicate', form_id, field_id, count(*) FROM n GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'mixed_family', family, field_id, n FROM pn WHERE family IN (SELECT family FROM pn GROUP BY family HAVING count(*) > 1)""",
)
def name_audit(t: Tables):
    renamed = t.field.withColumn("field_id", F.when(F.col("size") % 11 == 0, F.concat(F.lit("X-"), "field_id")).otherwise(F.col("field_id")))
    return reports.name_audit(renamed, FAMILIES)


@query(
    uses="box",
    sql="""SELECT label AS group_id, count(*) AS n, count(DISTINCT form_id) AS n_forms, string_agg(DISTINCT CAST(page AS VARCHAR), ',' ORDER BY CAST(page AS VARCHAR)) AS pages,
  string_agg(DISTINCT 'o' || CAST(box_id % 4 AS VARCHAR), ',' ORDER BY 'o' || CAST(box_id % 4 AS VARCHAR)) AS options FROM box GROUP BY label""",
)
def group_summary(t: Tables):
    option = F.concat(F.lit("o"), (F.col("box_id") % 4).cast("string"))
    return reports.group_summary(t.box.withColumnRenamed("label", "group_id").withColumn("group_option", option))


@query(
    uses="field",
    sql="""WITH b AS (SELECT form_id, category AS candidate, CASE WHEN size % 3 = 0 THEN 'choice' ELSE 'text' END AS wt, data_type FROM field),
c AS (SELECT form_id, candidate, count(*) FILTER ((wt = 'choice') <> (data_type IN ('choice', 'boolean'))) AS n_wrong, count(*) AS n FROM b GROUP BY ALL)
SELECT form_id, candidate, n_wrong, n FROM c QUALIFY row_number() OVER (PARTITION BY form_id ORDER BY n_wrong, length(candidate), candidate) = 1""",
)
def type_fit(t: Tables):
    bindings = t.field.select(
        "form_id", F.col("category").alias("candidate"), F.when(F.col("size") % 3 == 0, "choice").otherwise("text").alias("widget_type"),
        F.col("data_type").alias("field_type"),
    )
    return reports.type_fit(bindings)


@query(
    uses="vote",
    sql="SELECT key, voter, arg_max(verdict, (ts, event_id)) AS verdict, max(event_id) FILTER (ts = m) AS event_id FROM (SELECT *, max(ts) OVER (PARTITION BY key, voter) AS m FROM vote) GROUP BY key, voter",
)
def latest_by_key(t: Tables):
    return reports.latest_by_key(t.vote, ["key", "voter"], ["ts", "event_id"]).select("key", "voter", "verdict", "event_id")


CONSENSUS = """WITH l AS (SELECT key, voter, arg_max(verdict, (ts, event_id)) AS verdict FROM vote GROUP BY ALL),
c AS (SELECT key, count(*) FILTER (verdict = 'major') AS n_major, count(*) FILTER (verdict = 'minor') AS n_minor FROM l GROUP BY key),
cons AS (SELECT *, CASE WHEN n_major >= 2 THEN 'confirmed' WHEN n_major = 1 OR n_minor >= 2 THEN 'disputed' ELSE 'clean' END AS status FROM c)"""


@query(uses="vote", sql=f"{CONSENSUS} SELECT * FROM cons")
def vote_consensus(t: Tables):
    return reports.vote_consensus(t.vote)


@query(
    uses="issue",
    sql="""WITH a AS (SELECT form_id, code AS field_id, event_id % 3 AS idx, arg_max(severity, (event_id, severity)) AS analytic FROM issue WHERE variant = 0 GROUP BY ALL),
o AS (SELECT form_id, code AS field_id, event_id % 3 AS idx, arg_max(severity, (event_id, severity)) AS ocr FROM issue WHERE variant = 1 AND severity <> 'low' GROUP BY ALL)
SELECT coalesce(a.form_id, o.form_id) AS form_id, coalesce(a.field_id, o.field_id) AS field_id, coalesce(a.idx, o.idx) AS idx, analytic, ocr
FROM a FULL JOIN o ON a.form_id = o.form_id AND a.field_id = o.field_id AND a.idx = o.idx""",
)
def evidence_units(t: Tables):
    flags = lambda v: t.issue.where(F.col("variant") == v).select(
        "form_id", F.col("code").alias("field_id"), (F.col("event_id") % 3).alias("idx"),
        F.when((F.col("variant") == 1) & (F.col("severity") == "low"), "ok").otherwise(F.col("severity")).alias("flag"), F.col("event_id").alias("at"),
    )
    return reports.evidence_units(flags(0), flags(1))


@query(
    uses="vote issue",
    sql="""WITH l AS (SELECT key, arg_max(verdict, (ts, event_id)) AS verdict FROM vote WHERE voter = 'click' GROUP BY key),
u AS (SELECT form_id AS key, arg_max(severity, event_id) AS flag FROM issue GROUP BY form_id),
c AS (SELECT key FROM (SELECT DISTINCT c_custkey AS key FROM customer) ORDER BY sha256(key || '|20240601'), key LIMIT 40)
SELECT key, 'unit' AS why FROM u LEFT JOIN l USING (key) WHERE verdict IN ('minor', 'major') OR flag = 'high' UNION ALL SELECT key, 'control' FROM c""",
)
def panel_selection(t: Tables):
    latest = reports.latest_by_key(t.vote.where("voter = 'click'"), ["key"], ["ts", "event_id"]).select("key", "verdict")
    units = t.issue.groupBy(F.col("form_id").alias("key")).agg(F.max_by("severity", "event_id").alias("flag"))
    controls = t.raw("customer").select(F.col("c_custkey").alias("key"))
    return reports.panel_selection(units, latest, controls, strong=["high"], n_controls=40, seed=20240601)


@query(
    uses="rect",
    sql="""SELECT form_id, page || '-' || rect_id AS key FROM rect
QUALIFY row_number() OVER (PARTITION BY form_id ORDER BY sha256(page || '-' || rect_id || '|7'), page || '-' || rect_id) <= 2""",
)
def sampled_controls(t: Tables):
    rows = t.rect.select("form_id", F.concat_ws("-", "page", "rect_id").alias("key"))
    return reports.sampled_controls(rows, "form_id", "key", n=2, seed=7)


@query(
    uses="vote issue",
    sql=f"""{CONSENSUS}, r AS (SELECT key, 'vote' AS source FROM cons WHERE status = 'confirmed' UNION ALL SELECT key, 'adjudicated' FROM vote WHERE verdict = 'major' AND voter = 'error'),
w AS (SELECT key, max(source) AS source FROM r GROUP BY key),
f AS (SELECT form_id AS key, count(DISTINCT code) AS n_flags, min(code) AS first_flag FROM issue WHERE variant = 1 AND severity = 'high' AND code <> 'other' GROUP BY form_id)
SELECT w.key, source, n_flags, first_flag FROM w JOIN f ON w.key = f.key""",
)
def rebuild_worklist(t: Tables):
    flags = t.issue.where("variant = 1 AND severity = 'high'").select(F.col("form_id").alias("key"), F.col("code").alias("flag"))
    adjudications = t.vote.where("voter = 'error'").select("key", "verdict")
    return reports.rebuild_worklist(reports.vote_consensus(t.vote), adjudications, flags, benign=["other"])


@query(
    uses="vote",
    sql="SELECT verdict, count(*) AS n FROM (SELECT key, arg_max(verdict, (ts, event_id)) AS verdict FROM vote GROUP BY key) GROUP BY verdict",
)
def review_progress(t: Tables):
    return reports.review_progress(t.vote)


@query(
    uses="issue",
    sql="""WITH l AS (SELECT form_id, code AS stage, CASE WHEN severity = 'high' THEN 1 ELSE 0 END AS errors, event_id FROM issue),
z AS (SELECT form_id, arg_max(stage, event_id) AS stage, arg_max(errors, event_id) AS errors FROM l GROUP BY form_id),
s AS (SELECT stage, count(*) AS n FROM z WHERE errors > 0 GROUP BY stage)
SELECT l.stage, sum(errors)::BIGINT AS errors, count(DISTINCT form_id) AS n_forms, coalesce(any_value(s.n), 0) AS n_last_with_errors FROM l LEFT JOIN s ON l.stage = s.stage GROUP BY l.stage""",
)
def stage_error_totals(t: Tables):
    log = t.issue.select(
        "form_id", F.col("code").alias("stage"), F.col("event_id").alias("stage_no"), "event_id", (F.col("severity") == "high").cast("bigint").alias("errors")
    )
    return reports.stage_error_totals(log)


@query(
    sql="""WITH e AS (SELECT c_mktsegment AS case_type, event_type <> 'signup' AS filled, CASE WHEN value > 50 THEN 1 ELSE 0 END AS errors FROM events JOIN customer ON user_id = c_custkey)
SELECT case_type, count(*) AS events, count(*) FILTER (filled) AS filled, count(*) FILTER (filled AND errors = 0) AS clean, count(*) FILTER (NOT filled) AS failed FROM e GROUP BY ALL""",
)
def chain_summary(t: Tables):
    events = t.raw("events").join(t.raw("customer"), F.col("user_id") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("case_type"), (F.col("event_type") != "signup").alias("filled"), (F.col("value") > 50).cast("int").alias("errors")
    )
    return reports.chain_summary(events)


@query(
    uses="field",
    sql="""WITH f AS (SELECT *, CASE WHEN size > 45 THEN 'red' ELSE 'green' END AS tier, CASE WHEN size = 50 AND data_type = 'currency' THEN 1 END AS formula, CASE WHEN size = 49 THEN 1 END AS deadline,
  CASE WHEN size = 48 THEN 1 ELSE 0 END AS evidence FROM field),
g AS (SELECT form_id, count(*) AS n_fields, round(count(*) FILTER (category = 'financial') / count(*), 6) AS financial_share, round(count(*) FILTER (tier = 'red') / count(*), 6) AS red_share,
  bool_or(formula IS NOT NULL) AS has_formula, bool_or(deadline IS NOT NULL) AS has_deadline, bool_or(evidence > 0) AS has_evidence FROM f GROUP BY form_id)
SELECT *, concat_ws(',', CASE WHEN NOT has_formula THEN 'formula' END, CASE WHEN NOT has_deadline THEN 'deadline' END, CASE WHEN NOT has_evidence THEN 'evidence' END) AS missing FROM g""",
)
def gap_tracker(t: Tables):
    fields = t.field.withColumns(
        {
            "tier": F.when(F.col("size") > 45, "red").otherwise("green"),
            "formula": F.when((F.col("size") == 50) & (F.col("data_type") == "currency"), 1),
            "deadline": F.when(F.col("size") == 49, 1),
            "evidence": (F.col("size") == 48).cast("int"),
        }
    )
    return reports.gap_tracker(fields)


@query(
    uses="field",
    sql="""WITH u AS (SELECT DISTINCT data_type AS cite, form_id FROM field WHERE size > 20),
a AS (SELECT DISTINCT data_type AS cite, 'statute' AS kind FROM field UNION ALL SELECT DISTINCT 'cat ' || category, 'case' FROM field)
SELECT a.cite, a.kind, count(u.form_id) AS n_forms, string_agg(u.form_id, ',' ORDER BY u.form_id) AS forms FROM a LEFT JOIN u ON a.cite = u.cite GROUP BY ALL""",
)
def authority_usage(t: Tables):
    uses = t.field.where("size > 20").select(F.col("data_type").alias("cite"), "form_id")
    known = t.field.select(F.col("data_type").alias("cite"), F.lit("statute").alias("kind")).unionByName(
        t.field.select(F.concat(F.lit("cat "), "category").alias("cite"), F.lit("case").alias("kind"))
    )
    return reports.authority_usage(uses, known.distinct())


@query(
    uses="field",
    sql="""WITH u AS (SELECT DISTINCT data_type AS cite, form_id || '-' || CAST(seq // 40 AS VARCHAR) AS form_id FROM field WHERE size > 20),
a AS (SELECT DISTINCT data_type AS cite, 'statute' AS kind FROM field UNION ALL SELECT DISTINCT 'cat ' || category, 'case' FROM field)
SELECT a.cite, a.kind, u.form_id FROM a LEFT JOIN u ON a.cite = u.cite""",
)
def authority_uses(t: Tables):
    fields = _more_forms(t)
    uses = fields.where("size > 20").select(F.col("data_type").alias("cite"), "form_id")
    known = fields.select(F.col("data_type").alias("cite"), F.lit("statute").alias("kind")).unionByName(
        fields.select(F.concat(F.lit("cat "), "category").alias("cite"), F.lit("case").alias("kind"))
    )
    return reports.authority_uses(uses, known.distinct())


SLOTS = r"""WITH n AS (SELECT form_id, CASE size % 3 WHEN 0 THEN field_id WHEN 1 THEN 'heir_' || CAST(seq % 4 + 1 AS VARCHAR) || '_' || string_split(label, ' ')[1] ELSE 'heir_' || string_split(label, ' ')[2] || '_' || CAST(seq % 3 + 1 AS VARCHAR) END AS f FROM field),
s AS (SELECT form_id, CASE WHEN regexp_matches(f, '^([a-z]+(?:_[a-z0-9]+)*?)_(\d+)_([a-z]+(?:_[a-z]+)*)$') THEN regexp_extract(f, '^([a-z]+(?:_[a-z0-9]+)*?)_(\d+)_([a-z]+(?:_[a-z]+)*)$', ['e', 'i', 'a'])
  WHEN regexp_matches(f, '^([a-z]+(?:_[a-z0-9]+)*?)_([a-z]+)_(\d+)$') THEN {'e': regexp_extract(f, '^([a-z]+(?:_[a-z0-9]+)*?)_([a-z]+)_(\d+)$', 1), 'i': regexp_extract(f, '_(\d+)$', 1), 'a': regexp_extract(f, '^([a-z]+(?:_[a-z0-9]+)*?)_([a-z]+)_(\d+)$', 2)}
  WHEN regexp_matches(f, '^([a-z]+(?:_[a-z]+)*?)_(\d+)$') THEN {'e': regexp_extract(f, '^([a-z]+(?:_[a-z]+)*?)_(\d+)$', 1), 'i': regexp_extract(f, '_(\d+)$', 1), 'a': 'value'} END AS s FROM n)"""


def _slot_names(t: Tables):
    w = lambda i: F.split("label", " ")[i]
    name = (
        F.when(F.col("size") % 3 == 0, F.col("field_id"))
        .when(F.col("size") % 3 == 1, F.concat(F.lit("heir_"), (F.col("seq") % 4 + 1).cast("string"), F.lit("_"), w(0)))
        .otherwise(F.concat(F.lit("heir_"), w(1), F.lit("_"), (F.col("seq") % 3 + 1).cast("string")))
    )
    return t.field.select("form_id", name.alias("field_id"))


@query(
    uses="field",
    sql=f"""{SLOTS}, d AS (SELECT DISTINCT form_id, s.e AS entity, CAST(s.i AS INTEGER) AS idx, s.a AS attr FROM s WHERE s IS NOT NULL AND CAST(s.i AS INTEGER) >= 1)
SELECT form_id, entity, max(idx) AS capacity, count(*) AS n_slots, string_agg(DISTINCT attr, ',' ORDER BY attr) AS attrs, count(DISTINCT attr) AS n_attrs,
  count(*) = max(idx) * count(DISTINCT attr) AS valid FROM d GROUP BY form_id, entity HAVING max(idx) >= 2""",
)
def repeating_groups(t: Tables):
    return reports.repeating_groups(_slot_names(t))


SCORED = """WITH e AS (SELECT form_id, code AS field_id, CASE WHEN severity = 'high' THEN 'wrong' WHEN severity = 'medium' THEN 'matches' ELSE 'not_applicable' END AS accuracy,
  CASE event_id % 3 WHEN 0 THEN 'overconfident' WHEN 1 THEN 'underconfident' ELSE 'calibrated' END AS calibration, CASE WHEN event_id % 7 = 0 THEN 'misunderstood' ELSE 'ok' END AS comprehension FROM issue),
ev AS (SELECT form_id, field_id, count(*) AS patterns_scored, count(*) FILTER (accuracy = 'wrong') AS wrong, count(*) FILTER (accuracy = 'matches') AS matches,
  count(*) FILTER (accuracy = 'not_applicable') AS not_applicable, count(*) FILTER (calibration = 'overconfident') AS overconfident,
  count(*) FILTER (calibration = 'underconfident') AS underconfident, count(*) FILTER (comprehension = 'misunderstood') AS misunderstood FROM e GROUP BY ALL)"""


def _evidence(t: Tables):
    scored = t.issue.select(
        "form_id", F.col("code").alias("field_id"),
        F.expr("CASE WHEN severity = 'high' THEN 'wrong' WHEN severity = 'medium' THEN 'matches' ELSE 'not_applicable' END").alias("accuracy"),
        F.expr("CASE event_id % 3 WHEN 0 THEN 'overconfident' WHEN 1 THEN 'underconfident' ELSE 'calibrated' END").alias("calibration"),
        F.when(F.col("event_id") % 7 == 0, "misunderstood").otherwise("ok").alias("comprehension"),
    )
    return reports.eval_evidence(scored)


@query(uses="issue", sql=f"{SCORED} SELECT * FROM ev")
def eval_evidence(t: Tables):
    return _evidence(t)


@query(
    uses="issue",
    sql=f"""{SCORED}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY form_id ORDER BY wrong DESC, field_id) AS INTEGER) AS place FROM ev WHERE wrong > 0 OR overconfident > 0 OR misunderstood > 0)
SELECT form_id, place, field_id, concat_ws('; ', CASE WHEN wrong > 0 THEN 'wrong ' || wrong END, CASE WHEN overconfident > 0 THEN 'overconfident ' || overconfident END,
  CASE WHEN misunderstood > 0 THEN 'misunderstood ' || misunderstood END) AS symptom, wrong FROM r WHERE place <= 8""",
)
def failure_modes(t: Tables):
    return reports.failure_modes(_evidence(t))


@query(
    uses="issue",
    sql="""WITH f AS (SELECT form_id, event_id % 5 AS round_no, CASE code WHEN 'alignment' THEN 'delete' WHEN 'missing' THEN 'add' ELSE 'rename' END AS action, event_id AS fix_no FROM issue),
r AS (SELECT *, row_number() OVER (PARTITION BY form_id, round_no, action ORDER BY fix_no) AS k FROM f)
SELECT form_id, round_no, action, fix_no FROM r WHERE action = 'rename' OR (action = 'delete' AND k <= 3) OR (action = 'add' AND k <= 2)""",
)
def cap_actions(t: Tables):
    fixes = t.issue.select(
        "form_id", (F.col("event_id") % 5).alias("round_no"),
        F.expr("CASE code WHEN 'alignment' THEN 'delete' WHEN 'missing' THEN 'add' ELSE 'rename' END").alias("action"), F.col("event_id").alias("fix_no"),
    )
    return reports.cap_actions(fixes, max_delete=3, max_add=2)


def _iterations(t: Tables):
    return t.issue.where("severity = 'high'").groupBy("form_id", (F.col("event_id") % 6).cast("int").alias("iter")).agg(F.count("*").alias("issues"))


@query(
    uses="issue",
    sql="""WITH c AS (SELECT form_id, CAST(event_id % 6 AS INTEGER) AS iter, count(*) AS issues FROM issue WHERE severity = 'high' GROUP BY ALL)
SELECT form_id, arg_min(iter, (issues, iter)) AS best_iter, min(issues) AS best_issues FROM c GROUP BY form_id""",
)
def best_iteration(t: Tables):
    return reports.best_iteration(_iterations(t))


@query()
def improvement_status(t: Tables):
    return reports.improvement_status(_iterations(t))
