"""Events routed to forms, catalogue search and lifecycles."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.operators import routing
from formloom.plans.records import _cases
from formloom.plans.registry import query
from formloom.sources.testdata import Tables

# form, anchor, case types, filer role, who satisfies it, parties, fields
FORMS = (
    ("AA-101", "signup", ("BUILDING", "MACHINERY"), "petitioner", ("owner", "heir"), ("heir", "owner"), 40),
    ("AA-102", "signup", ("BUILDING",), "heir", ("heir",), ("heir",), 20),
    ("AA-103", "click", ("BUILDING", "FURNITURE"), "owner", None, ("owner",), 0),
    ("BB-201", "click", ("HOUSEHOLD",), "owner", ("owner",), ("owner", "heir"), 12),
    ("BB-202", "purchase", None, "heir", ("heir",), ("heir",), 30),
    ("BB-203", "purchase", None, "clerk", None, (), 8),
    ("CC-301", "error", None, "any", (), ("heir",), 15),
    ("CC-302", None, ("AUTOMOBILE", "FURNITURE"), "owner", ("owner",), ("owner",), 25),
    ("CC-303", None, None, "owner", None, ("heir", "owner"), 18),
    ("DD-401", "view", None, "heir", None, ("heir",), 5),
    ("DD-402", "view", ("MACHINERY",), "owner", ("owner",), ("owner",), 9),
    ("DD-403", None, None, "clerk", None, (), 3),
)
# form, source, key, expected value, only for event type, points
BOOSTS = (
    ("AA-101", "fact", "cause", None, None, 0.15),
    ("AA-102", "fact_absent", "choice_1", None, None, 0.1),
    ("BB-202", "payload", "k", "7", None, 0.25),
    ("CC-303", "fact", "choice_1", "yes", "click", 0.3),
    ("CC-303", "fact_absent", "cause", None, "error", -0.05),
    ("DD-403", "payload", "k", None, "signup", 0.2),
)


def catalogue(t: Tables) -> tuple[DataFrame, DataFrame]:
    forms = t.spark.createDataFrame(
        list(FORMS), "form_id string, anchor string, case_types array<string>, filer_role string, satisfiers array<string>, parties array<string>, n_fields int"
    )
    boosts = t.spark.createDataFrame(list(BOOSTS), "form_id string, source string, key string, expected string, gate string, delta double")
    return forms, boosts


def case_events(t: Tables) -> DataFrame:
    """Events with their case's type, parties and facts."""
    cases = _cases(t).select("case_id", "case_type", F.map_keys("parties").alias("roles"), F.map_filter("facts", lambda k, v: v != "").alias("facts"))
    payload = F.from_json("props", "map<string,string>")
    return (
        t.raw("events")
        .select("event_id", F.col("user_id").alias("case_id"), F.col("event_type").alias("type"), "ts", payload.alias("payload"))
        .join(cases, "case_id")
        .withColumn("filers", F.col("roles"))
    )


def _sql_list(xs) -> str:
    return "NULL" if xs is None else "[" + ", ".join(f"'{x}'" for x in xs) + "]::VARCHAR[]"


def _sql(x) -> str:
    return "NULL" if x is None else (f"'{x}'" if isinstance(x, str) else repr(x))


FORM_ROWS = ", ".join(f"({_sql(a)}, {_sql(b)}, {_sql_list(c)}, {_sql(d)}, {_sql_list(e)}, {_sql_list(g)}, {h})" for a, b, c, d, e, g, h in FORMS)
BOOST_ROWS = ", ".join(f"({', '.join(_sql(x) for x in row)}::DOUBLE)" for row in BOOSTS)
SCORED = f"""WITH forms(form_id, anchor, case_types, filer_role, satisfiers, parties, n_fields) AS (VALUES {FORM_ROWS}),
boosts(form_id, source, key, expected, gate, delta) AS (VALUES {BOOST_ROWS}),
ev AS (SELECT event_id, event_type AS type, c_mktsegment AS case_type, CASE WHEN c_custkey % 2 = 0 THEN ['heir', 'owner'] ELSE ['owner'] END AS roles,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS cause, CASE WHEN c_custkey % 3 = 0 THEN 'Yes' END AS choice_1, regexp_extract(props, '"k": *(\\d+)', 1) AS k FROM events JOIN customer ON user_id = c_custkey),
p AS (SELECT e.*, f.*, CASE WHEN anchor IS NOT NULL THEN 0.5 ELSE 0 END::DOUBLE + CASE WHEN case_types IS NOT NULL THEN 0.1 ELSE 0 END::DOUBLE
  + CASE WHEN satisfiers IS NULL THEN CASE WHEN list_contains(roles, lower(filer_role)) THEN 0.1 ELSE 0 END WHEN len(satisfiers) > 0 THEN 0.2 ELSE 0 END::DOUBLE
  + CAST(0.05 AS DOUBLE) * len(list_intersect(roles, parties)) AS base
  FROM ev e JOIN forms f ON (anchor IS NULL OR anchor = type) AND (case_types IS NULL OR list_contains(case_types, case_type))
  WHERE satisfiers IS NULL OR len(satisfiers) = 0 OR list_has_any(roles, satisfiers)),
b AS (SELECT p.event_id, p.form_id, sum(delta) AS delta FROM p JOIN boosts o ON p.form_id = o.form_id AND (gate IS NULL OR gate = type) AND CASE source
  WHEN 'payload' THEN k <> '' AND (expected IS NULL OR expected = k)
  WHEN 'fact' THEN CASE key WHEN 'cause' THEN cause ELSE choice_1 END IS NOT NULL AND (expected IS NULL OR lower(expected) = lower(CASE key WHEN 'cause' THEN cause ELSE choice_1 END))
  ELSE CASE key WHEN 'cause' THEN cause ELSE choice_1 END IS NULL END GROUP BY ALL),
scored AS (SELECT p.event_id, p.form_id, p.n_fields, round(base + coalesce(delta, 0), 3) AS score FROM p LEFT JOIN b ON p.event_id = b.event_id AND p.form_id = b.form_id WHERE round(base + coalesce(delta, 0), 3) <> 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY event_id ORDER BY score DESC, CASE WHEN n_fields > 0 THEN n_fields ELSE 9999 END, form_id) AS INTEGER) AS place FROM scored)"""


def scored(t: Tables) -> DataFrame:
    return routing.score_events(case_events(t), routing.form_routes(*catalogue(t)))


@query(sql=f"{SCORED} SELECT event_id, form_id, n_fields, score FROM scored")
def score_events(t: Tables):
    return scored(t).drop("reasons")


@query(sql=f"{SCORED} SELECT * FROM ranked WHERE place <= 3")
def top_forms(t: Tables):
    return routing.top_forms(scored(t), 3).drop("reasons")


@query(sql=f"{SCORED} SELECT * FROM ranked WHERE place = 1 OR (score >= 0.7 AND place <= 5)")
def forms_above(t: Tables):
    return routing.forms_above(scored(t)).drop("reasons")


def _labels(t: Tables) -> DataFrame:
    """Events labelled with the form their type should and should not reach."""
    good = F.expr("CASE event_type WHEN 'signup' THEN 'AA-101' WHEN 'click' THEN 'AA-103' WHEN 'purchase' THEN 'BB-202' WHEN 'error' THEN 'CC-301' ELSE 'DD-401' END")
    pair = F.array(F.struct(good.alias("form_id"), F.lit(True).alias("expected")), F.struct(F.lit("DD-403").alias("form_id"), F.lit(False).alias("expected")))
    return t.raw("events").select("event_id", F.inline(pair))


EVAL = f"""{SCORED}, lab AS (SELECT event_id, CASE event_type WHEN 'signup' THEN 'AA-101' WHEN 'click' THEN 'AA-103' WHEN 'purchase' THEN 'BB-202' WHEN 'error' THEN 'CC-301' ELSE 'DD-401' END AS form_id, true AS expected FROM events
  UNION ALL SELECT event_id, 'DD-403', false FROM events),
j AS (SELECT l.*, r.place FROM lab l LEFT JOIN (SELECT * FROM ranked WHERE place <= 3) r ON l.event_id = r.event_id AND l.form_id = r.form_id),
e AS (SELECT event_id, count(*) FILTER (expected AND place IS NOT NULL) AS expected_found, count(*) FILTER (expected AND place IS NULL) AS expected_missed,
  count(*) FILTER (NOT expected AND place IS NOT NULL) AS negative_found, coalesce(bool_or(expected AND place = 1), false) AS top1 FROM j GROUP BY event_id)"""


@query(sql=f"{EVAL} SELECT * FROM e")
def routing_eval(t: Tables):
    return routing.routing_eval(routing.top_forms(scored(t), 3), _labels(t))


@query(
    sql=f"""{EVAL} SELECT count(*) AS n, round(avg(CASE WHEN top1 THEN 1 ELSE 0 END), 6) AS top1_accuracy, round(avg(CASE WHEN expected_missed = 0 THEN 1 ELSE 0 END), 6) AS all_expected,
  round(avg(CASE WHEN negative_found > 0 THEN 1 ELSE 0 END), 6) AS any_negative FROM e""",
)
def routing_accuracy(t: Tables):
    return routing.eval_summary(routing.routing_eval(routing.top_forms(scored(t), 3), _labels(t)))


def _form_titles(t: Tables) -> DataFrame:
    form = F.concat(F.lit("PT-"), F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 5 == 0, "(I)").otherwise(""))
    return t.raw("part").select(form.alias("form_id"), F.col("p_name").alias("title"), F.concat_ws(" ", "p_type", F.lit("form")).alias("category"))


def _queries(t: Tables) -> DataFrame:
    """Benchmark texts, each asking for a part by name and some by id."""
    named = t.raw("benchmark").join(t.raw("part").select("p_partkey", "p_name", "p_type"), F.col("item_id") == F.col("p_partkey"))
    ask = F.when(F.col("item_id") % 3 == 0, F.concat(F.lit(" need pt "), F.col("item_id").cast("string"), F.lit("."))).when(
        F.col("item_id") % 3 == 1, F.concat(F.lit(" the informal PT-"), F.col("item_id").cast("string"))
    ).otherwise("")
    return named.select(F.col("item_id").alias("query_id"), F.concat_ws(" ", "text", "p_name", F.lower("p_type"), ask).alias("query"))


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in routing.STOP_WORDS) + "]"


@query(
    sql=rf"""WITH f AS (SELECT 'PT-' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 5 = 0 THEN '(I)' ELSE '' END AS form_id, p_name AS title, p_type || ' form' AS category FROM part),
q AS (SELECT item_id AS query_id, concat_ws(' ', text, p_name, lower(p_type), CASE item_id % 3 WHEN 0 THEN ' need pt ' || CAST(item_id AS VARCHAR) || '.' WHEN 1 THEN ' the informal PT-' || CAST(item_id AS VARCHAR) ELSE '' END) AS query
  FROM benchmark JOIN part ON item_id = p_partkey),
m0 AS (SELECT query_id, regexp_matches(query, '(?i)\binformal(ly)?\b') AND NOT regexp_matches(query, '(?i)\bformal(ly)?\b') AS inf, unnest(regexp_extract_all(query, '(?i)\b([A-Za-z]{{2,4}})[-_ ]?(\d{{1,3}}[A-Za-z]?)(\s*\(\s*i\s*\))?')) AS hit FROM q),
m AS (SELECT query_id, inf, upper(regexp_extract(hit, '^([A-Za-z]+)', 1) || '-' || regexp_extract(hit, '(\d{{1,3}}[A-Za-z]?)', 1)) AS base, ends_with(hit, ')') AS mark FROM m0),
n AS (SELECT query_id, v AS form_id, min(k) AS k FROM (SELECT query_id, unnest(CASE WHEN inf OR mark THEN [base || '(I)', base] ELSE [base, base || '(I)'] END) AS v, unnest([0, 1]) AS k FROM m) WHERE v IN (SELECT form_id FROM f) GROUP BY ALL),
w AS (SELECT form_id, token, sum(x) AS w FROM (
  SELECT form_id, unnest(list_distinct(regexp_extract_all(lower(title), '[a-z0-9]+'))) AS token, 2 AS x FROM f UNION ALL SELECT form_id, unnest(list_distinct(regexp_extract_all(lower(category), '[a-z0-9]+'))), 1 FROM f
) WHERE length(token) > 2 AND NOT list_contains({STOP_SQL}, token) GROUP BY ALL),
qt AS (SELECT query_id, unnest(list_distinct(regexp_extract_all(lower(query), '[a-z0-9]+'))) AS token FROM q),
s AS (SELECT qt.query_id, w.form_id, CAST(sum(w) AS BIGINT) AS score FROM qt JOIN w ON qt.token = w.token GROUP BY ALL),
al AS (SELECT query_id, form_id, true AS named, 0::BIGINT AS score, k FROM n UNION ALL SELECT query_id, form_id, false, score, 9 FROM s WHERE (query_id, form_id) NOT IN (SELECT (query_id, form_id) FROM n)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY named DESC, k, score DESC, form_id) AS INTEGER) AS place FROM al)
SELECT query_id, place, form_id, named, score FROM r WHERE place <= 8""",
)
def search_forms(t: Tables):
    return routing.search_forms(_queries(t), _form_titles(t), k=8)


@query(
    sql="""WITH f AS (SELECT 'PT-' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 5 = 0 THEN '(I)' ELSE '' END AS form_id, p_name AS title, p_type || ' form' AS category, p_size FROM part),
l AS (SELECT form_id, concat_ws(' | ', form_id, category, title, CASE WHEN p_size > 25 THEN 'large' END) AS line FROM f)
SELECT form_id, line, CAST(length(line) // 4 AS BIGINT) AS tokens FROM l""",
)
def router_menu(t: Tables):
    titles = _form_titles(t)
    form = F.concat(F.lit("PT-"), F.col("p_partkey").cast("string"), F.when(F.col("p_partkey") % 5 == 0, "(I)").otherwise(""))
    hints = t.raw("part").where("p_size > 25").select(form.alias("form_id"), F.lit("large").alias("hint"))
    return routing.router_menu(titles, hints)


def _templates(t: Tables) -> DataFrame:
    """One lifecycle for every market segment found in the data."""
    steps = [
        {"seq": 1, "type": "opened", "offset_days": 0, "sets": {"opened_on": "{event_date}"}},
        {"seq": 2, "type": "notice", "offset_days": 14, "override": {"stage": "noticed"}, "defaults": {"docket": "D-1"}},
        {"seq": 3, "type": "contest", "offset_days": 20, "requires_fact": "choice_1", "sets": {"contested": "yes"}},
        {"seq": 4, "type": "hearing", "offset_days": 45, "requires_fact": "contested", "override": {"stage": None},
         "copies": {"guardian": "owner_name"}, "defaults": {"docket": "D-2"}},
        {"seq": 5, "type": "closed", "offset_days": 180, "override": {"stage": "closed"}},
    ]
    types = t.raw("customer").select(F.col("c_mktsegment").alias("case_type")).distinct()
    return types.withColumn("steps", F.from_json(F.lit(json.dumps(steps)), routing.TEMPLATE_TYPE))


def _life(t: Tables) -> DataFrame:
    c = _cases(t).select(
        "case_id", "case_type", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("case_id") % 300).cast("int")).alias("anchor_date"),
        F.map_concat("facts", F.create_map(F.lit("owner_name"), F.col("case_type"))).alias("facts"),
    )
    return routing.expand_lifecycle(c, _templates(t))


@query(
    sql="""WITH c AS (SELECT c_custkey AS case_id, c_mktsegment AS case_type, DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS d, c_custkey % 3 = 0 AS ch FROM customer),
s(seq, type, off) AS (VALUES (1, 'opened', 0), (2, 'notice', 14), (3, 'contest', 20), (4, 'hearing', 45), (5, 'closed', 180))
SELECT case_id, case_type, seq, type, CAST(d + off AS DATE) AS event_date, CASE seq WHEN 2 THEN 'noticed' WHEN 3 THEN 'noticed' WHEN 5 THEN 'closed' END AS stage, CASE WHEN seq > 1 THEN strftime(d, '%Y-%m-%d') END AS opened_on,
  CASE WHEN seq > 2 THEN 'D-1' END AS docket, CASE WHEN seq = 5 AND ch THEN case_type END AS guardian, CASE WHEN seq > 3 AND ch THEN 'yes' END AS contested
FROM c JOIN s ON seq IN (1, 2, 5) OR ch""",
)
def expand_lifecycle(t: Tables):
    f = lambda k: F.try_element_at("facts", F.lit(k)).alias(k)
    return _life(t).select("case_id", "case_type", "seq", "type", "event_date", *[f(k) for k in ("stage", "opened_on", "docket", "guardian", "contested")])


@query(
    sql=r"""WITH c AS (SELECT c_custkey AS k, c_name AS nm, c_mktsegment AS seg, CAST(c_nationkey AS VARCHAR) AS n FROM customer)
SELECT k AS case_id, 'Case ' || CAST(k AS VARCHAR) || ' (' || seg || ') in C' || n || ' County.' || chr(10) || 'Triggering event: first filing on 2024-05-01.' || chr(10)
  || CASE WHEN k % 2 = 0 THEN 'Heir: ' || nm || ', DOB 1960-01-02, phone 207555' || n || '.' || chr(10) ELSE '' END || 'Owner: ' || seg || ' L' || n || '.' || chr(10)
  || CASE WHEN k % 3 = 0 THEN 'Cause: ' || seg || '.' || chr(10) || 'Choice 1: Yes.' ELSE 'Cause: .' END AS narrative FROM c""",
)
def narrative(t: Tables):
    c = _cases(t).select(
        "case_id", "case_type", F.try_element_at("matter", F.lit("county")).alias("county"), F.lit("first_filing").alias("event_type"), F.lit("2024-05-01").alias("event_date"), "parties", "facts"
    )
    return routing.narrative(c)
