"""Rule checks over answers derived from orders and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.operators import rule_tables as tables
from formloom.operators import validation as val
from formloom.plans.records import LINES, TOTAL, _line_answers
from formloom.plans.registry import query
from formloom.plans.scalars import BOUND, _bound
from formloom.sources.testdata import Tables

MONEY = r"'^-?\$?\d{1,3}(,\d{3})*(\.\d{1,2})?$|^-?\$?\d+(\.\d{1,2})?$'"
WIDE = """WITH w AS (SELECT record_id, form_id, max(value) FILTER (field_id = 'total') AS total, max(value) FILTER (field_id = 'order_date') AS d, max(value) FILTER (field_id = 'priority') AS pr,
  max(value) FILTER (field_id = 'status') AS st FROM answer GROUP BY ALL)"""


def _v(field: str, code: str, cond: str, severity: str = "error") -> str:
    return f"SELECT record_id, form_id, '{field}' AS field_id, '{severity}' AS severity, '{code}' AS code FROM w WHERE {cond}"


@query(
    uses="answer",
    sql=WIDE + " " + " UNION ALL ".join([
        _v("total", "bad_currency", f"total <> '' AND NOT regexp_matches(trim(total), {MONEY})"),
        _v("total", "below_min", f"total <> '' AND regexp_matches(trim(total), {MONEY}) AND CAST(total AS DOUBLE) < 50000"),
        _v("total", "above_max", f"total <> '' AND regexp_matches(trim(total), {MONEY}) AND CAST(total AS DOUBLE) > 400000"),
        _v("order_date", "impossible_date", "d = '2024-02-31'"),
        _v("priority", "bad_email", "pr <> ''"),
        _v("priority", "bad_phone", "pr <> ''"),
        _v("status", "bad_docket", "st <> ''", "warn"),
        _v("status", "bad_bar_number", "st <> ''", "warn"),
    ]),
)
def validate_types(t: Tables):
    r = val.Rule
    return val.validate(
        t.answer,
        [r("total", "currency", (50000, 400000)), r("order_date", "date"), r("priority", "email"), r("priority", "phone"), r("status", "docket_number", ("ME",)), r("status", "bar_number", ("ME",)), r("priority", "docket_number")],
    )


NEEDS = {"any_of": [{"field": "status", "equals": "O"}, {"all_of": [{"field": "total", "gte": 300000}, {"none_of": [{"field": "priority", "in": ["1-URGENT", "2-HIGH"]}]}]}]}
OPEN = {"all_of": [{"field": "status", "ne": "F"}, {"field": "total", "exists": True}]}
NUM = "TRY_CAST(replace(replace(nullif(total, ''), '$', ''), ',', '') AS DECIMAL(18,2))"


@query(
    uses="answer",
    sql=WIDE + " " + " UNION ALL ".join([
        _v("order_date", "missing_required", f"(coalesce(st = 'O', false) OR (coalesce({NUM} >= 300000, false) AND NOT coalesce(pr IN ('1-URGENT', '2-HIGH'), false))) AND coalesce(d, '') = ''"),
        _v("priority", "not_writable", "pr <> '' AND NOT (coalesce(st <> 'F', true) AND coalesce(total, '') <> '')"),
    ]),
)
def validate_conditions(t: Tables):
    return val.validate(t.answer, [val.Rule("order_date", "required_when", (NEEDS,)), val.Rule("priority", "writable_when", (OPEN,))])


@query(
    uses="answer",
    sql=WIDE + " " + " UNION ALL ".join([
        _v("status", "value_not_in_choices", "st <> '' AND lower(st) NOT IN ('o', 'f')"),
        _v("priority", "regex_match_failed", r"pr <> '' AND NOT regexp_matches(pr, '^\d{2,6}$')"),
        _v("total", "value_range_unparseable", "total <> '' AND TRY_CAST(regexp_replace(total, '[$,%]', '', 'g') AS DECIMAL(18,2)) IS NULL"),
        _v("total", "value_below_range", "TRY_CAST(regexp_replace(nullif(total, ''), '[$,%]', '', 'g') AS DECIMAL(18,2)) < 1000"),
        _v("total", "value_above_range", "TRY_CAST(regexp_replace(nullif(total, ''), '[$,%]', '', 'g') AS DECIMAL(18,2)) > 250000"),
        _v("status", "field_mismatch", "st <> '' AND pr <> '' AND regexp_replace(lower(st), '[^a-z0-9 ]+', '', 'g') <> regexp_replace(lower(pr), '[^a-z0-9 ]+', '', 'g')"),
    ]),
)
def validate_tags(t: Tables):
    tags = (("status", "value_in(O, F)"), ("priority", "regex_match(bar_number)"), ("total", "value_range(1000, 250000)"), ("status", "equals_field(priority, relaxed)"))
    return val.validate(t.answer, [val.parse_tag(f, tag) for f, tag in tags])


# The first form asks for an email, the second for a priority where the order
# is open; records of every ninth order answer nothing.
DECLARED = (
    ("FX-003", "priority", None, "value_in(1-URGENT)"),
    ("FX-005", "email", '{"field": "status", "equals": "O"}', None),
    ("FX-005", "priority", None, "regex_match(bar_number)"),
    ("FX-007", "email", '{"field": "total", "exists": false}', ""),
)


@query(
    uses="answer",
    sql="""WITH r AS (SELECT record_id, form_id, max(field_id) FILTER (record_id % 9 <> 0) AS any_field, max(value) FILTER (field_id = 'total' AND record_id % 9 <> 0) AS total,
  max(value) FILTER (field_id = 'priority' AND record_id % 9 <> 0) AS pr, max(value) FILTER (field_id = 'status' AND record_id % 9 <> 0) AS st FROM answer GROUP BY ALL)
SELECT record_id, form_id, 'priority' AS field_id, 'error' AS severity, 'value_not_in_choices' AS code FROM r WHERE form_id = 'FX-003' AND pr <> '' AND pr <> '1-URGENT'
UNION ALL SELECT record_id, form_id, 'email', 'error', 'missing_required' FROM r WHERE form_id = 'FX-005' AND st = 'O'
UNION ALL SELECT record_id, form_id, 'priority', 'error', 'regex_match_failed' FROM r WHERE form_id = 'FX-005' AND pr <> ''
UNION ALL SELECT record_id, form_id, 'email', 'error', 'missing_required' FROM r WHERE form_id = 'FX-007' AND coalesce(total, '') = ''""",
)
def validate_by_form(t: Tables):
    """Rules of form packages, and records that hold nothing."""
    schema = "form_id string, field_id string, required_when string, validators string"
    fields = t.spark.createDataFrame(list(DECLARED), schema).selectExpr("*", "CAST(NULL AS STRING) AS writable_when", "CAST(NULL AS STRING) AS formula")
    held = t.answer.where("record_id % 9 <> 0")
    return val.validate(held, val.rules_from_packages(fields), t.answer.select("record_id", "form_id").distinct())


@query(
    uses="answer",
    sql="""WITH s AS (SELECT l_orderkey AS record_id, CAST(max(l_shipdate) AS DATE) AS ship FROM lineitem GROUP BY ALL),
w AS (SELECT a.record_id, form_id, a.value AS d, TRY_CAST(a.value AS DATE) AS od, ship FROM answer a LEFT JOIN s ON a.record_id = s.record_id WHERE field_id = 'order_date')
SELECT record_id, form_id, 'order_date' AS field_id, 'error' AS severity, CASE WHEN d <> '' AND od IS NULL THEN 'date_order_unparseable' ELSE 'date_order_violation' END AS code
FROM w WHERE (d <> '' AND od IS NULL) OR (od IS NOT NULL AND ship IS NOT NULL AND NOT od < ship)""",
)
def validate_date_order(t: Tables):
    ship = t.raw("lineitem").groupBy(F.col("l_orderkey").alias("record_id")).agg(F.date_format(F.max("l_shipdate"), "MMMM d, yyyy").alias("value"))
    form = t.answer.select("record_id", "form_id").distinct()
    shipped = ship.join(form, "record_id").select("record_id", "form_id", F.lit("ship_date").alias("field_id"), "value")
    return val.validate(t.answer.unionByName(shipped), [val.parse_tag("order_date", "date_order(ship_date, <)")])


@query(
    sql=f"""{LINES}, w AS (SELECT r.record_id, coalesce(sum(amt), 0)::DOUBLE AS s, any_value(v) AS v FROM (SELECT record_id FROM li UNION SELECT record_id FROM tot) r
  LEFT JOIN li ON r.record_id = li.record_id LEFT JOIN tot ON r.record_id = tot.record_id GROUP BY r.record_id),
g AS (SELECT *, CASE WHEN coalesce(v, '') = '' THEN 0 ELSE CAST(v AS DOUBLE) END AS got, greatest(5, abs(s) * CAST(0.005 AS DOUBLE)) AS slack FROM w)
SELECT record_id, 'INV' AS form_id, 'grand_total' AS field_id, 'error' AS severity, 'recompute_mismatch' AS code FROM g WHERE abs(got - s) > slack
UNION ALL SELECT record_id, 'INV', 'grand_total', 'error', 'recompute_below_minimum' FROM g WHERE got < s - slack""",
)
def validate_recompute(t: Tables):
    return val.validate(_line_answers(t), [val.Rule("grand_total", "recompute", (TOTAL,)), val.Rule("grand_total", "recompute", (TOTAL, "at_least"))])


@query(
    sql=f"""{LINES}, r AS (SELECT record_id, 'row_' || CAST(k AS VARCHAR) || '_desc' AS field_id, lower(flag) AS n FROM li WHERE flag <> 'R')
SELECT record_id, 'INV' AS form_id, field_id, first_field FROM (SELECT *, min(field_id) OVER (PARTITION BY record_id, n) AS first_field FROM r) WHERE field_id <> first_field""",
)
def duplicate_in_group(t: Tables):
    return val.dedupe_within(_line_answers(t), [("row", "desc")])


@query(
    sql=f"""{LINES}, r AS (SELECT record_id, CASE WHEN k % 2 = 0 THEN 'row' ELSE 'tang' END AS e, CASE WHEN k % 2 = 0 THEN 'row_' ELSE 'tang_' END || CAST(k AS VARCHAR) || '_desc' AS f, lower(flag) AS n FROM li WHERE flag <> 'R')
SELECT a.record_id, 'INV' AS form_id, a.f AS field_id, b.f AS other_field FROM r a JOIN r b ON a.record_id = b.record_id AND a.n = b.n AND a.e = 'tang' AND b.e = 'row'""",
)
def cross_section_dedupe(t: Tables):
    even = F.regexp_extract("field_id", r"_(\d+)_", 1).try_cast("int") % 2 == 0
    split = _line_answers(t).withColumn("field_id", F.when(F.col("field_id").endswith("_desc") & ~even, F.regexp_replace("field_id", "^row_", "tang_")).otherwise(F.col("field_id")))
    return val.cross_section_dedupe(split, "desc", [("tang", "row")])


@query(
    sql=f"""{LINES} SELECT record_id, 'INV' AS form_id, 'row_' || CAST(k AS VARCHAR) || '_amount' AS field_id FROM li WHERE flag = 'R'""",
)
def nonempty_if_desc(t: Tables):
    return val.nonempty_if_desc(_line_answers(t))


@query(
    uses="answer",
    sql="""SELECT a.record_id, a.form_id, a.field_id, a.value, o_orderstatus AS constant FROM answer a JOIN orders ON record_id = o_orderkey WHERE field_id = 'status' AND value <> o_orderstatus""",
)
def case_dict_drift(t: Tables):
    constants = t.raw("orders").select(F.col("o_orderkey").alias("record_id"), F.lit("status").alias("key"), F.col("o_orderstatus").alias("value"))
    return val.case_dict_drift(t.answer, constants)


@query(
    uses="answer",
    sql=f"""{WIDE}, v AS (SELECT record_id, form_id, 'error' AS s FROM w WHERE total <> '' AND NOT regexp_matches(trim(total), {MONEY}) UNION ALL SELECT record_id, form_id, 'error' FROM w WHERE d = '2024-02-31'
  UNION ALL SELECT record_id, form_id, 'warn' FROM w WHERE st <> '')
SELECT record_id, form_id, count(*) FILTER (s = 'error') AS n_error, count(*) FILTER (s = 'warn') AS n_warn, count(*) FILTER (s = 'info') AS n_info FROM v GROUP BY ALL""",
)
def error_counts(t: Tables):
    r = val.Rule
    return val.error_counts(val.validate(t.answer, [r("total", "currency"), r("order_date", "date"), r("status", "bar_number", ("ME",))]))


GUIDE = """SELECT form_id, seq, CASE WHEN data_type = 'date' THEN 'MM/DD/YYYY' WHEN data_type = 'currency' THEN '0,000.00' WHEN data_type IN ('choice', 'boolean') THEN 'check one' ELSE 'free text' END AS format,
  CASE WHEN data_type = 'currency' THEN 'right' ELSE 'left' END AS align, CASE WHEN data_type = 'date' THEN '04/02/2025' WHEN data_type = 'currency' THEN '1,250.00' END AS example, size % 2 = 0 AS required FROM field"""


def _guides(t: Tables):
    return val.value_guides(t.field.withColumn("required", F.col("size") % 2 == 0))


@query(uses="field", sql=f"SELECT form_id, seq, format, align, example, concat_ws('; ', format, CASE WHEN required THEN 'required' END, example) AS guide FROM ({GUIDE})")
def value_guides(t: Tables):
    return _guides(t)


TYPES = ("currency", "date", "address", "person_name", "phone", "email", "signature", "docket_number", "bar_number", "checkbox", "text", "text", "text", "text")
LABELS = (" amount", " of birth", " street address", " mailing address", " county", " year", " zip code", " state", " note")
KIND_SQL = """CASE WHEN contains(lab, 'county') THEN 'county' WHEN dt = 'currency' THEN 'currency' WHEN dt = 'date' THEN CASE WHEN contains(fid, 'birth') THEN 'past_date' ELSE 'date' END
  WHEN dt = 'address' THEN CASE WHEN contains(lab, 'street') AND NOT contains(lab, 'mailing') THEN 'street' ELSE 'address' END WHEN dt = 'person_name' THEN 'name' WHEN dt IN ('phone', 'email', 'signature') THEN dt
  WHEN dt = 'docket_number' THEN 'docket' WHEN dt = 'bar_number' THEN 'bar' WHEN dt = 'checkbox' THEN 'check' WHEN contains(lab, 'year') THEN 'year' WHEN contains(lab, 'zip') THEN 'zip' WHEN contains(lab, 'state') THEN 'state' ELSE 'text' END"""


def _literal(value) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


@query(
    uses="field",
    sql=f"""WITH f AS (SELECT form_id, seq, field_id || CASE WHEN seq % 9 = 1 THEN '_birth' ELSE '' END || '_' || CAST(seq AS VARCHAR) AS fid, label || {list(LABELS)}[CAST(seq % 9 AS INTEGER) + 1] AS lab, {list(TYPES)}[CAST(size % 14 AS INTEGER) + 1] AS dt, size FROM field),
k AS (SELECT *, {KIND_SQL} AS kind FROM f), g(kind, format, expects, examples, avoid) AS (VALUES {", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in val.GUIDES)})
SELECT form_id, fid AS field_id, lab AS label, k.kind, CASE size % 3 WHEN 0 THEN 'always' WHEN 1 THEN 'conditional' ELSE 'optional' END AS required, CASE WHEN size % 5 = 0 THEN 'right' ELSE 'left' END AS alignment,
  format, expects, coalesce(examples, '') AS examples, coalesce(avoid, '') AS avoid, CASE WHEN size % 4 = 0 AND k.kind <> 'county' THEN 'a + b' END AS calculated FROM k JOIN g ON k.kind = g.kind""",
)
def field_guides(t: Tables):
    """Fields of all declared types, with labels that tell more."""
    at = lambda names, i: F.element_at(F.array(*[F.lit(x) for x in names]), (i + 1).cast("int"))
    fid = F.concat("field_id", F.when(F.col("seq") % 9 == 1, "_birth").otherwise(""), F.lit("_"), F.col("seq").cast("string"))
    need = F.when(F.col("size") % 3 == 0, "always").when(F.col("size") % 3 == 1, '{"field": "a", "equals": "b"}')
    fields = t.field.select(
        "form_id", fid.alias("field_id"), F.concat("label", at(LABELS, F.col("seq") % 9)).alias("label"), at(TYPES, F.col("size") % 14).alias("data_type"),
        F.lit("text").alias("field_type"), need.alias("required_when"), F.when(F.col("size") % 4 == 0, "a + b").alias("formula"), "size",
    )
    aligned = fields.where("size % 5 = 0").select("form_id", "field_id", F.lit("right").alias("alignment"))
    told = val.field_guides(fields, aligned)
    return told.withColumns({c: F.coalesce(F.array_join(c, "|"), F.lit("")) for c in ("examples", "avoid")})


@query(
    uses="field",
    sql="""SELECT form_id, seq, CASE size % 4 WHEN 0 THEN 'date' WHEN 1 THEN 'currency' WHEN 2 THEN 'zip' END AS implied FROM field WHERE data_type = 'text' AND size % 4 < 3""",
)
def under_typed_text(t: Tables):
    k = F.col("size") % 4
    tail = F.when(k == 0, " date").when(k == 1, " total amount").when(k == 2, " zip code").otherwise(" note")
    return val.under_typed_text(t.field.withColumn("label", F.concat("label", tail)))


@query(
    uses="field",
    sql=f"{BOUND} SELECT form_id, seq, source, 'unknown_namespace' AS problem FROM b WHERE source = 'other.key'",
)
def lint_sources(t: Tables):
    return val.lint_sources(_bound(t), namespaces=["case_dict"])


@query(
    uses="field",
    sql=f"SELECT form_id, seq, CASE WHEN seq % 9 = 0 THEN 'old' ELSE format END AS stored, format AS derived FROM ({GUIDE}) WHERE seq % 9 = 0",
)
def stale_projection(t: Tables):
    fresh = _guides(t)
    stored = fresh.withColumn("format", F.when(F.col("seq") % 9 == 0, "old").otherwise(F.col("format")))
    return val.stale_projection(stored, fresh, ["form_id", "seq"], "format")


@query(
    uses="answer",
    sql=f"""{LINES}, e AS (SELECT 'grand_total' AS target, 'row_' || CAST(k AS VARCHAR) || '_amount' AS input FROM range(1, 8) t(k) UNION ALL VALUES ('net', 'grand_total'), ('share', 'row_1_amount'), ('share', 'net')),
u AS (SELECT 'row_' || CAST(k AS VARCHAR) || '_amount' AS input, record_id FROM li UNION ALL SELECT 'grand_total', record_id FROM tot)
SELECT target, e.input, count(record_id) AS n_records FROM e LEFT JOIN u ON e.input = u.input GROUP BY ALL""",
)
def formula_inputs(t: Tables):
    """Edges from formula targets to the fields they read, with their use; an
    input that no record holds has none."""
    from formloom.plans.records import FORMULAS

    pairs = [(target, i) for target, tree in FORMULAS.items() for i in val.formula_inputs(tree)]
    edges = t.spark.createDataFrame(pairs, "target string, input string")
    used = _line_answers(t).groupBy(F.col("field_id").alias("input")).agg(F.count("*").alias("n_records"))
    return edges.join(used, "input", "left").select("target", "input", F.coalesce("n_records", F.lit(0)).alias("n_records"))


#: Rules and patterns as rows: for all forms, for one, and by a name that is not there.
RULE_ROWS = (
    (None, "total", "currency", ["50000", "400000"]),
    (None, "order_date", "date", []),
    (None, "status", "value_in", ["O", "F"]),
    (None, "total", "value_range", ["1000", "250000"]),
    (None, "status", "equals_field", ["priority", "relaxed"]),
    (None, "order_date", "date_order", ["due_date", "<"]),
    ("FX-003", "priority", "regex_match", ["urgent"]),
    ("FX-005", "priority", "regex_match", ["not_there"]),
    (None, "status", "bar_number", ["ME"]),
    (None, "status", "docket_number", ["XX"]),
)
PATTERN_ROWS = (("urgent", "^1-"), ("bar_number:ME", r"^\d{2,6}$"), ("docket_number:ME", "^[A-Z]"))


@query(
    uses="answer",
    sql=WIDE + " " + " UNION ALL ".join([
        _v("total", "bad_currency", f"total <> '' AND NOT regexp_matches(trim(total), {MONEY})"),
        _v("total", "below_min", f"total <> '' AND regexp_matches(trim(total), {MONEY}) AND CAST(total AS DOUBLE) < 50000"),
        _v("total", "above_max", f"total <> '' AND regexp_matches(trim(total), {MONEY}) AND CAST(total AS DOUBLE) > 400000"),
        _v("order_date", "impossible_date", "d = '2024-02-31'"),
        _v("status", "value_not_in_choices", "st <> '' AND lower(st) NOT IN ('o', 'f')"),
        _v("total", "value_range_unparseable", "total <> '' AND TRY_CAST(regexp_replace(total, '[$,%]', '', 'g') AS DECIMAL(18,2)) IS NULL"),
        _v("total", "value_below_range", "TRY_CAST(regexp_replace(nullif(total, ''), '[$,%]', '', 'g') AS DECIMAL(18,2)) < 1000"),
        _v("total", "value_above_range", "TRY_CAST(regexp_replace(nullif(total, ''), '[$,%]', '', 'g') AS DECIMAL(18,2)) > 250000"),
        _v("status", "field_mismatch", "st <> '' AND pr <> '' AND regexp_replace(lower(st), '[^a-z0-9 ]+', '', 'g') <> regexp_replace(lower(pr), '[^a-z0-9 ]+', '', 'g')"),
        _v("order_date", "date_order_unparseable", "d <> '' AND TRY_CAST(d AS DATE) IS NULL"),
        _v("order_date", "date_order_violation", "TRY_CAST(d AS DATE) >= DATE '1996-01-01'"),
        _v("priority", "regex_match_failed", "form_id = 'FX-003' AND pr <> '' AND NOT starts_with(pr, '1-')"),
        _v("priority", "regex_match_unknown_pattern", "form_id = 'FX-005' AND pr <> ''"),
        _v("status", "bad_bar_number", "st <> ''", "warn"),
    ]),
)
def validate_by_table(t: Tables):
    """Rules and patterns as tables; every record is due on one day."""
    due = t.answer.select("record_id", "form_id").distinct().select("record_id", "form_id", F.lit("due_date").alias("field_id"), F.lit("1996-01-01").alias("value"))
    rules = t.spark.createDataFrame(list(RULE_ROWS), tables.RULES)
    patterns = t.spark.createDataFrame(list(PATTERN_ROWS), tables.PATTERNS)
    return tables.validate_rows(t.answer.select("record_id", "form_id", "field_id", "value").unionByName(due), rules, patterns)


FILL_ROWS = (
    (None, "^total$", "0.00", 0.5, "no-total", 2),
    ("FX-003", "^total$", "1.00", 0.9, "own-total", 1),
    (None, "(^|_)date$", "2024-01-01", 0.7, "a-date", 1),
    ("FX-005", "^status$", "", 0.7, "empty", 1),
)


@query(
    uses="answer",
    sql="""SELECT record_id, form_id, field_id, CASE WHEN coalesce(trim(value), '') <> '' THEN value WHEN field_id = 'total' AND form_id = 'FX-003' THEN '1.00' WHEN field_id = 'total' THEN '0.00' WHEN field_id = 'order_date' THEN '2024-01-01' ELSE value END AS value,
  CAST(CASE WHEN coalesce(trim(value), '') <> '' THEN 0.6 WHEN field_id = 'total' AND form_id = 'FX-003' THEN 0.9 WHEN field_id = 'order_date' THEN 0.7 ELSE 0.6 END AS DOUBLE) AS confidence,
  CASE WHEN coalesce(trim(value), '') <> '' THEN '' WHEN field_id = 'total' AND form_id = 'FX-003' THEN 'own-total' WHEN field_id = 'total' THEN 'no-total' WHEN field_id = 'order_date' THEN 'a-date' ELSE '' END AS methods
FROM (SELECT record_id, form_id, field_id, CASE WHEN record_id % 3 > 0 THEN value END AS value FROM answer)""",
)
def fill_by_table(t: Tables):
    blank = t.answer.select(
        "record_id", "form_id", "field_id", F.when(F.col("record_id") % 3 > 0, F.col("value")).alias("value"), F.lit(0.6).alias("confidence"),
        F.array().cast("array<struct<from:string,to:string,method:string>>").alias("provenance"),
    )
    filled = tables.fill_from_rows(blank, t.spark.createDataFrame(list(FILL_ROWS), tables.FILLS))
    return filled.select("record_id", "form_id", "field_id", "value", "confidence", F.array_join("provenance.method", ",").alias("methods"))


SLOTTED = """WITH f AS (SELECT form_id, CASE seq % 3 WHEN 0 THEN 'heir' WHEN 1 THEN 'asset' ELSE 'debt' END AS e, CASE WHEN size % 2 = 0 THEN 'desc' ELSE 'amount' END AS a, seq % 5 + 1 AS i, seq, size % 4 AS k FROM field),
n AS (SELECT DISTINCT form_id, e, a, CASE WHEN k = 3 THEN 'plain_' || CAST(seq AS VARCHAR) || '_x' ELSE e || '_' || CAST(i AS VARCHAR) || '_' || a END AS field_id,
  CASE k WHEN 0 THEN 'computed' WHEN 1 THEN 'case_constant' WHEN 2 THEN 'narrative_derived' ELSE 'legal_choice' END AS category, k FROM f)"""


@query(
    uses="field",
    sql=f"""{SLOTTED}, d AS (SELECT form_id, list_sort(list(DISTINCT e)) AS fam FROM n WHERE k < 3 AND a = 'desc' GROUP BY form_id)
SELECT n.form_id, field_id, category, concat_ws('|', CASE WHEN k = 3 THEN 'value_in(yes, no)' END, CASE WHEN k < 3 AND a = 'desc' THEN 'dedupe_within(' || e || '_desc)' END,
  CASE WHEN k < 3 AND a = 'desc' AND len(list_filter(fam, lambda x: x <> e)) > 0 THEN 'cross_section_dedupe(' || array_to_string(list_transform(list_filter(fam, lambda x: x <> e), lambda x: x || '_desc'), ',') || ')' END,
  CASE WHEN k < 3 AND a = 'amount' THEN 'nonempty_if_desc' END, CASE WHEN k = 0 THEN 'recompute_from_dependencies' END, CASE WHEN k = 1 THEN 'populate_from_case_dict' END) AS tags
FROM n LEFT JOIN d ON n.form_id = d.form_id""",
)
def default_validators(t: Tables):
    k = F.col("size") % 4
    entity = F.when(F.col("seq") % 3 == 0, "heir").when(F.col("seq") % 3 == 1, "asset").otherwise("debt")
    attr = F.when(F.col("size") % 2 == 0, "desc").otherwise("amount")
    name = F.when(k == 3, F.concat(F.lit("plain_"), F.col("seq").cast("string"), F.lit("_x"))).otherwise(
        F.concat_ws("_", entity, (F.col("seq") % 5 + 1).cast("string"), attr)
    )
    fields = t.field.select(
        "form_id", name.alias("field_id"),
        F.when(k == 0, "computed").when(k == 1, "case_constant").when(k == 2, "narrative_derived").otherwise("legal_choice").alias("category"),
        F.when(k == 3, "yes_no").otherwise("repeating_slot").alias("subcategory"),
    ).distinct()
    tagged = val.default_validators(fields).distinct()
    return fields.join(tagged, ["form_id", "field_id"]).where(
        # a name may carry several categories here; keep the tags made for its own
        (F.array_contains("validators", "recompute_from_dependencies") == (F.col("category") == "computed"))
        & (F.array_contains("validators", "populate_from_case_dict") == (F.col("category") == "case_constant"))
    ).select("form_id", "field_id", "category", F.array_join("validators", "|").alias("tags"))
