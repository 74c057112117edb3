"""Resolution and repair over cases and answers derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formloom.operators import diffs, records
from formloom.operators import validation as val
from formloom.operators.pairs import dealt
from formloom.plans.registry import query
from formloom.plans.reports import SLOTS, _slot_names
from formloom.plans.scalars import BOUND, _bound
from formloom.sources.testdata import Tables


def _customers(t: Tables):
    """A file of one split, whose rows give some 20 facts and fields each."""
    return dealt(t.raw("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "c_custkey")


def _cases(t: Tables):
    """Customers as cases: party maps by key, matter and narrative facts."""
    c = _customers(t)
    k = F.col("c_custkey")
    n = F.col("c_nationkey").cast("string")
    kv = lambda **p: F.create_map(*[x for a, b in p.items() for x in (F.lit(a), b)])
    heir = kv(full_name=F.col("c_name"), phone=F.concat(F.lit("207555"), n), dob=F.lit("1960-01-02"))
    owner = kv(first_name=F.col("c_mktsegment"), last_name=F.concat(F.lit("L"), n), street=F.concat(n, F.lit(" Elm")), email=F.lit(""))
    return c.select(
        k.alias("case_id"),
        F.col("c_mktsegment").alias("case_type"),
        F.when(k % 2 == 0, F.create_map(F.lit("heir"), heir, F.lit("owner"), owner)).otherwise(F.create_map(F.lit("owner"), owner)).alias("parties"),
        F.create_map(F.lit("county"), F.concat(F.lit("C"), n)).alias("matter"),
        F.when(k % 3 == 0, F.create_map(F.lit("cause"), F.col("c_mktsegment"), F.lit("choice_1"), F.lit("Yes"))).otherwise(F.create_map(F.lit("cause"), F.lit(""))).alias("facts"),
    )


FACTS = """WITH c AS (SELECT c_custkey AS case_id, c_mktsegment AS seg, c_name AS nm, CAST(c_nationkey AS VARCHAR) AS n FROM customer),
facts AS (SELECT case_id, 'heir_record' AS namespace, unnest(['heir', 'heir_name', 'heir_phone', 'heir_phone_number', 'heir_telephone', 'heir_date_of_birth']) AS key,
    unnest([nm, nm, '207555' || n, '207555' || n, '207555' || n, '1960-01-02']) AS value FROM c WHERE case_id % 2 = 0
  UNION ALL SELECT case_id, 'owner_record', unnest(['owner', 'owner_name', 'owner_address']), unnest([seg || ' L' || n, seg || ' L' || n, n || ' Elm']) FROM c
  UNION ALL SELECT case_id, 'case_dict', 'county', 'C' || n FROM c
  UNION ALL SELECT case_id, 'narrative_facts', unnest(['cause', 'choice_1']), unnest([seg, 'Yes']) FROM c WHERE case_id % 3 = 0)"""


@query(sql=f"{FACTS} SELECT * FROM facts")
def facts_from_parties(t: Tables):
    return records.facts_from_parties(_cases(t))


# One form per market segment: (field, source, formula?, when)
FORM_FIELDS = (
    ("county", "case_dict.county", False, None),
    ("heir_phone", "heir_record.heir", False, None),
    ("heir_full_name", "heir_record.heir", False, None),
    ("heir_email", "heir_record.heir", False, "heir_full_name"),
    ("owner_line", "owner_record.owner.name_and_address", False, "county == 'C3'"),
    ("owner_addr", "owner_record.owner.address", False, "county != 'C4'"),
    ("cause", "llm_over_narrative", False, "choice_1 == true"),
    ("heir_date_of_birth", "llm_over_narrative", False, "county in ['C1', 'C2', 'C7']"),
    ("sum", "recompute_from_dependencies", True, None),
    ("choice_1", "human_decision", False, None),
    ("sign", "wet_ink", False, None),
    ("odd", "unknown", False, None),
)


def _case_fields(t: Tables):
    spec = F.array(*[F.struct(F.lit(f).alias("field_id"), F.lit(s).alias("source"), F.lit(m).alias("has_formula")) for f, s, m, _ in FORM_FIELDS])
    return _customers(t).select(
        F.col("c_custkey").alias("case_id"), F.col("c_mktsegment").alias("form_id"), F.explode(spec).alias("s")
    ).select("case_id", "form_id", "s.*", F.lit(False).alias("llm_eligible"))


def _gates(t: Tables):
    spec = F.array(*[F.struct(F.lit(f).alias("field_id"), F.lit(w).alias("when")) for f, _, _, w in FORM_FIELDS if w])
    return t.raw("customer").select(F.col("c_mktsegment").alias("form_id")).distinct().select("form_id", F.explode(spec).alias("s")).select("form_id", "s.*")


PLAN = f"""{FACTS}, w AS (SELECT case_id, max(value) FILTER (namespace = 'case_dict' AND key = 'county') AS county, max(value) FILTER (key = 'heir_phone') AS hp, max(value) FILTER (key = 'heir') AS heir,
  max(value) FILTER (key = 'owner_name') AS o_n, max(value) FILTER (key = 'owner_address') AS o_a, max(value) FILTER (key = 'cause') AS cause, max(value) FILTER (key = 'choice_1') AS ch,
  max(value) FILTER (key = 'heir_date_of_birth') AS dob FROM facts GROUP BY case_id),
l AS (SELECT w.*, seg AS form_id FROM w JOIN c ON w.case_id = c.case_id),
r0 AS (SELECT case_id, form_id, county, heir, ch, unnest(['county', 'heir_phone', 'heir_full_name', 'heir_email', 'owner_line', 'owner_addr', 'cause', 'heir_date_of_birth', 'sum', 'choice_1', 'sign', 'odd']) AS field_id,
  unnest([county, hp, heir, NULL, concat_ws(', ', o_n, o_a), o_a, cause, dob, NULL, ch, NULL, NULL]) AS value,
  unnest(['unresolved', 'unresolved', 'unresolved', 'unresolved', 'unresolved', 'unresolved', 'narrative', 'narrative', 'recompute', 'blank', 'blank', 'unresolved']) AS b0,
  unnest(['case_record', 'case_record', 'case_record', 'case_record', 'case_record', 'case_record', 'narrative_composed', 'rescued_record_fact', '', 'human_decision', '', '']) AS o0 FROM l),
r AS (SELECT case_id, form_id, county, heir, ch, field_id, value, CASE WHEN value IS NOT NULL THEN 'resolved' ELSE b0 END AS bucket, CASE WHEN value IS NOT NULL THEN o0 END AS origin FROM r0),
g AS (SELECT *, CASE field_id WHEN 'heir_email' THEN heir IS NOT NULL AND lower(heir) IN ('no', 'false') WHEN 'owner_line' THEN county <> 'C3' WHEN 'owner_addr' THEN county = 'C4'
  WHEN 'cause' THEN ch IS NOT NULL AND ch <> 'Yes' WHEN 'heir_date_of_birth' THEN county NOT IN ('C1', 'C2', 'C7') ELSE false END AS off FROM r),
p AS (SELECT case_id, form_id, field_id, CASE WHEN off THEN 'skipped' ELSE bucket END AS bucket, CASE WHEN NOT off THEN value END AS value, CASE WHEN NOT off THEN origin END AS origin FROM g)"""


@query(sql=f"{PLAN} SELECT case_id, form_id, field_id, bucket, value, origin FROM r")
def resolve_fields(t: Tables):
    return records.resolve_fields(_case_fields(t), records.facts_from_parties(_cases(t)))


def _plan(t: Tables):
    facts = records.facts_from_parties(_cases(t))
    return records.apply_when(records.resolve_fields(_case_fields(t), facts), _gates(t), facts)


@query(sql=f"{PLAN} SELECT * FROM p")
def apply_when(t: Tables):
    return _plan(t)


@query(
    sql=f"""{PLAN} SELECT form_id, count(*) FILTER (bucket = 'resolved') AS resolved, count(*) FILTER (bucket = 'narrative') AS narrative, count(*) FILTER (bucket = 'recompute') AS recompute,
  count(*) FILTER (bucket = 'blank') AS blank, count(*) FILTER (bucket = 'unresolved') AS unresolved, count(*) FILTER (bucket = 'skipped') AS skipped FROM p GROUP BY form_id""",
)
def plan_coverage(t: Tables):
    return records.plan_coverage(_plan(t))


def _heirs(t: Tables):
    li = t.raw("lineitem").select(
        F.col("l_orderkey").alias("case_id"),
        F.struct(F.col("l_linenumber").alias("k"), F.col("l_partkey").alias("k2"), F.col("l_suppkey").alias("k3"), F.col("l_quantity").alias("k4"),
                 F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("name"),
                 F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_returnflag")).alias("share")).alias("it"),
    )
    lists = li.groupBy("case_id").agg(F.array_sort(F.collect_set("it")).alias("items"))
    return records.distribute_records(lists, "heir", ["name", "share"], cap=3)


HEIRS = """WITH d AS (SELECT DISTINCT l_orderkey AS case_id, l_linenumber, l_partkey, l_suppkey, l_quantity, 'P' || CAST(l_partkey AS VARCHAR) AS name, CASE WHEN l_returnflag = 'R' THEN '' ELSE l_returnflag END AS share FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, name, share) AS k FROM d)"""


@query(
    sql=f"""{HEIRS} SELECT case_id, 'heir_' || CAST(k AS VARCHAR) || '_name' AS field_id, name AS value FROM o WHERE k <= 3
UNION ALL SELECT case_id, 'heir_' || CAST(k AS VARCHAR) || '_share', share FROM o WHERE k <= 3 AND share <> ''""",
)
def distribute_records(t: Tables):
    return _heirs(t)[0]


@query(
    sql=f"""{HEIRS} SELECT case_id, string_agg(concat_ws(' — ', name, nullif(share, '')), '; ' ORDER BY k) AS overflow FROM o WHERE k > 3 GROUP BY case_id""",
)
def record_overflow(t: Tables):
    return _heirs(t)[1]


@query(
    sql="""WITH e AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'Semi-Monthly' WHEN 'view' THEN 'twice a month' WHEN 'error' THEN 'has_weekly_pay' WHEN 'signup' THEN 'weekly' ELSE 'zzz' END AS value FROM events)
SELECT event_id, value, CASE value WHEN 'Semi-Monthly' THEN 'semi_monthly' WHEN 'twice a month' THEN 'semi_monthly' WHEN 'has_weekly_pay' THEN 'weekly' END AS canonical,
  CASE value WHEN 'Semi-Monthly' THEN 'norm' WHEN 'twice a month' THEN 'stem' WHEN 'has_weekly_pay' THEN 'substring' END AS method FROM e""",
)
def canonicalize_enum(t: Tables):
    value = F.expr("CASE event_type WHEN 'click' THEN 'Semi-Monthly' WHEN 'view' THEN 'twice a month' WHEN 'error' THEN 'has_weekly_pay' WHEN 'signup' THEN 'weekly' ELSE 'zzz' END")
    choices = F.array(*[F.lit(c) for c in ("weekly", "semi_monthly", "yes")])
    e = t.raw("events").select("event_id", value.alias("value"))
    return e.withColumn("c", records.canonicalize_enum(F.col("value"), choices, {"twiceamonth": "semi_monthly"})).select("event_id", "value", "c.canonical", "c.method")


#: Priorities as people type them; DuckDB compares letters with a table of rows.
TYPED = "CASE record_id % 6 WHEN 0 THEN 'urgnt' WHEN 1 THEN 'high  priority' WHEN 2 THEN 'speciffied not' WHEN 3 THEN 'lo' WHEN 4 THEN 'MEDIUM!' ELSE 'quite else' END"
CHOICES = ("urgent", "high", "medium", "low", "not specified")


def _lcs_sql(a: str, b: str) -> str:
    row = f"list_reduce([list_transform(range(len({b}) + 1), lambda _: 0)] || list_transform(string_split({a}, ''), lambda c: list_concat([-1], list_transform(string_split({b}, ''), lambda d: (c = d)::INTEGER))), lambda row, hit: list_reduce([[0]] || list_transform(range(2, len(row) + 1), lambda j: [row[j - 1] + 1, row[j], hit[j]]), lambda new, x: list_append(new, CASE WHEN x[3] = 1 THEN x[1] ELSE greatest(x[2], new[-1]) END)))"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE ({row})[-1] END"


@query(
    uses="answer",
    sql=f"""WITH v AS (SELECT DISTINCT {TYPED} AS value FROM answer WHERE field_id = 'priority'), c AS (SELECT unnest(range(5)) AS k, unnest({list(CHOICES)}) AS choice),
n AS (SELECT value, k, choice, regexp_replace(lower(value), '[^a-z0-9]', '', 'g') AS nv, regexp_replace(choice, '[^a-z0-9]', '', 'g') AS nc,
  list_sort(list_distinct(list_filter(regexp_split_to_array(lower(value), ' +'), lambda x: x <> ''))) AS a, list_sort(list_distinct(string_split(choice, ' '))) AS b FROM v, c),
s AS (SELECT *, array_to_string(list_sort(list_intersect(a, b)), ' ') AS sh, array_to_string(list_filter(a, lambda x: NOT list_contains(b, x)), ' ') AS oa, array_to_string(list_filter(b, lambda x: NOT list_contains(a, x)), ' ') AS ob FROM n),
l AS (SELECT *, {_lcs_sql("oa", "ob")} AS common, length(concat_ws(' ', nullif(sh, ''), nullif(oa, ''))) AS la, length(concat_ws(' ', nullif(sh, ''), nullif(ob, ''))) AS lb, length(sh) AS ls FROM s),
f AS (SELECT *, CASE WHEN ls > 0 AND (oa = '' OR ob = '') THEN 100.0 ELSE greatest(200.0 * (ls + CASE WHEN ls > 0 THEN 1 ELSE 0 END + common) / (la + lb), CASE WHEN ls > 0 THEN 200.0 * ls / (ls + la) ELSE 0 END, CASE WHEN ls > 0 THEN 200.0 * ls / (ls + lb) ELSE 0 END) END AS score FROM l),
g AS (SELECT value, max(choice) FILTER (nv = nc) AS same, arg_max(choice, (length(nc), choice)) FILTER (contains(nv, nc) OR contains(nc, nv)) AS part, arg_max(choice, (score, -k)) AS best, max(score) AS score FROM f GROUP BY value)
SELECT record_id, form_id, field_id, g.value, coalesce(same, part, CASE WHEN score >= 85 THEN best END) AS canonical,
  CASE WHEN same IS NOT NULL THEN 'norm' WHEN part IS NOT NULL THEN 'substring' WHEN score >= 85 THEN 'fuzz:' || format('{{:.2f}}', score) END AS method
FROM answer JOIN g ON g.value = {TYPED} WHERE field_id = 'priority'""",
)
def canonicalize_answers(t: Tables):
    """Misspelt priorities: cut short, joined, turned round, with signs."""
    typed = t.answer.where("field_id = 'priority'").withColumn("value", F.expr(TYPED))
    choices = typed.select("form_id", "field_id").distinct().withColumn("choices", F.array(*[F.lit(c) for c in CHOICES]))
    return records.canonicalize_answers(typed, choices, {})


@query(
    uses="answer",
    sql=r"""WITH a AS (SELECT record_id, CASE record_id % 4 WHEN 0 THEN '$' || value WHEN 1 THEN 'none' WHEN 2 THEN 'paid $1,300.50 then left' ELSE value END AS v FROM answer WHERE field_id = 'total'),
s AS (SELECT record_id, v, CASE WHEN starts_with(v, '$') THEN substr(v, 2) ELSE v END AS st FROM a),
m AS (SELECT *, regexp_matches(trim(st), '^-?\$?\d{1,3}(,\d{3})*(\.\d{1,2})?$|^-?\$?\d+(\.\d{1,2})?$') AS money, regexp_replace(regexp_extract(st, '\$?\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?|\$\d+(?:\.\d{1,2})?'), '^\$+', '') AS found FROM s)
SELECT record_id, CASE WHEN st = 'none' THEN '' WHEN st <> '' AND NOT money THEN found WHEN starts_with(v, '$') THEN st END AS cleaned,
  CASE WHEN st = 'none' THEN 'clear-currency' WHEN st <> '' AND NOT money AND found <> '' THEN 'extract-currency' WHEN st <> '' AND NOT money THEN 'clear-currency-prose' WHEN starts_with(v, '$') THEN 'strip-currency-prefix' END AS method FROM m""",
)
def clean_currency(t: Tables):
    k = F.col("record_id") % 4
    v = F.when(k == 0, F.concat(F.lit("$"), "value")).when(k == 1, "none").when(k == 2, "paid $1,300.50 then left").otherwise(F.col("value"))
    a = t.answer.where("field_id = 'total'").select("record_id", records.clean_currency(v).alias("c"))
    return a.select("record_id", F.col("c.value").alias("cleaned"), "c.method")


GATED = """WITH a AS (SELECT record_id, form_id, field_id, value FROM answer UNION ALL SELECT record_id, form_id, 'scope', CASE WHEN record_id % 5 = 0 THEN 'given' ELSE '' END FROM answer WHERE field_id = 'total'),
d AS (SELECT record_id, form_id, count(*) AS n_deps, count(DISTINCT CASE WHEN field_id = 'priority' THEN 'limited' ELSE 'expanded' END) AS n_targets, min(CASE WHEN field_id = 'priority' THEN 'limited' ELSE 'expanded' END) AS target
  FROM a WHERE field_id IN ('priority', 'status') AND trim(value) <> '' AND NOT (field_id = 'status' AND value = 'O') GROUP BY ALL)"""


@query(
    uses="answer",
    sql=f"""{GATED} SELECT d.record_id, d.form_id, 'scope' AS gate, CASE WHEN n_targets > 1 THEN 'conflict' ELSE 'inferred' END AS action, CASE WHEN n_targets = 1 THEN target END AS value, n_deps
FROM d JOIN a ON a.record_id = d.record_id AND a.field_id = 'scope' AND a.value = ''""",
)
def infer_gates(t: Tables):
    scope = t.answer.where("field_id = 'total'").select("record_id", "form_id", F.lit("scope").alias("field_id"), F.when(F.col("record_id") % 5 == 0, "given").otherwise("").alias("value"))
    answers = t.answer.withColumn("value", F.when((F.col("field_id") == "status") & (F.col("value") == "O"), "").otherwise(F.col("value"))).unionByName(scope)
    dep = F.array(*[F.struct(F.lit(f).alias("field_id"), F.lit("scope").alias("gate"), F.lit(x).alias("target")) for f, x in (("priority", "limited"), ("status", "expanded"))])
    deps = t.answer.select("form_id").distinct().select("form_id", F.explode(dep).alias("d")).select("form_id", "d.*")
    return records.infer_gates(answers, deps)


def _blankable(t: Tables):
    """Answers renamed so that dates, words and contacts are blank by key."""
    name = F.expr("CASE field_id WHEN 'order_date' THEN 'owner_signature_date' WHEN 'priority' THEN 'filed_day' WHEN 'status' THEN 'agent_email' ELSE 'agent_bar_no' END")
    value = F.when(F.col("record_id") % 3 == 0, F.col("value")).when(F.col("record_id") % 3 == 1, " ")
    return t.answer.select(
        "record_id", "form_id", name.alias("field_id"), value.alias("value"), F.lit(0.5).alias("confidence"),
        F.array().cast("array<struct<from:string,to:string,method:string>>").alias("provenance"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("record_id") % 700).cast("int")).alias("event_date"),
        F.concat(F.lit("Agent "), (F.col("record_id") % 50).cast("string")).alias("person"),
    )


def _filled(t: Tables):
    rules = records.date_pack(F.col("event_date")) + records.contact_pack(F.col("person"), ["a.test", "b.test"])
    return records.fill_if_blank(_blankable(t), rules)


@query(
    uses="answer",
    sql="""WITH b AS (SELECT record_id, form_id, CASE field_id WHEN 'order_date' THEN 'owner_signature_date' WHEN 'priority' THEN 'filed_day' WHEN 'status' THEN 'agent_email' ELSE 'agent_bar_no' END AS field_id,
  CASE record_id % 3 WHEN 0 THEN value WHEN 1 THEN ' ' END AS value, DATE '2024-01-01' + CAST(record_id % 700 AS INTEGER) AS d, 'Agent ' || CAST(record_id % 50 AS VARCHAR) AS person FROM answer),
f AS (SELECT *, value IS NULL OR trim(value) = '' AS blank, CASE field_id WHEN 'owner_signature_date' THEN strftime(d, '%Y-%m-%d') WHEN 'filed_day' THEN strftime(d, '%-d')
  WHEN 'agent_email' THEN replace(lower(person), ' ', '.') || '@' || list_extract(['a.test', 'b.test'], 1 + CAST(('0x' || substr(sha256(person), 1, 8))::BIGINT % 2 AS INTEGER))
  ELSE lpad(CAST(1000 + ('0x' || substr(sha256(person), 1, 8))::BIGINT % 9000 AS VARCHAR), 4, '0') END AS made FROM b)
SELECT record_id, form_id, field_id, CASE WHEN blank THEN made ELSE value END AS value, CASE WHEN NOT blank THEN 0.5 WHEN field_id = 'owner_signature_date' THEN 0.85 WHEN field_id = 'filed_day' THEN 0.8 ELSE 0.7 END::DOUBLE AS confidence,
  CASE WHEN blank THEN CASE field_id WHEN 'owner_signature_date' THEN 'signature-date' WHEN 'filed_day' THEN 'date-word' WHEN 'agent_email' THEN 'seeded-email' ELSE 'seeded-bar' END END AS method FROM f""",
)
def fill_if_blank(t: Tables):
    return _filled(t).select("record_id", "form_id", "field_id", "value", "confidence", F.try_element_at(F.col("provenance.method"), F.lit(1)).alias("method"))


@query(
    uses="answer",
    sql="""SELECT CASE field_id WHEN 'order_date' THEN 'signature-date' WHEN 'priority' THEN 'date-word' WHEN 'status' THEN 'seeded-email' ELSE 'seeded-bar' END AS method, count(*) AS n
FROM answer WHERE record_id % 3 <> 0 OR trim(value) = '' GROUP BY ALL""",
)
def repair_provenance(t: Tables):
    return records.merge_provenance(_filled(t))


def _line_answers(t: Tables):
    """Line items as numbered rows of their order, plus a blank total."""
    li = t.raw("lineitem").groupBy(F.col("l_orderkey").alias("record_id"), "l_linenumber").agg(F.sum(F.floor("l_extendedprice")).cast("string").alias("value"), F.max("l_returnflag").alias("flag"))
    form = F.lit("INV").alias("form_id")
    name = lambda attr: F.concat(F.lit("row_"), F.col("l_linenumber").cast("string"), F.lit(attr)).alias("field_id")
    amount = F.struct(name("_amount"), F.col("value"))
    desc = F.struct(name("_desc"), F.when(F.col("flag") == "R", "").otherwise(F.col("flag")).alias("value"))
    lines = li.select("record_id", form, F.inline(F.array(amount, desc)))
    total = t.raw("orders").select(F.col("o_orderkey").alias("record_id"), form, F.lit("grand_total").alias("field_id"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.floor("o_totalprice").cast("string")).alias("value"))
    return lines.unionByName(total)


LINES = """WITH li AS (SELECT l_orderkey AS record_id, l_linenumber AS k, CAST(sum(floor(l_extendedprice)) AS BIGINT) AS amt, max(l_returnflag) AS flag FROM lineitem GROUP BY ALL),
tot AS (SELECT o_orderkey AS record_id, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS v FROM orders)"""


@query(
    sql=f"""{LINES}, s AS (SELECT record_id, sum(amt) AS s, count(*) AS n_rows FROM li GROUP BY record_id)
SELECT t.record_id, 'INV' AS form_id, 'grand_total' AS field_id, format('{{:,}}', CAST(s AS BIGINT)) || '.00' AS value, n_rows FROM tot t JOIN s ON t.record_id = s.record_id WHERE v = ''""",
)
def derive_totals(t: Tables):
    return records.derive_totals(_line_answers(t), r"^row_\d+_amount$", "grand_total")


TOTAL = {"op": "sum_slot", "prefix": "row", "suffix": "amount", "from": 1, "to": 7}
FORMULAS = {
    "grand_total": TOTAL,
    "net": {"op": "sub", "args": [{"op": "field", "id": "grand_total"}, {"op": "const", "value": 100}]},
    "share": {"op": "if", "cond": {"op": "field", "id": "row_1_amount"}, "then": {"op": "div", "args": [{"op": "field", "id": "net"}, {"op": "const", "value": 4}]}, "else": {"op": "const", "value": 0}},
}


@query(
    sql=f"""{LINES}, w AS (SELECT r.record_id, coalesce(sum(amt), 0) AS s, coalesce(max(amt) FILTER (k = 1), 0) AS first, any_value(v) AS v FROM (SELECT record_id FROM li UNION SELECT record_id FROM tot) r
  LEFT JOIN li ON r.record_id = li.record_id LEFT JOIN tot ON r.record_id = tot.record_id GROUP BY r.record_id),
c AS (SELECT record_id, s, first, coalesce(v, '') AS v, CASE WHEN coalesce(v, '') = '' OR abs(CAST(v AS BIGINT) - s) >= 0.01 THEN 1 ELSE 0 END AS wr FROM w)
SELECT record_id, 'INV' AS form_id, 'grand_total' AS field_id, v AS old_value, format('{{:,.2f}}', CAST(s AS DOUBLE)) AS new_value FROM c WHERE wr = 1
UNION ALL SELECT record_id, 'INV', 'net', '', format('{{:,.2f}}', CAST(s - 100 AS DOUBLE)) FROM c
UNION ALL SELECT record_id, 'INV', 'share', '', format('{{:,.2f}}', CASE WHEN first <> 0 THEN CAST(s - 100 AS DOUBLE) / 4 ELSE 0 END) FROM c""",
)
def recompute_totals(t: Tables):
    return val.recompute_totals(_line_answers(t), FORMULAS)


@query(
    sql=f"""{LINES}, w AS (SELECT r.record_id, coalesce(sum(amt), 0) AS s, any_value(v) AS v FROM (SELECT record_id FROM li UNION SELECT record_id FROM tot) r
  LEFT JOIN li ON r.record_id = li.record_id LEFT JOIN tot ON r.record_id = tot.record_id GROUP BY r.record_id),
c AS (SELECT record_id, coalesce(v, '') AS v, CASE record_id % 3 WHEN 0 THEN s WHEN 1 THEN s + 7 END AS want, CASE record_id % 3 WHEN 0 THEN 'INV' ELSE 'TAX' END AS form_id FROM w WHERE record_id % 3 < 2)
SELECT record_id, form_id, 'grand_total' AS field_id, v AS old_value, format('{{:,.2f}}', CAST(want AS DOUBLE)) AS new_value FROM c WHERE v = '' OR abs(CAST(v AS BIGINT) - want) >= 0.01""",
)
def recompute_by_form(t: Tables):
    """Two forms with different formulas for one field; a third has none."""
    form = F.expr("CASE record_id % 3 WHEN 0 THEN 'INV' WHEN 1 THEN 'TAX' ELSE 'NONE' END")
    plus = {"op": "add", "args": [TOTAL, {"op": "const", "value": 7}]}
    return val.recompute_by_form(_line_answers(t).withColumn("form_id", form), {"INV": {"grand_total": TOTAL}, "TAX": {"grand_total": plus}})


@query(
    uses="answer",
    sql="""WITH a AS (SELECT record_id // 4 AS case_id, form_id || '-' || CAST(record_id % 4 AS VARCHAR) AS form_id, field_id, CASE WHEN record_id % 3 = 0 THEN '' ELSE value END AS value FROM answer),
d AS (SELECT case_id, field_id, min((form_id, value)) AS d FROM a WHERE trim(value) <> '' GROUP BY ALL)
SELECT a.case_id, a.form_id, a.field_id, d[2] AS value, d[1] AS from_form FROM a JOIN d ON a.case_id = d.case_id AND a.field_id = d.field_id WHERE trim(a.value) = ''""",
)
def cross_form_fill(t: Tables):
    a = t.answer.select(
        F.expr("record_id DIV 4").alias("case_id"), F.concat_ws("-", "form_id", (F.col("record_id") % 4).cast("string")).alias("form_id"), "field_id",
        F.when(F.col("record_id") % 3 == 0, "").otherwise(F.col("value")).alias("value"),
    )
    return records.cross_form_fill(a)


@query(
    uses="field",
    sql="""WITH r AS (SELECT DISTINCT form_id, CASE WHEN size % 3 = 0 THEN 'no_' || field_id ELSE field_id END AS current, CASE WHEN size % 2 = 0 THEN replace(label, ' ', '_') || '_1' ELSE 'new_' || field_id END AS suggested FROM field)
SELECT r.*, CASE WHEN NOT EXISTS (SELECT 1 FROM field f WHERE f.form_id = r.form_id AND f.field_id = current) THEN 'not_found'
  WHEN suggested <> current AND EXISTS (SELECT 1 FROM field f WHERE f.form_id = r.form_id AND f.field_id = suggested) THEN 'collision' ELSE 'applied' END AS outcome FROM r""",
)
def apply_rename_fixes(t: Tables):
    renames = t.field.select(
        "form_id", F.when(F.col("size") % 3 == 0, F.concat(F.lit("no_"), "field_id")).otherwise(F.col("field_id")).alias("current"),
        F.when(F.col("size") % 2 == 0, F.concat(F.regexp_replace("label", " ", "_"), F.lit("_1"))).otherwise(F.concat(F.lit("new_"), "field_id")).alias("suggested"),
    ).distinct()
    return records.apply_rename_fixes(t.field, renames)


@query(
    uses="field",
    sql="""WITH a AS (SELECT DISTINCT field_id, 'g_' || field_id AS n FROM field WHERE ends_with(field_id, '3')),
o AS (SELECT DISTINCT form_id, field_id, 'o_' || field_id AS n FROM field WHERE form_id IN ('Brand#1', 'Brand#2'))
SELECT f.form_id, f.field_id, f.seq, coalesce(o.n, a.n, f.field_id) AS new_name FROM field f LEFT JOIN o ON f.form_id = o.form_id AND f.field_id = o.field_id LEFT JOIN a ON f.field_id = a.field_id""",
)
def alias_rename(t: Tables):
    names = t.field.select("form_id", "field_id", "seq")
    aliases = t.field.where("field_id LIKE '%3'").select("field_id", F.concat(F.lit("g_"), "field_id").alias("new_name")).distinct()
    overrides = t.field.where("form_id IN ('Brand#1', 'Brand#2')").select("form_id", "field_id", F.concat(F.lit("o_"), "field_id").alias("new_name")).distinct()
    return records.alias_rename(names, aliases, overrides)


@query(
    uses="answer",
    sql="""WITH p AS (SELECT record_id, field_id, CASE WHEN field_id = 'status' THEN 'red;blue' ELSE value END AS value, field_id = 'status' AS multi FROM answer WHERE value <> ''),
g AS (SELECT record_id, field_id, value, CASE record_id % 5 WHEN 0 THEN NULL WHEN 1 THEN upper(value) WHEN 2 THEN left(value, 3) WHEN 3 THEN CASE WHEN multi THEN 'blue; red' ELSE 'x' || value END ELSE value END AS got, multi FROM p)
SELECT record_id, field_id, value, got, CASE WHEN got IS NULL THEN 'missing' WHEN lower(value) = lower(got) THEN 'match' WHEN multi AND record_id % 5 = 3 THEN 'match'
  WHEN length(got) < length(value) AND starts_with(lower(value), lower(got)) THEN 'overflowed' ELSE 'mismatch' END AS status FROM g""",
)
def plan_vs_readback(t: Tables):
    k = F.col("record_id") % 5
    planned = t.answer.where("value <> ''").select(
        "record_id", "field_id", F.when(F.col("field_id") == "status", "red;blue").otherwise(F.col("value")).alias("value"), (F.col("field_id") == "status").alias("multi")
    )
    v = F.col("value")
    got = F.when(k == 1, F.upper(v)).when(k == 2, F.substring(v, 1, 3)).when(k == 3, F.when(F.col("multi"), "blue; red").otherwise(F.concat(F.lit("x"), v))).otherwise(v)
    whole = planned.where(k != 0).withColumn("got", got)
    # values with a space come back as two chained parts
    parts = whole.select("record_id", "field_id", F.posexplode(F.split("got", " ")).alias("part", "value"))
    return records.plan_vs_readback(planned, parts)


@query(
    sql="""WITH o AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'AA-1' WHEN 1 THEN 'BB-2' WHEN 2 THEN 'AA-9' ELSE 'ZZ-3' END AS form_id, c_mktsegment AS case_type FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT form_id, case_type, count(*) AS n FROM o WHERE (starts_with(form_id, 'AA') AND case_type NOT IN ('BUILDING', 'MACHINERY')) OR (starts_with(form_id, 'BB') AND case_type <> 'HOUSEHOLD') GROUP BY ALL""",
)
def stale_outputs(t: Tables):
    form = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'AA-1' WHEN 1 THEN 'BB-2' WHEN 2 THEN 'AA-9' ELSE 'ZZ-3' END")
    outputs = t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey")).select(form.alias("form_id"), F.col("c_mktsegment").alias("case_type"))
    compat = t.spark.createDataFrame([("AA", "BUILDING"), ("AA", "MACHINERY"), ("BB", "HOUSEHOLD")], "prefix string, case_type string")
    return records.stale_outputs(outputs, compat)


@query(
    uses="rect",
    sql="""WITH f AS (SELECT form_id, field_id, min(part) % 3 = 0 AS given, min(q) % 2 = 0 AS locked, max(x0) AS mx FROM rect GROUP BY ALL)
SELECT form_id, field_id, locked, 0 AS idx, 0 AS page, mx AS x0, 1.0::DOUBLE AS y0, mx + 9 AS x1, 10.0::DOUBLE AS y1, 'explicit' AS source FROM f WHERE given
UNION ALL SELECT f.form_id, f.field_id, locked, CAST(row_number() OVER (PARTITION BY f.form_id, f.field_id ORDER BY page, y0, x0, rect_id) - 1 AS INTEGER), page, x0, y0, x1, y1, 'detected'
FROM f JOIN rect r ON f.form_id = r.form_id AND f.field_id = r.field_id WHERE NOT given""",
)
def bind_geometry(t: Tables):
    one = F.array(F.struct(F.lit(0).alias("page"), F.col("mx").alias("x0"), F.lit(1.0).alias("y0"), (F.col("mx") + 9).alias("x1"), F.lit(10.0).alias("y1")))
    none = F.array().cast("array<struct<page:int,x0:double,y0:double,x1:double,y1:double>>")
    fields = (
        t.rect.groupBy("form_id", "field_id")
        .agg((F.min("part") % 3 == 0).alias("given"), (F.min("q") % 2 == 0).alias("locked"), F.max("x0").alias("mx"))
        .withColumn("explicit", F.when(F.col("given"), one).otherwise(none))
    )
    return records.bind_geometry(fields, t.rect)


@query(
    uses="rect field",
    sql="""SELECT DISTINCT CAST(user_id AS VARCHAR) AS ref, 'event_without_case' AS reason FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT DISTINCT CAST(l_partkey AS VARCHAR), 'widget_without_field' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)
UNION ALL SELECT DISTINCT p_type, 'type_without_use' FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size > 60)""",
)
def dangling_references(t: Tables):
    ref = lambda df, c: df.select(F.col(c).alias("ref"))
    part = t.raw("part")
    return records.dangling_references(
        {
            "event_without_case": (ref(t.raw("events"), "user_id"), ref(t.raw("customer").where("c_acctbal > 0"), "c_custkey")),
            "widget_without_field": (ref(t.raw("lineitem"), "l_partkey"), ref(part.where("p_size > 5"), "p_partkey")),
            "type_without_use": (ref(part, "p_type"), ref(part.where("p_size > 60"), "p_type")),
        }
    )


@query()
def synthesize_cases(t: Tables):
    seeds = t.raw("customer").select(
        F.col("c_custkey").alias("case_id"), F.col("c_mktsegment").alias("case_type"), F.concat(F.lit("Brand#"), (F.col("c_custkey") % 25 + 1).cast("string")).alias("form_id")
    )
    # fields of odd slots (the number their id ends in) are the owner's
    role = F.when(F.col("seq") % 7 % 2 == 1, "owner").otherwise("heir")
    return records.synthesize_cases(seeds, ["heir", "owner"], ["Ana", "Ben", "Cleo"], ["Reed", "Stone"], t.field.withColumn("role", role))


@query(
    uses="answer",
    sql="""WITH b AS (SELECT record_id, form_id, CASE field_id WHEN 'order_date' THEN 'owner_age' WHEN 'priority' THEN 'venue_state' WHEN 'status' THEN 'printed_name' ELSE 'total' END AS field_id,
  CASE WHEN record_id % 2 = 0 THEN value END AS value, strftime(DATE '1950-01-01' + CAST(record_id % 9000 AS INTEGER), '%Y-%m-%d') AS dob FROM answer),
f AS (SELECT *, value IS NULL OR trim(value) = '' AS blank, CASE field_id WHEN 'owner_age' THEN CAST(date_diff('year', CAST(dob AS DATE), DATE '2024-06-15') - CASE WHEN strftime(CAST(dob AS DATE), '%m%d') > '0615' THEN 1 ELSE 0 END AS VARCHAR)
  WHEN 'venue_state' THEN 'Home State' WHEN 'printed_name' THEN 'Rec ' || CAST(record_id AS VARCHAR) END AS made FROM b)
SELECT record_id, form_id, field_id, CASE WHEN blank THEN coalesce(made, value) ELSE value END AS value FROM f""",
)
def fill_packs(t: Tables):
    """Constant, copy and age packs in one pass."""
    name = F.expr("CASE field_id WHEN 'order_date' THEN 'owner_age' WHEN 'priority' THEN 'venue_state' WHEN 'status' THEN 'printed_name' ELSE 'total' END")
    dob = F.date_add(F.lit("1950-01-01").cast("date"), (F.col("record_id") % 9000).cast("int"))
    a = t.answer.select(
        "record_id", "form_id", name.alias("field_id"), F.when(F.col("record_id") % 2 == 0, F.col("value")).alias("value"), F.lit(0.5).alias("confidence"),
        F.array().cast("array<struct<from:string,to:string,method:string>>").alias("provenance"), dob.alias("dob"),
        F.concat(F.lit("Rec "), F.col("record_id").cast("string")).alias("person"),
    )
    rules = (
        records.age_pack(F.col("dob"), F.lit("2024-06-15").cast("date"))
        + records.constant_pack([("^venue_state$", "Home State", "venue")])
        + records.copy_pack([("^printed_name$", F.col("person"), "copied-name")])
    )
    return records.fill_if_blank(a, rules).select("record_id", "form_id", "field_id", "value")
