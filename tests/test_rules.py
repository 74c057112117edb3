"""Counter-examples and adversarial values for rules, dates and numbers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from formloom.functions import values as V
from formloom.operators import records
from formloom.operators import validation as val


def one(spark, column_of, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("v")).alias("x")).collect()]


def codes(spark, values, *rules):
    rows = [(1, "F", k, v) for k, v in values.items()]
    df = spark.createDataFrame(rows, "record_id int, form_id string, field_id string, value string")
    return sorted((r.field_id, r.code) for r in val.validate(df, list(rules)).collect())


def test_dates(spark):
    good = ["2025-04-02", "4/2/2025", "04/02/25", "April 2, 2025", "Apr 2, 2025", "April 2 2025", "2 April 2025"]
    assert one(spark, V.parse_date_any, *good) == [dt.date(2025, 4, 2)] * len(good)
    bad = ["2024-02-31", "13/45/2024", "Foo 2, 2025", "", "soon", "2025-04", "April 31, 2025", None]
    assert one(spark, V.parse_date_any, *bad) == [None] * len(bad)
    assert one(spark, V.parse_date_any, "1/1/69", "1/1/68") == [dt.date(1969, 1, 1), dt.date(2068, 1, 1)]


def test_numbers(spark):
    got = one(spark, V.parse_number, "$1,200.50", "(75)", "12%", "", "abc", None)
    assert [None if g is None else float(g) for g in got] == [1200.5, -75.0, 12.0, None, None, None]
    assert one(spark, V.extract_currency, "about $1,200.50 or so", "$75", "none", "1,000") == ["1,200.50", "75", "", "1,000"]


def test_date_rules(spark):
    date = val.Rule("d", "date")
    assert codes(spark, {"d": "2024-02-31"}, date) == [("d", "impossible_date")]
    assert codes(spark, {"d": "soonish"}, date) == [("d", "bad_date")]
    assert codes(spark, {"d": ""}, date) == []
    order = val.parse_tag("death", "date_order(birth, >)")
    assert codes(spark, {"death": "1990-01-01", "birth": "2000-01-01"}, order) == [("death", "date_order_violation")]
    assert codes(spark, {"death": "2000-13-01", "birth": "1990-01-01"}, order) == [("death", "date_order_unparseable")]
    assert codes(spark, {"death": "", "birth": "1990-01-01"}, order) == []


def test_choices_and_equality(spark):
    yes = val.parse_tag("c", "value_in(yes, no)")
    assert codes(spark, {"c": "X"}, yes) == []
    assert codes(spark, {"c": "maybe"}, yes) == [("c", "value_not_in_choices")]
    caption = val.parse_tag("a", "equals_field(b, caption)")
    assert codes(spark, {"a": "Estate of Ana Reed", "b": "ana  reed."}, caption) == []
    assert codes(spark, {"a": "Estate of Ana Reed", "b": "Ben Reed"}, caption) == [("a", "field_mismatch")]
    assert codes(spark, {"a": "", "b": "Ben"}, caption) == []


def test_conditions(spark):
    need = val.Rule("x", "required_when", ({"all_of": [{"field": "box", "equals": True}, {"field": "n", "gte": 10}]},))
    assert codes(spark, {"box": "Yes", "n": "$1,000", "x": ""}, need) == [("x", "missing_required")]
    assert codes(spark, {"box": "off", "n": "1000", "x": ""}, need) == []
    assert codes(spark, {"box": "yes", "n": "ten", "x": ""}, need) == []
    never = val.Rule("x", "writable_when", ({"none_of": [{"field": "box", "equals": True}]},))
    assert codes(spark, {"box": "x", "x": "filled"}, never) == [("x", "not_writable")]


def test_formulas(spark):
    tree = {"op": "div", "args": [{"op": "sum_slot", "prefix": "r", "suffix": "v", "from": 1, "to": 2}, {"op": "field", "id": "d"}]}
    rule = val.Rule("t", "recompute", (tree,))
    assert codes(spark, {"r_1_v": "60", "r_2_v": "40", "d": "2", "t": "50"}, rule) == []
    assert codes(spark, {"r_1_v": "60", "r_2_v": "", "d": "2", "t": "500"}, rule) == [("t", "recompute_mismatch")]
    assert codes(spark, {"r_1_v": "60", "r_2_v": "40", "d": "0", "t": "500"}, rule) == []
    assert codes(spark, {"r_1_v": "n/a", "r_2_v": "40", "d": "2", "t": "500"}, rule) == []
    assert codes(spark, {"r_1_v": "60", "r_2_v": "40", "d": "2", "t": "plenty"}, rule) == [("t", "non_numeric")]


def test_formula_levels():
    f = lambda *ids: {"op": "add", "args": [{"op": "field", "id": i} for i in ids]}
    assert val.formula_levels({"c": f("a", "b"), "d": f("c"), "e": f("x")}) == [["c", "e"], ["d"]]
    with pytest.raises(ValueError, match="cycle"):
        val.formula_levels({"a": f("b"), "b": f("a")})


def test_wrap_and_address(spark):
    caps = F.array(F.lit(5), F.lit(9))
    got = one(spark, lambda v: V.wrap_lines(v, caps), "one two three four", "extraordinary", "", "wonderful you")
    assert [(list(g.lines), g.rest) for g in got] == [
        (["one", "two three"], "four"), (["", ""], "extraordinary"), (["", ""], ""), (["", "wonderful"], "you"),
    ]
    assert one(spark, lambda v: V.split_address(v, 2), "1 Elm St, Bath, ME 04530", "nowhere") == [["1 Elm St", "Bath, ME 04530"], ["nowhere", ""]]


def test_enum_layers(spark):
    choices = F.array(F.lit("minor_only"), F.lit("adult_only"), F.lit("yes"))
    got = one(spark, lambda v: records.canonicalize_enum(v, choices, {"haskids": "minor_only"}), "Minor Only", "has kids", "the adult only one", "yes", "zzz")
    assert [g and (g.canonical, g.method) for g in got] == [("minor_only", "norm"), ("minor_only", "stem"), ("adult_only", "substring"), None, None]


def test_supplied_values_win(spark):
    df = spark.createDataFrame([(1, "a_date", "2020-01-01", 0.9), (2, "a_date", " ", 0.1)], "record_id int, field_id string, value string, confidence double").withColumn(
        "provenance", F.array().cast("array<struct<from:string,to:string,method:string>>")
    )
    rule = records.FillRule("_date$", F.lit("2024-05-05"), 0.85, "event")
    got = {r.record_id: (r.value, r.confidence, len(r.provenance)) for r in records.fill_if_blank(df, [rule]).collect()}
    assert got == {1: ("2020-01-01", 0.9, 0), 2: ("2024-05-05", 0.85, 1)}


def test_rules_of_one_form_leave_others_alone(spark):
    answers = spark.createDataFrame([(1, "a", "x", "1"), (2, "b", "y", "2"), (3, "a", "z", "")], "record_id long, form_id string, field_id string, value string")
    fields = spark.createDataFrame(
        [("a", "x", '{"any_of": [{"field": "q", "exists": false}]}', None, None, "value_in(5); date_order(x, <)"), ("b", "x", None, None, None, '["regex_match(zip)"]')],
        "form_id string, field_id string, required_when string, writable_when string, formula string, validators string",
    )
    rules = val.rules_from_packages(fields)
    assert {(r.form_id, r.kind) for r in rules} == {("a", "required_when"), ("a", "value_in"), ("a", "date_order"), ("b", "regex_match")}
    asked = spark.createDataFrame([(9, "a"), (8, "b")], "record_id long, form_id string")
    found = {(r.record_id, r.code) for r in val.validate(answers, rules, asked).collect()}
    assert found == {(1, "value_not_in_choices"), (1, "date_order_unparseable"), (3, "missing_required"), (9, "missing_required")}
    assert val.validate(answers, [val.Rule("x", "docket_number")]).count() == 0


def test_wide_families(monkeypatch):
    monkeypatch.setattr(val, "FAMILY_FIELDS", 2)
    rules = [val.Rule(f"f{i}", "date", (), f"form{i % 3}") for i in range(6)] + [val.Rule("any", "date")]
    assert [len(f) for f in val.rule_families(rules)] == [1, 2, 2, 2]
