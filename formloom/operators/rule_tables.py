"""Rules, named patterns and fill packs as tables.

Nothing here is read on the driver: declared tags are parsed by Spark into rows,
rules meet answers by form and field, patterns by name.  A rule without a form
holds for all forms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formloom.functions import values as V
from formloom.functions.text import present
from formloom.operators.pairs import dealt
from formloom.operators.validation import CAPTION, DATE_SHAPE, EMAIL, PHONE, TAGS

ANY = "*"
#: Rules up to which they are sent to all tasks.
BROADCAST_RULES = 1 << 14
RULES = "form_id string, field_id string, kind string, args array<string>"
PATTERNS = "name string, pattern string"
FILLS = "form_id string, field_pattern string, text string, confidence double, method string, priority int"
#: Kinds that a list of names or values belongs to as a whole.
LISTED = ("value_in", "cross_section_dedupe")


def tag_rows(fields: DataFrame) -> DataFrame:
    """Validator tags of form packages as rules (form_id, field_id, kind, args).

    ``validators`` is a JSON list or text parted by "|" or ";".  Unknown tags
    give no rule.
    """
    text = F.trim("validators")
    split = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.split(text, r"[|;]"))
    tags = fields.where(present(F.col("validators"))).select("form_id", "field_id", F.explode(split).alias("tag"))
    tags = tags.withColumn("tag", F.trim("tag"))
    kind, args = F.lit(None).cast("string"), F.array().cast("array<string>")
    for name, pattern in reversed(TAGS):
        groups = pattern.replace(r"\(", "").replace("(?:", "").count("(")
        found = [F.nullif(F.trim(F.regexp_extract("tag", pattern, i + 1)), F.lit("")) for i in range(groups)]
        own = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
        if name in LISTED:
            own = F.filter(F.transform(F.split(found[0], ","), lambda x: F.trim(x)), lambda x: x != "")
        hit = F.col("tag").rlike(pattern)
        kind, args = F.when(hit, name).otherwise(kind), F.when(hit, own).otherwise(args)
    return tags.select("form_id", "field_id", kind.alias("kind"), args.alias("args")).where("kind IS NOT NULL")


def _with_rules(answers: DataFrame, rules: DataFrame, few: bool) -> DataFrame:
    """Answers with the rules of their form and of all forms.

    There may be a handful of fields, so answers are not dealt by field where the
    rules are ``few`` and can go to every task."""
    if few:
        rule = rules.withColumnsRenamed({"form_id": "_form", "field_id": "_field"})
        asked = (F.col("field_id") == F.col("_field")) & (F.col("_form").isNull() | (F.col("_form") == F.col("form_id")))
        return answers.join(F.broadcast(rule), asked).drop("_form", "_field")
    own = answers.join(rules.where("form_id IS NOT NULL"), ["form_id", "field_id"])
    every = answers.join(rules.where("form_id IS NULL").drop("form_id"), "field_id")
    return own.unionByName(every.select(own.columns))


def validate_rows(answers: DataFrame, rules: DataFrame, patterns: DataFrame) -> DataFrame:
    """Violations of rules that look at one value or compare two: record_id,
    form_id, field_id, severity, code.

    ``rules`` has the columns of ``RULES`` and the kinds currency, date, email,
    phone, value_in, value_range, regex_match, docket_number, bar_number,
    equals_field and date_order.  ``patterns`` (name, pattern) is what
    ``regex_match`` names; a name it does not hold is a finding.  Dockets and
    bar numbers look for ``kind:place`` there, and without that shape nothing is
    said.
    """
    arg = lambda i: F.get("args", F.lit(i))
    answers = answers.select("record_id", "form_id", "field_id", "value")
    placed = F.col("kind").isin("docket_number", "bar_number")
    name = F.when(F.col("kind") == "regex_match", arg(0)).when(placed, F.concat_ws(":", "kind", arg(0)))
    rules = rules.withColumn("name", name).join(patterns, "name", "left")
    few = rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES
    paired = F.col("kind").isin("equals_field", "date_order")
    two_sided = rules.where(paired).withColumn("_other", arg(0))
    named = two_sided.select("_other").distinct()
    others = answers.select("record_id", "form_id", F.col("field_id").alias("_other"), F.col("value").alias("_value"))
    # names are distinct, so this filters; a semi join would sink to parts of the answers with a fixed field, as a nested loop
    others = others.join(F.broadcast(named) if few else named, "_other")
    two = _with_rules(answers, two_sided, few).join(others, ["record_id", "form_id", "_other"], "left")
    one = _with_rules(answers, rules.where(~paired), few).withColumns({"_other": F.lit(None).cast("string"), "_value": F.lit(None).cast("string")})
    # The checks cost far more than reading, so rows go to all tasks, whatever the files.
    held = dealt(one.unionByName(two.select(one.columns)), "record_id")

    v, w = F.col("value"), F.col("_value")
    s, filled = F.trim(v), present(F.coalesce(v, F.lit("")))
    finding = lambda severity, code: F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"))
    error = lambda cond, code: F.when(F.coalesce(cond, F.lit(False)), finding("error", code))
    warn = lambda cond, code: F.when(F.coalesce(cond, F.lit(False)), finding("warn", code))
    bound = lambda i: F.nullif(F.replace(arg(i), F.lit(","), F.lit("")), F.lit("*")).try_cast("double")
    low, high = bound(0), bound(1)
    amount, number = V.parse_number(s), V.parse_number(v)
    money = s.rlike(V.MONEY)
    allowed = F.transform("args", V.norm)
    truth = F.array_contains(allowed, "yes") & F.coalesce(V.truthy(v), F.lit(False))
    untruth = F.array_contains(allowed, "no") & ~F.coalesce(V.truthy(v), F.lit(True))
    relaxed = lambda c: F.trim(F.regexp_replace(c, "[^a-z0-9 ]+", ""))
    mode = F.coalesce(arg(1), F.lit("exact"))
    form = lambda c: F.when(mode == "relaxed", relaxed(c)).when(mode == "caption", relaxed(F.regexp_replace(c, CAPTION, ""))).otherwise(c)
    a, b = V.parse_date_any(v), V.parse_date_any(w)
    garbled = (filled & a.isNull()) | (present(F.coalesce(w, F.lit(""))) & b.isNull())
    op = arg(1)
    in_order = F.when(op == "<", a < b).when(op == "<=", a <= b).when(op == ">", a > b).when(op == ">=", a >= b).otherwise(a == b)
    shape = F.regexp_like(v, F.col("pattern"))
    by_kind = {
        "currency": [error(filled & ~money, "bad_currency"), error(filled & money & (amount < low), "below_min"), error(filled & money & (amount > high), "above_max")],
        "date": [error(filled & ~s.rlike(DATE_SHAPE), "bad_date"), error(filled & s.rlike(DATE_SHAPE) & V.parse_date_any(s).isNull(), "impossible_date")],
        "email": [error(filled & ~s.rlike(EMAIL), "bad_email")],
        "phone": [error(filled & ~s.rlike(PHONE), "bad_phone")],
        "value_in": [error(filled & ~F.array_contains(allowed, V.norm(v)) & ~truth & ~untruth, "value_not_in_choices")],
        "value_range": [
            error(filled & number.isNull(), "value_range_unparseable"),
            error(filled & (number < low), "value_below_range"),
            error(filled & (number > high) & F.coalesce(number >= low, F.lit(True)), "value_above_range"),
        ],
        "regex_match": [error(filled & F.col("pattern").isNull(), "regex_match_unknown_pattern"), error(filled & ~shape, "regex_match_failed")],
        "docket_number": [warn(filled & ~F.regexp_like(s, F.col("pattern")), "bad_docket")],
        "bar_number": [warn(filled & ~F.regexp_like(s, F.col("pattern")), "bad_bar_number")],
        "equals_field": [error((V.norm(v) != "") & (V.norm(w) != "") & (form(V.norm(v)) != form(V.norm(w))), "field_mismatch")],
        "date_order": [error(garbled, "date_order_unparseable"), error(~garbled & ~in_order, "date_order_violation")],
    }
    none = F.array().cast("array<struct<severity:string,code:string>>")
    cases = [(F.col("kind") == kind, F.array_compact(F.array(*checks))) for kind, checks in by_kind.items()]
    found = reduce(lambda chain, case: F.when(case[0], case[1]).otherwise(chain), reversed(cases), none)
    return held.select("record_id", "form_id", "field_id", F.explode(found).alias("f")).select("record_id", "form_id", "field_id", "f.*")


def fill_from_rows(answers: DataFrame, fills: DataFrame) -> DataFrame:
    """Blank answers filled from a table of rules (the columns of ``FILLS``).

    A rule fills the fields whose name its pattern matches, in one form or (no
    form) in all; the least priority wins, then the method and the text.
    Patterns are tried once for each field of a form, not for each answer.
    Confidence is raised to the rule's floor, and the source is appended to the
    provenance.
    """
    rule = F.struct("priority", "method", "text", "confidence", "field_pattern")
    by_form = fills.groupBy(F.coalesce("form_id", F.lit(ANY)).alias("_key")).agg(F.collect_list(rule).alias("_rules"))
    named = answers.select("form_id", "field_id").distinct()
    keyed = named.withColumn("_key", F.explode(F.array(F.col("form_id").cast("string"), F.lit(ANY))))
    fits = F.filter("_rules", lambda r: F.regexp_like(F.col("field_id"), r["field_pattern"]) & present(r["text"]))
    best = keyed.join(by_form, "_key").select("form_id", "field_id", F.array_min(fits).alias("r")).where("r IS NOT NULL")
    chosen = best.groupBy("form_id", "field_id").agg(F.min("r").alias("_r"))
    blank = ~present(F.coalesce("value", F.lit("")))
    joined = answers.join(chosen, ["form_id", "field_id"], "left").withColumn("_hit", F.when(blank, F.col("_r")))
    step = F.struct(F.col("value").alias("from"), F.col("_hit.text").alias("to"), F.col("_hit.method").alias("method"))
    hit = F.col("_hit").isNotNull()
    return joined.withColumns(
        {
            "value": F.coalesce("_hit.text", "value"),
            "confidence": F.when(hit, F.greatest("confidence", "_hit.confidence")).otherwise(F.col("confidence")),
            "provenance": F.when(hit, F.array_append("provenance", step)).otherwise(F.col("provenance")),
        }
    ).select(answers.columns)
