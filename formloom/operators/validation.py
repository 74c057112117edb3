"""Checking filled records against declared rules.

Rules are plain rows; on the driver they are compiled to Column expressions
over one wide row per record.  The wide row holds only the fields some rule
reads, so any number of rules costs one aggregation.  Rules over numbered rows
(duplicates, orphans) stay on the long table.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions import values as V
from formloom.functions.text import present
from formloom.operators.reports import slot_of, slot_parts, slot_text

# What the declared types accept.
EMAIL = r"^[^\s@]+@[^\s@]+\.[^\s@]+$"
PHONE = r"^\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}$"
DATE_SHAPE = r"^(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{2,4}|[A-Z][a-z]+\s+\d{1,2},?\s+\d{4})$"
CAPTION = r"^\s*(estate of|in re|matter of|guardianship of|conservatorship of)\s+"
# Named patterns for ``regex_match``.
PATTERNS = {
    "zip": r"^\d{5}(?:-\d{4})?$",
    "us_phone": r"^[\d()+\- .x]{7,25}$",
    "us_email": EMAIL,
    "bar_number": r"^\d{2,6}$",
    "docket": r"^(?:[A-Z0-9]{2,5}-)?\d{4}-(?:[A-Z]{2,5}-)?(?:[A-Z]{2,5}-)?\d{1,6}(?:-[A-Z]{2,5})?$",
    "non_empty": r"\S",
}


# Jurisdictions whose docket and bar numbers have these shapes.
JURISDICTIONS = ("ME",)


class Rule(NamedTuple):
    """A check of one field; ``form_id`` limits it to one form's records."""

    field_id: str
    kind: str
    args: tuple = ()
    form_id: str | None = None


# How validators are written.
TAGS = (
    ("date_order", r"^date_order\(([^,)]+),\s*([<>=]+)\)$"),
    ("equals_field", r"^equals_field\(([^,)]+)(?:,\s*(\w+))?\)$"),
    ("value_in", r"^value_in\(([^)]+)\)$"),
    ("value_range", r"^value_range\(\s*([-+]?[\d.,*]+|\*)\s*,\s*([-+]?[\d.,*]+|\*)\s*\)$"),
    ("regex_match", r"^regex_match\(([a-z0-9_]+)\)$"),
    ("dedupe_within", r"^dedupe_within\(([^)]+)\)$"),
    ("cross_section_dedupe", r"^cross_section_dedupe\(([^)]+)\)$"),
    ("nonempty_if_desc", r"^nonempty_if_desc$"),
)


def parse_tag(field_id: str, tag: str) -> Rule | None:
    """A declared validator tag as a rule; unknown tags give nothing."""
    for kind, pattern in TAGS:
        m = re.match(pattern, tag)
        if m:
            args = tuple(g.strip() for g in m.groups() if g is not None)
            if kind in ("value_in", "cross_section_dedupe"):
                args = tuple(x.strip() for x in args[0].split(",") if x.strip())
            return Rule(field_id, kind, args)
    return None


# ---- trees to expressions --------------------------------------------------


def condition_fields(tree: Any) -> set[str]:
    if not isinstance(tree, Mapping):
        return set()
    out = {tree["field"]} if "field" in tree else set()
    for branch in ("all_of", "any_of", "none_of"):
        for sub in tree.get(branch, ()):
            out |= condition_fields(sub)
    return out


def compile_condition(tree: Any, field: Mapping[str, Column] | Any) -> Column:
    """A boolean tree as a Column that is never null.

    Branches all_of, any_of, none_of over leaves equals, ne, in, exists, gt,
    gte, lt, lte on one field.
    """
    get = field if callable(field) else field.__getitem__
    if tree is None:
        return F.lit(True)
    combine = {"all_of": lambda cs: _fold(cs, "and"), "any_of": lambda cs: _fold(cs, "or"), "none_of": lambda cs: ~_fold(cs, "or")}
    for branch, how in combine.items():
        if branch in tree:
            return how([compile_condition(sub, field) for sub in tree[branch]])
    v = get(tree["field"])
    if "equals" in tree or "ne" in tree:
        rhs = tree["equals"] if "equals" in tree else tree["ne"]
        if isinstance(rhs, bool):
            same = F.coalesce(V.truthy(v) == F.lit(rhs), F.lit(False))
        else:
            same = F.coalesce(v == F.lit(str(rhs)), F.lit(False))
        return same if "equals" in tree else ~same
    if "exists" in tree:
        there = v.isNotNull() & (v != "")
        return F.coalesce(there, F.lit(False)) == F.lit(bool(tree["exists"]))
    if "in" in tree:
        return F.coalesce(v.isin([str(x) for x in tree["in"]]), F.lit(False))
    compare = {"gt": lambda a, b: a > b, "gte": lambda a, b: a >= b, "lt": lambda a, b: a < b, "lte": lambda a, b: a <= b}
    for op, fn in compare.items():
        if op in tree:
            number = F.when(v != "", V.to_double(v))
            return F.coalesce(fn(number, F.lit(float(tree[op]))), F.lit(False))
    return F.lit(False)


def _fold(columns: Sequence[Column], how: str) -> Column:
    out = F.lit(how == "and")
    for c in columns:
        out = (out & c) if how == "and" else (out | c)
    return out


def formula_inputs(tree: Any) -> list[str]:
    """Field ids a formula reads, slot sums spelled out, in order, once each."""
    if not isinstance(tree, Mapping):
        return []
    op = tree.get("op")
    if op == "field":
        found = [tree["id"]]
    elif op == "sum_slot":
        found = [f"{tree['prefix']}_{i}_{tree['suffix']}" for i in range(tree["from"], tree["to"] + 1)]
    else:
        kids = [*tree.get("args", ()), *(tree[k] for k in ("arg", "cond", "then", "else") if k in tree)]
        found = [f for kid in kids for f in formula_inputs(kid)]
    return list(dict.fromkeys(found))


def compile_formula(tree: Mapping, field: Any, number: Any = None) -> Column:
    """A formula tree as a double Column.

    Blank inputs count as 0; text that is no number, or a zero divisor, gives
    null.  ``number`` gives the fields as numbers where they are known.
    """
    op = tree["op"]
    num = number or (lambda f: V.to_amount(field(f)).cast("double"))
    sub = lambda t: compile_formula(t, field, number)
    if op == "const":
        return F.lit(float(tree["value"]))
    if op == "field":
        return num(tree["id"])
    if op == "sum_slot":
        return _sum([num(f) for f in formula_inputs(tree)])
    if op == "abs":
        return F.abs(sub(tree["arg"]))
    if op == "if":
        cond = sub(tree["cond"])
        return F.when(cond.isNotNull(), F.when(cond != 0, sub(tree["then"])).otherwise(sub(tree["else"])))
    args = [sub(a) for a in tree.get("args", ())]
    if op == "add":
        return _sum(args)
    out = args[0]
    for a in args[1:]:
        if op == "sub":
            out = out - a
        elif op == "mul":
            out = out * a
        elif op == "div":
            out = F.try_divide(out, a)
        else:
            # least and greatest skip nulls; a missing input must give null
            pick = F.least if op == "min" else F.greatest
            out = F.when(out.isNotNull() & a.isNotNull(), pick(out, a))
    return out


def _sum(columns: Sequence[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def formula_levels(formulas: Mapping[str, Mapping]) -> list[list[str]]:
    """Formula targets in waves: each reads only given fields and earlier
    waves.  A cycle is an error."""
    waiting = {t: [d for d in formula_inputs(f) if d in formulas] for t, f in formulas.items()}
    levels: list[list[str]] = []
    done: set[str] = set()
    while waiting:
        ready = sorted(t for t, deps in waiting.items() if all(d in done for d in deps))
        if not ready:
            raise ValueError(f"formulas form a cycle: {sorted(waiting)}")
        levels.append(ready)
        done |= set(ready)
        for t in ready:
            del waiting[t]
    return levels


# ---- rules on one wide row per record --------------------------------------


def wide_records(answers: DataFrame, fields: Iterable[str], everyone: bool = False) -> DataFrame:
    """One row per record with a column ``v_<field>`` for each named field.

    Records that hold none of the fields are left out, or with ``everyone``
    kept with nulls.
    """
    names = sorted(set(fields))
    held = answers if everyone else answers.where(F.col("field_id").isin(names))
    return held.groupBy("record_id", "form_id").agg(
        *[F.max(F.when(F.col("field_id") == f, F.col("value"))).alias("v_" + f) for f in names]
    )


def _rule_fields(rule: Rule) -> set[str]:
    out = {rule.field_id}
    if rule.kind in ("date_order", "equals_field"):
        out.add(rule.args[0])
    elif rule.kind in ("required_when", "writable_when"):
        out |= condition_fields(rule.args[0])
    elif rule.kind == "recompute":
        out |= set(formula_inputs(rule.args[0]))
    return out


def _violations(rule: Rule) -> list[tuple[Column, str, str]]:
    """(condition, severity, code) for one rule over the wide row."""
    col = lambda f: F.col("v_" + f)
    v = col(rule.field_id)
    s = F.trim(v)
    filled = v.isNotNull() & (v != "")
    kind, args = rule.kind, rule.args
    if kind == "currency":
        low, high = (args + (None, None))[:2]
        bad = ~s.rlike(V.MONEY)
        amount = V.parse_number(s)
        out = [(filled & bad, "error", "bad_currency")]
        if low is not None:
            out.append((filled & ~bad & (amount < low), "error", "below_min"))
        if high is not None:
            out.append((filled & ~bad & (amount > high), "error", "above_max"))
        return out
    if kind == "date":
        shaped = s.rlike(DATE_SHAPE)
        return [
            (filled & ~shaped, "error", "bad_date"),
            (filled & shaped & V.parse_date_any(s).isNull(), "error", "impossible_date"),
        ]
    if kind in ("email", "phone"):
        return [(filled & ~s.rlike(EMAIL if kind == "email" else PHONE), "error", f"bad_{kind}")]
    if kind in ("docket_number", "bar_number"):
        # The shape is a jurisdiction's own; without a known one nothing is said.
        if args[:1] not in [(place,) for place in JURISDICTIONS]:
            return []
        pattern, code = ("docket", "bad_docket") if kind == "docket_number" else ("bar_number", "bad_bar_number")
        return [(filled & ~s.rlike(PATTERNS[pattern]), "warn", code)]
    if kind == "required_when":
        return [(compile_condition(args[0], col) & ~filled, "error", "missing_required")]
    if kind == "writable_when":
        return [(filled & ~compile_condition(args[0], col), "error", "not_writable")]
    if kind == "equals_field":
        mode = args[1] if len(args) > 1 else "exact"
        a, b = V.norm(v), V.norm(col(args[0]))
        relaxed = lambda c: F.trim(F.regexp_replace(c, "[^a-z0-9 ]+", ""))
        form = {"exact": lambda c: c, "relaxed": relaxed, "caption": lambda c: relaxed(F.regexp_replace(c, CAPTION, ""))}[mode]
        return [((a != "") & (b != "") & (form(a) != form(b)), "error", "field_mismatch")]
    if kind == "value_in":
        allowed = [re.sub(r"\s+", " ", a).strip().lower() for a in args]
        yes = F.lit("yes" in allowed) & F.coalesce(V.truthy(v), F.lit(False))
        no = F.lit("no" in allowed) & ~F.coalesce(V.truthy(v), F.lit(True))
        return [(filled & ~V.norm(v).isin(allowed) & ~yes & ~no, "error", "value_not_in_choices")]
    if kind == "date_order":
        w = col(args[0])
        a, b = V.parse_date_any(v), V.parse_date_any(w)
        garbled = (filled & a.isNull()) | (w.isNotNull() & (w != "") & b.isNull())
        holds = {"<": a < b, "<=": a <= b, ">": a > b, ">=": a >= b, "=": a == b, "==": a == b}[args[1]]
        return [
            (garbled, "error", "date_order_unparseable"),
            (~garbled & a.isNotNull() & b.isNotNull() & ~holds, "error", "date_order_violation"),
        ]
    if kind == "value_range":
        n = V.parse_number(v)
        bound = lambda x: None if x == "*" else float(str(x).replace(",", ""))
        low, high = bound(args[0]), bound(args[1])
        out = [(filled & n.isNull(), "error", "value_range_unparseable")]
        if low is not None:
            out.append((filled & (n < low), "error", "value_below_range"))
        if high is not None:
            out.append((filled & (n > high) & ((n >= low) if low is not None else F.lit(True)), "error", "value_above_range"))
        return out
    if kind == "regex_match":
        if args[0] not in PATTERNS:
            return [(filled, "error", "regex_match_unknown_pattern")]
        return [(filled & ~v.rlike(PATTERNS[args[0]]), "error", "regex_match_failed")]
    if kind == "recompute":
        mode = args[1] if len(args) > 1 else "exact"
        expected, got = F.col(expected_name(args[0])), F.col("n_" + rule.field_id)
        slack = F.greatest(F.lit(5.0), F.abs(expected) * 0.005)
        known = expected.isNotNull()
        off = (got < expected - slack) if mode == "at_least" else (F.abs(got - expected) > slack)
        code = "recompute_below_minimum" if mode == "at_least" else "recompute_mismatch"
        return [(known & got.isNull() & filled, "error", "non_numeric"), (known & off, "error", code)]
    raise ValueError(f"unknown rule kind {kind}")


#: Columns of one wide row; rules of more fields are worked off form by form.
FAMILY_FIELDS = 200


def rule_families(rules: Sequence[Rule]) -> list[list[Rule]]:
    """Rules of any form together, then forms whose fields fit one wide row."""
    by_form: dict[str | None, list[Rule]] = {}
    for r in rules:
        by_form.setdefault(r.form_id, []).append(r)
    out = [by_form.pop(None)] if None in by_form else []
    family: list[Rule] = []
    for form in sorted(by_form):
        grown = {f for r in (*family, *by_form[form]) for f in _rule_fields(r)}
        if family and len(grown) > FAMILY_FIELDS:
            out.append(family)
            family = []
        family = [*family, *by_form[form]]
    return [*out, family] if family else out


def validate(answers: DataFrame, rules: Sequence[Rule], records: DataFrame | None = None) -> DataFrame:
    """Violations of all wide-row rules: record_id, form_id, field_id,
    severity, code.

    A rule with a form is checked on that form's records only.  Every record
    is judged, also one that answers none of the ruled fields; ``records``
    (record_id, form_id) adds those without any answer.
    """
    if records is not None:
        none = F.lit(None).cast("string")
        empty = records.select("record_id", "form_id", none.alias("field_id"), none.alias("value"))
        answers = answers.select("record_id", "form_id", "field_id", "value").unionByName(empty)
    out = None
    for family in rule_families(rules):
        forms = {r.form_id for r in family}
        held = answers if None in forms else answers.where(F.col("form_id").cast("string").isin(sorted(forms)))
        found = _violated(wide_records(held, {f for r in family for f in _rule_fields(r)}, everyone=True), family)
        out = found if out is None else out.unionByName(found)
    if out is None:
        raise ValueError("no rules")
    return out


def expected_name(formula: Mapping) -> str:
    return "e_" + hashlib.md5(json.dumps(formula, sort_keys=True).encode()).hexdigest()


def _computed(wide: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The wide row with the numbers of the fields and the results of the
    formulas that ``recompute`` rules look at, each worked out once a row."""
    recomputed = [r for r in rules if r.kind == "recompute"]
    if not recomputed:
        return wide
    formulas = {expected_name(r.args[0]): r.args[0] for r in recomputed}
    fields = sorted({f for tree in formulas.values() for f in formula_inputs(tree)} | {r.field_id for r in recomputed})
    numbers = wide.select("*", *[V.to_amount(F.col("v_" + f)).cast("double").alias("n_" + f) for f in fields])
    known = lambda f: F.col("n_" + f)
    return numbers.select("*", *[compile_formula(tree, known, known).alias(name) for name, tree in formulas.items()])


def _violated(wide: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    wide = _computed(wide, rules)
    own = lambda r: F.lit(True) if r.form_id is None else F.col("form_id").cast("string") == r.form_id
    checks = [
        F.when(
            own(r) & F.coalesce(cond, F.lit(False)),
            F.struct(F.lit(r.field_id).alias("field_id"), F.lit(sev).alias("severity"), F.lit(code).alias("code")),
        )
        for r in rules
        for cond, sev, code in _violations(r)
    ]
    if not checks:
        checks = [F.lit(None).cast("struct<field_id:string,severity:string,code:string>")]
    return wide.select("record_id", "form_id", F.explode(F.array_compact(F.array(*checks))).alias("v")).select(
        "record_id", "form_id", "v.*"
    )


def rules_from_packages(fields: DataFrame) -> list[Rule]:
    """The rules that form packages declare, each for its own form.

    ``fields`` is what ``read_form_packages`` gives; there is a row per field
    of a form (a catalogue, not the corpus), so the declarations are read on the
    driver.  Trees are JSON; validators are tags in a JSON list or parted by
    "|" or ";".  Unknown tags give nothing.
    """
    declared = ("required_when", "writable_when", "formula", "validators")
    some = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in declared])
    out = []
    for r in fields.select("form_id", "field_id", *declared).where(some.isNotNull()).orderBy("form_id", "field_id").collect():
        for kind in ("required_when", "writable_when"):
            if present_text(r[kind]):
                out.append(Rule(r.field_id, kind, (json.loads(r[kind]),), r.form_id))
        if present_text(r.formula):
            out.append(Rule(r.field_id, "recompute", (json.loads(r.formula),), r.form_id))
        text = (r.validators or "").strip()
        tags = json.loads(text) if text.startswith("[") else re.split(r"[|;]", text)
        rules = [parse_tag(r.field_id, str(tag).strip()) for tag in tags]
        out += [rule._replace(form_id=r.form_id) for rule in rules if rule]
    return out


def present_text(value: str | None) -> bool:
    return bool(value and value.strip())


# ---- rules on numbered rows, long form -------------------------------------


def numbered(answers: DataFrame, *columns: Column | str) -> DataFrame:
    """Numbered fields with ``columns`` and their entity, index and attribute.

    The parts come out of a generator, so that conditions on them neither read
    the name again nor move below it, to rows before they are aggregated.
    """
    keys = ["record_id", "form_id", "field_id"]
    read = answers.select(*keys, *columns, slot_text(F.col("field_id")).alias("_slot"))
    parts = F.inline(F.array_compact(F.array(slot_of(F.col("_slot"), F.col("field_id")))))
    return read.select("*", parts).drop("_slot")


def slot_values(answers: DataFrame) -> DataFrame:
    """Filled numbered fields with their entity, index and attribute."""
    return numbered(answers.where(present(F.col("value"))), V.norm(F.col("value")).alias("norm"))


def dedupe_within(answers: DataFrame, groups: Sequence[tuple[str, str]]) -> DataFrame:
    """Second and later equal values among the (entity, attribute) rows of a
    record, with the field they repeat."""
    wanted = _fold([(F.col("entity") == e) & (F.col("attr") == a) for e, a in groups], "or")
    w = Window.partitionBy("record_id", "form_id", "entity", "attr", "norm")
    return (
        slot_values(answers)
        .where(wanted)
        .withColumn("first_field", F.min("field_id").over(w))
        .where("field_id <> first_field")
        .select("record_id", "form_id", "field_id", "first_field")
    )


def cross_section_dedupe(answers: DataFrame, attr: str, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Values of one entity's rows found among another's in the same record."""
    s = slot_values(answers).where(F.col("attr") == attr)
    left = s.where(F.col("entity").isin([a for a, _ in pairs]))
    right = s.select(
        "record_id", "form_id", "norm", F.col("entity").alias("other_entity"), F.col("field_id").alias("other_field")
    )
    allowed = _fold([(F.col("entity") == a) & (F.col("other_entity") == b) for a, b in pairs], "or")
    return (
        left.join(right, ["record_id", "form_id", "norm"])
        .where(allowed & (F.col("field_id") != F.col("other_field")))
        .select("record_id", "form_id", "field_id", "other_field")
    )


def nonempty_if_desc(answers: DataFrame, desc: Sequence[str] = ("desc", "description")) -> DataFrame:
    """Row values whose description is blank though the form has one."""
    is_desc = F.col("attr").isin(list(desc))
    by = ["record_id", "form_id", "entity", "idx"]
    # one row's few fields; names are read once for values and descriptions
    filled = numbered(answers, F.coalesce(present(F.col("value")), F.lit(False)).alias("filled")).dropna(subset=by)
    described = F.max(F.when(is_desc, F.col("filled"))).over(Window.partitionBy(*by))
    return (
        filled.withColumns({"is_desc": is_desc, "described": described})
        .where("NOT described AND NOT is_desc AND filled")
        .select("record_id", "form_id", "field_id")
    )


def case_dict_drift(answers: DataFrame, constants: DataFrame) -> DataFrame:
    """Answers that differ from the case's constant for the same key."""
    c = constants.select("record_id", F.col("key").alias("field_id"), F.col("value").alias("constant"))
    return (
        answers.join(c, ["record_id", "field_id"])
        .where(~F.col("value").eqNullSafe(F.col("constant")))
        .select("record_id", "form_id", "field_id", "value", "constant")
    )


def error_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("record_id", "form_id").agg(
        *[F.count_if(F.col("severity") == s).alias("n_" + s) for s in ("error", "warn", "info")]
    )


def recompute_totals(answers: DataFrame, formulas: Mapping[str, Mapping], at_least: Sequence[str] = ()) -> DataFrame:
    """Formula targets overwritten where off by a cent or more or blank; later
    formulas read earlier results.  Returns the changes."""
    needed = set(formulas) | {f for t in formulas.values() for f in formula_inputs(t)}
    wide = wide_records(answers, needed)
    changes = []
    for level in formula_levels(formulas):
        updates = {}
        for target in level:
            if target in at_least:
                continue
            cur = F.col("v_" + target)
            expected = compile_formula(formulas[target], lambda f: F.col("v_" + f))
            blank = ~present(F.coalesce(cur, F.lit("")))
            same = F.abs(V.to_amount(cur).cast("double") - expected) < 0.01
            write = expected.isNotNull() & (blank | ~F.coalesce(same, F.lit(False)))
            updates["n_" + target] = F.when(write, F.format_number(expected, 2))
            changes.append(target)
        wide = wide.withColumns(updates)
        wide = wide.withColumns(
            {"o_" + t[2:]: F.col("v_" + t[2:]) for t in updates}
        ).withColumns({"v_" + t[2:]: F.coalesce(t, "v_" + t[2:]) for t in updates})
    made = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("n_" + t).isNotNull(),
                    F.struct(F.lit(t).alias("field_id"), F.coalesce("o_" + t, F.lit("")).alias("old_value"), F.col("n_" + t).alias("new_value")),
                )
                for t in changes
            ]
        )
    )
    return wide.select("record_id", "form_id", F.explode(made).alias("c")).select("record_id", "form_id", "c.*")


# ---- guides and lints ------------------------------------------------------

# Labels that imply a type, in order.
LABEL_TYPES = (
    (r"\bdate\b|\bdob\b", "date"),
    (r"\$|\bamount\b|\btotal\b|\bvalue\b", "currency"),
    (r"\bzip\b", "zip"),
    (r"\bphone\b|\btelephone\b", "phone"),
    (r"\be-?mail\b", "email"),
)


def value_guides(fields: DataFrame) -> DataFrame:
    """Format, alignment and example shown for a field, from type and label."""
    t = F.col("data_type")
    fmt = (
        F.when(t == "date", "MM/DD/YYYY").when(t == "currency", "0,000.00").when(t == "phone", "(000) 000-0000")
        .when(t.isin("choice", "boolean"), "check one").otherwise("free text")
    )
    example = F.when(t == "date", "04/02/2025").when(t == "currency", "1,250.00")
    align = F.when(t == "currency", "right").otherwise("left")
    return fields.select(
        "form_id", "seq", fmt.alias("format"), align.alias("align"), example.alias("example"),
        F.concat_ws("; ", F.array_compact(F.array(fmt, F.when(F.col("required"), "required"), example))).alias("guide"),
    )


# What a field of each kind expects, by kind.
GUIDES = (
    ("county", None, "a county name, upper-case, without the word 'County'", "CUMBERLAND|YORK", "a person or court name|the trailing word 'County'"),
    ("currency", "decimal", "a dollar amount, digits and decimal point only", "1500.00|0.00|27834.50", "a '$' character inside the value|thousands separators or words|a negative amount unless the line is a credit"),
    ("date", "YYYY-MM-DD or MM/DD/YYYY", "a real calendar date", "2026-03-18|03/18/2026", "vague text|an impossible calendar date|a value that runs across a printed comma or '20__' stub"),
    ("past_date", "YYYY-MM-DD or MM/DD/YYYY", "a real calendar date", "2026-03-18|03/18/2026", "vague text|an impossible calendar date|a value that runs across a printed comma or '20__' stub|a date in the future"),
    ("street", None, "an address with: street", "47 Pine Hill Road", "the state spelled out|a PO box where a physical residence is required"),
    ("address", None, "an address with: street, city, state, zip", "47 Pine Hill Road, Falmouth, ME 04105", "a missing ZIP code|the state spelled out|a PO box where a physical residence is required"),
    ("name", None, "full legal name as it should appear on the order", "Margaret L. Walsh", "initials or nicknames|a title with no name|'Last, First' order"),
    ("phone", "NNN-NNN-NNNN", "a 10-digit US phone number", None, "letters|a missing area code"),
    ("email", "local@domain", None, None, "spaces|a missing @"),
    ("docket", None, "a docket number of the court", None, "a docket from another jurisdiction's format"),
    ("bar", None, "a bar registration number", None, None),
    ("signature", None, "leave blank: wet-ink signature", None, None),
    ("check", None, "check only if the statement is true", None, None),
    ("year", "YYYY", "a 4-digit calendar year", None, "a 2-digit year|text spanning the printed '20' stub"),
    ("zip", "ZIP5 or ZIP+4", "a US ZIP code", None, "fewer than 5 digits|letters"),
    ("state", None, "a US state, 2-letter abbreviation preferred", None, None),
    ("text", None, "free text answering the printed prompt", None, None),
)
# Names and labels that tell a kind.
COUNTY, YEAR = r"(?i)county", r"(?i)\byear\b|_year$|year_"
ZIP_LABEL, STATE_LABEL, PAST = r"(?i)\bzip\b|postal", r"(?i)\bstate\b", r"(?i)birth|dob|death"
STREET = r"(?i)street address|street\b"
WHOLE_ADDRESS = r"(?i)mailing|residence|domicile|legal address|address.*(?:email|telephone|phone)"


def guide_kind(label: Column, field_id: Column, data_type: Column, field_type: Column) -> Column:
    """Which guide a field gets: a county first, then its type; plain text goes
    by what its label or name says."""
    either = lambda pattern: label.rlike(pattern) | field_id.rlike(pattern)
    return (
        F.when(either(COUNTY), "county")
        .when(data_type == "currency", "currency")
        .when(data_type == "date", F.when(field_id.rlike(PAST), "past_date").otherwise("date"))
        .when(data_type == "address", F.when(label.rlike(STREET) & ~label.rlike(WHOLE_ADDRESS), "street").otherwise("address"))
        .when(data_type.isin("person_name", "entity_name"), "name")
        .when(data_type.isin("phone", "email", "signature"), data_type)
        .when(data_type == "docket_number", "docket")
        .when(data_type == "bar_number", "bar")
        .when((data_type == "checkbox") | (field_type == "enabler"), "check")
        .when(either(YEAR), "year")
        .when(label.rlike(ZIP_LABEL), "zip")
        .when(label.rlike(STATE_LABEL), "state")
        .otherwise("text")
    )


def field_guides(fields: DataFrame, aligned: DataFrame) -> DataFrame:
    """What a filler should put into each field: form_id, field_id, label, kind,
    required, alignment, format, expects, examples, avoid, calculated.

    ``fields``: form_id, field_id, label, data_type, field_type, required_when
    (null, "always" or a tree), formula.  ``aligned``: form_id, field_id,
    alignment, where one is declared.  Examples and what to avoid are arrays.
    """
    label = F.coalesce(F.nullif("label", F.lit("")), F.translate("field_id", "_", " "))
    need = F.when(F.lower(F.trim("required_when")).isin("always", "true"), "always").when(present(F.coalesce("required_when", F.lit(""))), "conditional").otherwise("optional")
    kind = guide_kind(F.col("label"), F.col("field_id"), F.coalesce("data_type", F.lit("")), F.coalesce("field_type", F.lit("")))
    told = fields.withColumn("label", label).withColumns({"kind": kind, "required": need})
    listed = lambda c: F.split(c, r"\|")
    guides = fields.sparkSession.createDataFrame(list(GUIDES), "kind string, format string, expects string, examples string, avoid string")
    calculated = F.when((F.col("kind") != "county") & present(F.coalesce("formula", F.lit(""))), F.col("formula"))
    return (
        told.join(aligned.select("form_id", "field_id", "alignment"), ["form_id", "field_id"], "left")
        .join(F.broadcast(guides), "kind")  # one row a kind
        .select(
            "form_id", "field_id", "label", "kind", "required", F.coalesce("alignment", F.lit("left")).alias("alignment"),
            "format", "expects", listed("examples").alias("examples"), listed("avoid").alias("avoid"), calculated.alias("calculated"),
        )
    )


def recompute_by_form(answers: DataFrame, formulas: Mapping[str, Mapping[str, Mapping]], at_least: Sequence[str] = ()) -> DataFrame:
    """``recompute_totals`` with each form's own formulas: ``formulas`` maps a
    form to its targets.  Records of other forms are left alone; forms with the
    same formulas are worked off together."""
    together: dict[str, tuple[Mapping, list[str]]] = {}
    for form, own in sorted(formulas.items()):
        together.setdefault(json.dumps(own, sort_keys=True), (own, []))[1].append(form)
    out = None
    for own, forms in together.values():
        part = recompute_totals(answers.where(F.col("form_id").cast("string").isin(forms)), own, at_least)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no formulas")
    return out


def under_typed_text(fields: DataFrame) -> DataFrame:
    """Text fields whose label implies a stricter type."""
    from formloom.functions.schema_rules import first_match

    implied = first_match(F.col("label"), LABEL_TYPES)
    return fields.where("data_type = 'text'").select("form_id", "seq", implied.alias("implied")).where("implied IS NOT NULL")


def lint_sources(fields: DataFrame, namespaces: Sequence[str]) -> DataFrame:
    """Sources with an unknown namespace or too many dots."""
    parts = F.split("source", r"\.")
    head = F.get(parts, F.lit(0))
    problem = F.when((F.size(parts) > 1) & ~(head.isin(list(namespaces)) | head.endswith("_record")), "unknown_namespace").when(
        F.size(parts) > 3, "too_many_dots"
    )
    return fields.select("form_id", "seq", "source", problem.alias("problem")).where("problem IS NOT NULL")


def stale_projection(stored: DataFrame, derived: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Stored projections that differ from freshly derived ones."""
    s = stored.select(*key, F.col(value).alias("stored"))
    d = derived.select(*key, F.col(value).alias("derived"))
    return s.join(d, list(key), "full").where(~F.col("stored").eqNullSafe(F.col("derived")))


def default_validators(fields: DataFrame) -> DataFrame:
    """Rule tags a field gets from its category and numbered name.

    ``fields``: form_id, field_id, category, subcategory.  Descriptions of one
    family must not repeat those of the form's other families, which are named
    in the tag.
    """
    slotted = fields.withColumn("_s", slot_parts(F.col("field_id")))
    is_desc = F.col("_s.attr").isin("desc", "description")
    families = slotted.where(is_desc).groupBy("form_id").agg(F.collect_set("_s.entity").alias("_all"))
    own = F.col("_s.entity")
    others = F.array_sort(F.array_except(F.coalesce("_all", F.array().cast("array<string>")), F.array(own)))
    slot = F.col("subcategory") == "repeating_slot"
    tag = lambda ok, c: F.when(F.coalesce(ok, F.lit(False)), c)
    tags = F.array_compact(
        F.array(
            tag((F.col("category") == "legal_choice") & (F.col("subcategory") == "yes_no"), F.lit("value_in(yes, no)")),
            tag(slot & is_desc, F.concat(F.lit("dedupe_within("), own, F.lit("_desc)"))),
            tag(
                slot & is_desc & (F.size(others) > 0),
                F.concat(F.lit("cross_section_dedupe("), F.array_join(F.transform(others, lambda o: F.concat(o, F.lit("_desc"))), ","), F.lit(")")),
            ),
            tag(slot & F.col("_s.attr").isin("val", "value", "amount", "enc", "encumbrance"), F.lit("nonempty_if_desc")),
            tag(F.col("category") == "computed", F.lit("recompute_from_dependencies")),
            tag(F.col("category") == "case_constant", F.lit("populate_from_case_dict")),
        )
    )
    return slotted.join(families, "form_id", "left").select("form_id", "field_id", tags.alias("validators"))
