"""Case facts, field resolution and repair of filled records.

Facts are one long table ``(case_id, namespace, key, value)``; answers are
``(record_id, form_id, field_id, value, …)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions import values as V
from formloom.functions.text import present
from formloom.operators.naming import _lookup
from formloom.operators.pairs import by_shuffle, dealt
from formloom.operators.ranking import block_window, neighbours, rank_in_groups

# Other spellings forms use for a party attribute.
ATTRIBUTE_NAMES = {
    "street": "address", "zipcode": "zip", "telephone": "phone", "dob": "date_of_birth", "bar": "bar_number",
}
ATTRIBUTE_ALIASES = {
    "bar_number": ("bar_no",), "phone": ("phone_number", "telephone"), "email": ("email_address",),
}
# Field names that never take a party's bare name.
NOT_A_NAME = (
    r"_(address|phone|phone_number|email|email_address|bar_number|bar_no|city|state|zip|county|residence|"
    r"domicile|day|month|year|title|other|other_text|date_of_birth|date_of_death|dob|date)$"
)
BLANK_SOURCES = ("wet_ink", "human_decision", "left_blank", "triage")


def widget_mode(widgets: DataFrame) -> DataFrame:
    """How a field's widgets share one value: replicate, first_only or wrap."""
    keys = ["form_id", "field_id"]
    ranked = rank_in_groups(
        widgets.select(*keys, "page", "rect_id", "x0", "y0", "x1"), keys,
        [F.col("page"), F.col("y0"), F.col("x0"), F.col("rect_id")], [F.col("page"), F.floor(F.col("y0") / 64)],
    )
    w = block_window(keys)
    steps = neighbours(
        ranked, keys,
        {
            "turns": F.col("page") != F.lag("page").over(w),
            "dy": F.col("y0") - F.lag("y0").over(w),
            "dx": F.col("x0") - F.lag("x1").over(w),
        },
        behind=1,
    )
    apart = F.max(F.coalesce(F.col("turns") | (F.col("dy") > 60), F.lit(False)))
    beside = F.max(F.coalesce((F.abs("dy") < 5) & (F.col("dx") < 5), F.lit(False)))
    return steps.groupBy("form_id", "field_id").agg(
        F.count("*").alias("n"),
        F.when(F.count("*") < 2, "single").when(apart, "replicate").when(beside, "first_only").otherwise("wrap").alias("mode"),
    )


def facts_from_parties(cases: DataFrame) -> DataFrame:
    """Party maps and matter facts as long facts, with aliases.

    ``cases``: case_id, ``parties`` map role → map attribute → value, and
    ``matter`` / ``facts`` maps.  Each party gives ``<role>``, ``<role>_name``
    and ``<role>_<attribute>`` under ``<role>_record``.
    """
    party = cases.select("case_id", F.explode("parties").alias("role", "p"))
    at = lambda k: F.try_element_at(F.col("p"), F.lit(k))
    name = V.full_name(at("full_name"), at("first_name"), at("middle_name"), at("last_name"))
    names = party.select("case_id", "role", F.explode(F.array(F.lit(""), F.lit("_name"))).alias("suffix"), name.alias("value")).select(
        "case_id", F.concat("role", F.lit("_record")).alias("namespace"), F.concat("role", "suffix").alias("key"), "value"
    )
    attrs = party.select("case_id", "role", F.explode("p").alias("k", "value")).where(
        ~F.col("k").isin("full_name", "first_name", "middle_name", "last_name")
    )
    std = F.coalesce(_lookup(ATTRIBUTE_NAMES, F.col("k")), F.col("k"))
    alias = F.lit(None).cast("array<string>")
    for k, v in ATTRIBUTE_ALIASES.items():
        alias = F.when(std == k, F.array(*[F.lit(x) for x in v])).otherwise(alias)
    spread = attrs.select(
        "case_id", "role", "value",
        F.posexplode(F.concat(F.array(std), F.coalesce(alias, F.array().cast("array<string>")))).alias("is_alias", "attr"),
    )
    keyed = spread.select(
        "case_id", F.concat("role", F.lit("_record")).alias("namespace"), F.concat_ws("_", "role", "attr").alias("key"), "value", "is_alias"
    )
    # a spelled-out attribute beats an alias of another one
    attributes = (
        keyed.where(present(F.col("value")))
        .groupBy("case_id", "namespace", "key")
        .agg(F.min_by("value", F.struct(F.col("is_alias") > 0, "value")).alias("value"))
    )
    plain = lambda col, ns: cases.select("case_id", F.explode(col).alias("key", "value")).select(
        "case_id", F.lit(ns).alias("namespace"), "key", "value"
    )
    out = names.unionByName(attributes).unionByName(plain("matter", "case_dict")).unionByName(plain("facts", "narrative_facts"))
    return out.where(present(F.col("value")))


def _any_record(facts: DataFrame) -> DataFrame:
    """A pseudo namespace holding, per key, the value of the first record."""
    return (
        facts.where(F.col("namespace").endswith("_record"))
        .groupBy("case_id", "key")
        .agg(F.min_by("value", "namespace").alias("value"))
        .select("case_id", F.lit("*_record").alias("namespace"), "key", "value")
    )


def resolve_fields(case_fields: DataFrame, facts: DataFrame) -> DataFrame:
    """Resolve each (case, field) from the case's facts.

    ``case_fields``: case_id, form_id, field_id, source, llm_eligible,
    has_formula.  All places a value may stand are listed per field and looked
    up in one join; the best place wins.  Adds ``bucket``, ``value``,
    ``origin``.
    """
    head = F.substring_index("source", ".", 1)
    key = F.regexp_replace("source", r"^[^.]*\.?", "")
    role = F.substring_index(key, ".", 1)
    attr = F.regexp_replace(key, r"^[^.]*\.", "")
    two_dots = key.contains(".")
    flat = F.concat_ws("_", role, F.regexp_replace(attr, r"\.", "_"))
    own_record = F.concat(role, F.lit("_record"))
    from_record = F.col("source").startswith("case_dict.") | (head.endswith("_record") & F.col("source").contains("."))
    narrative = ~from_record & ((F.col("source") == "llm_over_narrative") | F.col("llm_eligible"))
    recompute = ~from_record & ~narrative & ((F.col("source") == "recompute_from_dependencies") | F.col("has_formula"))
    blank = ~from_record & ~narrative & ~recompute & F.col("source").isin(list(BLANK_SOURCES))
    may_be_name = ~F.col("field_id").rlike(NOT_A_NAME) | F.col("field_id").rlike("name|caption")
    place = lambda ok, n, part, ns, k, origin: F.when(
        ok, F.struct(F.lit(n).alias("n"), F.lit(part).alias("part"), ns.alias("namespace"), k.alias("key"), F.lit(origin).alias("origin"))
    )
    composite = from_record & two_dots & (attr == "name_and_address")
    places = F.array_compact(
        F.array(
            place(from_record, 1, "value", head, F.col("field_id"), "case_record"),
            place(from_record & two_dots, 2, "value", head, flat, "case_record"),
            place(from_record & two_dots, 3, "value", own_record, flat, "case_record"),
            place(composite, 4, "name", own_record, F.concat(role, F.lit("_name")), "case_record"),
            place(composite, 5, "name", own_record, role, "case_record"),
            place(composite, 6, "address", own_record, F.concat(role, F.lit("_address")), "case_record"),
            place(from_record & ~two_dots & may_be_name, 7, "value", head, key, "case_record"),
            place(narrative, 8, "value", F.lit("narrative_facts"), F.col("field_id"), "narrative_composed"),
            place(narrative, 9, "value", F.lit("*_record"), F.col("field_id"), "rescued_record_fact"),
            place(blank & (F.col("source") != "wet_ink"), 10, "value", F.lit("narrative_facts"), F.col("field_id"), "human_decision"),
        )
    )
    bucket = (
        F.when(from_record, "unresolved").when(narrative, "narrative").when(recompute, "recompute").when(blank, "blank").otherwise("unresolved")
    )
    by = ["case_id", "form_id", "field_id"]
    asked = case_fields.select(*by, bucket.alias("bucket"), places.alias("places"))
    lookups = asked.select(*by, F.explode("places").alias("p")).select(*by, "p.*")
    known = facts.where(present(F.col("value"))).unionByName(_any_record(facts))
    best = lambda part: F.min(F.when(F.col("part") == part, F.struct("n", "value", "origin")))
    found = (
        lookups.join(by_shuffle(known), ["case_id", "namespace", "key"])
        .groupBy(*by)
        .agg(best("value").alias("v"), best("name").alias("nm"), best("address").alias("ad"))
    )
    value = F.coalesce("v.value", F.nullif(V.join_present(", ", F.col("nm.value"), F.col("ad.value")), F.lit("")))
    origin = F.when(value.isNotNull(), F.coalesce("v.origin", F.lit("case_record")))
    return asked.drop("places").join(by_shuffle(found), by, "left").select(
        *by, F.when(value.isNotNull(), "resolved").otherwise(F.col("bucket")).alias("bucket"), value.alias("value"), origin.alias("origin")
    )


def known_values(resolved: DataFrame, facts: DataFrame) -> DataFrame:
    """What gates may look at: resolved fields before narrative facts before
    records before matter facts."""
    rank = F.when(F.col("namespace") == "narrative_facts", 3).when(F.col("namespace").endswith("_record"), 2).otherwise(1)
    base = facts.select("case_id", F.lit(None).cast("string").alias("form_id"), "key", "value", rank.alias("rank"), "namespace")
    return base.where(present(F.col("value")))


def apply_when(resolved: DataFrame, gates: DataFrame, facts: DataFrame) -> DataFrame:
    """Mark fields whose ``when`` is definitely false as ``skipped``.

    ``gates``: form_id, field_id, ``when`` — ``x == 'v'``, ``x != 'v'``,
    ``x in ['a', 'b']`` or bare ``x``.  An unknown controller leaves the field.
    """
    expr = F.trim("when")
    member, compare, bare = r"^([A-Za-z0-9_]+)\s+in\s+\[(.*)\]$", r"^([A-Za-z0-9_]+)\s*(==|!=)\s*(.+)$", r"^([A-Za-z0-9_]+)$"
    unquote = lambda c: F.regexp_replace(F.trim(c), r"""^(['"])(.*)\1$""", "$2")
    parsed = gates.select(
        "form_id", "field_id",
        F.when(expr.rlike(member), "in").when(expr.rlike(compare), F.regexp_extract(expr, compare, 2)).when(expr.rlike(bare), "bare").alias("op"),
        F.coalesce(*[F.nullif(F.regexp_extract(expr, p, 1), F.lit("")) for p in (member, compare, bare)]).alias("lhs"),
        F.transform(
            F.when(expr.rlike(member), F.split(F.regexp_extract(expr, member, 2), ",")).otherwise(F.array(F.regexp_extract(expr, compare, 3))),
            lambda x: F.lower(unquote(x)),
        ).alias("rhs"),
    ).where("op IS NOT NULL")
    asked = resolved.join(parsed, ["form_id", "field_id"]).select("case_id", "form_id", "field_id", "op", "lhs", "rhs")
    own = resolved.where("bucket = 'resolved'").select("case_id", "form_id", F.col("field_id").alias("lhs"), F.col("value").alias("own_value"))
    shared = (
        known_values(resolved, facts)
        .groupBy("case_id", F.col("key").alias("lhs"))
        .agg(F.max_by("value", F.struct("rank", "namespace")).alias("fact_value"))
    )
    v = F.coalesce("own_value", "fact_value")
    low = F.lower(F.trim(v))
    as_bool = F.coalesce(V.truthy(v), F.lit(True))
    one = F.get("rhs", F.lit(0))
    equal = F.when(one.isin("true", "yes", "false", "no"), as_bool == one.isin("true", "yes")).otherwise(low == one)
    holds = (
        F.when(F.col("op") == "in", F.array_contains("rhs", low))
        .when(F.col("op") == "==", equal)
        .when(F.col("op") == "!=", ~equal)
        .otherwise(as_bool)
    )
    off = (
        asked.join(by_shuffle(own), ["case_id", "form_id", "lhs"], "left")
        .join(by_shuffle(shared), ["case_id", "lhs"], "left")
        .where(v.isNotNull() & ~holds)
        .select("case_id", "form_id", "field_id", F.lit(True).alias("_off"))
    )
    gone = F.coalesce("_off", F.lit(False))
    return resolved.join(by_shuffle(off), ["case_id", "form_id", "field_id"], "left").select(
        "case_id", "form_id", "field_id",
        F.when(gone, "skipped").otherwise(F.col("bucket")).alias("bucket"),
        F.when(~gone, F.col("value")).alias("value"),
        F.when(~gone, F.col("origin")).alias("origin"),
    )


BUCKETS = ("resolved", "narrative", "recompute", "blank", "unresolved", "skipped")


def plan_coverage(plan: DataFrame) -> DataFrame:
    """Fields per bucket, by form."""
    return plan.groupBy("form_id").agg(*[F.count_if(F.col("bucket") == b).alias(b) for b in BUCKETS])


def distribute_records(lists: DataFrame, entity: str, attrs: Sequence[str], cap: int) -> tuple[DataFrame, DataFrame]:
    """Spread a case's list over numbered fields; the rest become overflow
    lines.  ``lists``: case_id, items array<struct<attrs…>>."""
    item = lists.select("case_id", F.posexplode("items").alias("pos", "it"))
    cells = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(f"it.{a}").alias("value")) for a in attrs])
    placed = (
        item.where(F.col("pos") < cap)
        .select("case_id", "pos", F.explode(cells).alias("c"))
        .where(present(F.col("c.value")))
        .select("case_id", F.concat_ws("_", F.lit(entity), (F.col("pos") + 1).cast("string"), "c.attr").alias("field_id"), "c.value")
    )
    line = lambda it: V.join_present(" — ", *[it[a] for a in attrs])
    extra = F.slice("items", cap + 1, F.greatest(F.size("items") - cap, F.lit(1)))
    overflow = lists.where(F.size("items") > cap).select("case_id", F.array_join(F.transform(extra, line), "; ").alias("overflow"))
    return placed, overflow


def canonicalize_enum(value: Column, choices: Column, stems: Mapping[str, str]) -> Column:
    """Map a value onto its allowed choices: (canonical, method), or null.

    Layers in order: same letters and digits; a known stem; the longest
    choice contained in the value or containing it.
    """
    flat = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    nv = flat(value)
    stem = flat(_lookup(stems, nv))
    same = F.filter(choices, lambda c: flat(c) == nv)
    stemmed = F.filter(choices, lambda c: flat(c) == stem)
    inside = F.filter(
        choices,
        lambda c: (flat(c) != "") & ~flat(c).isin("yes", "no") & (nv.contains(flat(c)) | flat(c).contains(nv)),
    )
    longest = F.array_max(F.transform(inside, lambda c: F.struct(F.length(flat(c)).alias("n"), c.alias("c"))))["c"]
    make = lambda c, m: F.struct(c.alias("canonical"), F.lit(m).alias("method"))
    first = lambda a: F.try_element_at(a, F.lit(1))
    return F.when(
        ~F.array_contains(choices, value) & (nv != ""),
        F.when(F.size(same) > 0, make(first(same), "norm"))
        .when(F.size(stemmed) > 0, make(first(stemmed), "stem"))
        .when(longest.isNotNull(), make(longest, "substring")),
    )


def fuzzy_choice(value: Column, choices: Column, least: float = 85.0) -> Column:
    """The allowed choice most similar to a value as a set of words, the first
    of equal ones: (canonical, method), or null below ``least``."""
    scored = F.transform(choices, lambda c, i: F.struct(V.token_set_ratio(F.lower(value), F.lower(c)).alias("score"), (-i).alias("at"), c.alias("choice")))
    best = F.array_max(scored)
    method = F.concat(F.lit("fuzz:"), F.format_number(best["score"], 2))
    return F.when(best["score"] >= least, F.struct(best["choice"].alias("canonical"), method.alias("method")))


def canonicalize_answers(answers: DataFrame, choices: DataFrame, stems: Mapping[str, str], least: float = 85.0) -> DataFrame:
    """Answers that are none of their field's choices, with the choice they
    stand for and the layer that found it (null: none did).

    ``choices``: form_id, field_id, choices (array).  Each different answer of a
    field is looked at once, whatever the number of records that give it.
    """
    keys = ["form_id", "field_id"]
    values = answers.where(present(F.col("value"))).select(*keys, "value").distinct().join(choices, keys)
    values = values.where(~F.array_contains("choices", F.col("value")))
    plain = canonicalize_enum(F.col("value"), F.col("choices"), stems)
    found = values.withColumn("_plain", plain).withColumn("_c", F.coalesce("_plain", F.when(F.col("_plain").isNull(), fuzzy_choice(F.col("value"), F.col("choices"), least))))
    found = found.select(*keys, "value", "_c.canonical", "_c.method")
    return answers.select("record_id", *keys, "value").join(found, [*keys, "value"]).select("record_id", *keys, "value", "canonical", "method")


def clean_currency(value: Column) -> Column:
    """A currency answer made scalar: (value, method), or null when it is fine."""
    s = F.ltrim(value)
    stripped = F.when(s.startswith("$"), F.ltrim(F.substring(s, F.lit(2), F.length(s)))).otherwise(value)
    word = F.regexp_replace(F.lower(stripped), "[^a-z0-9]", "")
    found = V.extract_currency(stripped)
    make = lambda v, m: F.struct(v.alias("value"), F.lit(m).alias("method"))
    return (
        F.when(word.isin("no", "none", "na", "nothing"), make(F.lit(""), "clear-currency"))
        .when((stripped != "") & ~V.is_money(stripped) & (found != ""), make(found, "extract-currency"))
        .when((stripped != "") & ~V.is_money(stripped), make(F.lit(""), "clear-currency-prose"))
        .when(s.startswith("$"), make(stripped, "strip-currency-prefix"))
    )


def infer_gates(answers: DataFrame, deps: DataFrame) -> DataFrame:
    """Empty gates set from their populated dependants.

    ``deps``: form_id, field_id, gate, target.  Gates already answered stay;
    dependants of different targets are reported as a conflict.
    """
    filled = answers.where(present(F.col("value"))).join(deps, ["form_id", "field_id"]).select("record_id", "form_id", "gate", "target", "field_id")
    per_gate = filled.groupBy("record_id", "form_id", "gate").agg(
        F.count_distinct("target").alias("n_targets"), F.min("target").alias("target"), F.count("*").alias("n_deps")
    )
    answered = answers.where(present(F.col("value"))).select("record_id", "form_id", F.col("field_id").alias("gate"))
    open_gates = per_gate.join(answered, ["record_id", "form_id", "gate"], "left_anti")
    conflict = F.col("n_targets") > 1
    return open_gates.select(
        "record_id", "form_id", "gate",
        F.when(conflict, "conflict").otherwise("inferred").alias("action"),
        F.when(~conflict, F.col("target")).alias("value"),
        "n_deps",
    )


class FillRule(NamedTuple):
    """One row of a rule pack: which fields, from what, how sure, by what name."""

    pattern: str
    value: Column
    confidence: float
    method: str


def fill_if_blank(answers: DataFrame, rules: Sequence[FillRule]) -> DataFrame:
    """Blank answers filled by the first rule whose pattern matches the field.

    Rules are compiled to one expression, so a pack costs no join.  Confidence
    is raised to the rule's floor and the source is appended to provenance.
    """
    # values become columns first, so that no expression is repeated in the chain
    answers = answers.withColumns({f"_r{i}": r.value.cast("string") for i, r in enumerate(rules)})
    hit = F.lit(None).cast("struct<value:string,confidence:double,method:string>")
    for i, r in reversed(list(enumerate(rules))):
        value = F.col(f"_r{i}")
        made = F.struct(value.alias("value"), F.lit(r.confidence).alias("confidence"), F.lit(r.method).alias("method"))
        hit = F.when(F.col("field_id").rlike(r.pattern) & present(value), made).otherwise(hit)
    staged = answers.withColumn("_hit", F.when(~present(F.coalesce("value", F.lit(""))), hit))
    step = F.struct(F.col("value").alias("from"), F.col("_hit.value").alias("to"), F.col("_hit.method").alias("method"))
    return staged.withColumns(
        {
            "value": F.coalesce("_hit.value", "value"),
            "confidence": F.when(F.col("_hit").isNotNull(), F.greatest("confidence", "_hit.confidence")).otherwise(F.col("confidence")),
            "provenance": F.when(F.col("_hit").isNotNull(), F.array_append("provenance", step)).otherwise(F.col("provenance")),
        }
    ).drop("_hit", *[f"_r{i}" for i in range(len(rules))])


def date_pack(event_date: Column, years: int = 1) -> list[FillRule]:
    """Worked example: signature dates from the event, report dates a year on."""
    return [
        FillRule(r"(^|_)(signature_date|date_signed|signed_date|dated)$", F.date_format(event_date, "yyyy-MM-dd"), 0.85, "signature-date"),
        FillRule(r"(^|_)report_period_end$", F.date_format(V.shift_date(event_date, years=years), "yyyy-MM-dd"), 0.8, "anniversary"),
        FillRule(r"_day$", F.day(event_date).cast("string"), 0.8, "date-word"),
        FillRule(r"_month$", F.date_format(event_date, "MMMM"), 0.8, "date-word"),
    ]


def contact_pack(person: Column, domains: Sequence[str]) -> list[FillRule]:
    """Worked example: stable contact details from a name."""
    user = F.regexp_replace(F.lower(F.trim(person)), "[^a-z0-9]+", ".")
    return [
        FillRule(r"_email$", F.concat(user, F.lit("@"), V.seeded_choice(person, domains)), 0.7, "seeded-email"),
        FillRule(r"_bar_(no|number)$", F.lpad((1000 + V.seeded_pick(person, 9000)).cast("string"), 4, "0"), 0.7, "seeded-bar"),
    ]


def constant_pack(rows: Sequence[tuple[str, str, str]], confidence: float = 0.75) -> list[FillRule]:
    """Fixed text per field pattern: (pattern, text, method)."""
    return [FillRule(p, F.lit(text), confidence, method) for p, text, method in rows]


def copy_pack(rows: Sequence[tuple[str, Column, str]], confidence: float = 0.8) -> list[FillRule]:
    """Values the record already holds elsewhere: (pattern, column, method).

    Captions, petitioner and closing blocks, printed names and addresses are
    all rows of this kind.
    """
    return [FillRule(p, column, confidence, method) for p, column, method in rows]


def age_pack(dob: Column, day: Column, pattern: str = r"(^|_)age$") -> list[FillRule]:
    """Whole years from a birth date (a date column) on a given day."""
    return [FillRule(pattern, V.age_on(dob, day).cast("string"), 0.85, "age-from-birth-date")]


def derive_totals(answers: DataFrame, slots: str, total: str) -> DataFrame:
    """Blank totals from the numbered rows above them, which stay blank when
    no row is filled.  ``slots`` is the pattern of the row fields."""
    by = ["record_id", "form_id"]
    sums = (
        answers.where(F.col("field_id").rlike(slots) & present(F.col("value")))
        .groupBy(*by)
        .agg(F.sum(V.to_amount(F.col("value"))).alias("s"), F.count("*").alias("n_rows"))
    )
    blank = answers.where((F.col("field_id") == total) & ~present(F.coalesce("value", F.lit(""))))
    return blank.join(sums, by).select(*by, "field_id", F.format_number("s", 2).alias("value"), "n_rows")


def cross_form_fill(answers: DataFrame) -> DataFrame:
    """Blank values taken from another form of the same case; the first form
    in order that has one."""
    donor = (
        answers.where(present(F.col("value")))
        .groupBy("case_id", "field_id")
        .agg(F.min(F.struct("form_id", "value")).alias("d"))
    )
    blank = answers.where(~present(F.coalesce("value", F.lit(""))))
    return blank.join(donor, ["case_id", "field_id"]).select(
        "case_id", "form_id", "field_id", F.col("d.value").alias("value"), F.col("d.form_id").alias("from_form")
    )


def apply_rename_fixes(fields: DataFrame, renames: DataFrame) -> DataFrame:
    """Renames with their outcome: applied, collision (the new name exists)
    or not_found (the old one does not)."""
    names = fields.select("form_id", "field_id").distinct()
    old = names.select("form_id", F.col("field_id").alias("current"), F.lit(True).alias("_has"))
    new = names.select("form_id", F.col("field_id").alias("suggested"), F.lit(True).alias("_taken"))
    outcome = (
        F.when(F.col("_has").isNull(), "not_found")
        .when(F.col("_taken") & (F.col("suggested") != F.col("current")), "collision")
        .otherwise("applied")
    )
    return (
        renames.join(old, ["form_id", "current"], "left")
        .join(new, ["form_id", "suggested"], "left")
        .select("form_id", "current", "suggested", outcome.alias("outcome"))
    )


def alias_rename(fields: DataFrame, aliases: DataFrame, overrides: DataFrame) -> DataFrame:
    """Field names through a per-form override, else a global alias."""
    o = overrides.select("form_id", "field_id", F.col("new_name").alias("_o"))
    a = aliases.select("field_id", F.col("new_name").alias("_a"))
    return (
        fields.join(o, ["form_id", "field_id"], "left")
        .join(a, "field_id", "left")
        .withColumn("new_name", F.coalesce("_o", "_a", "field_id"))
        .drop("_o", "_a")
    )


def plan_vs_readback(planned: DataFrame, placed: DataFrame) -> DataFrame:
    """Planned values against what was placed: match, mismatch, missing or
    overflowed.

    A placed value may be cut into chained parts (``part``), which are joined
    in order; multi-choice values compare as sets.
    """
    key = ["record_id", "field_id"]
    joined = placed.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "value"))), lambda p: p["value"]), " ").alias("got")
    )
    p, g = V.norm(F.col("value")), V.norm(F.col("got"))
    items = lambda c: F.array_distinct(F.transform(F.split(c, ";"), lambda x: F.trim(x)))
    same_set = (F.size(F.array_except(items(p), items(g))) == 0) & (F.size(F.array_except(items(g), items(p))) == 0)
    status = (
        F.when(F.col("got").isNull() | (g == ""), "missing")
        .when(p == g, "match")
        .when(F.col("multi") & same_set, "match")
        .when((F.length(g) < F.length(p)) & p.startswith(g), "overflowed")
        .otherwise("mismatch")
    )
    return planned.join(joined, key, "left").select(*key, "value", "got", status.alias("status"))


def stale_outputs(outputs: DataFrame, compat: DataFrame) -> DataFrame:
    """Outputs whose (case type, form prefix) the present rules reject.

    ``compat``: prefix, case_type pairs allowed; prefixes not listed take any.
    """
    prefix = F.regexp_extract("form_id", "^([A-Z]+)", 1)
    ruled = compat.select("prefix").distinct()
    return (
        outputs.withColumn("prefix", prefix)
        .join(ruled, "prefix", "left_semi")
        .join(compat, ["prefix", "case_type"], "left_anti")
        .groupBy("form_id", "case_type")
        .agg(F.count("*").alias("n"))
    )


def bind_geometry(fields: DataFrame, rects: DataFrame) -> DataFrame:
    """Field nodes to widget rectangles: explicit ones, else detected by id.

    ``fields``: form_id, field_id, ``explicit`` array<struct<page,x0,y0,x1,y1>>,
    locked.
    """
    given = fields.select(
        "form_id", "field_id", "locked", F.posexplode("explicit").alias("idx", "r")
    ).select("form_id", "field_id", "locked", "idx", "r.*", F.lit("explicit").alias("source"))
    w = Window.partitionBy("form_id", "field_id").orderBy("page", "y0", "x0", "rect_id")
    found = (
        fields.where(F.size("explicit") == 0)
        .select("form_id", "field_id", "locked")
        .join(rects.select("form_id", "field_id", "page", "rect_id", "x0", "y0", "x1", "y1"), ["form_id", "field_id"])
        .select("form_id", "field_id", "locked", (F.row_number().over(w) - 1).alias("idx"), "page", "x0", "y0", "x1", "y1", F.lit("detected").alias("source"))
    )
    return given.unionByName(found)


def dangling_references(checks: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """References with no target.  Each check is (refs with ``ref``, targets
    with ``ref``); results carry the check's name as ``reason``."""
    out: DataFrame | None = None
    for reason, (refs, targets) in checks.items():
        lost = refs.select(F.col("ref").cast("string").alias("ref")).distinct().join(
            targets.select(F.col("ref").cast("string").alias("ref")), "ref", "left_anti"
        ).withColumn("reason", F.lit(reason))
        out = lost if out is None else out.unionByName(lost)
    return out


#: Fields (of all forms, repeats merged) up to which they are broadcast.
BROADCAST_FIELDS = 100_000
CASE_SALTS = 64


def synthesize_cases(
    seeds: DataFrame, roles: Sequence[str], first: Sequence[str], last: Sequence[str], fields: DataFrame, stress: bool = False
) -> DataFrame:
    """Seeded cases: one identity per role and a stable value for each field.

    ``seeds``: case_id, case_type, form_id.  The same seed gives the same case
    on every run.  A field that names a person takes the one of its ``role``,
    if ``fields`` has that column and the role is among ``roles``, else that of
    the first role.  ``stress`` makes long names and large amounts, to shake out
    overflow.

    A form may list one field many times over.  Equal rows would be all a case
    got from that, so a case gets one row for a field of one kind, with
    ``n_fields``, the number of times its form lists it.
    """
    pick = lambda r, what, bank: V.seeded_choice(F.concat_ws("|", "case_id", F.lit(r), F.lit(what)), bank)
    hyphened = lambda r, what, bank: F.concat_ws("-", pick(r, what, bank), pick(r, what + "_2", bank))
    who = lambda r: F.concat_ws(" ", pick(r, "first", first), pick(r, "last", last))
    if stress:
        who = lambda r: F.concat_ws(" ", hyphened(r, "first", first), hyphened(r, "last", last), pick(r, "last_3", last))
    made = F.coalesce(F.col("data_type").isin("currency", "date", "boolean"), F.lit(False))
    role = F.lit(0)
    for i, r in enumerate(roles):
        role = F.when(F.col("role") == r, i).otherwise(role) if "role" in fields.columns else role
    listed = fields.groupBy(
        "form_id", "field_id", F.when(made, F.col("data_type")).alias("kind"), F.when(~made, role).alias("role_no")
    ).agg(F.count("*").alias("n_fields"))
    # a case gives a row per field of its form, so a small file of cases is dealt out first
    cases = dealt(seeds, "case_id").withColumns({f"_person_{i}": who(r) for i, r in enumerate(roles)})
    # there are few forms, so a plain shuffle would bring all cases to a few tasks
    if listed.limit(BROADCAST_FIELDS + 1).count() <= BROADCAST_FIELDS:
        paired = cases.join(F.broadcast(listed), "form_id")
    else:
        salted = cases.withColumn("_salt", F.pmod(F.xxhash64("case_id"), F.lit(CASE_SALTS)).cast("int"))
        copies = listed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(CASE_SALTS - 1))))
        paired = salted.join(by_shuffle(copies), ["form_id", "_salt"])
    person = F.coalesce(*[F.when(F.col("role_no") == i, F.col(f"_person_{i}")) for i in range(len(roles))])
    # the number of a value is drawn once, in a step before its text, not once for each kind
    drawn = F.when(F.col("kind").isNotNull(), V.seeded_number(F.concat_ws("|", "case_id", "field_id")))
    draw = lambda n: (F.col("_drawn") % n).cast("int")
    amount = (draw(90_000_000) + 10_000_000 if stress else draw(90000) + 100).cast("string")
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), draw(1500)), "yyyy-MM-dd")
    value = (
        F.when(F.col("kind") == "currency", amount)
        .when(F.col("kind") == "date", day)
        .when(F.col("kind") == "boolean", F.when(draw(2) == 0, "yes").otherwise("no"))
        .otherwise(person)
    )
    return paired.withColumn("_drawn", drawn).select("case_id", "case_type", "form_id", "field_id", value.alias("value"), "n_fields")


def merge_provenance(answers: DataFrame) -> DataFrame:
    """How many repair steps each method took."""
    return answers.select(F.explode("provenance").alias("p")).groupBy(F.col("p.method").alias("method")).agg(F.count("*").alias("n"))
