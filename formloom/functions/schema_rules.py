"""What a schema field is, from its name, category and declared source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk points per category, subcategory and evaluation outcome.
CATEGORY_RISK = {
    "case_constant": 0, "party_attr": 0, "computed": 0, "signature": 5,
    "external": 5, "narrative_derived": 5, "legal_choice": 20, "other": 30,
}
SLOT_RISK = 15
OUTCOME_RISK = {"wrong": 20, "overconfident": 8, "misunderstood": 12}


def _map(table: Mapping, key: Column, default: Column) -> Column:
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default)


def risk_score(category: Column, subcategory: Column, wrong: Column, overconfident: Column, misunderstood: Column) -> Column:
    """0 to 100: category base, repeating-slot bonus and weighted evidence."""
    base = _map(CATEGORY_RISK, category, F.lit(30))
    slot = F.when(subcategory == "repeating_slot", SLOT_RISK).otherwise(0)
    seen = sum(
        (F.coalesce(c, F.lit(0)) * OUTCOME_RISK[k] for k, c in (("overconfident", overconfident), ("misunderstood", misunderstood))),
        F.coalesce(wrong, F.lit(0)) * OUTCOME_RISK["wrong"],
    )
    return F.least(F.lit(100), F.greatest(F.lit(0), base + slot + seen)).cast("int")


def risk_tier(score: Column) -> Column:
    return F.when(score <= 15, "green").when(score <= 35, "yellow").when(score <= 65, "orange").otherwise("red")


def first_match(name: Column, patterns: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """The value of the first pattern that matches; patterns are in order."""
    out = F.lit(default)
    for pattern, value in reversed(patterns):
        out = F.when(F.lower(name).rlike(pattern), value).otherwise(out)
    return out


# Data types by how a field name ends, in order of precedence.
TYPE_PATTERNS = (
    (r"_(name_address(_email|_phone|_email_phone)?|address_email_phone|email_phone)$", "text"),
    (r"_(val|value|amount|enc|encumbrance|fee|cost|price)$", "currency"),
    (r"_(date|dated|on)$", "date"),
    (r"_(phone|fax|telephone)$", "phone"),
    (r"_email$", "email"),
    (r"_(address|street)$", "address"),
    (r"_bar(_no|_number|)?$", "bar_number"),
    (r"^docket_(no|number)$", "docket_number"),
)


def data_type_by_name(name: Column, category: Column) -> Column:
    return (
        F.when((category == "signature") & F.lower(name).contains("_dated"), "date")
        .when(category == "signature", "signature")
        .when(category == "computed", "currency")
        .otherwise(
            F.coalesce(
                first_match(name, TYPE_PATTERNS), F.when(category == "legal_choice", "checkbox"), F.lit("text")
            )
        )
    )


def fill_source(category: Column, subcategory: Column, party: Column) -> Column:
    """Where a field's value comes from."""
    return (
        F.when(category == "case_constant", F.concat(F.lit("case_dict."), subcategory))
        .when(category == "party_attr", F.concat(party, F.lit("_record."), subcategory))
        .when(category == "computed", "recompute_from_dependencies")
        .when(category == "signature", "wet_ink")
        .when(category == "external", "left_blank")
        .when(category == "legal_choice", "human_decision")
        .when(category == "narrative_derived", "llm_over_narrative")
        .otherwise("triage")
    )


def fill_actor(category: Column) -> Column:
    """Who may fill it: rules, model, person, nobody, or model and person."""
    return (
        F.when(category.isin("case_constant", "party_attr", "computed"), "rules")
        .when(category.isin("signature", "legal_choice"), "person")
        .when(category == "external", "nobody")
        .when(category == "narrative_derived", "model")
        .otherwise("model_then_person")
    )


def canonical_type(data_type: Column, field_type: Column) -> Column:
    """Exchange type from declared data and widget types."""
    choice = F.when(field_type == "select_one", "choice").when(field_type == "select_many", "choice_multi")
    by_data = (
        F.when(data_type == "currency", "currency")
        .when(data_type == "date", "date")
        .when(data_type.isin("checkbox", "boolean"), F.coalesce(choice, F.lit("boolean")))
        .when(data_type == "email", "email")
        .when(data_type == "phone", "phone")
        .when(data_type == "signature", "signature")
    )
    return F.coalesce(by_data, choice, F.lit("string"))


def binding(source: Column, field_id: Column, data_type: Column) -> Column:
    """kind, role, key and token of a field's declared source."""
    head = F.substring_index(source, ".", 1)
    attr = F.when(source.contains("."), F.regexp_replace(source, r"^[^.]*\.", "")).otherwise(field_id)
    other = (
        F.when(head == "wet_ink", "signature")
        .when(head.isin("human_decision", "left_blank"), F.when(data_type == "signature", "signature").otherwise("manual"))
        .when(head == "llm_over_narrative", F.when(data_type == "signature", "signature").otherwise("narrative"))
        .when(head == "recompute_from_dependencies", "computed")
        .when(head == "triage", "routing")
    )
    is_record = head.endswith("_record")
    role = (
        F.when(head == "case_dict", "matter")
        .when(is_record, F.regexp_replace(head, "_record$", ""))
        .otherwise(F.coalesce(F.nullif(head, F.lit("")), F.lit("matter")))
    )
    token = F.when(is_record, F.concat_ws("_", role, attr)).otherwise(attr)
    none = F.lit(None).cast("string")
    return F.struct(
        F.coalesce(other, F.lit("data")).alias("kind"),
        F.when(other.isNull(), role).otherwise(none).alias("role"),
        F.when(other.isNull(), attr).otherwise(none).alias("key"),
        F.when(other.isNull(), token).otherwise(none).alias("token"),
    )


def alignment(name: Column, data_type: Column, right_types: Sequence[str] = ("currency", "number")) -> Column:
    return (
        F.when(F.lower(name).contains("caption"), "center")
        .when(data_type.isin(list(right_types)), "right")
        .otherwise("left")
    )


def layout_alignment(x0: Column, x1: Column, page_width: float, tolerance: float = 10.0) -> Column:
    """Alignment suggested by where a widget stands on the page."""
    mid = (x0 + x1) / 2
    return F.when(F.abs(mid - page_width / 2) <= tolerance, "center").when(x0 > page_width / 2, "right").otherwise("left")
