"""Text predicates and name cleaning, all as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a section heading.
SECTION_WORDS = (
    "information", "petitioner", "co-petitioner", "respondent", "minor", "decedent",
    "guardian", "conservator", "heir", "devisee", "fiduciary", "attorney",
    "applicant", "ward", "estate", "interested person",
)
# Words that decide the type of a blank.
SIGNATURE_WORDS = ("signature", "sign", "subscribed", "sworn")
DATE_WORDS = ("date", "dob", "dod", "mm/dd/yyyy", "mm/dd/yy", "month", "day", "year")
CURRENCY_WORDS = ("$", "amount", "value", "total", "balance", "dollars")
# Phrases that make a line a prompt.
PROMPT_PATTERN = r"(?i):$|name of\b|address of\b|date of\b|telephone\b|phone\b|email\b"
SIGNATURE_MIN_WIDTH = 200.0


def any_word(words: Sequence[str]) -> str:
    """A regex matching any of ``words`` literally."""
    special = r"\.^$|?*+()[]{}"
    return "|".join("".join("\\" + c if c in special else c for c in w) for w in words)


def has_word(text: Column, words: Sequence[str]) -> Column:
    return F.lower(text).rlike(any_word(words))


def n_words(text: Column) -> Column:
    """Whitespace-separated tokens; 0 for blank text."""
    t = F.trim(text)
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"\s+")))


# Leading item numbers, and citations and blanks that no heading has.
ITEM = r"^\d+[a-z]?\.\s*"
STATE_CODE, FEDERAL_CODE, BLANK, SECTION_SIGN = r"\bM\.?\s*R\.?\s*S\.?\b", r"\bU\.?\s*S\.?\s*C\.?\b", "___", "§"


def is_section_header(text: Column, roles: Sequence[str] = SECTION_WORDS) -> Column:
    """Numbered short title, capitals, or "role …:", each naming a role.

    Lines holding citations or blanks never count.
    """
    t = F.trim(text)
    title = F.trim(F.regexp_replace(t, ITEM, ""))
    usable = (
        (F.length(t) >= 5)
        & ~t.contains(SECTION_SIGN)
        & ~t.contains(BLANK)
        & ~t.rlike(STATE_CODE)
        & ~t.rlike(FEDERAL_CODE)
    )
    numbered = t.rlike(r"^\d+[a-z]?\.\s+\S") & ~title.rlike(r"[?.]$") & n_words(title).between(2, 7)
    capitals = t.rlike("[A-Z]") & (F.upper(t) == t) & n_words(t).between(2, 6)
    labelled = t.endswith(":") & (n_words(title) >= 2) & (n_words(t) <= 6)
    return usable & has_word(t, roles) & (numbered | capitals | labelled)


def cut_at_word(text: Column, limit: int = 60) -> Column:
    """At most ``limit`` characters, cut back to the last space."""
    head = F.substring(text, 1, limit)
    cut = F.when(head.contains(" "), F.regexp_replace(head, r" [^ ]*$", "")).otherwise(head)
    return F.when(F.length(text) > limit, cut).otherwise(text)


def looks_like_body_text(text: Column) -> Column:
    """A wrapped sentence rather than a label."""
    t = F.trim(text)
    underscores = F.length(t) - F.length(F.translate(t, "_", ""))
    return (t != "") & (
        (F.length(t) > 50) | t.rlike(r"[.,;]$") | (F.greatest(n_words(t), underscores + 1) >= 5)
    )


def is_prompt_label(text: Column) -> Column:
    t = F.trim(text)
    return (F.length(t) >= 5) & t.rlike(PROMPT_PATTERN)


def is_numbering(text: Column) -> Column:
    return F.trim(text).rlike(r"^\d+[a-z]?\.?$")


def classify_field_type(label: Column, width: Column) -> Column:
    """signature, date, currency or text, from the label and the blank's width."""
    return (
        F.when(has_word(label, SIGNATURE_WORDS) & (width >= SIGNATURE_MIN_WIDTH), "signature")
        .when(has_word(label, DATE_WORDS), "date")
        .when(has_word(label, CURRENCY_WORDS), "currency")
        .otherwise("text")
    )


def to_snake_case(text: Column) -> Column:
    """Lower snake case; a name may not start with a digit."""
    s = F.lower(F.trim(F.regexp_replace(F.trim(text), r"[:.\s]+$", "")))
    s = F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(s.rlike("^[0-9]"), F.concat(F.lit("f_"), s)).otherwise(s)


def clean_label(text: Column) -> Column:
    """Like ``to_snake_case``, but names already in that form stay."""
    s = F.trim(F.regexp_replace(F.trim(text), r"[:. ]+$", ""))
    return F.when(s.rlike("^[a-z][a-z0-9_]*$"), s).otherwise(to_snake_case(text))


def slugify(text: Column, limit: int = 45) -> Column:
    s = F.regexp_replace(F.trim(F.lower(text)), "[:.,?#]+$", "")
    s = F.substring(F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, limit)
    return F.when(s == "", "field").otherwise(s)


def present(value: Column) -> Column:
    """Not null and not blank."""
    return value.isNotNull() & (F.trim(value) != "")


def is_repr_leak(value: Column) -> Column:
    """A printed list or mapping where a value should be."""
    return F.trim(value).rlike(r"^\s*(\[\s*['\"{\[]|\{\s*['\"])")
