"""Filters on drawings, text and widgets of a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.functions import text as X
from formloom.operators.pairs import PAGE, Reach, page_anti, page_pairs
from formloom.operators.ranking import block_window, neighbours, rank_in_groups, running

# Fixed values, in points.
MIN_RULE = 50.0
MAX_STROKE = 3.0
PAGE_RULE_MARGIN = 20.0
BOX_MIN, BOX_MAX, BOX_ASPECT = 8.0, 16.0, 1.3
BOX_GLYPHS = "☐☒✓✗❑❒□■◇◆"


def horizontal_rules(drawings: DataFrame, pages: DataFrame) -> DataFrame:
    """Thin wide strokes, page-wide separators left out."""
    b = G.box()
    thin = drawings.where(
        F.col("kind").isin("line", "rect") & (G.width(b) >= MIN_RULE) & (G.height(b) <= MAX_STROKE)
    )
    return (
        thin.join(pages.select(*PAGE, "width"), list(PAGE))
        .where(G.width(b) < F.col("width") - 2 * PAGE_RULE_MARGIN)
        .drop("width")
    )


def vertical_rules(drawings: DataFrame) -> DataFrame:
    b = G.box()
    return drawings.where(
        F.col("kind").isin("line", "rect") & (G.height(b) >= MIN_RULE) & (G.width(b) <= MAX_STROKE)
    )


def checkbox_rects(drawings: DataFrame) -> DataFrame:
    b = G.box()
    w, h = G.width(b), G.height(b)
    return drawings.where(
        (F.col("kind") == "rect")
        & w.between(BOX_MIN, BOX_MAX)
        & h.between(BOX_MIN, BOX_MAX)
        & (F.greatest(w, h) <= BOX_ASPECT * F.least(w, h))
    )


def underscore_runs(spans: DataFrame, rules: DataFrame, min_chars: int = 5) -> DataFrame:
    """Blanks printed as underscores, placed by the share of characters
    before them; those on a drawn rule are left out."""
    pieces = F.regexp_extract_all("text", F.lit("_+|[^_]+"), 0)
    walked = (
        spans.where(F.col("text").contains("_" * min_chars))
        .select("*", F.posexplode(pieces).alias("_i", "_piece"), pieces.alias("_all"))
        .withColumn("_from", F.length(F.array_join(F.expr("slice(_all, 1, _i)"), "")))
        .where(F.col("_piece").rlike(f"^_{{{min_chars},}}$"))
    )
    per_char = (F.col("x1") - F.col("x0")) / F.length("text")
    runs = walked.select(
        *PAGE,
        "span_id",
        F.col("_from").alias("start"),
        (F.col("x0") + F.col("_from") * per_char).alias("x0"),
        "y0",
        (F.col("x0") + (F.col("_from") + F.length("_piece")) * per_char).alias("x1"),
        "y1",
    ).where(F.col("x1") - F.col("x0") >= MIN_RULE)
    a, b = G.box(), G.box("r_")
    return page_anti(
        runs,
        rules,
        (F.abs(b.y0 - a.y1) < 4) & (b.x1 >= a.x0 - 5) & (b.x0 <= a.x1 + 5),
        id_cols=(*PAGE, "span_id", "start"),
        reach=Reach(5, 4, 5, 4),
    )


def merge_adjacent_runs(hits: DataFrame, words: DataFrame, min_width: float = 50.0) -> DataFrame:
    """Join hits of one row whose gap is at most 5; drop short results and
    left-margin footnote separators (a digit starts the text just below)."""
    ranked = rank_in_groups(
        hits, PAGE, [F.col("y0"), F.col("x0"), F.col("hit_id")], [F.floor(F.col("y0") / 64)]
    )
    w = block_window(PAGE)
    flagged = neighbours(
        ranked,
        PAGE,
        {
            "_py": F.lag("y0").over(w),
            "_px": F.lag("x1").over(w),
        },
        behind=1,
    )
    starts = F.col("_py").isNull() | (F.abs(F.col("y0") - F.col("_py")) >= 3) | (F.col("x0") > F.col("_px") + 5)
    grouped = running(flagged, PAGE, starts.cast("int"), "run_id")
    merged = (
        grouped.groupBy(*PAGE, "run_id")
        .agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
        .where(F.col("x1") - F.col("x0") >= min_width)
    )
    b = G.box("r_")
    # first word below the run's left end decides
    below = page_pairs(
        merged.where("x0 < 90"),
        words.where(~F.col("text").rlike("^[_ \t]*$")),
        (b.x1 > F.col("x0") - 5) & (b.x0 < F.col("x0") + 80) & (b.y1 > F.col("y1")) & (b.y0 < F.col("y1") + 14),
        reach=Reach(5, 0, 80, 14),
    )
    first = below.groupBy(*PAGE, "run_id").agg(
        F.min_by("r_text", F.struct("r_y0", "r_x0", "r_line_id")).alias("first_word")
    )
    footnotes = first.where(F.col("first_word").rlike("^[0-9¹²³⁴⁵⁶⁷⁸⁹]"))
    return merged.join(footnotes, [*PAGE, "run_id"], "left_anti")


def glyph_boxes(spans: DataFrame) -> DataFrame:
    """Small square spans showing a box glyph, a private-use code point or
    nothing; one per 2-point bin."""
    b = G.box()
    w, h = G.width(b), G.height(b)
    t = F.trim("text")
    square = w.between(4, 14) & h.between(4, 14) & (F.greatest(w, h) <= 1.6 * F.least(w, h))
    private_use = t.rlike("[\\x{E000}-\\x{F8FF}]")
    shown = (t == "") | t.rlike(f"^[{BOX_GLYPHS}]$") | private_use
    bins = [F.round(F.col("x0") / 2).alias("bx"), F.round(F.col("y0") / 2).alias("by")]
    return (
        spans.where(square & shown)
        .groupBy(*PAGE, *bins)
        .agg(F.min(F.struct("y0", "x0", "span_id", "x1", "y1")).alias("_s"))
        .select(*PAGE, "_s.span_id", "_s.x0", "_s.y0", "_s.x1", "_s.y1")
    )


def clamp_to_margins(
    widgets: DataFrame,
    pages: DataFrame,
    top: float = 18.0,
    bottom: float = 18.0,
    side: float = 12.0,
    sliver: float = 6.0,
) -> DataFrame:
    """Widgets centred in a margin go, the rest are cut to the page body."""
    b = G.box()
    inside = (
        G.center_y(b).between(F.lit(top), F.col("height") - bottom)
        & G.center_x(b).between(F.lit(side), F.col("width") - side)
    )
    return (
        widgets.join(pages, list(PAGE))
        .where(inside)
        .select(
            *PAGE,
            "rect_id",
            F.greatest("x0", F.lit(side)).alias("x0"),
            F.greatest("y0", F.lit(top)).alias("y0"),
            F.least(F.col("x1"), F.col("width") - side).alias("x1"),
            F.least(F.col("y1"), F.col("height") - bottom).alias("y1"),
        )
        .where((F.col("x1") - F.col("x0") >= sliver) & (F.col("y1") - F.col("y0") >= sliver))
    )


def suppress_fields(widgets: DataFrame, schema: DataFrame, court_only: str) -> DataFrame:
    """Widgets whose schema field must stay without one, unless locked.

    ``schema`` carries ``fill_source, category, field_type, suppress, court_only``.
    """
    rule = (
        F.col("suppress")
        | (F.col("fill_source") == "wet_ink")
        | ((F.col("category") == "signature") & (F.col("field_type") == "signature"))
        | ((F.col("fill_source") == "left_blank") & F.col("field_id").rlike(court_only))
        | F.col("court_only")
    )
    flagged = schema.where(rule).select("form_id", "field_id").distinct()
    return widgets.where(~F.col("locked")).join(flagged, ["form_id", "field_id"], "left_semi")


def narrative_single_lines(widgets: DataFrame, schema: DataFrame, short_fact: str, max_height: float = 16.0) -> DataFrame:
    """Free-text fields whose every widget is one line high, short facts
    (dates, names, amounts …) left out."""
    height = F.col("y1") - F.col("y0")
    one_line = (
        widgets.groupBy("form_id", "field_id").agg(F.max(height).alias("tallest"), F.count("*").alias("n_widgets"))
    ).where(F.col("tallest") <= max_height)
    open_text = schema.where(
        (F.col("fill_source") == "llm_over_narrative") & ~F.col("field_id").rlike(short_fact)
    ).select("form_id", "field_id")
    return one_line.join(open_text.distinct(), ["form_id", "field_id"], "left_semi")


# Where a line stops being an answer area.
OPTION_INDENT = 115.0
SUBLABEL = (
    r"(?i)^(name|address|phone|email|fax|zip|city|state|county|bar\s+number|license|"
    r"date\s+of\s+birth|signature|title)\b"
)
PROMPT_LINE = r"(?i):\s*$|\?\s*$|^\s*\d{1,2}[a-z]?[.)]\s|explain"
NO_ANSWER_BELOW = (
    r"(?i)under\s+penalty\s+of\s+perjury|i\s+hereby\s+certif|i\s+declare\s+(under|that)|"
    r"i\s+swear\s+(under|that)|in\s+witness\s+whereof|subscribed\s+and\s+sworn|"
    r"fees?\s+due\s+(upon|on)\s+filing|for\s+(court|register|office)\s+use|court\s+use\s+only|"
    r"do\s+not\s+write\s+(below|above)\s+this|filing\s+fee\s*[:$]|"
    r"action\s+by\s+the\s+(register|judge|court)|bond\s+requirement"
)


def prompt_lines(
    lines: DataFrame,
    look_ahead: int = 8,
    indent: float = OPTION_INDENT,
    sub_indent: float = 100.0,
    sublabel: str = SUBLABEL,
    stop: str = NO_ANSWER_BELOW,
) -> DataFrame:
    """Lines that ask for an answer, with what stands under them.

    ``is_option`` lines are short and indented.  A prompt is dropped when half
    of the next lines are options, when two of them are left-margin sub-labels,
    or when it lies in a zone opened by a ``stop`` line.
    """
    text = F.trim("text")
    marked = lines.withColumns(
        {
            "is_option": ((F.col("x0") > indent) & (F.length(text) < 80))
            | text.rlike("^[☐☑□■]"),
            "is_sublabel": (F.col("x0") <= sub_indent) & text.rlike(sublabel),
            "is_prompt": text.rlike(PROMPT_LINE) & ~((F.col("x0") > indent) & (F.length(text) < 60)),
        }
    )
    ranked = rank_in_groups(
        marked, PAGE, [F.col("y0"), F.col("x0"), F.col("line_id")], [F.floor(F.col("y0") / 64)]
    )
    w = block_window(PAGE).rowsBetween(1, look_ahead)
    seen = neighbours(
        ranked,
        PAGE,
        {
            "n_ahead": F.count("*").over(w),
            "n_options": F.count_if("is_option").over(w),
            "n_sublabels": F.count_if("is_sublabel").over(w),
        },
        ahead=look_ahead,
    )
    zones = lines.where(F.col("text").rlike(stop)).groupBy(*PAGE).agg(F.min("y0").alias("stop_y"))
    keep = (
        F.col("is_prompt")
        & ~((F.col("n_ahead") > 0) & (F.col("n_options") * 2 >= F.col("n_ahead")))
        & (F.col("n_sublabels") < 2)
        & (F.col("stop_y").isNull() | (F.col("y0") < F.col("stop_y")))
    )
    return (
        seen.join(zones, list(PAGE), "left")
        .where(keep)
        .select(*PAGE, "line_id", "text", "n_ahead", "n_options", "n_sublabels")
    )


def inline_labels(prompts: DataFrame, lines: DataFrame, right_margin: float, min_width: float = 40.0) -> DataFrame:
    """Blank space to the right of a label ending in a colon, up to the next
    text on its row or the right margin."""
    a, b = G.box(), G.box("r_")
    labels = lines.where(F.rtrim("text").endswith(":") & ~F.trim("text").startswith("(")).join(
        prompts.select(*PAGE, "line_id"), [*PAGE, "line_id"], "left_semi"
    )
    after = (
        page_pairs(
            labels.select(*PAGE, "line_id", "x0", "y0", "x1", "y1"),
            lines,
            (b.x0 >= a.x1) & (G.overlap_y(a, b) > 0),
            reach=Reach(0, 0, right_margin, 0),
            cell=(1024.0, 64.0),
        )
        .groupBy(*PAGE, "line_id")
        .agg(F.min("r_x0").alias("next_x0"))
    )
    x1 = F.coalesce(F.col("next_x0"), F.lit(right_margin)) - 2
    return (
        labels.join(after, [*PAGE, "line_id"], "left")
        .select(*PAGE, "line_id", (F.col("x1") + 2).alias("x0"), "y0", x1.alias("x1"), "y1")
        .where(F.col("x1") - F.col("x0") >= min_width)
    )
