"""Geometry audits: what is wrong with where widgets sit on the page.

Widgets carry ``form_id, page, rect_id, field_id, kind`` and a box; rules,
words and printed boxes are boxes with an id of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.functions import geometry as G
from formloom.operators.pairs import BOX, PAGE, Reach, nearest, on_y_axis, page_anti, page_pairs, places
from formloom.operators.ranking import block_window, neighbours, rank_in_groups

WIDGET = (*PAGE, "rect_id")
SINGLE_LINE = 20.0


def widget_collisions(widgets: DataFrame) -> DataFrame:
    """Pairs of widgets sharing more than 2 pt both ways and 12 sq pt.

    Two options of one choice field may share a box on purpose.
    """
    a, b = G.box(), G.box("r_")
    same_choice = (
        (F.col("field_id") == F.col("r_field_id"))
        & (F.col("kind") == "choice")
        & (F.col("r_kind") == "choice")
    )
    cols = widgets.select(*WIDGET, "field_id", "kind", "x0", "y0", "x1", "y1")
    return page_pairs(
        cols,
        cols,
        (F.col("rect_id") < F.col("r_rect_id"))
        & (G.overlap_x(a, b) > 2)
        & (G.overlap_y(a, b) > 2)
        & (G.overlap_area(a, b) >= 12)
        & ~same_choice,
    ).select(
        *WIDGET,
        F.col("r_rect_id").alias("other_id"),
        "field_id",
        F.col("r_field_id").alias("other_field_id"),
        G.overlap_area(a, b).alias("overlap"),
    )


def same_row_overlaps(widgets: DataFrame, min_area: float = 4.0, min_y: float = 1.5) -> DataFrame:
    """Overlaps between widgets of different names, thin touches ignored."""
    a, b = G.box(), G.box("r_")
    cols = widgets.select(*WIDGET, "field_id", "x0", "y0", "x1", "y1")
    return page_pairs(
        cols,
        cols,
        (F.col("rect_id") < F.col("r_rect_id"))
        & (F.col("field_id") != F.col("r_field_id"))
        & (G.overlap_y(a, b) >= min_y)
        & (G.overlap_area(a, b) >= min_area),
    ).select(*WIDGET, F.col("r_rect_id").alias("other_id"), F.round(G.overlap_area(a, b), 1).alias("overlap"))


def shared_rect_fields(widgets: DataFrame) -> DataFrame:
    """Long form of ``shared_rects``: a rectangle bound to several fields, each
    field with the number of its widgets there."""
    here = widgets.groupBy(*PAGE, *BOX, "field_id").agg(F.count("*").alias("n_widgets"))
    several = here.groupBy(*PAGE, *BOX).agg(F.count("*").alias("n_fields")).where("n_fields > 1")
    return here.join(several, [*PAGE, *BOX])


def shared_rects(widgets: DataFrame) -> DataFrame:
    """One rectangle bound to several fields, listed (``shared_rect_fields`` is
    the long table)."""
    return (
        widgets.groupBy(*PAGE, "x0", "y0", "x1", "y1")
        .agg(F.sort_array(F.collect_set("field_id")).alias("targets"), F.count("*").alias("n_widgets"))
        .where(F.size("targets") > 1)
        .select(*PAGE, "x0", "y0", "x1", "y1", F.concat_ws(",", "targets").alias("targets"), "n_widgets")
    )


def overlapping_options(widgets: DataFrame, min_iou: float = 0.3) -> DataFrame:
    """Options of one choice field that largely cover each other."""
    a, b = G.box(), G.box("r_")
    options = widgets.where(F.col("kind") == "choice").select(*WIDGET, "field_id", "x0", "y0", "x1", "y1")
    return page_pairs(
        options,
        options,
        (F.col("rect_id") < F.col("r_rect_id")) & (G.rect_iou(a, b) > min_iou),
        keys=(*PAGE, "field_id"),
    ).select(*WIDGET, F.col("r_rect_id").alias("other_id"), "field_id", F.round(G.rect_iou(a, b), 6).alias("iou"))


def covers_printed_text(widgets: DataFrame, words: DataFrame, min_area: float = 8.0) -> DataFrame:
    """Text widgets holding the centre of a printed word."""
    a, b = G.box(), G.box("r_")
    text = F.trim(F.col("r_text"))
    underscores = F.length("r_text") - F.length(F.translate("r_text", "_", ""))
    printed = (F.length(text) >= 2) & ~text.rlike("^_+$") & (underscores <= F.length("r_text") / 2)
    return page_pairs(
        widgets.where(F.col("kind").isin("text", "date")).select(*WIDGET, "field_id", "x0", "y0", "x1", "y1"),
        words,
        G.contains_point(a, G.center_x(b), G.center_y(b)) & (G.overlap_area(a, b) >= min_area) & printed,
    ).select(*WIDGET, "field_id", F.col("r_line_id").alias("line_id"), F.col("r_text").alias("text"), G.overlap_area(a, b).alias("overlap"))


def label_intrusion(widgets: DataFrame, words: DataFrame) -> DataFrame:
    """Printed words reaching into a widget, by widget.

    ``overlaps`` counts words covered by more than 30 %; ``under_label`` counts
    words of the same band ending in the widget's left 40 %.  Fields aligned
    centre or right are judged on their middle 60 % only and never under a
    label, since their text does not start at the left edge.
    """
    b = G.box("r_")
    w = F.col("x1") - F.col("x0")
    left_aligned = F.col("align") == "left"
    core = G.Box(
        F.when(left_aligned, F.col("x0")).otherwise(F.col("x0") + 0.2 * w),
        F.col("y0"),
        F.when(left_aligned, F.col("x1")).otherwise(F.col("x1") - 0.2 * w),
        F.col("y1"),
    )
    covered = G.overlap_area(core, b) > 0.30 * G.rect_area(b)
    under = (
        left_aligned
        & (G.overlap_y(G.box(), b) > 0.5 * G.height(b))
        & (b.x1 > F.col("x0") + 3)
        & (b.x1 <= F.col("x0") + 0.4 * w)
    )
    big = widgets.where((F.col("x1") - F.col("x0") > 16) | (F.col("y1") - F.col("y0") > 16))
    return (
        page_pairs(big.select(*WIDGET, "align", "x0", "y0", "x1", "y1"), places(words), covered | under)
        .groupBy(*WIDGET)
        .agg(
            F.sum(F.when(covered, F.col("r_n_here")).otherwise(0)).alias("overlaps"),
            F.sum(F.when(under, F.col("r_n_here")).otherwise(0)).alias("under_label"),
        )
    )


def overruns_rule(widgets: DataFrame, rules: DataFrame, slack: float = 5.0) -> DataFrame:
    """Single-line widgets sticking out past the rule they share most with."""
    a, b = G.box(), G.box("r_")
    single = widgets.where(F.col("kind").isin("text", "date") & (F.col("y1") - F.col("y0") <= SINGLE_LINE))
    pairs = page_pairs(
        single.select(*WIDGET, "x0", "y0", "x1", "y1"),
        places(rules, rule_id=F.min("rule_id")),
        (F.abs(b.y0 - a.y1) <= 7) & (G.overlap_x(a, b) >= 15),
        reach=Reach(0, 0, 0, 7),
    )
    best = nearest(
        pairs,
        [*WIDGET, "x0", "x1"],
        {"rule_x0": b.x0, "rule_x1": b.x1},
        [-G.overlap_x(a, b), b.y0, b.x0, F.col("r_rule_id")],
    )
    left, right = F.col("rule_x0") - F.col("x0"), F.col("x1") - F.col("rule_x1")
    return best.where((left > slack) | (right > slack)).select(
        *WIDGET, left.alias("left_overrun"), right.alias("right_overrun")
    )


def overruns_blank(widgets: DataFrame, blanks: DataFrame, words: DataFrame, slack: float = 6.0) -> DataFrame:
    """Widgets reaching past the union of the blanks on their row.

    An overrun crossing printed words is ``high``, else ``medium``.
    """
    a, b = G.box(), G.box("r_")
    single = widgets.where(F.col("kind").isin("text", "date") & (F.col("y1") - F.col("y0") <= SINGLE_LINE))
    row = page_pairs(
        single.select(*WIDGET, "x0", "y0", "x1", "y1"),
        places(blanks.where(F.col("x1") - F.col("x0") >= 18)),
        (F.abs(b.y0 - a.y1) < 6) & (G.overlap_x(a, b) > 15),
        reach=Reach(0, 0, 0, 6),
    )
    span = row.groupBy(*WIDGET, "x0", "y0", "x1", "y1").agg(
        F.min("r_x0").alias("span_x0"), F.max("r_x1").alias("span_x1"), F.min("r_y0").alias("row_y")
    )
    edges = span.select(
        *WIDGET,
        "row_y",
        F.inline(
            F.array(
                F.struct(
                    F.lit("right").alias("edge"),
                    (F.col("x1") - F.col("span_x1")).alias("overrun"),
                    F.col("span_x1").alias("lo"),
                    F.col("x1").alias("hi"),
                ),
                F.struct(
                    F.lit("left").alias("edge"),
                    (F.col("span_x0") - F.col("x0")).alias("overrun"),
                    F.col("x0").alias("lo"),
                    F.col("span_x0").alias("hi"),
                ),
            )
        ),
    ).where(F.col("overrun") > slack)
    # the strip the overrun covers, as a box around the text row
    strip = edges.select(
        *WIDGET,
        "edge",
        "row_y",
        "lo",
        "hi",
        F.col("lo").alias("x0"),
        (F.col("row_y") - 12).alias("y0"),
        F.col("hi").alias("x1"),
        (F.col("row_y") + 2).alias("y1"),
    )
    crossing = page_pairs(
        strip,
        places(words.where(~F.trim("text").rlike("^_+$"))),
        (F.abs(G.center_y(b) - (F.col("row_y") - 5)) < 7)
        & (b.x0 < F.col("hi") - 2)
        & (b.x1 > F.col("lo") + 2),
    )
    crossed = crossing.groupBy(*WIDGET, "edge").agg(F.sum("r_n_here").alias("n_crossed"))
    return edges.join(crossed, [*WIDGET, "edge"], "left").select(
        *WIDGET,
        "edge",
        "overrun",
        F.coalesce("n_crossed", F.lit(0)).cast("bigint").alias("n_crossed"),
        F.when(F.col("n_crossed") > 0, "high").otherwise("medium").alias("severity"),
    )


def nearest_box(checks: DataFrame, boxes: DataFrame, near: float = 4.5, far: float = 40.0) -> DataFrame:
    """Choice widgets off their printed box: the nearest one is between
    ``near`` and ``far`` away and no other widget sits on it."""
    a, b = G.box(), G.box("r_")
    d = G.chebyshev(a, b)
    pairs = page_pairs(
        checks.select(*WIDGET, "x0", "y0", "x1", "y1"),
        places(boxes, box_id=F.min("box_id")),
        d <= far,
        reach=Reach.all_round(far),
    )
    claimed = pairs.where(d <= near).select(*PAGE, F.col("r_box_id").alias("box_id")).distinct()
    best = nearest(pairs, WIDGET, {"box_id": F.col("r_box_id"), "offset": d}, [d, b.y0, b.x0, F.col("r_box_id")])
    return best.where(F.col("offset") > near).join(claimed, [*PAGE, "box_id"], "left_anti").select(
        *WIDGET, "box_id", "offset"
    )


def uncovered_rules(rules: DataFrame, widgets: DataFrame, page_height: float, min_len: float = 65.0) -> DataFrame:
    """Long rules above the footer that no widget covers by 55 %."""
    a, b = G.box(), G.box("r_")
    long_rules = rules.where((F.col("x1") - F.col("x0") >= min_len) & (F.col("y0") <= page_height - 45))
    return page_anti(
        long_rules,
        widgets,
        (F.abs(b.y1 - a.y0) <= 8) & (G.overlap_x(a, b) >= 0.55 * G.width(a)),
        id_cols=(*PAGE, "rule_id"),
        reach=Reach(0, 8, 0, 8),
    ).select(*PAGE, "rule_id", "x0", "x1", F.col("y0").alias("y"))


def split_date_stubs(date_widgets: DataFrame, words: DataFrame) -> DataFrame:
    """Printed century stubs ("20__") on, or one line below, a date widget."""
    stubs = words.where(F.trim("text").rlike(r"^(19|20)_+"))
    delta = F.col("r_mid") - F.col("mid")
    mid = ((F.col("y0") + F.col("y1")) / 2).alias("mid")
    pairs = page_pairs(
        on_y_axis(date_widgets.select(*WIDGET, "field_id", "y0", "y1", mid)),
        on_y_axis(stubs.select(*PAGE, "line_id", "y0", "y1", mid)),
        (delta >= -4) & (delta <= 20),
        reach=Reach(0, 40, 0, 40),
    )
    return pairs.select(*WIDGET, "field_id", F.col("r_line_id").alias("line_id"))


def chain_gaps(widgets: DataFrame, max_gap: float = 22.0) -> DataFrame:
    """Consecutive widgets of one field on a page with a wide gap between."""
    keys = [*PAGE, "field_id"]
    ranked = rank_in_groups(
        widgets.select(*keys, "rect_id", "y0", "y1"), keys, [F.col("rect_id")], [F.floor(F.col("rect_id") / 4096)]
    )
    before = F.lag("y1").over(block_window(keys))
    return (
        neighbours(ranked, keys, {"gap": F.col("y0") - before}, behind=1)
        .where(F.col("gap") > max_gap)
        .select(*WIDGET, "field_id", "gap")
    )


def odd_sizes(widgets: DataFrame) -> DataFrame:
    """Choices larger than a box, text fields as small as one."""
    b = G.box()
    code = F.when(
        (F.col("kind") == "choice") & ((G.width(b) > 24) | (G.height(b) > 24)), "choice_not_checkbox_sized"
    ).when(
        F.col("kind").isin("text", "date") & (G.width(b) <= 18) & (G.height(b) <= 18), "text_is_checkbox_sized"
    )
    return widgets.select(*WIDGET, "field_id", code.alias("code")).where(F.col("code").isNotNull())


def wide_outliers(widgets: DataFrame, factor: float = 1.5) -> DataFrame:
    """Widgets wider than ``factor`` times the form's median width.

    The median comes from counts per distinct width, so no form's rows are
    gathered in one place.
    """
    w = F.col("x1") - F.col("x0")
    median = (
        widgets.groupBy("form_id", w.alias("w"))
        .agg(F.count("*").alias("n"))
        .groupBy("form_id")
        .agg(F.expr("percentile(w, 0.5, n)").alias("median"))
    )
    return (
        widgets.select(*WIDGET, w.alias("width"))
        .join(median, "form_id")
        .where(F.col("width") > factor * F.col("median"))
        .select(*WIDGET, "width", "median")
    )


def valid_rects(widgets: DataFrame, pages: DataFrame, tol: float = 1.0) -> DataFrame:
    """Every widget with the reason it is invalid, or null."""
    reason = (
        F.when(F.col("width").isNull(), "page out of range")
        .when(F.col("x0").isNull() | F.col("y0").isNull() | F.col("x1").isNull() | F.col("y1").isNull(), "bad rect")
        .when((F.col("x1") <= F.col("x0")) | (F.col("y1") <= F.col("y0")), "degenerate")
        .when(
            (F.col("x0") < -tol)
            | (F.col("y0") < -tol)
            | (F.col("x1") > F.col("width") + tol)
            | (F.col("y1") > F.col("height") + tol),
            "outside page",
        )
    )
    return widgets.join(pages, list(PAGE), "left").select(*WIDGET, reason.alias("reason"))


def orphan_widgets(widgets: DataFrame, words: DataFrame, radius: float = 200.0, side: float = 300.0) -> DataFrame:
    """Text widgets with no text of 3+ letters near them, edge to edge."""
    a, b = G.box(), G.box("r_")
    shared = G.overlap_x(a, b)
    across = F.when(shared > 0, -shared).otherwise(F.least(F.abs(b.x0 - a.x1), F.abs(a.x0 - b.x1)))
    down = F.greatest(F.lit(0.0), b.y0 - a.y1, a.y0 - b.y1)
    return page_anti(
        widgets.where(F.col("kind") == "text").select(*WIDGET, "x0", "y0", "x1", "y1"),
        words.where(F.length(F.trim("text")) >= 3),
        (down <= radius) & (across <= side),
        id_cols=WIDGET,
        reach=Reach(side, radius, side, radius),
        cell=(512.0, 256.0),
    ).select(*WIDGET)


def near_footer(widgets: DataFrame, rules: DataFrame, words: DataFrame, citation: str, proximity: float = 30.0) -> DataFrame:
    """Text widgets that belong to a page header or footer.

    Either the widget sits on citation text, or a separator rule within
    ``proximity`` has citation text within 40 pt on its far side.
    """
    a, b = G.box(), G.box("r_")
    cited = words.where(F.col("text").rlike(citation)).select(*PAGE, "x0", "y0", "x1", "y1")
    text = widgets.where(F.col("kind") == "text").select(*WIDGET, "x0", "y0", "x1", "y1")
    on_text = page_pairs(
        text,
        cited,
        (b.x0.between(a.x0, a.x1) | b.x1.between(a.x0, a.x1)) & b.y0.between(a.y0, a.y1),
    ).select(*WIDGET)
    # which side of each separator has citation text; x plays no part, so both
    # sides are projected on the y axis
    separators = rules.where((F.col("x1") - F.col("x0") >= 100) & (F.col("y1") - F.col("y0") <= 1.5))
    rows = on_y_axis(separators.select(*PAGE, "y0", "y1").distinct())
    gap = F.col("r_y0") - F.col("y0")
    sides = (
        page_pairs(rows, on_y_axis(cited.select(*PAGE, "y0", "y1").distinct()), F.abs(gap) <= 40, reach=Reach(0, 40, 0, 40))
        .groupBy(*PAGE, F.col("y0").alias("line_y"))
        .agg(F.max(gap > 0).alias("below"), F.max(gap <= 0).alias("above"))
    )
    lines = separators.select(*PAGE, F.col("y0").alias("line_y"), "x0", "x1", "y0", "y1").join(sides, [*PAGE, "line_y"])
    under = F.col("r_below") & b.y0.between(a.y1 + 2, a.y1 + proximity)
    over = F.col("r_above") & b.y0.between(a.y0 - proximity, a.y0 - 2)
    by_rule = page_pairs(
        text, lines, (G.overlap_x(a, b) > 0) & (under | over), reach=Reach(0, proximity, 0, proximity)
    ).select(*WIDGET)
    return on_text.unionByName(by_rule).distinct()
