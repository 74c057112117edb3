"""Moving widgets onto what is printed: rules, boxes, cells and margins.

Operators propose new rectangles from the rectangles they are given and do not
change their input while scanning, so results do not depend on visiting order;
``shrink_tall_in_order`` is the one ordered pass.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions import geometry as G
from formloom.operators import page_walks as W
from formloom.operators.detect import clustered_positions
from formloom.operators.greedy import connected_components
from formloom.operators.pairs import PAGE, Reach, dealt, nearest, on_y_axis, page_anti, page_pairs, page_semi, places
from formloom.session import cut_lineage, stored

WIDGET = (*PAGE, "rect_id")
BOX = ("x0", "y0", "x1", "y1")

# Fixed values, in points.
RULE_Y_TOL, RULE_X_SLOP, BELOW_BIAS = 15.0, 12.0, 4.0
NARROW_PENALTY, NARROWEST_SHARE = 0.05, 0.3
X_CLAMP = 8.0
TEXT_HEIGHT = 12.0
# Rules are long and looked for 15 pt around, so small cells copy them often.
RULE_CELL = (512.0, 128.0)


def _widgets(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(*WIDGET, *BOX, *extra)


def nearest_rule(widgets: DataFrame, rules: DataFrame, tolerance: float = RULE_Y_TOL) -> DataFrame:
    """The rule a widget most likely belongs to: close to its bottom edge,
    rather below than above, and not much narrower than the widget."""
    a, b = G.box(), G.box("r_")
    dy = b.y0 - a.y1
    cost = (
        F.abs(dy)
        + F.when(dy.between(0, BELOW_BIAS), 0.0).otherwise(0.5)
        + NARROW_PENALTY * F.greatest(F.lit(0.0), G.width(a) - G.width(b))
    )
    pairs = page_pairs(
        _widgets(widgets),
        places(rules, rule_id=F.min("rule_id")),
        (F.abs(dy) <= tolerance) & (b.x1 >= a.x0 - RULE_X_SLOP) & (b.x0 <= a.x1 + RULE_X_SLOP),
        reach=Reach(RULE_X_SLOP, tolerance, RULE_X_SLOP, tolerance),
        cell=RULE_CELL,
    )
    return nearest(
        pairs,
        (*WIDGET, *BOX),
        {"rule_id": F.col("r_rule_id"), "rule_x0": b.x0, "rule_x1": b.x1, "rule_y": b.y0, "cost": cost},
        ["cost", "rule_y", "rule_x0", "rule_id"],
    )


def snap_to_rule(matches: DataFrame, widgets: DataFrame, sibling_tol: float = 3.0) -> DataFrame:
    """Seat a matched widget on its rule at the standard height.

    A widget that is the only one on its rule takes the full rule; others keep
    their x range, give or take, inside it.  Rules under 30 % of the widget's
    width are declined.
    """
    b = G.box("r_")
    on_rule = matches.select(
        *WIDGET,
        "rule_id",
        *BOX,
        "rule_x0",
        "rule_x1",
        "rule_y",
    ).where(F.col("rule_x1") - F.col("rule_x0") >= NARROWEST_SHARE * (F.col("x1") - F.col("x0")))
    ruled = on_rule.select(
        *PAGE, "rule_id", F.col("rule_x0").alias("x0"), F.col("rule_y").alias("y0"), F.col("rule_x1").alias("x1"), F.col("rule_y").alias("y1")
    ).distinct()
    owners = (
        page_pairs(ruled, _widgets(widgets), F.abs(b.y1 - F.col("y0")) <= sibling_tol, reach=Reach(0, sibling_tol, 0, sibling_tol), cell=RULE_CELL)
        .groupBy(*PAGE, "rule_id")
        .agg(F.count("*").alias("n_near"), F.max("r_rect_id").alias("one_owner"))
    )
    clamped_x0 = F.greatest(F.col("rule_x0"), F.col("x0") - X_CLAMP)
    clamped_x1 = F.least(F.col("rule_x1"), F.col("x1") + X_CLAMP)
    # nobody else: no widget near the rule, or only this one
    sole = F.col("n_near").isNull() | ((F.col("n_near") == 1) & (F.col("one_owner") == F.col("rect_id")))
    full = sole | (clamped_x1 - clamped_x0 < 5)
    return on_rule.join(owners, [*PAGE, "rule_id"], "left").select(
        *WIDGET,
        "rule_id",
        F.when(full, F.col("rule_x0")).otherwise(clamped_x0).alias("x0"),
        (F.col("rule_y") - TEXT_HEIGHT).alias("y0"),
        F.when(full, F.col("rule_x1")).otherwise(clamped_x1).alias("x1"),
        F.col("rule_y").alias("y1"),
        sole.alias("sole_owner"),
    )


def currency_glyph_overlap(widgets: DataFrame, glyphs: DataFrame, rules: DataFrame, money_names: str, gap: float = 2.0) -> DataFrame:
    """Money fields whose left edge sits on a printed currency sign: a new
    left edge past the sign, bottom on the nearest rule within 3."""
    a, b = G.box(), G.box("r_")
    money = widgets.where(F.lower("field_id").rlike(money_names))
    hits = nearest(
        page_pairs(
            _widgets(money),
            glyphs.select(*PAGE, "line_id", *BOX),
            a.x0.between(b.x0 - 1, b.x1 + 1) & (b.y1 >= a.y0) & (b.y0 <= a.y1),
            reach=Reach.all_round(1),
        ),
        (*WIDGET, *BOX),
        {"glyph_x1": b.x1},
        [b.y0, b.x0, F.col("r_line_id")],
    )
    dy = F.abs(b.y0 - a.y1)
    under = nearest(
        page_pairs(_widgets(hits), rules, (dy <= 3) & (b.x1 >= a.x0) & (b.x0 <= a.x1), reach=Reach(0, 0, 0, 3)),
        WIDGET,
        {"rule_y": b.y0},
        [dy, b.y0, b.x0, F.col("r_rule_id")],
    )
    bottom = F.coalesce("rule_y", "y1")
    return hits.join(under, list(WIDGET), "left").select(
        *WIDGET,
        (F.col("glyph_x1") + gap).alias("x0"),
        (bottom - (F.col("y1") - F.col("y0"))).alias("y0"),
        "x1",
        bottom.alias("y1"),
    )


def lone_segment_snap(widgets: DataFrame, rules: DataFrame, words: DataFrame, page_width: float, gap: float = 1.5) -> DataFrame:
    """Widgets over exactly one rule take its extent, stopping at words on
    either side."""
    tables = [_widgets(widgets), rules.select(*PAGE, *BOX), words.select(*PAGE, *BOX)]
    pages, crowded, any_crowded = W.by_crowd(tables)
    snapped = _lone_on_pages(*pages, page_width, gap)
    return snapped.unionByName(_lone_by_pairs(*crowded, page_width, gap)) if any_crowded else snapped


def _lone_on_pages(widgets: DataFrame, rules: DataFrame, words: DataFrame, page_width: float, gap: float) -> DataFrame:
    ids = widgets.schema["rect_id"].dataType
    blank = F.lit(None).cast(ids).alias("rect_id")  # rules and words need no id
    stacked = widgets.withColumn("what", F.lit(0))
    for what, other in ((1, rules), (2, words)):
        stacked = stacked.unionByName(other.select(*PAGE, blank, *BOX, F.lit(what).alias("what")))

    def work(table: pa.Table, starts: np.ndarray) -> pa.Table:
        page, boxes, what = W.page_of_row(table, starts), W.boxes_of(table), table.column("what").to_numpy()
        ends = np.append(starts[1:], table.num_rows)
        rule_at = starts + np.add.reduceat((what == 0).astype(int), starts)
        word_at = rule_at + np.add.reduceat((what == 1).astype(int), starts)
        first, n, n_strong = W.same_id(table, page, "what", "rect_id", *BOX), *np.zeros((2, table.num_rows), int)
        rule = np.zeros(table.num_rows, int)
        own = np.flatnonzero(what == 0)
        for i, j in W.ranges(own, rule_at[page[own]], word_at[page[own]]):
            a, b = boxes[:, i], boxes[:, j]
            ov = W.overlap(a, b, 0)
            hit = (b[1] >= a[1] - 3) & (b[1] <= a[3] + 9) & (ov > 8)
            np.add.at(n, first[i[hit]], 1)
            np.add.at(n_strong, first[i[hit & (ov > 0.40 * (a[2] - a[0]))]], 1)
            rule[first[i[hit]]] = j[hit]
        lone = np.flatnonzero((n == 1) & (n_strong == 1))
        (x0, _, x1, _), (sx0, sy, sx1, _) = boxes[:, lone], boxes[:, rule[lone]]
        fits = (sx1 - sx0 >= 25.0) & (sx1 - sx0 <= 0.8 * page_width) & (sx0 - x0 <= 30) & (x1 - sx1 <= 30)
        lone, sx0, sx1, sy = lone[fits], sx0[fits], sx1[fits], sy[fits]
        nx0, nx1 = sx0.copy(), sx1.copy()
        at = np.arange(len(lone))
        for i, j in W.ranges(at, word_at[page[lone]], ends[page[lone]]):
            a, b = boxes[:, lone[i]], boxes[:, j]
            on_row = W.overlap(a, b, 1) > 0.4 * (b[3] - b[1])
            i, a, b = i[on_row], a[:, on_row], b[:, on_row]
            is_left = (b[2] >= sx0[i] - 2) & (b[2] <= a[0] + 0.5 * (a[2] - a[0]))
            np.maximum.at(nx0, i[is_left], b[2][is_left] + gap)
            is_right = (b[0] > nx0[i] + 6) & (b[0] <= sx1[i] + 4)
            np.minimum.at(nx1, i[is_right], b[0][is_right] - gap)
        keys = table.select(list(WIDGET)).take(pa.array(lone))
        seat = {"x0": nx0, "y0": boxes[1, lone], "x1": nx1, "y1": boxes[3, lone], "sy": sy}
        return pa.table({**{c: keys.column(c) for c in WIDGET}, **{c: pa.array(v) for c, v in seat.items()}})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in widgets.schema) + ", sy double"
    return W.each_page(stacked, ["what"], work, schema)


def _lone_by_pairs(widgets: DataFrame, rules: DataFrame, words: DataFrame, page_width: float, gap: float) -> DataFrame:
    a, b = G.box(), G.box("r_")
    ov = G.overlap_x(a, b)
    lone = (
        page_pairs(_widgets(widgets), rules, b.y0.between(a.y0 - 3, a.y1 + 9) & (ov > 8), reach=Reach(0, 3, 0, 9))
        .groupBy(*WIDGET, *BOX)
        .agg(
            F.count("*").alias("n"),
            F.count_if(ov > 0.40 * G.width(a)).alias("n_strong"),
            F.min(b.x0).alias("sx0"),
            F.min(b.x1).alias("sx1"),
            F.min(b.y0).alias("sy"),
        )
        .where("n = 1 AND n_strong = 1")
        .where((F.col("sx1") - F.col("sx0")).between(25.0, 0.8 * page_width))
        .where((F.col("sx0") - F.col("x0") <= 30) & (F.col("x1") - F.col("sx1") <= 30))
        .drop("n", "n_strong")
    )
    on_row = G.overlap_y(a, b) > 0.4 * G.height(b)
    is_left = b.x1.between(F.col("sx0") - 2, a.x0 + 0.5 * G.width(a))
    left = (
        page_pairs(lone, words, on_row & is_left, reach=Reach(None, 0, None, 0))
        .groupBy(*WIDGET)
        .agg(F.max("r_x1").alias("word_x1"))
    )
    lim_left = F.greatest(F.col("sx0"), F.col("word_x1") + gap)
    limited = lone.join(left, list(WIDGET), "left").withColumn("nx0", lim_left)
    is_right = (b.x0 > F.col("nx0") + 6) & (b.x0 <= F.col("sx1") + 4)
    right = (
        page_pairs(limited, words, on_row & is_right, reach=Reach(None, 0, None, 0))
        .groupBy(*WIDGET)
        .agg(F.min("r_x0").alias("word_x0"))
    )
    return limited.join(right, list(WIDGET), "left").select(
        *WIDGET, F.col("nx0").alias("x0"), "y0", F.least(F.col("sx1"), F.col("word_x0") - gap).alias("x1"), "y1", "sy"
    )


def blank_snap(widgets: DataFrame, blanks: DataFrame, words: DataFrame, drop: float = 1.0, lead: float = 3.5) -> DataFrame:
    """Put single-line widgets on the one blank of their row.

    Targets are computed for all widgets first.  A target is then dropped when
    it collides with where the others end up and the widget was free before.
    """
    a, b = G.box(), G.box("r_")
    single = _widgets(
        widgets.where((F.col("kind") == "text") & (F.col("y1") - F.col("y0") <= 20)), "field_id"
    )
    dy, ov = F.abs(b.y0 - a.y1), G.overlap_x(a, b)
    fits = (dy < 9) & (ov > 0.4 * F.least(G.width(a), G.width(b)))
    same_row = (dy < 5) & (ov > 25)
    best = (
        page_pairs(
            single,
            blanks.where(F.col("x1") - F.col("x0") >= 20).select(*PAGE, *BOX),
            fits | same_row,
            reach=Reach(0, 0, 0, 9),
            cell=RULE_CELL,
        )
        .groupBy(*WIDGET, "field_id", *BOX)
        .agg(
            F.count_if(same_row).alias("n_row"),
            F.min(F.when(fits, F.struct(dy.alias("dy"), b.x0.alias("bx0"), b.x1.alias("bx1"), b.y0.alias("by")))).alias("s"),
        )
        .where(F.col("s").isNotNull() & (F.col("n_row") <= 1))
        .select(*WIDGET, "field_id", *BOX, "s.bx0", "s.bx1", "s.by")
        .where(F.col("bx1") - F.col("bx0") >= 0.75 * (F.col("x1") - F.col("x0")))
    )
    best = stored(best)  # read twice below
    # room for the label word the blank starts at
    start = best.select(
        *WIDGET,
        (F.col("bx0") - lead).alias("x0"),
        (F.col("by") - 6).alias("y0"),
        (F.col("bx0") + 2).alias("x1"),
        (F.col("by") + 6).alias("y1"),
        "bx0",
        "by",
    )
    pushed = (
        page_pairs(
            start,
            words.where(~F.trim("text").rlike("^_*$")),
            (F.abs(G.center_y(b) - F.col("by")) < 6) & (b.x1 <= F.col("bx0") + 2) & (F.col("bx0") - b.x1 < lead),
            reach=Reach.all_round(2),
        )
        .groupBy(*WIDGET)
        .agg(F.max("r_x1").alias("word_x1"))
    )
    y1 = F.col("by") + drop
    targets = (
        best.join(pushed, list(WIDGET), "left")
        .select(
            *WIDGET,
            "field_id",
            F.round(F.greatest(F.col("bx0"), F.col("word_x1") + lead), 1).alias("n_x0"),
            F.round(y1 - (F.col("y1") - F.col("y0")), 1).alias("n_y0"),
            F.round("bx1", 1).alias("n_x1"),
            F.round(y1, 1).alias("n_y1"),
            *BOX,
        )
        .where(
            (F.abs(F.col("n_x0") - F.col("x0")) >= 1)
            | (F.abs(F.col("n_x1") - F.col("x1")) >= 1)
            | (F.abs(F.col("n_y1") - F.col("y1")) >= 1)
        )
    )
    # the targets are read several times below; written once, they are not recomputed
    targets = stored(targets)
    new = targets.select(*WIDGET, "field_id", *[F.col("n_" + c).alias(c) for c in BOX])
    old = targets.select(*WIDGET, "field_id", *BOX)
    # Places that widgets stood on, and those taken in the end: who moved leaves
    # one place and takes another, so counts tell them without a join by widget.
    counted = lambda df, stood, taken: df.select(*PAGE, "field_id", *BOX, F.lit(stood).alias("stood"), F.lit(taken).alias("taken"))
    ends = counted(widgets, 1, 1).unionByName(counted(old, 0, -1)).unionByName(counted(new, 0, 1))
    stands = places(ends, (*PAGE, "field_id"), stood=F.sum("stood") > 0, taken=F.sum("taken") > 0)
    # one row a target, around its old and its new place
    around = [f("n_" + c, c).alias(c) for c, f in zip(BOX, (F.least, F.least, F.greatest, F.greatest))]
    both = targets.select(*WIDGET, "field_id", *["n_" + c for c in BOX], *[F.col(c).alias("o_" + c) for c in BOX], *around)
    clash = lambda x, there: F.col(there) & (G.overlap_x(x, b) > 2) & (G.overlap_y(x, b) > 2)
    bumps, held = clash(G.box("n_"), "r_taken"), clash(G.box("o_"), "r_stood")
    hits = page_pairs(both, stands, (F.col("field_id") != F.col("r_field_id")) & (bumps | held), cell=RULE_CELL)
    dropped = hits.groupBy(*WIDGET).agg(F.max(bumps).alias("bumps"), F.max(held).alias("held")).where("bumps AND NOT held")
    return new.join(dropped, list(WIDGET), "left_anti")


def fix_candidates(widgets: DataFrame, words: DataFrame, rules: DataFrame, gap: float = 3.0) -> DataFrame:
    """Up to three trial rectangles per widget: past the label, before the
    text, down onto the next line, or up onto its own; equal ones merged."""
    a, b = G.box(), G.box("r_")
    slim = _widgets(widgets)
    on_row = G.overlap_y(a, b) > 0.5 * G.height(b)
    is_label = (b.x0 < a.x0 + 0.6 * G.width(a)) & (b.x1 > a.x0 - 1)
    is_text = (b.x0 > a.x0 + 0.3 * G.width(a)) & (b.x0 < a.x1)
    by_words = (
        page_pairs(slim, words.select(*PAGE, *BOX), on_row & (is_label | is_text), reach=Reach(1, 0, 0, 0))
        .groupBy(*WIDGET)
        .agg(F.max(F.when(is_label, b.x1)).alias("label_x1"), F.min(F.when(is_text, b.x0)).alias("text_x0"))
    )
    wide = G.overlap_x(a, b) > 0.3 * G.width(a)
    below = (b.y0 > a.y1) & (b.y0 <= a.y1 + 34)
    near = b.y0.between(a.y0 - 4, a.y1 + 8)
    by_rules = (
        page_pairs(slim, rules.select(*PAGE, *BOX), wide & (below | near), reach=Reach(0, 4, 0, 34))
        .groupBy(*WIDGET)
        .agg(
            F.min(F.when(below, b.y0)).alias("below_y"),
            F.min(F.when(near, F.struct(F.abs(b.y0 - a.y1).alias("d"), b.y0.alias("y")))).alias("own"),
        )
    )
    lift = F.least(F.col("y1") - F.col("own.y") - 0.5, F.lit(6.0))
    shift = F.col("below_y") - 2 - F.col("y1")

    def trial(n: int, name: str, ok: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        rect = [F.round(c, 1).alias(k) for c, k in zip((x0, y0, x1, y1), BOX)]
        return F.when(ok, F.struct(F.lit(n).alias("n"), F.lit(name).alias("trial"), F.struct(*rect).alias("rect")))

    x0, y0, x1, y1 = (F.col(c) for c in BOX)
    trials = F.array_compact(
        F.array(
            trial(1, "past_label", x1 - (F.col("label_x1") + gap) >= 20, F.col("label_x1") + gap, y0, x1, y1),
            trial(2, "before_text", F.col("text_x0") - gap - x0 >= 20, x0, y0, F.col("text_x0") - gap, y1),
            trial(3, "down_to_line", F.col("below_y").isNotNull(), x0, y0 + shift, x1, y1 + shift),
            trial(4, "up_to_line", y1 - F.col("own.y") - 0.5 > 1.5, x0, y0 - lift, x1, y1 - lift),
        )
    )
    # equal rectangles keep their first trial
    first_only = F.filter(
        "trials",
        lambda t: ~F.exists("trials", lambda u: (u["n"] < t["n"]) & (u["rect"] == t["rect"])),
    )
    return (
        slim.join(by_words, list(WIDGET), "left")
        .join(by_rules, list(WIDGET), "left")
        .select(*WIDGET, trials.alias("trials"))
        .select(*WIDGET, F.posexplode(F.slice(first_only, 1, 3)).alias("pos", "t"))
        .select(*WIDGET, (F.col("pos") + 1).alias("choice_no"), "t.trial", *[F.col(f"t.rect.{c}").alias(c) for c in BOX])
    )


def swallowed_labels(widgets: DataFrame, words: DataFrame, older: DataFrame) -> DataFrame:
    """Text widgets with a label starting well inside them: replaced by the
    older widget at their centre, or dropped."""
    a, b = G.box(), G.box("r_")
    text = _widgets(widgets.where(F.col("kind") == "text"))
    label = words.where(
        (F.length(F.trim("text")) >= 2) & F.col("text").rlike("[A-Za-z]") & (F.col("x1") - F.col("x0") >= 10)
    )
    bad = page_semi(
        text,
        label.select(*PAGE, *BOX),
        G.center_y(b).between(a.y0 - 1, a.y1 + 1) & b.x0.between(a.x0 + 5, a.x1 - 10),
        id_cols=WIDGET,
        reach=Reach(0, 6, 0, 6),
    )
    old = _widgets(older.where(F.col("kind") == "text"))
    hit = page_pairs(bad, old, G.contains_point(b, G.center_x(a), G.center_y(a)))
    pick = nearest(
        hit,
        WIDGET,
        {"old_id": F.col("r_rect_id"), "n_x0": b.x0, "n_y0": b.y0, "n_x1": b.x1, "n_y1": b.y1},
        [F.col("r_rect_id")],
    )
    return bad.join(pick, list(WIDGET), "left").select(
        *WIDGET,
        F.when(F.col("old_id").isNull(), "dropped").otherwise("replaced").alias("action"),
        "old_id",
        *[F.col("n_" + c).alias(c) for c in BOX],
    )


def shrink_tall(
    widgets: DataFrame,
    rules: DataFrame,
    min_area: float = 100.0,
    min_y: float = 2.0,
    min_taller: float = 12.0,
    max_share: float = 0.5,
    height: float = 12.0,
) -> DataFrame:
    """The taller of two overlapping widgets moves to the one short rule near
    it that no other widget stands on; skipped unless there is exactly one.

    All widgets are judged on their given rectangles at once, so the result
    does not depend on the order in which pairs are visited.
    """
    a, b = G.box(), G.box("r_")
    slim = _widgets(widgets, "field_id")
    tall = page_semi(
        slim,
        slim,
        (F.col("field_id") != F.col("r_field_id"))
        & (G.overlap_y(a, b) >= min_y)
        & (G.overlap_x(a, b) > 0)
        & (G.overlap_area(a, b) >= min_area)
        & (G.height(a) - G.height(b) >= min_taller),
        id_cols=WIDGET,
        reads=("field_id",),
    )
    near = stored(_short_rules(tall, rules, max_share))  # read twice below
    # a rule within 2 pt of another widget's bottom is that widget's own,
    # wherever it stands across the page
    bottoms = on_y_axis(slim.select(*PAGE, "rect_id", F.col("y1").alias("y0"), "y1"))
    taken = (
        page_pairs(
            on_y_axis(near.select(*WIDGET, "rule_id", "y0", "y1")),
            bottoms,
            (F.abs(F.col("r_y1") - F.col("y1")) < 2) & (F.col("r_rect_id") != F.col("rect_id")),
            reach=Reach(0, 2, 0, 2),
        )
        .select(*WIDGET, "rule_id")
        .distinct()
    )
    free = near.join(taken, [*WIDGET, "rule_id"], "left_anti")
    return (
        free.groupBy(*WIDGET)
        .agg(F.count("*").alias("n"), F.min("x0").alias("x0"), F.min("x1").alias("x1"), F.min("y1").alias("y1"))
        .where("n = 1")
        .select(*WIDGET, "x0", (F.col("y1") - height).alias("y0"), "x1", "y1")
    )


def _short_rules(tall: DataFrame, rules: DataFrame, max_share: float, *extra: Column) -> DataFrame:
    """Short rules near the bottom or top of a widget, with their boxes; ``extra``
    columns of the widget come along."""
    a, b = G.box(), G.box("r_")
    ov = F.greatest(F.lit(0.0), G.overlap_x(a, b))
    return page_pairs(
        tall,
        rules.where(F.col("x1") - F.col("x0") >= 20).select(*PAGE, "rule_id", *BOX),
        b.y0.between(a.y0 - 20, a.y1 + 5)
        & ((ov >= 0.05 * G.width(a)) | (ov >= 0.5 * G.width(b)))
        & (G.width(b) <= max_share * G.width(a)),
        reach=Reach(0, 20, 0, 5),
    ).select(*WIDGET, *extra, F.col("r_rule_id").alias("rule_id"), *[F.col("r_" + c).alias(c) for c in BOX])


def shrink_tall_in_order(
    widgets: DataFrame,
    rules: DataFrame,
    min_area: float = 100.0,
    min_y: float = 2.0,
    min_taller: float = 12.0,
    max_share: float = 0.5,
    height: float = 12.0,
) -> DataFrame:
    """``shrink_tall`` as an ordered pass: pairs of a page are visited by
    (rect_id, rect_id), and later pairs see the rectangles that earlier ones
    moved, both as partners and as owners of rules.

    ``min_taller`` is at least ``height``: a moved widget is ``height`` high and
    so never moves again, and where it can go is known beforehand.  The pass is therefore fed with candidates only: pairs
    that can meet in a given or a moved place, and rules that no widget which
    stays owns.  Widgets that can affect one another form a component, and each
    component is one ordered pass in one task.
    """
    if min_taller < height:
        raise ValueError("min_taller has to be at least height")
    a, b = G.box(), G.box("r_")
    slim = _widgets(widgets, "field_id")
    high = slim.where(F.col("y1") - F.col("y0") >= min_taller)
    near = stored(_short_rules(high, rules, max_share, F.col("field_id"), F.struct(*BOX).alias("own")))
    movers = near.select(*WIDGET, "field_id", "own.*").distinct()
    moved = near.select(*WIDGET, "field_id", "x0", (F.col("y1") - height).alias("y0"), "x1", "y1").distinct()
    stands = slim.select(*WIDGET, "field_id", *BOX).unionByName(moved)
    near = near.drop("field_id", "own")
    meets = (
        page_pairs(
            movers,
            stands,
            (F.col("field_id") != F.col("r_field_id"))
            & (F.col("rect_id") != F.col("r_rect_id"))
            & (G.overlap_y(a, b) >= min_y)
            & (G.overlap_x(a, b) > 0)
            & (G.overlap_area(a, b) >= min_area)
            & (G.height(a) - G.height(b) >= min_taller),
        )
        .select(*WIDGET, F.col("r_rect_id").alias("other_id"))
        .distinct()
    )
    meets = cut_lineage(meets)
    movable = meets.select(*WIDGET).distinct()
    near = near.join(movable, list(WIDGET), "left_semi")
    # Owners of a rule: a bottom within 2 pt of the rule's, anywhere on the page.
    # Moved places count for widgets that may move; others stay where they are.
    ends = slim.select(*WIDGET, "y1").unionByName(moved.join(movable, list(WIDGET), "left_semi").select(*WIDGET, "y1").distinct())
    bottoms = ends.select(*WIDGET, F.col("y1").alias("y0"), "y1")
    # read twice below
    owners = stored(
        page_pairs(
            on_y_axis(near.select(*WIDGET, "rule_id", "y0", "y1")),
            on_y_axis(bottoms),
            (F.abs(F.col("r_y1") - F.col("y1")) < 2) & (F.col("r_rect_id") != F.col("rect_id")),
            reach=Reach(0, 2, 0, 2),
        )
        .select(*WIDGET, "rule_id", F.col("r_rect_id").alias("other_id"))
        .distinct()
    )
    others = movable.select(*PAGE, F.col("rect_id").alias("other_id"))
    staying = owners.join(others, [*PAGE, "other_id"], "left_anti").select(*WIDGET, "rule_id").distinct()
    near = cut_lineage(near.join(staying, [*WIDGET, "rule_id"], "left_anti"))
    links = owners.select(*WIDGET, "other_id").unionByName(meets).join(others, [*PAGE, "other_id"], "left_semi")
    node = lambda c: F.struct(*PAGE, F.col(c).alias("rect_id"))
    roots = connected_components(links.select(node("rect_id").alias("u"), node("other_id").alias("v")))
    roots = roots.select(*[F.col(f"node.{c}").alias(c) for c in WIDGET], F.col("root.rect_id").alias("root"))
    home = cut_lineage(movable.join(roots, list(WIDGET), "left").withColumn("root", F.coalesce("root", "rect_id")))

    # One table for the pass: movable widgets, partners that stay, rules.
    boxes = slim.select(*WIDGET, "field_id", *BOX)
    asked = F.col("rect_id")  # never null, so ids stay whole numbers
    own = home.join(movers, list(WIDGET)).select(*PAGE, "root", F.lit("movable").alias("kind"), "rect_id", asked.alias("other_id"), "field_id", *BOX)
    partner = meets.join(others, [*PAGE, "other_id"], "left_anti").join(home, list(WIDGET))
    partner = partner.join(boxes.select(*PAGE, F.col("rect_id").alias("other_id"), "field_id", *BOX), [*PAGE, "other_id"])
    partner = partner.select(*PAGE, "root", F.lit("partner").alias("kind"), "rect_id", "other_id", "field_id", *BOX)
    line = near.join(home, list(WIDGET)).select(*PAGE, "root", F.lit("rule").alias("kind"), "rect_id", asked.alias("other_id"), F.lit(None).cast("string").alias("field_id"), *BOX)
    together = meets.join(others, [*PAGE, "other_id"], "left_semi").join(home, list(WIDGET))
    pair = together.select(*PAGE, "root", F.lit("pair").alias("kind"), "rect_id", "other_id", F.lit(None).cast("string").alias("field_id"), *[F.lit(None).cast("double").alias(c) for c in BOX])
    text = F.col("field_id").cast("string")
    fed = own.withColumn("field_id", text).unionByName(partner.withColumn("field_id", text)).unionByName(line).unionByName(pair)
    walk = _OrderedShrink(min_area, min_y, min_taller, height)

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [*(batch.schema.field(c).type for c in PAGE), batch.schema.field("members").type.value_type.field("rect_id").type]
            out = [[] for _ in (*WIDGET, *BOX)]
            for form, page, members in zip(*(batch.column(c).to_pylist() for c in (*PAGE, "members"))):
                for rect_id, moved_to in walk(members).items():
                    for column, value in zip(out, (form, page, rect_id, *moved_to)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (*kinds, *[pa.float64()] * 4))], names=[*WIDGET, *BOX])

    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in WIDGET), *(f"{c} double" for c in BOX)])
    # Most components hold a few widgets, so one call walks many of them.
    member = F.struct("kind", "rect_id", "other_id", "field_id", *BOX)
    parts = dealt(fed, *PAGE, "root").groupBy(*PAGE, "root").agg(F.collect_list(member).alias("members"))
    return parts.select(*PAGE, "members").mapInArrow(ordered, schema)


class _OrderedShrink:
    """The pass over one component of ``shrink_tall_in_order``: its rows in, the
    places of those that move out."""

    def __init__(self, min_area: float, min_y: float, min_taller: float, height: float):
        self.min_area, self.min_y, self.min_taller, self.height = min_area, min_y, min_taller, height

    def _crash(self, one, two) -> bool:
        down = min(one[3], two[3]) - max(one[1], two[1])
        across = min(one[2], two[2]) - max(one[0], two[0])
        taller = abs((one[3] - one[1]) - (two[3] - two[1]))
        return down >= self.min_y and across > 0 and down * across >= self.min_area and taller >= self.min_taller

    def __call__(self, members: list[dict]) -> dict:
        box = lambda r: tuple(r[c] for c in BOX)
        rows = defaultdict(list)
        for r in members:
            rows[r["kind"]].append(r)
        now = {r["rect_id"]: box(r) for r in rows["movable"]}
        names = {r["rect_id"]: r["field_id"] for r in rows["movable"]}
        for r in rows["partner"]:
            now[r["other_id"]], names[r["other_id"]] = box(r), r["field_id"]
        lines = defaultdict(list)
        for r in rows["rule"]:
            lines[r["rect_id"]].append(box(r))
        movable = {r["rect_id"] for r in rows["movable"]}
        # bottoms by bands of 2 pt: those within 2 pt lie in the same band or the next
        bands = defaultdict(set)
        for k in movable:
            bands[now[k][3] // 2].add(k)

        def owned(y: float, tall) -> bool:
            return any(k != tall and abs(y - now[k][3]) < 2 for band in (y // 2 - 1, y // 2, y // 2 + 1) for k in bands.get(band, ()))

        visits = {tuple(sorted((r["rect_id"], r["other_id"]))) for kind in ("partner", "pair") for r in rows[kind]}
        out = {}
        for i, j in sorted(visits):
            if names[i] == names[j] or not self._crash(now[i], now[j]):
                continue
            tall = i if now[i][3] - now[i][1] > now[j][3] - now[j][1] else j
            if tall not in movable or tall in out:
                continue
            free = [x for x in lines[tall] if not owned(x[3], tall)]
            if len(free) == 1:
                x0, _, x1, y1 = free[0]
                bands[now[tall][3] // 2].discard(tall)
                out[tall] = now[tall] = (x0, y1 - self.height, x1, y1)
                bands[y1 // 2].add(tall)
        return out


def modal_value(df: DataFrame, keys, value: Column, name: str = "mode") -> DataFrame:
    """Most common value per group; the smaller one wins a tie."""
    counts = df.groupBy(*keys, value.alias("_v")).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(
        F.max_by("_v", F.struct("n", -F.col("_v"))).alias(name), F.max("n").alias("n")
    )


def canonical_checkboxes(boxes: DataFrame, square_tolerance: float = 1.5) -> DataFrame:
    """Give all boxes of a form its modal size, around their centres."""
    w = modal_value(boxes, ["form_id"], F.rint(F.col("x1") - F.col("x0")), "mw").drop("n")
    h = modal_value(boxes, ["form_id"], F.rint(F.col("y1") - F.col("y0")), "mh").drop("n")
    n = boxes.groupBy("form_id").agg(F.count("*").alias("n"))
    square = F.abs(F.col("mw") - F.col("mh")) <= square_tolerance
    cw = F.when(square, F.greatest("mw", "mh")).otherwise(F.col("mw"))
    ch = F.when(square, F.greatest("mw", "mh")).otherwise(F.col("mh"))
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return (
        boxes.join(w.join(h, "form_id").join(n, "form_id").where("n >= 2"), "form_id")
        .select(
            *PAGE,
            "box_id",
            (cx - cw / 2).alias("x0"),
            (cy - ch / 2).alias("y0"),
            (cx + cw / 2).alias("x1"),
            (cy + ch / 2).alias("y1"),
        )
    )


def indent_peaks(lines: DataFrame, min_count: int = 3) -> DataFrame:
    """Left edges shared by at least three lines of a page."""
    return (
        lines.groupBy(*PAGE, F.rint("x0").alias("peak_x"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def body_margins(words: DataFrame) -> DataFrame:
    """Left and right body margin per page: the word edges at the 5 % and
    95 % index of their sorted lists."""

    def at_index(edge: str, index: Column, name: str) -> DataFrame:
        counts = words.groupBy(*PAGE, F.col(edge).alias("v")).agg(F.count("*").alias("c"))
        upto = F.sum("c").over(Window.partitionBy(*PAGE).orderBy("v"))
        total = F.sum("c").over(Window.partitionBy(*PAGE))
        return (
            counts.select(*PAGE, "v", upto.alias("upto"), total.alias("n"))
            .where(F.col("upto") > index)
            .groupBy(*PAGE)
            .agg(F.min("v").alias(name))
        )

    n = F.col("n")
    left = at_index("x0", F.floor(n / 20), "left_x")
    right = at_index("x1", F.least(n - 1, F.floor(n * 0.95)), "right_x")
    return left.join(right, list(PAGE))


def word_cover(widgets: DataFrame, words: DataFrame) -> DataFrame:
    """Share of a widget's row covered by the union of printed words."""
    a, b = G.box(), G.box("r_")
    parts = (
        page_pairs(
            _widgets(widgets),
            words.select(*PAGE, *BOX),
            (G.overlap_y(a, b) > 0.4 * G.height(b)) & (G.overlap_x(a, b) > 0),
        )
        .select(*WIDGET, (a.x1 - a.x0).alias("w"), F.greatest(a.x0, b.x0).alias("lo"), F.least(a.x1, b.x1).alias("hi"))
        .distinct()
    )
    before = Window.partitionBy(*WIDGET).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0.0), F.col("hi") - F.greatest("lo", F.max("hi").over(before)))
    return (
        parts.withColumn("fresh", fresh)
        .groupBy(*WIDGET)
        .agg(F.round(F.sum("fresh") / F.greatest(F.lit(1.0), F.max("w")), 2).alias("cover"))
    )


def equal_columns(widgets: DataFrame, margins: DataFrame, gutter: float = 14.0, repeats: int = 2) -> DataFrame:
    """Widgets sharing a row split the body width into equal columns; aligned
    grid columns are left out."""
    a, b = G.box(), G.box("r_")
    slim = _widgets(widgets)
    row = (
        page_pairs(
            slim,
            slim,
            (F.col("rect_id") != F.col("r_rect_id"))
            & (G.overlap_y(a, b) > 0.5 * F.least(G.height(a), G.height(b))),
            reach=Reach(None, 0, None, 0),
        )
        .groupBy(*WIDGET, *BOX)
        .agg((F.count("*") + 1).alias("n_columns"), F.count_if(b.x0 < a.x0).alias("slot"))
    )
    # widgets stacked in one column: counted over distinct places
    cy = (F.col("y0") + F.col("y1")) / 2
    places = slim.groupBy(*PAGE, "x0", "x1", cy.alias("cy")).agg(F.count("*").alias("n"))
    # left edges meet as points: whole boxes would lie in several cells each
    edge = lambda df: df.withColumns({"right": F.col("x1"), "x1": F.col("x0"), "y0": F.lit(0.0), "y1": F.lit(0.0)})
    aligned = (
        page_pairs(
            edge(slim.withColumns({"cy": cy, "h": F.col("y1") - F.col("y0")})),
            edge(places),
            (F.abs(b.x0 - a.x0) < 8)
            & (F.abs(F.col("r_right") - F.col("right")) < 8)
            & (F.abs(F.col("r_cy") - F.col("cy")) > F.col("h")),
            reach=Reach(8, 0, 8, 0),
            cell=(64.0, 64.0),
        )
        .groupBy(*WIDGET)
        .agg(F.sum("r_n").alias("n"))
        .where(F.col("n") >= repeats)
    )
    n, k = F.col("n_columns"), F.col("slot")
    col_w = (F.col("right_x") - F.col("left_x") - (n - 1) * gutter) / n
    left = F.col("left_x") + k * (col_w + gutter)
    return (
        row.join(aligned, list(WIDGET), "left_anti")
        .join(margins, list(PAGE))
        .select(*WIDGET, "n_columns", "slot", F.round(left, 6).alias("col_x0"), F.round(left + col_w, 6).alias("col_x1"))
    )


def cell_fit(widgets: DataFrame, cells: DataFrame, headers: DataFrame, max_ratio: float = 1.5) -> DataFrame:
    """Fit widgets to the largest cell holding their centre, unless they are
    much taller or centred in a header cell."""
    a, b = G.box(), G.box("r_")
    here = G.contains_point(b, G.center_x(a), G.center_y(a))
    text = _widgets(widgets.where(F.col("kind") == "text"))
    open_text = page_anti(text, headers.select(*PAGE, *BOX), here, id_cols=WIDGET)
    pick = nearest(
        page_pairs(open_text, cells.select(*PAGE, *BOX), here),
        (*WIDGET, "y0", "y1"),
        {"c_x0": b.x0, "c_y0": b.y0, "c_x1": b.x1, "c_y1": b.y1},
        [-G.rect_area(b), b.y0, b.x0],
    )
    return pick.where(F.col("y1") - F.col("y0") <= max_ratio * (F.col("c_y1") - F.col("c_y0"))).select(
        *WIDGET, *[F.col("c_" + c).alias(c) for c in BOX]
    )


def snap_rows(widgets: DataFrame, rules: DataFrame, tolerance: float = 3.0, min_height: float = 8.0) -> DataFrame:
    """Both y edges onto the nearest row border when both are within 3."""
    borders = on_y_axis(
        clustered_positions(rules, PAGE, "y0", 1.5).select(*PAGE, F.col("mean").alias("y0")).distinct().withColumn("y1", F.col("y0"))
    )
    slim = _widgets(widgets.where(F.col("kind") == "text"))
    d0, d1 = F.abs(F.col("r_y0") - F.col("y0")), F.abs(F.col("r_y0") - F.col("y1"))
    pairs = page_pairs(
        on_y_axis(slim), borders, (d0 <= tolerance) | (d1 <= tolerance), reach=Reach(0, tolerance, 0, tolerance)
    )
    edges = pairs.groupBy(*WIDGET).agg(
        F.min(F.when(d0 <= tolerance, F.struct(d0.alias("d"), F.col("r_y0").alias("y")))).alias("top"),
        F.min(F.when(d1 <= tolerance, F.struct(d1.alias("d"), F.col("r_y0").alias("y")))).alias("bottom"),
    )
    return edges.where(F.col("bottom.y") - F.col("top.y") >= min_height).select(
        *WIDGET, F.col("top.y").alias("y0"), F.col("bottom.y").alias("y1")
    )


def align_left_clusters(widgets: DataFrame, gap: float = 18.0, min_size: int = 2) -> DataFrame:
    """Shift widgets so that each cluster of left edges shares its median."""
    text = _widgets(widgets.where(F.col("kind") == "text"))
    clusters = clustered_positions(text, PAGE, "x0", gap).where(F.col("size") >= min_size)
    dx = F.col("median") - F.col("x0")
    return text.join(clusters.select(*PAGE, "x0", "median"), [*PAGE, "x0"]).where(F.abs(dx) > 0.01).select(
        *WIDGET, F.col("median").alias("x0"), (F.col("x1") + dx).alias("x1")
    )


def align_right_clusters(widgets: DataFrame, gap: float = 20.0, min_size: int = 2, min_width: float = 100.0) -> DataFrame:
    """Stretch wide widgets to the largest right edge of their cluster."""
    wide = _widgets(widgets.where((F.col("kind") == "text") & (F.col("x1") - F.col("x0") >= min_width)))
    clusters = clustered_positions(wide, PAGE, "x1", gap).where(F.col("size") >= min_size)
    return wide.join(clusters.select(*PAGE, "x1", "high"), [*PAGE, "x1"]).where("x1 <> high").select(
        *WIDGET, F.col("high").alias("x1")
    )


def align_right_margin(widgets: DataFrame, lines: DataFrame, tolerance: float = 8.0, body_x: float = 400.0) -> DataFrame:
    """Right edges near the page's most common line end move onto it."""
    margin = modal_value(lines.where(F.col("x1") > body_x), PAGE, F.rint("x1"), "margin_x").drop("n")
    return (
        _widgets(widgets.where(F.col("kind") == "text"))
        .join(margin, list(PAGE))
        .where(F.abs(F.col("x1") - F.col("margin_x")) <= tolerance)
        .select(*WIDGET, F.col("margin_x").alias("x1"))
    )


def align_to_indents(widgets: DataFrame, lines: DataFrame, tolerance: float = 6.0, max_peaks: int = 4) -> DataFrame:
    """Shift widgets onto the nearest paragraph indent of their page; pages
    with many indents are tables and stay as they are."""
    peaks = indent_peaks(lines)
    few = peaks.groupBy(*PAGE).agg(
        F.count("*").alias("n_peaks"), F.collect_set("peak_x").alias("peaks")
    ).where(F.col("n_peaks") <= max_peaks)
    best = F.array_min(
        F.transform("peaks", lambda p: F.struct(F.abs(p - F.col("x0")).alias("d"), p.alias("x")))
    )
    dx = F.col("best.x") - F.col("x0")
    return (
        _widgets(widgets.where(F.col("kind") == "text"))
        .join(few, list(PAGE))
        .withColumn("best", best)
        .where(F.col("best.d") <= tolerance)
        .select(*WIDGET, F.col("best.x").alias("x0"), (F.col("x1") + dx).alias("x1"))
    )


def align_to_separators(widgets: DataFrame, vrules: DataFrame, tolerance: float = 8.0, min_width: float = 8.0) -> DataFrame:
    """x edges within reach of a vertical separator move onto it."""
    seps = (
        clustered_positions(vrules, PAGE, "x0", 1.5)
        .select(*PAGE, F.col("mean").alias("x0"))
        .distinct()
        .withColumns({"x1": F.col("x0"), "y0": F.lit(0.0), "y1": F.lit(0.0)})
    )
    text = _widgets(widgets.where(F.col("kind") == "text"))
    flat = text.withColumns({"y0": F.lit(0.0), "y1": F.lit(0.0)})
    d0, d1 = F.abs(F.col("r_x0") - F.col("x0")), F.abs(F.col("r_x0") - F.col("x1"))
    edges = (
        page_pairs(flat, seps, (d0 <= tolerance) | (d1 <= tolerance), reach=Reach(tolerance, 0, tolerance, 0), cell=(128.0, 64.0))
        .groupBy(*WIDGET, "x0", "x1")
        .agg(
            F.min(F.when(d0 <= tolerance, F.struct(d0.alias("d"), F.col("r_x0").alias("x")))).alias("l"),
            F.min(F.when(d1 <= tolerance, F.struct(d1.alias("d"), F.col("r_x0").alias("x")))).alias("r"),
        )
    )
    x0, x1 = F.coalesce("l.x", "x0"), F.coalesce("r.x", "x1")
    return edges.where(x1 - x0 >= min_width).select(
        *WIDGET, x0.alias("x0"), x1.alias("x1"), (F.col("l").isNotNull() & F.col("r").isNotNull()).alias("anchored")
    )


def normalize_heights(widgets: DataFrame, target: float = 13.0, low: float = 9.0, high: float = 24.0, eps: float = 0.6) -> DataFrame:
    """Single-line heights become the standard one, bottom edge fixed."""
    h = F.col("y1") - F.col("y0")
    return widgets.where(h.between(low, high) & (F.abs(h - target) > eps)).select(
        *WIDGET, F.round("x0", 1).alias("x0"), F.round(F.col("y1") - target, 1).alias("y0"), F.round("x1", 1).alias("x1"), F.round("y1", 1).alias("y1")
    )


def shrink_overlaps(widgets: DataFrame, min_ratio: float = 0.5, min_area: float = 4.0, gap: float = 2.0) -> DataFrame:
    """Cut the wider of two same-row widgets back from the narrower one.

    Every cut is taken from the given rectangles, and all cuts of a widget
    apply: the tightest left and right edges win.  Ties in width cut the first.
    """
    a, b = G.box(), G.box("r_")
    slim = _widgets(widgets, "field_id")
    share = G.overlap_y(a, b) / F.least(G.height(a), G.height(b))
    wider = (G.width(a) > G.width(b)) | ((G.width(a) == G.width(b)) & (F.col("rect_id") < F.col("r_rect_id")))
    pairs = page_pairs(
        slim,
        slim,
        (F.col("rect_id") != F.col("r_rect_id"))
        & (F.col("field_id") != F.col("r_field_id"))
        & (share >= min_ratio)
        & (G.overlap_x(a, b) * F.least(G.height(a), G.height(b)) >= min_area)
        & wider,
    )
    to_right = G.center_x(b) > G.center_x(a)
    x1, x0 = F.when(to_right, b.x0 - gap), F.when(~to_right, b.x1 + gap)
    usable = F.coalesce(x1 > a.x0, x0 < a.x1)
    return (
        pairs.where(usable)
        .groupBy(*WIDGET, *BOX)
        .agg(F.max(x0).alias("cut_x0"), F.min(x1).alias("cut_x1"))
        .select(*WIDGET, F.coalesce("cut_x0", "x0").alias("x0"), F.coalesce("cut_x1", "x1").alias("x1"))
    )


def avoid_following_text(widgets: DataFrame, words: DataFrame, tall: float = 24.0, page_wide: float = 250.0) -> DataFrame:
    """A tall box ends 2 pt above the first printed word below its top."""
    a, b = G.box(), G.box("r_")
    boxes = _widgets(widgets.where(F.col("y1") - F.col("y0") > tall))
    blocks = (b.y0 > a.y0 + 4) & (b.y0 < a.y1)
    narrow, wide = boxes.where(F.col("x1") - F.col("x0") < page_wide), boxes.where(F.col("x1") - F.col("x0") >= page_wide)
    near = page_pairs(narrow, words, blocks & (G.overlap_x(a, b) >= 8)).select(*WIDGET, a.y0.alias("y0"), b.y0.alias("word_y"))
    rows = on_y_axis(words.select(*PAGE, "y0", "y1").distinct())
    page_w = page_pairs(on_y_axis(wide), rows, blocks).select(*WIDGET, a.y0.alias("y0"), b.y0.alias("word_y"))
    first = near.unionByName(page_w).groupBy(*WIDGET, "y0").agg((F.min("word_y") - 2).alias("stop"))
    return first.select(
        *WIDGET,
        F.when(F.col("stop") - F.col("y0") >= 13, F.col("stop")).otherwise(F.col("y0") + 13).alias("y1"),
    )


def drift_stats(widgets: DataFrame, rules_a: DataFrame, rules_b: DataFrame, moved: float = 5.0) -> DataFrame:
    """How far two sources of rules disagree about the same widgets."""
    pick = lambda rules, p: nearest_rule(widgets, rules).select(
        *WIDGET, F.col("rule_x0").alias(p + "x0"), F.col("rule_x1").alias(p + "x1")
    )
    both = pick(rules_a, "a_").join(pick(rules_b, "b_"), list(WIDGET))
    d0, d1 = F.abs(F.col("a_x0") - F.col("b_x0")), F.abs(F.col("a_x1") - F.col("b_x1"))
    return both.groupBy("form_id").agg(
        F.count("*").alias("n"),
        F.round(F.avg(d0), 6).alias("mean_dx0"),
        F.round(F.avg(d1), 6).alias("mean_dx1"),
        F.round(F.avg(((d0 > moved) | (d1 > moved)).cast("int")), 6).alias("share_moved"),
    )


def anchor_overhang(matches: DataFrame) -> DataFrame:
    """Per form, how far matched rules reach past their widgets."""
    left = F.greatest(F.lit(0.0), F.col("x0") - F.col("rule_x0"))
    right = F.greatest(F.lit(0.0), F.col("rule_x1") - F.col("x1"))
    total = left + right
    return matches.groupBy("form_id").agg(
        F.count("*").alias("n"),
        F.sum(left).alias("left_overhang"),
        F.sum(right).alias("right_overhang"),
        F.count_if((total > 25) & (total <= 75)).alias("creep"),
        F.count_if(total > 75).alias("big_creep"),
    )
