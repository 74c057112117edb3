"""Finding fields in a layout: labels, headers, tables and implied blanks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions import geometry as G
from formloom.functions import text as X
from formloom.operators.pairs import PAGE, Reach, nearest, on_y_axis, page_anti, page_pairs, page_semi, places
from formloom.operators.ranking import block_window, neighbours, rank_in_groups, running
from formloom.session import cut_lineage

GRID_SLACK = 5.0


def nearest_label(
    fields: DataFrame,
    lines: DataFrame,
    id_col: str = "rect_id",
    left: float = 150.0,
    above: float = 30.0,
    below: float = 20.0,
    right: float = 100.0,
) -> DataFrame:
    """The closest text on any side of a field; ties by reading order.

    Each line counts for the first side it qualifies for, in the order left,
    above, below, right, with costs of 0, 0.1, 5 and 0.5 on top of the distance.
    """
    a, b = G.box(), G.box("r_")
    usable = lines.where((F.length(F.trim("text")) >= 2) & ~X.is_numbering(F.col("text")))
    side = (
        F.when((b.x1 <= a.x0 + 5) & (a.x0 - b.x1 <= left) & G.y_overlaps(b, a, 10.0), "left")
        .when((b.y1 <= a.y0 + 2) & (a.y0 - b.y1 <= above) & G.x_overlaps(b, a), "above")
        .when((b.y0 >= a.y1 - 2) & (b.y0 - a.y1 <= below) & G.x_overlaps(b, a), "below")
        .when((b.x0 >= a.x1 - 5) & (b.x0 - a.x1 <= right) & G.y_overlaps(b, a, 5.0), "right")
    )
    cost = (
        F.when(F.col("side") == "left", F.greatest(F.lit(0.0), a.x0 - b.x1))
        .when(F.col("side") == "above", F.greatest(F.lit(0.0), a.y0 - b.y1) + 0.1)
        .when(F.col("side") == "below", F.greatest(F.lit(0.0), b.y0 - a.y1) + 5.0)
        .otherwise(F.greatest(F.lit(0.0), b.x0 - a.x1) + 0.5)
    )
    pairs = (
        page_pairs(
            fields.select(*PAGE, id_col, "x0", "y0", "x1", "y1"),
            places(usable, text=F.min_by("text", "line_id"), line_id=F.min("line_id")),
            reach=Reach(left, max(above, 10.0), right, max(below, 10.0)),
        )
        .withColumn("side", side)
        .where(F.col("side").isNotNull())
        .withColumn("cost", cost)
    )
    return nearest(
        pairs,
        (*PAGE, id_col),
        {"label": F.trim("r_text"), "side": F.col("side"), "cost": F.col("cost")},
        [F.col("cost"), b.y0, b.x0, F.col("r_line_id")],
    )


def section_header_asof(fields: DataFrame, lines: DataFrame, id_col: str = "rect_id", search: float = 120.0) -> DataFrame:
    """The lowest section heading above a field within ``search``.

    Where a heading stands across the page plays no part, so both sides are
    matched on the y axis; of headings at one height the last by id counts.
    """
    heads = (
        lines.where(X.is_section_header(F.col("text")))
        .groupBy(*PAGE, "y0", "y1")
        .agg(F.max_by("text", "line_id").alias("text"), F.max("line_id").alias("line_id"))
    )
    a, b = G.box(), G.box("r_")
    pairs = page_pairs(
        on_y_axis(fields.select(*PAGE, id_col, "y0", "y1")),
        on_y_axis(heads),
        (b.y1 <= a.y0) & (a.y0 - b.y1 <= search),
        reach=Reach(0, search, 0, 0),
    )
    return pairs.groupBy(*PAGE, id_col).agg(
        X.cut_at_word(F.trim(F.max_by("r_text", F.struct("r_y0", "r_line_id")))).alias("section")
    )


def section_span_prefix(fields: DataFrame, lines: DataFrame, id_col: str = "rect_id", max_len: int = 80) -> DataFrame:
    """Slug of the heading whose span, up to the next heading, holds the field."""
    t = F.trim("text")
    heads = lines.where(
        (F.length(t) <= max_len) & ((t.endswith(":") & (F.length(t) > 4)) | t.rlike(r"^\d{1,2}[a-z]?[.)]\s"))
    )
    # one heading per height: the first by place; heights on a page are few
    rows = heads.groupBy(*PAGE, "y0").agg(F.min_by("text", F.struct("x0", "line_id")).alias("text"))
    # the last heading at or above each field: headings and fields in one order
    marks = rows.select(*PAGE, "y0", F.lit(0).alias("kind"), F.lit(None).cast(fields.schema[id_col].dataType).alias(id_col))
    marks = marks.unionByName(fields.select(*PAGE, "y0", F.lit(1).alias("kind"), id_col))
    ranked = rank_in_groups(marks, PAGE, [F.col("y0"), F.col("kind"), F.col(id_col)], [F.floor(F.col("y0") / 64)])
    above = running(ranked, PAGE, F.when(F.col("kind") == 0, F.col("y0")), "head_y", how="max").where("kind = 1 AND head_y IS NOT NULL")
    named = rows.select(*PAGE, F.col("y0").alias("head_y"), X.slugify(F.col("text")).alias("prefix"))
    return above.join(named, [*PAGE, "head_y"]).select(*PAGE, id_col, "prefix")


def column_header(cells: DataFrame, lines: DataFrame, by: tuple[str, ...], search: float = 200.0) -> DataFrame:
    """Nearest text above a cell: centred over it, else overlapping at +50."""
    a, b = G.box(), G.box("r_")
    centred = (b.x0 <= G.center_x(a)) & (G.center_x(a) <= b.x1)
    cost = a.y0 - b.y1 + F.when(centred, 0.0).otherwise(50.0)
    pairs = page_pairs(
        cells.select(*by, "x0", "y0", "x1", "y1"),
        places(lines.where(F.length(F.trim("text")) >= 2), text=F.min_by("text", "line_id"), line_id=F.min("line_id")),
        (b.y1 <= a.y0 + 5) & (a.y0 - b.y0 <= search) & (centred | G.x_overlaps(b, a)),
        reach=Reach(0, search, 0, 5),
        cell=(256.0, 128.0),
    )
    return nearest(pairs, by, {"header": F.trim("r_text"), "cost": cost}, [cost, b.y0, b.x0, F.col("r_line_id")])


def grid_lines(h: DataFrame, v: DataFrame, min_crossings: int = 3) -> DataFrame:
    """Horizontal rules crossed by at least three vertical ones."""
    a, b = G.box(), G.box("r_")
    s = GRID_SLACK
    crossed = page_pairs(
        h.select(*PAGE, "rule_id", "x0", "y0", "x1", "y1"),
        v,
        b.x0.between(a.x0 - s, a.x1 + s) & (b.y0 <= a.y0 + s) & (b.y1 >= a.y1 - s),
        reach=Reach.all_round(s),
    )
    return (
        crossed.groupBy(*PAGE, "rule_id", "x0", "y0", "x1", "y1")
        .agg(F.count("*").alias("n_crossings"))
        .where(F.col("n_crossings") >= min_crossings)
    )


def table_cells(grid: DataFrame, v: DataFrame, lines: DataFrame) -> DataFrame:
    """Cells between consecutive grid rules and consecutive verticals, with
    the label printed inside or, failing that, the column header above."""
    # rules of one height act as one row edge; row numbers still count them all
    edges = grid.groupBy(*PAGE, "y0").agg(
        F.max_by("y1", F.struct("x0", "rule_id")).alias("edge_y1"), F.count("*").alias("n")
    )
    w = Window.partitionBy(*PAGE).orderBy("y0")
    rows = edges.select(
        *PAGE,
        F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("row_no"),
        F.col("edge_y1").alias("y0"),
        F.lead("y0").over(w).alias("y1"),
    ).where(F.col("y1") - F.col("y0") >= 5)
    s = GRID_SLACK
    spanning = page_pairs(
        on_y_axis(rows),
        on_y_axis(v.select(*PAGE, F.round("x0", 1).alias("at_x"), "y0", "y1").distinct()),
        (F.col("r_y0") <= F.col("y0") + s) & (F.col("r_y1") >= F.col("y1") - s),
        reach=Reach.all_round(s),
    ).select(*PAGE, "row_no", "y0", "y1", F.col("r_at_x").alias("at_x")).distinct()
    across = Window.partitionBy(*PAGE, "row_no").orderBy("at_x")
    cells = (
        spanning.withColumn("next_x", F.lead("at_x").over(across))
        .select(
            *PAGE,
            "row_no",
            (F.col("at_x") + 1).alias("x0"),
            (F.col("y0") + 1).alias("y0"),
            (F.col("next_x") - 1).alias("x1"),
            (F.col("y1") - 1).alias("y1"),
        )
        .where((F.col("x1") - F.col("x0") >= 10) & (F.col("y1") - F.col("y0") >= 5))
    )
    cells = cut_lineage(cells)  # read three times below
    by = (*PAGE, "row_no", "x0")
    a, b = G.box(), G.box("r_")
    inside = nearest(
        page_pairs(
            cells,
            places(lines, text=F.min_by("text", "line_id"), line_id=F.min("line_id")),
            (b.x0 >= a.x0 - 5) & (b.x1 <= a.x1 + 5) & (b.y0 >= a.y0 - 2) & (b.y1 <= a.y1 + 2),
            reach=Reach(5, 2, 5, 2),
        ),
        by,
        {"inner": F.trim("r_text")},
        [b.y0, b.x0, F.col("r_line_id")],
    )
    heads = column_header(cells, lines, by).drop("cost")
    label = F.coalesce("inner", "header")
    return (
        cells.join(inside, list(by), "left")
        .join(heads, list(by), "left")
        .select(
            *PAGE,
            "row_no",
            "x0",
            "y0",
            "x1",
            "y1",
            F.concat(label, F.lit(" (row "), F.col("row_no").cast("string"), F.lit(")")).alias("label"),
        )
    )


def clustered_positions(values: DataFrame, keys, value: str, tol: float) -> DataFrame:
    """Single-linkage clusters of a number within ``keys``: each distinct value
    with the mean, upper median, maximum and size of its cluster.

    The windows run over counts of distinct values.  A page has only so many
    distinct coordinates, however many elements share them, so a heavy page
    costs no more than a light one.
    """
    counts = values.groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    along = Window.partitionBy(*keys).orderBy("v")
    gap = F.col("v") - F.lag("v").over(along)
    labelled = counts.withColumn("_new", F.coalesce((gap > tol).cast("int"), F.lit(1))).withColumn(
        "cluster", F.sum("_new").over(along)
    )
    whole = Window.partitionBy(*keys, "cluster")
    upto = F.sum("n").over(whole.orderBy("v"))
    sized = labelled.withColumns(
        {
            "size": F.sum("n").over(whole),
            "_upto": upto,
            "_sum": F.sum(F.col("v") * F.col("n")).over(whole),
            "high": F.max("v").over(whole),
        }
    )
    # the upper median is the first value whose running count passes size div 2
    median = F.min(F.when(F.col("_upto") > F.floor(F.col("size") / 2), F.col("v"))).over(whole)
    return sized.select(
        *keys,
        "cluster",
        F.col("v").alias(value),
        "size",
        (F.col("_sum") / F.col("size")).alias("mean"),
        median.alias("median"),
        "high",
    )


def cells_from_line_grid(
    h: DataFrame, v: DataFrame, min_w: float = 30.0, min_h: float = 8.0, max_h: float = 50.0, tol: float = 1.0
) -> DataFrame:
    """Cells from clustered rule positions, with a real vertical behind both
    edges of each."""
    ys = clustered_positions(h, PAGE, "y0", tol).select(*PAGE, F.col("mean").alias("y")).distinct()
    xs = clustered_positions(v, PAGE, "x0", tol).select(*PAGE, "x0", F.col("mean").alias("x"))
    w = Window.partitionBy(*PAGE).orderBy("y")
    rows = ys.select(*PAGE, F.col("y").alias("y0"), F.lead("y").over(w).alias("y1")).where(
        (F.col("y1") - F.col("y0")).between(min_h, max_h)
    )
    segments = v.select(*PAGE, "x0", "y0", "y1").join(xs, [*PAGE, "x0"]).select(*PAGE, "x", "y0", "y1").distinct()
    spanning = page_pairs(
        on_y_axis(rows),
        on_y_axis(segments),
        (F.col("r_y0") <= F.col("y0") + 1.5) & (F.col("r_y1") >= F.col("y1") - 1.5),
        reach=Reach.all_round(1.5),
    ).select(*PAGE, "y0", "y1", F.col("r_x").alias("x")).distinct()
    across = Window.partitionBy(*PAGE, "y0").orderBy("x")
    return (
        spanning.select(*PAGE, F.col("x").alias("x0"), "y0", F.lead("x").over(across).alias("x1"), "y1")
        .where(F.col("x1") - F.col("x0") >= min_w)
    )


def header_cells(cells: DataFrame, spans: DataFrame) -> DataFrame:
    """Cells with the centre of a printed span of 2+ letters inside."""
    b = G.box("r_")
    return page_semi(
        cells,
        spans.where(F.length(F.trim("text")) >= 2),
        G.contains_point(G.box(), G.center_x(b), G.center_y(b)),
        id_cols=(*PAGE, "x0", "y0", "x1", "y1"),
    )


def drop_in_header_cells(widgets: DataFrame, headers: DataFrame) -> DataFrame:
    """Text widgets not centred in a header cell; other kinds pass."""
    a = G.box()
    text = widgets.where(F.col("kind") == "text")
    kept = page_anti(
        text,
        headers.select(*PAGE, "x0", "y0", "x1", "y1"),
        G.contains_point(G.box("r_"), G.center_x(a), G.center_y(a)),
        id_cols=(*PAGE, "rect_id"),
    )
    return widgets.where(F.col("kind") != "text").unionByName(kept)


def drop_outside_tables(widgets: DataFrame, cells: DataFrame, headers: DataFrame) -> DataFrame:
    """On pages with cells, text widgets of the second detector must be
    centred in a cell that is no header."""
    a = G.box()
    here = G.contains_point(G.box("r_"), G.center_x(a), G.center_y(a))
    box_cols = [*PAGE, "x0", "y0", "x1", "y1"]
    tabled = cells.select(*PAGE).distinct()
    text = widgets.where(F.col("kind") == "text")
    free = text.join(tabled, list(PAGE), "left_anti")
    placed = page_semi(
        text.join(tabled, list(PAGE), "left_semi"), cells.select(*box_cols), here, id_cols=(*PAGE, "rect_id")
    )
    placed = page_anti(placed, headers.select(*box_cols), here, id_cols=(*PAGE, "rect_id"))
    return widgets.where(F.col("kind") != "text").unionByName(free).unionByName(placed)


def case_number_line(lines: DataFrame, rules: DataFrame, keywords, header_y: float = 100.0) -> DataFrame:
    """The blank belonging to a case-number label in the page header."""
    a, b = G.box(), G.box("r_")
    labels = lines.where((F.col("y0") <= header_y) & X.has_word(F.col("text"), keywords))
    beside = G.y_overlaps(a, b, 10.0) & (b.x0 >= a.x1 - 10)
    under = (b.y0 >= a.y1) & (b.y0 - a.y1 < 20) & G.x_overlaps(a, b)
    cost = F.when(beside, b.x0 - a.x1).otherwise(b.y0 - a.y1)
    pairs = page_pairs(
        labels.select(*PAGE, "line_id", "x0", "y0", "x1", "y1"),
        rules.where(F.col("y0") <= header_y * 1.5),
        beside | under,
        reach=Reach(None, 10, None, 20),
    )
    return nearest(
        pairs,
        (*PAGE, "line_id"),
        {"rule_id": F.col("r_rule_id"), "cost": cost},
        [cost, b.y0, b.x0, F.col("r_rule_id")],
    )


def implied_fields(
    lines: DataFrame,
    rules: DataFrame,
    fields: DataFrame,
    pages: DataFrame,
    min_gap: float = 20.0,
    max_gap: float = 50.0,
    width: float = 400.0,
) -> DataFrame:
    """Answer areas implied by a prompt with white space below and no field."""
    a, b = G.box(), G.box("r_")
    box_cols = ["x0", "y0", "x1", "y1"]
    prompts = lines.where(X.is_prompt_label(F.col("text"))).select(*PAGE, "line_id", "text", *box_cols)
    covered = ((F.abs(b.y0 - a.y1) < 25) & G.x_overlaps(b, a)) | (
        G.y_overlaps(b, a, 5.0) & (b.x0 > a.x1 - 10) & (b.x0 - a.x1 < 150)
    )
    open_prompts = page_anti(
        prompts, fields.select(*PAGE, *box_cols), covered, id_cols=(*PAGE, "line_id"), reach=Reach(0, 25, 150, 25)
    )
    # only obstacles that could end the gap within max_gap matter
    things = lines.select(*PAGE, *box_cols).unionByName(rules.select(*PAGE, *box_cols))
    stops = (
        page_pairs(
            open_prompts.select(*PAGE, "line_id", *box_cols),
            things,
            (b.y0 > a.y1 + 5) & G.x_overlaps(b, a),
            reach=Reach(0, 0, 0, max_gap + 5),
        )
        .groupBy(*PAGE, "line_id")
        .agg(F.min("r_y0").alias("stop_y"))
    )
    next_y = F.coalesce("stop_y", "height")
    label = F.regexp_replace(F.trim(F.regexp_replace(F.trim("text"), r"^\d+[a-z]?\.\s*", "")), ":+$", "")
    return (
        open_prompts.join(stops, [*PAGE, "line_id"], "left")
        .join(pages, list(PAGE))
        .withColumn("next_y", next_y)
        .where((F.col("next_y") - F.col("y1")).between(min_gap, max_gap))
        .select(
            *PAGE,
            "line_id",
            "x0",
            (F.col("y1") + 2).alias("y0"),
            (F.col("x0") + F.least(F.lit(width), F.col("width") - F.col("x0") - 40)).alias("x1"),
            (F.col("next_y") - 2).alias("y1"),
            label.alias("label"),
        )
    )


def gap_fields(
    lines: DataFrame,
    left_margin: float = 72.0,
    right_margin: float = 540.0,
    min_gap: float = 20.0,
    max_gap: float = 50.0,
    field_height: float = 18.0,
) -> DataFrame:
    """The second detector: any gap between two consecutive lines, after a
    prompt or before a new number, becomes a field centred in the gap."""
    from formloom.operators.layout import OPTION_INDENT, PROMPT_LINE

    ranked = rank_in_groups(lines, PAGE, [F.col("y0"), F.col("x0"), F.col("line_id")], [F.floor(F.col("y0") / 64)])
    w = block_window(PAGE)
    near = neighbours(
        ranked, PAGE, {"next_y": F.lead("y0").over(w), "next_text": F.lead("text").over(w)}, ahead=1
    )
    gap = F.col("next_y") - F.col("y1")
    text = F.trim("text")
    prompt = text.rlike(PROMPT_LINE) & ~((F.col("x0") > OPTION_INDENT) & (F.length(text) < 60))
    numbered = F.col("next_text").rlike(r"^\s*\d{1,2}[a-z]?[.)]\s")
    h = F.least(gap - 4, F.lit(field_height))
    top = F.col("y1") + (gap - h) / 2
    return near.where(gap.between(min_gap, max_gap) & (prompt | numbered)).select(
        *PAGE,
        "line_id",
        F.lit(left_margin).alias("x0"),
        top.alias("y0"),
        F.lit(right_margin).alias("x1"),
        (top + h).alias("y1"),
    )


def question_mapping(lines: DataFrame, fields: DataFrame) -> DataFrame:
    """Prompts with the fields on their line or just below; both leftovers.

    ``status``: mapped, prompt_without_field, field_without_prompt.
    """
    a, b = G.box(), G.box("r_")
    prompts = lines.where(F.trim("text").rlike(r"[:?]$|^\d+[a-z]?[.)]\s")).select(
        *PAGE, "line_id", "text", "x0", "y0", "x1", "y1"
    )
    near = (G.overlap_y(a, b) > 0) & (b.x0 >= a.x1 - 10) & (b.x0 - a.x1 <= 150)
    under = (b.y0 >= a.y1 - 2) & (b.y0 - a.y1 <= 25) & G.x_overlaps(a, b)
    slim = fields.select(*PAGE, "rect_id", "label", "x0", "y0", "x1", "y1")
    hits = page_pairs(prompts, slim, near | under, reach=Reach(10, 2, 150, 25)).select(
        *PAGE, "line_id", F.col("r_rect_id").alias("rect_id"), "text", F.col("r_label").alias("label")
    )
    words = lambda c: F.split(F.lower(F.regexp_replace(c, "[^A-Za-z0-9]+", " ")), " ")
    mapped = hits.select(
        *PAGE,
        "line_id",
        "rect_id",
        F.lit("mapped").alias("status"),
        F.arrays_overlap(F.array_remove(words(F.col("text")), ""), F.array_remove(words(F.col("label")), "")).alias("shares_word"),
    )
    bare = prompts.join(hits, [*PAGE, "line_id"], "left_anti").select(
        *PAGE,
        "line_id",
        F.lit(None).cast("bigint").alias("rect_id"),
        F.lit("prompt_without_field").alias("status"),
        F.lit(None).cast("boolean").alias("shares_word"),
    )
    loose = fields.join(hits, [*PAGE, "rect_id"], "left_anti").select(
        *PAGE,
        F.lit(None).cast("bigint").alias("line_id"),
        "rect_id",
        F.lit("field_without_prompt").alias("status"),
        F.lit(None).cast("boolean").alias("shares_word"),
    )
    return mapped.unionByName(bare).unionByName(loose)


def uncovered_questions(lines: DataFrame, rules: DataFrame, widgets: DataFrame, page_height: float) -> DataFrame:
    """Numbered prompts whose band, up to the next number, has a printed rule
    and no widget."""
    numbered = lines.where(F.trim("text").rlike(r"^\d+[a-z]?[.)]\s"))
    rows = numbered.groupBy(*PAGE, "y0").agg(F.min_by("line_id", F.struct("x0", "line_id")).alias("line_id"))
    w = Window.partitionBy(*PAGE).orderBy("y0")
    bands = on_y_axis(rows.withColumn("y1", F.coalesce(F.lead("y0").over(w), F.lit(page_height))))
    holds = F.col("r_y0").between(F.col("y0"), F.col("y1") - 0.001)
    tops = lambda df, at: on_y_axis(df.select(*PAGE, at.alias("y0"), at.alias("y1")).distinct())
    ruled = page_semi(bands, tops(rules, F.col("y0")), holds, id_cols=(*PAGE, "line_id"))
    mid = (F.col("y0") + F.col("y1")) / 2
    return page_anti(ruled, tops(widgets, mid), holds, id_cols=(*PAGE, "line_id")).select(*PAGE, "line_id", "y0", "y1")


def symbol_splits(widgets: DataFrame, words: DataFrame) -> DataFrame:
    """Words strictly inside a widget's row, away from both ends."""
    a, b = G.box(), G.box("r_")
    return page_pairs(
        widgets.select(*PAGE, "rect_id", "x0", "y0", "x1", "y1"),
        words,
        (b.x0 > a.x0 + 2) & (b.x1 < a.x1 - 2) & (G.center_y(b) > a.y0) & (G.center_y(b) < a.y1),
    ).select(*PAGE, "rect_id", F.col("r_line_id").alias("line_id"))


def tight_buffers(widgets: DataFrame, words: DataFrame, min_gap: float = 1.0) -> DataFrame:
    """Gap to the nearest word on each side of a widget's row, where too small."""
    a, b = G.box(), G.box("r_")
    same_row = (G.center_y(b) > a.y0) & (G.center_y(b) < a.y1)
    before, after = a.x0 - b.x1, b.x0 - a.x1
    pairs = page_pairs(
        widgets.select(*PAGE, "rect_id", "x0", "y0", "x1", "y1"),
        words,
        same_row & ((before.between(0, 40)) | (after.between(0, 40))),
        reach=Reach(40, 0, 40, 0),
    )
    return (
        pairs.groupBy(*PAGE, "rect_id")
        .agg(
            F.min(F.when(before >= 0, before)).alias("gap_left"),
            F.min(F.when(after >= 0, after)).alias("gap_right"),
        )
        .where((F.col("gap_left") < min_gap) | (F.col("gap_right") < min_gap))
    )


def signature_line_text(lines: DataFrame, words: DataFrame, marker: str, search: float = 30.0) -> DataFrame:
    """Printed text just above a signature caption, nearest first."""
    a, b = G.box(), G.box("r_")
    captions = lines.where(F.col("text").rlike(marker)).select(*PAGE, "line_id", "x0", "y0", "x1", "y1")
    pairs = page_pairs(
        captions, words, (b.y1 <= a.y0) & (a.y0 - b.y1 <= search) & G.x_overlaps(a, b), reach=Reach(0, search, 0, 0)
    )
    return nearest(
        pairs,
        (*PAGE, "line_id"),
        {"above_id": F.col("r_line_id"), "gap": a.y0 - b.y1},
        [a.y0 - b.y1, b.x0, F.col("r_line_id")],
    )


def classified_fields(fields: DataFrame, labels: DataFrame, width: Column | None = None) -> DataFrame:
    """Attach the nearest label and the type it implies."""
    w = width if width is not None else F.col("x1") - F.col("x0")
    label = F.coalesce("label", F.lit(""))
    return fields.join(labels.select(*PAGE, "rect_id", "label"), [*PAGE, "rect_id"], "left").select(
        *PAGE, "rect_id", label.alias("label"), X.classify_field_type(label, w).alias("field_type")
    )
