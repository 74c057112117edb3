"""Field names and reading order."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions import geometry as G
from formloom.functions import text as X
from formloom.operators.pairs import PAGE, nearest, page_pairs
from formloom.operators.ranking import rank_in_groups
from formloom.operators.snap import modal_value
from formloom.session import cut_lineage



def _reading(id_col: str) -> tuple[list[Column], list[Column]]:
    """Page, top, left, id; and slices that never decrease along it."""
    return (
        [F.col("page"), F.col("y0"), F.col("x0"), F.col(id_col)],
        [F.col("page"), F.floor(F.col("y0") / 64)],
    )


def _lookup(table: Mapping[str, str], key: Column) -> Column:
    if not table:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for kv in sorted(table.items()) for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def _numbered(df: DataFrame, base: str, name: str, id_col: str) -> DataFrame:
    """``base`` for its first use in a form, ``base_N`` for later ones."""
    order, slices = _reading(id_col)
    ranked = rank_in_groups(df, ["form_id", base], order, slices, "_use")
    return ranked.withColumn(
        name, F.when(F.col("_use") == 1, F.col(base)).otherwise(F.concat_ws("_", base, F.col("_use").cast("string")))
    ).drop("_use")


def assign_names(
    fields: DataFrame,
    standard: Mapping[str, str],
    aliases: Mapping[str, str],
    id_col: str = "rect_id",
) -> DataFrame:
    """Names from labels in reading order: standard name, else cleaned label,
    else ``checkbox_N`` / ``field_N``; repeats get ``_N``.

    ``clash`` flags a numbered name that another field carries as its own.
    ``standard`` and ``aliases`` are small dictionaries, compiled to literals.
    """
    label = F.trim(F.coalesce("label", F.lit("")))
    known = _lookup(standard, F.regexp_replace(F.lower(label), "[:. ]+$", ""))
    cleaned = F.nullif(X.clean_label(label), F.lit(""))
    own = F.coalesce(known, cleaned, F.when(F.col("field_type") == "signature", "signature"))
    kind = F.when(own.isNull(), F.when(F.col("field_type") == "checkbox", "checkbox").otherwise("field"))
    staged = fields.withColumns({"_own": F.coalesce(_lookup(aliases, own), own), "_kind": F.coalesce(kind, F.lit(""))})
    order, slices = _reading(id_col)
    # a named field is counted within its name, a nameless one within its kind
    numbered = rank_in_groups(
        staged.withColumn("_group", F.coalesce("_own", "_kind")), ["form_id", "_kind", "_group"], order, slices, "_n"
    )
    n = F.col("_n").cast("string")
    base = F.when(F.col("_kind") != "", F.concat_ws("_", "_kind", n)).otherwise(F.col("_own"))
    plain = (F.col("_n") == 1) | (F.col("_kind") != "") | F.col("_own").rlike(r"^(checkbox|field)_\d+$")
    name = F.when(plain, base).otherwise(F.concat_ws("_", "_own", n))
    same = Window.partitionBy("form_id", "field_name")  # one row each, but for clashes
    return numbered.select(*PAGE, id_col, base.alias("base_name"), name.alias("field_name")).withColumn(
        "clash", F.count("*").over(same) > 1
    )


def assign_prefixed_names(fields: DataFrame, id_col: str = "rect_id") -> DataFrame:
    """Section prefix plus label slug, unless the label already starts with
    the prefix; repeats get ``_N``."""
    slug = F.when(F.col("label") != "", X.slugify(F.col("label"))).otherwise(F.col("kind"))
    prefix = F.coalesce("prefix", F.lit(""))
    base = F.when(
        (prefix != "") & ~F.startswith(slug, F.substring(prefix, 1, 8)), F.concat_ws("_", prefix, slug)
    ).otherwise(slug)
    based = fields.withColumn("base_name", base)
    return _numbered(based, "base_name", "field_name", id_col).select(*PAGE, id_col, "field_name")


def reuse_names(widgets: DataFrame, older: DataFrame, min_iou: float = 0.30) -> DataFrame:
    """The name of the older field lying best on the widget, else the section
    and label; made unique within the form."""
    iou = G.rect_iou(G.box(), G.box("r_"))
    cols = [*PAGE, "rect_id", "x0", "y0", "x1", "y1"]
    hits = nearest(
        page_pairs(widgets.select(cols), older.select(*cols, "field_name"), iou >= min_iou),
        (*PAGE, "rect_id"),
        {"old_name": F.col("r_field_name")},
        [-iou, F.col("r_rect_id")],
    )
    own = F.concat_ws(
        "_",
        F.when(X.present(F.col("section")), X.slugify(F.col("section"))),
        F.when(X.present(F.col("label")), X.slugify(F.col("label"))),
    )
    based = widgets.join(hits, [*PAGE, "rect_id"], "left").withColumn(
        "base_name",
        F.coalesce("old_name", F.nullif(own, F.lit("")), F.concat(F.lit("text_p"), F.col("page").cast("string"))),
    )
    return _numbered(based, "base_name", "field_name", "rect_id").select(
        *PAGE, "rect_id", "field_name", F.col("old_name").isNotNull().alias("reused")
    )


def renumber_rows(widgets: DataFrame, min_size: int = 3) -> DataFrame:
    """Columns of three or more widgets get their most common ``_rowN`` prefix
    and row numbers from top to bottom."""
    binned = widgets.where(X.present(F.col("field_name"))).withColumns(
        {
            "bin_x0": F.rint("x0"),
            "bin_x1": F.rint("x1"),
            "stem": F.nullif(F.regexp_extract("field_name", r"^(.+)_row\d+(?:_\d+)?$", 1), F.lit("")),
        }
    )
    col = [*PAGE, "bin_x0", "bin_x1"]
    stems = binned.where("stem IS NOT NULL").groupBy(*col, "stem").agg(F.count("*").alias("n"))
    # ties between prefixes go to the first in alphabetical order
    modal = stems.groupBy(*col).agg(F.min(F.struct((-F.col("n")).alias("n"), "stem")).alias("m"))
    sizes = binned.groupBy(*col).agg(F.count("*").alias("size")).where(F.col("size") >= min_size)
    chosen = modal.join(sizes, col).select(*col, F.col("m.stem").alias("prefix"))
    ranked = rank_in_groups(
        binned.join(chosen, col), col, [F.col("y0"), F.col("rect_id")], [F.floor(F.col("y0") / 64)], "row_no"
    )
    return ranked.select(
        *PAGE, "rect_id", F.concat(F.col("prefix"), F.lit("_row"), F.col("row_no").cast("string")).alias("field_name")
    )


def reading_order(items: DataFrame, id_col: str = "rect_id", line: float = 4.0) -> DataFrame:
    """Position by page, 4-point line band, then left edge."""
    band = F.floor(F.col("y0") / line)
    ranked = rank_in_groups(
        items, ["form_id"], [F.col("page"), band, F.col("x0"), F.col(id_col)],
        [F.col("page"), F.floor(F.col("y0") / (16 * line))], "position",
    )
    return ranked.select(*PAGE, id_col, "position")


def vertical_bands(items: DataFrame, gap: float = 12.0) -> DataFrame:
    """Bands of a page separated by empty rows higher than ``gap``.

    Whether a new band starts depends only on tops and lowest bottoms so far,
    so the walk is over the page's distinct tops.
    """
    tops = items.groupBy(*PAGE, "y0").agg(F.max("y1").alias("bottom"))
    w = Window.partitionBy(*PAGE).orderBy("y0")
    reach = F.max("bottom").over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = tops.withColumn("_new", F.when(F.col("y0") - reach <= gap, 0).otherwise(1))
    bands = flagged.select(*PAGE, "y0", F.sum("_new").over(w).alias("band"))
    return items.join(bands, [*PAGE, "y0"])


def band_columns(items: DataFrame, min_gutter: float = 25.0, id_col: str = "rect_id") -> DataFrame:
    """Side (left or right) of items in bands that split at one clear gutter:
    the median gap centre, in the middle 60 % of the band, with nothing across."""
    banded = vertical_bands(items)
    row = [*PAGE, "band", "row"]
    placed = banded.withColumn("row", F.floor(F.col("y0") / 4))
    w = Window.partitionBy(*row).orderBy("x0", id_col)
    gaps = placed.select(*PAGE, "band", "x1", F.lead("x0").over(w).alias("next_x")).where(
        F.col("next_x") - F.col("x1") >= min_gutter
    )
    centers = gaps.groupBy(*PAGE, "band", ((F.col("x1") + F.col("next_x")) / 2).alias("c")).agg(F.count("*").alias("n"))
    wb = Window.partitionBy(*PAGE, "band")
    upto = F.sum("n").over(wb.orderBy("c"))
    total = F.sum("n").over(wb)
    middle = (
        centers.withColumns({"upto": upto, "total": total})
        .where(F.col("upto") > F.floor(F.col("total") / 2))
        .groupBy(*PAGE, "band")
        .agg(F.min("c").alias("gutter"))
    )
    judged = placed.join(middle, [*PAGE, "band"])
    extent = judged.groupBy(*PAGE, "band", "gutter").agg(
        F.max((F.col("x0") < F.col("gutter") - 1) & (F.col("x1") > F.col("gutter") + 1)).alias("crossed"),
        F.min("x0").alias("bx0"),
        F.max("x1").alias("bx1"),
        F.max(F.col("x1") <= F.col("gutter")).alias("has_left"),
        F.max(F.col("x0") >= F.col("gutter")).alias("has_right"),
    )
    share = (F.col("gutter") - F.col("bx0")) / F.greatest(F.col("bx1") - F.col("bx0"), F.lit(1.0))
    good = extent.where(~F.col("crossed") & share.between(0.2, 0.8) & F.col("has_left") & F.col("has_right"))
    side = F.when(F.col("x1") <= F.col("gutter"), "left").when(F.col("x0") >= F.col("gutter"), "right")
    return (
        judged.join(good.select(*PAGE, "band"), [*PAGE, "band"], "left_semi")
        .select(*PAGE, id_col, "band", "gutter", side.alias("side"))
        .where(F.col("side").isNotNull())
    )


def conditional_sections(fields: DataFrame) -> DataFrame:
    """Gate fields: one whose name prefixes two or more others, or
    ``<base>_enabler`` for the names under its base.

    The longest gate claims its fields first; one left with fewer than two
    gives them up to the next shorter.  Gates that share fields form a
    component, and each component is walked once in that order by one task;
    components of too many pairs are cut by rounds, each of which settles every
    gate that no longer one stands before.
    """
    from formloom.operators.greedy import _by_component

    ids = fields.select("form_id", "field_id").distinct()
    open_edges = cut_lineage(section_candidates(ids))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in open_edges.schema)
    ends = [F.struct("form_id", F.lit(side).alias("side"), F.col(c).alias("name")) for side, c in enumerate(("gate", "child"))]
    claimed = open_edges.limit(0)
    child = Window.partitionBy("form_id", "child")
    gate = Window.partitionBy("form_id", "gate")
    first = F.struct(F.length("gate").alias("len"), F.col("gate").alias("gate"))
    while not open_edges.isEmpty():
        whole, open_edges = _by_component(open_edges, ends[0], *ends)
        claimed = claimed.unionByName(cut_lineage(whole.groupBy("root").applyInPandas(_walk_gates, schema)))
        if open_edges.isEmpty():
            break
        state = open_edges.withColumn("_top", first == F.max(first).over(child))
        state = state.withColumns({"_ready": F.min("_top").over(gate), "_n": F.count("*").over(gate)})
        state = state.withColumn("_claim", F.col("_ready") & (F.col("_n") >= 2))
        state = cut_lineage(state.withColumn("_taken", F.max("_claim").over(child)))
        claimed = claimed.unionByName(state.where("_claim").select("form_id", "gate", "child"))
        open_edges = state.where(~F.col("_ready") & ~F.col("_taken")).select("form_id", "gate", "child")
    return claimed


def _walk_gates(edges: pd.DataFrame) -> pd.DataFrame:
    """What each gate of one component claims, the longest name first."""
    taken: set[str] = set()
    won = []
    groups = sorted(edges.groupby("gate"), key=lambda g: (len(g[0]), g[0].encode()), reverse=True)
    for _, own in groups:
        free = own[~own["child"].isin(taken)]
        if len(free) >= 2:
            taken |= set(free["child"])
            won.append(free)
    return pd.concat(won)[["form_id", "gate", "child"]] if won else edges.iloc[:0][["form_id", "gate", "child"]]


def section_candidates(ids: DataFrame) -> DataFrame:
    """(gate, child) pairs by name prefix, for gates with at least two."""
    parts = F.split("field_id", "_")
    prefixes = ids.select(
        "form_id",
        F.col("field_id").alias("child"),
        F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "_"))).alias("prefix"),
    ).where(~F.col("child").endswith("_enabler") & (F.col("prefix") != F.col("child")))
    enabler = F.col("field_id").endswith("_enabler")
    gates = ids.select(
        "form_id",
        F.col("field_id").alias("gate"),
        F.explode(
            F.array_compact(F.array(F.col("field_id"), F.when(enabler, F.regexp_replace("field_id", "_enabler$", ""))))
        ).alias("prefix"),
    )
    pairs = prefixes.join(gates, ["form_id", "prefix"]).where("gate <> child").select("form_id", "gate", "child")
    enough = pairs.groupBy("form_id", "gate").agg(F.count("*").alias("n")).where("n >= 2")
    return pairs.join(enough.select("form_id", "gate"), ["form_id", "gate"], "left_semi")


def stacked_blocks(rules: DataFrame, labels: DataFrame, max_height: float = 80.0) -> DataFrame:
    """Stacks of two or more rules close under one another, near an address
    label: gaps under 30, overlap over 50, at most 80 high."""
    from formloom.operators.ranking import block_window, neighbours, running

    ranked = rank_in_groups(rules, PAGE, [F.col("y0"), F.col("x0"), F.col("rule_id")], [F.floor(F.col("y0") / 64)])
    w = block_window(PAGE)
    near = neighbours(
        ranked,
        PAGE,
        {"_py": F.lag("y1").over(w), "_px0": F.lag("x0").over(w), "_px1": F.lag("x1").over(w)},
        behind=1,
    )
    gap = F.col("y0") - F.col("_py")
    shared = F.least("x1", "_px1") - F.greatest("x0", "_px0")
    joins = (gap > 0) & (gap < 30) & (shared > 50)
    grouped = running(near, PAGE, F.when(joins, 0).otherwise(1), "block")
    blocks = (
        grouped.groupBy(*PAGE, "block")
        .agg(
            F.count("*").alias("n_rules"), F.min("x0").alias("x0"), F.min("y0").alias("y0"),
            F.max("x1").alias("x1"), F.max("y1").alias("y1"),
        )
        .where((F.col("n_rules") >= 2) & (F.col("y1") - F.col("y0") <= max_height))
    )
    from formloom.operators.pairs import Reach, page_semi

    a, b = G.box(), G.box("r_")
    return page_semi(
        blocks,
        labels,
        (F.abs(b.y1 - a.y0) < 40) & G.x_overlaps(b, a),
        id_cols=(*PAGE, "block"),
        reach=Reach(0, 40, 0, 40),
    )
