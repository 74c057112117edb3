"""Order-dependent picks, computed in rounds instead of one page at a time.

Keeping the best and dropping what conflicts with it, walking down a list, has
one well-defined result: a row is dropped exactly when some earlier row that
was kept conflicts with it.  A round settles every row whose earlier conflicts
are all settled, for all pages at once.  After a few rounds the conflicts left
are cut into components, which know nothing of one another: each is walked in
its order by one task.  All of it works on conflicting pairs only.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from formloom.functions import geometry as G
from formloom.functions import text as X
from formloom.operators import page_walks as W
from formloom.operators.pairs import BOX, PAGE, Reach, page_pairs, page_pairs_within
from formloom.session import cut_lineage, stored


#: Edges of a component that one task walks; rounds cut larger ones apart.
WALKED_EDGES = 200_000
#: Rounds before components are looked for: most conflicts are shallow.
ROUNDS_FIRST = 2


def dropped_by_better(edges: DataFrame) -> DataFrame:
    """Nodes dropped when conflicts are settled from the best down.

    ``edges`` has struct columns ``hi`` and ``lo``: of two conflicting nodes
    ``hi`` comes first.  Returns distinct ``node``.

    A round settles what nothing unsettled stands before, which ends most
    conflicts.  What is left falls into components; each is walked once in its
    order, by one task, so a long chain costs the logarithm of its length in
    jobs.  Components of more than ``WALKED_EDGES`` go through further rounds,
    which break them up.
    """
    edges = cut_lineage(edges.select("hi", "lo").distinct())
    gone = edges.select(F.col("lo").alias("node")).limit(0)
    while not edges.isEmpty():
        for _ in range(ROUNDS_FIRST):
            beaten = edges.select(F.col("lo").alias("node")).distinct()
            safe = edges.join(beaten, F.col("hi") == F.col("node"), "left_anti")
            lost = cut_lineage(safe.select(F.col("lo").alias("node")).distinct())
            gone = gone.unionByName(lost)
            edges = cut_lineage(edges.join(lost, F.col("lo") == F.col("node"), "left_anti").join(lost, F.col("hi") == F.col("node"), "left_anti"))
        if edges.isEmpty():
            break
        whole, edges = _by_component(edges, F.col("hi"), F.col("hi"), F.col("lo"))
        schema = StructType([StructField("node", whole.schema["lo"].dataType)])
        walked = whole.groupBy("root").applyInArrow(_walk_conflicts, schema)
        gone = gone.unionByName(cut_lineage(walked))
    return gone


def _walk_conflicts(table: pa.Table) -> pa.Table:
    """The nodes dropped in one component: a node is judged when all that come
    before it are."""
    hi, lo = ([tuple(node.values()) for node in table.column(side).to_pylist()] for side in ("hi", "lo"))
    before, after = Counter(lo), defaultdict(list)
    for a, b in zip(hi, lo):
        after[a].append(b)
    ready, gone = [a for a in after if not before[a]], set()
    while ready:
        node = ready.pop()
        for other in after.get(node, ()):
            if node not in gone:
                gone.add(other)
            before[other] -= 1
            if not before[other]:
                ready.append(other)
    first = {node: i for i, node in enumerate(lo) if node in gone}
    return pa.table({"node": table.column("lo").take(pa.array(first.values(), pa.int64()))})


def _by_component(rows: DataFrame, at: Column, u: Column, v: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with the ``root`` of their component over links ``u, v`` (found by
    their node ``at``), and the rows of components too large to walk."""
    roots = cut_lineage(connected_components(rows.select(u.alias("u"), v.alias("v"))))
    named = cut_lineage(rows.join(roots, at == F.col("node")).drop("node"))
    large = named.groupBy("root").agg(F.count("*").alias("_n")).where(F.col("_n") > WALKED_EDGES).select("root")
    return named.join(large, "root", "left_anti"), cut_lineage(named.join(large, "root", "left_semi").drop("root"))


def _conflicts(
    df: DataFrame, id_col: str, order: Sequence[str], conflict: Column, reach: Reach = Reach(), corners: bool = False
) -> DataFrame:
    """Conflicting pairs as (hi, lo) nodes; ``order`` columns sort ascending.
    With ``corners`` only boxes whose top left corners are within reach conflict."""
    cols = list(dict.fromkeys([*PAGE, id_col, "x0", "y0", "x1", "y1", *order]))
    slim = df.select(*cols)
    first = F.struct(*[F.col(c) for c in order], F.col(id_col))
    second = F.struct(*[F.col("r_" + c).alias(c) for c in order], F.col("r_" + id_col).alias(id_col))
    if len(set(reach)) == 1 and reach.left is not None:
        pairs = page_pairs_within(slim, (first < second) & conflict, reach.left, corners=corners)
    else:
        pairs = page_pairs(slim, slim, (first < second) & conflict, reach=reach)
    return pairs.select(
        F.struct(*PAGE, F.col(id_col).alias("id")).alias("hi"),
        F.struct(*PAGE, F.col("r_" + id_col).alias("id")).alias("lo"),
    )


def _without(df: DataFrame, id_col: str, dropped: DataFrame) -> DataFrame:
    gone = dropped.select(*[F.col(f"node.{k}").alias(k) for k in PAGE], F.col("node.id").alias(id_col))
    return df.join(gone, [*PAGE, id_col], "left_anti")


def _first_of_box(df: DataFrame, id_col: str, order: Sequence[str], apart: Column | None = None) -> DataFrame:
    """The first row of each distinct box.  Equal boxes conflict and share all
    other conflicts, so the rows after the first are dropped whatever happens
    to it; k boxes on one spot then need no pairs.  Rows with ``apart`` (boxes
    that do not conflict with their equals) stay by themselves.  Both sides of
    the pairs and the survivors read them, so they are worked out once."""
    alone = F.when(apart, F.col(id_col)) if apart is not None else F.lit(None)
    first = F.min(F.struct(*order, id_col)).alias("_f")
    return stored(
        df.groupBy(*PAGE, *BOX, alone.alias("_alone"))
        .agg(first)
        .select(*PAGE, *BOX, *[F.col(f"_f.{c}").alias(c) for c in (*order, id_col)])
    )


def _survivors(df: DataFrame, firsts: DataFrame, id_col: str, edges: DataFrame) -> DataFrame:
    kept = _without(firsts, id_col, dropped_by_better(edges)).select(*PAGE, id_col)
    return df.join(kept, [*PAGE, id_col], "left_semi")


def nms(rects: DataFrame, threshold: float = 0.5, id_col: str = "rect_id") -> DataFrame:
    """Best first by source rank, then by area: drop what overlaps a kept one
    by ``threshold``.  Ties go to the smaller id."""
    if threshold <= 0:  # boxes apart from one another would conflict
        return _nms_by_pairs(rects, threshold, id_col)
    (pages,), (crowded,), any_crowded = W.by_crowd([rects], id_col, "source_rank")
    order = ["source_rank", -G.rect_area(G.box())]
    kept = W.kept_on_pages(pages, id_col, order, lambda a, b: W.iou(a, b) >= threshold)
    return kept.unionByName(_nms_by_pairs(crowded, threshold, id_col)) if any_crowded else kept


def _nms_by_pairs(rects: DataFrame, threshold: float, id_col: str) -> DataFrame:
    order = ("source_rank", "neg_area")
    ranked = rects.withColumn("neg_area", -G.rect_area(G.box()))
    firsts = _first_of_box(ranked, id_col, order, ~(G.rect_iou(G.box(), G.box()) >= threshold))
    edges = _conflicts(firsts, id_col, order, G.rect_iou(G.box(), G.box("r_")) >= threshold)
    return _survivors(rects, firsts, id_col, edges)


def dedupe_fields(fields: DataFrame, tolerance: float = 5.0, id_col: str = "rect_id") -> DataFrame:
    """Of fields whose four edges agree within ``tolerance`` the most
    confident stays (then the smaller id)."""
    (pages,), (crowded,), any_crowded = W.by_crowd([fields], id_col, "confidence")
    kept = W.kept_on_pages(pages, id_col, [-F.col("confidence")], lambda a, b: (abs(a - b) < tolerance).all(axis=0))
    return kept.unionByName(_dedupe_by_pairs(crowded, tolerance, id_col)) if any_crowded else kept


def _dedupe_by_pairs(fields: DataFrame, tolerance: float, id_col: str) -> DataFrame:
    ranked = fields.withColumn("doubt", -F.col("confidence"))
    same = (
        (F.abs(F.col("x0") - F.col("r_x0")) < tolerance)
        & (F.abs(F.col("y0") - F.col("r_y0")) < tolerance)
        & (F.abs(F.col("x1") - F.col("r_x1")) < tolerance)
        & (F.abs(F.col("y1") - F.col("r_y1")) < tolerance)
    )
    firsts = _first_of_box(ranked, id_col, ("doubt",), F.lit(tolerance <= 0))
    edges = _conflicts(firsts, id_col, ("doubt",), same, Reach.all_round(tolerance), corners=True)
    return _survivors(fields, firsts, id_col, edges)


def row_leaders(rules: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """Rows of rules: a rule joins the row whose first rule is at most
    ``tolerance`` above it.  Returns each distinct height with its row's top.

    A page has a bounded number of distinct heights, so the walk folds over
    one short sorted array per page.
    """
    heights = rules.groupBy(*PAGE).agg(F.array_sort(F.collect_set("y0")).alias("ys"))
    tops = F.aggregate(
        "ys",
        F.expr("CAST(array() AS ARRAY<STRUCT<y: DOUBLE, top: DOUBLE>>)"),
        lambda acc, y: F.concat(
            acc,
            F.array(
                F.struct(
                    y.alias("y"),
                    F.when(
                        (F.size(acc) > 0) & (y - F.element_at(acc, -1)["top"] <= tolerance),
                        F.element_at(acc, -1)["top"],
                    )
                    .otherwise(y)
                    .alias("top"),
                )
            ),
        ),
    )
    return heights.select(*PAGE, F.inline(tops)).select(*PAGE, F.col("y").alias("y0"), F.col("top").alias("row_y"))


def drawn_tables(rules: DataFrame, min_rows: int = 3, col_tol: float = 6.0, min_col: float = 80.0) -> DataFrame:
    """Cells of tables drawn as rows of underlines.

    The most common exact column signature of a page, seen at least three
    times, sets the columns; every row within ``col_tol`` of it belongs to the
    table, and each column at least ``min_col`` wide gives a cell between
    consecutive rows.
    """
    rows = row_leaders(rules)
    segments = rules.join(rows, [*PAGE, "y0"]).groupBy(*PAGE, "row_y", "x0", "x1").agg(F.count("*").alias("n"))
    n_segs = segments.groupBy(*PAGE, "row_y").agg(
        F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("x0", "x1", "n"))).alias("sig"),
    ).where("n >= 2")
    sigs = n_segs.groupBy(*PAGE, "sig").agg(F.count("*").alias("times"), F.min("row_y").alias("first_y"))
    dominant = (
        sigs.groupBy(*PAGE)
        .agg(F.max_by(F.struct("sig", "times"), F.struct("times", -F.col("first_y"))).alias("d"))
        .where(F.col("d.times") >= min_rows)
        .select(*PAGE, F.col("d.sig").alias("dom"))
    )
    flat = lambda c: F.flatten(F.transform(c, lambda s: F.array_repeat(F.struct(s["x0"].alias("x0"), s["x1"].alias("x1")), s["n"].cast("int"))))
    close = F.forall(
        F.arrays_zip(F.col("a"), F.col("b")),
        lambda p: (F.abs(p["a"]["x0"] - p["b"]["x0"]) <= col_tol) & (F.abs(p["a"]["x1"] - p["b"]["x1"]) <= col_tol),
    )
    table_rows = (
        n_segs.join(dominant, list(PAGE))
        .select(*PAGE, "row_y", flat(F.col("sig")).alias("a"), flat(F.col("dom")).alias("b"))
        .where((F.size("a") == F.size("b")) & close)
    )
    w = Window.partitionBy(*PAGE).orderBy("row_y")
    return (
        table_rows.withColumn("next_y", F.lead("row_y").over(w))
        .where(F.col("next_y").isNotNull())
        .select(*PAGE, "row_y", "next_y", F.explode("b").alias("c"))
        .select(*PAGE, F.col("c.x0").alias("x0"), F.col("row_y").alias("y0"), F.col("c.x1").alias("x1"), F.col("next_y").alias("y1"))
        .where(F.col("x1") - F.col("x0") >= min_col)
    )


def radio_groups(boxes: DataFrame, max_drop: float = 60.0, max_shift: float = 30.0) -> DataFrame:
    """Choice boxes grouped under leaders.

    In reading order the first free box leads and takes every later free one
    at most ``max_drop`` below and ``max_shift`` to the side.  Leaders are
    exactly the boxes no earlier leader reaches; every other box belongs to
    the earliest leader reaching it.
    """
    dx = F.abs(F.col("r_x0") - F.col("x0"))
    dy = F.col("r_y0") - F.col("y0")
    reach = Reach(max_shift, 0, max_shift, max_drop)
    near = (dx <= max_shift) & dy.between(0, max_drop)
    edges = _conflicts(boxes, "box_id", ("y0", "x0"), near, reach)
    leaders = cut_lineage(_without(boxes.select(*PAGE, "box_id", "x0", "y0", "x1", "y1"), "box_id", dropped_by_better(edges)))
    slim = boxes.select(*PAGE, "box_id", "x0", "y0", "x1", "y1")
    member_of = (
        page_pairs(
            leaders,
            slim,
            near
            & (
                F.struct("y0", "x0", "box_id")
                <= F.struct(F.col("r_y0").alias("y0"), F.col("r_x0").alias("x0"), F.col("r_box_id").alias("box_id"))
            ),
            reach=reach,
        )
        .groupBy(*PAGE, F.col("r_box_id").alias("box_id"))
        .agg(F.min(F.struct("y0", "x0", "box_id")).alias("lead"))
    )
    return member_of.select(*PAGE, "box_id", F.col("lead.box_id").alias("leader_id"))


# Labels that suggest an exclusive choice.
EXCLUSIVE_WORDS = (
    "yes", "no", "male", "female", "formal", "informal", "petitioner", "respondent",
    "check one", "select one",
)


def promote_groups(members: DataFrame, boxes: DataFrame, words: Sequence[str] = EXCLUSIVE_WORDS) -> DataFrame:
    """Groups of two to five boxes that read as one exclusive choice."""
    by = [*PAGE, "leader_id"]
    sized = members.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n").between(2, 5))
    label = F.lower(F.coalesce("label", F.lit("")))
    labelled = (
        members.join(sized, by)
        .join(boxes.select(*PAGE, "box_id", "y0", "x0", label.alias("label")), [*PAGE, "box_id"])
        .groupBy(*by, "n")
        .agg(F.array_sort(F.collect_list(F.struct("y0", "x0", "box_id", "label"))).alias("m"))
        .withColumn("labels", F.col("m.label"))
    )
    filled = F.filter("labels", lambda s: s != "")
    has = lambda w: F.exists("labels", lambda s: s.contains(w))
    short = (F.col("n") <= 3) & F.forall("labels", lambda s: F.length(s) < 30) & (F.size(filled) >= 2)
    is_radio = F.array_join("labels", " ").rlike(X.any_word(words)) | (has("yes") & has("no")) | short
    option = F.substring(F.translate(F.trim("o.label"), " ", "_"), 1, 32)
    return (
        labelled.where(is_radio)
        .select(*by, F.explode("m").alias("o"))
        .select(*by, F.col("o.box_id").alias("box_id"), option.alias("group_option"))
    )


def candidate_matches(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """All pairs of two detectors on a page with IoU at or above ``threshold``."""
    iou = G.rect_iou(G.box(), G.box("r_"))
    cols = [*PAGE, "rect_id", "x0", "y0", "x1", "y1"]
    ca, cb = G.box(), G.box("r_")
    return page_pairs(a.select(*cols), b.select(*cols), iou >= threshold).select(
        *PAGE,
        F.col("rect_id").alias("a_id"),
        F.col("r_rect_id").alias("b_id"),
        iou.alias("iou"),
        G.center_dist(ca, cb).alias("center_dist"),
    )


def mutual_best(pairs: DataFrame) -> DataFrame:
    """Mark pairs that are the first choice of both their ends."""
    order = F.struct((-F.col("iou")).alias("s"), "a_id", "b_id")
    wa = Window.partitionBy(*PAGE, "a_id")
    wb = Window.partitionBy(*PAGE, "b_id")
    return (
        pairs.withColumn("_o", order)
        .withColumn("_a", F.min("_o").over(wa))
        .withColumn("_b", F.min("_o").over(wb))
        .withColumn("chosen", (F.col("_o") == F.col("_a")) & (F.col("_o") == F.col("_b")))
        .drop("_o", "_a", "_b")
    )


def iou_match(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """Greedy one-to-one matching by (IoU descending, a_id, b_id)."""
    return iou_matches(a, b, (threshold,))[threshold]


def iou_matches(a: DataFrame, b: DataFrame, thresholds: Sequence[float]) -> dict[float, DataFrame]:
    """``iou_match`` at several thresholds; candidates are looked for once, at
    the least, and serve all others."""
    cols = [*PAGE, "rect_id", *BOX]
    pages, crowded, any_crowded = W.by_crowd([a.select(*cols), b.select(*cols)], "rect_id")
    if min(thresholds) <= 0:  # pairs would need to touch only
        pages, crowded, any_crowded = [], [a, b], True
    pairs = candidate_matches(*crowded, min(thresholds))
    pairs = stored(pairs) if any_crowded else pairs
    by_pairs = {t: match_pairs(pairs.where(F.col("iou") >= t)) for t in thresholds if any_crowded}
    if not pages:
        return by_pairs
    found = W.matches_on_pages(*pages, thresholds).select(
        *PAGE,
        F.col("rect_id").cast(a.schema["rect_id"].dataType).alias("a_id"),
        F.col("r_rect_id").cast(b.schema["rect_id"].dataType).alias("b_id"),
        G.rect_iou(G.box(), G.box("r_")).alias("iou"),
        G.center_dist(G.box(), G.box("r_")).alias("center_dist"),
        "at",
    )
    found = stored(found) if len(thresholds) > 1 else found
    taken = {t: found.where(F.col("at").bitwiseAND(1 << i) != 0).drop("at") for i, t in enumerate(thresholds)}
    return {t: taken[t].unionByName(by_pairs[t]) if any_crowded else taken[t] for t in thresholds}


def match_pairs(open_pairs: DataFrame) -> DataFrame:
    """Greedy one-to-one choice among candidate pairs, best first.

    A pair that is best for both its ends is taken by the greedy walk whatever
    the other pairs are.  A round takes those, the rest falls into components of
    boxes, and each is walked once in its order by one task.  Components of more
    than ``WALKED_EDGES`` pairs go through further rounds.
    """
    wa = Window.partitionBy(*PAGE, "a_id")
    wb = Window.partitionBy(*PAGE, "b_id")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in open_pairs.schema)
    ends = [F.struct(*PAGE, F.lit(side).alias("side"), F.col(c).alias("id")) for side, c in enumerate(("a_id", "b_id"))]
    done: DataFrame | None = None
    while True:
        state = (
            mutual_best(open_pairs)
            .withColumn("_tb", F.max("chosen").over(wb))  # rows are dealt by b_id already
            .withColumn("_ta", F.max("chosen").over(wa))
            .where(F.col("chosen") | ~(F.col("_ta") | F.col("_tb")))
            .drop("_ta", "_tb")
        )
        state = cut_lineage(state)
        picked = state.where("chosen").drop("chosen")
        done = picked if done is None else done.unionByName(picked)
        open_pairs = state.where(~F.col("chosen")).drop("chosen")
        if open_pairs.isEmpty():
            return done
        whole, open_pairs = _by_component(open_pairs, ends[0], *ends)
        done = done.unionByName(cut_lineage(whole.groupBy("root").applyInPandas(_walk_matches, schema)))


def _walk_matches(pairs: pd.DataFrame) -> pd.DataFrame:
    """One component's pairs from the best down, each end taken once."""
    pairs = pairs.sort_values(["iou", "a_id", "b_id"], ascending=[False, True, True])
    left, right, keep = set(), set(), []
    for x, y in zip(pairs["a_id"], pairs["b_id"]):
        keep.append(x not in left and y not in right)
        if keep[-1]:
            left.add(x)
            right.add(y)
    return pairs.loc[keep].drop(columns="root")


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node of each connected component, by star contraction.

    ``edges`` has columns ``u`` and ``v`` of one orderable type.  Every step is
    an aggregation and a join on nodes; the number of rounds grows with the
    logarithm of the component size.  Returns ``node, root`` for nodes with an
    edge.
    """
    edges = cut_lineage(edges.select("u", "v").where("u <> v").distinct())

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        linked = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return linked.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()

    seen = None
    while True:
        after = cut_lineage(small_star(large_star(edges)))
        digest = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if digest == seen:
            break
        edges, seen = after, digest
    roots = after.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    tops = after.select(F.col("v").alias("node")).distinct().join(roots, "node", "left_anti")
    return roots.unionByName(tops.withColumn("root", F.col("node")))


def proximity_components(members: DataFrame, pages: DataFrame, distance: float = 300.0) -> DataFrame:
    """Members of one group linked when their centres lie within ``distance``;
    heights run on from page to page of a form.

    ``members``: form_id, group_id, page, box_id and a box.  Adds
    ``component`` (id of its first member) and ``global_y``.
    """
    before = Window.partitionBy("form_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pages.select("form_id", "page", F.coalesce(F.sum("height").over(before), F.lit(0.0)).alias("page_y"))
    cx, cy = (F.col("x0") + F.col("x1")) / 2, F.col("page_y") + (F.col("y0") + F.col("y1")) / 2
    placed = members.join(offsets, list(PAGE)).select(
        *PAGE, "group_id", "box_id", cx.alias("x0"), cy.alias("y0"), cx.alias("x1"), cy.alias("y1"),
        (F.col("page_y") + F.col("y0")).alias("global_y"),
    )
    node = F.struct("form_id", "group_id", "page", "box_id")
    other = F.struct(*[F.col("r_" + c).alias(c) for c in ("form_id", "group_id", "page", "box_id")])
    points = placed.select("form_id", "group_id", "page", "box_id", "x0", "y0", "x1", "y1")
    close = F.hypot(F.col("x0") - F.col("r_x0"), F.col("y0") - F.col("r_y0")) < distance
    links = page_pairs(
        points,
        points,
        (node < other) & close,
        reach=Reach.all_round(distance),
        cell=(distance, distance),
        keys=("form_id", "group_id"),
    ).select(node.alias("u"), other.alias("v"))
    found = connected_components(links)
    named = found.select(
        *[F.col(f"node.{c}").alias(c) for c in ("form_id", "group_id", "page", "box_id")],
        F.struct(F.col("root.page").alias("page"), F.col("root.box_id").alias("box_id")).alias("root"),
    )
    own = F.struct("page", "box_id")
    return placed.join(named, ["form_id", "group_id", "page", "box_id"], "left").select(
        "form_id", "group_id", "page", "box_id", "global_y",
        F.coalesce("root.page", "page").alias("root_page"),
        F.coalesce("root.box_id", "box_id").alias("root_box"),
    )


def split_groups(components: DataFrame, members: DataFrame) -> DataFrame:
    """One radio group per component, numbered top to bottom; the smallest box
    per option stays; groups left with fewer than two members go."""
    comp = ["form_id", "group_id", "root_page", "root_box"]
    tops = components.groupBy(*comp).agg(F.min("global_y").alias("top"))
    w = Window.partitionBy("form_id", "group_id").orderBy("top", "root_page", "root_box")
    numbered = tops.select(*comp, F.row_number().over(w).alias("n"), F.count("*").over(Window.partitionBy("form_id", "group_id")).alias("n_groups"))
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    options = (
        components.join(members.select("form_id", "group_id", "page", "box_id", "group_option", area.alias("area")), ["form_id", "group_id", "page", "box_id"])
        .where(X.present(F.col("group_option")))
        .groupBy(*comp, "group_option")
        .agg(F.min(F.struct("area", "page", "box_id")).alias("best"))
    )
    sized = options.groupBy(*comp).agg(F.count("*").alias("n_options")).where("n_options >= 2")
    name = F.when(F.col("n_groups") == 1, F.col("group_id")).otherwise(F.concat_ws("_", "group_id", F.col("n").cast("string")))
    return (
        options.join(sized, comp)
        .join(numbered, comp)
        .select("form_id", name.alias("group_name"), "group_option", F.col("best.page").alias("page"), F.col("best.box_id").alias("box_id"))
    )


def precision_recall(truth: DataFrame, candidates: DataFrame, matches: dict[float, DataFrame]) -> DataFrame:
    """Counts of truth, candidates and matches at each threshold, per form and
    in total (form_id null)."""
    parts = [
        truth.groupBy("form_id").agg(F.count("*").alias("n")).withColumn("what", F.lit("truth")),
        candidates.groupBy("form_id").agg(F.count("*").alias("n")).withColumn("what", F.lit("candidates")),
    ]
    names = ["truth", "candidates"]
    for thr, m in matches.items():
        names.append(f"matched_{round(thr * 100)}")
        parts.append(m.groupBy("form_id").agg(F.count("*").alias("n")).withColumn("what", F.lit(names[-1])))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return stacked.rollup("form_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("what") == n, F.col("n"))), F.lit(0)).alias(n) for n in names]
    )


def match_stats(a: DataFrame, b: DataFrame, matches: DataFrame) -> DataFrame:
    """Matched, extras on both sides, mean IoU and mean centre distance."""
    m = matches.groupBy("form_id").agg(
        F.count("*").alias("matched"),
        F.round(F.avg("iou"), 6).alias("mean_iou"),
        F.round(F.avg("center_dist"), 6).alias("mean_dist"),
    )
    na = a.groupBy("form_id").agg(F.count("*").alias("n_a"))
    nb = b.groupBy("form_id").agg(F.count("*").alias("n_b"))
    matched = F.coalesce("matched", F.lit(0))
    return (
        na.join(nb, "form_id", "full")
        .join(m, "form_id", "left")
        .select(
            "form_id",
            matched.alias("matched"),
            (F.coalesce("n_a", F.lit(0)) - matched).alias("only_a"),
            (F.coalesce("n_b", F.lit(0)) - matched).alias("only_b"),
            "mean_iou",
            "mean_dist",
        )
    )


def dropped_truth(truth: DataFrame, stage1: DataFrame, stage2: DataFrame) -> DataFrame:
    """Truth rows matched by stage 1 and lost by stage 2, or never matched."""
    key = [*PAGE, "rect_id"]
    m1 = stage1.select(*PAGE, F.col("a_id").alias("rect_id")).distinct().withColumn("in1", F.lit(True))
    m2 = stage2.select(*PAGE, F.col("a_id").alias("rect_id")).distinct().withColumn("in2", F.lit(True))
    reason = F.when(F.col("in1") & F.col("in2").isNull(), "lost_in_second").when(
        F.col("in1").isNull() & F.col("in2").isNull(), "never_matched"
    )
    return (
        truth.select(*key)
        .join(m1, key, "left")
        .join(m2, key, "left")
        .select(*key, reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )
