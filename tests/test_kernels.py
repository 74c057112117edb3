"""Order-dependent operators against plain walks over small pages."""

import random

import pytest
from pyspark.sql import functions as F

from formloom.operators import greedy, naming, ranking, reports, snap

BOXES = "form_id int, page int, rect_id int, x0 double, y0 double, x1 double, y1 double"


def boxes(spark, seed, n=60, size=60):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = r.randrange(0, 200, 5), r.randrange(0, 200, 5)
        rows.append((i % 2, 0, i, float(x), float(y), float(x + r.randrange(10, size)), float(y + r.randrange(8, 20))))
    return rows, spark.createDataFrame(rows, BOXES)


def iou(a, b):
    w, h = min(a[5], b[5]) - max(a[3], b[3]), min(a[6], b[6]) - max(a[4], b[4])
    inter = max(0, w) * max(0, h)
    area = lambda r: (r[5] - r[3]) * (r[6] - r[4])
    return inter / (area(a) + area(b) - inter)


@pytest.mark.parametrize("seed", [1, 2])
def test_iou_match_is_the_greedy_walk(spark, seed):
    ra, a = boxes(spark, seed)
    rb, b = boxes(spark, seed + 10)
    pairs = sorted(
        (-iou(x, y), x[2], y[2], x[0]) for x in ra for y in rb if x[0] == y[0] and iou(x, y) >= 0.2
    )
    used_a, used_b, want = set(), set(), set()
    for _, i, j, _ in pairs:
        if i not in used_a and j not in used_b:
            used_a.add(i), used_b.add(j)
            want.add((i, j))
    got = {(r.a_id, r.b_id) for r in greedy.iou_match(a, b, 0.2).collect()}
    assert got == want and want


@pytest.mark.parametrize("parts", [1, 7])
def test_nms_is_the_greedy_walk(spark, parts):
    rows, df = boxes(spark, 3, n=80)
    df = df.withColumn("source_rank", F.col("rect_id") % 3).repartition(parts)
    order = sorted(rows, key=lambda r: (r[2] % 3, -(r[5] - r[3]) * (r[6] - r[4]), r[2]))
    kept = []
    for r in order:
        if all(k[0] != r[0] or iou(k, r) < 0.3 for k in kept):
            kept.append(r)
    got = {r.rect_id for r in greedy.nms(df, 0.3).collect()}
    assert got == {k[2] for k in kept}
    assert len(kept) < len(rows)


def test_stacked_boxes_need_no_pairs(spark):
    df = spark.range(20_000).selectExpr("0L AS form_id", "0 AS page", "id AS rect_id", "1.0D AS x0", "1.0D AS y0", "9.0D AS x1", "9.0D AS y1", "1 AS source_rank", "0.5D AS confidence")
    flat = df.where("rect_id < 3").selectExpr("form_id", "page", "rect_id + 50000 AS rect_id", "x0", "2.0D AS y0", "x1", "2.0D AS y1", "source_rank", "confidence")
    assert sorted(r.rect_id for r in greedy.nms(df.unionByName(flat)).collect()) == [0, 50000, 50001, 50002]
    assert [r.rect_id for r in greedy.dedupe_fields(df).collect()] == [0]


def jobs_of(spark, name, run):
    """What ``run`` gives, and the number of jobs it took."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_long_chain_of_overlapping_boxes(spark):
    """Each box overlaps the next only, so the walk keeps every other one."""
    n = 2000
    df = spark.range(n).selectExpr("0L AS form_id", "0 AS page", "id AS rect_id", "id * 4.0D AS x0", "0.0D AS y0", "id * 4.0D + 10 AS x1", "10.0D AS y1", "id AS source_rank", "1 - id / 10000D AS confidence")
    kept, jobs = jobs_of(spark, "nms", lambda: sorted(r.rect_id for r in greedy.nms(df, 0.4).collect()))
    assert kept == list(range(0, n, 2)) and jobs < 300
    kept, jobs = jobs_of(spark, "dedupe", lambda: sorted(r.rect_id for r in greedy.dedupe_fields(df).collect()))
    assert kept == list(range(0, n, 2)) and jobs < 300
    shifted = df.selectExpr("form_id", "page", "rect_id", "x0 + rect_id * 0.0005 + 1.9 AS x0", "y0", "x1 + rect_id * 0.0005 + 1.9 AS x1", "y1")
    pairs = {(r.a_id, r.b_id): r.iou for r in greedy.candidate_matches(df, shifted, 0.5).collect()}
    used_a, used_b, want = set(), set(), set()
    for i, j in sorted(pairs, key=lambda p: (-pairs[p], p)):
        if i not in used_a and j not in used_b:
            used_a.add(i), used_b.add(j)
            want.add((i, j))
    got, jobs = jobs_of(spark, "match", lambda: {(r.a_id, r.b_id) for r in greedy.iou_match(df, shifted, 0.5).collect()})
    assert got == want and jobs < 300


@pytest.mark.parametrize("walked", [0, 3])
def test_components_too_large_to_walk_go_by_rounds(spark, monkeypatch, walked):
    monkeypatch.setattr(greedy, "WALKED_EDGES", walked)
    test_nms_is_the_greedy_walk(spark, 7)
    test_iou_match_is_the_greedy_walk(spark, 1)
    test_conditional_sections(spark)


def shrunk(rects, rules, height=12.0):
    """The plain walk over the pairs of one page."""
    now, out = {i: r for i, _, r in rects}, {}
    names = {i: n for i, n, _ in rects}
    ids = sorted(now)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = now[i], now[j]
            down, across = min(a[3], b[3]) - max(a[1], b[1]), min(a[2], b[2]) - max(a[0], b[0])
            if names[i] == names[j] or down < 2 or across <= 0 or down * across < 100 or abs((a[3] - a[1]) - (b[3] - b[1])) < 12:
                continue
            tall = i if a[3] - a[1] > b[3] - b[1] else j
            t, free = now[tall], []
            for x0, y0, x1, y1 in rules:
                shared = max(0.0, min(x1, t[2]) - max(x0, t[0]))
                near = x1 - x0 >= 20 and t[1] - 20 <= y0 <= t[3] + 5 and (shared >= 0.05 * (t[2] - t[0]) or shared >= 0.5 * (x1 - x0)) and x1 - x0 <= 0.5 * (t[2] - t[0])
                if near and not any(m != tall and abs(y1 - r[3]) < 2 for m, r in now.items()):
                    free.append((x0, y0, x1, y1))
            if len(free) == 1:
                x0, _, x1, y1 = free[0]
                out[tall] = now[tall] = (x0, y1 - height, x1, y1)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_ordered_shrink_is_the_walk(spark, seed):
    r = random.Random(seed)
    rects, rules = [], []
    for page in range(8):
        for i in range(r.randrange(3, 14)):
            x, y = r.randrange(0, 160, 10), r.randrange(0, 160, 6)
            rects.append((0, page, page * 100 + i, f"f{r.randrange(9)}", float(x), float(y), float(x + r.randrange(30, 200)), float(y + r.choice([8, 10, 12, 30, 40, 60]))))
        for i in range(r.randrange(2, 9)):
            x, y = r.randrange(0, 200, 10), r.randrange(0, 220, 5)
            rules.append((0, page, page * 100 + i, float(x), float(y), float(x + r.randrange(15, 80)), float(y + 1)))
    want = {}
    for page in range(8):
        want |= shrunk([(x[2], x[3], x[4:]) for x in rects if x[1] == page], [x[3:] for x in rules if x[1] == page])
    df = spark.createDataFrame(rects, "form_id int, page int, rect_id bigint, field_id string, x0 double, y0 double, x1 double, y1 double")
    lines = spark.createDataFrame(rules, "form_id int, page int, rule_id bigint, x0 double, y0 double, x1 double, y1 double")
    got = {x.rect_id: (x.x0, x.y0, x.x1, x.y1) for x in snap.shrink_tall_in_order(df, lines).collect()}
    assert got == want


def test_later_pairs_see_moved_rectangles(spark):
    """A chain of three: the first move frees the rule of the second widget."""
    rects = [(0, 0, 1, "a", 0.0, 0.0, 200.0, 50.0), (0, 0, 2, "b", 100.0, 20.0, 300.0, 32.0), (0, 0, 3, "c", 250.0, 0.0, 500.0, 60.0)]
    rules = [(0, 0, 1, 20.0, 40.0, 60.0, 41.0), (0, 0, 2, 300.0, 49.5, 360.0, 50.5)]
    df = spark.createDataFrame(rects, "form_id int, page int, rect_id bigint, field_id string, x0 double, y0 double, x1 double, y1 double")
    lines = spark.createDataFrame(rules, "form_id int, page int, rule_id bigint, x0 double, y0 double, x1 double, y1 double")
    got = {x.rect_id: (x.x0, x.y0, x.x1, x.y1) for x in snap.shrink_tall_in_order(df, lines).collect()}
    assert got == shrunk([(x[2], x[3], x[4:]) for x in rects], [x[3:] for x in rules]) and set(got) == {1, 3}
    assert [x.rect_id for x in snap.shrink_tall(df, lines).collect()] == [1]


def test_ordered_shrink_walks_many_components_a_call(spark):
    """A call per component costs more than the walk: pages mostly hold small ones."""
    rects = spark.createDataFrame([(0, 0, 1, "a", 0.0, 0.0, 200.0, 50.0)], "form_id int, page int, rect_id bigint, field_id string, x0 double, y0 double, x1 double, y1 double")
    lines = spark.createDataFrame([(0, 0, 1, 20.0, 40.0, 60.0, 41.0)], "form_id int, page int, rule_id bigint, x0 double, y0 double, x1 double, y1 double")
    plan = snap.shrink_tall_in_order(rects, lines)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan


def test_dedupe_keeps_the_most_confident(spark):
    rows = [(0, 0, 1, 0.0, 0.0, 10.0, 10.0, 0.5), (0, 0, 2, 3.0, 0.0, 13.0, 10.0, 0.9), (0, 0, 3, 6.0, 0.0, 16.0, 10.0, 0.7), (0, 0, 4, 9.0, 0.0, 19.0, 10.0, 0.6)]
    df = spark.createDataFrame(rows, BOXES + ", confidence double")
    # 2 beats 1 and 3; 4 is near 3 only, and 3 is gone
    assert sorted(r.rect_id for r in greedy.dedupe_fields(df).collect()) == [2, 4]


def test_radio_groups_follow_leaders(spark):
    r = random.Random(5)
    rows = [(0, 0, i, float(r.randrange(0, 120, 10)), float(r.randrange(0, 300, 10)), 0.0, 0.0) for i in range(50)]
    rows = [(f, p, i, x, y, x + 10, y + 10) for f, p, i, x, y, _, _ in rows]
    df = spark.createDataFrame(rows, BOXES.replace("rect_id", "box_id"))
    order = sorted(rows, key=lambda b: (b[4], b[3], b[2]))
    leader = {}
    for a in order:
        if a[2] in leader:
            continue
        leader[a[2]] = a[2]
        for b in order:
            if b[2] not in leader and abs(b[3] - a[3]) <= 30 and 0 <= b[4] - a[4] <= 60:
                leader[b[2]] = a[2]
    got = {x.box_id: x.leader_id for x in greedy.radio_groups(df).collect()}
    assert got == leader


def test_promotion_needs_an_exclusive_choice(spark):
    members = spark.createDataFrame([(0, 0, 1, 1), (0, 0, 2, 1), (0, 0, 3, 3)], "form_id int, page int, box_id int, leader_id int")
    labelled = spark.createDataFrame([(0, 0, 1, 0.0, 0.0, "Yes"), (0, 0, 2, 0.0, 20.0, "Never "), (0, 0, 3, 0.0, 40.0, "Yes")], "form_id int, page int, box_id int, x0 double, y0 double, label string")
    got = {(r.box_id, r.group_option) for r in greedy.promote_groups(members, labelled).collect()}
    assert got == {(1, "yes"), (2, "never")}


def test_drawn_tables(spark):
    rows = [(0, 0, 10 * k + j, x, 100.0 + 20 * k, x + w, 100.0 + 20 * k) for k in range(3) for j, (x, w) in enumerate(((50.0, 40.0), (100.0, 120.0)))]
    rules = spark.createDataFrame(rows, BOXES.replace("rect_id", "rule_id"))
    cells = sorted((r.x0, r.y0, r.y1) for r in greedy.drawn_tables(rules).collect())
    assert cells == [(100.0, 100.0, 120.0), (100.0, 120.0, 140.0)]


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "u int, v int")
    got = {r.node: r.root for r in greedy.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def claims(ids):
    sections = {}
    for p in ids:
        base = p[: -len("_enabler")] if p.endswith("_enabler") else None
        kids = {f for f in ids if f.startswith(p + "_") and not f.endswith("_enabler")}
        if base:
            kids |= {f for f in ids if f.startswith(base + "_") and not f.endswith("_enabler")} - {base}
        kids.discard(p)
        if len(kids) >= 2:
            sections[p] = kids
    out, seen = set(), set()
    for p in sorted(sections, key=lambda p: (len(p), p), reverse=True):
        kids = sections[p] - seen
        if len(kids) >= 2:
            out |= {(p, k) for k in kids}
            seen |= kids
    return out


def test_conditional_sections(spark):
    ids = ["a", "a_b", "a_b_c", "a_b_d", "a_e", "a_f", "g", "g_h", "k_enabler", "k_one", "k_two", "k", "a_b_c_x"]
    df = spark.createDataFrame([("F", i) for i in ids], "form_id string, field_id string")
    got = {(r.gate, r.child) for r in naming.conditional_sections(df).collect()}
    assert got == claims(ids)


def test_ranks_and_running_values_across_slices(spark):
    n = 9000
    df = spark.range(n).select(F.lit("k").alias("key"), (F.col("id") * 7919 % n).alias("v"))
    ranked = ranking.rank_in_groups(df, ["key"], [F.col("v")], [F.floor(F.col("v") / 100)])
    assert ranked.where("rank <> v + 1").count() == 0
    summed = ranking.running(ranked, ["key"], F.lit(1), "upto")
    assert summed.where("upto <> rank").count() == 0
    top = ranking.running(ranked, ["key"], F.col("v"), "before", how="max", exclusive=True)
    assert top.where("rank > 1 AND before <> v - 1").count() == 0
    w = ranking.block_window(["key"])
    near = ranking.neighbours(ranked, ["key"], {"p": F.lag("v").over(w), "n": F.lead("v", 2).over(w)}, behind=1, ahead=2)
    assert near.count() == n
    assert near.where("coalesce(p, -1) <> v - 1 OR coalesce(n, v + 2) <> v + 2").count() == 0


def test_improvement_status(spark):
    def status(*counts):
        df = spark.createDataFrame([("f", i, c) for i, c in enumerate(counts)], "form_id string, iter int, issues bigint")
        r = reports.improvement_status(df, threshold=3, regression=5).collect()[0]
        return r.status, r.final_issues

    assert status(2) == ("converged", 2)
    assert status(20, 10, 3) == ("converged", 3)
    assert status(20, 10, 16) == ("rollback", 10)
    assert status(20, 20, 19, 4, 1) == ("needs_review", 20)
    assert status(20, 10, 9) == ("needs_review", 10)
