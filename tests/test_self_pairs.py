"""Pairs of a table with itself, and matches at several thresholds."""

import random

import pytest
from pyspark.sql import functions as F

from formloom.operators import greedy
from formloom.operators.pairs import Reach, page_pairs, page_pairs_within


def boxes(spark, n=300, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y = rng.choice([0, 64, 253.5, 256, 500]) + rng.randrange(12), rng.choice([0, 62, 64, 128, 700]) + rng.randrange(9)
        rows.append((i % 3, i % 2, i, float(x), float(y), float(x + rng.randrange(250)), float(y + rng.randrange(20))))
    return spark.createDataFrame(rows, "form_id long, page int, rect_id long, x0 double, y0 double, x1 double, y1 double")


def near(tolerance):
    return (F.abs(F.col("x0") - F.col("r_x0")) < tolerance) & (F.abs(F.col("y0") - F.col("r_y0")) < tolerance)


@pytest.mark.parametrize("reach, corners", [(0.0, False), (5.0, False), (5.0, True), (300.0, False)])
def test_pairs_within_are_page_pairs(spark, reach, corners):
    df = boxes(spark)
    touching = F.col("rect_id") < F.col("r_rect_id")
    predicate = touching & (near(reach) if corners else (F.col("x0") - reach <= F.col("r_x1")) & (F.col("r_x0") - reach <= F.col("x1")) & (F.col("y0") - reach <= F.col("r_y1")) & (F.col("r_y0") - reach <= F.col("y1")))
    other = F.broadcast(df.select([F.col(c).alias("r_" + c) for c in df.columns]))
    want = df.join(other, (F.col("form_id") == F.col("r_form_id")) & (F.col("page") == F.col("r_page")) & predicate)
    found = page_pairs_within(df, predicate, reach, corners=corners)
    rows = lambda d: sorted((r.rect_id, r.r_rect_id) for r in d.collect())
    assert rows(found) == rows(want) == rows(page_pairs(df, df, predicate, reach=Reach.all_round(reach))) and rows(want)


def test_self_pairs_are_shuffled_once(spark):
    mode = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = greedy._conflicts(boxes(spark), "rect_id", (), near(5.0), Reach.all_round(5.0), corners=True)
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", mode)
    assert "ReusedExchange" in plan


def test_candidates_are_looked_for_once(spark, monkeypatch):
    a, b, calls = boxes(spark), boxes(spark, seed=4), []
    want = {t: sorted(map(tuple, greedy.iou_match(a, b, t).collect())) for t in (0.3, 0.5)}
    monkeypatch.setattr(greedy, "page_pairs", lambda *p, **k: calls.append(1) or page_pairs(*p, **k))
    found = greedy.iou_matches(a, b, (0.3, 0.5))
    assert {t: sorted(map(tuple, d.collect())) for t, d in found.items()} == want and len(calls) == 1


def test_a_round_of_matches_deals_pairs_three_times(spark, monkeypatch):
    plans = []
    cut = greedy.cut_lineage
    monkeypatch.setattr(greedy, "cut_lineage", lambda d: plans.append(d._jdf.queryExecution().sparkPlan().toString()) or cut(d))
    pairs = cut(greedy.candidate_matches(boxes(spark), boxes(spark, seed=4), 0.3))
    greedy.match_pairs(pairs)
    ends = [line.split("windowspecdefinition(")[1].split(",")[2].split("#")[0].strip() for line in plans[0].splitlines() if "Window [" in line]
    assert ends[::-1] == ["a_id", "b_id", "b_id", "a_id"] or ends == ["a_id", "b_id", "b_id", "a_id"], ends
