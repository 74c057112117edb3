"""Ordinary pages worked on whole give what crowded ones give by pairs."""

import random

import pytest
from pyspark.sql import functions as F

from paths import SMALL
from formloom.operators import greedy, page_walks, snap
from formloom.plans import registry

registry.load()
BOXES = "form_id string, page int, rect_id long, x0 double, y0 double, x1 double, y1 double"


def boxes(spark, seed, odd=True, n=240):
    """Small pages and a large one, stacked boxes, rows given twice; with
    ``odd`` also blank and inverted ones."""
    r, rows = random.Random(seed), []
    for i in range(n):
        x, y = r.randrange(0, 200, 5), r.randrange(0, 200, 5)
        page = ("f", 1) if i % 2 else (f"g{i % 7}", i % 3)
        rows.append((*page, i, float(x), float(y), float(x + r.randrange(10, 60)), float(y + r.randrange(8, 20))))
    rows += [(*q[:2], q[2] + 1000, *q[3:]) for q in rows[::5]] + rows[::11]
    if odd:
        rows += [("g1", 1, 5001, None, 1.0, 2.0, 3.0), ("g2", 2, 5002, float("nan"), 1.0, 2.0, 3.0), ("g3", 0, 5003, 50.0, 60.0, 40.0, 70.0)]
        rows += [(None, 1, 5005, 1.0, 1.0, 9.0, 9.0), ("g5", None, 5006, 1.0, 1.0, 9.0, 9.0), ("g6", 0, 5007, 5.0, 5.0, 5.0, 5.0), ("g6", 0, 5008, 5.0, 5.0, 5.0, 5.0)]
    return spark.createDataFrame(rows, BOXES)


def found(df):
    return sorted(map(str, map(tuple, df.collect())))


def three_ways(monkeypatch, run):
    """All pages whole, some of them, none of them; the last is how it was."""
    got = []
    for bound, at_once in ((10_000, 7), (60, 1_000_000), (0, 1_000_000)):
        monkeypatch.setattr(page_walks, "PAGE_BOXES", bound)
        monkeypatch.setattr(page_walks, "PAIRS_AT_ONCE", at_once)
        got.append(run())
    assert got[0] == got[1] == got[2] and got[0]


@pytest.mark.parametrize("seed, threshold", [(1, 0.3), (3, 1.0), (4, 0.0)])
def test_nms_of_ordinary_and_crowded_pages(spark, monkeypatch, seed, threshold):  # F3
    df = boxes(spark, seed).withColumn("source_rank", (F.col("rect_id") % 3).cast("int"))
    three_ways(monkeypatch, lambda: found(greedy.nms(df, threshold)))


@pytest.mark.parametrize("tolerance", [25.0, 0.0])
def test_dedupe_of_ordinary_and_crowded_pages(spark, monkeypatch, tolerance):  # F3
    df = boxes(spark, 5).withColumn("confidence", F.col("rect_id") % 4 / 4)
    three_ways(monkeypatch, lambda: found(greedy.dedupe_fields(df, tolerance)))


def test_ids_may_be_text(spark, monkeypatch):  # F3
    df = boxes(spark, 6).withColumn("rect_id", F.concat(F.lit("r"), "rect_id")).withColumn("source_rank", F.lit(1))
    three_ways(monkeypatch, lambda: found(greedy.nms(df, 0.2)))


@pytest.mark.parametrize("name", ["nms", "dedupe_fields"])
def test_boxes_are_shuffled_once_by_page(spark, name):  # F3
    plan = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_matches_of_ordinary_and_crowded_pages(spark, monkeypatch):  # F2
    a = boxes(spark, 7).distinct()
    b = boxes(spark, 8).distinct().withColumn("rect_id", F.col("rect_id").cast("int")).withColumn("x0", F.col("x0") + 1)
    three_ways(monkeypatch, lambda: [found(m) for m in greedy.iou_matches(a, b, (0.5, 0.1)).values()])
    assert dict(greedy.iou_matches(a, b, (0.5,))[0.5].dtypes)["b_id"] == "int"


def test_no_boxes_no_matches(spark):  # F2
    a = boxes(spark, 7)
    assert greedy.iou_match(a, a.limit(0), 0.3).count() == 0 == greedy.iou_match(a.limit(0), a, 0.3).count()


def test_matches_of_ordinary_pages_take_no_rounds(spark):  # F2
    plan = registry.QUERIES["precision_recall"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Join" not in plan and "MapInArrow" not in plan  # stored once for both thresholds
    plan = registry.QUERIES["iou_match"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_lone_rules_of_ordinary_and_crowded_pages(spark, monkeypatch):  # F4
    widgets, words = boxes(spark, 9), boxes(spark, 10)
    rules = boxes(spark, 11, odd=False, n=40).withColumn("y1", F.col("y0")).withColumn("x1", F.col("x1") + 20)
    three_ways(monkeypatch, lambda: found(snap.lone_segment_snap(widgets, rules, words, page_width=612.0)))


def test_rules_and_words_meet_widgets_after_one_shuffle(spark):  # F4
    plan = registry.QUERIES["lone_segment_snap"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("hashpartitioning(form_id") == 1
