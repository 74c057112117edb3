"""Plans hold no nested-loop or cross joins, prune columns, and spread pages."""

import re

import pytest
from pyspark.sql import functions as F

from paths import SMALL
from formloom.operators import audit, detect, snap
from formloom.operators.pairs import Reach, page_pairs
from formloom.plans import registry

registry.load()

ITERATIVE = {"iou_match", "nms", "dedupe_fields", "radio_groups", "precision_recall", "match_stats", "conditional_sections", "proximity_components", "split_groups", "shrink_tall_in_order"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith("stream_") and n not in ITERATIVE))
def test_no_nested_loops(name, spark):
    plan = plan_of(registry.QUERIES[name](spark, SMALL))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_scans_read_only_what_they_need(spark, tables):
    plan = plan_of(audit.widget_collisions(tables.rect))
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan


def test_without_broadcast_pairs_meet_on_page_and_cell(spark, tables):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(snap.nearest_rule(tables.rect, tables.rule))
        assert "_cx" in plan and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)
        assert "NestedLoop" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_crowded_page_is_spread_and_whole(spark):
    n = 3000
    df = spark.range(n).select(
        F.lit(1).alias("form_id"), F.lit(0).alias("page"), F.col("id").alias("rect_id"),
        (F.col("id") % 60 * 10.0).alias("x0"), (F.floor(F.col("id") / 60) * 15.0).alias("y0"),
    ).withColumns({"x1": F.col("x0") + 12, "y1": F.col("y0") + 10})
    b = df.select(*[F.col(c) for c in df.columns])
    pairs = page_pairs(df, b, F.col("rect_id") < F.col("r_rect_id"))
    # each box meets its right neighbour only
    assert pairs.count() == n - n // 60
    assert pairs.select("rect_id", "r_rect_id").distinct().count() == n - n // 60
    wide = page_pairs(df, b, (F.col("rect_id") < F.col("r_rect_id")) & (F.abs(F.col("r_y0") - F.col("y0")) <= 15), reach=Reach(600, 15, 600, 15))
    rows = n // 60
    assert wide.count() == rows * (60 * 59 // 2) + (rows - 1) * 60 * 60


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_results_do_not_depend_on_partitioning(spark, tables, parts):
    base = {tuple(r) for r in detect.nearest_label(tables.rect, tables.word).collect()}
    again = {tuple(r) for r in detect.nearest_label(tables.rect.repartition(parts), tables.word.repartition(parts)).collect()}
    assert again == base


def test_everything_in_one_place_stays_linear(spark):
    n = 20000
    at = lambda name, x: spark.range(n).select(
        F.lit(1).alias("form_id"), F.lit(0).alias("page"), F.col("id").alias(name), F.lit(x).alias("x0"), F.lit(100.0).alias("y0"),
        F.lit(x + 50).alias("x1"), F.lit(110.0).alias("y1"), F.lit("Label").alias("text"),
    )
    got = detect.nearest_label(at("rect_id", 100.0).drop("text"), at("line_id", 20.0))
    assert got.groupBy("label", "side", "cost").count().collect()[0]["count"] == n
    ruled = snap.nearest_rule(at("rect_id", 100.0), at("rule_id", 100.0))
    assert ruled.select("rule_id").distinct().collect()[0].rule_id == 0 and ruled.count() == n


@pytest.mark.parametrize("name", ["resolve_fields", "apply_when", "plan_coverage"])
def test_facts_are_not_broadcast(name, spark):
    """A file of customers is small, the facts and fields it gives are not; only gates (by form) may be sent to all tasks."""
    assert set(re.findall(r"BroadcastHashJoin \[(\w+)", plan_of(registry.QUERIES[name](spark, SMALL)))) <= {"form_id"}


@pytest.mark.parametrize("name", ["synthesize_cases", "expand_lifecycle"])
def test_cases_are_dealt_out_before_they_grow(name, spark):
    assert "REPARTITION_BY_NUM" in plan_of(registry.QUERIES[name](spark, SMALL))
