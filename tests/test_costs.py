"""What the plans of queries leave out, since it grew too large."""

import pytest

from formloom.plans import registry

registry.load()
SMALL = "/root/testdata/sf0.001"


def plan(spark, name):
    return registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_names_of_answers_are_read_once(spark):
    found = plan(spark, "nonempty_if_desc")  # F9
    assert "Join" not in found and "Window" in found


def test_facts_of_a_step_are_merged_once(spark):
    assert plan(spark, "expand_lifecycle").count("map_filter(") <= 20  # F14


def test_old_and_new_places_meet_in_one_join(spark):
    assert plan(spark, "blank_snap").count("Join") <= 2  # F18


@pytest.mark.parametrize("name", ["snap_to_rule", "drift_stats"])
def test_order_of_nearest_rules_is_not_shuffled_twice(spark, name):
    assert "min_by(" not in plan(spark, name)  # F21, F25


def test_columns_are_found_by_left_edges(spark):
    assert "r_right" in plan(spark, "equal_columns")  # F26


def test_short_rules_of_tall_widgets_are_found_once(spark):
    assert plan(spark, "shrink_tall").count("Join") <= 2  # F23


def test_text_between_placeholders_is_not_joined_by_key(spark):
    found = plan(spark, "substitute_refs")  # F22
    assert found.index("Union") < found.index("Join") and "isnotnull(key" in found


def test_answers_meet_few_rules_without_a_shuffle_by_field(spark):
    found = plan(spark, "validate_by_table")  # F20
    assert found.count("strategy=broadcast") >= 3 and "_form#" in found and "RepartitionByExpression" in found
