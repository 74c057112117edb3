"""What the checks of answers do to a row, and how often."""

import re

import pytest
from paths import SMALL
from pyspark.sql import functions as F

from formloom.operators.reports import slot_parts
from formloom.plans import registry

registry.load()

MIDDLE = r"^([a-z]+(?:_[a-z0-9]+)*?)_(\d+)_([a-z]+(?:_[a-z]+)*)\n?\Z"
END = r"^([a-z]+(?:_[a-z0-9]+)*?)_([a-z]+)_(\d+)\n?\Z"
BARE = r"^([a-z]+(?:_[a-z]+)*?)_(\d+)\n?\Z"


def parts(name):
    if m := re.match(MIDDLE, name):
        return m[1], m[2], m[3]
    if m := re.match(END, name):
        return m[1], m[3], m[2]
    if m := re.match(BARE, name):
        return m[1], m[2], "value"
    return None


def optimized(spark, name):
    return registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_slot_parts_of_one_match(spark):
    names = ["heir_2_name", "heir_name_2", "heir_2", "a_b2_3_c_d", "a_b_4\n", "a_1_b\n", "a_1\n\n", "A_1", "x", "", "_1", "a__1", "a_1_", "a_b_c_12", "a_1_2_b", "a_1_2", "\x01", "a\x01_1", "a_99999999999"]
    found = spark.createDataFrame([(n,) for n in names], "name string").select("name", slot_parts(F.col("name")).alias("s")).collect()
    for r in found:
        want = parts(r["name"])
        got = r.s and (r.s.entity, r.s.idx, r.s.attr)
        assert got == (want and (want[0], int(want[1]) if int(want[1]) < 1 << 31 else None, want[2])), r


@pytest.mark.parametrize("name", ["cross_section_dedupe", "nonempty_if_desc", "duplicate_in_group"])
def test_names_are_matched_once_and_not_below_the_sums(spark, name):
    plan = optimized(spark, name)
    sides = sum("Generate inline(" in line and "entity" in line for line in plan)
    matched = [line for line in plan if r"_(\d+)_([a-z]" in line]
    assert sides and len(matched) == sides and all(line.count(r"_(\d+)_([a-z]") == 1 for line in matched)
    assert not any("Filter" in line for line in matched)


def test_amounts_of_a_recompute_are_read_once_a_record(spark):
    plan = optimized(spark, "validate_recompute")
    assert 0 < sum(line.count("regexp_replace") for line in plan) <= 16
    assert not any("regexp_replace" in line for line in plan if "Generate explode" in line)
