"""Made-up cases: an identity for every role, fields listed more than once."""

import hashlib
from collections import Counter

import pytest

from formloom.operators import records

FIRST, LAST = ["Ana", "Ben", "Cleo"], ["Reed", "Stone"]


def pick(key, bank):
    return bank[int(hashlib.sha256(key.encode()).hexdigest()[:8], 16) % len(bank)]


def seeds(spark, n=40):
    return spark.createDataFrame([(i, "estate", "fg"[i % 2]) for i in range(n)], "case_id long, case_type string, form_id string")


def fields(spark):
    rows = [("f", "who", "text", "heir"), ("f", "whose", "text", "owner"), ("f", "other", None, "clerk"), ("f", "none", "text", None), ("g", "sum", "currency", "owner")]
    return spark.createDataFrame(rows, "form_id string, field_id string, data_type string, role string")


def name(i, role):
    return f"{pick(f'{i}|{role}|first', FIRST)} {pick(f'{i}|{role}|last', LAST)}"


def test_every_role_has_its_identity(spark):  # F5
    found = records.synthesize_cases(seeds(spark), ["heir", "owner"], FIRST, LAST, fields(spark)).collect()
    values = {(r.case_id, r.field_id): r.value for r in found}
    for i in range(0, 40, 2):
        assert values[i, "who"] == values[i, "other"] == values[i, "none"] == name(i, "heir") and values[i, "whose"] == name(i, "owner")
    assert Counter(r.field_id for r in found) == {"who": 20, "whose": 20, "other": 20, "none": 20, "sum": 20}
    assert any(values[i, "who"] != values[i, "whose"] for i in range(0, 40, 2))


def test_stress_makes_long_names_and_large_amounts(spark):  # F5
    found = records.synthesize_cases(seeds(spark), ["heir", "owner"], FIRST, LAST, fields(spark), stress=True).collect()
    names = [r.value for r in found if r.field_id != "sum"]
    assert all(len(v.split(" ")) == 3 and v.count("-") == 2 for v in names)
    assert all(10_000_000 <= int(r.value) < 100_000_000 for r in found if r.field_id == "sum")


@pytest.mark.parametrize("bound", [100_000, 3])
def test_a_field_listed_many_times_gives_one_row_a_case(spark, monkeypatch, bound):  # F1
    monkeypatch.setattr(records, "BROADCAST_FIELDS", bound)
    listed = fields(spark)
    many = listed
    for _ in range(6):
        many = many.unionByName(listed)
    want = {tuple(r)[:5] for r in records.synthesize_cases(seeds(spark), ["heir", "owner"], FIRST, LAST, listed).collect()}
    found = records.synthesize_cases(seeds(spark), ["heir", "owner"], FIRST, LAST, many).collect()
    assert len(found) == len(want) == 100 and {tuple(r)[:5] for r in found} == want and {r.n_fields for r in found} == {7}
