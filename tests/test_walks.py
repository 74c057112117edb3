"""Plain walks for queries that SQL cannot state."""

import hashlib
from collections import Counter

from formloom.operators import diffs, greedy, records

BOX = "x0 double, y0 double, x1 double, y1 double"


def boxes(spark, rows):
    return spark.createDataFrame(rows, f"form_id string, page int, rect_id long, {BOX}")


def test_match_counts(spark):
    a = boxes(spark, [("f", 1, 1, 0.0, 0.0, 10.0, 10.0), ("f", 1, 2, 50.0, 0.0, 60.0, 10.0), ("g", 1, 3, 0.0, 0.0, 10.0, 10.0)])
    b = boxes(spark, [("f", 1, 7, 0.0, 0.0, 10.0, 8.0), ("f", 1, 8, 200.0, 0.0, 210.0, 10.0), ("h", 1, 9, 0.0, 0.0, 5.0, 5.0)])
    matches = greedy.iou_match(a, b, 0.3)
    stats = {r.form_id: (r.matched, r.only_a, r.only_b, r.mean_iou) for r in greedy.match_stats(a, b, matches).collect()}
    assert stats == {"f": (1, 1, 1, 0.8), "g": (0, 1, 0, None), "h": (0, 0, 1, None)}
    counts = {r.form_id: (r.truth, r.candidates, r.matched_30, r.matched_90) for r in greedy.precision_recall(a, b, {0.3: matches, 0.9: greedy.iou_match(a, b, 0.9)}).collect()}
    assert counts == {None: (3, 3, 1, 0), "f": (2, 2, 1, 0), "g": (1, 0, 0, 0), "h": (0, 1, 0, 0)}


def pick(key, n):
    return int(hashlib.sha256(key.encode()).hexdigest()[:8], 16) % n


def test_made_up_cases(spark):
    seeds = spark.createDataFrame([(i, "estate", "f") for i in range(20)], "case_id long, case_type string, form_id string")
    fields = spark.createDataFrame([("f", "sum", "currency"), ("f", "ok", "boolean"), ("f", "who", "text")], "form_id string, field_id string, data_type string")
    found = {(r.case_id, r.field_id): r.value for r in records.synthesize_cases(seeds, ["heir"], ["Ana", "Ben"], ["Reed", "Stone"], fields).collect()}
    for i in range(20):
        assert found[i, "sum"] == str(pick(f"{i}|sum", 90000) + 100)
        assert found[i, "ok"] == ("yes" if pick(f"{i}|ok", 2) == 0 else "no")
        assert found[i, "who"] == f"{['Ana', 'Ben'][pick(f'{i}|heir|first', 2)]} {['Reed', 'Stone'][pick(f'{i}|heir|last', 2)]}"
    assert Counter(k for _, k in found) == {"sum": 20, "ok": 20, "who": 20}


def test_repeated_keys_pair_up_and_null_keys_stay_alone(spark):
    keys = lambda ids: spark.createDataFrame([(i,) for i in ids], "id long")
    found = diffs.key_sets(keys([1, 2, 2, 3, None]), keys([2, 2, 4, 4, 1, None]), ["id"]).collect()
    assert Counter(map(tuple, found)) == {(1, "both"): 1, (2, "both"): 4, (3, "only_a"): 1, (4, "only_b"): 2, (None, "only_a"): 2}
