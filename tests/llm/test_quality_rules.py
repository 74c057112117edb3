"""The decision list: statistics against a plain count, learning on planted rows."""

import random
import re
from collections import Counter

from edge import DOCS, docs

from formloom.llm import decision_list
from formloom.llm.decision_list import Condition


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed)


def test_statistics_are_the_plain_counts(spark):
    rng = random.Random(4)
    gaps = [" ", "  ", "\t", "\n", "\n\n", "\r\n", "\x0b", " ", " "]
    texts = ["".join(rng.choice(["a", "b", "cc", "ñ#", "🙂", "x|y", "<b>"]) + rng.choice(gaps) for _ in range(rng.randrange(200))) for _ in range(120)]
    texts += [t for _, t in DOCS] + ["a b c", "a b c a b c", "a a a a", " \n x\n x\nx", "\n"]
    got = decision_list.judge(docs(spark, list(enumerate(texts))), []).collect()
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row)[1:7] == plain(texts[row.doc_id]), texts[row.doc_id]
        assert row.kept is (not row.base_failed)


def planted(spark, n=900):
    """Good prose; bad rows full of signs, or in capitals where words are long."""
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(n):
        kind = rng.choice(["good", "good", "good", "signs", "capitals"])
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(60, 90))]
        if kind == "signs":
            words = [w + rng.choice("#$%") if rng.random() < 0.4 else w for w in words]
        if kind == "capitals":
            words = [w.upper() for w in words]
        rows.append((i, " ".join(words)))
        marks.append((i, int(kind == "good")))
    return docs(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int"), dict(marks)


def test_rules_are_learnt_and_hold_on_other_rows(spark):
    texts, labels, marks = planted(spark)
    rules = decision_list.learn(texts, labels)
    assert {c.feature for r in rules for c in r} >= {"symbols_per_word", "upper_per_char"}
    judged = decision_list.judge(texts, rules).collect()
    assert sum(r.kept == bool(marks[r.doc_id]) for r in judged) >= 0.98 * len(judged)


def test_the_first_rule_that_holds_decides(spark):
    rules = [(Condition("words", True, 70.0), Condition("symbols_per_word", True, 0.5)), (Condition("upper_per_char", True, 0.9),)]
    texts = ["word# " * 3 + " ".join(f"a{i}#" for i in range(80)), " ".join(f"b{i}" for i in range(80)), " ".join(f"CA{'A' * i}" for i in range(60))]
    kept = {r.doc_id: r.kept for r in decision_list.judge(docs(spark, list(enumerate(texts))), rules).collect()}
    assert kept == {0: False, 1: True, 2: False}


def test_no_labels_no_rows_and_odd_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(None, 0), (1, None), (4, 7), (99, 0)], "doc_id long, quality int")
    for labels in (none, odd):
        rows = decision_list.quality_rules(docs(spark), labels).collect()
        assert len(rows) == len(DOCS) and all(r.kept is (not r.base_failed) for r in rows)
    assert decision_list.quality_rules(docs(spark, []), none).count() == 0


def test_only_built_in_functions(spark):
    texts, labels, _ = planted(spark, 60)
    plan = decision_list.quality_rules(texts, labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("ArrowEvalPython", "Python")) and "Exchange" not in plan
