"""Every registered query against its SQL, on the smallest tables.  A query
without SQL has to name the walk that tests it."""

import ast
import pathlib

import pytest
from check_queries import compare, duck
from paths import SMALL

from formloom.plans import registry

registry.load()

#: Query without SQL: the test that walks a small fixture.
WALKS = {
    "iou_match": "test_iou_match_is_the_greedy_walk",
    "precision_recall": "test_match_counts",
    "match_stats": "test_match_counts",
    "nms": "test_nms_is_the_greedy_walk",
    "dedupe_fields": "test_dedupe_keeps_the_most_confident",
    "radio_groups": "test_radio_groups_follow_leaders",
    "drawn_tables": "test_drawn_tables",
    "conditional_sections": "test_conditional_sections",
    "shrink_tall_in_order": "test_ordered_shrink_is_the_walk",
    "improvement_status": "test_improvement_status",
    "html_to_text": "test_page_text",
    "wrap_lines": "test_wrap_and_address",
    "synthesize_cases": "test_made_up_cases",
    "scan_mentions": "test_surface_forms",
}
QUERIES = sorted(n for n, f in registry.QUERIES.items() if f.__module__ == registry.__name__)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.fixture(scope="module")
def tests():
    folder = pathlib.Path(__file__).parent
    return {n.name for p in folder.glob("test_*.py") for n in ast.walk(ast.parse(p.read_text())) if isinstance(n, ast.FunctionDef)}


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, con, tests):
    df = registry.QUERIES[name](spark, SMALL)
    if name in registry.ORACLES:
        rows, differences = compare(name, df, registry.ORACLES[name], con)
        assert not differences, "\n".join(differences)
    else:
        assert WALKS.get(name) in tests, f"{name} has neither SQL nor a walk"
        assert df.count() > 0 and df.columns
