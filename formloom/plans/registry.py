"""Where queries and their oracle SQL are collected."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from formloom.sources.testdata import Tables, oracle

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = (
    "layout",
    "joins",
    "snapping",
    "matching",
    "sequences",
    "reports",
    "scalars",
    "records",
    "validation",
    "routing",
    "citations",
    "logs",
    "exports",
)


def query(name: str | None = None, uses: str = "", sql: str | None = None):
    """Register a function of ``Tables``; ``sql`` is the DuckDB body over the
    derived tables named in ``uses``."""

    def wrap(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = oracle(uses, sql)
        return build

    return wrap


def load() -> None:
    for module in MODULES:
        try:
            importlib.import_module(f"formloom.plans.{module}")
        except ModuleNotFoundError as missing:
            if missing.name != f"formloom.plans.{module}":
                raise
