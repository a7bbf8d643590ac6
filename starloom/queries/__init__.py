"""Registered queries over the driver tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import importlib

from starloom.session import spread

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under its own name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


# text tables, whose rows are costly to process
HEAVY = {"documents", "pages", "conversations"}


def load(spark, folder: str, name: str):
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread(table) if name in HEAVY else table


def load_all() -> None:
    for module in ("warehouse", "quality_files", "feature_tools", "retrieval_memory", "evaluation", "text_graph", "streams"):
        importlib.import_module(f"starloom.queries.{module}")
