"""The queries of the engine's operators, each with its SQL where SQL can express it."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("scalars", "documents", "keys", "figures", "runs")


def _modules() -> list:
    return [importlib.import_module(f"scriptorium.plans.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: _counts_as_bigint(v) for m in _modules() for k, v in m.SQL.items()}


def _counts_as_bigint(sql: str) -> str:
    """DuckDB's conditional counts are wider than Spark's: each is cast to the same type."""
    out, at = "", 0
    while (start := sql.find("count_if(", at)) >= 0:
        depth, end = 1, start + len("count_if(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        out += sql[at:start] + f"CAST({sql[start:end]} AS BIGINT)"
        at = end
    return out + sql[at:]
