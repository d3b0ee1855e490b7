"""Registry of named queries: a Spark callable and, where SQL can express
it, the independent DuckDB oracle text for the same result.

Oracle texts reference the fixture views by name; :func:`oracle_sql` prefixes
the ``WITH`` clause that defines them over the raw tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockyard.sources.fixtures import VIEWS, Fixtures, oracle_with

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}
_ORDER: list[str] = []


def query(name: str, sql: str | None = None):
    """Register ``fn(fx: Fixtures) -> DataFrame`` under ``name``."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str, tables_dir: str | None = None) -> DataFrame:
            return fn(Fixtures(spark, sf_dir, tables_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = run
        _ORDER.append(name)
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


_WORD = re.compile(r"\b(f_\w+)\b")


def _with_fixtures(body: str) -> str:
    used = [n for n in dict.fromkeys(_WORD.findall(body)) if n in VIEWS]
    head = oracle_with(used)
    body = body.strip()
    if head and body.upper().startswith("WITH "):
        # merge our CTE list with the query's own
        return head.rstrip() + ",\n" + body[5:]
    return head + body


def queries() -> dict[str, QueryFn]:
    _load()
    return {n: _QUERIES[n] for n in _ORDER}


def oracle_sql() -> dict[str, str]:
    _load()
    return {n: _with_fixtures(_ORACLE[n]) for n in _ORDER if n in _ORACLE}


def _load() -> None:
    # importing the query modules fills the registry
    from dockyard.plans import (  # noqa: F401
        q_confirm, q_outbound, q_messages, q_replies, q_inbound, q_returns)
