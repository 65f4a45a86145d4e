"""Named queries over the driver's tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under a name, with its SQL where SQL can express it."""

    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tessella.plans import load

    load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from tessella.plans import load

    load()
    return dict(ORACLES)
