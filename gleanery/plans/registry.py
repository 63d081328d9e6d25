"""The registered queries and their SQL; importing the plan modules fills both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with the SQL of the same result."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


from gleanery.plans import accounts, catalogue, costing, discovery, feeds, followups, intake, keeping, ledger, listings, merging, registering, state, texts, upkeep  # noqa: E402, F401
