"""Registered queries: each is ``fn(spark, sf_dir) -> DataFrame`` plus, where
SQL can express it, an independent DuckDB oracle over the same tables.

Oracles are written *differently* from the Spark side where possible (a
self-join where Spark uses ``lag``, ``unnest ... with ordinality`` where Spark
uses ``posexplode``), so a shared mistake is unlikely.  Every computed column
is aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: add ``fn`` to the catalogue under ``name``."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco
