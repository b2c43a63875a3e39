"""Collects the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from touchpoint.session import scratch_path, ship_package, use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_STAGED: dict[tuple[str, str, str], str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the SQL that checks it."""
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(use_utc(ship_package(spark)), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def staged(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Folder written once per session from the given tables, for queries that read files."""
    slot = (spark.sparkContext.applicationId, sf_dir, name)
    if slot not in _STAGED:
        path = scratch_path(spark, name)
        write(path)
        _STAGED[slot] = path
    return _STAGED[slot]
