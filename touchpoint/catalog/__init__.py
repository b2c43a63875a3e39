"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

from touchpoint.catalog.registry import ORACLES, QUERIES, Query

MODULES = (
    "sources", "sinks", "projections", "filters", "joins", "aggregates", "windows", "ordering", "scalars", "streams",
    "enrichment", "jobs",
)


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"touchpoint.catalog.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
