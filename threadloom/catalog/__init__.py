"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from importlib import import_module

MODULES = ["flatten", "ingest", "state", "enrich", "topics", "project", "jobs"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in MODULES:
        for key, value in getattr(import_module(f"threadloom.catalog.{name}"), attribute).items():
            if key in merged:
                raise ValueError(f"query {key} is registered twice")
            merged[key] = value
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("SQL")
