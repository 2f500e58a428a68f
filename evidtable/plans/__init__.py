"""Registered queries and their SQL."""

from __future__ import annotations

from . import assembly, corpus, documents, measurements

_PARTS = (measurements, corpus, documents, assembly)


def queries() -> dict:
    return {name: f for part in _PARTS for name, f in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.SQL.items()}
