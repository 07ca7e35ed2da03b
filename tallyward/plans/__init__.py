"""Registered queries, grouped by subject; each module gives QUERIES and ORACLES."""

from __future__ import annotations


def _modules():
    from . import evaluations, finance, intake, records, text, votes

    return [finance, intake, votes, text, records, evaluations]


def queries() -> dict:
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
