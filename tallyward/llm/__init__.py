"""Corpus operators for training data at scale. Nothing outside this folder imports it."""

from . import queries as _q


def queries() -> dict:
    return dict(_q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_q.ORACLES)
