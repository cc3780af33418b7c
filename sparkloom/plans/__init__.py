"""Named queries over the driver tables and the SQL that checks them."""

from __future__ import annotations

from . import aggregates, names, pages, rules, scores, tabular  # noqa: F401  they register their queries
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
