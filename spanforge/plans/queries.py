"""All registered queries of the core."""

from __future__ import annotations

from spanforge.plans import problems, reference


def queries() -> dict:
    return problems.queries() | reference.QUERIES


def oracle_sql() -> dict[str, str]:
    return problems.oracle_sql() | reference.SQL
