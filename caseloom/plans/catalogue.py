"""All queries of the core, and their SQL."""

from __future__ import annotations

from caseloom.plans import problem_queries, reference_queries, reference_sql

FLAGSHIP = reference_queries.fact_daily


def queries() -> dict:
    return problem_queries.QUERIES | reference_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return problem_queries.SQL | reference_sql.SQL
