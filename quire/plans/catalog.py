"""All registered queries of the library."""

from __future__ import annotations

from quire.plans import audit_plans, book_plans, campaign_plans, corpus_plans, edition_plans, keeping_plans, outcome_plans, relation_plans, text_plans, tracker_plans, verdict_plans  # noqa: F401  they register themselves
from quire.plans.registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
