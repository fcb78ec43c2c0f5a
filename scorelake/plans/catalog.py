"""All registered queries."""

from __future__ import annotations

from scorelake.plans import queries_model, queries_monitor, queries_rows, queries_tables  # noqa: F401
from scorelake.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracles():
    return dict(ORACLES)
