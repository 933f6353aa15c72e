"""All registered queries and their oracle SQL."""

from __future__ import annotations

from skewkit.plans.batch import BATCH_QUERIES
from skewkit.plans.oracle import ORACLE_SQL
from skewkit.plans.streams import STREAM_QUERIES


def all_queries() -> dict:
    return {**BATCH_QUERIES, **STREAM_QUERIES}


def all_oracle_sql() -> dict[str, str]:
    names = all_queries()
    return {k: v for k, v in ORACLE_SQL.items() if k in names}
