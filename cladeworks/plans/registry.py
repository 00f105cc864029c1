"""Named queries of the engine and the SQL that each must agree with."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLES[name] = sql


from . import decision_queries, marker_queries  # noqa: E402, F401  they register themselves
