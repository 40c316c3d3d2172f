"""Name -> query, name -> SQL."""

from __future__ import annotations

from sievework.plans import flow_queries, gate_queries, report_queries, stream_queries

MODULES = (gate_queries, flow_queries, report_queries, stream_queries)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
