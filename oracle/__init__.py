"""Every query a second time as DuckDB SQL over the given tables."""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    from oracle import jobs, reports, rules, streams
    from oracle.model import with_model

    return {name: with_model(sql) for part in (reports, rules, jobs, streams) for name, sql in part.SQL.items()}
