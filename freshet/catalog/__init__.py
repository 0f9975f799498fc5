"""The registered queries and, for each, the same result in plain SQL."""

from freshet.catalog import multi, ordered, outlets, rows, state, streams, windows

MODULES = (rows, windows, state, multi, streams, ordered, outlets)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
