"""All queries of the library and their SQL."""

from __future__ import annotations

from . import clean_queries, job_queries, model_queries, place_queries, shape_queries, source_queries, space_queries, table_queries

MODULES = [model_queries, clean_queries, space_queries, shape_queries, table_queries, job_queries, place_queries, source_queries]


def queries() -> dict:
    return {name: f for m in MODULES for name, (f, _) in m.Q.items()}


def oracles() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.Q.items() if sql}
