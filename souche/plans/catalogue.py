"""All queries of the core, gathered from the modules that define them."""

from __future__ import annotations

from souche.plans import births, groups, links, measures, pipelines, records, relations, sheets, texts

MODULES = (groups, births, texts, relations, measures, links, pipelines, sheets, records)


def queries() -> dict:
    return {name: call for module in MODULES for name, call in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
