"""Every registered query and its SQL twin."""

from __future__ import annotations

from opsframe.plans import jobs, reads, reports, values, writes

MODULES = (reads, reports, values, writes, jobs)


def queries() -> dict:
    return {name: fn for module in MODULES for name, fn in module.REGISTRY.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.REGISTRY.oracle.items()}
