"""Collects the queries of one module under their function names."""

from __future__ import annotations


class Registry:
    def __init__(self):
        self.queries: dict = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, fn, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query '{name}' is registered twice")
        self.queries[name] = fn
        if sql:
            self.oracle[name] = sql

    def query(self, sql: str | None = None):
        def register(fn):
            self.add(fn.__name__, fn, sql)
            return fn

        return register
