"""Keyed operational tables (settings and run logs) as Spark DataFrames."""

from opsframe.schema import PIPELINES, RUNS, TABLES, Index, TableMeta

__all__ = ["PIPELINES", "RUNS", "TABLES", "Index", "TableMeta"]
