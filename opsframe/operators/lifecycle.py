"""Archiving and purging by age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsframe.functions.predicates import literal_for, time_range, with_day
from opsframe.operators.read import _before


def _archived(s: DataFrame, old: Column, by: str | None) -> DataFrame:
    was = F.col("archived") if "archived" in s.columns else F.lit(False)
    who = F.col("archived_by") if "archived_by" in s.columns else F.lit(None).cast("string")
    old = F.coalesce(old, F.lit(False))
    return s.withColumns({
        "archived": F.coalesce(was, F.lit(False)) | old,
        "archived_by": F.when(old, F.lit(by).cast("string")).otherwise(who)})


def archive_pipelines(s: DataFrame, environment: str, as_of, days: int = 90,
                      by: str | None = None) -> DataFrame:
    """Mark the inactive pipelines of an environment last updated before the cutoff."""
    cutoff = literal_for(s, "updated_at", _before(as_of, days=days))
    old = (F.col("environment") == environment) & ~F.col("is_active") & (F.col("updated_at") < cutoff)
    return _archived(s, old, by)


def archive_tables(s: DataFrame, as_of, days: int = 30, pipeline_id=None,
                   by: str | None = None) -> DataFrame:
    """Mark the tables whose last data is older than the cutoff; never those without data."""
    cutoff = literal_for(s, "last_updated_data", _before(as_of, days=days))
    old = F.col("last_updated_data") < cutoff
    if pipeline_id is not None:
        old = old & (F.col("pipeline_id") == pipeline_id)
    return _archived(s, old, by)


def purge_runs(s: DataFrame, as_of, days: int = 90) -> DataFrame:
    """The runs to keep. On a log partitioned by day the cutoff prunes whole partitions."""
    return s.where(time_range(s, "start_time", _before(as_of, days=days)))


def purged_runs(s: DataFrame, as_of, days: int = 90) -> DataFrame:
    cutoff = _before(as_of, days=days)
    older = F.col("start_time") < literal_for(s, "start_time", cutoff)
    return s.where(with_day(older, s, "start_time", high=cutoff))
