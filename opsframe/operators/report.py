"""Counts, run and table reports, cross-domain summaries and lineage.

Every grouping is a partial aggregate before its shuffle, so a key that holds a large
share of the rows reaches its final task as one row per input task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from opsframe.functions.predicates import col, time_range
from opsframe.functions.times import day_in_zone
from opsframe.operators.read import _before


def count_by(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    return df.groupBy(*[col(c) for c in columns]).agg(F.count("*").alias(name))


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.where(condition).agg(F.count("*").alias(name))


# -- runs -------------------------------------------------------------------------------

def _known(status: Column) -> Column:
    return F.coalesce(status, F.lit("unknown"))


def in_window(df: DataFrame, as_of, days: int, column: str = "start_time") -> DataFrame:
    return df.where(time_range(df, column, _before(as_of, days=days)))


def _measures() -> list[Column]:
    """A run without a duration counts in the average as zero."""
    total = F.count("*")
    success = F.sum(F.when(F.col("status") == "success", 1).otherwise(0))
    seconds = F.sum(F.coalesce(F.col("duration_seconds").cast("double"), F.lit(0.0)))
    empty = total == 0
    return [
        total.alias("total_runs"),
        F.when(empty, F.lit(0.0)).otherwise(success / total * 100).alias("success_rate"),
        F.when(empty, F.lit(0.0)).otherwise(seconds / total).alias("avg_duration_seconds"),
    ]


def run_stats(df: DataFrame, as_of, days: int = 30, by: Sequence[str] = ("pipeline_id",)) -> DataFrame:
    """Run count, success rate (0-100) and mean duration per pipeline."""
    return in_window(df, as_of, days).groupBy(*by).agg(*_measures())


def status_counts(df: DataFrame, as_of, days: int = 30,
                  by: Sequence[str] = ("pipeline_id",)) -> DataFrame:
    runs = in_window(df, as_of, days).withColumn("status", _known(F.col("status")))
    return count_by(runs, *by, "status")


def runs_by_day(df: DataFrame, as_of, days: int = 30, zone: str | None = None,
                by: Sequence[str] = ("pipeline_id",)) -> DataFrame:
    """Runs per day of the display zone."""
    runs = in_window(df, as_of, days).withColumn("day", day_in_zone(F.col("start_time"), zone))
    return count_by(runs, *by, "day")


def run_report(df: DataFrame, as_of, days: int = 30, zone: str | None = None,
               by: Sequence[str] = ("pipeline_id",)) -> DataFrame:
    """The whole run report, breakdowns as maps, in one pass over the runs.

    Runs are reduced to one row per (key, day, status) and those rows to the report. The
    window has no upper end, so days after ``as_of`` are in it. Statuses are reported as
    they are, a null one as ``unknown``. With no ``by`` the report is one row, with zeros
    and empty maps when nothing ran.
    """
    cells = (
        in_window(df, as_of, days)
        .withColumns({"status": _known(F.col("status")), "day": day_in_zone(F.col("start_time"), zone).cast("string")})
        .groupBy(*by, "day", "status")
        .agg(F.count("*").alias("n"),
             F.sum(F.coalesce(F.col("duration_seconds").cast("double"), F.lit(0.0))).alias("seconds"))
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    success = F.coalesce(F.sum(F.when(F.col("status") == "success", F.col("n"))), F.lit(0))
    found = cells.groupBy(*by).agg(
        total.alias("total_runs"),
        F.when(total == 0, F.lit(0.0)).otherwise(success / total * 100).alias("success_rate"),
        F.when(total == 0, F.lit(0.0)).otherwise(F.sum("seconds") / total).alias("avg_duration_seconds"),
        F.collect_list(F.struct("day", "status", "n")).alias("_cells"),
    )

    def summed(field: str) -> Column:
        labels = F.array_sort(F.array_distinct(F.transform("_cells", lambda c: c[field])))
        return F.map_from_arrays(labels, F.transform(labels, lambda label: F.aggregate(
            F.filter("_cells", lambda c: c[field] == label), F.lit(0).cast("bigint"), lambda n, c: n + c["n"])))

    return found.withColumns({"status_counts": summed("status"), "runs_by_day": summed("day")}).drop("_cells")


# -- tables -----------------------------------------------------------------------------

def table_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("total_tables"),
        F.coalesce(F.sum("record_count"), F.lit(0)).cast("bigint").alias("total_records"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total_size_bytes"),
    )


def tables_by_type_count(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return count_by(df.withColumn("table_type", _known(F.col("table_type"))), *by, "table_type")


def table_report(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The table report with its type breakdown as a map with an entry for each type.

    Tables are read once and reduced to one row per (key, type) before the report.
    """
    per_type = table_stats(df.withColumn("table_type", _known(F.col("table_type"))), [*by, "table_type"])
    return per_type.groupBy(*by).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n)
          for n in ("total_tables", "total_records", "total_size_bytes")],
        F.map_from_entries(F.collect_list(F.struct("table_type", "total_tables"))).alias("by_type"))


# -- across domains ---------------------------------------------------------------------

def overview(pipelines: DataFrame, tables: DataFrame, runs: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Each pipeline with its table and run figures; both sides are aggregated first."""
    per_table = tables.groupBy("pipeline_id").agg(
        F.count("*").alias("tables"),
        F.sum(F.when(F.col("is_active"), 1).otherwise(0)).alias("active_tables"))
    per_run = in_window(runs, as_of, days).groupBy("pipeline_id").agg(
        *_measures(), F.max("start_time").alias("last_start"))
    joined = pipelines.join(per_table, "pipeline_id", "left").join(per_run, "pipeline_id", "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.lit(0)) for c in ("tables", "active_tables", "total_runs")
    } | {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("success_rate", "avg_duration_seconds")})


def lineage_edges(runs: DataFrame, keys: Sequence[str] = ("run_id", "pipeline_id")) -> DataFrame:
    """One row per run, direction and table id, read from the two id lists of a run.

    Runs are unique by their key, so an id that repeats does so within its row, where it is
    dropped; no edge is shuffled.
    """
    def tagged(name: str, direction: str) -> Column:
        return F.transform(
            F.coalesce(col(name), F.array()),
            lambda t: F.struct(F.lit(direction).alias("direction"), t.alias("table_id")))

    both = F.concat(tagged("input_tables", "input"), tagged("output_tables", "output"))
    return runs.select(*keys, F.inline(F.array_distinct(both)))


def lineage_usage(runs: DataFrame, tables: DataFrame,
                  keys: Sequence[str] = ("run_id", "pipeline_id")) -> DataFrame:
    """Readers and writers of every known table, counted before the join."""
    used = lineage_edges(runs, keys).groupBy("table_id").agg(
        F.sum(F.when(F.col("direction") == "input", 1).otherwise(0)).alias("readers"),
        F.sum(F.when(F.col("direction") == "output", 1).otherwise(0)).alias("writers"))
    return tables.join(used, "table_id", "left").withColumns({
        c: F.coalesce(F.col(c), F.lit(0)) for c in ("readers", "writers")})
