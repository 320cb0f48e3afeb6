"""Registered reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.operators import report
from opsframe.plans.domains import (
    AS_OF, AS_OF_SQL, PIPELINES_SQL, RUNS_SQL, TABLES_SQL, pipeline_settings, runs, table, tables,
)
from opsframe.plans.registering import Registry

REGISTRY = Registry()
_query = REGISTRY.query

_WINDOW = f"start_time >= {AS_OF_SQL} - INTERVAL 20 DAY"


@_query(f"WITH {PIPELINES_SQL} SELECT environment, count(*) AS n FROM pipelines GROUP BY environment")
def count_by_environment(spark, sf_dir):
    return report.count_by(pipeline_settings(spark, sf_dir), "environment")


@_query(f"WITH {PIPELINES_SQL} SELECT count(*) AS n FROM pipelines WHERE is_active")
def count_active(spark, sf_dir):
    return report.count_where(pipeline_settings(spark, sf_dir), F.col("is_active"))


@_query(f"""WITH {TABLES_SQL} SELECT pipeline_id, table_type, count(*) AS n FROM tables
GROUP BY pipeline_id, table_type""")
def count_tables(spark, sf_dir):
    return report.count_by(tables(spark, sf_dir), "pipeline_id", "table_type")


@_query(f"""WITH {RUNS_SQL} SELECT pipeline_id, status, count(*) AS n FROM runs
GROUP BY pipeline_id, status""")
def count_runs(spark, sf_dir):
    return report.count_by(runs(spark, sf_dir), "pipeline_id", "status")


@_query(f"""WITH {RUNS_SQL}
SELECT pipeline_id, count(*) AS total_runs,
  round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 6) AS success_rate,
  round(sum(coalesce(duration_seconds, 0)) / count(*), 6) AS avg_duration_seconds
FROM runs WHERE {_WINDOW} GROUP BY pipeline_id""")
def run_stats(spark, sf_dir):
    return _rounded(report.run_stats(runs(spark, sf_dir), AS_OF, 20))


@_query(f"""WITH {RUNS_SQL} SELECT pipeline_id, status, count(*) AS n FROM runs
WHERE {_WINDOW} GROUP BY pipeline_id, status""")
def status_counts(spark, sf_dir):
    return report.status_counts(runs(spark, sf_dir), AS_OF, 20)


@_query(f"""WITH {RUNS_SQL}
SELECT pipeline_id, CAST(timezone('Asia/Tokyo', timezone('UTC', start_time)) AS DATE) AS day,
  count(*) AS n
FROM runs WHERE {_WINDOW} GROUP BY 1, 2""")
def runs_by_day(spark, sf_dir):
    return report.runs_by_day(runs(spark, sf_dir), AS_OF, 20, zone="Asia/Tokyo")


@_query(f"""WITH {RUNS_SQL}, w AS (SELECT * FROM runs WHERE {_WINDOW}),
totals AS (SELECT pipeline_id, count(*) AS total_runs,
    round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 6) AS success_rate,
    round(sum(coalesce(duration_seconds, 0)) / count(*), 6) AS avg_duration_seconds
  FROM w GROUP BY pipeline_id),
parts AS (
  SELECT pipeline_id, 'status' AS kind, status AS label, count(*) AS n FROM w GROUP BY 1, 3
  UNION ALL
  SELECT pipeline_id, 'day', strftime(start_time, '%Y-%m-%d'), count(*) FROM w GROUP BY 1, 3)
SELECT pipeline_id, total_runs, success_rate, avg_duration_seconds, kind, label, n
FROM totals JOIN parts USING (pipeline_id)""")
def run_report(spark, sf_dir):
    found = _rounded(report.run_report(runs(spark, sf_dir), AS_OF, 20))
    parts = F.concat(_long("status", "status_counts"), _long("day", "runs_by_day"))
    return found.select("pipeline_id", "total_runs", "success_rate", "avg_duration_seconds",
                        F.inline(parts))


@_query(f"""WITH {TABLES_SQL} SELECT count(*) AS total_tables,
  CAST(sum(record_count) AS BIGINT) AS total_records,
  CAST(sum(size_bytes) AS BIGINT) AS total_size_bytes FROM tables""")
def table_stats(spark, sf_dir):
    return report.table_stats(tables(spark, sf_dir))


@_query(f"""WITH {TABLES_SQL} SELECT coalesce(table_type, 'unknown') AS table_type, count(*) AS n
FROM tables GROUP BY 1""")
def tables_by_type_count(spark, sf_dir):
    return report.tables_by_type_count(tables(spark, sf_dir))


@_query(f"""WITH {TABLES_SQL}, stats AS (SELECT pipeline_id, count(*) AS total_tables,
    CAST(sum(record_count) AS BIGINT) AS total_records,
    CAST(sum(size_bytes) AS BIGINT) AS total_size_bytes FROM tables GROUP BY 1),
types AS (SELECT pipeline_id, coalesce(table_type, 'unknown') AS table_type, count(*) AS n
  FROM tables GROUP BY 1, 2)
SELECT * FROM stats JOIN types USING (pipeline_id)""")
def table_report(spark, sf_dir):
    found = report.table_report(tables(spark, sf_dir), ["pipeline_id"])
    return found.select("pipeline_id", "total_tables", "total_records", "total_size_bytes",
                        F.explode("by_type").alias("table_type", "n"))


@_query(f"""WITH {RUNS_SQL}, {TABLES_SQL}, {PIPELINES_SQL},
t AS (SELECT CAST(substr(pipeline_id, 7) AS BIGINT) AS pipeline_id, count(*) AS tables,
        count(*) FILTER (is_active) AS active_tables FROM tables GROUP BY 1),
r AS (SELECT pipeline_id, count(*) AS total_runs,
        round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 6) AS success_rate,
        round(sum(coalesce(duration_seconds, 0)) / count(*), 6) AS avg_duration_seconds,
        max(start_time) AS last_start FROM runs WHERE {_WINDOW} GROUP BY 1)
SELECT p.pipeline_id, p.pipeline_name, p.environment, p.is_active,
  coalesce(tables, 0) AS tables, coalesce(active_tables, 0) AS active_tables,
  coalesce(total_runs, 0) AS total_runs, coalesce(success_rate, 0) AS success_rate,
  coalesce(avg_duration_seconds, 0) AS avg_duration_seconds, last_start
FROM pipelines p LEFT JOIN t USING (pipeline_id) LEFT JOIN r USING (pipeline_id)""")
def overview(spark, sf_dir):
    numbered = tables(spark, sf_dir).withColumn(
        "pipeline_id", F.substring("pipeline_id", 7, 10).cast("bigint"))
    return _rounded(report.overview(pipeline_settings(spark, sf_dir), numbered,
                                    runs(spark, sf_dir), AS_OF, 20))


def _lines_as_runs(spark, sf_dir):
    """An order line reads its parts and writes to its suppliers' tables; lines that repeat
    their key are one run."""
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("pipeline_id"),
    ).agg(F.collect_list("l_partkey").alias("input_tables"), F.collect_list("l_suppkey").alias("output_tables"))


_EDGES_SQL = """edges AS (
  SELECT l_orderkey AS run_id, l_linenumber AS pipeline_id, 'input' AS direction,
         l_partkey AS table_id FROM lineitem
  UNION SELECT l_orderkey, l_linenumber, 'output', l_suppkey FROM lineitem)"""


@_query(f"WITH {_EDGES_SQL} SELECT * FROM edges")
def lineage_edges(spark, sf_dir):
    return report.lineage_edges(_lines_as_runs(spark, sf_dir))


@_query(f"""WITH {TABLES_SQL}, {_EDGES_SQL},
used AS (SELECT table_id, count(*) FILTER (direction = 'input') AS readers,
           count(*) FILTER (direction = 'output') AS writers FROM edges GROUP BY 1)
SELECT table_id, table_name, coalesce(readers, 0) AS readers, coalesce(writers, 0) AS writers
FROM tables LEFT JOIN used USING (table_id)""")
def lineage_usage(spark, sf_dir):
    return report.lineage_usage(
        _lines_as_runs(spark, sf_dir), tables(spark, sf_dir).select("table_id", "table_name"))


def _long(kind, name):
    return F.transform(F.map_entries(name), lambda e: F.struct(
        F.lit(kind).alias("kind"), e["key"].alias("label"), e["value"].alias("n")))


def _rounded(df):
    return df.withColumns({
        c: F.round(c, 6) for c in ("success_rate", "avg_duration_seconds")})
