"""Registered table-driven reads and writes, the job and the streamed fold."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from opsframe.operators import job, lifecycle, quality, read, report, runs as life
from opsframe.plans.domains import AS_OF, AS_OF_SQL, RUNS_SQL, TABLES_SQL, runs, table, tables
from opsframe.plans.registering import Registry
from opsframe.plans.writes import FOLD_SQL, events_as_log
from opsframe.schema import RUNS
from opsframe.session import prepare
from opsframe.sources import layout
from opsframe.sources.configured import (
    config_read as read_configured, config_write as write_configured, table_settings,
)
from opsframe.sources.storage import new_path, saved
from opsframe.streaming import fold

REGISTRY = Registry()
_query = REGISTRY.query


@_query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def config_read(spark, sf_dir):
    return read_configured(prepare(spark), {
        "table_id": "orders", "data_format": "parquet", "location": f"{sf_dir}/orders.parquet",
        "schema_definition": {"fields": [
            {"name": "o_orderkey", "type": "bigint", "nullable": False},
            {"name": "o_custkey", "type": "bigint"}, {"name": "o_totalprice", "type": "double"}]},
        "read_options": {"mergeSchema": False},
    })


@_query("SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def config_write(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    settings = {"data_format": "parquet", "location": new_path(spark, "lines"),
                "partition_columns": ["l_returnflag"], "write_options": {"compression": "zstd"}}
    write_configured(lines, settings)
    return read_configured(spark, settings)


@_query(f"""WITH {TABLES_SQL} SELECT table_id, table_name,
  CASE WHEN table_id = 7 THEN (SELECT count(*) FROM lineitem) ELSE record_count END AS record_count,
  CASE WHEN table_id = 7 THEN TIMESTAMP '2024-01-31' ELSE last_updated_data END AS last_updated_data
FROM tables""")
def write_stats(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    records = write_configured(
        lines, {"data_format": "parquet", "location": new_path(spark, "stats")})
    state = tables(spark, sf_dir).select("table_id", "table_name", "record_count", "last_updated_data")
    return job.record_write(state, 7, records, AS_OF).state


@_query("""WITH old AS (SELECT o_orderkey AS run_id, o_custkey AS t FROM orders),
new AS (SELECT l_orderkey AS run_id, l_partkey AS t, CAST(l_quantity AS BIGINT) AS n FROM lineitem),
total AS (SELECT run_id, CAST(sum(n) AS BIGINT) AS n FROM new GROUP BY 1)
SELECT e.run_id, e.t AS table_id, coalesce(total.n, 0) + 5 AS total_records_processed
FROM (SELECT run_id, t FROM old UNION SELECT run_id, t FROM new
      WHERE run_id IN (SELECT run_id FROM old)) e LEFT JOIN total USING (run_id)""")
def record_outputs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    state = orders.selectExpr("o_orderkey AS run_id", "CAST(5 AS BIGINT) AS total_records_processed")
    outputs = orders.selectExpr("o_orderkey AS run_id", "o_custkey AS table_id", "0L AS records")
    c = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS run_id", "l_partkey AS table_id", "CAST(l_quantity AS BIGINT) AS records")
    done = life.record_outputs(state, outputs, c, AS_OF, keys=["run_id"])
    return done.entries.join(done.state, "run_id").select("run_id", "table_id", "total_records_processed")


@_query("""SELECT o_custkey AS customer_id, round(sum(o_totalprice), 2) AS total_amount,
  count(*) AS transaction_count, max(o_orderdate) AS last_transaction_date,
  (SELECT count(DISTINCT o_custkey) FROM orders) AS run_records, 'success' AS run_status,
  true AS data_quality_passed
FROM orders GROUP BY 1""")
def job_run(spark, sf_dir):
    """Read by settings, check, summarize per customer, write by settings, record the run."""
    source = {"data_format": "parquet", "location": f"{sf_dir}/orders.parquet"}
    target = {"data_format": "parquet", "location": new_path(spark, "summary")}
    with job.job_run("summary", trigger_type="schedule", created_by="ops") as run:
        orders = read_configured(prepare(spark), source)
        checks = quality.dq_results(orders, [
            {"name": "keys", "measure": "null_count", "column": "o_orderkey", "max": 0},
            {"name": "prices", "measure": "negative_count", "column": "o_totalprice", "max": 0}])
        passed = quality.dq_passed(checks).first()["data_quality_passed"]
        summary = orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
            F.round(F.sum("o_totalprice"), 2).alias("total_amount"),
            F.count("*").alias("transaction_count"),
            F.max("o_orderdate").alias("last_transaction_date"))
        run.wrote("summary", write_configured(summary, target))
    row = run.run_row(spark).first()
    return read_configured(spark, target).withColumns({
        "run_records": F.lit(row["total_records_processed"]).cast("bigint"),
        "run_status": F.lit(row["status"]), "data_quality_passed": F.lit(passed)})


@_query("""SELECT 'summary' AS pipeline_id, 'running' AS status, CAST(NULL AS VARCHAR) AS error_message,
  count(*) AS records FROM orders
UNION ALL SELECT 'check', 'failed', concat(count(*), ' lines are returned'), NULL FROM lineitem
WHERE l_returnflag = 'R'""")
def job_states(spark, sf_dir):
    """A job as others see it while it runs, beside one that failed."""
    log = job.EventLog(prepare(spark), new_path(spark, "events"))
    with job.job_run("summary", log=log) as run:
        run.wrote("orders", table(spark, sf_dir, "orders").count())
        try:
            with job.job_run("check", log=log):
                returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").count()
                raise ValueError(f"{returned} lines are returned")
        except ValueError:
            pass
        seen = saved(log.runs(), "seen")
    return seen.select("pipeline_id", "status", "error_message", F.col("total_records_processed").alias("records"))


@_query("""WITH log AS (SELECT concat(user_id, '-', strftime(ts, '%Y%m%d')) AS run_id, user_id AS pipeline_id,
    event_id AS seq, ts, event_type, CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'running'
      WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' END AS status,
    CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS records FROM events)
SELECT run_id, pipeline_id, coalesce(arg_max(status, seq), 'pending') AS status, arg_min(ts, seq) AS start_time,
  arg_max(ts, seq) FILTER (status IN ('success', 'failed')) AS end_time,
  CAST(sum(records) AS BIGINT) AS total_records_processed, count(*) AS events,
  arg_min(event_type, seq) AS trigger_type, count(DISTINCT records) AS n_outputs FROM log GROUP BY 1, 2""")
def event_log(spark, sf_dir):
    """The events, appended in four parts to a log that is compacted after the first three."""
    log = job.EventLog(prepare(spark), new_path(spark, "events"))
    told = events_as_log(table(spark, sf_dir, "events"), "event_type AS trigger_type").selectExpr(
        "*", "CAST(NULL AS STRING) AS created_by", "CAST(records AS STRING) AS table_id")
    for part in range(4):
        log.append_all(told.where(F.col("seq") % 4 == part))
        if part < 3:
            log.compact()
    times = [F.col(n).cast("timestamp_ntz").alias(n) for n in ("start_time", "end_time")]
    return log.runs().select(
        "run_id", F.col("pipeline_id").cast("bigint").alias("pipeline_id"), "status", *times, "total_records_processed", "events", "trigger_type",
        F.size("output_tables").cast("bigint").alias("n_outputs"))


@_query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 100000")
def table_driven_job(spark, sf_dir):
    """Source and target are rows of a tables state; the source is kept as its row says."""
    target = new_path(spark, "large_orders")
    state = prepare(spark).createDataFrame(
        [("orders", "parquet", f"{sf_dir}/orders.parquet", True, "MEMORY_AND_DISK"),
         ("large_orders", "parquet", target, False, None)],
        "table_id string, data_format string, location string, caching_enabled boolean, cache_level string")
    orders = read_configured(spark, table_settings(state, "orders"))
    try:
        large = orders.where("o_totalprice >= 100000").select("o_orderkey", "o_custkey", "o_totalprice")
        write_configured(large, table_settings(state, "large_orders"))
    finally:
        orders.unpersist()
    return read_configured(spark, table_settings(state, "large_orders"))


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status, start_time FROM runs
WHERE start_time BETWEEN TIMESTAMP '2024-01-10 12:00:00' AND TIMESTAMP '2024-01-20'""")
def run_log_by_day(spark, sf_dir):
    path = new_path(spark, "runs")
    layout.write_run_log(runs(spark, sf_dir).select("run_id", "pipeline_id", "status", "start_time"), path)
    return layout.read_run_log(spark, path, datetime(2024, 1, 10, 12), datetime(2024, 1, 20))


_LOG_COLUMNS = ["run_id", "pipeline_id", "status", "trigger_type", "start_time", "end_time", "duration_seconds"]


@_query(f"""WITH {RUNS_SQL}, keys AS (SELECT 7 * o_orderkey AS run_id, o_custkey AS pipeline_id FROM orders
  WHERE o_orderkey <= 40 UNION SELECT event_id, user_id FROM events WHERE event_id <= 40)
SELECT keys.run_id, keys.pipeline_id, status, start_time, runs.run_id IS NOT NULL AS found
FROM keys LEFT JOIN runs ON runs.run_id = keys.run_id AND runs.pipeline_id = keys.pipeline_id""")
def listed_runs(spark, sf_dir):
    """A caller's short list of keys, some of them absent, from a log that is ordered otherwise."""
    path = new_path(spark, "runs")
    layout.write_run_log(runs(spark, sf_dir).select("run_id", "pipeline_id", "status", "start_time"), path)
    some = table(spark, sf_dir, "orders").where("o_orderkey <= 40").selectExpr("7 * o_orderkey AS run_id", "o_custkey AS pipeline_id")
    there = runs(spark, sf_dir).where("run_id <= 40").select("run_id", "pipeline_id")
    keys = [r.asDict() for r in some.unionByName(there).collect()]
    return read.get_listed(layout.open_run_log(spark, path), RUNS, keys, ["status", "start_time"])


def _log_by_day(spark, sf_dir):
    path = new_path(spark, "runs")
    log = runs(spark, sf_dir)
    layout.write_run_log(log.select(*[c for c in _LOG_COLUMNS if c in log.columns]), path)
    return layout.open_run_log(spark, path)


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status, start_time FROM runs
WHERE status = 'failed' AND start_time >= {AS_OF_SQL} - INTERVAL 96 HOUR""")
def failed_runs_by_day(spark, sf_dir):
    return read.failed_runs(_log_by_day(spark, sf_dir), AS_OF, hours=96).select(
        "run_id", "pipeline_id", "status", "start_time")


@_query(f"""WITH {RUNS_SQL} SELECT pipeline_id, count(*) AS total_runs,
  round(count(*) FILTER (status = 'success') * 100.0::DOUBLE / count(*), 6) AS success_rate
FROM runs WHERE start_time >= {AS_OF_SQL} - INTERVAL 5 DAY GROUP BY 1""")
def run_stats_by_day(spark, sf_dir):
    found = report.run_stats(_log_by_day(spark, sf_dir), AS_OF, 5)
    return found.select("pipeline_id", "total_runs", F.round("success_rate", 6).alias("success_rate"))


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status, start_time FROM runs
WHERE start_time >= {AS_OF_SQL} - INTERVAL 10 DAY""")
def purge_runs_by_day(spark, sf_dir):
    return lifecycle.purge_runs(_log_by_day(spark, sf_dir), AS_OF, 10).select(
        "run_id", "pipeline_id", "status", "start_time")


@_query(FOLD_SQL)
def fold_events_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    incoming = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
                .parquet(sf_dir))
    folder = new_path(spark, "fold")
    fold.start_fold(events_as_log(incoming), folder, ["seq"], availableNow=True).awaitTermination()
    done = fold.folded(spark, folder)
    return done.withColumn("duration_seconds", F.col("duration_seconds").cast("double"))
