"""Registered reads: lookups, index queries, paging, projections, predicates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from opsframe.functions import times
from opsframe.functions.predicates import key_condition, match_all
from opsframe.operators import read
from opsframe.plans.domains import (
    AS_OF, AS_OF_SQL, PIPELINES_SQL, RUNS_SQL, TABLES_SQL, pipeline_settings, pipelines, runs,
    table, tables,
)
from opsframe.plans.registering import Registry
from opsframe.schema import Index, PIPELINES, RUNS, TABLES, TableMeta

REGISTRY = Registry()
_query = REGISTRY.query

_RUN_LIST = ("run_id, pipeline_id, status, start_time, end_time, duration_seconds, "
             "created_at, updated_at")
_TABLE_LIST = "table_id, pipeline_id, table_name, table_type, data_format, is_active"
_PIPELINE_LIST = "pipeline_id, pipeline_name, is_active, environment, created_at, updated_at"

_DAY_20 = datetime(2024, 1, 20)
_DAY_25 = datetime(2024, 1, 25)


# -- scans and lookups ------------------------------------------------------------------

@_query(f"WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs ORDER BY run_id, pipeline_id LIMIT 100")
def scan_page(spark, sf_dir):
    return read.scan_page(runs(spark, sf_dir), RUNS)


@_query("SELECT * FROM events")
def full_scan(spark, sf_dir):
    return table(spark, sf_dir, "events")


@_query(f"""WITH {PIPELINES_SQL}, wanted AS (SELECT DISTINCT l_partkey AS pipeline_id FROM lineitem)
SELECT w.pipeline_id, p.pipeline_name, p.is_active, p.environment, p.created_at, p.updated_at,
       p.pipeline_id IS NOT NULL AS found
FROM wanted w LEFT JOIN pipelines p ON p.pipeline_id = w.pipeline_id""")
def batch_get(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("pipeline_id"))
    return read.get_many(pipelines(spark, sf_dir), PIPELINES, keys)


@_query(f"""WITH {PIPELINES_SQL} SELECT DISTINCT l_partkey AS pipeline_id FROM lineitem
WHERE l_partkey NOT IN (SELECT pipeline_id FROM pipelines)""")
def missing_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("pipeline_id"))
    return read.missing_keys(pipeline_settings(spark, sf_dir), PIPELINES, keys)


@_query(f"""WITH {PIPELINES_SQL} SELECT pipeline_id FROM pipelines
WHERE pipeline_id IN (SELECT user_id FROM events)""")
def existing_keys(spark, sf_dir):
    keys = table(spark, sf_dir, "events").select(F.col("user_id").alias("pipeline_id"))
    return read.existing_keys(pipeline_settings(spark, sf_dir), PIPELINES, keys)


# Order lines as a table of their own, keyed by order and line.
_LINES = TableMeta("order_lines", ("l_orderkey", "l_linenumber"), {},
                   (Index("ShippedIndex", "l_returnflag", "l_shipdate"),))


@_query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 5979")
def query_by_pk(spark, sf_dir):
    return read.query_by_pk(table(spark, sf_dir, "lineitem"), _LINES, 5979,
                            columns=["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])


# -- index queries ----------------------------------------------------------------------

@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs
WHERE status = 'failed' AND start_time BETWEEN TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-25'
  AND pipeline_id IS NOT NULL""")
def index_query(spark, sf_dir):
    return read.index_query(runs(spark, sf_dir), RUNS, "StatusRunsIndex", "failed", op="between",
                            low=_DAY_20, high=_DAY_25, columns=RUNS.list_columns, ascending=False)


@_query(f"WITH {PIPELINES_SQL} SELECT {_PIPELINE_LIST} FROM pipelines WHERE is_active")
def active_pipelines(spark, sf_dir):
    return read.active_pipelines(pipelines(spark, sf_dir))


@_query(f"WITH {PIPELINES_SQL} SELECT {_PIPELINE_LIST} FROM pipelines WHERE environment = 'MACHINERY'")
def by_environment(spark, sf_dir):
    return read.pipelines_by_environment(pipelines(spark, sf_dir), "MACHINERY")


@_query(f"""WITH {PIPELINES_SQL} SELECT {_PIPELINE_LIST} FROM pipelines
WHERE environment = 'MACHINERY' AND is_active
ORDER BY created_at DESC, pipeline_id LIMIT 25""")
def by_env_status(spark, sf_dir):
    return read.pipelines_by_environment(pipelines(spark, sf_dir), "MACHINERY", True, limit=25)


@_query(f"""WITH {PIPELINES_SQL}, examined AS (
  SELECT * FROM pipelines WHERE environment = 'MACHINERY'
  ORDER BY created_at DESC, pipeline_id LIMIT 25)
SELECT {_PIPELINE_LIST} FROM examined WHERE is_active""")
def limit_then_filter(spark, sf_dir):
    return read.pipelines_by_environment(pipelines(spark, sf_dir), "MACHINERY", True, limit=25,
                                         limit_first=True)


@_query(f"""WITH {TABLES_SQL} SELECT {_TABLE_LIST} FROM tables
WHERE pipeline_id = 'Brand#7' AND table_type IS NOT NULL""")
def tables_by_pipeline(spark, sf_dir):
    return read.tables_by_pipeline(tables(spark, sf_dir), "Brand#7")


@_query(f"WITH {TABLES_SQL} SELECT {_TABLE_LIST} FROM tables WHERE table_type = 'lookup'")
def tables_by_type(spark, sf_dir):
    return read.tables_by_type(tables(spark, sf_dir), "lookup")


@_query(f"""WITH {TABLES_SQL} SELECT {_TABLE_LIST} FROM tables
WHERE pipeline_id = 'Brand#7' AND table_type IS NOT NULL AND is_active""")
def active_tables(spark, sf_dir):
    return read.active_tables(tables(spark, sf_dir), "Brand#7")


@_query(f"""WITH {TABLES_SQL} SELECT {_TABLE_LIST} FROM tables
WHERE pipeline_id = 'Brand#7' AND table_type = 'source'""")
def source_tables(spark, sf_dir):
    return read.source_tables(tables(spark, sf_dir), "Brand#7")


@_query(f"""WITH {TABLES_SQL} SELECT {_TABLE_LIST} FROM tables
WHERE pipeline_id = 'Brand#7' AND table_type = 'destination'""")
def destination_tables(spark, sf_dir):
    return read.destination_tables(tables(spark, sf_dir), "Brand#7")


@_query(f"WITH {TABLES_SQL} SELECT {_TABLE_LIST} FROM tables WHERE data_format = 'csv'")
def tables_by_format(spark, sf_dir):
    return read.tables_by_format(tables(spark, sf_dir), "csv")


@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs
WHERE pipeline_id = 8 AND start_time >= TIMESTAMP '2024-01-20'""")
def runs_by_pipeline(spark, sf_dir):
    return read.runs_by_pipeline(runs(spark, sf_dir), 8, start=_DAY_20)


@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs
WHERE status = 'skipped' AND start_time <= TIMESTAMP '2024-01-25'""")
def runs_by_status(spark, sf_dir):
    return read.runs_by_status(runs(spark, sf_dir), "skipped", end=_DAY_25)


@_query(f"WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs WHERE status = 'running'")
def running_runs(spark, sf_dir):
    return read.running_runs(runs(spark, sf_dir))


@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs
WHERE status = 'failed' AND start_time >= {AS_OF_SQL} - INTERVAL 72 HOUR""")
def failed_runs(spark, sf_dir):
    return read.failed_runs(runs(spark, sf_dir), AS_OF, hours=72)


@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs
WHERE pipeline_id = 8 AND start_time >= {AS_OF_SQL} - INTERVAL 240 HOUR""")
def recent_runs(spark, sf_dir):
    return read.recent_runs(runs(spark, sf_dir), 8, AS_OF, hours=240)


@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs
ORDER BY start_time DESC, run_id, pipeline_id LIMIT 50""")
def newest_runs(spark, sf_dir):
    return read.query(runs(spark, sf_dir), RUNS, sort="start_time", ascending=False, limit=50,
                      columns=RUNS.list_columns)


@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST} FROM runs
WHERE status = 'success' AND start_time >= {AS_OF_SQL} - INTERVAL 7 DAY""")
def successful_runs(spark, sf_dir):
    return read.successful_runs(runs(spark, sf_dir), AS_OF, days=7)


@_query("""SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate > TIMESTAMP '1999-06-01'""")
def composite_range(spark, sf_dir):
    return read.composite_range(
        table(spark, sf_dir, "lineitem"), _LINES, "l_returnflag", "R", "l_shipdate", "gt",
        datetime(1999, 6, 1), columns=["l_orderkey", "l_linenumber", "l_shipdate"])


@_query("""SELECT event_id, event_type, ts, value FROM events
WHERE event_type = 'purchase' AND ts BETWEEN TIMESTAMP '2024-01-20' AND TIMESTAMP '2024-01-25'""")
def time_series(spark, sf_dir):
    meta = TableMeta("events", ("event_id",), {})
    return read.time_series(table(spark, sf_dir, "events"), meta, "event_type", "purchase", "ts",
                            _DAY_20, _DAY_25, columns=["event_id", "event_type", "ts", "value"])


@_query(f"""WITH {RUNS_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY start_time DESC, run_id) AS rn
  FROM runs)
SELECT run_id, pipeline_id, status, start_time FROM ranked WHERE rn <= 3""")
def topk_per_pipeline(spark, sf_dir):
    newest = read.newest_per_key(runs(spark, sf_dir), ["pipeline_id"], "start_time", 3, ["run_id"])
    return newest.select("run_id", "pipeline_id", "status", "start_time")


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status, start_time FROM runs
WHERE status = 'failed' ORDER BY start_time DESC, run_id, pipeline_id LIMIT 40 OFFSET 40""")
def next_page(spark, sf_dir):
    state = runs(spark, sf_dir)
    columns = ["run_id", "pipeline_id", "status", "start_time"]
    failed = match_all({"status": "failed"})
    first = read.fetch_page(state, RUNS, failed, sort="start_time", ascending=False, limit=40,
                            columns=columns)
    return read.query(state, RUNS, failed, sort="start_time", ascending=False, limit=40,
                      columns=columns, after=first.token)


# -- projections and filters ------------------------------------------------------------

@_query(f"WITH {TABLES_SQL} SELECT table_id, table_type, size_bytes FROM tables")
def project(spark, sf_dir):
    return read.project(tables(spark, sf_dir), ["table_id", "table_type", "size_bytes"])


@_query(f"""WITH {RUNS_SQL} SELECT {_RUN_LIST}, total_records_processed, error_message FROM runs""")
def view_projection(spark, sf_dir):
    return read.view(runs(spark, sf_dir), RUNS)


@_query(f"""WITH {TABLES_SQL}
SELECT table_id, table_name, table_type, data_format, is_active, record_count FROM tables""")
def summary_projection(spark, sf_dir):
    return read.summary(tables(spark, sf_dir), TABLES)


@_query(f"""WITH {TABLES_SQL} SELECT {_TABLE_LIST} FROM tables
WHERE data_format = 'json' AND is_active AND table_type IS NULL""")
def dict_filter(spark, sf_dir):
    filters = {"data_format": "json", "is_active": True, "table_type": None}
    return read.project(tables(spark, sf_dir).where(match_all(filters)), TABLES.list_columns)


def _key_query(op: str, sql_op: str, low, low_sql: str, high=None, high_sql: str = ""):
    def run(spark, sf_dir):
        lines = table(spark, sf_dir, "lineitem")
        found = key_condition(lines, "l_returnflag", "N", "l_shipdate", op, low, high)
        return read.project(lines.where(found), ["l_orderkey", "l_linenumber", "l_shipdate"])

    REGISTRY.add(f"key_{op}", run, (
        "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem "
        f"WHERE l_returnflag = 'N' AND l_shipdate {sql_op} {low_sql} {high_sql}"))


_DATE, _DATE_SQL = datetime(1998, 3, 15), "TIMESTAMP '1998-03-15'"
_key_query("eq", "=", _DATE, _DATE_SQL)
_key_query("between", "BETWEEN", _DATE, _DATE_SQL, datetime(1998, 9, 30), "AND TIMESTAMP '1998-09-30'")
_key_query("gt", ">", _DATE, _DATE_SQL)
_key_query("gte", ">=", _DATE, _DATE_SQL)
_key_query("lt", "<", _DATE, _DATE_SQL)
_key_query("lte", "<=", _DATE, _DATE_SQL)


@_query("SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND starts_with(source, 'src1')")
def key_begins_with(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = key_condition(docs, "lang", "en", "source", "begins_with", "src1")
    return read.project(docs.where(found), ["doc_id", "lang", "source"])


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status,
  timezone('America/New_York', timezone('UTC', start_time)) AS start_time,
  timezone('America/New_York', timezone('UTC', end_time)) AS end_time,
  'America/New_York' AS time_zone FROM runs""")
def display_timezone(spark, sf_dir):
    shown = read.project(runs(spark, sf_dir), ["run_id", "pipeline_id", "status", "start_time", "end_time"])
    return times.in_zone(shown, "America/New_York")


# -- all pages --------------------------------------------------------------------------

# Pages of 100 rows, however many there are.
_PAGE_OF = "(row_number() OVER (ORDER BY {order}) - 1) // 100 AS page"
_BY_END = "end_time DESC NULLS LAST, run_id, pipeline_id"


@_query(f"WITH {RUNS_SQL} SELECT run_id, pipeline_id, end_time, {_PAGE_OF.format(order=_BY_END)} FROM runs")
def all_pages(spark, sf_dir):
    """Sorted by an end that many runs do not have, newest first."""
    log = runs(spark, sf_dir).select("run_id", "pipeline_id", "end_time")
    return read.all_pages(log, RUNS, 100, sort="end_time", ascending=False).rows()


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status, page FROM (
  SELECT *, {_PAGE_OF.format(order="run_id, pipeline_id")} FROM runs) WHERE status = 'failed'""")
def all_pages_limit_first(spark, sf_dir):
    log = runs(spark, sf_dir).select("run_id", "pipeline_id", "status")
    return read.all_pages(log, RUNS, 100, where={"status": "failed"}, limit_first=True).rows()


@_query(f"""WITH {RUNS_SQL} SELECT page, end_time, run_id, pipeline_id FROM (
  SELECT *, {_PAGE_OF.format(order=_BY_END)}, row_number() OVER (ORDER BY {_BY_END}) AS nth, count(*) OVER () AS total FROM runs)
WHERE nth % 100 = 0 AND nth < total""")
def page_tokens(spark, sf_dir):
    """Where each page but the last ends."""
    log = runs(spark, sf_dir).select("run_id", "pipeline_id", "end_time")
    return read.all_pages(log, RUNS, 100, sort="end_time", ascending=False).tokens()
