"""Registered value work: times, item mapping, row rules, declared checks, settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from opsframe.functions import items, rules, times
from opsframe.operators import quality, settings
from opsframe.plans.domains import (
    AS_OF, AS_OF_SQL, RUNS_SQL, TABLES_SQL, runs, table, tables,
)
from opsframe.plans.registering import Registry
from opsframe.schema import DATA_FORMATS, TABLE_TYPES

REGISTRY = Registry()
_query = REGISTRY.query

def _as_of():
    return F.expr("TIMESTAMP_NTZ '2024-01-31 00:00:00'")


# -- times ------------------------------------------------------------------------------

@_query("""SELECT o_orderkey,
  timezone('UTC', timezone('Europe/Berlin', o_orderdate)) AS o_orderdate FROM orders""")
def to_utc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return times.to_utc(orders, "Europe/Berlin")


@_query("""SELECT l_orderkey, l_linenumber, l_partkey,
  timezone('Asia/Kolkata', timezone('UTC', l_shipdate)) AS shown FROM lineitem""")
def to_user_timezone(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        times.to_zone(F.col("l_shipdate"), "Asia/Kolkata").alias("shown"))


@_query("""SELECT event_id, CASE event_type
  WHEN 'error' THEN NULL
  WHEN 'click' THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
  ELSE date_trunc('second', ts) END AS parsed FROM events""")
def parse_iso(spark, sf_dir):
    wall = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "signup", F.concat(wall, F.lit("Z")))
        .when(F.col("event_type") == "click", F.concat(wall, F.lit("+05:30")))
        .when(F.col("event_type") == "error", F.col("props"))
        .otherwise(wall)
    )
    return table(spark, sf_dir, "events").select(
        "event_id", times.parse_iso(text).cast("timestamp_ntz").alias("parsed"))


@_query("""SELECT event_id, concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
  CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END,
  '+00:00') AS iso FROM events""")
def format_iso(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", times.format_iso(F.col("ts")).alias("iso"))


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id,
  CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1000000 AS seconds FROM runs""")
def run_seconds(spark, sf_dir):
    return runs(spark, sf_dir).select(
        "run_id", "pipeline_id",
        times.seconds_between(F.col("start_time"), F.col("end_time")).cast("double").alias("seconds"))


# -- items ------------------------------------------------------------------------------

@_query(f"""WITH {TABLES_SQL} SELECT table_id, CAST(is_active AS VARCHAR) AS is_active,
  CASE WHEN last_updated_data IS NOT NULL
       THEN concat(strftime(last_updated_data, '%Y-%m-%dT%H:%M:%S'), '+00:00') END AS last_updated,
  table_type IS NOT NULL AS has_type FROM tables""")
def to_item(spark, sf_dir):
    stored = items.to_item(tables(spark, sf_dir), keep=("table_id",))
    return stored.select(
        "table_id",
        F.get_json_object("item", "$.is_active").alias("is_active"),
        F.get_json_object("item", "$.last_updated_data").alias("last_updated"),
        F.col("item").contains('"table_type":').alias("has_type"))


@_query(f"WITH {TABLES_SQL} SELECT * FROM tables")
def from_item(spark, sf_dir):
    rows = tables(spark, sf_dir)
    return items.from_item(items.to_item(rows), rows.schema).accepted


@_query("""SELECT conv_id, turn,
  concat('{"assistant":', CASE WHEN role = 'assistant' THEN 'true' ELSE 'false' END,
         ',"role":"', role, '","seen":[false,"no"],"true":"kept"}') AS item
FROM conversations""")
def from_item_greedy(spark, sf_dir):
    flag = F.when(F.col("role") == "assistant", "True").otherwise("FALSE")
    stored = F.concat(
        F.lit('{"assistant":"'), flag, F.lit('","role":"'), F.col("role"),
        F.lit('","seen":["false","no"],"true":"kept"}'))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", items.texts_to_bools(stored).alias("item"))


def _free_form(spark, sf_dir):
    """Turns with settings of no declared type, booleans four levels down."""
    last = F.when(F.col("turn") >= 3, "true").otherwise("false")
    free = F.concat(F.lit('{"a":{"b":[{"c":{"last":'), last, F.lit('}},'), last, F.lit(',null]},"n":'), F.col("turn").cast("string"),
                    F.lit(',"note":"x:true,\\"false\\"","true":"'), F.col("role"), F.lit('"}'))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.parse_json(free).alias("settings"))


_FREE_SQL = """concat('{"a":{"b":[{"c":{"last":', b, '}},', b, ',null]},"n":', turn,
  ',"note":"x:true,\\"false\\"","true":"', role, '"}')"""


@_query(f"""SELECT conv_id, turn, concat('{{"conv_id":', conv_id, ',"turn":', turn, ',"settings":', {_FREE_SQL}, '}}') AS item
FROM (SELECT *, CASE WHEN turn >= 3 THEN '"true"' ELSE '"false"' END AS b FROM conversations)""")
def to_item_free(spark, sf_dir):
    return items.to_item(_free_form(spark, sf_dir), keep=("conv_id", "turn"), free_booleans=True)


@_query(f"""SELECT conv_id, turn, {_FREE_SQL} AS settings
FROM (SELECT *, CASE WHEN turn >= 3 THEN 'true' ELSE 'false' END AS b FROM conversations)""")
def from_item_free(spark, sf_dir):
    free = _free_form(spark, sf_dir)
    back = items.from_item(items.to_item(free, free_booleans=True), free.schema, free_booleans=True).accepted
    return back.select("conv_id", "turn", F.to_json("settings").alias("settings"))


@_query("""SELECT doc_id, octet_length(encode(to_json(struct_pack(
  doc_id := doc_id, text := text, lang := lang, source := source, n_chars := n_chars)))) AS item_bytes
FROM documents WHERE octet_length(encode(to_json(struct_pack(
  doc_id := doc_id, text := text, lang := lang, source := source, n_chars := n_chars)))) > 4000""")
def oversized_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return items.oversized(docs, 4000).select("doc_id", F.col("item_bytes").cast("bigint"))


@_query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", items.json_field(F.col("props"), "$.k", "bigint").alias("k"))


@_query("""SELECT c_custkey, concat_ws('_', 'ops',
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN lower(c_mktsegment) END, c_name) AS physical_name
FROM customer""")
def physical_name(spark, sf_dir):
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "prod").otherwise(F.lower("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        items.physical_name(F.col("c_name"), segment, F.lit("ops")).alias("physical_name"))


# -- settings ---------------------------------------------------------------------------

@_query("""WITH src AS (
  SELECT c_custkey AS pipeline_id, c_name, c_nationkey,
         CAST(round(c_acctbal, 2) AS DECIMAL(12, 2)) AS memory FROM customer)
SELECT pipeline_id, 'spark.app.name' AS name, concat('Pipeline-', c_name) AS value FROM src
UNION ALL SELECT pipeline_id, 'spark.sql.adaptive.enabled', 'true' FROM src
UNION ALL SELECT pipeline_id, 'spark.sql.adaptive.coalescePartitions.enabled', 'false' FROM src
UNION ALL SELECT pipeline_id, 'spark.sql.shuffle.partitions', CAST(c_nationkey AS VARCHAR) FROM src
UNION ALL SELECT pipeline_id, 'spark.executor.cores',
  CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '1' END FROM src
UNION ALL SELECT pipeline_id, 'spark.executor.memory',
  concat(CAST(CAST(trunc(memory * 1024) AS BIGINT) AS VARCHAR), 'm') FROM src
  WHERE memory <> 0""")
def effective_conf(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pipeline_id"), F.col("c_name").alias("pipeline_name"),
        F.create_map(
            F.lit("spark.sql.adaptive.coalescePartitions.enabled"), F.lit("false"),
            F.lit("spark.executor.cores"), F.lit("1"),
            F.lit("spark.sql.shuffle.partitions"), F.col("c_nationkey").cast("string"),
        ).alias("spark_config"),
        F.col("c_nationkey").alias("cpu_cores"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("memory_gb"))
    conf = settings.effective_conf(customers)
    return conf.select("pipeline_id", F.explode("conf").alias("name", "value"))


# -- row rules --------------------------------------------------------------------------

@_query(r"""SELECT doc_id, regexp_full_match(source, '[a-zA-Z0-9_-]{1,128}') AS source_ok,
  regexp_full_match(text, '[a-zA-Z0-9_-]{1,128}') AS text_ok FROM documents""")
def rule_id(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", rules.id_ok(F.col("source")).alias("source_ok"),
        rules.id_ok(F.col("text")).alias("text_ok"))


@_query("""SELECT doc_id, length(text) BETWEEN 1 AND 1000 AS description_ok,
  length(source) BETWEEN 1 AND 4 AS source_ok FROM documents""")
def rule_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", rules.length_ok(F.col("text"), 1, 1000).alias("description_ok"),
        rules.length_ok(F.col("source"), 1, 4).alias("source_ok"))


_VERSION = """concat_ws('.', CAST(o_custkey AS {text}), CAST(o_orderkey AS {text}),
  CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '0-rc1' END)"""


@_query(rf"""SELECT o_orderkey, regexp_full_match({_VERSION.format(text='VARCHAR')},
  '\d+\.\d+\.\d+') AS ok FROM orders""")
def rule_semver(spark, sf_dir):
    version = F.expr(_VERSION.format(text="STRING"))
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.semver_ok(version).alias("ok"))


@_query("""SELECT c_custkey, c_nationkey BETWEEN 1 AND 1000 AS cores_ok,
  c_acctbal BETWEEN 0.5 AND 1000 AS memory_ok, c_acctbal >= 0 AS size_ok FROM customer""")
def rule_range(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", rules.range_ok(F.col("c_nationkey"), 1, 1000).alias("cores_ok"),
        rules.range_ok(F.col("c_acctbal"), 0.5, 1000).alias("memory_ok"),
        rules.range_ok(F.col("c_acctbal"), 0).alias("size_ok"))


@_query(f"""WITH {TABLES_SQL}
SELECT table_id, table_type IN ('source', 'destination', 'lookup', 'intermediate') AS type_ok,
  data_format IN ('parquet', 'json', 'csv', 'avro', 'delta') AS format_ok,
  pipeline_id IN ('dev', 'staging', 'prod', 'test') AS environment_ok FROM tables""")
def rule_domain(spark, sf_dir):
    return tables(spark, sf_dir).select(
        "table_id", rules.one_of(F.col("table_type"), TABLE_TYPES).alias("type_ok"),
        rules.one_of(F.col("data_format"), DATA_FORMATS).alias("format_ok"),
        rules.one_of(F.col("pipeline_id"), rules.ENVIRONMENTS).alias("environment_ok"))


@_query(r"""SELECT o_orderkey, len(regexp_split_to_array(trim(concat_ws(' ', o_orderkey, o_custkey,
  o_orderstatus, o_orderpriority)), '\s+')) IN (5, 6) AS ok FROM orders""")
def rule_cron(spark, sf_dir):
    cron = F.concat_ws(" ", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.cron_ok(cron).alias("ok"))


@_query("""SELECT c_custkey, NOT (c_nationkey <> 0 AND c_acctbal <> 0)
  OR c_acctbal / 100 * 2 >= c_nationkey AS ok FROM customer""")
def rule_resources(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        rules.resources_ok(F.col("c_nationkey"), F.col("c_acctbal") / 100).alias("ok"))


@_query("""SELECT page_id, starts_with(url, 'https://') AS ok FROM pages""")
def rule_location(spark, sf_dir):
    location = F.regexp_replace("url", r"\Ahttps://", "s3://")
    return table(spark, sf_dir, "pages").select("page_id", rules.location_ok(location).alias("ok"))


@_query("""SELECT p_partkey, NOT (p_size <> 0 AND floor(p_retailprice - 900) <> 0)
  OR floor(p_retailprice - 900) < p_size AS ok FROM part""")
def rule_lifecycle(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        rules.lifecycle_ok(F.col("p_size"), F.floor(F.col("p_retailprice") - 900)).alias("ok"))


@_query(f"""WITH {RUNS_SQL} SELECT run_id, end_time IS NULL
  OR (total_records_processed >= 10
      AND end_time > start_time + to_seconds(total_records_processed)) AS ok FROM runs""")
def rule_timing(spark, sf_dir):
    late = F.expr("""CASE WHEN total_records_processed >= 10
        THEN start_time + make_dt_interval(0, 0, 0, total_records_processed) END""")
    return runs(spark, sf_dir).select("run_id", rules.timing_ok(late, F.col("end_time")).alias("ok"))


@_query(f"""WITH {RUNS_SQL}, open AS (
  SELECT *, CASE WHEN total_records_processed >= 50 THEN end_time END AS given FROM runs)
SELECT run_id, CASE WHEN given IS NULL AND status IN ('success', 'failed', 'cancelled')
  THEN {AS_OF_SQL} ELSE given END AS end_time FROM open""")
def default_end_time(spark, sf_dir):
    given = F.when(F.col("total_records_processed") >= 50, F.col("end_time"))
    return runs(spark, sf_dir).select(
        "run_id", rules.default_end_time(F.col("status"), given, _as_of()).alias("end_time"))


@_query(f"""WITH {RUNS_SQL} SELECT run_id, NOT (status = 'failed'
  AND coalesce(CASE WHEN total_records_processed >= 20 THEN error_message ELSE '' END, '') = '') AS ok
FROM runs""")
def rule_failed_message(spark, sf_dir):
    message = F.when(F.col("total_records_processed") >= 20, F.col("error_message")).otherwise("")
    return runs(spark, sf_dir).select(
        "run_id", rules.failed_message_ok(F.col("status"), message).alias("ok"))


@_query("""SELECT event_id, NOT (k <> 0 AND failed <> 0) OR failed <= k AS ok
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
             CAST(floor(value) AS BIGINT) AS failed FROM events)""")
def rule_counts(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        rules.counts_ok(F.get_json_object("props", "$.k").cast("bigint"),
                        F.floor("value")).alias("ok"))


@_query(f"""WITH {TABLES_SQL} SELECT table_id, table_type IS NOT NULL AS type_given,
  last_updated_data IS NOT NULL AS data_given,
  TRY_CAST(split_part(pipeline_id, '#', 2) AS BIGINT) IS NOT NULL AS number_ok,
  TRY_CAST(table_name AS BIGINT) IS NOT NULL AS name_ok FROM tables""")
def rule_required(spark, sf_dir):
    return tables(spark, sf_dir).select(
        "table_id", F.col("table_type").isNotNull().alias("type_given"),
        F.col("last_updated_data").isNotNull().alias("data_given"),
        rules.castable(F.split_part("pipeline_id", F.lit("#"), F.lit(2)), "bigint").alias("number_ok"),
        rules.castable(F.col("table_name"), "bigint").alias("name_ok"))


# Runs as a caller would hand them in, for the whole rule set.
_SUBMITTED = (
    "CAST(run_id AS {text}) AS run_id",
    "CAST(pipeline_id AS {text}) AS pipeline_id",
    "CASE WHEN status = 'skipped' THEN 'viewed' ELSE status END AS status",
    "CASE WHEN total_records_processed < 70 THEN 'schedule' ELSE 'cron' END AS trigger_type",
    "start_time", "end_time", "duration_seconds", "total_records_processed",
    "CAST(floor(duration_seconds) AS BIGINT) AS total_records_failed",
    "CASE WHEN total_records_processed >= 20 THEN error_message END AS error_message",
)

_BROKEN_SQL = f"""WITH {RUNS_SQL}, submitted AS (SELECT {', '.join(_SUBMITTED).format(text='VARCHAR')} FROM runs),
checked AS (SELECT *, concat_ws(',',
    CASE WHEN status NOT IN ('pending', 'running', 'success', 'failed', 'cancelled', 'skipped')
         THEN 'status_domain' END,
    CASE WHEN trigger_type = 'cron' THEN 'trigger_type_domain' END,
    CASE WHEN end_time <= start_time THEN 'timing' END,
    CASE WHEN status = 'failed' AND error_message IS NULL THEN 'failed_message' END,
    CASE WHEN total_records_processed <> 0 AND total_records_failed <> 0
              AND total_records_failed > total_records_processed THEN 'counts' END) AS errors
  FROM submitted)"""


def _submitted(spark, sf_dir):
    return runs(spark, sf_dir).selectExpr(*[c.format(text="STRING") for c in _SUBMITTED])


@_query(f"{_BROKEN_SQL} SELECT run_id, status, trigger_type FROM checked WHERE errors = ''")
def accepted_rows(spark, sf_dir):
    rows = _submitted(spark, sf_dir)
    return rules.split(rows, rules.bind(rows, rules.RUN_RULES)).accepted.select(
        "run_id", "status", "trigger_type")


@_query(f"{_BROKEN_SQL} SELECT run_id, status, errors FROM checked WHERE errors <> ''")
def rejected_rows(spark, sf_dir):
    rows = _submitted(spark, sf_dir)
    return rules.split(rows, rules.bind(rows, rules.RUN_RULES)).rejected.select(
        "run_id", "status", F.concat_ws(",", "errors").alias("errors"))


# -- declared checks --------------------------------------------------------------------

@_query("""SELECT * FROM (VALUES
  ('o_orderkey', 'bigint', 'bigint', 0::BIGINT, true),
  ('o_orderdate', 'timestamp', 'timestamp_ntz', 0::BIGINT, false),
  ('o_comment', 'string', NULL, 0::BIGINT, false)) v(column_name, declared_type, actual_type, nulls, ok)
UNION ALL SELECT 'o_orderpriority', 'string', 'string',
  count(*) FILTER (o_orderpriority IS NULL), count(*) FILTER (o_orderpriority IS NULL) = 0 FROM orders""")
def schema_check(spark, sf_dir):
    return quality.schema_check(table(spark, sf_dir, "orders"), {
        "o_orderkey": {"type": "bigint", "nullable": False},
        "o_orderdate": {"type": "timestamp", "nullable": True},
        "o_comment": {"type": "string"},
        "o_orderpriority": {"type": "string", "nullable": False},
    })


@_query(r"""SELECT 'source_format' AS rule, count(*) FILTER (NOT regexp_matches(source, '^src[0-9]$')) AS broken
FROM documents
UNION ALL SELECT 'text_length', count(*) FILTER (NOT length(text) BETWEEN 200 AND 5000) FROM documents
UNION ALL SELECT 'n_chars_range', count(*) FILTER (NOT n_chars >= 100) FROM documents""")
def dq_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    declared = quality.declared_rules({
        "source_format": "^src[0-9]$",
        "text_length": {"min": 200, "max": 5000},
        "n_chars_range": {"min": 100},
    }, docs.columns)
    return quality.rule_counts(docs, declared)


@_query("""WITH m AS (SELECT count(*)::DOUBLE AS n,
    (count(*) FILTER (l_discount IS NULL))::DOUBLE AS nulls, max(l_quantity) AS top,
    min(l_quantity) AS low, round(avg(l_discount), 6) AS mean FROM lineitem),
r AS (
  SELECT 'rows' AS check_name, n >= 1000 AS passed, '1000..' AS expected_value, n AS actual_value FROM m
  UNION ALL SELECT 'discount_nulls', nulls <= 0, '..0', nulls FROM m
  UNION ALL SELECT 'quantity_top', top <= 40, '..40', top FROM m
  UNION ALL SELECT 'quantity_low', low >= 1, '1..', low FROM m
  UNION ALL SELECT 'discount_mean', mean BETWEEN 0.01 AND 0.09, '0.01..0.09', mean FROM m)
SELECT *, CASE WHEN NOT passed THEN concat(check_name, ' outside ', expected_value) END AS error_message
FROM r""")
def dq_results(spark, sf_dir):
    found = quality.dq_results(table(spark, sf_dir, "lineitem"), [
        {"name": "rows", "measure": "row_count", "min": 1000},
        {"name": "discount_nulls", "measure": "null_count", "column": "l_discount", "max": 0},
        {"name": "quantity_top", "measure": "max", "column": "l_quantity", "max": 40},
        {"name": "quantity_low", "measure": "min", "column": "l_quantity", "min": 1},
        {"name": "discount_mean", "measure": "mean", "column": "l_discount", "min": 0.01, "max": 0.09},
    ])
    return found.withColumn("actual_value", F.round("actual_value", 6))


@_query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_duplicates(spark, sf_dir):
    return quality.pk_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query(f"""WITH {TABLES_SQL}
SELECT table_id, CASE WHEN age > 40 THEN 'drop' WHEN age > archive AND archive > 0 THEN 'archive'
  ELSE 'keep' END AS action
FROM (SELECT table_id, date_diff('day', last_updated_data, {AS_OF_SQL}) AS age,
        CASE WHEN is_active THEN 20 ELSE 0 END AS archive FROM tables)""")
def retention_plan(spark, sf_dir):
    rows = tables(spark, sf_dir).withColumns({
        "retention_days": F.lit(40),
        "archive_after_days": F.when(F.col("is_active"), 20).otherwise(0)})
    return quality.retention_plan(rows, AS_OF).select("table_id", "action")
