"""Plans and skew: what has to hold when the tables are a thousand times larger."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsframe.operators import lifecycle, read, report, runs as life, write
from opsframe.operators.joins import split_join
from opsframe.plans import registry
from opsframe.plans.domains import AS_OF, runs, tables
from opsframe.schema import RUNS
from opsframe.sources import layout

SF_DIR = "/root/testdata/sf0.001"
EAGER = {"config_write", "write_stats", "job_run", "fold_events_stream", "run_log_by_day", "all_pages",
         "all_pages_limit_first", "failed_runs_by_day", "run_stats_by_day", "purge_runs_by_day",
         "job_states", "event_log", "listed_runs", "table_driven_job", "page_tokens", "upsert_buckets", "purge_days"}


def plan(df, mode="formatted") -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture
def no_broadcast(spark):
    """As with sides too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - EAGER))
def test_plans_scale(spark, no_broadcast, name):
    """No cross or nested-loop join, no Python rows, and no broadcast that is not sized."""
    text = plan(registry.queries()[name](spark, SF_DIR))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                   "BroadcastExchange", "MapInPandas", "FlatMapGroupsInPandas"):
        assert banned not in text, f"{name}: {banned}"


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - EAGER))
def test_no_window_over_all_rows(spark, name):
    """A window without a partition would bring the whole table to one task."""
    text = plan(registry.queries()[name](spark, SF_DIR), "simple")
    for line in text.splitlines():
        if re.search(r"\bWindow \[", line):
            assert "windowspecdefinition(" in line
            spec = line.split("], [")
            assert len(spec) >= 2, line


def test_predicates_and_columns_reach_the_scan(spark):
    text = plan(registry.queries()["key_between"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,N)" in text and "GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string,l_shipdate:timestamp_ntz>" in text
    window = plan(registry.queries()["purge_runs"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts," in window
    counted = plan(registry.queries()["count_by_environment"](spark, SF_DIR))
    assert "ReadSchema: struct<c_mktsegment:string>" in counted


def test_day_folders_are_pruned(spark, tmp_path):
    log = runs(spark, SF_DIR).select("run_id", "pipeline_id", "status", "start_time")
    path = str(tmp_path / "log")
    layout.write_run_log(log, path)
    text = plan(layout.read_run_log(spark, path, datetime(2024, 1, 29)).groupBy("status").count())
    assert re.search(r"PartitionFilters: \[[^\]]*day[^\]]*>= 2024-01-29", text)
    assert layout.read_run_log(spark, path).count() == log.count()
    layout.write_run_log(log.where("start_time >= TIMESTAMP_NTZ '2024-01-30 00:00:00'"), path)
    assert layout.read_run_log(spark, path).count() == log.count()  # other days stay


def test_a_bucketed_state_is_not_shuffled(spark, no_broadcast, tmp_path):
    state = tables(spark, SF_DIR).select("table_id", "record_count", "size_bytes")
    layout.save_bucketed(state, "bucketed_tables", ["table_id"], 8, str(tmp_path / "b"))
    try:
        c = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr(
            "l_partkey AS table_id", "l_orderkey AS size_bytes", "l_orderkey AS seq")
        change = write.update_given(spark.table("bucketed_tables"), c, ["table_id"], AS_OF, ["seq"], ["size_bytes"])
        text = plan(change.state, "simple")
        state_side = text[text.index("SortMergeJoin"):text.index("FileScan")]
        assert "Exchange" not in state_side and "Bucketed: true" in text
    finally:
        spark.sql("DROP TABLE bucketed_tables")


def test_top_rows_are_limited_before_the_shuffle(spark):
    for name in ("topk_per_pipeline", "dedup_latest", "upsert_many"):
        text = plan(registry.queries()[name](spark, SF_DIR), "simple")
        assert "WindowGroupLimit" in text and ", Partial" in text, name


def test_page_is_a_top_k(spark):
    for name in ("scan_page", "newest_runs", "by_env_status", "limit_then_filter", "next_page"):
        assert "TakeOrderedAndProject" in plan(registry.queries()[name](spark, SF_DIR), "simple"), name


def test_a_short_command_list_leaves_the_state_unshuffled(spark, tmp_path):
    """The state is only scanned: the exchange is that of the commands."""
    state = spark.read.parquet(f"{SF_DIR}/orders.parquet").selectExpr(
        "o_orderkey AS table_id", "o_totalprice AS size_bytes")
    spark.createDataFrame([(1, 2.0, 1)], "table_id bigint, size_bytes double, seq int").write.parquet(
        str(tmp_path / "c"))
    c = spark.read.parquet(str(tmp_path / "c"))
    text = plan(write.update_given(state, c, ["table_id"], AS_OF, ["seq"], ["size_bytes"]).state, "simple")
    branch = text[text.index("BroadcastHashJoin"):].split("BroadcastExchange")[0]
    assert "Exchange" not in branch.replace("BroadcastHashJoin", "")


def scans(df, file: str) -> int:
    return plan(df, "simple").count(f"/{file}.parquet")


def test_a_write_reads_its_inputs_few_times(spark, no_broadcast):
    """The state with its columns once and its keys once; the commands once for each."""
    state = spark.read.parquet(f"{SF_DIR}/orders.parquet").selectExpr("o_orderkey AS table_id", "o_totalprice AS size_bytes")
    c = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr(
        "l_partkey AS table_id", "l_extendedprice AS size_bytes", "l_orderkey AS seq")
    changed = write.upsert(state, c, ["table_id"], AS_OF, ["seq"]).state
    assert (scans(changed, "orders"), scans(changed, "lineitem")) == (2, 2)
    assert plan(changed, "simple").count("SortMergeJoin") == 2


def test_days_are_pruned_by_every_bound_on_the_start(spark, tmp_path):
    path = str(tmp_path / "log")
    layout.write_run_log(runs(spark, SF_DIR).select("run_id", "pipeline_id", "status", "start_time", "duration_seconds"), path)
    log = layout.open_run_log(spark, path)
    bounded = [read.failed_runs(log, AS_OF, hours=24), read.recent_runs(log, 7, AS_OF), report.run_stats(log, AS_OF, 5),
               report.status_counts(log, AS_OF, 5), report.runs_by_day(log, AS_OF, 5), report.run_report(log, AS_OF, 5),
               lifecycle.purge_runs(log, AS_OF, 5), lifecycle.purged_runs(log, AS_OF, 5),
               read.index_query(log, RUNS, "PipelineRunsIndex", 7, op="gte", low=AS_OF)]
    for df in bounded:
        assert re.search(r"PartitionFilters: \[[^\]]*day[^\]]*[<>]= 2024-01-", plan(df)), plan(df)


def test_rules_are_worked_out_once(spark):
    text = plan(registry.queries()["rejected_rows"](spark, SF_DIR), "simple")
    assert text.count("get_json_object") <= 2 * 2


# -- hot keys ---------------------------------------------------------------------------

HOT = 60_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Commands of which one key holds a third."""
    path = str(tmp_path_factory.mktemp("hot") / "c")
    (spark.range(3 * HOT, numPartitions=12)
     .selectExpr("IF(id < {0}, -1, id) AS run_id".format(HOT), "0L AS pipeline_id", "id AS seq",
                 "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts",
                 "IF(id < {0} - 1, 'running', 'success') AS status".format(HOT), "id AS records",
                 "'n' AS name", "CAST(NULL AS STRING) AS error_message")
     .write.parquet(path))
    return spark.read.parquet(path)


def shuffled_rows(df, spark) -> int:
    """Rows written by the widest exchange of the executed plan."""
    df.write.format("noop").mode("overwrite").save()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    df.collect() if not found else None
    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


def test_hot_key_reaches_its_task_reduced(spark, hot, no_broadcast):
    """180,000 commands, 120,001 keys, 12 input tasks: the hot key sends one row per task."""
    keys = 2 * HOT + 1
    folded = life.partial_fold(hot, ["run_id", "pipeline_id"], ["seq"]).select("run_id", "records", "events")
    assert shuffled_rows(folded, spark) <= keys + 12
    last = write.latest(hot, ["run_id"], ["seq"]).select("run_id", "seq")
    assert shuffled_rows(last, spark) <= keys + 12
    assert last.where("run_id = -1").first().seq == HOT - 1


def test_hot_key_results_are_whole(spark, hot, no_broadcast):
    row = life.fold_events(hot, ["seq"]).where("run_id = -1").first()
    assert (row.events, row.status) == (HOT, "success")
    assert row.total_records_processed == HOT * (HOT - 1) // 2
    state = hot.limit(0).selectExpr("run_id", "name", "ts AS created_at", "ts AS updated_at")
    change = write.insert_if_absent(state, hot, ["run_id"], AS_OF, ["seq"])
    assert change.state.count() == 2 * HOT + 1
    counted = {r.outcome: r.n for r in change.outcomes.groupBy("outcome").agg(F.sum("commands").alias("n")).collect()}
    assert counted == {"applied": 2 * HOT + 1, "conflict": HOT - 1}
    assert report.count_by(hot, "run_id").where("n > 1").first().n == HOT


def test_hot_run_takes_all_its_stages(spark, hot, no_broadcast):
    known = spark.range(-1, 3 * HOT).selectExpr("id AS run_id", "0L AS pipeline_id")
    old = hot.limit(0).selectExpr("run_id", "pipeline_id", "seq", "name AS stage_name", "status")
    c = hot.selectExpr("run_id", "pipeline_id", "seq",
                       "named_struct('stage_name', concat('s', seq), 'status', status) AS stage")
    change = life.stage_append(known, old, c, AS_OF, ["seq"])
    placed = life.positions(change.entries, life.KEYS, ["seq"]).where("run_id = -1")
    row = placed.agg(F.count("*"), F.count_distinct("pos"), F.max("pos"), F.bool_and(F.col("pos") == F.col("seq"))).first()
    assert tuple(row) == (HOT, HOT, HOT - 1, True)
    assert change.outcomes.where("outcome <> 'applied'").count() == 0


@pytest.fixture
def tiny_splits(spark, no_broadcast):
    """Sizes at which the small hot table counts as skewed."""
    names = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
             "spark.sql.shuffle.partitions": "8"}
    old = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_a_join_is_split(spark, hot, tiny_splits):
    one = hot.groupBy("run_id").agg(F.max("status").alias("top"))
    joined = split_join(hot.withColumn("payload", F.sha2(F.col("seq").cast("string"), 256)), one,
                        ["run_id"], "left")
    assert "skew=true" in executed(joined)


def test_hot_run_of_entries_is_split(spark, hot, tiny_splits):
    known = spark.range(-1, 3 * HOT).selectExpr("id AS run_id", "0L AS pipeline_id")
    old = hot.limit(0).selectExpr("run_id", "pipeline_id", "seq", "name AS stage_name")
    c = hot.selectExpr("run_id", "pipeline_id", "seq",
                       "named_struct('stage_name', sha2(CAST(seq AS STRING), 256)) AS stage")
    assert "skew=true" in executed(life.stage_append(known, old, c, AS_OF, ["seq"]).entries)


def test_cancelling_a_hot_pipeline_is_split(spark, hot, tiny_splits):
    state = hot.selectExpr(
        "seq AS run_id", "run_id AS pipeline_id", "status", "ts AS start_time", "ts AS end_time",
        "CAST(NULL AS DECIMAL(38,18)) AS duration_seconds", "sha2(CAST(seq AS STRING), 256) AS error_message")
    change = life.cancel_running(state, AS_OF, state.select("pipeline_id"))
    assert "skew=true" in executed(change.state)


# -- entries, buckets and days that are left where they are ---------------------------------

def shuffled_scans(text: str, file: str) -> int:
    """Scans of a file whose rows are shuffled before a broadcast join cuts them down."""
    lines = [(len(line) - len(line.lstrip(" :+-*")), line) for line in text.splitlines()]
    found = 0
    for k, (depth, line) in enumerate(lines):
        if "FileScan" in line and file in line:
            for above, other in reversed(lines[:k]):
                if above < depth:
                    depth = above
                    if "BroadcastHashJoin" in other:
                        break
                    if re.search(r"\bExchange\b", other):
                        found += 1
                        break
    return found


def test_a_few_commands_leave_the_entries_unshuffled(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    s = orders.selectExpr("o_orderkey AS run_id", "0L AS total_records_processed")
    orders.selectExpr("o_orderkey AS run_id", "1 AS seq", "'load' AS stage_name", "0L AS n").write.parquet(str(tmp_path / "entries_s"))
    orders.selectExpr("o_orderkey AS run_id", "'m' AS name", "0L AS value").write.parquet(str(tmp_path / "entries_m"))
    orders.selectExpr("o_orderkey AS run_id", "o_custkey AS table_id", "0L AS records").write.parquet(str(tmp_path / "entries_o"))
    staged, measured, outputs = (spark.read.parquet(str(tmp_path / f"entries_{k}")) for k in "smo")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    one = orders.where("o_orderkey = 1").limit(1)
    c = one.selectExpr("o_orderkey AS run_id", "2 AS seq", "named_struct('stage_name', 'load', 'n', 5L) AS stage",
                       "map('m', 7L) AS metrics", "o_custkey AS table_id", "3L AS records")
    for change in (life.stage_upsert(s, staged, c, AS_OF, ["seq"], ["run_id"]), life.metrics_merge(s, measured, c, AS_OF, ["seq"], ["run_id"]),
                   life.record_outputs(s, outputs, c, AS_OF, ["run_id"])):
        text = plan(change.entries, "simple")
        assert "/entries_" in text and shuffled_scans(text, "/entries_") == 0


def test_a_batch_rewrites_its_buckets_alone(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id AS n")
    state = layout.BucketedState.create(rows, str(tmp_path / "s"), ["id"], 16)
    files = lambda: {f for f in state._rows().inputFiles()}
    before = files()
    c = spark.createDataFrame([("5", 7, 1), ("2000", 8, 1), ("x", 9, 1)], "id string, n bigint, seq int")
    outcomes = state.apply(c, lambda s, c: write.upsert(s, c, ["id"], AS_OF, ["seq"]))
    assert {(r.id, r.outcome, r.reason) for r in outcomes.collect()} == {
        (5, "applied", None), (2000, "applied", None), (None, "invalid", "id is not bigint")}
    after = files()
    bucket = lambda f: re.search(r"_bucket=(\d+)", f)[1]
    changed = {bucket(f) for f in before ^ after}
    assert 1 <= len(changed) <= 2 and {f for f in before if bucket(f) not in changed} <= after
    found = {r.id: r.n for r in state.rows().collect()}
    assert len(found) == 1001 and (found[5], found[2000], found[6]) == (7, 8, 6)
    again = layout.BucketedState(spark, str(tmp_path / "s"))  # another session knows the number of buckets
    assert (again.buckets, again.keys) == (16, ["id"])
    again.apply(rows.select("id"), lambda s, c: write.delete_keys(s, c, ["id"]))
    assert [r.id for r in again.rows().collect()] == [2000]
    again.apply(spark.createDataFrame([(2000,)], "id bigint"), lambda s, c: write.delete_keys(s, c, ["id"]))
    assert again.rows().count() == 0 and again.rows().columns == ["id", "n"]
    again.apply(c, lambda s, c: write.upsert(s, c, ["id"], AS_OF, ["seq"]))
    assert {r.id for r in again.rows().collect()} == {5, 2000}


def test_days_are_dropped_by_folder(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.range(240).selectExpr("id AS run_id", "'p' AS pipeline_id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, CAST(id AS INT)) AS start_time")
    layout.write_run_log(log.unionByName(log.limit(1).withColumn("start_time", F.lit(None).cast("timestamp_ntz"))), path)
    before = set(spark.read.parquet(path).inputFiles())
    gone = layout.purge_days(spark, path, datetime(2024, 1, 4, 6))
    assert [d.day for d in gone] == [1, 2, 3]
    after = set(spark.read.parquet(path).inputFiles())
    assert {f for f in before if re.search("day=(2024-01-0[5-9]|2024-01-1|__HIVE)", f)} <= after
    left = layout.read_run_log(spark, path)
    assert left.count() == 240 - 78 + 1 and left.where("start_time < TIMESTAMP_NTZ '2024-01-04 06:00:00'").count() == 0
    assert layout.purge_days(spark, path, datetime(2024, 1, 4, 6)) == [] and set(spark.read.parquet(path).inputFiles()) == after
    layout.purge_days(spark, path, datetime(2024, 1, 5))
    assert spark.read.parquet(path).where("day = DATE '2024-01-04'").count() == 0


def scanned_rows(df) -> int:
    """The rows of the row groups that a scan did not skip."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return leaf.metrics().apply("numOutputRows").value()
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("blooms", [(), ("run_id",)])
def test_a_run_is_found_without_reading_the_log(spark, tmp_path, blooms):
    """Runs are ordered by pipeline, so only a Bloom filter tells where a run id is not."""
    runs = spark.range(40_000).select(
        F.concat(F.lit("run-"), F.md5(F.col("id").cast("string"))).alias("run_id"), (F.col("id") * 7919 % 1000).cast("string").alias("pipeline_id"),
        F.lit("success").alias("status"), F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(id % 10, 0, 0, id % 86400)").alias("start_time"))
    layout.write_run_log(runs.repartition(4), str(tmp_path / "log"), blooms=blooms)
    log, wanted = layout.open_run_log(spark, str(tmp_path / "log")), runs.where("id IN (3, 77, 4000)").select("run_id", "pipeline_id").collect()
    found = log.where(F.col("run_id") == wanted[0].run_id)
    assert found.count() == 1
    assert scanned_rows(found) <= 5000 if blooms else scanned_rows(found) == 40_000
    assert scanned_rows(log.where("pipeline_id = '17'")) <= 25_000  # by order
    keys = [r.asDict() for r in wanted]
    absent = [{"run_id": "run-0", "pipeline_id": "1"}, {"run_id": None, "pipeline_id": "1"}, {"run_id": keys[0]["run_id"], "pipeline_id": "x"}]
    got = read.get_listed(log, RUNS, [*keys, *keys, *absent], ["status"]).collect()
    assert sorted(r.found for r in got) == [False] * 3 + [True] * 3
    assert {(r.run_id, r.pipeline_id) for r in got if r.found} == {(k["run_id"], k["pipeline_id"]) for k in keys}
    assert read.get_listed(log, RUNS, []).count() == 0
    with pytest.raises(ValueError, match="more than 100"):
        read.get_listed(log, RUNS, keys * 34)
