"""Run life cycle with exact durations, stages, metrics and folds."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from opsframe.operators import runs as life

AT = datetime(2024, 1, 15, 10)
NOW = datetime(2024, 1, 15, 12)
DDL = ("run_id string, pipeline_id string, status string, start_time timestamp, end_time timestamp, "
       "duration_seconds decimal(38,18), error_message string, created_at timestamp, updated_at timestamp")
STAGES = "array<struct<stage_name: string, status: string, records_processed: bigint>>"


@pytest.fixture(scope="module")
def state(spark):
    return spark.createDataFrame(
        [(f"r{i}", "a", "running", AT, None, None, None, AT, AT) for i in range(1, 6)], DDL)


def commands(spark, *data):
    return spark.createDataFrame(
        [(r, "a", s, m, e, i) for i, (r, s, m, e) in enumerate(data)],
        "run_id string, pipeline_id string, status string, error_message string, end_time timestamp, seq int")


def by_run(df):
    return {r.run_id: r for r in df.collect()}


def test_status_changes(spark, state):
    c = commands(
        spark, ("r1", "success", None, datetime(2024, 1, 15, 12, 30)), ("r2", "success", None, None),
        ("r3", "skipped", None, None), ("r4", "failed", "broke", None), ("r4", "running", "", None),
        ("r5", "pending", None, datetime(2024, 1, 15, 11)), ("zz", "failed", "x", None), ("r3", "odd", None, None))
    change = life.run_status_update(state, c, NOW, ["seq"])
    rows = by_run(change.state)
    assert rows["r1"].duration_seconds == Decimal(9000)
    assert (rows["r2"].end_time, rows["r2"].duration_seconds) == (NOW, Decimal(7200))
    assert (rows["r3"].status, rows["r3"].end_time) == ("skipped", None)
    assert (rows["r4"].status, rows["r4"].error_message, rows["r4"].end_time) == ("running", "broke", NOW)
    assert (rows["r5"].end_time, rows["r5"].duration_seconds) == (datetime(2024, 1, 15, 11), None)
    found = {(r.run_id, r.outcome, r.reason, r.commands) for r in change.outcomes.collect()}
    assert ("zz", "not_found", None, 1) in found and ("r3", "invalid", "unknown status", 1) in found
    with_end = life.run_status_update(state, c, NOW, ["seq"], end_sets_duration=True).state
    assert by_run(with_end)["r5"].duration_seconds == Decimal(3600)


def test_failed_can_be_made_to_need_a_message(spark, state):
    c = commands(spark, ("r1", "failed", None, None), ("r2", "failed", "why", None))
    change = life.run_status_update(state, c, NOW, ["seq"], require_message=True)
    rows = by_run(change.state)
    assert (rows["r1"].status, rows["r2"].status) == ("running", "failed")


def test_start_and_finish(spark, state):
    c = spark.createDataFrame([("r9", "a", None, 1), ("r1", "a", None, 1)],
                              "run_id string, pipeline_id string, start_time timestamp, seq int")
    started = life.start_runs(state, c, NOW, ["seq"])
    assert (by_run(started.state)["r9"].status, by_run(started.state)["r9"].start_time) == ("running", NOW)
    created = by_run(life.create_runs(state, c, NOW, ["seq"]).state)["r9"]
    assert (created.status, created.created_at) == ("pending", NOW)
    done = life.finish_runs(started.state, commands(spark, ("r1", "success", None, None), ("r2", "running", None, None)), NOW, ["seq"])
    rows = by_run(done.state)
    assert rows["r1"].duration_seconds == Decimal(7200) and rows["r2"].status == "running"
    assert {(r.run_id, r.outcome) for r in done.outcomes.collect()} == {("r1", "applied"), ("r2", "invalid")}


def test_cancel_running(spark, state):
    change = life.cancel_running(state, NOW, spark.createDataFrame([("a",)], "pipeline_id string"), by="ann")
    assert {r.error_message for r in change.state.collect()} == {"Cancelled by ann"}
    assert change.outcomes.count() == 5
    assert life.cancel_running(state, NOW, spark.createDataFrame([("b",)], "pipeline_id string")).outcomes.count() == 0
    assert {r.error_message for r in life.cancel_running(state, NOW).state.collect()} == {"Cancelled"}


def run_ids(spark):
    return spark.createDataFrame([("r1", "a"), ("r2", "a")], "run_id string, pipeline_id string")


STAGE = "run_id string, pipeline_id string, seq int, stage_name string, status string, records_processed bigint"


def stages(spark):
    return spark.createDataFrame(
        [("r1", "a", -3, "load", "running", None), ("r1", "a", -2, "load", "old", None), ("r1", "a", -1, "sink", "pending", None)], STAGE)


def stage_commands(spark):
    return spark.createDataFrame(
        [("r1", "a", 2, ("load", "completed", 5000)), ("r1", "a", 1, ("load", "half", 1)),
         ("r1", "a", 3, ("new", "running", 0)), ("r2", "a", 1, ("only", "running", 0)),
         ("r1", "a", 4, ("", "x", 0)), ("zz", "a", 1, ("s", "x", 0))],
        "run_id string, pipeline_id string, seq int, stage struct<stage_name: string, status: string, records_processed: bigint>")


def listed(entries, run):
    placed = life.positions(entries, life.KEYS, ["seq"]).where(F.col("run_id") == run).orderBy("pos").collect()
    assert [r.pos for r in placed] == list(range(len(placed)))
    return [(r.stage_name, r.status, r.records_processed) for r in placed]


def test_stage_upsert_replaces_in_place(spark):
    change = life.stage_upsert(run_ids(spark), stages(spark), stage_commands(spark), NOW, ["seq"])
    assert listed(change.entries, "r1") == [
        ("load", "completed", 5000), ("load", "old", None), ("sink", "pending", None), ("new", "running", 0)]
    assert listed(change.entries, "r2") == [("only", "running", 0)] and listed(change.entries, "zz") == []
    found = {(r.run_id, r.outcome, r.reason, r.commands) for r in change.outcomes.collect()}
    assert found == {("r1", "applied", None, 3), ("r1", "invalid", "stage_name missing", 1),
                     ("r2", "applied", None, 1), ("zz", "not_found", None, 1)}


def test_stage_append_keeps_every_command(spark):
    change = life.stage_append(run_ids(spark), stages(spark), stage_commands(spark), NOW, ["seq"])
    assert [s[1] for s in listed(change.entries, "r1")] == ["running", "old", "pending", "half", "completed", "running"]


def test_appended_stage_gets_the_clock_where_stages_hold_one(spark):
    old = spark.createDataFrame([], "run_id string, pipeline_id string, seq int, stage_name string, timestamp timestamp")
    done = life.stage_append(run_ids(spark), old, stage_commands(spark), NOW, ["seq"]).entries
    assert {r.timestamp for r in done.collect()} == {NOW} and done.count() == 4


def test_many_stages_are_alike_in_one_batch_and_in_four(spark):
    """20,000 stages of one run: no batch is too large, and the cut of the log is not seen."""
    c = spark.range(20_000).selectExpr(
        "'r2' AS run_id", "'a' AS pipeline_id", "CAST(id AS INT) AS seq",
        "named_struct('stage_name', concat('s', id % 15000), 'status', concat('x', id), 'records_processed', id) AS stage")
    whole = life.stage_upsert(run_ids(spark), stages(spark), c, NOW, ["seq"])
    assert {(r.outcome, r.commands) for r in whole.outcomes.collect()} == {("applied", 20_000)}
    parts = stages(spark)
    for k in range(4):
        parts = life.stage_upsert(run_ids(spark), parts, c.where(f"seq div 5000 = {k}"), NOW, ["seq"]).entries
    assert whole.entries.exceptAll(parts).count() == 0 and parts.count() == 15_003


def test_stage_values_that_do_not_fit_are_invalid(spark):
    c = spark.createDataFrame([("r1", "a", 1, ("load", "done", "many")), ("r1", "a", 2, ("sink", "done", "7"))],
                              "run_id string, pipeline_id string, seq int, stage struct<stage_name: string, status: string, records_processed: string>")
    change = life.stage_upsert(run_ids(spark), stages(spark), c, NOW, ["seq"])
    assert listed(change.entries, "r1") == [("load", "running", None), ("load", "old", None), ("sink", "done", 7)]
    assert {(r.outcome, r.reason) for r in change.outcomes.collect()} == {("invalid", "records_processed is not bigint"), ("applied", None)}


def test_metrics_merge(spark):
    old = spark.createDataFrame([("r1", "a", "x", 1)], "run_id string, pipeline_id string, name string, value bigint")
    c = spark.createDataFrame([("r1", "a", {"x": 2, "y": 3}, 1), ("r1", "a", {"y": 4}, 2), ("r2", "a", {}, 1), ("zz", "a", {"q": 1}, 1)],
                              "run_id string, pipeline_id string, metrics map<string,bigint>, seq int")
    change = life.metrics_merge(run_ids(spark), old, c, NOW, ["seq"])
    assert {(r.run_id, r.name, r.value) for r in change.entries.collect()} == {("r1", "x", 2), ("r1", "y", 4)}
    assert {(r.run_id, r.outcome) for r in change.outcomes.collect()} == {("r1", "applied"), ("r2", "invalid"), ("zz", "not_found")}


def test_record_outputs(spark):
    state = spark.createDataFrame([("r1", "a", 5, AT), ("r2", "a", None, AT)],
                                  "run_id string, pipeline_id string, total_records_processed bigint, updated_at timestamp")
    old = spark.createDataFrame([("r1", "a", "t1", 5)], "run_id string, pipeline_id string, table_id string, records bigint")
    c = spark.createDataFrame([("r1", "a", "t1", 10), ("r1", "a", "t2", 1), ("r2", "a", "t3", 7), ("zz", "a", "t", 1)],
                              "run_id string, pipeline_id string, table_id string, records bigint")
    change = life.record_outputs(state, old, c, NOW)
    rows = by_run(change.state)
    assert (rows["r1"].total_records_processed, rows["r2"].total_records_processed, rows["r2"].updated_at) == (16, 7, NOW)
    assert {(r.run_id, r.table_id, r.records) for r in change.entries.collect()} == {("r1", "t1", 15), ("r1", "t2", 1), ("r2", "t3", 7)}


# -- fold -------------------------------------------------------------------------------

EVENTS = ("run_id string, pipeline_id string, seq bigint, ts timestamp, status string, "
          "error_message string, end_time timestamp, records bigint")


def brute_force(events):
    """One event after another, as a live job would have applied them."""
    runs = {}
    for run, pipeline, seq, ts, status, message, end, records in sorted(events, key=lambda e: e[2]):
        row = runs.setdefault((run, pipeline), {
            "status": "pending", "start": ts, "end": None, "duration": None, "message": None, "records": None, "n": 0})
        row["n"] += 1
        row["updated"] = ts
        if status:
            row["status"] = status
        if message:
            row["message"] = message
        if status in ("success", "failed", "cancelled"):
            row["end"] = end or ts
            row["duration"] = Decimal((row["end"] - row["start"]) // timedelta(microseconds=1)) / 1_000_000
        elif end:
            row["end"] = end
        if records is not None:
            row["records"] = (row["records"] or 0) + records
    return runs


def random_events(seed, n=300):
    rnd = random.Random(seed)
    return [(f"r{rnd.randint(0, 12)}", "a", i, AT + timedelta(seconds=i, microseconds=rnd.randint(0, 9)),
             rnd.choice([None, "pending", "running", "success", "failed", "cancelled", "skipped"]),
             rnd.choice([None, "", f"m{i}"]), rnd.choice([None, AT + timedelta(hours=i)]),
             rnd.choice([None, i])) for i in range(n)]


def as_dict(df):
    return {(r.run_id, r.pipeline_id): {
        "status": r.status, "start": r.start_time, "end": r.end_time, "duration": r.duration_seconds,
        "message": r.error_message, "records": r.total_records_processed, "n": r.events, "updated": r.updated_at,
    } for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_equals_brute_force(spark, seed):
    events = random_events(seed)
    shuffled = random.Random(seed).sample(events, len(events))
    found = as_dict(life.fold_events(spark.createDataFrame(shuffled, EVENTS), ["seq"]))
    assert found == brute_force(events)


def test_folds_merge_in_any_split(spark):
    events = random_events(7)
    whole = spark.createDataFrame(events, EVENTS)
    keys = list(life.KEYS)
    parts = [life.partial_fold(whole.where(F.col("seq") % 3 == i), keys, ["seq"]) for i in (2, 0, 1)]
    merged = life.merge_folds(parts[0].unionByName(parts[1]).unionByName(parts[2]), keys)
    assert as_dict(life.finish_fold(merged, keys)) == brute_force(events)


def test_folds_laid_over_a_state(spark, state):
    events = spark.createDataFrame(
        [("r1", "a", 1, NOW, "success", None, None, None), ("new", "a", 1, NOW, "running", None, None, None)], EVENTS)
    rows = by_run(life.apply_folds(state, life.partial_fold(events, life.KEYS, ["seq"])))
    assert len(rows) == 6 and rows["r1"].status == "success" and rows["r1"].start_time == AT
    assert rows["r1"].duration_seconds == Decimal(7200) and rows["r1"].updated_at == NOW
    assert rows["new"].status == "running" and rows["r2"].status == "running"


@pytest.mark.parametrize("seed", [4, 5])
def test_a_state_goes_on_from_later_events(spark, seed):
    events = random_events(seed)
    whole = spark.createDataFrame(events, EVENTS)
    before = life.fold_events(whole.where("seq < 120"), ["seq"])
    after = life.partial_fold(whole.where("seq >= 120"), life.KEYS, ["seq"])
    found = as_dict(life.apply_folds(before.withColumn("events", F.lit(0)), after).withColumn("events", F.lit(0)))
    assert found == {k: {**v, "n": 0} for k, v in brute_force(events).items()}


# -- entries that do not fit, and entries that stay where they are -------------------------

def test_orders_keys_and_values_of_entries_that_do_not_fit(spark):
    s = spark.createDataFrame([(1,), (2,)], "run_id bigint")
    stages = spark.createDataFrame([(1, 0, "a", 5)], "run_id bigint, seq int, stage_name string, n bigint")
    c = spark.createDataFrame([("1", "7", ("b", "2.5")), ("1", "later", ("c", "3")), ("x", "8", ("d", "4")), ("2", "9", ("e", "6"))],
                              "run_id string, seq string, stage struct<stage_name:string,n:string>")
    for change in (life.stage_append(s, stages, c, NOW, ["seq"], ["run_id"]), life.stage_upsert(s, stages, c, NOW, ["seq"], ["run_id"])):
        assert sorted((tuple(r) for r in change.outcomes.collect()), key=repr) == sorted([
            (1, "invalid", "n is not bigint", 1), (1, "invalid", "seq is not int", 1), (2, "applied", None, 1),
            (None, "invalid", "run_id is not bigint", 1)], key=repr)
        assert sorted(tuple(r) for r in change.entries.collect()) == [(1, 0, "a", 5), (2, 9, "e", 6)]
    metrics = spark.createDataFrame([(1, "m", 5)], "run_id bigint, name string, value bigint")
    m = spark.createDataFrame([("1", 1, {"m": "2.5"}), ("2", 1, {"m": "6"}), ("x", 1, {"m": "6"})], "run_id string, seq int, metrics map<string,string>")
    merged = life.metrics_merge(s, metrics, m, NOW, ["seq"], ["run_id"])
    assert {(r.run_id, r.outcome, r.reason) for r in merged.outcomes.collect()} == {
        (1, "invalid", "metrics{} is not bigint"), (2, "applied", None), (None, "invalid", "run_id is not bigint")}
    assert sorted(tuple(r) for r in merged.entries.collect()) == [(1, "m", 5), (2, "m", 6)]
    state = s.withColumn("total_records_processed", F.lit(0).cast("bigint"))
    outputs = spark.createDataFrame([(1, 7, 5)], "run_id bigint, table_id bigint, records bigint")
    o = spark.createDataFrame([("1", "7", "1.5"), ("1", "7", "2"), ("2", "t", "3"), ("x", "7", "3")], "run_id string, table_id string, records string")
    done = life.record_outputs(state, outputs, o, NOW, ["run_id"])
    assert {(r.run_id, r.outcome, r.reason) for r in done.outcomes.collect()} == {
        (1, "invalid", "records is not bigint"), (1, "applied", None), (2, "invalid", "table_id is not bigint"),
        (None, "invalid", "run_id is not bigint")}
    assert [tuple(r) for r in done.entries.collect()] == [(1, 7, 7)]


def test_status_changes_that_do_not_fit(spark):
    s = spark.createDataFrame([(1, "running", NOW, None, None, None)],
                              "run_id bigint, status string, start_time timestamp, end_time timestamp, error_message string, duration_seconds double")
    c = spark.createDataFrame([("1", "success", "soon", 1), ("y", "success", None, 1)], "run_id string, status string, end_time string, seq int")
    change = life.run_status_update(s, c, NOW, ["seq"], ["run_id"])
    assert {(r.run_id, r.outcome, r.reason) for r in change.outcomes.collect()} == {
        (1, "invalid", "end_time is not timestamp"), (None, "invalid", "run_id is not bigint")}
    assert change.state.first().status == "running"
    owned = s.withColumn("pipeline_id", F.lit(4))
    for owner, status in (("z", "running"), ("4", "cancelled")):
        owners = spark.createDataFrame([(owner,)], "pipeline_id string")
        assert life.cancel_running(owned, NOW, owners, keys=["run_id"]).state.first().status == status


def test_only_the_first_stage_of_a_name_is_replaced(spark):
    s = spark.createDataFrame([(1,)], "run_id bigint")
    stages = spark.createDataFrame([(1, 0, "a", 1), (1, 0, "a", 2), (1, 3, "a", 3), (1, None, "b", 4), (1, 1, "b", 5)],
                                   "run_id bigint, seq int, stage_name string, n bigint")
    c = spark.createDataFrame([(1, 9, ("a", 70)), (1, 8, ("b", 80)), (1, 7, ("c", 90))], "run_id bigint, seq int, stage struct<stage_name:string,n:bigint>")
    found = life.stage_upsert(s, stages, c, NOW, ["seq"], ["run_id"]).entries.collect()
    assert sorted(((r.stage_name, r.seq) for r in found), key=repr) == sorted(
        [("a", 0), ("a", 0), ("a", 3), ("b", None), ("b", 1), ("c", 7)], key=repr)
    changed = {(r.stage_name, r.seq): r.n for r in found if r.n >= 70}
    assert changed == {("a", 0): 70, ("b", None): 80, ("c", 7): 90} and sum(r.n >= 70 for r in found) == 3
