"""Configured reads and writes, the job wrapper and the streamed fold."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F
from test_runs import EVENTS, as_dict, brute_force, random_events

from opsframe.operators import job, runs as life
from opsframe.schema import TABLES
from opsframe.sources import configured, storage
from opsframe.streaming import fold


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [("cust_001", "2024-01-15", 150.0, "electronics"), ("cust_002", "2024-01-15", 75.5, "books"),
         ("cust_003", "2024-01-15", 220.25, "clothing")],
        "customer_id string, transaction_date string, amount double, category string")


@pytest.mark.parametrize("name,options", [("parquet", {}), ("json", {}), ("csv", {"header": True})])
def test_write_then_read_by_settings(spark, sales, rows, tmp_path, name, options):
    settings = {
        "data_format": name, "location": str(tmp_path / "t"), "partition_columns": ["category"],
        "read_options": options, "write_options": options,
        "schema_definition": {c: {"type": t} for c, t in sales.dtypes},
    }
    assert configured.config_write(sales, settings) == 3
    found = configured.config_read(spark, settings)
    assert rows(found, *sales.columns) == rows(sales)
    assert configured.config_write(sales, settings) == 3  # overwrite is the default
    assert configured.config_read(spark, settings).count() == 3
    assert configured.config_write(sales, {**settings, "write_options": {**options, "mode": "append"}}) == 3
    assert configured.config_read(spark, settings).count() == 6


def test_options_follow_the_settings():
    settings = {"data_format": "csv", "location": "/x", "partition_columns": ["d"],
                "read_options": {"path": "/y", "header": True}, "write_options": {"mode": "append"}}
    assert configured.read_options(settings) == {
        "format": "csv", "path": "/y", "header": True, "partitionColumns": ["d"]}
    assert configured.write_options(settings) == {
        "format": "csv", "path": "/x", "mode": "append", "partitionBy": ["d"]}
    with pytest.raises(ValueError, match="unknown format"):
        configured.read_options({**settings, "data_format": "orc"})


def test_formats_without_their_package_say_so(spark, tmp_path):
    for name in ("avro", "delta"):
        with pytest.raises(RuntimeError, match="needs its Spark package"):
            configured.config_read(spark, {"data_format": name, "location": str(tmp_path)})


def test_cache_levels():
    assert configured.storage_level({"caching_enabled": False, "cache_level": "DISK_ONLY"}) is None
    assert configured.storage_level({"caching_enabled": True, "cache_level": "MEMORY_ONLY_SER"}) == StorageLevel.MEMORY_ONLY
    with pytest.raises(ValueError):
        configured.storage_level({"caching_enabled": True, "cache_level": "HEAP"})


def test_settings_come_from_the_table(spark, sales, tmp_path):
    tables = spark.sql(f"""SELECT 't1' AS table_id, 'parquet' AS data_format, '{tmp_path}/s' AS location,
        parse_json('{json.dumps({"compression": "zstd"})}') AS write_options""")
    settings = configured.table_settings(tables, "t1")
    assert settings["write_options"] == {"compression": "zstd"}
    assert configured.config_write(sales, settings) == 3
    with pytest.raises(KeyError):
        configured.table_settings(tables, "t2")


def test_job_run_records_success_and_failure(spark):
    ticks = iter(datetime(2024, 1, 1) + timedelta(seconds=s) for s in range(100))
    with job.job_run("p", "manual", "ann", clock=lambda: next(ticks)) as run:
        run.wrote("t1", 10)
        run.wrote("t2", 5)
    row = run.run_row(spark).first()
    assert (row.status, row.total_records_processed, row.output_tables) == ("success", 15, ["t1", "t2"])
    assert (row.trigger_type, row.created_by, row.duration_seconds) == ("manual", "ann", 4)
    with pytest.raises(ValueError, match="boom"):
        with job.job_run("p") as broken:
            raise ValueError("boom")
    row = broken.run_row(spark).first()
    assert (row.status, row.error_message) == ("failed", "boom") and row.end_time is not None


def test_runs_without_a_key_and_events_in_any_order(spark):
    at = datetime(2024, 1, 1)
    events = spark.createDataFrame([
        ("r", None, "later", "bob", 1, at, "success", None, "t2", 4), ("r", None, "first", "ann", 0, at, "running", None, "t1", 3)], job.EVENT_DDL)
    row = job.run_rows(events.repartition(2)).first()
    assert (row.run_id, row.pipeline_id, row.status, row.trigger_type, row.created_by) == ("r", None, "success", "first", "ann")
    assert row.output_tables == ["t1", "t2"] and job.run_rows(events).columns.count("run_id") == 1


def test_record_write(spark):
    tables = spark.createDataFrame([("t1", 1, None), ("t2", 2, None)], "table_id string, record_count bigint, last_updated_data timestamp")
    now = datetime(2024, 1, 1)
    rows = {r.table_id: r for r in job.record_write(tables, "t1", 99, now).state.collect()}
    assert (rows["t1"].record_count, rows["t1"].last_updated_data, rows["t2"].record_count) == (99, now, 2)


def test_saved_rows_come_back(spark, sales, rows):
    assert rows(storage.saved(sales, "sales")) == rows(sales)


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert storage.shared_dir(spark) == named.rstrip("/")
        assert storage.new_path(spark, "x").startswith(named.rstrip("/"))


def test_streamed_fold_equals_batch_fold(spark, tmp_path):
    """Events over several files, out of order and late, some delivered twice in other batches;
    the stream is stopped and started again, and compacted on the way."""
    events = random_events(11)
    rnd = random.Random(5)
    sent = rnd.sample(events, len(events)) + rnd.sample(events, 60)
    folder = str(tmp_path / "fold")

    def go(parts):
        for i in parts:
            spark.createDataFrame(sent[i::6], EVENTS).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{i}"))
        stream = (spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", True).parquet(str(tmp_path / "in")))
        fold.start_fold(stream, folder, ["seq"], compact_every=2, availableNow=True).awaitTermination()

    go(range(4))
    assert fold._noted(spark, folder) >= 1
    go(range(4, 6))
    assert spark.read.parquet(f"{folder}/partials").select("batch").distinct().count() < 6  # replaced ones are gone
    assert as_dict(fold.folded(spark, folder)) == brute_force(events)


def test_ids_of_many_batches_stay_in_few_folders(spark, tmp_path):
    """Batches that mix days, repeat ids, are added twice and go on after a restart: an id is
    new once, and a day never holds more than its base and a bounded number of batches."""
    rnd, known, days = random.Random(3), set(), [datetime(2024, 1, d) for d in (1, 2, 3)]
    for number in range(24):
        store = fold.DayIds(spark, str(tmp_path / "ids"), most=4)
        held = rnd.sample(days, 2) if number % 3 else days[:1]
        ids = [(rnd.randrange(60), d) for d in held for _ in range(4)]
        events = spark.createDataFrame([(i + 100 * d.day, d) for i, d in ids], "id bigint, ts timestamp").coalesce(1)
        fresh = {r.id for r in fold._new_events(events, store, number, ["id"])[0].collect()}
        assert fresh == {i + 100 * d.day for i, d in ids} - known
        for _ in range(1 + (number % 10 == 7)):  # a batch that is run again
            new, told = fold._new_events(events, store, number, ["id"])
            assert {r.id for r in new.collect()} == fresh
            store.add(new.select("id", "day"), told, number)
        known |= fresh
        for folder in (tmp_path / "ids").glob("day=*"):
            assert len(list(folder.glob("batch=*"))) <= 5 and len(list(folder.glob("base=*"))) <= 1
    assert sum(1 for _ in (tmp_path / "ids").glob("day=*")) == 3
    listed = store._paths(days[0].date(), 99)
    assert len(listed) <= 6 and all("day=2024-01-01/" in p for p in listed)


def test_a_base_that_is_not_whole_is_not_read(spark, tmp_path):
    store = fold.DayIds(spark, str(tmp_path / "ids"), most=2)
    day = datetime(2024, 1, 1).date()
    for number in range(2):
        store.add(spark.createDataFrame([(number, day)], "id bigint, day date"), [day], number)
    (tmp_path / "ids" / "day=2024-01-01" / "base=1").mkdir()  # a writer was lost here
    assert {r.id for r in store.seen([day], 2).collect()} == {0, 1}
    store.add(spark.createDataFrame([(2, day)], "id bigint, day date"), [day], 2)
    assert {r.id for r in store.seen([day], 3).collect()} == {0, 1, 2}


def test_a_fold_without_events_is_empty(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(EVENTS).parquet(str(tmp_path / "in"))
    query = fold.start_fold(stream, str(tmp_path / "fold"), ["seq"], availableNow=True)
    assert fold.folded(spark, str(tmp_path / "fold")).count() == 0
    query.awaitTermination()


def test_a_run_is_seen_while_it_goes_on_and_after_it_failed(spark, tmp_path):
    log = job.EventLog(spark, str(tmp_path / "log"))
    with pytest.raises(ValueError):
        with job.job_run("p", log=log) as run:
            run.wrote("t", 3)
            assert [(r.status, r.total_records_processed) for r in log.runs().collect()] == [("running", 3)]
            raise ValueError("boom")
    row = log.runs().first()
    assert (row.run_id, row.status, row.error_message) == (run.run_id, "failed", "boom")


def _log_rows(log):
    return sorted(map(tuple, log.runs().collect()), key=repr)


def test_a_compacted_log_tells_the_same_runs(spark, tmp_path):
    """Appends and compactions in any order, as one fold of all events; files stay few."""
    rng, at, told = random.Random(4), datetime(2024, 1, 1), []
    log = job.EventLog(spark, str(tmp_path / "log"))
    assert log.runs().count() == log.events().count() == log.compact() == 0
    for step in range(9):
        new = [(rng.choice(["a", "b", "c", None]), rng.choice(["p", None]), f"trigger {step}", None, 10 * step + k,
                at + timedelta(seconds=rng.randrange(99)), rng.choice(["running", "success", "failed", None]), None,
                rng.choice(["t1", "t2", None]), rng.choice([1, 2, None])) for k in range(rng.randrange(5))]
        told += new
        log.append_all(spark.createDataFrame(new, job.EVENT_DDL).coalesce(1))
        if step % 2:
            assert log.compact() == 2
        whole = spark.createDataFrame(told, job.EVENT_DDL)
        assert _log_rows(log) == sorted(map(tuple, job.run_rows(whole).collect()), key=repr)
        assert sorted(map(tuple, log.events().collect()), key=repr) == sorted(map(tuple, told), key=repr)
    assert len(storage.subfolders(spark, log.path + "/tail", "event")) <= 3
    assert storage.subfolders(spark, log.path + "/base", "number") == ["2", "3"]


@pytest.mark.parametrize("lost_at", ["history", "held", "base", "tail"])
def test_a_lost_compaction_is_made_again(spark, tmp_path, lost_at, monkeypatch):
    log = job.EventLog(spark, str(tmp_path / "log"))

    def add(seq):
        log.append(("r", "p", "manual", None, seq, datetime(2024, 1, 1), "running", None, None, 1))

    for seq in range(3):
        add(seq)
        if seq == 0:
            log.compact()
    with monkeypatch.context() as m:
        if lost_at == "tail":  # lost while it removed what the base before held
            m.setattr(job, "remove", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                log.compact()
        else:  # lost after it wrote that folder, the base without its mark
            log.compact()
            late = {"history": ("held", "base"), "held": ("base",), "base": ()}[lost_at]
            for kind in late:
                storage.remove(spark, f"{log.path}/{kind}/number=1")
            storage.remove(spark, f"{log.path}/base/number=1/_SUCCESS")
    assert (log.runs().first().events, log.events().count()) == (3, 3)
    add(3)
    log.compact()
    add(4)
    assert (log.runs().first().total_records_processed, log.events().count()) == (5, 5)


def test_an_append_that_is_not_whole_is_not_seen(spark, tmp_path):
    log = job.EventLog(spark, str(tmp_path / "log"))
    log.append(("r", "p", "manual", None, 0, datetime(2024, 1, 1), "running", None, None, 1))
    (name,) = storage.subfolders(spark, log.path + "/tail", "event")
    storage.remove(spark, f"{log.path}/tail/event={name}/_SUCCESS")
    assert log.events().count() == log.runs().count() == log.compact() == 0


def test_compaction_changes_no_run(spark, tmp_path):
    events, folder = random_events(13), str(tmp_path)
    whole = spark.createDataFrame(events, EVENTS)

    def batch(i):
        life.partial_fold(whole.where(F.col("seq") % 4 == i), life.KEYS, ["seq"]).write.mode(
            "overwrite").parquet(f"{folder}/partials/batch={i}")

    for i in range(3):
        batch(i)
    fold.compact(spark, folder, 1)
    fold.compact(spark, folder, 1)  # as a batch that is run again would
    batch(3)
    fold.compact(spark, folder, 2)
    assert as_dict(fold.folded(spark, folder)) == brute_force(events)


def test_a_batch_written_again_counts_once(spark, tmp_path):
    events = spark.createDataFrame(random_events(3), EVENTS)
    for _ in range(2):
        life.partial_fold(events, life.KEYS, ["seq"]).write.mode("overwrite").parquet(f"{tmp_path}/partials/batch=0")
    assert as_dict(fold.folded(spark, str(tmp_path))) == brute_force(random_events(3))
