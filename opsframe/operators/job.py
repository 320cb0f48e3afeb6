"""A table-driven job: its run is recorded as events and folded like any other log.

Events are appended to the log as they happen, so a run is seen while it goes on, after it
failed, and when its driver was lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from opsframe.operators.runs import KEYS, finish_fold, merge_folds, partial_fold
from opsframe.operators.write import Change, update_stats
from opsframe.sources.storage import exists, remove, subfolders

EVENT_DDL = (
    "run_id STRING, pipeline_id STRING, trigger_type STRING, created_by STRING, seq BIGINT, "
    "ts TIMESTAMP, status STRING, error_message STRING, table_id STRING, records BIGINT"
)


def _now() -> datetime:
    return datetime.now(timezone.utc)


class EventLog:
    """A table of run events that any number of jobs append to, and the runs they tell of.

    Every append is a folder of its own, so appending jobs never meet. ``compact`` folds the
    appended events into a new base of one partial row per run and merges their files into
    the history; reading the runs then takes the newest base and what came after it, however
    old the log is. One job at a time compacts. A base counts once it is whole, and names the
    appends it holds, so a compaction that was lost is made again and nothing counts twice.
    What the base before it held is removed then; a reader may go on through one compaction.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def append(self, event: tuple) -> None:
        self.append_all(self.spark.createDataFrame([event], EVENT_DDL).coalesce(1))

    def append_all(self, events: DataFrame) -> None:
        """Append many events (columns as in ``EVENT_DDL``) at once: all or none are seen."""
        kind = self._none().schema
        events.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kind]).write.parquet(
            self._append(uuid.uuid4().hex))

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], EVENT_DDL)

    def _append(self, name: str) -> str:
        return f"{self.path}/tail/event={name}"

    def _whole(self, folder: str, name: str) -> list[str]:
        return [v for v in subfolders(self.spark, folder, name)
                if exists(self.spark, f"{folder}/{name}={v}/_SUCCESS")]

    def _state(self) -> tuple[int, list[str], list[str]]:
        """The newest base (-1: none), the appends it holds and those after it."""
        base = max(map(int, self._whole(f"{self.path}/base", "number")), default=-1)
        held = [] if base < 0 else [
            r["name"] for r in self.spark.read.parquet(f"{self.path}/held/number={base}").collect()]
        return base, held, sorted(set(self._whole(f"{self.path}/tail", "event")) - set(held))

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self._none().schema).parquet(*paths) if paths else self._none()

    def _folds(self, base: int, tail: list[str]) -> DataFrame:
        new = _partial(self._read([self._append(n) for n in tail]))
        if base < 0:
            return new
        return merge_folds(self.spark.read.parquet(f"{self.path}/base/number={base}").unionByName(new), KEYS, (
            F.min("opened").alias("opened"), F.array_distinct(F.flatten(F.collect_list("tables"))).alias("tables")))

    def compact(self) -> int:
        """Fold what was appended since the last base; the number of appends folded."""
        base, held, tail = self._state()
        if tail:
            new = base + 1
            self._read([self._append(n) for n in tail]).repartitionByRange("run_id").sortWithinPartitions(
                "run_id", "seq").write.mode("overwrite").parquet(f"{self.path}/history/number={new}")
            left = [n for n in subfolders(self.spark, f"{self.path}/tail", "event") if n in {*held, *tail}]
            self.spark.createDataFrame([(n,) for n in left], "name string").coalesce(1).write.mode(
                "overwrite").parquet(f"{self.path}/held/number={new}")
            self._folds(base, tail).write.mode("overwrite").parquet(f"{self.path}/base/number={new}")
            for name in held:
                remove(self.spark, self._append(name))
            for kind in ("base", "held"):
                for n in subfolders(self.spark, f"{self.path}/{kind}", "number"):
                    if int(n) < base:
                        remove(self.spark, f"{self.path}/{kind}/number={n}")
        return len(tail)

    def events(self) -> DataFrame:
        """Every event ever appended."""
        base, _, tail = self._state()
        told = [n for n in subfolders(self.spark, f"{self.path}/history", "number") if int(n) <= base]
        return self._read([f"{self.path}/history/number={n}" for n in told] + [self._append(n) for n in tail])

    def runs(self) -> DataFrame:
        """All runs as they stand, with the tables they wrote."""
        base, _, tail = self._state()
        return _finished(self._folds(base, tail))


def _partial(events: DataFrame) -> DataFrame:
    """The fold of some events, with the trigger of the first one and the tables written."""
    opened = F.when(F.col("seq").isNotNull(), F.struct("seq", "trigger_type", "created_by"))
    return partial_fold(events, KEYS, ["seq"], (
        F.min(opened).alias("opened"), F.collect_set("table_id").alias("tables")))


def _finished(folds: DataFrame) -> DataFrame:
    return finish_fold(folds, KEYS, (
        F.col("opened")["trigger_type"].alias("trigger_type"), F.col("opened")["created_by"].alias("created_by"),
        F.sort_array("tables").alias("output_tables")))


def run_rows(events: DataFrame) -> DataFrame:
    """The runs that these events tell of, with the tables they wrote."""
    return _finished(_partial(events))


class JobRun:
    """The events of one running job: a handful of rows made by the driver, each appended to
    the log, if there is one, before the job goes on."""

    def __init__(self, pipeline_id: str, trigger_type: str, created_by: str | None,
                 clock: Callable[[], datetime], log: EventLog | None = None):
        self._log = log
        self.run_id = str(uuid.uuid4())
        self.pipeline_id = pipeline_id
        self.trigger_type = trigger_type
        self.created_by = created_by
        self._clock = clock
        self._events: list[tuple] = []

    def record(self, status: str | None = None, error_message: str | None = None,
               table_id: str | None = None, records: int | None = None) -> None:
        event = (self.run_id, self.pipeline_id, self.trigger_type, self.created_by,
                 len(self._events), self._clock(), status, error_message, table_id, records)
        self._events.append(event)
        if self._log:
            self._log.append(event)

    def wrote(self, table_id: str, records: int) -> None:
        self.record(table_id=table_id, records=records)

    def events(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self._events, EVENT_DDL)

    def run_row(self, spark: SparkSession) -> DataFrame:
        """The finished run, with the tables it wrote."""
        return run_rows(self.events(spark))


@contextmanager
def job_run(pipeline_id: str, trigger_type: str = "manual", created_by: str | None = None,
            clock: Callable[[], datetime] = _now, log: EventLog | None = None) -> Iterator[JobRun]:
    """pending, running, then success; or failed with the message, and the error goes on."""
    run = JobRun(pipeline_id, trigger_type, created_by, clock, log)
    run.record("pending")
    run.record("running")
    try:
        yield run
    except Exception as error:
        run.record("failed", str(error) or type(error).__name__)
        raise
    run.record("success")


def record_write(tables: DataFrame, table_id, records: int, as_of) -> Change:
    """Row count and data time of a table just written."""
    spark = tables.sparkSession
    kind = tables.schema["table_id"].dataType.simpleString()
    told = spark.range(1).select(
        F.lit(table_id).cast(kind).alias("table_id"), F.lit(records).cast("bigint").alias("record_count"),
        F.lit(as_of).cast("timestamp").alias("last_updated_data"), F.lit(0).alias("seq"))
    return update_stats(tables, told, ["table_id"], as_of, ["seq"])
