"""Run life cycle: status changes, stages, metrics, cancellation and the event fold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from opsframe.functions.fits import fitted, misfit_at
from opsframe.functions.predicates import col, literal, literal_for
from opsframe.functions.rules import failed_message_ok
from opsframe.functions.times import seconds_between
from opsframe.operators.joins import HASH, split_join
from opsframe.operators.write import (
    Change, _sound, clock, folded_sound, hits, insert_if_absent, keyed, misfit, stamped, update_outcomes, valued,
)
from opsframe.schema import RUN_STATUSES, TERMINAL_STATUSES
from opsframe.sources.storage import saved

KEYS = ("run_id", "pipeline_id")


def is_terminal(status: Column) -> Column:
    return status.isin(*TERMINAL_STATUSES)


def _optional(c: DataFrame, name: str, kind: str) -> Column:
    return col(name) if name in c.columns else F.lit(None).cast(kind)


def _last(value: Column, when: Column, order: Column) -> Column:
    return F.max_by(value, F.when(when, order))


# -- status -----------------------------------------------------------------------------

def run_status_update(s: DataFrame, c: DataFrame, as_of, order: Sequence[str],
                      keys: Sequence[str] = KEYS, end_sets_duration: bool = False,
                      require_message: bool = False, terminal_only: bool = False) -> Change:
    """Status changes: ``status`` and optionally ``error_message`` and ``end_time``.

    A terminal status closes the run: its end is the given one or the clock, and its
    duration the seconds since the start. Any other status takes an end only if one is
    given, which sets the duration too with ``end_sets_duration``. ``skipped`` is not
    terminal. An empty message changes nothing.
    """
    keys = list(keys)
    c = valued(keyed(c, s, keys), s, ["status", "error_message", "end_time"])
    status = F.col("status")
    message = _optional(c, "error_message", "string")
    given_end = _optional(c, "end_time", s.schema["end_time"].dataType.simpleString())
    bad = F.when(~F.coalesce(status.isin(*RUN_STATUSES), F.lit(False)), F.lit("unknown status"))
    if terminal_only:
        bad = bad.when(~is_terminal(status), F.lit("status is not terminal"))
    if require_message:
        bad = bad.when(~failed_message_ok(status, message), F.lit("failed needs a message"))

    bad = F.coalesce(misfit(c), bad)
    now = literal_for(s, "end_time", as_of)
    seq = F.struct(*order)
    end = F.when(is_terminal(status), F.coalesce(given_end, now)).otherwise(given_end)
    closes = end.isNotNull() if end_sets_duration else is_terminal(status)
    folded = folded_sound(c, keys, bad, lambda ok: [
        _last(status, ok, seq).alias("_status"),
        _last(message, ok & (message != ""), seq).alias("_message"),
        _last(end, ok & end.isNotNull(), seq).alias("_end"),
        _last(end, ok & closes, seq).alias("_closed"),
    ])
    joined = s.join(folded, keys, "left")
    hit = F.col("_status").isNotNull()
    changed = {
        "status": F.coalesce("_status", "status"),
        "end_time": F.coalesce("_end", "end_time"),
        "error_message": F.coalesce("_message", "error_message"),
        "updated_at": F.when(hit, clock(s, "updated_at", as_of)).otherwise(col("updated_at"))
        if "updated_at" in s.columns else None,
        "duration_seconds": F.coalesce(
            seconds_between(F.col("start_time"), F.col("_closed"))
            .cast(s.schema["duration_seconds"].dataType), F.col("duration_seconds"))
        if "duration_seconds" in s.columns else None,
    }
    state = joined.select(*[
        (changed[n] if changed.get(n) is not None else col(n)).alias(n) for n in s.columns])
    return Change(state, update_outcomes(s, c, keys, bad))


def start_runs(s: DataFrame, c: DataFrame, as_of, order: Sequence[str],
               keys: Sequence[str] = KEYS, status: str = "running") -> Change:
    """Insert runs; the start defaults to the clock."""
    return insert_if_absent(
        s, c.drop("status"), keys, as_of, order,
        {"status": F.lit(status), "start_time": literal_for(s, "start_time", as_of)})


def create_runs(s: DataFrame, c: DataFrame, as_of, order: Sequence[str],
                keys: Sequence[str] = KEYS) -> Change:
    """Insert runs; the status defaults to pending and the start to the clock."""
    return insert_if_absent(
        s, c, keys, as_of, order,
        {"status": F.lit("pending"), "start_time": literal_for(s, "start_time", as_of)})


def finish_runs(s: DataFrame, c: DataFrame, as_of, order: Sequence[str],
                keys: Sequence[str] = KEYS) -> Change:
    """Close runs at the clock; a status that is not terminal is invalid."""
    return run_status_update(s, c.drop("end_time"), as_of, order, keys, terminal_only=True)


def cancel_running(s: DataFrame, as_of, pipelines: DataFrame | None = None, by: str | None = None,
                   keys: Sequence[str] = KEYS) -> Change:
    """Cancel the running runs of the pipelines, or of all.

    Only running runs meet the pipelines; all others are passed on where they are.
    """
    running = F.coalesce(F.col("status") == "running", F.lit(False))
    picked, rest, go = s, None, running
    if pipelines is not None:
        wanted = keyed(pipelines, s, ["pipeline_id"]).select("pipeline_id").distinct().withColumn("_hit", F.lit(True))
        picked, rest = split_join(s.where(running), wanted, ["pipeline_id"], "left"), s.where(~running)
        go = F.col("_hit").isNotNull()
    now = literal_for(s, "end_time", as_of)
    values = {
        "status": F.lit("cancelled"), "end_time": now,
        "error_message": F.lit(f"Cancelled by {by}" if by else "Cancelled"),
        "duration_seconds": seconds_between(F.col("start_time"), now)
        .cast(s.schema["duration_seconds"].dataType),
        **stamped(s, as_of, "updated_at"),
    }
    marked = picked.withColumn("_go", go)
    state = marked.select(*[
        (F.when(F.col("_go"), values[n]).otherwise(col(n)) if n in values else col(n)).alias(n)
        for n in s.columns])
    if rest is not None:
        state = rest.unionByName(state)
    outcomes = marked.where("_go").select(
        *keys, F.lit("applied").alias("outcome"), F.lit(None).cast("string").alias("reason"),
        F.lit(1).cast("bigint").alias("commands"))
    return Change(state, outcomes)


# -- entries of a run -------------------------------------------------------------------

class Nested(NamedTuple):
    """The runs, stamped; the table of their entries; what became of the commands."""

    state: DataFrame
    entries: DataFrame
    outcomes: DataFrame


# Stages, metrics and outputs are tables of one row per entry. A run may have any number of
# them, a batch may be cut into any batches, and nothing is gathered into a row. Commands are
# reduced first, into the shared folder: there Spark knows their size before it plans, so that
# few of them are broadcast and the entries and runs are only scanned.

def _touched(s: DataFrame, sound: DataFrame, keys: list[str], as_of) -> DataFrame:
    stamps = stamped(s, as_of, "updated_at")
    if not stamps:
        return s
    named = sound.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return s.join(named, keys, "left").select(*[
        (F.when(F.col("_hit"), stamps[n]).otherwise(col(n)) if n in stamps else col(n)).alias(n)
        for n in s.columns])


def _of_known_runs(rows: DataFrame, s: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of runs that the state has, which has a run once."""
    return split_join(rows, s.select(*keys), keys, "inner").drop(HASH)


def _entries_merged(entries: DataFrame, new: DataFrame, on: list[str], values: Mapping[str, Column]) -> DataFrame:
    """The entries with ``new`` laid over them, which has a ``_new`` for each of its keys
    ``on``: the ``values`` of those it names are made anew, and those not there are added,
    as from an entry of nulls. Equal entries of a key would all take the value."""
    known = entries.join(new.select(*on, "_new"), on, "left").select(*[
        (F.when(F.col("_new").isNotNull(), values[n]).otherwise(col(n)) if n in values else col(n)).alias(n)
        for n in entries.columns])
    absent = {f.name: F.lit(None).cast(f.dataType) for f in entries.schema.fields if f.name not in on}
    there = entries.select(*on).join(new.select(*on), on, "left_semi")
    added = new.join(there, on, "left_anti").withColumns(absent).select(*[
        (values[n] if n in values else col(n)).alias(n) for n in entries.columns])
    return known.unionByName(added)


def _stage_fields(entries: DataFrame, keys, order) -> list[T.StructField]:
    return [f for f in entries.schema.fields if f.name not in (*keys, *order)]


def _stage_kinds(c: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in c.schema["stage"].dataType.fields}


def _bad_stage(c: DataFrame, fields: list[T.StructField]) -> Column:
    """The name has to be given, and every value has to fit the stages' columns."""
    stage, given = F.col("stage"), _stage_kinds(c)
    bad = F.when(stage["stage_name"].isNull() | (stage["stage_name"] == ""), F.lit("stage_name missing"))
    unfit = [misfit_at(stage[f.name], given[f.name], f.dataType, f.name) for f in fields if f.name in given]
    return F.coalesce(bad, misfit(c), *unfit)


def _as_entry(c: DataFrame, fields: list[T.StructField], stage: Column) -> list[Column]:
    given = _stage_kinds(c)
    return [(fitted(stage[f.name], given[f.name], f.dataType) if f.name in given else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in fields]


def stage_upsert(s: DataFrame, stages: DataFrame, c: DataFrame, as_of, order: Sequence[str],
                 keys: Sequence[str] = KEYS) -> Nested:
    """A stage replaces the first of its name in place, or is added at the end.

    ``stages`` has a row for each stage of a run: the keys, the ``order`` columns of the
    command that added it, which are its place, ``stage_name`` and what else a stage has.
    Commands are first reduced to the last one per run and stage name. Only the entries of
    these names are put in order to find the first; the others stay where they are.
    """
    keys, order = list(keys), list(order)
    fields = _stage_fields(stages, keys, order)
    c = valued(keyed(c, s, keys), stages, order)
    bad = _bad_stage(c, fields)
    sound = _sound(c, keys, bad)
    name = [f for f in fields if f.name == "stage_name"]
    on = [*keys, "stage_name"]
    last = (
        sound.groupBy(*keys, *_as_entry(c, name, F.col("stage")))
        .agg(F.min(F.struct(*order)).alias("_place"), F.max(F.struct(*order, "stage"))["stage"].alias("_stage"))
    )
    new = saved(_of_known_runs(last, s, keys), "stages")
    named = new.select(*on)
    nth = F.row_number().over(Window.partitionBy(*on).orderBy(*order))
    old = stages.join(named, on, "left_semi").withColumns({"_nth": nth, "_old": F.lit(True)})
    told = {f.name: e for f, e in zip(fields, _as_entry(c, fields, F.col("_stage")), strict=True)}
    met = old.join(new.withColumn("_nth", F.lit(1)), [*on, "_nth"], "full_outer").select(*[
        (F.when(F.col("_old"), col(n)).otherwise(F.col("_place")[n]) if n in order
         else F.when(F.col("_stage").isNotNull(), told[n]).otherwise(col(n)) if n in told and n != "stage_name"
         else col(n)).alias(n) for n in stages.columns])
    entries = stages.join(named, on, "left_anti").select(*stages.columns).unionByName(met)
    return Nested(_touched(s, sound, keys, as_of), entries, update_outcomes(s, c, keys, bad))


def stage_append(s: DataFrame, stages: DataFrame, c: DataFrame, as_of, order: Sequence[str],
                 keys: Sequence[str] = KEYS) -> Nested:
    """Every stage is added at the end, in command order, whatever its name.

    Where the stages hold a ``timestamp``, a stage without one gets the clock.
    """
    keys, order = list(keys), list(order)
    fields = _stage_fields(stages, keys, order)
    c = valued(keyed(c, s, keys), stages, order)
    bad = _bad_stage(c, fields)
    sound = _sound(c, keys, bad)
    new = _of_known_runs(sound, s, keys).select(*keys, *order, *_as_entry(c, fields, F.col("stage")))
    kinds = {f.name: f.dataType for f in fields}
    if "timestamp" in kinds:
        new = new.withColumn("timestamp", F.coalesce(
            "timestamp", literal(as_of, kinds["timestamp"]).cast(kinds["timestamp"])))
    return Nested(_touched(s, sound, keys, as_of), stages.unionByName(_typed(new, stages)),
                  update_outcomes(s, c, keys, bad))


def _typed(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def positions(entries: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos") -> DataFrame:
    """The entries with their place in their run, counted from 0.

    Entries are laid out by ranges of (keys, order) in the shared folder, counted by range,
    and ranked within a range, so a run that holds much of the table is split.
    """
    ordered = [*keys, *order]
    laid = saved(entries.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
                 .withColumn("_range", F.spark_partition_id()), "positions")
    counts = laid.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    return laid.withColumn("_rank", F.row_number().over(within) - 1).join(before, [*keys, "_range"]).select(
        *[col(n) for n in entries.columns], (F.col("_rank") + F.col("_before")).alias(name))


def metrics_merge(s: DataFrame, metrics: DataFrame, c: DataFrame, as_of, order: Sequence[str],
                  keys: Sequence[str] = KEYS) -> Nested:
    """Merge each command's ``metrics`` map into the table of (keys, ``name``, ``value``), the
    last value of a name winning."""
    keys, given = list(keys), F.col("metrics")
    c = keyed(c, s, keys)
    wanted = T.MapType(metrics.schema["name"].dataType, metrics.schema["value"].dataType)
    bad = F.when(given.isNull() | (F.size(given) == 0), F.lit("no metrics"))
    bad = F.coalesce(bad, misfit_at(given, c.schema["metrics"].dataType, wanted, "metrics"))
    sound = _sound(c, keys, bad)
    entry = F.explode(fitted(given, c.schema["metrics"].dataType, wanted)).alias("name", "_value")
    last = (sound.select(*keys, *order, entry)
            .groupBy(*keys, "name").agg(F.max(F.struct(*order, "_value")).alias("_new")))
    new = saved(_of_known_runs(last, s, keys), "metrics")
    entries = _entries_merged(metrics, new, [*keys, "name"], {"value": F.col("_new")["_value"]})
    return Nested(_touched(s, sound, keys, as_of), entries, update_outcomes(s, c, keys, bad))


def record_outputs(s: DataFrame, outputs: DataFrame, c: DataFrame, as_of,
                   keys: Sequence[str] = KEYS) -> Nested:
    """Bookkeeping of writes: each command names a ``table_id`` and its ``records``.

    ``outputs`` has a row (keys, ``table_id``, ``records``) for each table a run wrote. Records
    add up there and in the run's ``total_records_processed``.
    """
    keys = list(keys)
    c = valued(keyed(c, s, keys), outputs, ["table_id", "records"])
    bad = F.coalesce(misfit(c), F.when(F.col("table_id").isNull(), F.lit("table_id missing")))
    sound = _sound(c, keys, bad)
    per_table = sound.groupBy(*keys, "table_id").agg(F.sum("records").alias("_records"))
    new = saved(_of_known_runs(per_table, s, keys).withColumn("_new", F.struct("_records")), "outputs")
    added = F.coalesce(F.col("records"), F.lit(0)) + F.coalesce(F.col("_new")["_records"], F.lit(0))
    entries = _entries_merged(outputs, new, [*keys, "table_id"], {"records": added.cast(outputs.schema["records"].dataType)})
    per_run = per_table.groupBy(*keys).agg(F.sum("_records").alias("_sum"), F.lit(True).alias("_hit"))
    values = {
        "total_records_processed": (F.coalesce(F.col("total_records_processed"), F.lit(0))
                                    + F.coalesce(F.col("_sum"), F.lit(0))).cast(s.schema["total_records_processed"].dataType),
        **stamped(s, as_of, "updated_at"),
    }
    state = s.join(per_run, keys, "left").select(*[
        (F.when(F.col("_hit"), values[n]).otherwise(col(n)) if n in values else col(n)).alias(n) for n in s.columns])
    return Nested(state, entries, update_outcomes(s, c, keys, bad))


# -- event log --------------------------------------------------------------------------

def partial_fold(c: DataFrame, keys: Sequence[str], order: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """One row per run that later folds can be merged with.

    Each ``last`` is the greatest (order, value) pair, so that merging two folds is again
    taking the greatest. ``more`` are further aggregates of the caller.
    """
    status, ts = F.col("status"), F.col("ts")
    message = _optional(c, "error_message", "string")
    given_end = _optional(c, "end_time", "timestamp")
    records = _optional(c, "records", "bigint")
    end = F.when(is_terminal(status), F.coalesce(given_end, ts)).otherwise(given_end)

    def pair(value: Column) -> Column:
        return F.struct(*[col(o) for o in order], value.alias("v"))

    return c.groupBy(*keys).agg(
        F.min(pair(ts)).alias("first"),
        F.max(pair(ts)).alias("latest"),
        F.max(F.when(status.isNotNull(), pair(status))).alias("status"),
        F.max(F.when(message != "", pair(message))).alias("message"),
        F.max(F.when(end.isNotNull(), pair(end))).alias("end"),
        F.max(F.when(is_terminal(status), pair(end))).alias("closed"),
        F.sum(records).alias("records"),
        F.count("*").alias("events"),
        *more,
    )


def merge_folds(folds: DataFrame, keys: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    return folds.groupBy(*keys).agg(
        F.min("first").alias("first"),
        *[F.max(n).alias(n) for n in ("latest", "status", "message", "end", "closed")],
        *[F.sum(n).alias(n) for n in ("records", "events")],
        *more,
    )


def finish_fold(folds: DataFrame, keys: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """The run rows of a fold."""
    return folds.select(
        *keys,
        F.coalesce(F.col("status")["v"], F.lit("pending")).alias("status"),
        F.col("first")["v"].alias("start_time"),
        F.col("end")["v"].alias("end_time"),
        seconds_between(F.col("first")["v"], F.col("closed")["v"]).alias("duration_seconds"),
        F.col("message")["v"].alias("error_message"),
        F.col("records").alias("total_records_processed"),
        F.col("first")["v"].alias("created_at"),
        F.col("latest")["v"].alias("updated_at"),
        F.col("events").alias("events"),
        *more,
    )


def fold_events(c: DataFrame, order: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Final run rows from a log of events (``ts``, ``status``, ``error_message``, ...).

    The last status wins; the run starts with its first event; a terminal status fixes end
    and duration; records add up.
    """
    return finish_fold(partial_fold(c, keys, order), keys)


def apply_folds(s: DataFrame, folds: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Lay folds over a state: known runs go on from their row, others are added.

    A known run keeps its start; its records add up; what no event gave stays.
    """
    keys = list(keys)
    fresh = finish_fold(folds.join(hits(s, folds, keys), keys, "left_anti"), keys)
    told = folds.select(*keys, F.struct(*[n for n in folds.columns if n not in keys]).alias("_f"))
    new = {n: F.col("_f")[n]["v"] for n in ("latest", "status", "message", "end", "closed")}
    records = F.col("_f")["records"]
    values = {
        "status": new["status"], "error_message": new["message"], "end_time": new["end"],
        "updated_at": new["latest"],
        "duration_seconds": seconds_between(F.col("start_time"), new["closed"]),
        "total_records_processed":
            records + F.coalesce(_optional(s, "total_records_processed", "bigint"), F.lit(0)),
    }
    kept = s.join(told, keys, "left").select(*[
        (F.coalesce(values[n].cast(s.schema[n].dataType), col(n)) if n in values else col(n)).alias(n)
        for n in s.columns])
    aligned = fresh.select(*[
        col(f.name).cast(f.dataType).alias(f.name) for f in s.schema.fields if f.name in fresh.columns])
    return kept.unionByName(aligned, allowMissingColumns=True)
