"""Row rules as boolean columns, and the accepted / rejected split.

A rule passes on null unless it is ``required``. All rules of a table are evaluated in one
pass and leave the names of the broken ones in ``errors``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from opsframe.functions.predicates import col
from opsframe.schema import (
    CACHE_LEVELS, DATA_FORMATS, ENDPOINT_TYPES, ENVIRONMENTS, LOCATION_SCHEMES, LOG_LEVELS,
    RUN_STATUSES, TABLE_TYPES, TERMINAL_STATUSES, TRIGGER_TYPES,
)


class Rule(NamedTuple):
    name: str
    ok: Column


# -- single checks ----------------------------------------------------------------------

def id_ok(c: Column) -> Column:
    return F.length(c).between(1, 128) & c.rlike(r"\A[a-zA-Z0-9_-]+\z")


def length_ok(c: Column, low: int, high: int) -> Column:
    return F.length(c).between(low, high)


def semver_ok(c: Column) -> Column:
    # Digits and spaces of any script count, as in the patterns these rules have to match.
    return c.rlike(r"\A\p{Nd}+\.\p{Nd}+\.\p{Nd}+\z")


def range_ok(c: Column, low=None, high=None) -> Column:
    if high is None:
        return c >= low
    return c.between(low, high)


def one_of(c: Column, allowed: Sequence[str]) -> Column:
    return c.isin(*allowed)


def cron_ok(c: Column) -> Column:
    """Five or six parts; an empty expression passes."""
    parts = F.size(F.split(F.regexp_replace(c, r"(?U)\A\s+|\s+\z", ""), r"(?U)\s+"))
    return (c == "") | parts.isin(5, 6)


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def resources_ok(cores: Column, memory_gb: Column) -> Column:
    return ~(_truthy(cores) & _truthy(memory_gb)) | (memory_gb * 2 >= cores)


def location_ok(c: Column) -> Column:
    starts = F.lit(False)
    for scheme in LOCATION_SCHEMES:
        starts = starts | c.startswith(scheme)
    return starts


def lifecycle_ok(retention: Column, archive: Column) -> Column:
    return ~(_truthy(retention) & _truthy(archive)) | (archive < retention)


def timing_ok(start: Column, end: Column) -> Column:
    return end.isNull() | (start.isNotNull() & (end > start))


def failed_message_ok(status: Column, message: Column) -> Column:
    return ~status.eqNullSafe("failed") | (message.isNotNull() & (message != ""))


def counts_ok(processed: Column, failed: Column) -> Column:
    return ~(_truthy(processed) & _truthy(failed)) | (failed <= processed)


def castable(text: Column, kind: str) -> Column:
    """Null, or text that reads as ``kind``."""
    return text.isNull() | text.try_cast(kind).isNotNull()


def default_end_time(status: Column, end: Column, as_of: Column) -> Column:
    """A terminal status without an end gets the clock; this mends, and never rejects."""
    return F.when(end.isNull() & status.isin(*TERMINAL_STATUSES), as_of).otherwise(end)


# -- rule sets of the three domains -----------------------------------------------------

def _required(*names: str) -> list[tuple[str, tuple[str, ...], object]]:
    return [(f"{n}_required", (n,), lambda c: c.isNotNull()) for n in names]


def _lengths(bounds: dict[str, tuple[int, int]]):
    return [(f"{n}_length", (n,), lambda c, b=b: length_ok(c, *b)) for n, b in bounds.items()]


def _domains(allowed: dict[str, Sequence[str]]):
    return [(f"{n}_domain", (n,), lambda c, a=a: one_of(c, a)) for n, a in allowed.items()]


def _ranges(bounds: dict[str, tuple]):
    return [(f"{n}_range", (n,), lambda c, b=b: range_ok(c, *b)) for n, b in bounds.items()]


def _ids(*names: str):
    return [(f"{n}_id", (n,), id_ok) for n in names]


# -- fixed values: the bounds below are those of the stored tables -----------------------

PIPELINE_RULES = [
    *_required("pipeline_id", "pipeline_name", "source_type", "destination_type"),
    *_ids("pipeline_id"),
    *_lengths({"pipeline_name": (1, 256), "description": (0, 1000), "source_type": (1, 50),
               "destination_type": (1, 50), "schedule_expression": (0, 256),
               "created_by": (0, 128), "updated_by": (0, 128)}),
    *_domains({"environment": ENVIRONMENTS, "source_type": ENDPOINT_TYPES,
               "destination_type": ENDPOINT_TYPES}),
    *_ranges({"cpu_cores": (1, 1000), "memory_gb": (0.5, 1000)}),
    ("version_semver", ("version",), semver_ok),
    ("schedule_expression_cron", ("schedule_expression",), cron_ok),
    ("resources", ("cpu_cores", "memory_gb"), resources_ok),
]

TABLE_RULES = [
    *_required("table_id", "pipeline_id", "table_name", "table_type", "data_format", "location"),
    *_ids("table_id", "pipeline_id"),
    *_lengths({"table_name": (1, 256), "location": (1, 1000), "description": (0, 1000),
               "created_by": (0, 128), "updated_by": (0, 128)}),
    *_domains({"table_type": TABLE_TYPES, "data_format": DATA_FORMATS,
               "cache_level": CACHE_LEVELS, "environment": ENVIRONMENTS}),
    *_ranges({"retention_days": (1, 36500), "archive_after_days": (1, 36500)}),
    ("location_scheme", ("location",), location_ok),
    ("lifecycle", ("retention_days", "archive_after_days"), lifecycle_ok),
]

RUN_RULES = [
    *_required("run_id", "pipeline_id", "status", "trigger_type"),
    *_ids("run_id", "pipeline_id"),
    *_lengths({"trigger_type": (1, 50), "spark_application_id": (0, 256),
               "error_message": (0, 2000), "error_stack_trace": (0, 10000),
               "pipeline_version": (0, 50), "spark_version": (0, 50),
               "python_version": (0, 50), "created_by": (0, 128)}),
    *_domains({"status": RUN_STATUSES, "trigger_type": TRIGGER_TYPES,
               "environment": ENVIRONMENTS, "log_level": LOG_LEVELS}),
    *_ranges({"duration_seconds": (0,), "total_records_processed": (0,),
              "total_records_failed": (0,), "input_data_size_bytes": (0,),
              "output_data_size_bytes": (0,), "cpu_hours": (0,), "memory_usage_gb": (0,),
              "retry_count": (0, 10)}),
    ("timing", ("start_time", "end_time"), timing_ok),
    ("failed_message", ("status", "error_message"), failed_message_ok),
    ("counts", ("total_records_processed", "total_records_failed"), counts_ok),
]

STATUS_RULES = [
    *_required("status"),
    *_lengths({"error_message": (0, 2000), "updated_by": (0, 128)}),
    *_domains({"status": RUN_STATUSES}),
    ("failed_message", ("status", "error_message"), failed_message_ok),
]


def bind(df: DataFrame, rules) -> list[Rule]:
    """The rules whose columns the rows hold. A required column left out breaks its rule."""
    present = set(df.columns)
    bound = []
    for name, columns, check in rules:
        if all(c in present for c in columns):
            bound.append(Rule(name, check(*[col(c) for c in columns])))
        elif name.endswith("_required"):
            bound.append(Rule(name, F.lit(False)))
    return bound


def type_rules(texts: DataFrame, kinds: Mapping[str, str]) -> list[Rule]:
    """A rule ``<column>_type`` for each column of texts that are to become values."""
    return [Rule(f"{n}_type", castable(col(n), kind)) for n, kind in kinds.items() if n in texts.columns]


def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows with the names of the rules they break in ``errors``.

    The row passes through a generator, which the optimizer does not see through: whatever
    is asked of ``errors`` afterwards, the rules are worked out once.
    """
    broken = [F.when(~F.coalesce(r.ok, F.lit(True)), F.lit(r.name)) for r in rules]
    errors = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    others = [col(n) for n in df.columns if n != "errors"]
    once = df.select(F.inline(F.array(F.struct(*[col(n) for n in df.columns]))))
    return once.select(F.inline(F.array(F.struct(*others, errors.alias("errors")))))


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def split(df: DataFrame, rules: Sequence[Rule]) -> Split:
    checked = check(df, rules)
    return Split(checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0))
