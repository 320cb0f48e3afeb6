"""Instants, zones and durations as columns.

Instants are UTC. A TIMESTAMP_NTZ column holds the UTC wall clock; text is parsed with
its own offset, or as UTC when it has none.
"""

from __future__ import annotations

from collections.abc import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsframe.functions.predicates import col

_ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def check_zone(zone: str) -> str:
    """An unknown zone name fails here, and not in a task."""
    try:
        ZoneInfo(zone)
    except Exception as error:
        raise ValueError(f"unknown time zone: {zone!r}") from error
    return zone


def naive_to_utc(wall: Column, zone: str = "UTC") -> Column:
    """The UTC wall clock of a naive time read in ``zone``."""
    return F.convert_timezone(F.lit(check_zone(zone)), F.lit("UTC"), wall)


def to_zone(utc: Column, zone: str | None) -> Column:
    """The wall clock of ``zone`` for a UTC time; no zone leaves the column as it is."""
    if zone is None:
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(check_zone(zone)), utc.cast("timestamp_ntz"))


# A date, or a date and a time of day; a time alone would depend on today.
_ISO = (r"\A\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?(Z|[+-]\d{2}(:?\d{2}(:\d{2})?)?)?)?\z")


def parse_iso(text: Column) -> Column:
    """ISO text with ``Z``, an offset or neither, as an instant; null where it is not one."""
    return F.when(text.rlike(_ISO), F.try_to_timestamp(text))


def format_iso(utc: Column) -> Column:
    """``2024-01-15T12:00:00+00:00``, with six decimals only when there are any."""
    wall = utc.cast("timestamp_ntz")
    micros = F.date_format(wall, "SSSSSS")
    return F.concat(
        F.date_format(wall, _ISO_SECONDS),
        F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)),
        F.lit("+00:00"),
    )


def micros(instant: Column) -> Column:
    return F.unix_micros(instant.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    """Exact seconds as a decimal; negative when the end comes first."""
    return ((micros(end) - micros(start)).cast("decimal(28,0)") / F.lit(1000000)).cast("decimal(38,18)")


def day_in_zone(utc: Column, zone: str | None = None) -> Column:
    return F.to_date(to_zone(utc, zone))


_TIMES = (T.TimestampType, T.TimestampNTZType)


def _times_of(kind: T.StructType, kinds=_TIMES) -> list[str]:
    return [f.name for f in kind.fields if isinstance(f.dataType, kinds)]


def map_times(df: DataFrame, change, columns: Sequence[str] | None = None, kinds=_TIMES,
              nested: Sequence[str] = ("stages",)) -> DataFrame:
    """Apply ``change`` to the time columns and to the times inside nested lists of structs."""
    names = _times_of(df.schema, kinds)
    chosen = {c: change(col(c)) for c in names if columns is None or c in columns}
    for name in nested:
        kind = df.schema[name].dataType if name in df.columns else None
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            inner = _times_of(kind.elementType, kinds)
            if inner:
                chosen[name] = F.transform(col(name), lambda s: _changed(s, inner, change))
    return df.withColumns(chosen) if chosen else df


def _changed(row: Column, names: Sequence[str], change) -> Column:
    for name in names:
        row = row.withField(name, change(row[name]))
    return row


def in_zone(df: DataFrame, zone: str | None, columns: Sequence[str] | None = None) -> DataFrame:
    """Display read: wall clocks of ``zone`` and the zone's name beside them."""
    if zone is None:
        return df
    return map_times(df, lambda c: to_zone(c, zone), columns).withColumn("time_zone", F.lit(zone))


def to_utc(df: DataFrame, naive_zone: str = "UTC", columns: Sequence[str] | None = None) -> DataFrame:
    """Write boundary: naive times are read in ``naive_zone``; instants are left alone."""
    return map_times(df, lambda c: naive_to_utc(c, naive_zone), columns, T.TimestampNTZType)
