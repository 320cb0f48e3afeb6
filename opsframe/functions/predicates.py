"""Key conditions and filters as boolean columns.

They are plain comparisons on bare columns, so the file scan receives them.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsframe.schema import TableMeta


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def literal(value, kind: T.DataType | None = None) -> Column:
    """``value`` as a literal; instants take the compared column's own time type.

    Comparing a TIMESTAMP_NTZ column with a TIMESTAMP literal would put a cast on the
    column and keep the predicate away from the scan.
    """
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        text = value.isoformat(sep=" ")
        if isinstance(kind, T.TimestampType):
            return F.expr(f"TIMESTAMP_LTZ '{text}+00:00'")
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if isinstance(value, date):
        return F.expr(f"DATE '{value.isoformat()}'")
    return F.lit(value)


def literal_for(df: DataFrame, column: str, value) -> Column:
    return literal(value, df.schema[column].dataType if column in df.columns else None)


# Tables of these columns may be laid out in folders by their UTC day.
DAYS = {"start_time": "day"}


def day_bound(df: DataFrame, column: str, low=None, high=None) -> Column | None:
    """The bound on the day folders that a bound on the instant implies, where the table has
    them; it prunes folders that the instant alone would have opened."""
    day = DAYS.get(column)
    if day not in df.columns or not isinstance(df.schema[day].dataType, T.DateType):
        return None
    parts = []
    for value, after in ((low, True), (high, False)):
        if isinstance(value, datetime):
            utc = value.astimezone(timezone.utc) if value.tzinfo else value
            edge = literal(utc.date())
            parts.append(col(day) >= edge if after else col(day) <= edge)
    return reduce(lambda a, b: a & b, parts) if parts else None


def with_day(condition: Column, df: DataFrame, column: str, low=None, high=None) -> Column:
    bound = day_bound(df, column, low, high)
    return condition if bound is None else bound & condition


_SORT_OPS = {
    "eq": lambda c, low, high: c == low,
    "begins_with": lambda c, low, high: c.startswith(low),
    "between": lambda c, low, high: c.between(low, high),
    "gt": lambda c, low, high: c > low,
    "gte": lambda c, low, high: c >= low,
    "lt": lambda c, low, high: c < low,
    "lte": lambda c, low, high: c <= low,
}


def sort_condition(column: Column, op: str, low, high=None) -> Column:
    if op not in _SORT_OPS:
        raise ValueError(f"unsupported sort condition '{op}'; supported: {', '.join(_SORT_OPS)}")
    if op == "between" and high is None:
        raise ValueError("'between' needs a second value")
    return _SORT_OPS[op](column, low, high)


def key_condition(
    df: DataFrame, partition: str, value, sort: str | None = None,
    op: str = "eq", low=None, high=None,
) -> Column:
    """Partition equality, and a sort condition when a sort value is given."""
    found = col(partition) == literal_for(df, partition, value)
    if sort is None or low is None:
        return found
    found = found & sort_condition(
        col(sort), op, literal_for(df, sort, low),
        None if high is None else literal_for(df, sort, high),
    )
    from_day = low if op in ("eq", "between", "gt", "gte") else None
    to_day = high if op == "between" else low if op in ("eq", "lt", "lte") else None
    return with_day(found, df, sort, from_day, to_day)


def model_condition(df: DataFrame, meta: TableMeta, op: str = "eq", high=None, **values) -> Column:
    """A key condition named by the table's own key columns."""
    partition, *rest = meta.keys
    if partition not in values:
        raise ValueError(f"{meta.name}: missing partition key '{partition}'")
    sort = rest[0] if rest else None
    return key_condition(df, partition, values[partition], sort, op, values.get(sort), high)


def index_condition(
    df: DataFrame, meta: TableMeta, index: str, op: str = "eq", high=None, **values
) -> Column:
    """A key condition named by one of the table's indexes; null index keys stay out."""
    found = meta.index(index)
    if found.partition not in values:
        raise ValueError(f"missing partition key '{found.partition}' for index '{index}'")
    condition = key_condition(
        df, found.partition, values[found.partition], found.sort, op,
        values.get(found.sort), high,
    )
    return condition if found.sort is None else condition & col(found.sort).isNotNull()


def match_all(filters: Mapping | None) -> Column | None:
    """AND of equalities; nothing given means no filter."""
    if not filters:
        return None
    return reduce(
        lambda a, b: a & b,
        (col(k).isNull() if v is None else col(k) == literal(v) for k, v in filters.items()),
    )


def time_range(df: DataFrame, column: str, start=None, end=None) -> Column | None:
    """Inclusive range; each end is optional."""
    parts = []
    if start is not None:
        parts.append(col(column) >= literal_for(df, column, start))
    if end is not None:
        parts.append(col(column) <= literal_for(df, column, end))
    return with_day(reduce(lambda a, b: a & b, parts), df, column, start, end) if parts else None
