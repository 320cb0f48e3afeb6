"""Keyed lookups, index queries, paging and projections.

Every function takes and returns DataFrames; nothing runs until the caller acts, except
``fetch_page`` and ``require``, which bring back at most one page of rows, and
``saved_pages``, which writes every page to the shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from opsframe.functions.predicates import (
    col, index_condition, key_condition, literal_for, match_all, time_range,
)
from opsframe.schema import DEFAULT_PAGE, PIPELINES, RUNS, TABLES, TableMeta
from opsframe.sources.storage import saved


# -- projection -------------------------------------------------------------------------

def project(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The named columns, or all. A name the table does not hold is left out."""
    if not columns:
        return df
    present = set(df.columns)
    return df.select(*[col(c) for c in dict.fromkeys(columns) if c in present])


def view(df: DataFrame, meta: TableMeta) -> DataFrame:
    return project(df, meta.view_columns)


def summary(df: DataFrame, meta: TableMeta) -> DataFrame:
    return project(df, meta.summary_columns)


# -- lookup by key ----------------------------------------------------------------------

def get_many(
    df: DataFrame, meta: TableMeta, keys: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per distinct key with ``found``; absent keys keep null columns.

    The state side is cut to the wanted keys first, so a short key list is sent to the
    state and the state is never shuffled for it.
    """
    meta.require_keys(keys)
    names = list(meta.keys)
    wanted = keys.select(*names).distinct()
    hits = project(df, [*names, *(columns or meta.view_columns)]).join(wanted, names, "left_semi")
    return wanted.join(hits.withColumn("found", F.lit(True)), names, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def get_one(df: DataFrame, meta: TableMeta, columns: Sequence[str] | None = None, **key) -> DataFrame:
    parts = meta.key(**key)
    found = df.where(match_all(parts))
    return project(found, columns or meta.view_columns)


def get_listed(df: DataFrame, meta: TableMeta, keys: Sequence[Mapping], columns: Sequence[str] | None = None) -> DataFrame:
    """``get_many`` for keys that the caller holds, each a mapping of the key's columns.

    The keys become equalities in the scan, which skips the folders and row groups that hold
    none of them. At most 100, as they are part of the plan; more go as a table to
    ``get_many``. A null part finds nothing.
    """
    if len(keys) > 100:
        raise ValueError("more than 100 keys: give them as a table to get_many")
    names = list(meta.keys)
    parts = [meta.key(**k) for k in keys]
    wanted = df.sparkSession.createDataFrame(
        [tuple(p.values()) for p in parts], T.StructType([T.StructField(n, df.schema[n].dataType) for n in names]))
    tests = [reduce(and_, [col(n) == literal_for(df, n, v) for n, v in p.items()])
             for p in parts if None not in p.values()]
    held = df.where(reduce(or_, tests)) if tests else df.limit(0)
    return get_many(held, meta, wanted, columns)


def missing_keys(df: DataFrame, meta: TableMeta, keys: DataFrame) -> DataFrame:
    names = list(meta.keys)
    wanted = meta.require_keys(keys).select(*names).distinct()
    return wanted.join(existing_keys(df, meta, wanted), names, "left_anti")


def existing_keys(df: DataFrame, meta: TableMeta, keys: DataFrame) -> DataFrame:
    names = list(meta.keys)
    return df.select(*names).join(
        meta.require_keys(keys).select(*names).distinct(), names, "left_semi"
    )


def require(df: DataFrame, meta: TableMeta, keys: DataFrame) -> DataFrame:
    """The rows of ``keys``; raises ``KeyError`` naming some of the absent ones."""
    absent = missing_keys(df, meta, keys).take(5)
    if absent:
        raise KeyError(f"{meta.name}: no item for {[r.asDict() for r in absent]}")
    return df.join(keys.select(*meta.keys).distinct(), list(meta.keys), "left_semi")


def query_by_pk(df: DataFrame, meta: TableMeta, value, **options) -> DataFrame:
    """All rows of one partition key."""
    return query(df, meta, key_condition(df, meta.keys[0], value), **options)


# -- ordered queries and paging ---------------------------------------------------------

def _order(order: Sequence[str], ascending: bool, leading: int = 1) -> list[Column]:
    """Direction applies to the sort key; the row key always breaks ties ascending."""
    return [
        col(c).asc() if ascending or i >= leading else col(c).desc() for i, c in enumerate(order)
    ]


def after_token(df: DataFrame, order: Sequence[str], ascending: bool, token: dict) -> Column:
    """Rows strictly after ``token`` in the order; never an offset.

    Spark puts nulls first going up and last going down, and so does this.
    """
    def beyond(i: int, name: str) -> Column:
        up, value = ascending or i > 0, literal_for(df, name, token[name])
        if token[name] is None:
            return col(name).isNotNull() if up else F.lit(False)
        return col(name) > value if up else (col(name) < value) | col(name).isNull()

    def same(name: str) -> Column:
        return col(name).isNull() if token[name] is None else col(name) == literal_for(df, name, token[name])

    options, equal = [], []
    for i, name in enumerate(order):
        options.append(reduce(lambda a, b: a & b, [*equal, beyond(i, name)]))
        equal.append(same(name))
    after = reduce(lambda a, b: a | b, options)
    first = order[0]
    if token[first] is None:
        return after if ascending else col(first).isNull() & after
    edge = literal_for(df, first, token[first])
    # The bare bound on the first column is implied; it is stated for the file scan.
    return (col(first) >= edge if ascending else (col(first) <= edge) | col(first).isNull()) & after


def query(
    df: DataFrame,
    meta: TableMeta,
    condition: Column | None = None,
    *,
    sort: str | None = None,
    where: Column | dict | None = None,
    columns: Sequence[str] | None = None,
    ascending: bool = True,
    limit: int | None = None,
    after: dict | None = None,
    limit_first: bool = False,
) -> DataFrame:
    """Key condition, filter, order, limit and projection, in that order.

    ``limit`` of 0 or None means no limit. ``limit_first`` limits the rows of the key
    condition and filters what is left, so it may return fewer than ``limit`` rows.
    """
    extra = match_all(where) if isinstance(where, dict) else where
    order = ([sort] if sort else []) + [k for k in meta.keys if k != sort]
    rows = df if condition is None else df.where(condition)
    if extra is not None and not limit_first:
        rows = rows.where(extra)
    if after:
        rows = rows.where(after_token(df, order, ascending, after))
    rows = rows.orderBy(*_order(order, ascending))
    if limit:
        rows = rows.limit(limit)
    if extra is not None and limit_first:
        rows = rows.where(extra)
    return project(rows, columns)


def index_query(
    df: DataFrame, meta: TableMeta, index: str, value, *, op: str = "eq", low=None, high=None,
    where: Column | dict | None = None, columns: Sequence[str] | None = None,
    ascending: bool = True, limit: int | None = None, after: dict | None = None,
    limit_first: bool = False,
) -> DataFrame:
    """Rows of one index partition, ordered by the index's sort column."""
    found = meta.index(index)
    values = {found.partition: value}
    if low is not None:
        values[found.sort] = low
    return query(
        df, meta, index_condition(df, meta, index, op, high, **values), sort=found.sort,
        where=where, columns=columns or found.projection, ascending=ascending, limit=limit,
        after=after, limit_first=limit_first,
    )


class Page(NamedTuple):
    rows: list[Row]
    token: dict | None


def fetch_page(df: DataFrame, meta: TableMeta, condition: Column | None = None, *,
               limit: int = DEFAULT_PAGE, columns: Sequence[str] | None = None,
               sort: str | None = None, where: Column | dict | None = None,
               limit_first: bool = False, **options) -> Page:
    """One page and the token of the next: the order values of the last row examined.

    With ``limit_first`` the filter is applied to the page, so rows it leaves out move the
    token on as well, and a page may be short or empty before the last one.
    """
    if not limit or limit < 1:
        raise ValueError("a page needs a positive limit")
    order = ([sort] if sort else []) + [k for k in meta.keys if k != sort]
    wanted = None if not columns else [*columns, *order]
    extra = match_all(where) if isinstance(where, dict) else where
    late = limit_first and extra is not None
    if late:
        df = df.withColumn("_kept", F.coalesce(extra, F.lit(False)))
        wanted = wanted and [*wanted, "_kept"]
    rows = query(df, meta, condition, sort=sort, limit=limit, columns=wanted,
                 where=None if late else extra, **options).collect()
    token = {c: rows[-1][c] for c in order} if len(rows) == limit else None
    if late:
        rows = [Row(**{n: v for n, v in r.asDict().items() if n != "_kept"}) for r in rows if r["_kept"]]
    return Page(rows, token)


class Pages:
    """All pages of a query, made by one sort and one write.

    The rows lie in the shared folder in their order, numbered by partition and place. A
    count per partition, which is all the driver holds, turns the numbers into ranks, and a
    rank into a page. A page is read by the range of numbers it stands for, which skips the
    row groups of all others; nothing is scanned once per page.
    """

    def __init__(self, laid: DataFrame, columns: list[str], order: list[str], size: int, number: str, kept: str | None):
        self._laid, self._columns, self._order, self._size = laid, columns, order, size
        self._number, self._kept = number, kept
        part = F.shiftright(number, 33)
        found = {r["part"]: r["count"] for r in laid.groupBy(part.alias("part")).count().collect()}
        self._counts = [found.get(k, 0) for k in range(max(found, default=-1) + 1)]
        before = [0]
        for n in self._counts:
            before.append(before[-1] + n)
        self._before, self.total = before, before[-1]
        starts = F.array(*[F.lit(b).cast("bigint") for b in before])
        self._rank = F.get(starts, part) + F.col(number).bitwiseAND((1 << 33) - 1)

    def __len__(self) -> int:
        """The number of pages; without rows there is one empty page."""
        return max(1, -(-self.total // self._size))

    def _shown(self, rows: DataFrame, *more: Column) -> DataFrame:
        return (rows.where(self._kept) if self._kept else rows).select(*[col(c) for c in self._columns], *more)

    def rows(self, page: str = "page") -> DataFrame:
        """The rows of all pages with the number of their page, from 0."""
        return self._shown(self._laid, F.floor(self._rank / self._size).cast("bigint").alias(page))

    def page(self, number: int) -> DataFrame:
        """The rows of one page, in order."""
        low, high = number * self._size, min(self.total, (number + 1) * self._size)
        spans = [
            F.col(self._number).between((k << 33) + max(low, first) - first, (k << 33) + min(high, first + n) - first - 1)
            for k, (first, n) in enumerate(zip(self._before, self._counts, strict=False)) if first < high and first + n > low]
        held = reduce(lambda a, b: a | b, spans) if spans else F.lit(False)
        return self._shown(self._laid.where(held).orderBy(self._number))

    def tokens(self, page: str = "page") -> DataFrame:
        """For every page but the last, the order values of its last row, from which the next
        page goes on, also by ``after``."""
        ends = ((self._rank + 1) % self._size == 0) & (self._rank + 1 < self.total)
        return self._laid.where(ends).select(F.floor(self._rank / self._size).cast("bigint").alias(page), *[col(c) for c in self._order])


def all_pages(df: DataFrame, meta: TableMeta, size: int, *, columns: Sequence[str] | None = None,
              sort: str | None = None, where: Column | dict | None = None, ascending: bool = True,
              limit_first: bool = False) -> Pages:
    """The pages of ``size`` rows that ``fetch_page`` would give one after another.

    With ``limit_first`` the size counts the rows before the filter.
    """
    if not size or size < 1:
        raise ValueError("a page needs a positive limit")
    order = ([sort] if sort else []) + [k for k in meta.keys if k != sort]
    extra = match_all(where) if isinstance(where, dict) else where
    shown, number = list(columns or df.columns), "_at"
    wanted = [col(c) for c in dict.fromkeys([*shown, *order])]
    late = extra is not None and limit_first
    if extra is not None and not limit_first:
        df = df.where(extra)
    if late:
        wanted.append(F.coalesce(extra, F.lit(False)).alias("_kept"))
    placed = df.select(*wanted).orderBy(*_order(order, ascending)).withColumn(number, F.monotonically_increasing_id())
    return Pages(saved(placed, "pages"), shown, order, size, number, "_kept" if late else None)


def scan_page(df: DataFrame, meta: TableMeta, *, columns: Sequence[str] | None = None,
              limit: int = DEFAULT_PAGE, after: dict | None = None) -> DataFrame:
    """A page of the whole table in key order, cut to the list columns unless told."""
    return query(df, meta, columns=columns or meta.list_columns, limit=limit, after=after)


def newest_per_key(df: DataFrame, partition: Sequence[str], sort: str, n: int,
                   ties: Sequence[str]) -> DataFrame:
    """The newest ``n`` rows of every key.

    The rank filter is pushed below the shuffle as a group limit, so a hot key sends at
    most ``n`` rows per input task.
    """
    window = Window.partitionBy(*partition).orderBy(F.desc(sort), *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


# -- settings: pipelines ----------------------------------------------------------------

def active_pipelines(df: DataFrame, columns=PIPELINES.list_columns, **options) -> DataFrame:
    return index_query(df, PIPELINES, "ActivePipelinesIndex", True,
                       columns=columns, ascending=False, **options)


def pipelines_by_environment(df: DataFrame, environment: str, is_active: bool | None = None,
                             columns=PIPELINES.list_columns, **options) -> DataFrame:
    where = None if is_active is None else {"is_active": is_active}
    return index_query(df, PIPELINES, "EnvironmentIndex", environment, where=where,
                       columns=columns, ascending=False, **options)


# -- settings: tables -------------------------------------------------------------------

def tables_by_pipeline(df: DataFrame, pipeline_id, table_type: str | None = None,
                       active_only: bool = False, columns=TABLES.list_columns,
                       **options) -> DataFrame:
    return index_query(df, TABLES, "PipelineTablesIndex", pipeline_id, low=table_type,
                       where={"is_active": True} if active_only else None,
                       columns=columns, **options)


def tables_by_type(df: DataFrame, table_type: str, pipeline_id=None,
                   columns=TABLES.list_columns, **options) -> DataFrame:
    return index_query(df, TABLES, "TableTypeIndex", table_type, low=pipeline_id,
                       columns=columns, **options)


def active_tables(df: DataFrame, pipeline_id, **options) -> DataFrame:
    return tables_by_pipeline(df, pipeline_id, active_only=True, **options)


def source_tables(df: DataFrame, pipeline_id, **options) -> DataFrame:
    return tables_by_pipeline(df, pipeline_id, "source", **options)


def destination_tables(df: DataFrame, pipeline_id, **options) -> DataFrame:
    return tables_by_pipeline(df, pipeline_id, "destination", **options)


def tables_by_format(df: DataFrame, data_format: str, pipeline_id=None,
                     columns=TABLES.list_columns, **options) -> DataFrame:
    where = {"data_format": data_format}
    if pipeline_id is not None:
        where["pipeline_id"] = pipeline_id
    return query(df, TABLES, where=where, columns=columns, **options)


# -- run logs ---------------------------------------------------------------------------

def _and(*parts: Column | None) -> Column | None:
    given = [p for p in parts if p is not None]
    return reduce(lambda a, b: a & b, given) if given else None


def _runs(df, index, value, other, start, end, columns, options) -> DataFrame:
    condition = _and(
        index_condition(df, RUNS, index, **{RUNS.index(index).partition: value}),
        time_range(df, "start_time", start, end),
    )
    return query(df, RUNS, condition, sort="start_time", where=other, columns=columns,
                 ascending=False, **options)


def runs_by_pipeline(df: DataFrame, pipeline_id, status: str | None = None, start=None, end=None,
                     columns=RUNS.list_columns, **options) -> DataFrame:
    """Newest first; each end of the time range is optional and inclusive."""
    where = {"status": status} if status else None
    return _runs(df, "PipelineRunsIndex", pipeline_id, where, start, end, columns, options)


def runs_by_status(df: DataFrame, status: str, pipeline_id=None, start=None, end=None,
                   columns=RUNS.list_columns, **options) -> DataFrame:
    where = None if pipeline_id is None else {"pipeline_id": pipeline_id}
    return _runs(df, "StatusRunsIndex", status, where, start, end, columns, options)


def running_runs(df: DataFrame, **options) -> DataFrame:
    return runs_by_status(df, "running", **options)


def failed_runs(df: DataFrame, as_of, hours: int = 24, pipeline_id=None, **options) -> DataFrame:
    return runs_by_status(df, "failed", pipeline_id, start=_before(as_of, hours=hours), **options)


def recent_runs(df: DataFrame, pipeline_id, as_of, hours: int = 24, **options) -> DataFrame:
    return runs_by_pipeline(df, pipeline_id, start=_before(as_of, hours=hours), **options)


def successful_runs(df: DataFrame, as_of, days: int = 7, pipeline_id=None, **options) -> DataFrame:
    return runs_by_status(df, "success", pipeline_id, start=_before(as_of, days=days), **options)


def composite_range(df: DataFrame, meta: TableMeta, partition: str, value, sort: str,
                    op: str, low, high=None, ascending: bool = False, **options) -> DataFrame:
    """A range on any pair of columns the caller names."""
    return query(df, meta, key_condition(df, partition, value, sort, op, low, high),
                 sort=sort, ascending=ascending, **options)


def time_series(df: DataFrame, meta: TableMeta, partition: str, value, time_key: str,
                start, end, **options) -> DataFrame:
    return composite_range(df, meta, partition, value, time_key, "between", start, end, **options)


def _before(as_of, **span):
    from datetime import timedelta

    return as_of - timedelta(**span)
