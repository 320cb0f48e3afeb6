"""The run event fold as a stream.

Every micro-batch is reduced to one partial row per run and written under its batch
number, so a batch that is run again overwrites itself. Partial rows merge in any order:
reading the folder gives the same runs as folding all the events at once. Now and then the
partial rows are merged into a base, which bounds what a read has to merge; what the base
before it held is then removed.

The ids of events are kept in a folder for each day of the events. A batch lists and looks
up the days it holds alone, so an event counts once however late it comes or comes again,
and no state is held between batches. A day's folder has a base and a bounded number of
batches after it; a day that no batch holds any more is never listed again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from opsframe.operators.runs import KEYS, finish_fold, merge_folds, partial_fold
from opsframe.operators.write import latest
from opsframe.sources.storage import exists, remove, subfolders


class DayIds:
    """Ids of events by day: for each day a base and the batches after it.

    Only one writer adds batches, by rising number; adding a batch again replaces it. Where
    a day has ``most`` batches, those before the current one are merged into a new base.
    They are removed once the base is whole, and an id found twice does no harm, so a
    writer that was lost anywhere goes on.
    """

    def __init__(self, spark: SparkSession, folder: str, most: int = 32):
        self.spark, self.folder, self.most = spark, folder, most

    def _day(self, day) -> str:
        return f"{self.folder}/day={day}"

    def _parts(self, day, before: int) -> tuple[list[int], list[int]]:
        """The whole bases and the batches of a day, as numbers."""
        bases = [int(n) for n in subfolders(self.spark, self._day(day), "base")]
        whole = [n for n in bases if exists(self.spark, f"{self._day(day)}/base={n}/_SUCCESS")]
        batches = [int(n) for n in subfolders(self.spark, self._day(day), "batch")]
        upto = max(whole, default=-1)
        return sorted(whole), sorted(n for n in batches if upto < n < before)

    def _paths(self, day, before: int) -> list[str]:
        bases, batches = self._parts(day, before)
        return [f"{self._day(day)}/base={n}" for n in bases[-1:]] + [f"{self._day(day)}/batch={n}" for n in batches]

    def seen(self, days, before: int) -> DataFrame | None:
        """The ids of these days in batches before the given one; None if there are none."""
        paths = [p for day in days for p in self._paths(day, before)]
        return self.spark.read.parquet(*paths) if paths else None

    def add(self, ids: DataFrame, days, number: int) -> None:
        """The ids of a batch, with their ``day``."""
        (ids.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch").parquet(self.folder))
        for day in days:
            self._merge(day, number)

    def _merge(self, day, number: int) -> None:
        bases, batches = self._parts(day, number)
        if len(batches) < self.most:
            return
        self.spark.read.parquet(*self._paths(day, number)).write.mode("overwrite").parquet(f"{self._day(day)}/base={batches[-1]}")
        for n in [int(n) for n in subfolders(self.spark, self._day(day), "batch") if int(n) <= batches[-1]]:
            remove(self.spark, f"{self._day(day)}/batch={n}")
        for n in bases:
            remove(self.spark, f"{self._day(day)}/base={n}")


def _new_events(batch: DataFrame, store: DayIds, number: int, ids: Sequence[str]) -> tuple[DataFrame, list]:
    """The events of a batch that no earlier batch held, with their day, and these days. An
    event comes again with its time. Of events that differ under one id in a batch, the one
    with the least values, column by column, counts."""
    told = batch.withColumn("day", F.to_date("ts"))
    rest = [c for c in batch.columns if c not in ids]
    once = latest(told, ids, rest, first=True) if rest else told.dropDuplicates([*ids])
    days = [r["day"] for r in told.select("day").distinct().collect() if r["day"] is not None]
    seen = store.seen(days, number) if days else None
    return (once if seen is None else once.join(seen.select(*ids), [*ids], "left_anti")), days


def start_fold(events: DataFrame, folder: str, order: Sequence[str], keys: Sequence[str] = KEYS,
               compact_every: int = 100, **trigger) -> StreamingQuery:
    """Fold a stream of run events into ``folder``; ``trigger`` as for ``writeStream``.

    An event is known by its keys and ``order`` columns.
    """
    spark, ids = events.sparkSession, [*keys, *order]
    store = DayIds(spark, f"{folder}/ids")
    if _existing(spark, f"{folder}/partials") is None:
        none = spark.createDataFrame([], events.schema)
        partial_fold(none, keys, order).write.mode("overwrite").parquet(f"{folder}/partials/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        if number and number % compact_every == 0:
            compact(spark, folder, number - 1, keys)
        new, days = _new_events(batch, store, number, ids)
        partial_fold(new.drop("day"), keys, order).write.mode("overwrite").parquet(
            f"{folder}/partials/batch={number}")
        # Last, and by the batch's number: a batch that is run again does not see its own ids.
        store.add(new.where(F.col("day").isNotNull()).select(*ids, "day"), days, number)

    return (events.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{folder}/progress")
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    files, found = _folder(spark, path)
    parts = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/[!_.]*")) if files.exists(found) else None
    return spark.read.parquet(path) if parts else None


def compact(spark: SparkSession, folder: str, upto: int, keys: Sequence[str] = KEYS) -> None:
    """Merge the folds of the batches up to ``upto`` into one base.

    The base counts once its number is noted, which is the last step and one small file.
    Called before a batch is written, when all earlier ones are complete. What the base
    noted before this one replaced is removed after that, so a read that began before is
    not cut off.
    """
    noted = _noted(spark, folder)
    if noted is not None and noted >= upto:
        return
    merge_folds(_parts(spark, folder, upto), keys).write.mode("overwrite").parquet(
        f"{folder}/base/upto={upto}")
    spark.range(1).select(F.lit(upto).cast("bigint").alias("upto")).coalesce(1).write.mode(
        "append").parquet(f"{folder}/compacted")
    if noted is not None:
        replaced = spark.read.parquet(f"{folder}/partials").where(F.col("batch") <= noted)
        for row in replaced.select("batch").distinct().collect():
            remove(spark, f"{folder}/partials/batch={row['batch']}")
        for row in spark.read.parquet(f"{folder}/compacted").where(F.col("upto") < noted).distinct().collect():
            remove(spark, f"{folder}/base/upto={row['upto']}")


def _noted(spark: SparkSession, folder: str) -> int | None:
    noted = _existing(spark, f"{folder}/compacted")
    return None if noted is None else noted.agg(F.max("upto")).first()[0]


def _parts(spark: SparkSession, folder: str, upto: int | None = None) -> DataFrame:
    """The newest base and the batches after it, as far as ``upto``."""
    rest = spark.read.parquet(f"{folder}/partials")
    noted = _noted(spark, folder)
    if upto is not None:
        rest = rest.where(F.col("batch") <= upto)
    if noted is not None:
        rest = rest.where(F.col("batch") > noted)
    rest = rest.drop("batch")
    return rest if noted is None else rest.unionByName(
        spark.read.parquet(f"{folder}/base/upto={noted}"))


def folded(spark: SparkSession, folder: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The runs of every batch written so far."""
    return finish_fold(merge_folds(_parts(spark, folder), keys), keys)
