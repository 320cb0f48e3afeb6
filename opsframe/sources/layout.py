"""Physical layouts that the reads and writes profit from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opsframe.functions.predicates import literal_for
from opsframe.operators.write import Change, Removal, key_given, keyed
from opsframe.sources.storage import remove, saved, subfolders


def bloom_options(columns: Sequence[str]) -> dict[str, str]:
    """Write options for a Bloom filter of each of these columns in every row group, sized by
    the values found. A read with an equality on such a column skips row groups without it,
    however the rows are ordered."""
    out = {"parquet.bloom.filter.adaptive.enabled": "true"} if columns else {}
    return out | {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def write_run_log(runs: DataFrame, path: str, mode: str = "overwrite", blooms: Sequence[str] = ("run_id",)) -> None:
    """A run log in one folder per day, ordered by pipeline and start inside its files.

    Rows are spread by ranges of (day, pipeline, start), so a day or pipeline that holds
    much of the log fills several files; a read of one pipeline then skips most row groups,
    and so does a read of a few values of the ``blooms`` columns, by which rows are not
    ordered. Overwriting replaces only the days at hand.
    """
    order = ["day", "pipeline_id", "start_time"]
    (runs.withColumn("day", F.to_date("start_time"))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).options(**bloom_options([c for c in blooms if c in runs.columns]))
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def read_run_log(spark: SparkSession, path: str, start: datetime | None = None,
                 end: datetime | None = None) -> DataFrame:
    """The log between two instants, both inclusive; only the folders of those days are listed."""
    log = spark.read.parquet(path)
    if start is not None:
        log = log.where((F.col("day") >= F.lit(start.date()))
                        & (F.col("start_time") >= literal_for(log, "start_time", start)))
    if end is not None:
        log = log.where((F.col("day") <= F.lit(end.date()))
                        & (F.col("start_time") <= literal_for(log, "start_time", end)))
    return log.drop("day")


def open_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with its ``day``; every read, report and purge with a time bound then opens
    the folders of its days alone."""
    return spark.read.parquet(path)


def save_bucketed(state: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str,
                  blooms: Sequence[str] = ()) -> None:
    """A state kept in buckets of its key, so that applying commands does not shuffle it.

    Files are ordered by the key; ``blooms`` names index columns to be looked up as well.
    """
    (state.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .options(**bloom_options(blooms)).option("path", path).saveAsTable(table))


# -- days that are dropped ----------------------------------------------------------------

def purge_days(spark: SparkSession, path: str, cutoff: datetime) -> list[date]:
    """Drop the runs that started before the cutoff from a log by day; the days dropped whole.

    Days before the cutoff's own go by their folder, unread. Of the cutoff's day alone the
    rows are read and written anew, after they were saved aside; every other file stays as
    it is. Runs without a start are of unknown age and stay. Purging again changes nothing.
    """
    days = [date.fromisoformat(v) for v in subfolders(spark, path, "day") if v[:1].isdigit()]
    gone = sorted(d for d in days if d < cutoff.date())
    for day in gone:
        remove(spark, f"{path}/day={day}")
    if cutoff.date() in days:
        log = spark.read.parquet(path)
        edge = log.where(F.col("day") == F.lit(cutoff.date()))
        kept = saved(edge.where(F.col("start_time") >= literal_for(log, "start_time", cutoff)), "edge")
        if kept.isEmpty():
            remove(spark, f"{path}/day={cutoff.date()}")
        elif kept.count() < edge.count():
            write_run_log(kept.drop("day"), path)
    return gone


# -- a state in folders by key bucket ------------------------------------------------------

class BucketedState:
    """A state of which a batch of commands rewrites the buckets it names and no others.

    Rows lie in one folder per bucket of their key's hash. The number of buckets and the
    keys are kept beside them and cannot be changed by opening. Commands take the keys'
    types, so that equal keys have equal buckets. What is read and written grows with the
    buckets that a batch touches: their numbers, at most as many as there are buckets, go
    through the driver and prune the folders. One writer at a time; the outcomes and the
    new rows are saved before any folder is replaced.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        settings = spark.read.parquet(f"{path}/layout").first()
        self.buckets, self.keys = settings["buckets"], list(settings["keys"])

    @classmethod
    def create(cls, state: DataFrame, path: str, keys: Sequence[str], buckets: int) -> BucketedState:
        if buckets < 1:
            raise ValueError("a state needs a bucket")
        spark = state.sparkSession
        spark.range(1).select(F.lit(buckets).alias("buckets"), F.array(*map(F.lit, keys)).alias("keys")).coalesce(1).write.parquet(
            f"{path}/layout")
        spark.createDataFrame([], state.schema).write.parquet(f"{path}/schema")
        out = cls(spark, path)
        out._write(out._placed(state))
        return out

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _write(self, placed: DataFrame) -> None:
        """Ranges of (bucket, keys), so that a large bucket fills several files."""
        order = ["_bucket", *self.keys]
        (placed.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(f"{self.path}/rows"))

    def _rows(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema.add("_bucket", T.IntegerType())
        if not subfolders(self.spark, f"{self.path}/rows", "_bucket"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame:
        return self._rows().drop("_bucket")

    def apply(self, c: DataFrame, change: Callable[[DataFrame, DataFrame], Change | Removal]) -> DataFrame:
        """Let ``change(state, commands)`` change the touched buckets; the outcomes."""
        rows = self._rows()
        told = self._placed(keyed(c, rows, self.keys)).where(key_given(self.keys))
        touched = sorted(r["_bucket"] for r in told.select("_bucket").distinct().collect())
        held = rows.where(F.col("_bucket").isin(touched)).drop("_bucket")
        changed = change(held, c)
        outcomes = saved(changed.outcomes, "outcomes")
        new = saved(self._placed(changed.state.select(*held.columns)), "buckets")
        left = {r["_bucket"] for r in new.select("_bucket").distinct().collect()}
        if left:
            self._write(new)
        for bucket in set(touched) - left:
            remove(self.spark, f"{self.path}/rows/_bucket={bucket}")
        return outcomes
