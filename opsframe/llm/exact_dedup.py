"""Exact dedup against a persistent index of digests, bucketed and sorted by digest."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import ascii_lower, read_table, saved, text_or_empty
from opsframe.sources.storage import exists, new_path


def digest(text: str | Column) -> Column:
    """SHA-256 of the text with A-Z in lower case; a null text counts as empty."""
    return F.unhex(F.sha2(ascii_lower(text_or_empty(text)).cast("binary"), 256))


class DigestIndex:
    """One row per known digest: ``digest``, ``keep_id``, the ``group_size`` it came with and
    the number of the ``batch`` that brought it.

    The files lie at ``path`` as a table of ``buckets`` buckets sorted by digest, so that a
    new batch is compared with it by a sort-merge anti-join that shuffles the batch alone.
    The number of buckets is kept beside the files: a later session opens the folder with
    that number, and asking for another one is refused, as a digest would be looked for in
    the wrong bucket. The numbers of the batches entered are kept there as well.
    """

    COLUMNS = "digest BINARY, keep_id BIGINT, group_size BIGINT, batch BIGINT"

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path
        self.table = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:16]
        known = self._noted("layout")
        if known is None:
            # A bucket of a billion digests has files of some 20 GB, split as they are read.
            self.buckets = buckets or 64
            spark.range(1).select(F.lit(self.buckets).cast("bigint").alias("n")).coalesce(1).write.parquet(f"{path}/layout")
        else:
            self.buckets = known.first()["n"]
            if buckets not in (None, self.buckets):
                raise ValueError(f"the index at {path} has {self.buckets} buckets, not {buckets}")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({self.COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}/rows'"
        )

    def _noted(self, name: str) -> DataFrame | None:
        """Whole numbers noted beside the index, one small file each."""
        path = f"{self.path}/{name}"
        return self.spark.read.schema("n bigint").parquet(path) if exists(self.spark, path) else None

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)  # another session may have added files
        return self.spark.table(self.table)

    def append(self, entries: DataFrame, batch: int) -> None:
        entries.repartition(self.buckets, "digest") \
            .select("digest", "keep_id", "group_size", F.lit(batch).cast("bigint").alias("batch")) \
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest") \
            .sortBy("digest").option("path", f"{self.path}/rows").saveAsTable(self.table)

    def add(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Enter a batch and say of each of its rows which row stays.

        Returns ``id``, ``digest``, ``keep_id``, ``group_size`` and ``kept``. A digest known
        from an earlier batch keeps its earlier row, so all rows of this batch go. Rows that
        repeat both id and text share the fate of their id. A null id never wins against
        another; a group of null ids alone keeps them. An empty batch adds nothing.

        The batch's texts are digested once, into the shared folder, and its groups are
        aggregated before they are shuffled. They meet the index in its buckets, without
        moving it; the result is made of the batch and its groups alone.
        """
        rows = saved(docs.select(F.col(key).cast("bigint").alias("id"), digest(text).alias("digest")), "batch")
        noted = self._noted("batches")
        batch = 1 + ((noted.agg(F.max("n")).first()[0] if noted is not None else 0) or 0)
        # Numbers are noted first: one that was lost on the way is never used again.
        self.spark.range(1).select(F.lit(batch).cast("bigint").alias("n")).coalesce(1).write.mode("append").parquet(f"{self.path}/batches")
        groups = rows.groupBy("digest").agg(F.max("id").alias("own_id"), F.count("*").alias("own_size"))
        known = self.rows().select("digest", F.col("keep_id").alias("old_id"), F.col("group_size").alias("old_size"), F.lit(True).alias("old"))
        met = saved(groups.join(known.hint("merge"), "digest", "left"), "groups")
        new = met.where("old IS NULL").select("digest", F.col("own_id").alias("keep_id"), F.col("own_size").alias("group_size"))
        self.append(new, batch)
        old = F.col("old").isNotNull()
        fate = met.select("digest", F.when(old, F.col("old_id")).otherwise(F.col("own_id")).alias("keep_id"),
                          F.when(old, F.col("old_size")).otherwise(F.col("own_size")).alias("group_size"), old.alias("old"))
        kept = F.col("id").eqNullSafe(F.col("keep_id")) & ~F.col("old")
        # Both sides come from files and are shuffled here, so a digest that many rows share is split.
        return rows.join(fate, "digest").select("id", "digest", "keep_id", "group_size", kept.alias("kept"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents entered into a new index; of equal texts the largest doc_id stays."""
    index = DigestIndex(spark, new_path(spark, "digests"))
    return index.add(read_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


QUERY = op6_exact_dedup
SQL = """
WITH lowered AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), grouped AS (
  SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM lowered GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM lowered JOIN grouped USING (text_sha256)
"""
