"""The corpus pipeline: stages over documents, each written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import fresh, read_table, saved
from opsframe.llm.decontaminate import with_leaks
from opsframe.llm.line_dedup import keep_bitmaps, with_kept_lines
from opsframe.llm.near_dedup import near_duplicates
from opsframe.llm.packing import pack
from opsframe.llm.quality import quality_model, score

# Documents of a lower score than this are rejected.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality suffices, by a model learned from the labels."""
    model, into = quality_model(docs, read_table(spark, sf_dir, "labels")), fresh("score")
    return score(docs, model, into=into, keep_text=True).where(F.col(into) >= LEAST_QUALITY).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other documents hold as well."""
    kept, total, dropped = fresh("kept"), fresh("total"), fresh("dropped")
    marked = with_kept_lines(docs, keep_bitmaps(docs), names=(kept, total, dropped))
    changed = F.col(dropped) > 0
    text = F.when(changed, F.concat_ws("\n", kept)).otherwise(F.col("text"))
    return marked.withColumn("text", text).withColumn(
        "n_chars", F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars")),
    ).select(*docs.columns)


def _copies_once(docs: DataFrame) -> DataFrame:
    """The rows, those that ids do not tell apart once for each text: of rows with one id and
    one text any one stays, and of rows of one text without id none beside a row with an id,
    else any one. Texts without words are no copies. Ids alone are read where none repeats."""
    ids = docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if ids.isEmpty():
        return docs
    digest, keep, named = fresh("digest"), fresh("keep"), F.col("doc_id").isNotNull()
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    marked = docs.withColumn(digest, F.when(words, F.unhex(F.sha2("text", 256))))
    held = saved(marked.where(words).groupBy("doc_id", digest).count(), "digests")
    elsewhere = held.where(named).select(digest).distinct().withColumn(keep, F.lit(False))
    odd = saved(
        held.where(named & (F.col("count") > 1)).select(F.col("doc_id").alias("id"), F.col(digest).alias("of"), F.lit(True).alias(keep))
        .union(held.where(~named).join(elsewhere, digest, "left")
               .select("doc_id", digest, F.coalesce(keep, F.lit(True)))), "copies")
    told = marked.join(odd.withColumnsRenamed({"id": f"{digest}_id", "of": f"{digest}_of"}),
                       (F.col(digest) == F.col(f"{digest}_of")) & F.col("doc_id").eqNullSafe(F.col(f"{digest}_id")), "left")
    once = told.where(F.col(keep)).dropDuplicates(["doc_id", digest])
    return told.where(F.col(keep).isNull()).union(once).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates. Rows that repeat an id with its text, and
    rows without id that repeat a text, stay once; no other row without id goes."""
    gone = near_duplicates(docs).groupBy("id").agg(F.bool_or("kept").alias("kept")).where("NOT kept")
    once = _copies_once(docs)
    return once.join(gone.select(F.col("id").alias("doc_id")), "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    into = fresh("leaks")
    return with_leaks(docs, read_table(spark, sf_dir, "benchmark"), into=into).where(
        F.size(into) == 0).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in full windows, one row per piece."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality), ("line_dedup", lines), ("near_dedup", near),
    ("decontaminate", benchmark), ("packing", packing),
]

# Learned scores, sketches and packing are outside SQL; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
