"""Effective Spark settings of every pipeline."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Settings every job starts from.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def overlay(base: Column, over: Column) -> Column:
    """Key-wise merge, ``over`` winning."""
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k))
    return F.map_concat(kept, over)


def _one(key: str, value: Column, when: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.create_map(F.lit(key), value)).otherwise(
        F.create_map().cast("map<string,string>"))


def effective_conf(pipelines: DataFrame) -> DataFrame:
    """``conf``: defaults, then ``spark_config``, then the declared cores and memory."""
    base = F.create_map(
        F.lit("spark.app.name"), F.concat(F.lit("Pipeline-"), F.col("pipeline_name")),
        *[F.lit(x) for pair in _DEFAULTS.items() for x in pair])
    layers = [
        F.coalesce(F.col("spark_config"), F.create_map().cast("map<string,string>")),
        _one("spark.executor.cores", F.col("cpu_cores").cast("string"), F.col("cpu_cores") != 0),
        _one("spark.executor.memory",
             F.concat((F.col("memory_gb") * 1024).cast("bigint").cast("string"), F.lit("m")),
             F.col("memory_gb") != 0),
    ]
    return pipelines.select("pipeline_id", reduce(overlay, layers, base).alias("conf"))
