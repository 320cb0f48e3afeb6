"""Readers and writers whose format, path and options come from a table's settings."""

from __future__ import annotations

import json
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from opsframe.operators.quality import declared_schema
from opsframe.operators.read import get_one
from opsframe.schema import CACHE_LEVELS, DATA_FORMATS, TABLES

_READ_ONLY = ("format", "path", "partitionColumns")
_WRITE_ONLY = ("format", "path", "mode", "partitionBy")


def table_settings(tables: DataFrame, table_id) -> dict:
    """One table's settings as a dict; free-form fields as Python values."""
    row = get_one(tables, TABLES, list(TABLES.fields), table_id=table_id).first()
    if row is None:
        raise KeyError(f"{TABLES.name}: no item for {table_id!r}")
    return {k: _plain(k, v) for k, v in row.asDict(recursive=True).items()}


def _plain(name: str, value):
    if hasattr(value, "toPython"):
        return value.toPython()
    if isinstance(value, str) and TABLES.fields.get(name) == "VARIANT":
        return json.loads(value)
    return value


def _format(settings: Mapping) -> str:
    name = settings["data_format"]
    if name not in DATA_FORMATS:
        raise ValueError(f"unknown format '{name}'; choices: {list(DATA_FORMATS)}")
    return name


def _text(value) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def read_options(settings: Mapping) -> dict:
    """Format and path, the table's read options over them, and its partition columns."""
    options = {"format": _format(settings), "path": settings["location"],
               **(settings.get("read_options") or {})}
    if settings.get("partition_columns"):
        options["partitionColumns"] = list(settings["partition_columns"])
    return options


def write_options(settings: Mapping) -> dict:
    """As ``read_options``, with mode overwrite unless the table says otherwise."""
    options = {"format": _format(settings), "path": settings["location"], "mode": "overwrite",
               **(settings.get("write_options") or {})}
    if settings.get("partition_columns"):
        options["partitionBy"] = list(settings["partition_columns"])
    return options


def storage_level(settings: Mapping) -> StorageLevel | None:
    if not settings.get("caching_enabled"):
        return None
    name = settings.get("cache_level") or "MEMORY_AND_DISK"
    if name not in CACHE_LEVELS:
        raise ValueError(f"unknown cache level '{name}'; choices: {list(CACHE_LEVELS)}")
    # Rows from Python are kept serialized in any case; the _SER names are the plain ones.
    return getattr(StorageLevel, name.removesuffix("_SER"))


def _needing_package(name: str, action):
    """Run ``action``; a format that Spark does not know is reported in plain words."""
    try:
        return action()
    except (AnalysisException, Py4JJavaError) as error:
        if "failed to find" in str(error).lower():
            raise RuntimeError(f"format '{name}' needs its Spark package on the class path") from error
        raise


def config_read(spark: SparkSession, settings: Mapping) -> DataFrame:
    options = read_options(settings)
    reader = spark.read.format(options["format"])
    definition = settings.get("schema_definition")
    if definition:
        reader = reader.schema(declared_schema(definition))
    for name, value in options.items():
        if name not in _READ_ONLY:
            reader = reader.option(name, _text(value))
    rows = _needing_package(options["format"], lambda: reader.load(options["path"]))
    level = storage_level(settings)
    return rows if level is None else rows.persist(level)


def config_write(df: DataFrame, settings: Mapping) -> int:
    """Write, and return the row count observed by the write itself (no second job).

    Rows of a partitioned table are rebalanced by its partition columns: few large files
    for each value, and several tasks for a value that holds much of the table. The count
    is taken after that, in the tasks that write, so a map task run again does not count
    twice.
    """
    options = write_options(settings)
    parts = options.get("partitionBy")
    if parts:
        df = df.hint("rebalance", *parts)
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("records")).write
    writer = writer.format(options["format"]).mode(options["mode"])
    if parts:
        writer = writer.partitionBy(*parts)
    for name, value in options.items():
        if name not in _WRITE_ONLY:
            writer = writer.option(name, _text(value))
    _needing_package(options["format"], lambda: writer.save(options["path"]))
    return int(seen.get["records"])
