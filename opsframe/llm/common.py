"""What several corpus operators share."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.session import prepare
from opsframe.sources.storage import saved

__all__ = ["ascii_lower", "fresh", "read_table", "saved", "text_or_empty"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    """The text; a null one counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fresh(name: str) -> str:
    """A column name that no input column can clash with."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"
