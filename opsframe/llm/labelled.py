"""Labelled rows for the learned operators: a bounded sample, kept apart from held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(key: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, max_rows: int,
           key: str = "doc_id", text: str = "text") -> DataFrame:
    """``text`` and ``label`` of about ``max_rows`` labelled rows that are not held out.

    Labels are drawn by a hash of their id, so at most little more than ``max_rows`` ids are
    sent to every task to pick their texts. Null labels and ids are left out.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out)
    share = min(1.0, max_rows / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30))) \
        .groupBy(key).agg(F.max(F.col(label).cast("int")).alias("label"))
    return docs.select(key, F.col(text).alias("text")).join(F.broadcast(drawn), key).select("text", "label")
