"""A join that can be split where one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

HASH = "_key_hash"


def key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*on)


def split_join(many: DataFrame, one: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join rows, many of which may share a key, to one row per key.

    Adaptive execution splits a hot partition of a join, but only where both inputs come
    straight from shuffles made for that join. One row per key mostly comes out of an
    aggregate on the same keys, which is not shuffled again. Joining on a hash of the keys
    as well asks for a shuffle of its own on each side; the reduced side is the small one.
    The hash stays in the result for a grouping that follows: grouping by it and the keys
    needs no further shuffle unless a split took place.
    """
    left = many.withColumn(HASH, key_hash(on))
    right = one.withColumn(HASH, key_hash(on))
    return left.join(right, [*on, HASH], how)
