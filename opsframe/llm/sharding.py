"""Shards by sampled splitters: weighted key samples, quantile bounds, range partitions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsframe.llm.common import fresh, read_table, saved, text_or_empty

# The bounds and per-range totals are held by the driver: so many ranges at most.
MAX_RANGES = 50_000


def position(bounds: Column, n: int, key: Column) -> Column:
    """How many of the n ascending bounds are not above the key, by halving."""
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at),
    )


def _range_of(frame: DataFrame, key: Column, kind: str, bounds: list[str]) -> Column:
    """The range of a key; bounds are JSON texts of keys in ascending order."""
    if not bounds:
        return F.lit(0)
    held = F.from_json(F.lit("[" + ",".join(bounds) + "]"), f"array<{kind}>")
    return position(held, len(bounds), key)


def looked_up(values: list[int], at: Column) -> Column:
    return F.get(F.from_json(F.lit(json.dumps(values)), "array<bigint>"), at)


def _sampled(frame: DataFrame, key: Column, size: Column, per_byte: float, seed: int):
    """Keys drawn with a chance that follows their size, as (range, JSON key, weight) in
    order. The draw hashes the key, so that a repeated task draws the same keys."""
    expected = size * F.lit(per_byte)
    chance = F.pmod(F.xxhash64(F.lit(seed), F.to_json(key)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    return frame.where(chance < expected).select(
        "__range", F.to_json(key).alias("key"), F.greatest(expected, F.lit(1.0)).alias("weight"),
        key.alias("order"),
    ).orderBy("order").select("__range", "key", "weight").collect()


def _quantiles(drawn, pieces: int) -> list[str]:
    """The keys at the inner quantiles of the drawn weight."""
    total, passed, out = sum(r.weight for r in drawn), 0.0, []
    for row in drawn:
        passed += row.weight
        if len(out) < pieces - 1 and passed >= total * (len(out) + 1) / pieces:
            while len(out) < pieces - 1 and passed >= total * (len(out) + 1) / pieces:
                out.append(row.key)
    return out


def splitters(frame: DataFrame, key: Column, kind: str, size: Column, ranges: int,
              samples: int = 32, rounds: int = 3):
    """Bounds of about ``ranges`` key ranges of near equal size, with the bytes and rows of
    each range.

    ``samples`` keys are drawn for each range. Ranges over twice the mean are drawn from
    again, more densely, and subdivided, for up to ``rounds`` rounds. A range of one single
    key cannot be divided.
    """
    total = frame.agg(F.sum(size)).first()[0] or 0
    if not total:
        return [], [(0, frame.count())]
    mean = total / ranges
    drawn = _sampled(frame.withColumn("__range", F.lit(0)), key, size, samples / mean, 0)
    bounds = list(dict.fromkeys(_quantiles(drawn, ranges)))
    for turn in range(rounds + 1):
        placed = frame.withColumn("__range", _range_of(frame, key, kind, bounds))
        sums = {r["__range"]: (r[1], r[2]) for r in placed.groupBy("__range").agg(F.sum(size), F.count("*")).collect()}
        over = {k: min(64, -int(-b // mean)) for k, (b, _) in sums.items() if b > 2 * mean}
        if not over or turn == rounds or len(bounds) >= MAX_RANGES:
            break
        dense = _sampled(placed.where(F.col("__range").isin(list(over))), key, size, 4 * samples / mean, turn + 1)
        by_range: dict[int, list] = {}
        for row in dense:
            by_range.setdefault(row["__range"], []).append(row)
        merged: list[str] = []
        for k in range(len(bounds) + 1):
            merged += [bounds[k - 1]] if k else []
            merged += _quantiles(by_range.get(k, []), over.get(k, 1)) if k in over else []
        merged = list(dict.fromkeys(merged))
        if merged == bounds:
            break
        bounds = merged
    return bounds, [sums.get(k, (0, 0)) for k in range(len(bounds) + 1)]


def range_shards(records: DataFrame, key: list[str], size: str, shards: int = 8,
                 rows_per_range: int = 500_000) -> DataFrame:
    """Every record with its ``shard`` (0 to ``shards`` - 1) and its ``slot`` in it.

    Records in key order are cut where the running size passes each equal share, so the
    shards differ by less than one record and equal leading keys stay together but where a
    cut falls between them. Running sums are taken within the key ranges, which are balanced
    by size, and begin at the totals of the ranges before; a key that a third of all rows
    share is therefore spread as long as a later key column tells its rows apart. ``size``
    must be a positive whole number; null keys sort first; repeated rows are separate
    records and get separate slots; an empty table gives an empty result.

    The records are read several times; pass what is cheap to read. The result is saved in
    the shared folder before the slots are numbered.
    """
    n = records.count()
    ranges = min(MAX_RANGES, max(8 * shards, n // rows_per_range))
    keys = F.struct(*[F.col(c) for c in key])
    kind = records.select(keys.alias("k")).schema["k"].dataType.simpleString()
    bounds, sums = splitters(records, keys, kind, F.col(size), ranges)
    total = max(1, sum(b for b, _ in sums))
    bytes_before, rows_before = [0], [0]
    for b, rows in sums:
        bytes_before.append(bytes_before[-1] + b)
        rows_before.append(rows_before[-1] + rows)

    at, row, passed, shard = fresh("range"), fresh("row"), fresh("passed"), "shard"
    order = Window.partitionBy(at).orderBy(*[F.col(c).asc_nulls_first() for c in key])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        records.withColumn(at, _range_of(records, keys, kind, bounds))
        .withColumn(passed, F.coalesce(F.sum(size).over(before), F.lit(0)) + looked_up(bytes_before, F.col(at)))
        .withColumn(row, F.row_number().over(order) - 1 + looked_up(rows_before, F.col(at)))
        .withColumn(shard, F.least(
            F.lit(shards - 1),
            F.expr(f"((2 * `{passed}` + `{size}`) * {shards}L) div {2 * total}L").cast("int")))
        .drop(at, passed)
    )
    kept = saved(placed, "shards")
    first = {r[0]: r[1] for r in kept.groupBy(shard).agg(F.min(row)).collect()}
    starts = [first.get(s, 0) for s in range(shards)]
    return kept.withColumn("slot", F.col(row) - looked_up(starts, F.col(shard))).drop(row)


def write_shards(sharded: DataFrame, path: str) -> None:
    """Files of the records, one folder per shard, in slot order within each file."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near equal bytes; equal texts are neighbours."""
    text = text_or_empty("text")
    records = saved(read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    ), "records")
    return range_shards(records, ["text_hash", "doc_id"], "size", shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERY = op4_sharding
