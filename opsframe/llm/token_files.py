"""Token ids in sharded files with a minimal perfect hash index over the document keys."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import read_table
from opsframe.llm.sharding import looked_up, position
from opsframe.llm.tokens import END_ID, encode, id_width, tokenizer_path
from opsframe.sources.storage import new_path

# Bytes of ids in a block, keys in a part of the index, documents in a shard. The driver
# holds a bound and a sum for each shard: so many shards at most, larger ones beyond.
BLOCK_BYTES, PART_KEYS, SHARD_DOCS, MAX_SHARDS = 4 << 20, 50_000, 20_000, 50_000


def mixed(keys: np.ndarray, seed) -> np.ndarray:
    """64 well mixed bits of each key; the constants are fixed values of a public mixer."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.asarray(seed, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def build_hash(keys: np.ndarray) -> np.ndarray:
    """Displacements of a minimal perfect hash of distinct whole keys: keys share a small
    bucket, and each bucket, the fullest first, gets the first seed that sends its keys to
    free slots. A bucket of one key names its slot itself, as -1 - slot. The buckets of one
    size try a seed together; where two want a slot, the former gets it."""
    n = len(keys)
    buckets = max(1, -(-n // 4))
    home = (mixed(keys, 0) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    sizes = np.bincount(home, minlength=buckets)
    begins = np.cumsum(sizes) - sizes
    seeds, taken = np.zeros(buckets, np.int64), np.zeros(n, bool)
    for size in range(int(sizes.max(initial=0)), 1, -1):
        waiting, seed = np.flatnonzero(sizes == size), 0
        members = keys[order[begins[waiting][:, None] + np.arange(size)]]
        while len(waiting):
            seed += 1
            slots = (mixed(members, seed) % np.uint64(n)).astype(np.int64)
            fits = np.flatnonzero(~taken[slots].any(axis=1))
            first = np.unique(slots[fits], return_index=True)[1]
            won = np.bincount(first // size, minlength=len(fits)) == size
            placed = fits[won]
            seeds[waiting[placed]], taken[slots[placed]] = seed, True
            left = np.ones(len(waiting), bool)
            left[placed] = False
            waiting, members = waiting[left], members[left]
    singles = np.flatnonzero(sizes == 1)
    seeds[singles] = -1 - np.flatnonzero(~taken)[: len(singles)]
    return seeds


def slots_of(keys: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key; a key that is not in the index gets some slot too."""
    seed = seeds[(mixed(keys, 0) % np.uint64(len(seeds))).astype(np.int64)]
    hashed = (mixed(keys, np.maximum(seed, 0)) % np.uint64(n)).astype(np.int64)
    return np.where(seed < 0, -1 - seed, hashed)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 40) >> np.uint64(32)).astype(np.uint32)


def _spread(spark: SparkSession, shards: int) -> list[int]:
    """A number for each shard that hash partitioning into ``shards`` parts sends to the part
    of the shard's own number."""
    found: dict[int, int] = {}
    room = 32 * shards
    while len(found) < shards:
        place = F.pmod(F.hash("id"), F.lit(shards)).alias("place")
        found = {r["place"]: r["id"] for r in spark.range(room).groupBy(place).agg(F.min("id").alias("id")).collect()}
        room *= 2
    return [found[k] for k in range(shards)]


class TokenFiles:
    """Raw ids in ascending key order, and the index that finds a document in them.

    ``blocks``: one row of at most about ``BLOCK_BYTES`` of ids, or one document: ``shard``,
    ``block``, ``payload`` (raw little-endian ids of ``width`` bytes) and the ``keys``,
    ``lengths`` and ``offsets`` (in ids, within the shard) of its documents. It is a table
    of one bucket per shard, by a ``spread`` number of the shard that Spark's hash sends to
    the shard's own bucket, so no task has two shards and the payload is never shuffled to
    be read.

    ``index``: parts of about ``PART_KEYS`` keys by hash. A part holds the displacements of
    its minimal perfect hash and, by slot, a 32-bit fingerprint and the place of the
    document. The keys are not in it: looking one up takes its part, one hash and one
    comparison; a key that was never stored is refused but for a chance of 2**-32.

    ``repeats``: the places of the documents that the index leaves out, which are those of a
    null key and all but the first of a key that repeats.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int, shard_ids: list[int], width: int):
        self.spark, self.path, self.shards, self.width = spark, path, shards, width
        self.before = np.cumsum([0, *shard_ids]).tolist()
        self.spread = _spread(spark, shards)
        self.table = "token_blocks_" + path.rsplit("-", 1)[-1]

    @classmethod
    def write(cls, docs: DataFrame, key: str = "doc_id", text: str = "text",
              path: str | None = None, tokenizer: str | None = None, end_id: int = END_ID) -> TokenFiles:
        """Encode and write all documents. Whole-number keys, null ones first; of rows that
        repeat a key the index finds the first, in the order of their ids, and ``repeats`` the
        others. Rows of one key share a shard. A null or empty text has the end id alone; an
        empty table makes empty files."""
        spark = docs.sparkSession
        path, tokenizer = path or new_path(spark, "tokens"), tokenizer or tokenizer_path()
        width = id_width(tokenizer, end_id)
        keyed = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
        rows = keyed.count()
        shards = max(1, min(MAX_SHARDS, rows // SHARD_DOCS), min(48, rows // 1000))
        ranks = [k / shards for k in range(1, shards)]
        bounds = (keyed.agg(F.percentile_approx("key", ranks, 100 * shards)).first()[0] or []) if ranks else []
        held = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
        shard = position(held, len(bounds), F.col("key")) if bounds else F.lit(0)
        spread = _spread(spark, shards)
        ids = encode(keyed.withColumn("shard", F.coalesce(shard, F.lit(0))), "text", tokenizer, end_id, width)
        blocks = (
            ids.withColumn("spread", looked_up(spread, F.col("shard"))).repartition(shards, "spread").drop("spread").sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "ids")
            .mapInArrow(lambda batches: _blocks(batches, width),
                        "shard int, block int, payload binary, keys array<bigint>, "
                        "lengths array<bigint>, offsets array<bigint>")
        )
        table = "token_blocks_" + path.rsplit("-", 1)[-1]
        blocks.withColumn("spread", looked_up(spread, F.col("shard"))) \
            .write.format("parquet").option("compression", "zstd").option("path", f"{path}/blocks") \
            .bucketBy(shards, "spread").sortBy("spread", "block").saveAsTable(table)
        written = spark.table(table)
        sums = dict(written.groupBy("shard").agg(F.sum(F.aggregate(
            "lengths", F.lit(0).cast("bigint"), lambda a, b: a + b))).collect())
        store = cls(spark, path, shards, [sums.get(s, 0) for s in range(shards)], width)
        store._write_index(rows)
        return store

    def _write_index(self, rows: int) -> None:
        self.parts = max(1, rows // PART_KEYS)
        entries = self.spark.table(self.table).select(
            "shard", "block", F.explode(F.arrays_zip("keys", "lengths", "offsets")).alias("e"),
        ).select("e.*", "shard", "block")
        first = entries.where("keys IS NOT NULL").groupBy("keys").agg(
            F.min(F.struct("offsets", "shard", "block", "lengths")).alias("e"), F.count("*").alias("n"))

        def build(part: pd.DataFrame) -> pd.DataFrame:
            keys = part["keys"].to_numpy()
            seeds = build_hash(keys)
            at = np.argsort(slots_of(keys, seeds, len(keys)))
            return pd.DataFrame([{
                "part": part["part"].iloc[0], "n": len(keys), "seeds": seeds.tobytes(),
                "prints": fingerprints(keys)[at].tobytes(),
                **{c: part[c].to_numpy()[at].astype(np.int64).tobytes()
                   for c in ("shard", "block", "lengths", "offsets")},
            }])

        many = first.where("n > 1").select("keys", F.col("e.offsets").alias("first"))
        again = entries.join(many, "keys").where("offsets <> first").drop("first")
        again.unionByName(entries.where("keys IS NULL")).select(
            F.col("keys").alias("key"), "shard", "block", F.col("offsets").alias("offset"), F.col("lengths").alias("length"),
        ).write.parquet(f"{self.path}/repeats")
        first.select(self._part("keys").alias("part"), "keys", "e.*").groupBy("part").applyInPandas(
            build, "part int, n int, seeds binary, prints binary, shard binary, block binary, "
                   "lengths binary, offsets binary",
        ).sortWithinPartitions("part").write.parquet(f"{self.path}/index")

    def _part(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def locate(self, keys: DataFrame) -> DataFrame:
        """``key``, ``shard``, ``block``, ``offset``, ``length`` of those keys (one column of
        whole numbers) that are stored; each once."""
        wanted = keys.toDF("key").where("key IS NOT NULL").distinct().withColumn("part", self._part("key"))
        index = self.spark.read.parquet(f"{self.path}/index")
        schema = "key bigint, shard int, block int, offset bigint, length bigint"

        def find(asked: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
            if asked.empty or part.empty:
                return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
            row, keys = part.iloc[0], asked["key"].to_numpy()
            slots = slots_of(keys, np.frombuffer(row["seeds"], np.int64), row["n"])
            here = np.frombuffer(row["prints"], np.uint32)[slots] == fingerprints(keys)
            slots, column = slots[here], lambda c: np.frombuffer(row[c], np.int64)
            return pd.DataFrame({"key": keys[here]} | {
                name: column(c)[slots] for name, c in
                (("shard", "shard"), ("block", "block"), ("offset", "offsets"), ("length", "lengths"))})

        return wanted.groupBy("part").cogroup(index.groupBy("part")).applyInPandas(find, schema)

    def repeats(self, keys: DataFrame) -> DataFrame:
        """As ``locate``, the documents of those keys that the index leaves out; a null key
        stands for all documents without one."""
        wanted = keys.toDF("wanted").distinct()
        left = self.spark.read.parquet(f"{self.path}/repeats")
        return left.join(wanted, F.col("key").eqNullSafe(F.col("wanted")), "left_semi")

    def get(self, keys: DataFrame, every: bool = False) -> DataFrame:
        """``key``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``
        (little-endian unsigned 32-bit) of the keys that are stored: of the first document of
        a key, or of ``every`` one, those of a null key included.

        The places found are gathered by block, which bounds them, and meet the payload in
        its own buckets; the block is compared beside the join so that its buckets serve.
        """
        places = self.locate(keys)
        if every:
            places = places.unionByName(self.repeats(keys))
        asked = places.groupBy("shard", "block").agg(
            F.sort_array(F.collect_list(F.struct("offset", "length", "key"))).alias("asked")).withColumn(
            "spread", looked_up(self.spread, F.col("shard")))
        blocks = self.spark.table(self.table).select(
            F.col("spread").alias("s"), F.col("block").alias("b"), "payload",
            F.get("offsets", F.lit(0)).alias("first"))
        joined = blocks.join(asked.hint("merge"), (F.col("s") == F.col("spread")) & (F.col("b") - F.col("block") == 0))
        width = self.width
        cut = joined.select("shard", "payload", "first", "asked").mapInArrow(
            lambda batches: _cut(batches, width), "shard int, key bigint, offset bigint, n_tokens bigint, ids binary")
        return cut.select(
            "key", (looked_up(self.before, F.col("shard")) + F.col("offset")).alias("start"), "n_tokens", "ids")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows of one shard after the other, in key order, gathered into blocks."""
    shard, block, offset, held, rows = None, 0, 0, 0, []

    def flush():
        nonlocal rows, held, block
        columns = [[shard], [block], [b"".join(r[1] for r in rows)], [[r[0] for r in rows]],
                   [[len(r[1]) // width for r in rows]], [[r[2] for r in rows]]]
        rows, held, block = [], 0, block + 1
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), longs, longs, longs), strict=True)],
            names=["shard", "block", "payload", "keys", "lengths", "offsets"])

    for batch in batches:
        for s, k, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "key", "ids")), strict=True):
            if rows and (s != shard or held + len(ids) > BLOCK_BYTES):
                yield flush()
            if s != shard:
                shard, block, offset = s, 0, 0
            rows.append((k, ids, offset))
            offset, held = offset + len(ids) // width, held + len(ids)
    if rows:
        yield flush()


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, payload, first, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = np.frombuffer(payload, f"<u{width}")
            spans = [(a["offset"] - first, a["length"]) for a in asked]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * len(asked), pa.int32()), pa.array([a["key"] for a in asked], pa.int64()),
                 pa.array([a["offset"] for a in asked], pa.int64()), pa.array([n for _, n in spans], pa.int64()),
                 pa.array([ids[at:at + n].astype("<u4").tobytes() for at, n in spans], pa.binary())],
                names=["shard", "key", "offset", "n_tokens", "ids"])


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back by key through the index; those
    without an id, or with one that repeats, by their place."""
    docs = read_table(spark, sf_dir, "documents")
    store = TokenFiles.write(docs)
    return store.get(docs.select("doc_id"), every=True).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERY = op8_token_files
