"""Vectors as short codes, by an integer Walsh-Hadamard search in codebooks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import fresh, read_table, saved
from opsframe.llm.vectors import Sums, blocks, exact, finite, floor_means, largest, matrix, scaled


def walsh(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, its rows by rising sequency (the number
    of sign changes along a row)."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    return rows[np.argsort((rows[:, 1:] != rows[:, :-1]).sum(1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """The transform of each row, padded with zeros to a power of two."""
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    return parts @ walsh(size)[:parts.shape[1]].astype(parts.dtype) if parts.shape[1] else parts


@dataclass
class Search:
    """Nearest entries, and how many squared differences finding them took."""

    entry: np.ndarray
    distance: np.ndarray
    steps: int


def nearest(parts: np.ndarray, entries: np.ndarray) -> Search:
    """The nearest entry of each part by squared distance, the lowest index among equals.

    In the transform, the squared differences of all coefficients add up to the squared
    distance times the transform's size. They are added coefficient by coefficient in
    sequency order. The entry that is nearest after the first one is added up first and
    bounds the others: an entry whose sum exceeds the bound is left out at once, so no
    nearest entry is ever lost. All numbers are whole, so equal distances are equal.
    """
    size = 1 << max(0, parts.shape[1] - 1).bit_length()
    bound = size * (2 * size * max(1, largest(parts, entries))) ** 2
    x, e = (transformed(exact(m, bound)) for m in (parts, entries))
    n, wide = len(x), x.shape[1]
    sums = (x[:, :1] - e[None, :, 0]) ** 2
    rows = np.arange(n)
    guess = sums.argmin(axis=1)
    most = ((x - e[guess]) ** 2).sum(axis=1)
    steps = n * len(e) + n * (wide - 1)
    row, entry = np.nonzero(sums <= most[:, None])
    sums = sums[row, entry]
    for k in range(1, wide):
        sums = sums + (x[row, k] - e[entry, k]) ** 2
        steps += len(row)
        left = sums <= most[row]
        row, entry, sums = row[left], entry[left], sums[left]
    # Every part still has its guess; rows and entries are in ascending order.
    first = np.searchsorted(row, rows)
    least = np.minimum.reduceat(sums, first) if n else sums
    hit = np.flatnonzero(sums == least[row])
    chosen = hit[np.searchsorted(row[hit], rows)]
    return Search(entry[chosen], sums[chosen] // size, steps)


@dataclass
class Codebooks:
    """For each part position the entries, as whole numbers: (parts, entries, part width)."""

    entries: np.ndarray

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for x in self.entries.ravel()).encode()).hexdigest()

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry of each part of each row, and the squared distance to it."""
        parts, _, width = self.entries.shape
        cut = rows.reshape(len(rows), parts, width)
        found = [nearest(cut[:, p], self.entries[p]) for p in range(parts)]
        return np.stack([f.entry for f in found], 1), np.stack([f.distance.astype(object) for f in found], 1)


def prepared(vectors: DataFrame, vector: str, parts: int, scale: int) -> tuple[DataFrame, int]:
    """The rows that can be coded, their vector as whole numbers, and its length.

    Null vectors and those with null or non-finite components are left out. Vectors to be
    compared have one length that the parts divide: the commonest such length, of equally
    common ones the shorter, is kept and rows of other lengths are left out as well.
    """
    whole = finite(vectors, vector)
    lengths = whole.groupBy(F.size(vector).alias("size")).count().where((F.col("size") > 0) & (F.col("size") % parts == 0))
    best = lengths.orderBy(F.desc("count"), "size").limit(1).collect()
    width = best[0]["size"] if best else 0
    return whole.where((F.size(vector) == width) & (F.size(vector) > 0)).withColumn(vector, scaled(vector, scale)), width


def train(rows: DataFrame, width: int, key: str = "vec_id", vector: str = "embedding", parts: int = 16,
          entries: int = 64, rounds: int = 2) -> Codebooks:
    """Codebooks that begin as the parts of the rows with the smallest keys (null keys last,
    equal keys by their vector) and take floored means of their parts in each round.

    Every round reads all rows. Each task adds up its own sums by part and entry, and one row
    per part, entry and position reaches the driver, however many rows there are.
    """
    first = rows.select(key, vector).orderBy(F.asc_nulls_last(key), vector).limit(entries).collect()
    begin = np.array([r[vector] for r in first], np.int64).reshape(len(first), parts, width // parts)
    books = Codebooks(begin.transpose(1, 0, 2))
    for _ in range(rounds if first else 0):
        shape = books.entries.shape

        def sums(batches: Iterator[pa.RecordBatch], books=books, shape=shape):
            found = Sums(shape[0] * shape[1], shape[2])
            for batch in batches:
                for block in blocks(batch):
                    values = matrix(block.column(0), width)
                    entry, _ = books.assign(values)
                    cells = entry + np.arange(shape[0]) * shape[1]
                    found.add(cells.ravel(), values.reshape(-1, shape[2]))
            yield from found.batches()

        total = Sums.collect(rows.select(vector).mapInArrow(sums, Sums.SCHEMA), shape[0] * shape[1], shape[2])
        books = Codebooks(floor_means(total, books.entries.reshape(-1, shape[2])).reshape(shape))
    return books


def encode(rows: DataFrame, books: Codebooks, width: int, vector: str = "embedding", code: str = "code",
           error: str = "error") -> DataFrame:
    """The rows with ``code`` and ``error`` in place of the vector.

    A code has two hex digits for each part; more than 256 entries take as many as they need.
    The error adds up the squared distances of the parts; one that a 64-bit number cannot
    hold is null. Columns called ``code`` or ``error`` are replaced.
    """
    kept = [c for c in rows.columns if c not in (vector, code, error)]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept),
                        f"`{code}` string, `{error}` bigint"])
    digits = max(2, len(f"{max(0, books.entries.shape[1] - 1):x}"))

    def run(batches: Iterator[pa.RecordBatch]):
        names = [f"{k:0{digits}x}" for k in range(books.entries.shape[1])]
        for batch in batches:
            for block in blocks(batch):
                entry, distance = books.assign(matrix(block.column(vector), width))
                codes = ["".join(names[k] for k in row) for row in entry.tolist()]
                errors = [e if e < 1 << 63 else None for e in map(int, distance.sum(1))]
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(c) for c in kept), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                    names=[*kept, code, error])

    return rows.select(*kept, vector).mapInArrow(run, schema)


def with_group_error(coded: DataFrame, group: str, error: str = "error", into: str = "label_error") -> DataFrame:
    """The rows with the errors of all rows of their group added up, null groups together.
    A sum that a 64-bit number cannot hold is null. A group that holds a third of the rows
    is combined before it is shuffled, and split where it meets its rows again."""
    own, hashed = fresh("group"), fresh("hash")
    total = F.try_sum(F.col(error).cast("decimal(38,0)")).try_cast("bigint")
    sums = coded.groupBy(group).agg(total.alias(into)).select(
        F.col(group).alias(own), F.xxhash64(group).alias(hashed), into)
    beside = coded.drop(into).withColumn(hashed + "_", F.xxhash64(group))
    met = (F.col(hashed) == F.col(hashed + "_")) & F.col(group).eqNullSafe(F.col(own))
    return beside.join(sums, met, "left").drop(own, hashed, hashed + "_")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors in 16 parts of 64 entries, with their errors."""
    rows, width = prepared(read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), "embedding", 16, 256)
    books = train(rows, width)
    coded = saved(encode(rows, books, width), "codes")
    return with_group_error(coded, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256).alias("codebooks_sha256"))


QUERY = op11_vector_codes

_ROUND = """
  a{r} AS MATERIALIZED (
    SELECT row, p, arg_min(e, (d, e)) AS e, min(d) AS d
    FROM (SELECT x.row, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
          FROM parts x JOIN b{r} b ON x.p = b.p) GROUP BY row, p),
  s{r} AS (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
      SELECT x.p, a.e, u.i, (sum(x.v[u.i]) - ((sum(x.v[u.i]) % count(*)) + count(*)) % count(*)) // count(*) AS m
      FROM parts x JOIN a{r} a ON x.row = a.row AND x.p = a.p, range(1, 5) AS u(i) GROUP BY x.p, a.e, u.i) GROUP BY p, e),
  b{n} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(s.v, b.v) AS v FROM b{r} b LEFT JOIN s{r} s ON b.p = s.p AND b.e = s.e),"""

SQL = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label,
      list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
  parts AS MATERIALIZED (SELECT row, CAST(p AS INTEGER) AS p, v[p * 4 + 1:p * 4 + 4] AS v FROM kept, range(0, 16) AS t(p)),
  b0 AS MATERIALIZED (SELECT p, CAST(row - 1 AS INTEGER) AS e, v FROM parts WHERE row <= 64),
  {_ROUND.format(r=0, n=1)}{_ROUND.format(r=1, n=2)}
  final AS MATERIALIZED (
    SELECT row, p, arg_min(e, (d, e)) AS e, min(d) AS d
    FROM (SELECT x.row, x.p, b.e, list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
          FROM parts x JOIN b2 b ON x.p = b.p) GROUP BY row, p),
  coded AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d) AS error FROM final GROUP BY row),
  books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT k.vec_id, c.code, CAST(c.error AS BIGINT) AS error,
  CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, books.codebooks_sha256
FROM kept k JOIN coded c ON k.row = c.row, books
"""
