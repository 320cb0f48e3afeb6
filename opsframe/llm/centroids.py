"""Centroid clustering that scans a vector again only when its bounds allow another centroid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import fresh, read_table
from opsframe.llm.vectors import Sums, blocks, exact, finite, floor_means, largest, matrix, scaled
from opsframe.sources.storage import new_path

#: Gaps are whole multiples of 2**-20, rounded to the safe side, and end at _FAR; once the
#: drift is longer than that, vectors are scanned in every round.
_UNIT, _FAR = 1 << 20, 1 << 60
# What rounding can change of a root, taken a thousand times.
_SLACK = 1e-12
# Small row groups, so that reading the expired end of a heap skips most of a file.
_HEAP_FILE = {"parquet.block.size": str(4 << 20)}


def squared_distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids.

    Products of whole numbers below 2**53 are exact as floats too, which is faster.
    """
    bound = 4 * max(1, rows.shape[1]) * max(1, largest(rows, centroids)) ** 2
    if bound < 1 << 53:
        x, c = rows.astype(float), centroids.astype(float)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
    x, c = exact(rows, bound), exact(centroids, bound)
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]


def scan(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, of equals the smaller number, and the gap: how much
    nearer it is at least than any other one, in units; 0 or less where that is not sure."""
    d = squared_distances(rows, centroids)
    at = np.arange(len(d))
    cluster = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
    upper = np.sqrt(d[at, cluster].astype(float)) * (1 + _SLACK)
    others = d.astype(float)
    others[at, cluster] = np.inf
    lower = np.sqrt(others.min(axis=1)) * (1 - _SLACK) if len(d) else upper
    gap = np.minimum(np.floor((lower - upper) * _UNIT), float(_FAR))
    return cluster.astype(np.int32), gap.astype(np.int64)


def drifts(before: np.ndarray, after: np.ndarray) -> list[int]:
    """For each cluster, by how much the gap of its vectors shrinks at most: its own
    centroid's way and the longest way of another one."""
    way = [int(np.sqrt(float(sum(int(x) ** 2 for x in a - b))) * (1 + _SLACK) * _UNIT) + 1
           for a, b in zip(after, before, strict=True)]
    return [own + max(way[:k] + way[k + 1:], default=0) for k, own in enumerate(way)]


class Clustering:
    """Vectors dealt to their nearest centroids, round by round.

    Each cluster has a heap of its vectors, ordered by when their gap expires: the gap found
    by the last scan plus the drift that the cluster had accumulated by then. A heap lies in
    the shared folder as levels, files sorted by cluster and key. A round writes one level,
    of the vectors it scanned, and never changes an earlier one. The vectors whose key lies
    between the accumulated drift of the last round and that of this one are popped: that is
    a filter on the sorted columns, which skips the row groups of all others. They are
    scanned against all centroids and pushed into the new level; what lies above the drift
    is where it belongs, unread. Lost tasks are run again from the level's files.

    Sums, counts and squared lengths of the clusters are carried on by what the popped
    vectors change, so that means and inertia are exact without reading the others.
    """

    def __init__(self, rows: DataFrame, centroids: np.ndarray, vector: str):
        self.rows, self.centroids, self.vector = rows, centroids, vector
        self.k, self.width = centroids.shape
        self.cluster, self.was, self.key = fresh("cluster"), fresh("was"), fresh("key")
        self.drift = [0] * self.k
        self.levels: list[DataFrame] = []
        self.sums = Sums(self.k, self.width + 1)
        self._push(rows.withColumn(self.was, F.lit(-1)))

    def _push(self, popped: DataFrame) -> None:
        """Scan the vectors, write them as a level and add what they change to the sums."""
        vector, was, centroids, drift = self.vector, self.was, self.centroids, np.array(self.drift, object)
        kept = [c for c in self.rows.columns if c != vector]
        names = [*kept, vector, was, self.cluster, self.key]
        kinds = {**dict(self.rows.dtypes), was: "int", self.cluster: "int", self.key: "bigint"}

        def run(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for block in blocks(batch):
                    rows = matrix(block.column(vector), centroids.shape[1])
                    cluster, gap = scan(rows, centroids)
                    key = np.where(drift[cluster] < _FAR, gap + drift[cluster], -_FAR).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [*(block.column(c) for c in [*kept, vector, was]), pa.array(cluster), pa.array(key)], names=names)

        path = new_path(self.rows.sparkSession, "heap")
        level = popped.select(*kept, vector, was).mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in names))
        level.sortWithinPartitions(self.cluster, self.key).write.options(**_HEAP_FILE).parquet(path)
        self.levels.append(self.rows.sparkSession.read.schema(level.schema).parquet(path))
        self._count(self.levels[-1].where(F.col(self.cluster) != F.col(was)))

    def _count(self, moved: DataFrame) -> None:
        """Take the moved vectors from the sums of where they were to those of where they are.
        The last position adds up squared lengths."""
        k, width, cells = self.k, self.width, (self.cluster, self.was)

        def run(batches: Iterator[pa.RecordBatch]):
            found = Sums(k, width + 1)
            for batch in batches:
                for block in blocks(batch):
                    rows = matrix(block.column(2), width)
                    rows = exact(rows, (width + 1) * max(1, largest(rows)) ** 2)
                    whole = np.concatenate([rows, (rows * rows).sum(1)[:, None]], 1)
                    now, before = (block.column(c).to_numpy() for c in range(2))
                    found.add(now, whole)
                    found.add(before[before >= 0], whole[before >= 0], -1)
            yield from found.batches()

        parts = moved.select(*cells, self.vector).mapInArrow(run, Sums.SCHEMA)
        self.sums = self.sums.plus(Sums.collect(parts, k, width + 1))

    def _in_heap(self, level: DataFrame, above: list[int] | None, up_to: list[int] | None = None) -> DataFrame:
        """The level's vectors with keys above one bound of their cluster and up to another.
        No key exceeds twice _FAR, so a longer drift has all of them expired."""
        def one(c: int) -> Column:
            held = F.col(self.cluster) == c
            if above is not None:
                held &= F.col(self.key) > min(above[c], 2 * _FAR)
            return held if up_to is None else held & (F.col(self.key) <= min(up_to[c], 2 * _FAR))
        return level.where(reduce(Column.__or__, map(one, range(self.k))))

    def round(self) -> None:
        """Replace each centroid that has vectors by their floored mean, and deal the vectors
        whose gap has expired anew."""
        mean = Sums(self.k, self.width)
        mean.sums, mean.counts = self.sums.sums[:, :-1], self.sums.counts
        centroids = floor_means(mean, self.centroids)
        before = self.drift
        self.drift = [a + d for a, d in zip(before, drifts(self.centroids, centroids), strict=True)]
        self.centroids = centroids
        # The newest level has not been popped yet, not even of gaps that were never sure.
        popped = [self._in_heap(level, before, self.drift) for level in self.levels[:-1]]
        popped.append(self._in_heap(self.levels[-1], None, self.drift))
        again = reduce(DataFrame.unionAll, popped)
        kept = [c for c in self.rows.columns if c != self.vector]
        self._push(again.select(*kept, self.vector, F.col(self.cluster).alias(self.was)))

    def members(self) -> DataFrame:
        """Every row once, with its vector and its ``cluster``."""
        held = [self._in_heap(level, self.drift) for level in self.levels[:-1]]
        return reduce(DataFrame.unionAll, [*held, self.levels[-1]]).drop(self.was, self.key)

    def inertia(self) -> list[int]:
        """For each cluster, the squared distances of its vectors to its centroid added up."""
        out = []
        for c, total, n in zip(self.centroids, self.sums.sums, self.sums.counts, strict=True):
            across = sum(int(x) * int(s) for x, s in zip(c, total, strict=False))
            out.append(int(total[-1]) - 2 * across + int(n) * sum(int(x) ** 2 for x in c))
        return out


def prepared(vectors: DataFrame, vector: str = "embedding", width: int = 64, scale: int = 64) -> DataFrame:
    """The rows whose vector has ``width`` components, none null or non-finite, with these
    as whole numbers."""
    kept = finite(vectors.where(F.size(vector) == width), vector)
    return kept.withColumn(vector, scaled(vector, scale))


def first_centroids(rows: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", seed: int = 1) -> np.ndarray:
    """The vectors whose key has the smallest hashes; null keys come last, and vectors of
    equal keys by their components. Fewer rows make fewer centroids."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"), 256)
    first = rows.select(order.alias("hash"), vector).orderBy(F.asc_nulls_last("hash"), vector).limit(k).collect()
    return np.array([r[vector] for r in first], object)


def clustered(rows: DataFrame, centroids: np.ndarray, rounds: int, vector: str = "embedding") -> Clustering:
    """Deal the vectors, then move the centroids and deal them anew ``rounds`` times."""
    out = Clustering(rows, centroids, vector)
    for _ in range(rounds):
        out.round()
    return out


def with_distances(found: Clustering, cluster: str = "cluster", distance: str = "distance") -> DataFrame:
    """The rows with their cluster and exact squared distance in place of the vector. A
    distance that a 64-bit number cannot hold is null. Columns of these names are replaced."""
    vector, own, centroids = found.vector, found.cluster, found.centroids
    kept = [c for c in found.rows.columns if c not in (vector, cluster, distance)]
    schema = ", ".join([*(f"`{c}` {found.rows.schema[c].dataType.simpleString()}" for c in kept),
                        f"`{cluster}` int, `{distance}` bigint"])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block in blocks(batch):
                rows, at = matrix(block.column(vector), centroids.shape[1]), block.column(own)
                bound = 4 * centroids.shape[1] * max(1, largest(rows, centroids)) ** 2
                away = exact(rows, bound) - exact(centroids, bound)[at.to_numpy()]
                values = [d if d < 1 << 63 else None for d in map(int, (away * away).sum(1))]
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(c) for c in kept), at, pa.array(values, pa.int64())], names=[*kept, cluster, distance])

    return found.members().select(*kept, vector, own).mapInArrow(run, schema)


def _long(value: int) -> Column:
    return F.lit(value if abs(value) < 1 << 63 else None).cast("bigint")


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds of 16 centroids, with the inertia."""
    rows = prepared(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    centroids = first_centroids(rows, 16)
    if not len(centroids):
        return rows.where("false").select(
            "vec_id", *[F.lit(None).cast(t).alias(n) for n, t in [
                ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
                ("centroid_sha256", "string")]])
    found = clustered(rows, centroids, 3)
    inertia = found.inertia()
    digests = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in found.centroids]
    by_cluster = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return with_distances(found).select(
        "vec_id", "cluster", "distance", by_cluster([_long(i) for i in inertia]).alias("cluster_inertia"),
        _long(sum(inertia)).alias("inertia"), by_cluster([F.lit(d) for d in digests]).alias("centroid_sha256"))


QUERY = op13_centroids

_ROUND = """
  a{r} AS MATERIALIZED (
    SELECT row, arg_min(c, (d, c)) AS c FROM (
      SELECT k.row, b.c, list_sum(list_transform(list_zip(k.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
      FROM kept k, b{r} b) GROUP BY row),
  s{r} AS (
    SELECT c, list(m ORDER BY i) AS v FROM (
      SELECT a.c, u.i, (sum(k.v[u.i]) - ((sum(k.v[u.i]) % count(*)) + count(*)) % count(*)) // count(*) AS m
      FROM kept k JOIN a{r} a ON k.row = a.row, range(1, 65) AS u(i) GROUP BY a.c, u.i) GROUP BY c),
  b{n} AS MATERIALIZED (SELECT b.c, coalesce(s.v, b.v) AS v FROM b{r} b LEFT JOIN s{r} s ON b.c = s.c),"""

SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) AS row, vec_id,
      list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
  b0 AS MATERIALIZED (SELECT CAST(row - 1 AS INTEGER) AS c, v FROM kept WHERE row <= 16),
  {"".join(_ROUND.format(r=r, n=r + 1) for r in range(3))}
  final AS MATERIALIZED (
    SELECT row, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
      SELECT k.row, b.c, list_sum(list_transform(list_zip(k.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
      FROM kept k, b3 b) GROUP BY row)
SELECT k.vec_id, f.c AS cluster, CAST(f.d AS BIGINT) AS distance,
  CAST(sum(f.d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(b.v, ',')) AS centroid_sha256
FROM kept k JOIN final f ON k.row = f.row JOIN b3 b ON f.c = b.c
"""
