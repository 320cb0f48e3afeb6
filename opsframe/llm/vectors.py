"""Vectors as whole numbers, and exact sums of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a task works on at once.
ROWS = 2048
_PART = 1 << 32


def finite(vectors: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector is there and holds finite components alone."""
    whole = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.where(F.col(vector).isNotNull() & whole)


def scaled(vector: str, factor: int):
    """Each component x as floor(factor * x); beyond a 64-bit number, the nearest one."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("bigint"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` whole numbers as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact(numbers: np.ndarray, bound: int) -> np.ndarray:
    """Numbers whose sums stay exact: 64 bits wide where ``bound`` fits, else of any size."""
    return numbers.astype(np.int64 if bound < 1 << 62 else object)


def largest(*numbers: np.ndarray) -> int:
    """The largest absolute value, 0 without numbers."""
    return max((max(abs(int(n.max())), abs(int(n.min()))) for n in numbers if n.size), default=0)


def blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


class Sums:
    """Exact sums and counts by cell, added up in a task.

    A sum leaves the task in parts of 32 bits, which add up over all tasks without overflow
    whatever its size. The count takes the position behind the sums.
    """

    SCHEMA = "cell int, at int, part int, value bigint"

    def __init__(self, cells: int, width: int):
        self.sums, self.counts = np.zeros((cells, width), object), np.zeros(cells, np.int64)

    def add(self, cells: np.ndarray, rows: np.ndarray, sign: int = 1) -> None:
        order = np.argsort(cells, kind="stable")
        found, first, n = np.unique(cells[order], return_index=True, return_counts=True)
        if len(found):
            rows = exact(rows, largest(rows) * len(rows))
            self.sums[found] += sign * np.add.reduceat(rows[order], first, axis=0).astype(object)
            self.counts[found] += sign * n

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The parts of everything that is not 0."""
        whole = np.concatenate([self.sums, self.counts[:, None].astype(object)], 1)
        out: list[tuple[int, int, int, int]] = []
        for cell, at in zip(*(i.tolist() for i in np.nonzero(whole)), strict=True):
            value, part = int(whole[cell, at]), 0
            while not -_PART <= value < _PART:
                out.append((cell, at, part, value % _PART))
                value, part = value // _PART, part + 1
            out.append((cell, at, part, value))
        columns = np.array(out, np.int64).reshape(-1, 4).T
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c.astype(np.int32)) for c in columns[:3]), pa.array(columns[3])], names=["cell", "at", "part", "value"])

    @classmethod
    def collect(cls, parts: DataFrame, cells: int, width: int) -> Sums:
        """The sums of all tasks: a few rows per cell and position reach the driver."""
        whole = np.zeros((cells, width + 1), object)
        for r in parts.groupBy("cell", "at", "part").agg(F.sum("value").alias("value")).collect():
            whole[r["cell"], r["at"]] += r["value"] * _PART ** r["part"]
        out = cls(cells, width)
        out.sums, out.counts = whole[:, :-1], whole[:, -1].astype(np.int64)
        return out

    def plus(self, other: Sums) -> Sums:
        self.sums += other.sums
        self.counts += other.counts
        return self


def floor_means(sums: Sums, before: np.ndarray) -> np.ndarray:
    """floor(sum / count) of each cell; a cell without rows keeps its value of before."""
    out = before.astype(object)
    for cell in np.flatnonzero(sums.counts):
        out[cell] = [int(s) // int(sums.counts[cell]) for s in sums.sums[cell]]
    return out
