"""Benchmark items found in documents by SimHash of item-sized windows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import fresh, read_table, saved
from opsframe.llm.tokens import small_batches
from opsframe.llm.wordhash import MARKS, Words, shingled

# Bits of a fingerprint and its blocks; bytes of item texts that a task holds at once.
BITS, BLOCKS, ITEM_BYTES = 64, 8, 8 << 20
HASHED_BYTES = 1 << 20
# Windows whose fingerprints are made at once; room for rounding in sums of weights.
RUN, _SLACK = 4096, 1e-6
# Steps of the weight that a bag lacks.
STEPS = 64

_ONES = np.array([bin(v).count("1") for v in range(256)], np.uint8)


def radius(similarity: float, misses: float = 1e-6) -> int:
    """Fingerprints of two sets of equal weights of at least this similarity differ in at
    most so many bits, but for a share of ``misses`` of such pairs."""
    return _radius(2 * similarity / (1 + similarity), misses)


@lru_cache(maxsize=1024)
def _radius(cosine: float, misses: float = 1e-6) -> int:
    """Each bit differs with the chance of the angle between the bags."""
    p, passed = math.acos(min(1.0, cosine)) / math.pi, 0.0
    for k in range(BITS + 1):
        passed += math.comb(BITS, k) * p**k * (1 - p) ** (BITS - k)
        if 1 - passed <= misses:
            return k
    return BITS


def least_cosine(bag: np.ndarray, weights: np.ndarray, similarity: float, most: float) -> float:
    """No bag of at most as many shingles, each of a weight up to ``most``, with at least this
    weighted similarity to the bag has a lower cosine with it.

    Over steps of the weight it lacks: at worst its heaviest shingles are gone, which takes
    the most from the product, and what came instead is one shingle, repeated.
    """
    sums = np.sort(np.bincount(np.unique(bag, return_inverse=True)[1], weights))[::-1]
    square, whole, single = float((sums**2).sum()), float(sums.sum()), np.cumsum(np.sort(weights))
    lost = np.linspace(0, (1 - similarity) * whole, STEPS + 1)
    gone = np.interp(lost[1:], np.concatenate([[0.0], np.cumsum(sums)]), np.concatenate([[0.0], np.cumsum(sums**2)]))
    came = most * np.searchsorted(single, lost[1:] + _SLACK, side="right")
    came = np.minimum(came, (whole - lost[:-1]) / similarity - whole)
    left = np.maximum(square - gone, 0.0)
    return float((left / np.sqrt(square * (left + came**2))).min()) if square else 1.0


def _signed(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row of +-weight by bit for each shingle."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)
    return (2 * bits - 1) * weights[:, None]


def _prints(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, as rows of eight bytes, of sums by bit; a tie is no bit, however it
    was rounded."""
    return np.packbits(sums > 1e-6, axis=1)


def _similarity(a: np.ndarray, b: np.ndarray, weight) -> float:
    """Weighted Jaccard similarity of two bags of shingles."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left = np.bincount(at[:len(a)], minlength=len(values))
    right = np.bincount(at[len(a):], minlength=len(values))
    w = weight(values)
    most = (np.maximum(left, right) * w).sum()
    return float((np.minimum(left, right) * w).sum() / most) if most else 0.0


class ItemIndex:
    """Items by their shingles and, for each byte of a fingerprint, by all values near it.

    Two fingerprints within the radius agree in some block up to radius // BLOCKS bits, so
    the items to compare are those near the window in any block. Each item has the radius of
    the least cosine that its own weights allow at the similarity. A shingle weighs
    log(1 + items / items that hold it); one that no item holds weighs as if one did.

    Where the items are a part of a table, ``held`` has the table's number of items and its
    shingles of more than one holder, in order, with their numbers of holders.
    """

    def __init__(self, items: list[tuple], words: int, similarity: float,
                 held: tuple[int, np.ndarray, np.ndarray] | None = None):
        hashed = Words([(text or "").encode("utf-8", "replace") for _, text in items], MARKS)
        own, limits = hashed.keys(), hashed.first
        self.words, self.similarity = words, similarity
        rows = [(item, own[a:b]) for (item, _), a, b in zip(items, limits[:-1], limits[1:], strict=True) if b > a]
        self.ids, self.lengths = [r[0] for r in rows], np.array([len(r[1]) for r in rows], np.int64)
        self.bags = [shingled(r[1], words) for r in rows]
        sets = [np.unique(bag) for bag in self.bags]
        self.shingles, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64),) * 2
        n, self.common, holders = held or (len(rows), self.shingles[counts > 1], counts[counts > 1])
        self.rare, self.common_weights = float(np.log(1 + max(1, n))), np.log(1 + n / holders)
        self.weights = self.weight(self.shingles)
        # The places of each item's shingles, and for each place the items that hold it.
        self.held = [np.searchsorted(self.shingles, x) for x in sets]
        places = np.concatenate(self.held) if sets else np.zeros(0, np.int64)
        order = np.argsort(places, kind="stable")
        self.holder = np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order]
        self.holder_first = np.searchsorted(places[order], np.arange(len(self.shingles) + 1))
        self.totals = np.array([self.weight(b).sum() for b in self.bags])
        self.prints = np.array([_prints(_signed(b, self.weight(b)).sum(0)[None])[0] for b in self.bags], np.uint8).reshape(-1, 8)
        cosines = [least_cosine(b, self.weight(b), similarity, self.rare) for b in self.bags]
        self.radius = np.array([_radius(math.floor(c * 256) / 256) for c in cosines], np.int64)
        values = np.arange(256, dtype=np.uint8)
        self.near = [_ONES[values[:, None] ^ self.prints[:, k][None]] <= self.radius // BLOCKS for k in range(BLOCKS)]
        self.spans = sorted({min(words, int(n)) for n in self.lengths})

    def weight(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.common):
            return np.full(len(shingles), self.rare)
        at = np.minimum(np.searchsorted(self.common, shingles), len(self.common) - 1)
        return np.where(self.common[at] == shingles, self.common_weights[at], self.rare)

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(item, first word, number of words, similarity) of the best window of each item.

        Every window of the item's length counts. Those whose shared shingles, repeats and
        all, weigh too little for the similarity are left out before the fingerprints: the
        shared weight is at least what the similarity counts, so none of them has it.
        """
        out = []
        for span in self.spans:
            if len(words) < span or not len(words):
                continue
            bag = shingled(words, span)
            at = np.minimum(np.searchsorted(self.shingles, bag), max(0, len(self.shingles) - 1))
            shared = self.shingles[at] == bag
            if not shared.any():
                continue
            weights = self.weight(bag)
            # An item's shared weight in the whole text is a bound for any window.
            found, times = np.unique(at[shared], return_counts=True)
            first, n = self.holder_first[found], self.holder_first[found + 1] - self.holder_first[found]
            holders = self.holder[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]
            held = np.bincount(holders, np.repeat(times * self.weights[found], n), len(self.ids))
            asked = (held > 0) & (held >= self.similarity * self.totals - _SLACK)
            asked &= np.minimum(self.words, self.lengths) == span
            sums = np.concatenate([[0.0], np.cumsum(weights)])
            of_item = np.zeros(len(self.shingles), bool)
            for item in np.flatnonzero(asked).tolist():
                length = int(self.lengths[item])
                size = min(length, len(words)) - span + 1
                of_item[self.held[item]] = True
                mine = np.concatenate([[0.0], np.cumsum(np.where(shared & of_item[at], weights, 0.0))])
                of_item[self.held[item]] = False
                common, whole = mine[size:] - mine[:-size], sums[size:] - sums[:-size]
                bound = common / (whole + self.totals[item] - common)
                begins = np.flatnonzero(bound >= self.similarity - _SLACK)
                if len(begins):
                    begin, value = self._best(bag, weights, begins, bound[begins], size, item)
                    if value:
                        out.append((item, begin, length, value))
        return sorted(out)

    def _best(self, bag: np.ndarray, weights: np.ndarray, begins: np.ndarray, bound: np.ndarray,
              size: int, item: int) -> tuple[int, float]:
        """The first of the most similar windows within the radius of the item, or a value
        of 0."""
        near = np.zeros(len(begins), bool)
        cuts = (np.flatnonzero((np.diff(begins) > size) | (begins[1:] // RUN != begins[:-1] // RUN)) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(begins)], strict=True):
            run, low, high = begins[a:b], int(begins[a]), int(begins[b - 1]) + size
            sums = np.concatenate([np.zeros((1, BITS)), np.cumsum(_signed(bag[low:high], weights[low:high]), axis=0)])
            prints = _prints(sums[run - low + size] - sums[run - low])
            for k in range(BLOCKS):
                near[a:b] |= self.near[k][prints[:, k], item]
            near[a:b] &= _ONES[prints ^ self.prints[item]].sum(1) <= self.radius[item]
        best = (0, 0.0)
        for w in np.flatnonzero(near)[np.argsort(-bound[near], kind="stable")].tolist():
            begin = int(begins[w])
            if bound[w] < best[1] - _SLACK:
                break
            value = _similarity(bag[begin:begin + size], self.bags[item], self.weight)
            if value >= self.similarity and (value > best[1] or value == best[1] and begin < best[0]):
                best = (begin, value)
        return best


LEAK = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("similarity", pa.float64())])


def _code_points(raw: bytes, at: int) -> int:
    return len(raw[:at].decode("utf-8", "replace"))


def _search(texts: list[str], index: ItemIndex) -> list[list[dict]]:
    out: list[list[dict]] = []
    group: list[bytes] = []

    def flush():
        hashed = Words(group, MARKS)
        own, base = hashed.keys(), 0
        for k, raw in enumerate(group):
            a, b = int(hashed.first[k]), int(hashed.first[k + 1])
            leaks = []
            for item, begin, length, value in index.matches(own[a:b]):
                last = min(a + begin + length, b) - 1
                leaks.append({"item_id": index.ids[item], "similarity": value,
                              "start": _code_points(raw, int(hashed.starts[a + begin]) - base),
                              "end": _code_points(raw, int(hashed.ends[last]) - base)})
            out.append(leaks)
            base += len(raw) + 1
        group.clear()

    held = 0
    for text in texts:
        group.append(text.encode("utf-8", "replace"))
        held += len(group[-1])
        if held > HASHED_BYTES:
            flush()
            held = 0
    if group:
        flush()
    return out


def with_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
               item_text: str = "text", words: int = 5, similarity: float = 0.8, into: str = "leaks",
               keep_text: bool = True) -> DataFrame:
    """The rows with ``leaks``: the items found in the text, as an array of (item_id, start,
    end, similarity); the span of the best window in code points, its end exclusive.

    A window has as many words (runs of letters, digits and non-ASCII characters, A-Z in
    lower case) as the item, and is a leak where its bag of ``words``-word shingles has a
    weighted similarity of at least ``similarity`` with the item's. An item or text of fewer
    words is one shingle. An item that repeats is found once for each of its rows; null or
    empty texts hold nothing and are found nowhere.

    Items reach the tasks in blocks of at most about ``ITEM_BYTES``; each block is one pass
    over the documents, with the shingles' weights of the whole table, and its leaks are
    written to the shared folder before the next block is collected. For more than one block
    the shingles that several items hold, 16 bytes each, are on the driver and in each task.
    """
    size = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    items = items.select(F.col(item_key).cast("bigint").alias("id"), F.col(item_text).alias("text"))
    found = docs.drop(into)
    columns = found.columns
    if blocks == 1:
        found = _pass(found, items, None, text, words, similarity, into)
    else:
        held, row = _holders(items, words), fresh("row")
        found = saved(found.withColumn(row, F.monotonically_increasing_id()), "documents")
        passes = []
        for block in range(blocks):
            part = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
            leaks = _pass(found.select(row, text), part, held, text, words, similarity, into)
            passes.append(saved(leaks.where(F.size(into) > 0).select(row, into), "leaks"))
        every = reduce(DataFrame.unionAll, passes).groupBy(row).agg(F.flatten(F.collect_list(into)).alias(into))
        found = found.join(every, row, "left").withColumn(
            into, F.coalesce(into, F.array().cast(every.schema[into].dataType)))
    kept = [c for c in columns if keep_text or c != text]
    return found.select(*[F.col(f"`{c}`") for c in kept], F.array_sort(into).alias(into))


def _holders(items: DataFrame, words: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of items with words, and the shingles of more than one item, in order,
    with the number of items that hold each."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, "text"):
            for t in batch.column("text").to_pylist():
                hashed = Words([(t or "").encode("utf-8", "replace")], MARKS)
                own = np.unique(hashed.shingles(words, 0, hashed.keys()))
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array([None, *own.view(np.int64).tolist()], pa.int64())], names=["shingle"])

    counts = items.select("text").mapInArrow(run, "shingle bigint").groupBy("shingle").count()
    rows = counts.where("shingle IS NULL OR count > 1").toArrow()
    shingles, n = rows.column("shingle"), rows.column("count").to_numpy()
    none = shingles.is_null().to_numpy()
    known = shingles.drop_null().to_numpy().view(np.uint64)
    order = np.argsort(known)
    return int(n[none].sum()), known[order], n[~none][order]


def _pass(docs: DataFrame, part: DataFrame, held: tuple | None, text: str, words: int, similarity: float,
          into: str) -> DataFrame:
    items = sorted(map(tuple, part.collect()), key=repr)
    kept = docs.columns
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]):
        index = ItemIndex(items, words, similarity, held)
        for batch in small_batches(batches, text):
            leaks = _search([t or "" for t in batch.column(text).to_pylist()], index)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(leaks, pa.list_(LEAK))], names=[*kept, into])

    return docs.mapInArrow(
        run, f"{schema}, `{into}` array<struct<item_id:bigint, start:bigint, end:bigint, similarity:double>>")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items found in documents: one row per document and item."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = with_leaks(docs, read_table(spark, sf_dir, "benchmark"), keep_text=False)
    return leaks.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


QUERY = op10_decontaminate
