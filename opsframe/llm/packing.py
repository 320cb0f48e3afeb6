"""Hierarchical packing of token sequences into windows of several lengths."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import read_table
from opsframe.llm.tokens import END_ID, WordEncoder, small_batches, tokenizer_path

# Tokens that a task gathers before it packs them, and tokens of one training step.
POOL_TOKENS, STEP_TOKENS = 2_000_000, 64 * 4096

# A piece waiting for a window: (length, document number in the pool, start).
Item = tuple[int, int, int]


def fill(items: list[Item], longest: int, shortest: int) -> Iterator[tuple[int, list[Item]]]:
    """Full windows (length, pieces) from the items; what is left, under ``shortest`` tokens
    in all, stays in the list.

    A document is routed to the shortest tier (``longest``, its half, ... ``shortest``) that
    holds it; the part over ``longest`` is cut into windows of its own. From the longest
    item down, the gap beside it is filled by the longest shorter item that fits, and at
    last by the head of the shortest one left. When too little is left to fill a tier, the
    item's head fills a window of the next shorter tier and its tail is routed again.
    """
    ready: list[Item] = []
    for length, doc, start in items:
        whole = length // longest
        for k in range(whole):
            yield longest, [(longest, doc, start + k * longest)]
        if length % longest:
            ready.append((length % longest, doc, start + whole * longest))
    ready.sort()
    total = sum(item[0] for item in ready)
    while total >= shortest:
        main = ready.pop()
        tier = shortest
        while tier < main[0]:
            tier *= 2
        if total < tier:
            tier //= 2
        if main[0] > tier:
            insort(ready, (main[0] - tier, main[1], main[2] + tier))
            main = (tier, main[1], main[2])
        pieces, gap = [main], tier - main[0]
        while gap:
            at = bisect_right(ready, (gap, 1 << 62, 0))
            if at:
                piece = ready.pop(at - 1)
            else:
                length, doc, start = ready.pop(0)
                piece = (gap, doc, start)
                insort(ready, (length - gap, doc, start + gap))
            pieces.append(piece)
            gap -= piece[0]
        total -= tier
        yield tier, pieces
    items[:] = ready


def powers(items: list[Item]) -> Iterator[tuple[int, list[Item]]]:
    """The last items in windows of powers of two, none of which needs padding."""
    total = sum(item[0] for item in items)
    while total:
        size = 1 << (total.bit_length() - 1)
        pieces, gap = [], size
        while gap:
            length, doc, start = items.pop(0)
            taken = min(gap, length)
            pieces.append((taken, doc, start))
            if taken < length:
                items.insert(0, (length - taken, doc, start + taken))
            gap -= taken
        total -= size
        yield size, pieces


def balanced_steps(windows: list[tuple[int, list[Item]]], first: int) -> tuple[list[int], int]:
    """A step for each window: windows of a step have one length and the steps of a length
    near equal attention cost, as windows are dealt to and fro in order of their cost."""
    steps, following = [0] * len(windows), first
    by_tier: dict[int, list[int]] = {}
    for k, (tier, _) in enumerate(windows):
        by_tier.setdefault(tier, []).append(k)
    for tier, members in sorted(by_tier.items(), reverse=True):
        groups = -(-len(members) * tier // STEP_TOKENS)
        members.sort(key=lambda k: -sum(p[0] ** 2 for p in windows[k][1]))
        for rank, k in enumerate(members):
            lap, at = divmod(rank, groups)
            steps[k] = following + (groups - 1 - at if lap % 2 else at)
        following += groups
    return steps, following


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
         end_id: int = END_ID, longest: int = 4096, shortest: int = 512) -> DataFrame:
    """All documents' ids in full windows of ``longest``, its halves, ... ``shortest`` tokens.

    Returns one row for each piece: the key, ``start`` and ``length`` in its document,
    ``doc_tokens``, ``ids`` (binary, little-endian unsigned 32-bit), ``sequence_id``,
    ``offset`` in the sequence, ``tier`` (the sequence's length) and ``step`` (sequences to
    train on together). Every id is in exactly one piece; a null or empty text has the end
    id alone; repeated rows are packed as documents of their own; an empty table gives no
    rows. The last tokens of a task, under ``shortest``, make windows of powers of two.

    Documents are packed within their input partition, a pool at a time, so nothing is
    shuffled and a task holds a pool at most. A task that runs again over the same files
    packs them alike; give it written data rather than the outcome of a shuffle.
    """
    path = path or tokenizer_path()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder.of(path, 4), end_id.to_bytes(4, "little")
        base = TaskContext.get().partitionId() << 40
        sequence = step = base
        keys: list = []
        ids: list[bytes] = []
        items: list[Item] = []

        def emit(windows):
            nonlocal sequence, step, keys, ids, items
            steps, step = balanced_steps(windows, step)
            out = [(keys[d], s, n, len(ids[d]) // 4, ids[d][4 * s:4 * (s + n)], sequence + w, at, tier, steps[w])
                   for w, (tier, pieces) in enumerate(windows)
                   for (n, d, s), at in zip(pieces, np.cumsum([0, *[p[0] for p in pieces]]).tolist(), strict=False)]
            sequence += len(windows)
            left = sorted({d for _, d, _ in items})
            items = [(n, left.index(d), s) for n, d, s in items]
            keys, ids = [keys[d] for d in left], [ids[d] for d in left]
            columns = list(zip(*out, strict=True)) or [()] * 9
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key_type)]
                + [pa.array(columns[k], pa.int64()) for k in (1, 2, 3)]
                + [pa.array(columns[4], pa.binary())]
                + [pa.array(columns[k], pa.int64()) for k in (5, 6)]
                + [pa.array(columns[7], pa.int32()), pa.array(columns[8], pa.int64())],
                names=[key, "start", "length", "doc_tokens", "ids", "sequence_id", "offset", "tier", "step"])

        waiting, key_type = 0, None
        for batch in small_batches(batches, text):
            key_type = batch.schema.field(key).type
            for k, x in zip(batch.column(key).to_pylist(),
                            encoder([t or "" for t in batch.column(text).to_pylist()]), strict=True):
                items.append((len(x) // 4 + 1, len(ids), 0))
                keys.append(k)
                ids.append(x + end)
                waiting += len(x) // 4 + 1
            if waiting >= POOL_TOKENS:
                yield emit(list(fill(items, longest, shortest)))
                waiting = 0
        if key_type is not None:
            yield emit([*fill(items, longest, shortest), *powers(items)])

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, start bigint, length bigint, doc_tokens bigint, ids binary, "
             "sequence_id bigint, offset bigint, tier int, step bigint")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens, one row per piece."""
    return pack(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "tier", "step")


QUERY = op1_packing
