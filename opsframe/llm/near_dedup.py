"""Near-duplicate documents by bottom-k sketches from one hash function."""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import read_table, saved
from opsframe.llm.links import components
from opsframe.llm.tokens import small_batches
from opsframe.llm.wordhash import Words

# Values a sketch retains, and those of them whose neighbours make inverted lists.
RETAINED, LISTED = 48, 32
# Bytes hashed at once; members, and values of their sets, that one task compares with as many.
HASHED_BYTES, BLOCK, BLOCK_VALUES = 1 << 20, 2000, 1 << 20
# Below this similarity, in percent, lists of two neighbours would lose pairs.
LEAST_PERCENT = 80


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The set of each whole text: distinct hashes of its word shingles, ascending. With
    fewer words the whole sequence is one shingle; a text without words has none."""
    group: list[bytes] = []

    def flush():
        hashed = Words(group)
        own = hashed.keys()
        for k in range(len(group)):
            yield np.unique(hashed.shingles(words, k, own) >> np.uint64(1)).view(np.int64)
        group.clear()

    held = 0
    for text in texts:
        group.append(text.encode("utf-8", "replace"))
        held += len(group[-1])
        if held > HASHED_BYTES:
            yield from flush()
            held = 0
    if group:
        yield from flush()


def sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``id``, ``n`` (the set's size), ``print`` (a 128-bit digest of the set, null for an
    empty one) and ``sketch`` (its least ``RETAINED`` hashes, ascending)."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, "text"):
            sets = list(shingle_sets([t or "" for t in batch.column("text").to_pylist()], words))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([s[:RETAINED] for s in sets], pa.list_(pa.int64())),
            ], names=["id", "n", "print", "sketch"])

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id bigint, n bigint, print binary, sketch array<bigint>")


def least_common(percent: int, misses: float = 1e-9) -> int:
    """So many of the union's first ``RETAINED`` hashes are common to two sets of at least
    this similarity, but for a share of ``misses`` of such pairs."""
    p, seen = percent / 100, 0.0
    for c in range(RETAINED + 1):
        seen += math.comb(RETAINED, c) * p**c * (1 - p) ** (RETAINED - c)
        if seen > misses:
            return c
    return 0


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose union sketch allows the similarity. Sketches that hold
    their whole sets decide it."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("sketch").alias(f"s{s}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").where(_near_sizes(F.col("na"), F.col("nb"), percent))
    common = F.array_intersect("sa", "sb")
    union = F.array_sort(F.array_union("sa", "sb"))
    whole = (F.col("na") <= RETAINED) & (F.col("nb") <= RETAINED)
    in_sketch = F.size(F.array_intersect(F.slice(union, 1, RETAINED), common))
    return both.where(F.when(whole, F.size(common) * 100 >= F.size(union) * percent)
                      .otherwise(in_sketch >= least_common(percent))).select("a", "b")


def _sets_of(docs: DataFrame, asked: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``node`` and ``set`` (the full set as raw 64-bit numbers) of the asked nodes. Only their
    texts are hashed again; sets of all documents are never kept."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, "text"):
            sets = [s.tobytes() for s in shingle_sets([t or "" for t in batch.column("text").to_pylist()], words)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])

    texts = docs.select(F.col(key).cast("bigint").alias("node"), F.col(text).alias("text")).join(asked, "node", "left_semi")
    return texts.mapInArrow(run, "node bigint, set binary")


def _verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets have the similarity."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            a, b, sa, sb = (batch.column(c).to_pylist() for c in ("a", "b", "sa", "sb"))
            held = []
            for k, (x, y) in enumerate(zip(sa, sb, strict=True)):
                x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                if common * 100 >= (len(x) + len(y) - common) * percent:
                    held.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([side[k] for k in held], pa.int64()) for side in (a, b)], names=["a", "b"])

    pairs = saved(pairs, "candidates")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = saved(_sets_of(docs, asked, key, text, words), "sets")
    side = lambda s: sets.select(F.col("node").alias(s), F.col("set").alias(f"s{s}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a bigint, b bigint").distinct()


class _Merged(dict):
    """A union-find forest of numbers."""

    def root(self, k: int) -> int:
        while (up := self.setdefault(k, k)) != k:
            self[k] = self[up]
            k = up
        return k

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)
        return a != b


class _Block:
    """Nodes compared within one task: their sets or sketches in inverted form."""

    def __init__(self, members: list[tuple]):
        self.node, self.n, self.component, self.part = (np.array([m[k] for m in members], np.int64) for k in range(4))
        values = [m[4] for m in members]
        sizes = np.array([len(v) for v in values])
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        every = every[order]
        starts = np.ones(len(every), bool)
        starts[1:] = every[1:] != every[:-1]
        self.begin = np.append(np.flatnonzero(starts), len(order))
        self.code = np.empty(len(order), np.int32)
        self.code[order] = np.cumsum(starts, dtype=np.int32) - 1
        self.holders = np.repeat(np.arange(len(members), dtype=np.int32), sizes)[order]  # ascending in each list
        self.first = np.concatenate([[0], np.cumsum(sizes)])

    def pairs(self, apart: bool, near) -> Iterator[tuple[int, int]]:
        """Pairs of different components, and of different parts if ``apart``, for which
        ``near(shared, size, sizes)`` holds. The largest component is only compared with."""
        names, counts = np.unique(self.component, return_counts=True)
        largest = names[np.argmax(counts)]
        for k in np.flatnonzero(self.component != largest):
            lists = [self.holders[self.begin[c]:self.begin[c + 1]] for c in self.code[self.first[k]:self.first[k + 1]]]
            shared = np.bincount(np.concatenate(lists), minlength=len(self.node))
            found = near(shared, self.n[k], self.n) & (self.component != self.component[k])
            if apart:
                found &= self.part != self.part[k]
            for other in np.flatnonzero(found):
                yield int(k), int(other)


def _blocks(batches: Iterator[pa.RecordBatch], decode) -> Iterator[tuple[bool, _Block]]:
    """The rows of a group, or of two blocks of a large one, which follow each other."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("list", "pair", "node", "n", "component", "part")),
                           decode(batch.column("set")), strict=True)

    for (_, pair), group in groupby(rows(), lambda r: r[:2]):
        first, i, second, j = pair.values()
        yield (first, i) != (second, j), _Block([r[2:] for r in group])


def _dealt(rows: DataFrame, group: str, held: Column, percent: int) -> DataFrame:
    """Rows of a group together; ``held`` is the number of a row's values.

    A group that is more than a block is cut in bands of set sizes, each as wide as two
    similar sets may differ, and a band in blocks. Blocks of a band meet each other and those
    of the next band, in a task for each pair, and no others: sets further apart in size are
    not similar. Where two bands hold one component nothing is compared.
    """
    def blocks(n: Column, values: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(values / BLOCK_VALUES)).cast("int")

    measured = [blocks(F.count("*"), F.sum(held)).alias("blocks"), F.min("component").alias("low"),
                F.max("component").alias("high")]
    whole = rows.groupBy(group).agg(*measured).where("low <> high").select(group, (F.col("blocks") > 1).alias("large"))
    # A hair wider, so that rounding never puts two similar sets into bands that do not meet.
    width = max(math.log(100 / percent), 1e-6) * (1 + 1e-9)
    banded = rows.join(whole, group).withColumn(
        "band", F.when(F.col("large"), F.floor(F.log("n") / width)).otherwise(0).cast("int"))
    bands = banded.groupBy(group, "band").agg(*measured)
    about = bands.withColumn("d", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).groupBy(
        group, (F.col("band") + F.col("d")).alias("band")).agg(*[
            F.max(F.when(F.col("d") == d, F.struct("blocks", "low", "high"))).alias(name)
            for name, d in (("lower", 1), ("own", 0), ("upper", -1))]).where("own IS NOT NULL")

    def met(side: str, pair) -> Column:
        """The block pairs with a side, unless it and the own one are one component."""
        s, own = F.col(side), F.col("own")
        mixed = s.isNotNull() & (F.least(s["low"], own["low"]) != F.greatest(s["high"], own["high"]))
        return F.when(mixed, F.transform(F.sequence(F.lit(0), s["blocks"] - 1), pair)).otherwise(F.array())

    def pair(first: Column, i: Column, second: Column, j: Column) -> Column:
        return F.struct(first.alias("first"), i.alias("i"), second.alias("second"), j.alias("j"))

    band, part = F.col("band"), F.col("part")
    dealt = banded.join(about, [group, "band"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("own")["blocks"]).cast("int")).withColumn("pair", F.explode(F.concat(
            met("own", lambda o: pair(band, F.least(part, o), band, F.greatest(part, o))),
            met("upper", lambda o: pair(band, part, band + 1, o)),
            met("lower", lambda o: pair(band - 1, o, band, part)))))
    side = F.when(F.col("pair")["first"] == band, 0).otherwise(1)
    return dealt.select(
        F.col(group).alias("list"), "pair", "node", "n", "component", (part * 2 + side).alias("part"), "set",
    ).repartition("list", "pair").sortWithinPartitions("list", "pair", "node")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([min(p) for p in pairs], pa.int64()), pa.array([max(p) for p in pairs], pa.int64())], names=["a", "b"])


def _families(listed: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Groups of nodes (``node``, ``component`` for the group) that hold every pair of
    different components which shares a list and, by its sketches, may be similar.

    A list's task tells which of its members belong together, one row for each, and never
    the pairs themselves.
    """
    least = least_common(percent)

    def near(shared, n, others):
        whole = (n <= RETAINED) & (others <= RETAINED)
        sizes = np.minimum(n, others) * 100 >= np.maximum(n, others) * percent
        return sizes & np.where(whole, shared * 100 >= (n + others - shared) * percent, shared >= least)

    def sketches_of(column: pa.Array) -> list[np.ndarray]:
        values, ends = column.flatten().to_numpy(), np.cumsum([0, *column.value_lengths().to_pylist()])
        return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def run(batches):
        for apart, block in _blocks(batches, sketches_of):
            merged = _Merged()
            for a, b in block.pairs(apart, near):
                merged.join(a, b)
            found = [(int(block.node[merged.root(k)]), int(block.node[k])) for k in list(merged) if merged.root(k) != k]
            if found:
                yield _edges(found)

    labelled = listed.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    rows = labelled.join(mixed.select("list"), "list").join(nodes.select("node", "n", F.col("sketch").alias("set")), "node")
    return components(_dealt(rows, "list", F.least("n", F.lit(RETAINED)), percent).mapInArrow(run, "a bigint, b bigint").distinct())


def _links_within(families: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components of a family, by full sets: enough of them to tell
    what hangs together, at most one less than the components."""
    def near(shared, n, others):
        return shared * 100 >= (n + others - shared) * percent

    def run(batches):
        for apart, block in _blocks(batches, lambda c: [np.frombuffer(s, np.int64) for s in c.to_pylist()]):
            merged = _Merged()
            found = [(int(block.node[a]), int(block.node[b])) for a, b in block.pairs(apart, near)
                     if merged.join(int(block.component[a]), int(block.component[b]))]
            if found:
                yield _edges(found)

    rows = (
        sets.withColumn("n", (F.octet_length("set") / 8).cast("bigint"))
        .join(families.select("node", F.col("component").alias("family")), "node")
        .join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    )
    return _dealt(rows, "family", F.col("n"), percent).mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked where 100 * intersection >= ``percent`` * union of their shingle
    sets; a component's id is its smallest document id, and that document is kept. A
    ``percent`` under ``LEAST_PERCENT`` is refused: two sets share no list with a chance of
    about 3e-5 at 60 and 1e-3 at 50, and small sets could be lost for certain.

    1. Documents with equal sets are one node. 2. The least retained hashes of a node make
    inverted lists, one for each two neighbours among them: neighbours in the union's sketch
    that both sets hold are neighbours in both, so two similar sets share a list but for one
    pair in some 10**9, and in none where the sketches hold the whole sets. 3. In each list
    all members are compared with the least one: union sketches filter, full sets verify.
    4. Lists whose members are by then in one component are done. In the others, members of
    different components that may be similar by their sketches make families, and the full
    sets of a family meet in a task, or its blocks pair by pair as far as their sizes allow the
    similarity (members of like sizes, and not yet one component, make a number of pairs of
    blocks that grows with its square), where components are joined by exact links. No list is cut or skipped, and no task emits more rows than it has
    members, however many pairs come near the similarity.

    An empty or null text links with nothing; rows that repeat an id count as one document
    with several texts; a row without id joins documents of an equal set and no others, and
    is kept when no document with an id has that set. An empty table gives no rows.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"similarities under {LEAST_PERCENT} percent would lose pairs: {percent}")
    table = saved(sketches(docs, key, text, words), "sketches")
    groups = table.where("n > 0").groupBy("print").agg(F.min("id").alias("node"))
    nodes = saved(table.where("n > 0 AND id IS NOT NULL").groupBy("print").agg(
        F.min("id").alias("node"), F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch"),
    ).select("node", "n", "sketch"), "nodes")
    values = F.slice("sketch", 1, LISTED)
    entries = nodes.where("n > 1").select("node", F.explode(F.zip_with(
        values, F.slice("sketch", 2, LISTED - 1), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b)))).alias("list"),
    ).where("list IS NOT NULL")
    lists = entries.groupBy("list").agg(F.count("*").alias("members"), F.min("node").alias("pivot")).where("members > 1")
    listed = saved(entries.join(lists.select("list", "pivot"), "list"), "lists")

    star = listed.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = saved(_verified(_estimated(star, nodes, percent), docs, key, text, words, percent), "links")
    labels = components(links)
    families = _families(listed.select("list", "node"), labels, nodes, percent)
    sets = saved(_sets_of(docs, families.select("node"), key, text, words), "sets")
    more = saved(_links_within(families, labels, sets, percent), "links")
    if not more.isEmpty():
        labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    named = groups.join(labels, "node", "left").select("print", F.coalesce("component", "node").alias("component_id"))
    found = table.select("id", "n", "print").join(named, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.col("id").eqNullSafe(component).alias("kept"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by three-word shingles at a similarity of 0.85."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=3, percent=85).withColumnRenamed("id", "doc_id")


QUERY = op5_near_dedup
