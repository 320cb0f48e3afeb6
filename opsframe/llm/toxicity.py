"""Toxicity by a logistic model that is regularised with counterfactual sentences."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import read_table, saved
from opsframe.llm.labelled import id_remainder, sample
from opsframe.llm.tokens import small_batches
from opsframe.llm.wordhash import MARKS, Words

#: Groups of terms that may stand for each other. A caller names its own.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man"), ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "trans"), ("muslims", "christians", "jews", "hindus", "atheists"),
    ("muslim", "christian", "jewish", "hindu"), ("immigrants", "foreigners", "refugees", "natives"),
    ("old", "young"), ("disabled", "blind", "deaf"),
)

# A word counts whole and by its first bytes, as inflected words share these.
PREFIXES = (None, 4, 5, 6)
# Bytes hashed at once, which takes some 30 times as much memory.
HASHED_BYTES = 1 << 20


def word_features(texts: list[str]) -> list[np.ndarray]:
    """The distinct features of each text, as sorted 64-bit hashes."""
    out: list[np.ndarray] = []
    group: list[bytes] = []

    def flush():
        words = Words(group, MARKS)
        sides = [words.hashes(k, p) for k, p in enumerate(PREFIXES)]
        for a, b in zip(words.first[:-1], words.first[1:], strict=True):
            out.append(np.unique(np.concatenate([side[a:b] for side in sides])).view(np.int64))
        group.clear()

    held = 0
    for text in texts:
        group.append(text.encode("utf-8", "replace"))
        held += len(group[-1])
        if held > HASHED_BYTES:
            flush()
            held = 0
    flush()
    return out


class Swaps:
    """Sentences with an identity term, beside the same sentence with that term replaced by
    the next one of its group: one pair for each term of a sentence. A term of several
    groups keeps to the first of them.

    Of a text the ``sentences`` with the least checksums are taken, which bounds what a very
    long text of the sample adds.
    """

    def __init__(self, groups=IDENTITY_TERMS, sentences: int = 4):
        self.next: dict[str, str] = {}
        for g in groups:
            for k, term in enumerate(g):
                self.next.setdefault(term.lower(), g[(k + 1) % len(g)])
        self.sentences = sentences
        self.terms = re.compile(r"\b(" + "|".join(map(re.escape, self.next)) + r")\b", re.I) if self.next else None

    def pairs(self, text: str) -> list[tuple[str, str]]:
        if not self.terms or not self.terms.search(text):
            return []
        found = {s for s in re.split(r"(?<=[.!?])\s+|\n", text) if self.terms.search(s)}
        chosen = sorted(found, key=lambda s: (zlib.crc32(s.encode("utf-8", "replace")), s))[:self.sentences]
        return [(s, self._with_other(s, term)) for s in chosen
                for term in sorted({m.lower() for m in self.terms.findall(s)} & self.next.keys())]

    def _with_other(self, sentence: str, term: str) -> str:
        return self.terms.sub(lambda m: self.next[term] if m[0].lower() == term else m[0], sentence)


def neutral_groups(labelled: DataFrame, terms: int = 64, least: int = 20, alike: float = 0.5) -> list[tuple[str, ...]]:
    """Pairs of terms of ``labelled`` (``text``, ``label``) that may stand for each other.

    Candidates are the ``terms`` commonest words of letters, held by at least ``least`` rows,
    that the labels do not tell apart: their log odds lie within 1.64 standard errors of
    none. Two are grouped where their neighbouring words are alike, by the cosine of positive
    pointwise mutual information, the most alike first. Spark counts words and neighbours;
    the driver holds a table of ``terms`` by twice as many neighbours.
    """
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    told = labelled.select("label", words.alias("ws"))
    totals = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    held = (told.select("label", F.explode(F.array_distinct("ws")).alias("w")).where(F.length("w").between(2, 20))
            .groupBy("w").agg(F.count("*").alias("n"), F.sum("label").alias("t")).where(F.col("n") >= least))
    cells = [F.col("t"), F.col("n") - F.col("t"), F.lit(totals.get(1, 0)) - F.col("t"),
             F.lit(totals.get(0, 0)) - F.col("n") + F.col("t")]
    in_toxic, in_clean, out_toxic, out_clean = (c + F.lit(0.5) for c in cells)
    error = F.sqrt(1 / in_toxic + 1 / in_clean + 1 / out_toxic + 1 / out_clean)
    odds = F.log(in_toxic * out_clean / (in_clean * out_toxic))
    named = sorted(r["w"] for r in held.where(F.abs(odds) < 1.64 * error).orderBy(F.desc("n"), "w").limit(terms).collect())
    if len(named) < 2:
        return []
    at, size = {w: k for k, w in enumerate(named)}, len(named)
    beside = F.explode(F.arrays_zip(F.slice("ws", 1, F.size("ws") - 1).alias("a"), F.slice("ws", 2, F.size("ws") - 1).alias("b")))
    counted = (told.where(F.size("ws") > 1).select(beside.alias("p")).select("p.a", "p.b")
               .where(F.col("a").isin(named) | F.col("b").isin(named))
               .select(*[F.when(F.col(c).isin(named), F.col(c)).alias(c) for c in ("a", "b")])
               .groupBy("a", "b").count().collect())
    near = np.zeros((size, 2 * size + 2))  # those after it, then those before it; the last of each is any other word
    for r in counted:
        if r["a"] is not None:
            near[at[r["a"]], at.get(r["b"], size)] += r["count"]
        if r["b"] is not None:
            near[at[r["b"]], size + 1 + at.get(r["a"], size)] += r["count"]
    expected = near.sum(1, keepdims=True) * near.sum(0) / max(1.0, near.sum())
    profile = np.log(np.maximum(1.0, np.divide(near, expected, out=np.ones_like(near), where=expected > 0)))
    norms = np.linalg.norm(profile, axis=1)
    cosine = profile @ profile.T / np.maximum(1e-12, np.outer(norms, norms))
    groups, used = [], set()
    for value, i, j in sorted((-round(cosine[i, j], 9), i, j) for i in range(size) for j in range(i + 1, size)):
        if -value >= alike and not {i, j} & used:
            groups.append((named[i], named[j]))
            used |= {i, j}
    return groups


@dataclass
class ToxicityModel:
    """Weights of the chosen features, by ascending hash."""

    chosen: np.ndarray
    weights: np.ndarray
    intercept: float
    pairs: int = 0  # of sentences that it was regularised with

    def score(self, texts: list[str]) -> np.ndarray:
        raw = np.full(len(texts), self.intercept)
        if len(self.chosen):
            for k, found in enumerate(word_features(texts)):
                raw[k] += self.weights[places(found, self.chosen)].sum()
        return 1 / (1 + np.exp(-raw))


def places(found: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Where the features that were chosen stand among the chosen ones."""
    at = np.minimum(np.searchsorted(chosen, found), max(0, len(chosen) - 1))
    return at[chosen[at] == found] if len(chosen) else at[:0]


def fit(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]],
        counts: np.ndarray, size: int, ridge: float, counterfactual: float, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise log loss + ridge * |w|^2 + counterfactual * the
    mean squared change of the raw score over the pairs, by Adam over all rows. A pair is
    the features that either side alone has; ``counts`` says how often it occurs."""
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    w, b = np.zeros(size), float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return w, b
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate(rows).astype(np.int64)
    p_row = np.repeat(np.arange(len(pairs)), [len(x) + len(z) for x, z in pairs]) if pairs else np.zeros(0, int)
    p_col = np.concatenate([np.concatenate(p) for p in pairs]).astype(np.int64) if pairs else p_row
    sign = np.concatenate([np.concatenate([np.ones(len(x)), -np.ones(len(z))]) for x, z in pairs]) if pairs else p_row
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-(np.bincount(row, w[col], len(y)) + b))) - y) / len(y)
        grad = np.bincount(col, error[row], size) + 2 * ridge * w
        if len(pairs):
            change = np.bincount(p_row, sign * w[p_col], len(pairs)) * (counts / counts.sum())
            grad += 2 * counterfactual * np.bincount(p_col, sign * change[p_row], size)
        full = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full * full
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def train(labelled: DataFrame, groups=IDENTITY_TERMS, size: int = 4000, ridge: float = 2e-5,
          counterfactual: float = 10.0, least: int = 5) -> ToxicityModel:
    """A model from ``text`` and ``label`` (0 or 1).

    Spark counts the rows of each label that hold a feature, and the ``size`` features that
    tell them apart best are chosen, those of the identity terms always. The driver holds
    the chosen features of the sampled rows alone. Of a pair of sentences only the features
    that one side has alone matter; equal pairs are counted by Spark, so the driver holds at
    most a few hundred for each term.
    """
    swaps = Swaps(groups)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            pairs = [swaps.pairs(t) for t in texts]
            flat = iter(word_features([s for ps in pairs for pair in ps for s in pair]))
            swapped = [[_apart(next(flat), next(flat)) for _ in ps] for ps in pairs]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(word_features(texts), lists), pa.array(swapped, pa.list_(pa.list_(lists))), batch.column("label")],
                names=["x", "pairs", "label"])

    rows = saved(labelled.mapInArrow(run, "x array<bigint>, pairs array<array<array<bigint>>>, label int"), "features")
    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    a, b = (F.col("t") + 0.5) / (toxic + 1.0), (F.col("n") - F.col("t") + 0.5) / (clean + 1.0)
    gain = F.abs(F.log(a / b)) * F.sqrt(F.col("n").cast("double"))
    best = (
        rows.select("label", F.explode("x").alias("f")).groupBy("f")
        .agg(F.count("*").alias("n"), F.sum("label").alias("t")).where(F.col("n") >= least)
        .select("f", gain.alias("gain")).orderBy(F.desc("gain"), "f").limit(size).collect()
    )
    named = np.concatenate(word_features(list(swaps.next)) or [np.zeros(0, np.int64)])
    chosen = np.unique(np.concatenate([np.array([r["f"] for r in best], np.int64), named]))

    def pick(batches: Iterator[pa.RecordBatch]):
        take = lambda xs: places(np.array(xs, np.int64), chosen)
        for batch in batches:
            x = [take(r) for r in batch.column("x").to_pylist()]
            pairs = [[[take(s) for s in pair] for pair in r] for r in batch.column("pairs").to_pylist()]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, lists), pa.array(pairs, pa.list_(pa.list_(lists))), batch.column("label")],
                names=["x", "pairs", "label"])

    picked = saved(rows.mapInArrow(pick, "x array<bigint>, pairs array<array<array<bigint>>>, label int"), "picked")
    held = picked.select("x", "label").toArrow().to_pydict()
    order = sorted(range(len(held["label"])), key=lambda k: (held["label"][k], held["x"][k]))
    sides = picked.select(F.explode("pairs").alias("pair")).groupBy("pair").count().orderBy("pair").collect()
    counts = np.array([r["count"] for r in sides], float)
    w, intercept = fit([np.array(held["x"][k], int) for k in order], np.array([held["label"][k] for k in order], float),
                       [(np.array(x, int), np.array(z, int)) for x, z in (r["pair"] for r in sides)], counts,
                       len(chosen), ridge, counterfactual)
    return ToxicityModel(chosen, w, intercept, int(counts.sum()))


def _apart(x: np.ndarray, z: np.ndarray) -> list[np.ndarray]:
    return [np.setdiff1d(x, z, assume_unique=True), np.setdiff1d(z, x, assume_unique=True)]


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "score") -> DataFrame:
    """The rows with the model's score of their whole text in place of the text. A null
    text is scored as an empty one."""
    kept = [c for c in docs.columns if c not in (text, into)]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, text):
            scores = model.score([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores)], names=[*kept, into])

    return docs.select(*kept, text).mapInArrow(run, f"{schema}, `{into}` double")


def op7_toxicity(spark: SparkSession, sf_dir: str, max_rows: int = 20_000) -> DataFrame:
    """Every document's toxicity, learned from at most ``max_rows`` labels not held out.

    The given documents name none of the default identity terms, so neutral words of the
    labelled texts that stand for each other are swapped as well.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(True))
    rows = saved(sample(docs, read_table(spark, sf_dir, "labels"), "toxic", held_out, max_rows), "labelled")
    model = train(rows, (*IDENTITY_TERMS, *neutral_groups(rows)))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERY = op7_toxicity
