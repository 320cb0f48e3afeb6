"""Quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import read_table
from opsframe.llm.labelled import id_remainder, sample
from opsframe.llm.tokens import small_batches

FEATURES = [
    "log_words", "word_length", "distinct_words", "repeats", "top_word", "upper", "symbols", "digits",
    "marks_in_words", "marked_words", "distinct_pairs", "line_length", "distinct_lines", "ended_lines",
    "longest_word", "short_words", "pipes", "non_ascii",
]


def features(text: str) -> list[float]:
    """Plain statistics of a whole text; all zero for an empty one."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    lines = [line for line in text.split("\n") if line]
    counts = Counter(words)
    letters = sum(map(len, words))
    raw = text.encode("utf-8", "replace")
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digits = int(codes[65:91].sum()), int(codes[48:58].sum())
    ascii_marks = int(codes[33:127].sum()) - upper - digits - int(codes[97:123].sum())
    marked = sum(not w[-2:].isalnum() and len(w) > 2 and not w[-2:-1].isalnum() for w in words)
    return [
        float(np.log1p(n)), letters / n, len(counts) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, max(counts.values()) / n,
        upper / letters, ascii_marks / letters, digits / letters, ascii_marks / n, marked / n,
        len(set(zip(words, words[1:], strict=False))) / n, chars / max(1, len(lines)),
        len(set(lines)) / max(1, len(lines)), sum(x[-1] in ".!?" for x in lines) / max(1, len(lines)),
        float(max(map(len, words))), sum(len(w) < 4 for w in words) / n, int(codes[124]) / n,
        int(codes[128:].sum()) / len(raw),
    ]


def _best_cut(grad: np.ndarray, hess: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins."""
    g, h = np.cumsum(grad), np.cumsum(hess)
    score = lambda a, b: a * a / (b + 1.0)
    gain = score(g[:-1], h[:-1]) + score(g[-1] - g[:-1], h[-1] - h[:-1]) - score(g[-1], h[-1])
    at = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[at]), at + 1) if len(gain) else (0.0, 0)


def _shallow_tree(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """The step for each bin by a tree of depth two."""
    out = np.zeros(len(grad))
    gain, cut = _best_cut(grad, hess)
    spans = [(0, cut), (cut, len(grad))] if gain > 0 else [(0, len(grad))]
    for low, high in spans:
        gain, cut = _best_cut(grad[low:high], hess[low:high])
        inner = [(low, low + cut), (low + cut, high)] if gain > 0 else [(low, high)]
        for a, b in inner:
            out[a:b] = -grad[a:b].sum() / (hess[a:b].sum() + 1.0)
    return out


def _quarter_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and step for each cell of a grid by one cut along each side."""
    best, table = 0.0, np.zeros(grad.shape)
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        _, cut = _best_cut(g.sum(1), h.sum(1))
        step, gain = np.zeros(g.shape), -(g.sum() ** 2) / (h.sum() + 1.0)
        for rows in (slice(0, cut), slice(cut, None)):
            _, across = _best_cut(g[rows].sum(0), h[rows].sum(0))
            for cols in (slice(0, across), slice(across, None)):
                a, b = g[rows, cols].sum(), h[rows, cols].sum()
                step[rows, cols] = -a / (b + 1.0)
                gain += a * a / (b + 1.0)
        if gain > best:
            best, table = gain, step.T if turned else step
    return best, table


@dataclass
class AdditiveModel:
    """Lookup tables by feature and by pair of features; a score is a sum of cells."""

    edges: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, bins: int = 48, rounds: int = 150, rate: float = 0.1,
            n_pairs: int = 8, pair_rounds: int = 60) -> AdditiveModel:
        """Boosting in a cycle over the features, then over the pairs that promise most.
        Without rows, or with one label alone, every score is near that label's share."""
        model = cls([np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T])
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        model.intercept = float(np.log(share / (1 - share)))
        model.tables = [np.zeros(len(e) + 1) for e in model.edges]
        if not len(y) or y.min() == y.max():
            return model
        at, raw = model._bins(x), np.full(len(y), model.intercept)
        slopes = lambda: ((p := 1 / (1 + np.exp(-raw))) - y, p * (1 - p))
        for _ in range(rounds):
            for f, table in enumerate(model.tables):
                g, h = slopes()
                step = rate * _shallow_tree(*(np.bincount(at[f], w, len(table)) for w in (g, h)))
                table += step
                raw = raw + step[at[f]]
        sides = [len(t) for t in model.tables]
        grid = lambda i, j, w: np.bincount(at[i] * sides[j] + at[j], w, sides[i] * sides[j]).reshape(sides[i], sides[j])
        g, h = slopes()
        order = sorted(
            ((_quarter_tree(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(len(sides)) for j in range(i)),
            reverse=True)[:n_pairs]
        model.pairs = [(i, j, np.zeros((sides[i], sides[j]))) for gain, i, j in order if gain > 0]
        for _ in range(pair_rounds):
            for i, j, table in model.pairs:
                g, h = slopes()
                step = rate * _quarter_tree(grid(i, j, g), grid(i, j, h))[1]
                table += step
                raw = raw + step[at[i], at[j]]
        return model

    def _bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T, strict=True)]

    def score(self, x: np.ndarray) -> np.ndarray:
        at, raw = self._bins(x), np.full(len(x), self.intercept)
        for where, table in zip(at, self.tables, strict=True):
            raw += table[where]
        for i, j, table in self.pairs:
            raw += table[at[i], at[j]]
        return 1 / (1 + np.exp(-raw))


def _matrix(batch: pa.RecordBatch, text: str) -> np.ndarray:
    rows = [features(t or "") for t in batch.column(text).to_pylist()]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def train(labelled: DataFrame) -> AdditiveModel:
    """A model from ``text`` and ``label`` (0 or 1); tasks compute the features and the
    driver fits the tables to these few numbers a row."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(_matrix(batch, "text")), pa.list_(pa.float64())), batch.column("label")], names=["x", "label"])

    rows = labelled.mapInArrow(run, "x array<double>, label int").toArrow().to_pydict()
    order = sorted(range(len(rows["label"])), key=lambda k: (rows["x"][k], rows["label"][k]))
    x = np.array([rows["x"][k] for k in order], float).reshape(-1, len(FEATURES))
    return AdditiveModel.fit(x, np.array([rows["label"][k] for k in order], float))


def score(docs: DataFrame, model: AdditiveModel, text: str = "text", into: str = "score",
          keep_text: bool = False) -> DataFrame:
    """The rows with the model's score of their whole text, in place of the text or beside
    it. A null text is scored as an empty one; a column called ``into`` is replaced."""
    kept = [c for c in docs.columns if c != into and (keep_text or c != text)]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, text):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(model.score(_matrix(batch, text)))], names=[*kept, into])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, f"{schema}, `{into}` double")


def quality_model(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> AdditiveModel:
    """The model that learns ``labels.quality`` from a sample of rows that are not held out."""
    return train(sample(docs, labels, "quality", held_out(), max_rows))


def held_out():
    """Ids whose crc32 is divisible by five, and null ones, are never learned from."""
    return F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(True))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERY = op2_quality
