"""Secrets in texts: fixed patterns, and random strings by character Markov models."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import read_table
from opsframe.llm.tokens import small_batches

KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")
# Words, of any length: numbers and short words are ordinary too.
ORDINARY = re.compile("[A-Za-z0-9_]+")
# What the models judge: runs that could be a key, in pieces between separators.
SEPARATORS = "+/_=-"
_PIECE = re.compile("[A-Za-z0-9]+")

_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_SIDE = len(_SYMBOLS) + 1  # the last stands for a string's begin
_CODE = np.full(128, _SIDE - 1, np.int64)
_CODE[[ord(c) for c in _SYMBOLS]] = np.arange(_SIDE - 1)
_PARTS = np.array([c in SEPARATORS for c in _SYMBOLS] + [True])  # what ends a piece


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed patterns, ends exclusive, in code points."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _samples(text: str) -> tuple[list[str], list[str]]:
    """Strings labelled by the patterns: the values of secrets, and words outside them."""
    spans = base_spans(text)
    secrets = [m[2] for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if spans else []
    secrets += [text[a:b] for a, kind, b in spans if kind]
    rest, at = [], 0
    for a, _, b in spans:
        rest.append(text[at:a])
        at = max(at, b)
    return secrets, ORDINARY.findall(" ".join([*rest, text[at:]]))


def _steps(strings: list[str]) -> np.ndarray:
    """Counts of each character after each other one, over all strings."""
    codes = _CODE[np.frombuffer(("\n" + "\n".join(strings)).encode(), np.uint8)]
    pairs = codes[:-1] * _SIDE + codes[1:]
    return np.bincount(pairs[codes[1:] < _SIDE - 1], minlength=_SIDE * _SIDE)


@dataclass
class MarkovPair:
    """Log-likelihood ratios of character steps: random strings against identifiers.

    ``threshold`` is the ratio of a whole string from which it is rather a random one: the
    logarithm of how many identifiers the samples have for each random string.
    """

    ratio: np.ndarray
    threshold: float = 0.0

    @classmethod
    def fit(cls, random: np.ndarray, ordinary: np.ndarray, smoothing: float = 1.0) -> MarkovPair:
        """From counts of steps. Without samples both models are uniform, and no string is
        random."""
        logs = []
        for counts in (random, ordinary):
            grid = counts.reshape(_SIDE, _SIDE)[:, :-1] + smoothing
            logs.append(np.log(grid / grid.sum(1, keepdims=True)))
        begun = [counts.reshape(_SIDE, _SIDE)[-1].sum() + smoothing for counts in (random, ordinary)]
        return cls(logs[0] - logs[1], float(max(0.0, np.log(begun[1] / begun[0]))))

    def mean_ratio(self, string: str) -> float:
        """The ratio of a whole string, by character."""
        codes = _CODE[np.frombuffer(("\n" + string).encode(), np.uint8)]
        return float(self.ratio[codes[:-1], codes[1:]].mean())


def train(docs: DataFrame, text: str = "text") -> MarkovPair:
    """Models of the secrets the patterns find and of the other words, counted over all
    documents: each task adds up its own steps, and one row per step reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]):
        sums = [np.zeros(_SIDE * _SIDE, np.int64) for _ in range(2)]
        for batch in small_batches(batches, text):
            found = [_samples(t or "") for t in batch.column(text).to_pylist()]
            for side in range(2):
                sums[side] += _steps([s for pair in found for s in pair[side]])
        for side in range(2):
            at = np.flatnonzero(sums[side])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), side, np.int32)), pa.array(at.astype(np.int32)), pa.array(sums[side][at])],
                names=["side", "step", "n"])

    counts = np.zeros((2, _SIDE * _SIDE))
    steps = docs.select(text).mapInArrow(run, "side int, step int, n bigint")
    for row in steps.groupBy("side", "step").agg(F.sum("n").alias("n")).collect():
        counts[row["side"], row["step"]] = row["n"]
    return MarkovPair.fit(counts[0], counts[1])


def _keys(run: str, models: MarkovPair, margin: float) -> list[tuple[int, int]]:
    """The random parts of a run: pieces that are likelier random, joined with the one before
    where both and what lies between are likelier together than either alone; or the whole
    run, where no part suffices."""
    codes = _CODE[np.frombuffer(run.encode(), np.uint8)]
    first = models.ratio[-1, codes].tolist()
    after = np.concatenate([[0.0], np.cumsum(models.ratio[codes[:-1], codes[1:]])]).tolist()

    def total(a: int, b: int) -> float:
        return first[a] + after[b - 1] - after[a]

    groups: list[tuple[int, int, float]] = []
    for m in _PIECE.finditer(run):
        value = total(*m.span())
        if value <= 0:
            continue
        if groups and (joined := total(groups[-1][0], m.end())) >= max(value, groups[-1][2]):
            groups[-1] = (groups[-1][0], m.end(), joined)
        else:
            groups.append((*m.span(), value))
    found = [(a, b) for a, b, value in groups if value > margin]
    return found or ([(0, len(run))] if total(0, len(run)) > margin else [])


def _random_spans(text: str, taken: list[tuple[int, int, int]], models: MarkovPair, margin: float) -> list[tuple[int, int]]:
    """The random strings of the text outside the taken spans, by the ratio alone."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(points < 128, _CODE[np.minimum(points, 127)], _SIDE - 1)
    codes[points == ord(".")] = _SIDE - 1
    for a, _, b in taken:
        codes[a:b] = _SIDE - 1
    inside = np.concatenate([[False], codes < _SIDE - 1, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    if not len(begins):
        return []
    before = np.concatenate([[_SIDE - 1], codes[:-1]])
    step = np.where(codes < _SIDE - 1, models.ratio[before, np.minimum(codes, _SIDE - 2)], 0.0)
    sums = np.concatenate([[0.0], np.cumsum(step)])
    asked = sums[ends] - sums[begins] > margin - 1e-6
    # Runs with separators are cut into pieces one by one where a piece is likelier random.
    piece = ~_PARTS[codes]
    own = np.where(piece, models.ratio[np.where(_PARTS[before], _SIDE - 1, before), np.minimum(codes, _SIDE - 2)], 0.0)
    firsts = np.flatnonzero(piece & _PARTS[before])
    if len(firsts):
        totals = np.add.reduceat(own, firsts)
        run_of = np.searchsorted(begins, firsts[totals > 0], side="right") - 1
        separated = np.add.reduceat(~piece, begins) - np.add.reduceat(codes == _SIDE - 1, begins) > 0
        asked[run_of] |= separated[run_of]
    return [(a + x, a + y) for a, b in zip(begins[asked].tolist(), ends[asked].tolist(), strict=True)
            for x, y in _keys(text[a:b], models, margin)]


def spans_of(text: str, models: MarkovPair, margin: float | None = None) -> list[tuple[int, int, int]]:
    """The base spans, and outside them every string whose ratio exceeds the margin."""
    out = base_spans(text)
    added = _random_spans(text, out, models, models.threshold if margin is None else margin)
    return sorted(out + [(a, 3, b) for a, b in added])


def scan(docs: DataFrame, models: MarkovPair, text: str = "text", margin: float | None = None) -> DataFrame:
    """The rows with ``spans``, an array of (kind, start, end) in order, for the text.

    Kinds: ``assign``, ``access`` and ``hex`` by pattern, ``random`` for a string of key
    characters outside these, of any length and kind, whose log-likelihood ratio of the model
    of random strings to that of identifiers is over ``margin``; by default the threshold
    that the labelled samples set. In a run of key characters the pieces between separators
    are judged, random ones that belong together as one string, and then the whole run. Ends
    are exclusive, in code points. A null or empty text has no spans.
    """
    kept = [c for c in docs.columns if c not in (text, "spans")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_batches(batches, text):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t or "", models, margin)]
                     for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(found, kind)], names=[*kept, "spans"])

    return docs.select(*kept, text).mapInArrow(
        run, f"{schema}, spans array<struct<kind:string, start:bigint, end:bigint>>")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document, with a digest of those the patterns find."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    joined = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERY = op3_secrets
