"""The language of a text, by piece probabilities summed over all segmentations."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm.common import read_table, saved
from opsframe.llm.labelled import id_remainder
from opsframe.llm.tokens import small_batches, tokenizer_path

VOCABULARY, UNKNOWN = "piece_bpe_32k.model", "und"

# What begins a word in the vocabulary, and the code point steps of the tree below.
_BEGIN, _POINTS = "▁", 1 << 21
_LETTERS = re.compile(r"[^\W\d_]+")
# Below this, products of probabilities lose digits.
_LEAST = 1e-250
#: Sums (letters times languages) that a task holds at once, and words it remembers.
HELD_SUMS, CACHED_WORDS = 1 << 20, 400_000


def vocabulary(path: str | None = None) -> list[str]:
    """The vocabulary's pieces of lower-case letters, with the mark of a word's begin."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or tokenizer_path(VOCABULARY))
    pieces = (model.id_to_piece(k) for k in range(model.get_piece_size()))
    return sorted({p for p in pieces if p.lower() == p and _LETTERS.fullmatch(p.removeprefix(_BEGIN))})


class Pieces:
    """A tree of pieces. Piece 0 stands for any one letter that is no piece by itself."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces) + 1
        nodes: dict[int, int] = {}
        ends: dict[int, int] = {}
        for number, piece in enumerate(pieces, 1):
            at = 0
            for letter in piece:
                at = nodes.setdefault(at * _POINTS + ord(letter), len(nodes) + 1)
            ends[at] = number
        self.steps = np.array(sorted(nodes), np.int64)
        self.nodes = np.array([nodes[k] for k in self.steps.tolist()], np.int64)
        self.ends = np.zeros(len(nodes) + 1, np.int64)
        self.ends[list(ends)] = list(ends.values())
        self.longest = max(map(len, pieces), default=1)

    def _next(self, at: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The nodes one letter on; -1 where the tree ends."""
        if not len(self.steps):
            return np.full(len(at), -1)
        wanted = at * _POINTS + letters
        place = np.minimum(np.searchsorted(self.steps, wanted), len(self.steps) - 1)
        return np.where(self.steps[place] == wanted, self.nodes[place], -1)

    def edges(self, letters: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every piece in every word: where it begins, its length and its number. ``left``
        says for each letter how many its word still has, itself included."""
        begins, at, found = np.arange(len(letters)), np.zeros(len(letters), np.int64), []
        alone = np.ones(len(letters), bool)
        for length in range(1, self.longest + 1):
            at = self._next(at, letters[begins + length - 1])
            begins, at = begins[at >= 0], at[at >= 0]
            whole = self.ends[at] > 0
            found.append((begins[whole], np.full(int(whole.sum()), length), self.ends[at[whole]]))
            if length == 1:
                alone[begins[whole]] = False
            more = left[begins] > length
            begins, at = begins[more], at[more]
        single = np.flatnonzero(alone)
        found.append((single, np.ones(len(single), np.int64), np.zeros(len(single), np.int64)))
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


class Lattice:
    """All segmentations of words: a place before, between and behind their letters, and the
    pieces as edges between places."""

    def __init__(self, words: list[str], pieces: Pieces):
        lengths = np.array([len(w) for w in words], np.int64)
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        offset = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        begins, length, self.piece = pieces.edges(letters, lengths[word] - offset)
        self.word = word[begins]
        self.source = begins + self.word  # every word has one place more than letters
        self.target = self.source + length
        self.begin, self.end = offset[begins], offset[begins] + length
        self.last = np.cumsum(lengths + 1) - 1
        self.first = self.last - lengths
        self.longest = int(lengths.max(initial=0))

    def _steps(self, back: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The edges, and the places they lead from and to, by how far into the word they
        begin, or from its end ``back``. Edges of one step never meet in one place, so a step
        is a plain addition of arrays."""
        near, far, at = (self.target, self.source, self.longest - self.end) if back else (self.source, self.target, self.begin)
        order = np.argsort(at, kind="stable")
        limits = np.searchsorted(at[order], np.arange(self.longest + 1))
        for a, b in zip(limits[:-1], limits[1:], strict=True):
            some = order[a:b]
            yield some, near[some], far[some]

    def _places(self, width: int, value: float) -> np.ndarray:
        return np.full((len(self.last) + int((self.last - self.first).sum()), width), value)

    def sums(self, weights: np.ndarray, back: bool = False) -> np.ndarray:
        """For each place the logarithm of the sum over all ways to it from the word's begin,
        or from the word's end ``back``, whose edges have logarithmic weights."""
        out = self._places(weights.shape[1], -np.inf)
        out[self.last if back else self.first] = 0.0
        for some, near, far in self._steps(back):
            out[far] = np.logaddexp(out[far], out[near] + weights[some])
        return out

    def products(self, weights: np.ndarray) -> np.ndarray:
        """For each place the sum over all ways to it of the products of plain weights, which
        vanishes in long words."""
        out = self._places(weights.shape[1], 0.0)
        out[self.first] = 1.0
        for some, near, far in self._steps(False):
            out[far] += out[near] * weights[some]
        return out


def _groups(words: list[str], width: int) -> Iterator[slice]:
    """Runs of words of a bounded number of letters, or of one word."""
    begin, held = 0, 0
    for k, word in enumerate(words):
        if held and (held + len(word)) * width > HELD_SUMS:
            yield slice(begin, k)
            begin, held = k, 0
        held += len(word)
    if words:
        yield slice(begin, len(words))


def word_logs(words: list[str], pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """For each word and language the logarithm of the word's probability: the forward
    algorithm adds up the products of piece probabilities of all its segmentations."""
    out, plain = np.zeros((len(words), logs.shape[1])), np.exp(logs)
    for some in _groups(words, logs.shape[1]):
        lattice = Lattice(words[some], pieces)
        total = lattice.products(plain[lattice.piece])[lattice.last]
        if total.size and total.min() < _LEAST:  # long words, with logarithms all along
            total = lattice.sums(logs[lattice.piece])[lattice.last]
            out[some] = total
        else:
            out[some] = np.log(total)
    return out


def piece_counts(words: list[str], language: np.ndarray, times: np.ndarray, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """How often each piece is expected, by language, in words that each occur ``times`` in
    one language: forward sums up to the piece, the piece, and backward sums behind it, as a
    share of the whole word, over all segmentations."""
    out = np.zeros(logs.size)
    for some in _groups(words, 1):
        lattice = Lattice(words[some], pieces)
        cell = lattice.piece * logs.shape[1] + language[some][lattice.word]
        weights = logs.ravel()[cell][:, None]
        ahead, behind = lattice.sums(weights)[:, 0], lattice.sums(weights, back=True)[:, 0]
        share = ahead[lattice.source] + weights[:, 0] + behind[lattice.target] - ahead[lattice.last][lattice.word]
        out += np.bincount(cell, np.exp(share) * times[some][lattice.word], len(out))
    return out.reshape(logs.shape)


def words_of(token: str) -> list[str]:
    """The words of a run without white space: its runs of letters, in lower case, each
    behind the mark of a word's begin."""
    return [_BEGIN + w for w in _LETTERS.findall(token.lower())]


@dataclass
class LanguageModel:
    """For each language the logarithms of its share and of its piece probabilities."""

    names: list[str]
    prior: np.ndarray
    pieces: Pieces
    logs: np.ndarray


class _Numbered(dict):
    """Numbers of tokens, in the order they are first asked for."""

    def __missing__(self, token: str) -> int:
        number = self[token] = len(self)
        return number


class Scorer:
    """Scores texts in a task and remembers a bounded number of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.width = model, len(model.names)
        self.known, self.table = _Numbered(), np.zeros((0, self.width + 1))

    def _learn(self, tokens: list[str]) -> None:
        """One row for each token: the logarithms of its words added up, and their number."""
        found = [(t,) if t.isalpha() else _LETTERS.findall(t) for t in tokens]
        # Long words, which take logarithms, stand together.
        words = sorted({_BEGIN + w for ws in found for w in ws}, key=len)
        numbers = dict(zip(words, range(len(words)), strict=True))
        logs = word_logs(words, self.model.pieces, self.model.logs)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        token = np.repeat(np.arange(len(tokens)), counts)
        word = np.array([numbers[_BEGIN + w] for ws in found for w in ws], np.int64)
        rows = np.stack([*(np.bincount(token, logs[word, k], len(tokens)) for k in range(self.width)), counts], 1)
        self.table = np.concatenate([self.table, rows])

    def __call__(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its probability; the first of equal ones
        by name. A text without a letter, or a model without languages, has none."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.table = _Numbered(), self.table[:0]
        split = []
        for text in texts:  # in lower case before it is cut, as a letter may depend on those about it
            tokens = text.lower().replace(".", " ").replace(",", " ").split()
            split.append(np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens)))
        self._learn(list(islice(self.known, len(self.table), None)))
        names, scores = [], np.zeros(len(texts))
        for k, at in enumerate(split):
            total = self.table[at].sum(axis=0)
            if not self.width or not total[-1]:
                names.append(UNKNOWN)
                continue
            raw = self.model.prior + total[:-1]
            best = int(raw.argmax())
            names.append(self.model.names[best])
            scores[k] = 1.0 / np.exp(raw - raw[best]).sum()
        return names, scores


def train(docs: DataFrame, lang: str = "lang", text: str = "text", path: str | None = None, rounds: int = 2,
          strength: float = 500.0) -> LanguageModel:
    """A model from all rows with a language and a text.

    Spark counts the words of each language over all rows and keeps the counts in the shared
    folder. Expectation maximisation then learns piece probabilities from them: each task
    adds up the expected counts of its words, and one number per language and piece reaches
    the driver. A language's counts are smoothed with ``strength`` pieces dealt as in all
    languages together. The model's size is that of the vocabulary times the number of
    languages, whatever the rows.
    """
    usable = docs.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = usable.groupBy("lang").count().orderBy("lang").collect()
    names = [r["lang"] for r in found]
    pieces = Pieces(vocabulary(path))
    total = sum(r["count"] for r in found)
    prior = np.log(np.array([r["count"] / total for r in found])) if found else np.zeros(0)
    logs = np.full((pieces.size, len(names)), -np.log(pieces.size))
    if not names:
        return LanguageModel(names, prior, pieces, logs)
    number = {n: k for k, n in enumerate(names)}
    words = saved(usable.select("lang", F.explode(F.split("text", r"[ \t\n\x0B\f\r]+")).alias("word"))
                  .groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    for _ in range(rounds):
        def expected(batches: Iterator[pa.RecordBatch], logs=logs):
            counts = np.zeros(logs.shape)
            for batch in batches:
                rows = [(w, number[name], n) for name, token, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                        for w in words_of(token)]
                if rows:
                    word, language, n = zip(*rows, strict=True)
                    counts += piece_counts(list(word), np.array(language), np.array(n, float), pieces, logs)
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], names=["cell", "n"])

        parts = words.select("lang", "word", "n").mapInArrow(expected, "cell bigint, n double")
        summed = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow().to_pydict()
        counts = np.zeros(logs.size)
        counts[np.array(summed["cell"], np.int64)] = summed["n"]
        counts = counts.reshape(logs.shape)
        common = (counts.sum(1) + 1.0) / (counts.sum() + pieces.size)
        logs = np.log((counts + strength * common[:, None]) / (counts.sum(0) + strength))
    return LanguageModel(names, prior, pieces, logs)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", into: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """The rows with the language of their whole text and its probability, in place of the
    text. A null text, or one without a letter, is ``und`` with 0. Columns called ``into``
    or ``score`` are replaced."""
    kept = [c for c in docs.columns if c not in (text, into, score)]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept),
                        f"`{into}` string, `{score}` double"])

    def run(batches: Iterator[pa.RecordBatch]):
        scorer = Scorer(model)
        for batch in small_batches(batches, text):
            names, scores = scorer([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores)],
                names=[*kept, into, score])

    return docs.select(*kept, text).mapInArrow(run, schema)


def held_out() -> Column:
    """Ids whose crc32 leaves 2 when divided by four, and null ones, are never learned from."""
    return F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(True))


def op12_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out()).select("lang", "text"))
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score")


QUERY = op12_languages
