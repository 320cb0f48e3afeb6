"""Token ids of whole texts, encoded inside Spark tasks."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZER, END_ID = "word_bpe_49k.json", 2

# Bytes of text that a task encodes at once, and words whose ids a Python worker remembers
# within a task and beyond it.
BATCH_BYTES, CACHED_WORDS, KEPT_WORDS = 8 << 20, 600_000, 50_000

# Words of the letters of Latin-1 that have two cases, and of ß and ÿ, with ASCII marks behind them;
# an apostrophe may begin a piece of letters.
_MARKED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch

_encoders: dict = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """The ids of words, each worked out when it is first asked for. A word as long as a text
    is not worth its memory."""

    def __init__(self, ids_of):
        super().__init__({"": b""})
        self.ids_of = ids_of

    def __missing__(self, word: str) -> bytes:
        ids = self.ids_of(word)
        if len(word) <= 64:
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of a text by a tokenizer that drops white space between words.

    Such a tokenizer encodes each word by itself, so a text's ids are those of its words in
    a row and a word that was seen before need not be encoded again. Words are cut at space,
    tab, line feed and return alone; rarer white space stays inside a "word", which the
    tokenizer then splits itself. A tokenizer of another kind, told by a probe, encodes
    whole texts.
    """

    def __init__(self, path: str, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer, self.kind, self.known = Tokenizer.from_file(path), f"<u{width}", _Known(self._word)
        self._model = self.tokenizer.model
        self._raw = [k.to_bytes(width, "little") for k in range(self.tokenizer.get_vocab_size())]
        bytes_as_text = ByteLevel(add_prefix_space=False, use_regex=False)
        self._table = {k: bytes_as_text.pre_tokenize_str(chr(k))[0][0] for k in range(0xC0, 0x100)}
        probe = "Zażółć gęślą, The THE don't\tx1 2.\nß é. É, the.##! THE_a É- x'."
        self._by_word = self([probe]) == self._encoded([probe])

    def _encoded(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(e.ids, self.kind).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @classmethod
    def of(cls, path: str, width: int) -> WordEncoder:
        """The encoder of this Python worker, which outlives a task."""
        if (path, width) not in _encoders:
            _encoders[path, width] = cls(path, width)
        return _encoders[path, width]

    def _word(self, word: str) -> bytes:
        """A word of Latin letters is one piece, so the merges alone are asked; the tokenizer
        splits before the marks behind it and keeps them together."""
        found = _MARKED(word)
        if not found:
            return self._encoded([word])[0]
        letters, marks = found.groups()
        if marks:
            return self.known[letters] + self.known[marks]
        lower = word.lower()
        if lower != word:
            return self.known[lower]
        raw = self._raw
        return b"".join([raw[t.id] for t in self._model.tokenize(word if word.isascii() else word.translate(self._table))])

    def forget(self) -> None:
        """Drop the words of a task that had many; the next one may need the memory."""
        if len(self.known) > KEPT_WORDS:
            self.known = _Known(self._word)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not getattr(self, "_by_word", True):
            return self._encoded(texts)
        out = []
        for text in texts:
            if len(self.known) > CACHED_WORDS:
                self.known = _Known(self._word)
            words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            out.append(b"".join(map(self.known.__getitem__, words)))
        return out


def id_width(path: str, end_id: int) -> int:
    """Bytes of an id in files: two where every id fits, else four."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def small_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds few bytes of text, or one row."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * BATCH_BYTES / max(1, batch.column(text).nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode(docs: DataFrame, text: str = "text", path: str | None = None, end_id: int = END_ID,
           width: int = 4) -> DataFrame:
    """The rows with ``ids`` in place of the text: little-endian unsigned ids of ``width``
    bytes with the end id last. A null or empty text has the end id alone."""
    path = path or tokenizer_path()
    others = [c for c in docs.columns if c != text]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)

    def run(batches):
        encoder = WordEncoder.of(path, width)
        end = end_id.to_bytes(width, "little")
        for batch in small_batches(batches, text):
            ids = encoder([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in others] + [pa.array([x + end for x in ids], pa.binary())],
                names=[*others, "ids"])
        encoder.forget()

    return docs.select(*others, text).mapInArrow(run, f"{schema}, ids binary" if schema else "ids binary")
