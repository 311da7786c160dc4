"""Token counts by the whole-token shortcut.

A byte-pair vocabulary never merges across a character pair that no
vocabulary string contains.  :func:`prove` proves two things from the
vocabulary alone, once, before any text is seen: that no string holds a space
marker behind another character, nor a line feed, so that words (with the
spaces before them) and line feeds are counted independently; and which
strings encode, alone, as exactly one token.  The proof is broadcast.  Words
that match such a string count one without any merging; the library merges
only the rest, each distinct word once as long as the memo holds it.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import table, text_of

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Distinct words that a Python worker remembers beside the proven strings, and the longest such word.
MEMO_WORDS, MEMO_CHARS = 400_000, 64
MARK = "▁"


class _Memo(dict):
    """Count of each word; what is missing is merged by the library."""

    def __init__(self, proven: dict[str, int], merge):
        super().__init__(proven)
        self.proven, self.merge = proven, merge

    def __missing__(self, word: str) -> int:
        n = self.merge(word)
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS + len(self.proven):
                self.clear()
                self.update(self.proven)
            self[word] = n
        return n


@dataclass(frozen=True)
class Proof:
    """Whether words and line feeds may be counted apart, and the strings of one token each: after a space, with it, and at a line's start."""

    separable: bool
    led: dict[str, int]
    bare: dict[str, int]


@functools.lru_cache(maxsize=2)
def prove(path: str) -> Proof:
    """From the vocabulary at ``path`` alone."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encode = lambda text: library.encode(text, out_type=str)
    strings = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    plain = [s for i, s in enumerate(strings) if not (library.is_control(i) or library.is_byte(i) or library.is_unknown(i))]
    if any(MARK in s.lstrip(MARK) or " " in s or "\n" in s for s in plain) or len(encode("\n")) != 2:
        return Proof(False, {}, {})
    led = {s.replace(MARK, " "): 1 for s in plain if s.startswith(MARK) and s.strip(MARK) and encode(s[1:].replace(MARK, " ")) == [s]}
    return Proof(True, led, {s: 1 for s in plain if MARK not in s and encode("\n" + s)[2:] == [s]})


class PieceCounter:
    """Counts exactly the tokens that ``sentencepiece`` encodes a text to."""

    def __init__(self, path: str, proof: Proof | None = None):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proof = proof or prove(path)
        self.separable = proof.separable
        #: Words by their strings after one space, with any spaces before them, and at a line's start.
        self.after_space = _Memo({w[1:]: 1 for w in proof.led if w.count(" ") == 1}, lambda w: len(self._ids(w)))
        self.spaced = _Memo(dict(proof.led), lambda w: len(self._ids("\n" + w)) - 2)
        self.at_line_start = _Memo(dict(proof.bare), lambda w: len(self._ids("\n" + w)) - 2)
        self.runs = re.compile(r" *[^ ]+| +")

    def _ids(self, text: str) -> list[int]:
        return self.library.encode(text)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.separable:
            return len(self._ids(text))
        total, after_space = 0, self.after_space.__getitem__
        # The library puts a space before the text and reads its own marker as a space.
        for i, line in enumerate(text.replace(MARK, " ").split("\n")):
            if i:
                total += 1
            if "  " in line or line.startswith(" ") or line.endswith(" "):
                runs = self.runs.findall(line if i else " " + line)
                if i and not line.startswith(" "):
                    total += self.at_line_start[runs.pop(0)]
                total += sum(map(self.spaced.__getitem__, runs))
            elif line:
                words = line.split(" ")
                if i:
                    total += self.at_line_start[words.pop(0)]
                total += sum(map(after_space, words))
            elif not i:
                total += self.spaced[" "]
        return total


def counter(path: str | None = None) -> PieceCounter:
    return PieceCounter(_path(path))


def _path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return path


#: The counter of a Python worker, by vocabulary: its memo serves all tasks.
_COUNTERS: dict[str, PieceCounter] = {}


def _own_counter(path: str, proof: Proof) -> PieceCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path, proof)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    Null texts count as empty (0 tokens); very long texts are counted whole,
    a line at a time; null ids stay null; repeated rows give repeated results;
    an empty table gives no rows; other columns are not read.
    """
    given = _path(path)
    proof = docs.sparkSession.sparkContext.broadcast(prove(given))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _own_counter(_path(path), proof.value)
        for b in batches:
            n = [c.count(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
