"""Quality classifier: hashed word n-gram logistic regression (FTRL-proximal).

Features of a text are hashed word unigrams and bigrams, and unigrams and
bigrams of the words' shapes (case pattern and trailing signs; a word equal to
the one before has a shape of its own), each valued by its share of the
words.  Training is follow-the-regularised-leader with per-coordinate rates
over a bounded sample of labelled rows; a score is a sparse dot product.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import table, text_of

WORD_BITS, SHAPE_BITS = 18, 14
SIZE = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Most labelled rows that are fitted, taken in the order of a hash of their ids.
SAMPLE_ROWS = 6000
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 1e-4, 1e-4
#: Distinct words whose hashes a Python worker remembers; texts scored at a time.
MEMO_WORDS, SLAB = 100_000, 256
_REPEAT = zlib.crc32(b"repeat")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word to its hash (upper half) and its shape's (lower half)."""

    def __missing__(self, word: str) -> int:
        core = word.rstrip("!?.,;:*#$%&|")
        case = "x" if core.islower() else "X" if core.isupper() and len(core) > 1 else "Xx" if core.istitle() else "" if not core else "1" if any(c.isdigit() for c in core) else "xX"
        h = zlib.crc32(word.encode("utf-8", "surrogatepass")) << 32 | zlib.crc32((case + word[len(core) :][:4]).encode())
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = h
        return h


@functools.lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    return _Hashes()


def _pairs(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h[:-1] * np.uint64(3) + h[1:]) * _MIX) >> np.uint64(64 - bits)


def features(text: str) -> np.ndarray:
    """Indices of the text's features, one for each occurrence."""
    words = text.split()
    h = np.fromiter(map(_hashes().__getitem__, words), np.uint64, len(words))
    word, shape = h >> np.uint64(32), h & np.uint64(0xFFFFFFFF)
    if len(words) > 1:
        shape[1:][word[1:] == word[:-1]] = _REPEAT
    words_ = np.concatenate([(word * _MIX) >> np.uint64(64 - WORD_BITS), _pairs(word, WORD_BITS)])
    shapes = np.concatenate([(shape * _MIX) >> np.uint64(64 - SHAPE_BITS), _pairs(shape, SHAPE_BITS)]) + np.uint64(1 << WORD_BITS)
    return np.concatenate([words_, shapes]).astype(np.int64)


def train(texts: list[str], labels: list[int]) -> np.ndarray:
    """Weights by feature, the bias last.  Rows are passed in the given order."""
    z, n = np.zeros(SIZE + 1), np.zeros(SIZE + 1)
    rows = []
    for t in texts:
        i, c = np.unique(features(t).astype(np.int32), return_counts=True)
        rows.append((np.append(i, np.int32(SIZE)), c.astype(np.int32), max(1, len(t.split()))))

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for (i, c, words), y in zip(rows, labels, strict=True):
            x = np.append(c / words, 1.0)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - s * w
            n[i] += g * g
    return weights(np.arange(SIZE + 1)).astype(np.float32)


def score(weights: np.ndarray, text: str) -> float:
    n = len(text) and len(text.split())
    z = float(weights[-1]) + (float(weights[features(text)].sum(dtype=np.float64)) / n if n else 0.0)
    return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def held_out():
    """Rows that never train: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Fit on at most ``sample_rows`` labelled documents that are not held out.

    The sample is bounded, so one task trains on it; only the weights (about
    1 MB, whatever the input) reach the driver.  Without labelled rows of
    both kinds all weights are zero but the bias.  Ids with several labels or
    texts count once, by the larger label and the first text in code point
    order.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(sample_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(chosen, "doc_id")
    # An id that many rows share counts once, by its first text; partial sums reduce it before rows meet.
    rows = rows.groupBy("doc_id", "turn", "quality").agg(F.min("text").alias("text"))

    def one(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("turn", "ascending"), ("doc_id", "ascending")])
        return pa.table({"weights": pa.array([train(rows["text"].to_pylist(), rows["quality"].to_pylist()).tobytes()], pa.binary())})

    found = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(one, "weights binary").collect()
    return np.frombuffer(bytes(found[0][0]), np.float32) if found else np.zeros(SIZE + 1, np.float32)


def scored(docs: DataFrame, weights: np.ndarray, keep: list[str], name: str = "score") -> DataFrame:
    """The columns ``keep`` of ``docs`` with the score under ``name``."""
    given = docs.sparkSession.sparkContext.broadcast(weights)
    schema = docs.select(*keep).withColumn(name, F.lit(0.0)).schema
    rows = docs.select(*keep, text_of().alias("_" * 9 + "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = given.value
        for b in batches:
            # A few texts at a time are Python objects.
            texts = b.column(len(keep))
            s = [score(w, t) for at in range(0, len(texts), SLAB) for t in texts.slice(at, SLAB).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(s, pa.float64())], [*keep, name])

    return rows.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Null texts are scored as empty ones (the bias alone); very long texts are
    scored whole; null ids stay null and are not held out; repeated rows give
    repeated results; an empty table gives no rows; other columns are not read.
    """
    ids = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    out = scored(ids, fit(docs, labels), ["doc_id"])
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
