"""All pairs of texts whose sets of five-word shingles have a Jaccard index of at least 0.8.

SimHash by bit-sliced comparison, as in :mod:`landgauge.llm.simhash`, at a
radius that no table of bit blocks serves: buckets are first shingles instead.
Where every set is written in one global order (the rarer a shingle in a
sample the earlier, ties by hash), two sets that are alike share a shingle
among the first fifth of each, so no pair is lost.  Fingerprints that share a
bucket are compared bit-sliced, each bucket yields a spanning forest, and star
contraction joins the forests to blocks.  An exact check follows: within each
block, whole sets are compared, and its true classes yield a spanning forest
again.  No step lists pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.llm.common import WORD, materialize, text_of
from landgauge.llm.simhash import compared, components, in_pairs

#: Words of a shingle; the least Jaccard index, as a fraction.
WORDS, OVER, UNDER = 5, 4, 5
#: Texts whose shingles are counted for the global order, and the count from which one is put off.
SAMPLE_ROWS, OFTEN = 50_000, 3
#: Longs of a fingerprint, and the differing bits (of 256) up to which two may be those of alike sets.  At an index of 0.8 a bit differs with a
#: chance of at most 0.162, of 0.1875 for sets of four and five: more than FAR do with a chance of under one in a billion.  Unlike sets: about 128.
LONGS, FAR = 4, 88
#: Buckets and blocks above this are compared as pairs of chunks. Shingles whose bits are counted in bytes.
CHUNK_ROWS, SLAB = 8192, 255
SEED = 42

_PRINT = pa.list_(pa.int64())

_ASCII = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def shingles(text: str, size: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The distinct XXH64 of a text's shingles, ascending; a shorter text is one shingle, an empty one has none."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").translate(_ASCII).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][: max(1, len(words) - size + 1)].tolist()
    ends = ends[min(size, len(words)) - 1 :].tolist()
    return np.unique(np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends, strict=True)], np.uint64))


def prefix(found: np.ndarray, often: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the global order: as many as two alike sets cannot both miss."""
    n = len(found)
    rank = np.zeros(n, np.int64)
    if len(often) and n:
        at = np.minimum(np.searchsorted(often, found), len(often) - 1)
        rank = np.where(often[at] == found, count[at], 0)
    return found[np.lexsort((found, rank))[: n - -(-OVER * n // UNDER) + 1]] if n else found


def simhash(found: np.ndarray) -> np.ndarray:
    """256 bits, as longs; a bit is set if in over half of a set's hashes, each mixed once for every long."""
    h = found[:, None] + np.arange(LONGS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(times)
    h ^= h >> np.uint64(31)
    bits = np.unpackbits(h.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    count = np.add.reduceat(bits, np.arange(0, len(bits), SLAB), axis=0, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(count * 2 > len(found), bitorder="little").view("<i8")


def text_key() -> Column:
    """XXH64 of ``text``, the same for all texts without a word: texts that differ in case or white space only meet by their shingles."""
    return F.xxhash64(F.when(text_of().rlike(WORD), text_of()).otherwise(""))


def _sets(texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (u first, text last) with found, the shingles as signed 64 bits, for text: copies in one task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _unseen(batches):
            found = [shingles(t or "").view(np.int64) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.list_(pa.int64()))], [*b.schema.names[:-1], "found"])

    return texts.mapInArrow(run, ", ".join(f"{c} long" for c in texts.columns[:-1]) + ", found array<long>")


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose key (the first column) stands for the first time in this task."""
    seen: set[int] = set()
    for b in batches:
        keys = b.column(0).to_pylist()
        new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
        yield b.take(pa.array(new, pa.int64())) if len(new) < len(keys) else b


def _often(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that stand in ``OFTEN`` texts of a sample, and in how many."""
    some = texts.where(F.pmod(F.xxhash64("u"), F.lit(max(1, texts.count() // SAMPLE_ROWS))) == 0)
    rows = _sets(some.dropDuplicates(["u"]).select("u", "text")).select(F.explode("found").alias("s")).groupBy("s").count().where(F.col("count") >= OFTEN).toArrow()
    s, count = rows["s"].to_numpy().astype(np.int64).view(np.uint64), rows["count"].to_numpy()
    order = np.argsort(s)
    return s[order], count[order]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows of longs sorted by their first column, in pieces that part no run of it."""
    held = None
    for b in batches:
        r = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1)
        if not len(r):
            continue
        # Only a batch that starts the next run ends the one that is held.
        if held is not None and held[-1][0, 0] == r[-1, 0]:
            held.append(r)
            continue
        r = r if held is None else np.concatenate([*held, r])
        at = int(np.searchsorted(r[:, 0], r[-1, 0]))
        if at:
            yield r[:at]
        held = [r[at:]]
    if held is not None:
        yield np.concatenate(held)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by s and u: those with a fingerprint, and those of shingles that stand in several texts."""
    prints: list[pa.RecordBatch] = []

    def others() -> Iterator[pa.RecordBatch]:
        for b in batches:
            has = b.column("f").is_valid()
            prints.append(b.filter(has))
            yield b.filter(pc.invert(has)).select(["s", "u"])

    for r in _runs(others()):
        # Copies that other tasks listed too stand next to each other.
        r = r[np.r_[True, (r[1:] != r[:-1]).any(axis=1)]]
        run = np.cumsum(np.r_[True, r[1:, 0] != r[:-1, 0]]) - 1
        r = r[np.bincount(run)[run] > 1]
        yield pa.RecordBatch.from_arrays([pa.array(r[:, 0]), pa.array(r[:, 1]), pa.nulls(len(r), _PRINT)], ["s", "u", "f"])
        yield from prints
        prints.clear()
    yield from prints



def classes(found: list[np.ndarray]) -> np.ndarray:
    """The index of each set's class, its first set: sets that are alike, or joined by a chain of alike sets, have the same.

    Each set is compared once with those that are in no class yet, by lists
    of the sets that hold each shingle.
    """
    label = np.full(len(found), -1)
    size = np.array([len(f) for f in found])
    _, at, count = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
    lists = np.repeat(np.arange(len(found)), size)[np.argsort(at, kind="stable")]
    end = np.cumsum(count)
    edge = np.r_[0, np.cumsum(size)]
    left = len(found)
    for first in range(len(found)):
        if label[first] >= 0:
            continue
        label[first] = first
        left -= 1
        asks = [first]
        while asks and left:
            i = asks.pop()
            mine = at[edge[i] : edge[i + 1]]
            mine = mine[count[mine] > 1]
            if not len(mine):
                continue
            shared = np.bincount(np.concatenate([lists[e - c : e] for e, c in zip(end[mine].tolist(), count[mine].tolist(), strict=True)]), minlength=len(found))
            new = np.flatnonzero((shared * (OVER + UNDER) >= (size + size[i]) * OVER) & (label < 0))
            label[new] = first
            left -= len(new)
            asks += new.tolist()
    return label


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b: a spanning forest of the links between alike sets in each block, from rows (root, pair, u, found) sorted by these."""
    key, names, sets = None, [], []

    def forest() -> pa.RecordBatch:
        u, label = np.array(names, np.int64), classes(sets)
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(u[moved]), pa.array(u[label[moved]])], ["a", "b"])

    for b in batches:
        found, offset = b.column("found"), b.column("found").offsets.to_numpy()
        values = found.values.to_numpy().view(np.uint64)
        for i, (root, pair, u) in enumerate(zip(*(b.column(c).to_pylist() for c in ("root", "pair", "u")), strict=True)):
            if (root, pair) != key:
                if len(sets) > 1:
                    yield forest()
                key, names, sets = (root, pair), [], []
            if not names or names[-1] != u:  # copies of other tasks
                names.append(u)
                sets.append(values[offset[i] : offset[i + 1]].copy())
    if len(sets) > 1:
        yield forest()


def alike(texts: DataFrame) -> DataFrame:
    """node, root: the classes of ``texts`` (u, text; copies have one u).

    Texts whose Jaccard index is at least 0.8 are in one class, as are those
    joined by a chain of such pairs.  Very long texts are compared whole.
    """
    sent = texts.sparkSession.sparkContext.broadcast(_often(texts))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _unseen(batches):
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [shingles(t or "") for t in part.column(1).to_pylist()]
                cut = [prefix(f, *sent.value) for f in found]
                u = part.column(0).take(pa.array(np.repeat(np.arange(len(cut)), [len(c) for c in cut])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cut).view(np.int64)), u, pa.nulls(len(u), _PRINT)], ["s", "u", "f"])
                # One row more for each text that has a word, with its fingerprint.
                some = [i for i, f in enumerate(found) if len(f)]
                u = part.column(0).take(pa.array(some, pa.int64()))
                yield pa.RecordBatch.from_arrays([u, u, pa.array([simhash(found[i]) for i in some], _PRINT)], ["s", "u", "f"])

    row = "s long, u long, f array<long>"
    met = materialize(texts.select("u", "text").mapInArrow(first, row).repartition("s").sortWithinPartitions("s", "u").mapInArrow(_shared, row))
    prints = met.where("f IS NOT NULL").select("u", *(F.col("f")[k].alias(f"f{k}") for k in range(LONGS))).dropDuplicates(["u"])
    members = in_pairs(met.where("f IS NULL").select("s", "u"), ["s"], "u", CHUNK_ROWS).join(prints, "u")
    near = components(compared(members.select("s", "pair", "u", *prints.columns[1:]), 2, 3, FAR))
    block = materialize(near.select(F.col("node").alias("u"), "root").unionByName(near.select(F.col("root").alias("u"), "root").distinct()))
    sets = in_pairs(_sets(texts.join(block, "u").select("u", "root", "text")), ["root"], "u", CHUNK_ROWS, block)
    return components(sets.select("root", "pair", "u", "found").repartition("root", "pair").sortWithinPartitions("root", "pair", "u").mapInArrow(_confirmed, "a long, b long"))
