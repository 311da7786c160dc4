"""SimHash near-duplicates by bit-sliced comparison.

Every text gets a 64-bit fingerprint.  Distinct fingerprints are dealt into
buckets that are sure to bring any two within the radius together (pigeonhole
over blocks of bits), and each bucket is compared bit-sliced: 64 members make
one machine word per bit plane, distances to one member grow plane by plane
in carry-save counters, and words whose lanes have all left the radius are
abandoned.  A bucket yields a spanning forest of its links, never all pairs;
the forests are joined by alternating star contraction, written to the shared
folder after each round.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import hex16, materialize, row_key, table, text_of

RADIUS, SHINGLE, SEED, BITS = 4, 4, 42, 64
#: Expected distinct fingerprints in a bucket; more fingerprints get longer bucket keys.
BUCKET_ROWS = 256
#: Buckets above this are compared as pairs of chunks, each pair in a group of its own.
CHUNK_ROWS = 2048
#: Shingles whose bits are counted at once, tile pairs compared at once, rows gathered for one comparison.
SLAB, TILES, GATHER = 1 << 16, 4096, 1 << 17

_ASCII = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))
_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64 bits; a bit is set if in over half the shingles' XXH64."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").translate(_ASCII).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:n].tolist()
    ends = ((ends - 1)[size - 1 :] if len(words) >= size else ends[-1:] - 1).tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, SLAB):
        h = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[at : at + SLAB], ends[at : at + SLAB], strict=True)], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (signed 64 bits) of every row; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, fp long")


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give rows linked by (a, b) the same, smallest label."""
    while True:
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            return
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def linked(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For rows sorted by ``group``: the index of each one's class in its group.

    Rows of one group within ``radius`` of each other, or joined by a chain
    of such rows, have the same class: its first row.  Fingerprints of more
    than 64 bits are rows of longs.
    """
    n = len(fps)
    label = np.arange(n)
    if n < 2:
        return label
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, n])
    words = -(-size // 64)
    word0 = np.cumsum(words) - words
    # Lane of each row: words of 64 lanes, none shared by two groups.
    within = np.arange(n) - np.repeat(first, size)
    word = np.repeat(word0, size) + within // 64
    lane = (within % 64).astype(np.uint64)
    total = int(words.sum())
    start = np.zeros(total, np.int64)
    start[word[::-1]] = np.arange(n)[::-1]  # first row of each word
    f = np.ascontiguousarray(fps.reshape(n, -1).T).view(np.uint64)
    planes = np.stack([np.bitwise_or.reduceat(((c >> np.uint64(p)) & _ONE) << lane, start) for c in f for p in range(BITS)])
    filled = np.bitwise_or.reduceat(_ONE << lane, start)
    # Pairs of words of one group, the query's first.
    reach = np.repeat(word0 + words, words) - np.arange(total)
    query = np.repeat(np.arange(total), reach)
    target = query + np.arange(len(query)) - np.repeat(np.cumsum(reach) - reach, reach)
    busiest = int(min(64, size.max()))
    for at in range(0, len(query), TILES):
        q, t = query[at : at + TILES], target[at : at + TILES]
        for i in range(busiest):
            (_compare if len(planes) == BITS and radius < 8 else _compare_wide)(planes, filled, start, label, q, t, i, radius)
    return label


def _compare(planes, filled, start, label, q, t, i: int, radius: int) -> None:
    """Merge lane ``i`` of the words ``q`` with the lanes of ``t`` in its radius."""
    lane = np.uint64(i)
    q, t, live = _live(filled, q, t, i)
    if not len(q):
        return
    ones, twos, fours, over = (np.zeros(len(q), np.uint64) for _ in range(4))
    for p in range(BITS):
        d = planes[p][t] ^ (np.uint64(0) - ((planes[p][q] >> lane) & _ONE))
        carry = ones & d
        ones ^= d
        carry2 = twos & carry
        twos ^= carry
        over |= fours & carry2
        fours ^= carry2
        # The counter holds 0 to 7; past the radius a lane never comes back.
        if radius == 4:
            over |= fours & (ones | twos)
        elif p == BITS - 1 or p % 8 == 7:
            for v in range(radius + 1, 8):
                over |= (ones if v & 1 else ~ones) & (twos if v & 2 else ~twos) & (fours if v & 4 else ~fours)
        if p % 8 == 7 and p >= 15:
            keep = np.flatnonzero(live & ~over)
            if not len(keep):
                return
            if len(keep) < len(q):
                q, t, live, ones, twos, fours, over = (x[keep] for x in (q, t, live, ones, twos, fours, over))
    _hits(live & ~over, start, label, q, t, i)


def _compare_wide(planes, filled, start, label, q, t, i: int, radius: int) -> None:
    """As :func:`_compare`, for any number of planes and any radius: a tree of carry-save adders."""
    lane = np.uint64(i)
    q, t, live = _live(filled, q, t, i)
    if not len(q):
        return
    levels = len(planes).bit_length()
    sums, spare = [np.zeros(len(q), np.uint64) for _ in range(levels)], [None] * levels
    for plane in planes:
        x, at = plane[t] ^ (np.uint64(0) - ((plane[q] >> lane) & _ONE)), 0
        while spare[at] is not None:
            either = spare[at] ^ x
            x, spare[at], sums[at], at = (spare[at] & x) | (sums[at] & either), None, sums[at] ^ either, at + 1
        spare[at] = x
    # What is left over at a level is added bit by bit.
    for at in range(levels):
        x = spare[at]
        for up in range(at, levels if x is not None else at):
            sums[up], x = sums[up] ^ x, sums[up] & x
    over, equal = np.zeros(len(q), np.uint64), np.full(len(q), _ALL)
    for at in reversed(range(levels)):
        if radius >> at & 1:
            equal &= sums[at]
        else:
            over |= equal & sums[at]
            equal &= ~sums[at]
    _hits(live & ~over, start, label, q, t, i)


def _live(filled, q, t, i: int):
    """Those of the pairs of words (q, t) that have a lane ``i`` and lanes to compare it with, and these lanes."""
    lane = np.uint64(i)
    here = (filled[q] >> lane) & _ONE == _ONE
    later = _ALL << lane << _ONE if i < 63 else np.uint64(0)
    live = np.where(q == t, filled[t] & later, filled[t])
    some = np.flatnonzero(here & (live != 0))
    return q[some], t[some], live[some]


def _hits(hits, start, label, q, t, i: int) -> None:
    bits = np.unpackbits(hits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    tile, lanes = np.nonzero(bits)
    _merge(label, start[q[tile]] + i, start[t[tile]] + lanes)


def _tables(n: int, radius: int) -> list[int]:
    """Bit masks, one a table: any two fingerprints in the radius agree on one.

    The 64 bits fall into blocks; ``radius`` differing bits touch at most
    ``radius`` of them, so the others agree.  More fingerprints take more,
    longer keys, so that the buckets of unlike fingerprints stay small.
    """
    for blocks in range(radius + 1, 3 * radius + 1):
        kept = blocks - radius
        if n / 2.0 ** (BITS * kept // blocks) <= BUCKET_ROWS or blocks == 3 * radius:
            break
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    part = [((1 << edges[i + 1]) - 1) & ~((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(part[i] for i in chosen) for chosen in combinations(range(blocks), kept)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: a spanning forest of the links in each bucket of distinct ``fp``.

    ``fps`` has each fingerprint once and no null; other columns are not read;
    an empty table gives no links.  Buckets of any size are compared whole, as
    pairs of chunks where they are large.
    """
    n = fps.count()
    masks = F.array(*(F.lit(_signed(m)) for m in _tables(n, radius)))
    rows = fps.select("fp", F.posexplode(masks).alias("table", "mask")).select("fp", "table", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    return compared(in_pairs(rows, ["table", "key"], "fp", CHUNK_ROWS).select("table", "key", "pair", "fp"), 3, 3, radius)


def in_pairs(rows: DataFrame, keys: list[str], by: str, most: int, counted: DataFrame | None = None) -> DataFrame:
    """``rows`` with a column ``pair``: groups of ``keys`` above ``most`` rows are dealt as pairs of chunks, each pair a group of its own.

    Any two rows of a group meet in a pair.  Smaller groups are one pair.
    ``counted`` has the keys of all rows, where ``rows`` are dear to compute.
    """
    sizes = (rows if counted is None else counted).groupBy(*keys).count().where(F.col("count") > most)
    # Groups above ``most``: few, whatever the input, as n rows fill at most n / most of them.
    rows = rows.join(F.broadcast(sizes), keys, "left")
    chunks = F.ceil(F.col("count") * 2 / most)
    mine = F.pmod(F.xxhash64(by), chunks)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda other: F.least(mine, other) * chunks + F.greatest(mine, other))
    return rows.withColumn("pair", F.explode(F.when(F.col("count").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(F.array_except(pairs, F.array(mine * chunks + mine))))).drop("count")


def compared(rows: DataFrame, keys: int, first: int, radius: int) -> DataFrame:
    """a, b: a spanning forest of the links within ``radius`` in each group.

    ``rows`` are longs: ``keys`` columns that name the group, then the row's
    name; its fingerprint is in the columns from ``first`` on.
    """
    dealt = rows.repartition(*rows.columns[:keys]).sortWithinPartitions(*rows.columns[: keys + 1])
    gather = GATHER // (len(rows.columns) - first)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def forest(r: np.ndarray) -> pa.RecordBatch:
            new = np.r_[True, (r[1:, :keys] != r[:-1, :keys]).any(axis=1)]
            label = linked(np.ascontiguousarray(r[:, first:]), np.cumsum(new), radius)
            moved = np.flatnonzero(label != np.arange(len(label)))
            a, b = r[moved, keys], r[label[moved], keys]
            # Rows that meet in many groups are linked once.
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)])
            return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new])], ["a", "b"])

        for b in batches:
            r = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1)
            if len(r):
                held.append(r)
                count += len(r)
            if count >= gather:
                r = np.concatenate(held)
                at = np.flatnonzero((r[1:, :keys] != r[:-1, :keys]).any(axis=1))
                if len(at):  # the last group may go on
                    yield forest(r[: at[-1] + 1])
                    r = r[at[-1] + 1 :]
                held, count = [r], len(r)
        if count:
            yield forest(np.concatenate(held))

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` (a, b) reaches.

    Repeated edges and loops do no harm, nulls must not occur, and an empty
    table gives no rows; a node without an edge to another is not listed.
    Alternates the large-star and small-star steps until nothing changes;
    each round is an aggregation and a join, and is written.
    """
    edges = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.a", "e.b").where("a != b").distinct()
        edges, before = materialize(small), mark
        mark = _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Tells whether two sets of edges are equal."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs``.

    Null texts count as empty (fingerprint zero, linked like any other); very
    long texts are hashed whole; an empty table gives no rows;
    ``component_id`` is the smallest doc_id that a row reaches through links,
    null ids aside: it is null only where no row of the class has an id.
    Repeated rows give repeated results; other columns are not read.
    """
    rows = materialize(fingerprints(docs))
    fps = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(fps.select("fp"), radius))
    # Classes of more than one fingerprint, then the smallest id in each.
    member = found.select(F.col("node").alias("fp"), "root").unionByName(found.select(F.col("root").alias("fp"), "root").distinct())
    named = fps.join(member, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialize(named)
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(smallest, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each class of like texts.

    Texts are alike if they have the same words, or if their five-word
    shingles have a Jaccard index of at least 0.8 (found by bit-sliced
    comparison of wide fingerprints, then checked); chains of like texts are
    one class.  The row with the smallest id stays, rows without an id last,
    ties by a hash of the text; of rows equal in all columns one stays.  Null
    texts count as empty, all empty texts as alike; very long ones are
    compared whole; an empty table gives no rows; other columns, whatever
    their names, are kept as they are.
    """
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(text_of()).alias("h"))
    from landgauge.llm.near_copies import alike, text_key  # rests on this module

    keys = row_key(docs, "h1", "h2")
    # All is decided on keys and hashes; rows are dealt once, to be joined with those that stay.
    first = docs.select(text_key().alias("u"), order.alias("at"), *keys).groupBy("u").agg(F.min(F.struct("at", "h1", "h2")).alias("first"))
    first = materialize(first.select("u", "first.*"))
    found = alike(docs.select(text_key().alias("u"), text_of().alias("text")))
    member = found.select(F.col("node").alias("u"), "root").unionByName(found.select(F.col("root").alias("u"), "root").distinct())
    ranked = materialize(first.select("u", "at").join(member, "u"))
    best = ranked.groupBy("root").agg(F.min(F.struct("at", "u")).alias("best"))
    others = ranked.join(best, "root").where(F.col("u") != F.col("best.u")).select("u")
    kept = materialize(first.join(others, "u", "left_anti").select("h1", "h2"))
    rows = docs.select(F.struct("*").alias("row"), *keys).join(kept.hint("merge"), ["h1", "h2"], "left_semi")
    return rows.dropDuplicates(["h1", "h2"]).select("row.*")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
