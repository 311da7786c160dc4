"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by fast pseudo-rotations (random signs and a Hadamard
transform, three times) and assigned to the nearest signed axis; a table's
key joins some such axes, the last one of fewer dimensions, so that a bucket
holds a handful of vectors at any size of the index.  The index is keys and
row numbers only.  Queries probe keys in each table, the likeliest first,
until the buckets hold a stated number of vectors; what they collect is
reranked by exact distances of the original vectors in double precision, block
by block.  That number grows as a power of the vectors well under 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import materialize, table

#: Rows expected in a bucket, at most; a query's candidates: REACH times the POWER of the rows; tables over the fourth root, and the most.
BUCKET_ROWS, REACH, POWER, SPREAD, MOST_TABLES, SEED = 4, 72, 0.4, 4, 64, 11
#: Vectors of a block, and queries that meet one in a task; vectors hashed at a time.
BLOCK_ROWS, CHUNK_ROWS, SLAB = 4096, 4096, 2048
NEAREST, EVERY = 10, 100
#: Bits of a key within its table.
_KEY_BITS = 34


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The normalised Walsh-Hadamard transform of each row."""
    n = x.shape[1]
    h = 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        out = np.empty_like(y)
        np.add(y[:, :, 0], y[:, :, 1], out=out[:, :, 0])
        np.subtract(y[:, :, 0], y[:, :, 1], out=out[:, :, 1])
        x = out.reshape(len(x), n)
        h *= 2
    return x * x.dtype.type(1 / math.sqrt(n))


class CrossPolytope:
    """Keys of ``bits`` bits in each of ``tables`` tables, for vectors of up to ``dim`` parts."""

    def __init__(self, dim: int, tables: int, bits: int, seed: int = SEED):
        self.width = max(2, 1 << math.ceil(math.log2(max(1, dim))))
        whole = self.width.bit_length()  # bits that 2 * width signed axes need
        #: Dimensions of each axis of a key.
        self.axes = [self.width] * (bits // whole) + ([1 << (bits % whole - 1)] if bits % whole else [])
        self.tables = tables
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, len(self.axes), 3, self.width)).astype(np.float32)

    def _unit(self, x: np.ndarray) -> np.ndarray:
        y = np.zeros((len(x), self.width), np.float32)
        # Scaled first, so that neither huge nor tiny parts leave the range.
        x = x / np.abs(x).max(axis=1, keepdims=True)
        y[:, : x.shape[1]] = x / np.linalg.norm(x, axis=1, keepdims=True)
        return y

    def _turned(self, y: np.ndarray, t: int, a: int) -> np.ndarray:
        for s in self.signs[t, a]:
            y = _hadamard(y * s)
        return np.concatenate([y[:, : self.axes[a]], -y[:, : self.axes[a]]], axis=1)

    def keys(self, x: np.ndarray) -> np.ndarray:
        """The key of each row in each table: (tables, rows)."""
        y, out = self._unit(x), np.zeros((self.tables, len(x)), np.int64)
        for t in range(self.tables):
            for a, size in enumerate(self.axes):
                out[t] = out[t] * 2 * size + self._turned(y, t, a).argmax(axis=1)
        return out

    def probes(self, x: np.ndarray, t: int, most: int) -> np.ndarray:
        """The ``most`` likeliest keys of each row in a table, best first: (rows, probes).

        A key ranks by the sum of the squares of what its axes fall short of
        the nearest; of the best ``most`` keys each part is among the best.
        """
        y = self._unit(x)
        key, lost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for a, size in enumerate(self.axes):
            turned = self._turned(y, t, a).astype(np.float64)
            best = np.argsort(-turned, axis=1, kind="stable")[:, :most]
            short = turned.max(axis=1, keepdims=True) - np.take_along_axis(turned, best, 1)
            key = (key[:, :, None] * 2 * size + best[:, None, :]).reshape(len(x), -1)
            lost = (lost[:, :, None] + short[:, None, :] ** 2).reshape(len(x), -1)
            order = np.argsort(lost, axis=1, kind="stable")[:, :most]
            key, lost = np.take_along_axis(key, order, 1), np.take_along_axis(lost, order, 1)
        return key


def plan(n: int) -> tuple[int, int, int, int]:
    """Tables, bits of a key, probes of a table and vectors that end them, for ``n`` distinct vectors.

    The probes would meet that many vectors if all keys were equally filled;
    the likeliest are filled better, so the vectors end them.
    """
    tables = min(MOST_TABLES, max(1, math.ceil(SPREAD * n**0.25)))
    bits = max(1, math.ceil(math.log2(max(1, n / BUCKET_ROWS))))
    rows = max(1, math.ceil(REACH * n**POWER / tables))
    return tables, bits, max(1, math.ceil(rows / max(1.0, n / 2**bits))), rows


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and vectors of a column of lists, by their length."""
    lengths = np.diff(column.offsets.to_numpy())
    flat, starts = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(lengths) - lengths
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, flat[starts[at, None] + np.arange(d)]


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part; -0.0 is 0.0, as it is in distances."""
    ok = F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("embedding", lambda x: x != 0)
    # Floats travel as floats; distances are taken in double precision.
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding")).where(ok)
    return rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast(kind)))


def indexed(rows: DataFrame, every: int = EVERY) -> DataFrame:
    """v, dim, embedding, least (its smallest vec_id) and asks of each distinct vector."""
    one = rows.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.max((F.col("vec_id") % every == 0).cast("int")).alias("asks"))
    return materialize(one.select(F.monotonically_increasing_id().alias("v"), F.size("embedding").alias("dim"), "embedding", "least", "asks"))


def candidates(distinct: DataFrame, n: int) -> DataFrame:
    """q, v: the vectors that each asking vector meets in the tables; a pair may stand more than once."""
    tables, bits, probes, enough = plan(n)
    dim = distinct.agg(F.max("dim")).first()[0]
    hashing = CrossPolytope(dim, tables, bits)
    # A vector meets those of its own length only: the length is part of the key.
    base = lambda d, t: (d * MOST_TABLES + t) << _KEY_BITS

    def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
        for b in batches:
            for at in range(0, b.num_rows, SLAB):
                part = b.slice(at, SLAB)
                for rows_, x in _by_length(part.column(1)):
                    yield part.column(0).take(pa.array(rows_)), x

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for v, x in slabs(batches):
            keys = hashing.keys(x)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([pa.array(keys[t] + base(x.shape[1], t)), v], ["key", "v"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for q, x in slabs(batches):
            for t in range(tables):
                keys = hashing.probes(x, t, probes)
                row = pa.array(np.repeat(np.arange(len(x)), keys.shape[1]))
                turn = pa.array(np.tile(np.arange(keys.shape[1], dtype=np.int32), len(x)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel() + base(x.shape[1], t)), q.take(row), turn], ["key", "q", "turn"])

    index = materialize(distinct.select("v", "embedding").mapInArrow(place, "key long, v long"))
    asked = distinct.where("asks = 1").select("v", "embedding").mapInArrow(ask, "key long, q long, turn int")
    # A bucket is read whole if those before it hold too few.
    held = asked.join(index.groupBy("key").agg(F.count("*").alias("n")), "key")
    before = f"sum(n) over (partition by q, shiftright(key, {_KEY_BITS}) order by turn rows between unbounded preceding and 1 preceding)"
    kept = held.withColumn("before", F.expr(f"coalesce({before}, 0)")).where(F.col("before") < enough).select("key", "q")
    return kept.join(index, "key").select("q", "v")


def _block(v: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(v), F.lit(blocks)).cast("int")


def rerank(pairs: DataFrame, distinct: DataFrame, n: int, most: int) -> DataFrame:
    """q, v, least, score: the ``most`` nearest of each query among its candidates, ties to the smaller least.

    ``pairs`` are (q, v), or (q) alone for queries that meet every vector.
    Vectors are read in blocks; a block that many queries meet is given to
    several tasks, each with a part of the queries.
    """
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    if "v" in pairs.columns:
        met = pairs.select("q", "v", _block("v", blocks).alias("block")).groupBy("block", "q").agg(F.collect_set("v").alias("vs"))
    else:
        met = pairs.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "q", F.lit(None).cast("array<long>").alias("vs"))
    met = materialize(met)
    parts = met.groupBy("block").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("parts"))
    queries = distinct.select(F.col("v").alias("q"), F.col("embedding").alias("point"))
    asked = met.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int")).join(queries, "q").select("block", "part", "q", "vs", "point")
    held = distinct.select("v", "least", "embedding", _block("v", blocks).alias("block")).join(parts, "block")
    held = held.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("block", "part", "v", "least", "embedding")

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            right = right.combine_chunks()
            at = np.argsort(right["v"].to_numpy(), kind="stable")
            right = right.take(pa.array(at))
            v, least, x = right["v"].to_numpy(), right["least"].to_numpy(), right["embedding"].combine_chunks()
            by = {m.shape[1]: (rows_, m) for rows_, m in _by_length(x)}
            place = np.zeros(len(v), np.int64)
            for rows_, _ in by.values():
                place[rows_] = np.arange(len(rows_))
            left = left.combine_chunks()
            q, lists = left["q"].to_numpy(), left["vs"].to_pylist()
            for mine, y in _by_length(left["point"].combine_chunks()):
                if y.shape[1] not in by:
                    continue
                rows_, m = by[y.shape[1]]
                for i, one in zip(mine.tolist(), y, strict=True):
                    own = rows_ if lists[i] is None else np.searchsorted(v, np.array(lists[i], np.int64))
                    score = np.sqrt(((m[place[own]] - one) ** 2).sum(axis=1))
                    best = np.lexsort((least[own], score))[:most]
                    found.append((np.full(len(best), q[i]), v[own[best]], least[own[best]], score[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table(dict(zip(("q", "v", "least", "score"), map(pa.array, columns), strict=True)))

    near = asked.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInArrow(compare, "q long, v long, least long, score double")
    return _first(near, "q", ["score", "least", "v"], most)


def _first(df: DataFrame, by: str, order: list[str], most: int, name: str = "k") -> DataFrame:
    return df.withColumn(name, F.expr(f"row_number() over (partition by {by} order by {', '.join(order)})")).where(F.col(name) <= most)


def search(vectors: DataFrame, nearest: int = NEAREST, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of each query.

    Queries are the rows whose vec_id is divisible by ``every``; candidates
    are all rows but the query's own.  Vectors that are null, empty, zero or
    hold nulls or non-finite parts take no part, nor do null ids; vectors of
    different lengths have no distance and never meet.  Ties go to the smaller
    vec_id; of repeated rows each counts; very long vectors are hashed whole;
    an empty table gives no rows; other columns are not read.  Queries that
    found fewer rows than asked for meet all vectors, in blocks.  Unlike
    vectors that no key tells apart (a dense clump) share their buckets, and
    its queries meet all of them.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    rows = materialize(valid(vectors))
    distinct = indexed(rows, every)
    n = distinct.count()
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    most = nearest + 1
    near = materialize(rerank(candidates(distinct, n), distinct, n, most).drop("k"))
    # Rows that stand for each vector found decide whether a query has enough.
    ids = rows.join(distinct.select("embedding", "v"), "embedding").select("v", "vec_id")
    copies = ids.groupBy("v").agg(F.least(F.count("*"), F.lit(most)).alias("copies"))
    enough = near.join(copies, "v").groupBy("q").agg(F.sum("copies").alias("rows")).where(F.col("rows") >= most).select("q")
    short = materialize(distinct.where("asks = 1").select(F.col("v").alias("q")).join(enough, "q", "left_anti"))
    if short.limit(1).count():
        near = materialize(near.join(short, "q", "left_anti").unionByName(rerank(short, distinct, n, most).drop("k")))
    # The smallest ids of each vector found, then of all vectors that a query vector has found.
    ids = _first(ids.join(near.select("v").distinct(), "v", "left_semi"), "v", ["vec_id"], most).drop("k")
    found = _first(near.select("q", "v", "score").join(ids, "v"), "q", ["score", "vec_id"], most).drop("k", "v")
    asking = rows.where(F.col("vec_id") % every == 0).join(distinct.select("embedding", "v"), "embedding").select(F.col("v").alias("q"), F.col("vec_id").alias("query_id"))
    out = asking.join(found, "q").where("vec_id != query_id")
    out = _first(out, "query_id", ["score", "vec_id"], nearest, "rank")
    return out.select("query_id", "rank", "vec_id", "score")


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
