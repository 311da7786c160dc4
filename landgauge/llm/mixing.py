"""Mixing sources to target weights by the cube method.

A source's target over its size is the number of times each of its documents
is taken: the whole part for certain, the rest as an inclusion probability.
The flight phase of the cube method moves these probabilities through the
null space of the balancing constraints (token and document totals): the
largest undecided document is moved against all others of its block together,
until each block has at most two undecided ones, its smallest; these are
gathered into fewer blocks and fly again, until each source has at most two
left.  For those the landing drops the document and then the token constraint.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import WORD, materialize, row_key, table, text_of

WEIGHTS = (3, 1, 2)
#: Words taken over all words; times a source may be repeated; documents in a block.
SHARE, MOST, BLOCK_ROWS, SEED = 1.5, 2.0, 512, 7
#: Copies of one row that are listed at a time.
COPIES = 4096
_SURE = 1e-9


def targets(sizes: dict[str | None, int], weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words to take of each source.

    Sources by code point, null last, get the weights in turn.  Targets stop
    at ``most`` times the size; the excess is shared anew by weight among the
    others until none is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), list(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def _direction(p: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Units and a direction that moves the first of them while their number and tokens stay; None for under three units."""
    units = np.arange(len(p))
    while len(units) >= 3:
        rest = units[1:]
        # Units near 0 or 1 move least, so the first one arrives there before them.
        w, s = p[rest] * (1 - p[rest]), size[rest] / size[units].max()
        a, b, c, first = w.sum(), w @ s, w @ (s * s), size[units[0]] / size[units].max()
        det = a * c - b * b
        if det > 1e-12 * a * c:
            return units, np.r_[1.0, w * (b * first - c + (b - a * first) * s) / det]
        if size[units[0]] == size[rest[0]]:
            return units, np.r_[1.0, -w / a]
        units = rest  # all others are of one size, so the first cannot move
    return None


def flight(p: np.ndarray, size: np.ndarray, rng: random.Random, landing: bool) -> np.ndarray:
    """Move ``p`` keeping its sum and that of p times size, until decided.

    At most two entries stay strictly between 0 and 1; with ``landing`` none:
    the last two keep the token total alone, the last one neither.
    """
    p, size = p.astype(float), size.astype(float)
    live = np.flatnonzero((p > 0) & (p < 1))
    live = live[np.argsort(-size[live], kind="stable")]
    while len(live):
        found = _direction(p[live], size[live])
        if found is not None:
            units, d = found
        elif not landing:
            break
        elif len(live) == 2:
            units, d = np.arange(2), np.array([size[live[1]], -size[live[0]]]) / size[live[0]]
        else:
            units, d = np.arange(1), np.ones(1)
        at = live[units]
        with np.errstate(divide="ignore", invalid="ignore"):
            room = np.where(d > 0, (1 - p[at]) / d, np.where(d < 0, -p[at] / d, np.inf))
            back = np.where(d > 0, p[at] / d, np.where(d < 0, (p[at] - 1) / d, np.inf))
        up, down = room.min(), back.min()
        forward = rng.random() * (up + down) < down
        hit = int((room if forward else back).argmin())
        p[at] += (up if forward else -down) * d
        p[at[hit]] = float((d[hit] > 0) == forward)
        p[at] = np.where(p[at] < _SURE, 0.0, np.where(p[at] > 1 - _SURE, 1.0, p[at]))
        live = live[(p[live] > 0) & (p[live] < 1)]
    return p


def _sized(docs: DataFrame) -> DataFrame:
    """Each distinct row once, with the number of its copies."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"), *row_key(docs, "h1", "h2"))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


def _flight_of(seed: str, landing: bool):
    def fly(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("size", "descending"), ("h1", "ascending"), ("h2", "ascending"), ("k", "ascending")])
        rng = random.Random(f"{seed} {rows['source'][0].as_py()} {rows['block'][0].as_py()}")
        p = flight(rows["p"].to_numpy(), rows["size"].to_numpy(), rng, landing)
        return rows.drop_columns(["p", "block", "blocks"]).append_column("p", pa.array(p))

    return fly


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, source, h1, h2, k, size, source_size, target, taken of every row.

    ``taken`` is the row's size times the times it is taken; ``h1`` and ``h2``
    hash all columns, ``k`` numbers the copies of one row.  Null texts have
    size 0 and are never taken; a null source is a source of its own, the
    last; copies of one row are dealt over the blocks like other rows; very
    long texts are documents like others, decided first; an empty table gives
    no rows; extra columns count towards a row's identity only.  Choices
    follow from the rows alone, so reruns agree.  The driver holds a row a
    source.
    """
    spark = docs.sparkSession
    rows = materialize(_sized(docs))
    totals = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.sum("copies").alias("n")).collect()
    sizes = {r["source"]: r["source_size"] for r in totals}
    goal = targets(sizes, weights, share, most)
    plan = [(r["source"], r["source_size"], float(goal[r["source"]]), goal[r["source"]] / r["source_size"] if r["source_size"] else 0.0, max(1, math.ceil(r["n"] / BLOCK_ROWS))) for r in totals]
    names = ["doc_id", "source", "h1", "h2", "k", "size", "source_size", "target", "whole", "p"]
    schema = "doc_id long, source string, h1 long, h2 long, k long, size long, source_size long, target double, whole long, p double"
    if not plan:
        return spark.createDataFrame([], schema).select(*names[:8], F.lit(0).cast("long").alias("taken"))
    plan_rows = spark.createDataFrame(plan, "__s string, source_size long, target double, times double, blocks int")
    # Copies are listed in stretches, so that no array grows with them.
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    rows = rows.withColumn("k", F.explode(F.sequence(F.col("at"), F.least(F.col("copies"), F.col("at") + COPIES) - 1))).drop("at", "copies")
    rows = rows.join(plan_rows, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rows = rows.withColumn("whole", F.floor("times")).withColumn("p", F.col("times") - F.col("whole"))
    rows = rows.withColumn("p", F.when((F.col("size") == 0) | (F.col("p") < _SURE), 0.0).when(F.col("p") > 1 - _SURE, 1.0).otherwise(F.col("p")))
    decided = [rows.where("p in (0, 1)").select(*names)]
    pool = rows.where("p > 0 and p < 1")
    most_blocks, turn = max(r[4] for r in plan), 0
    while True:
        landing = most_blocks == 1
        blocks = F.pmod(F.xxhash64("h1", "h2", "k", F.lit(turn)), F.col("blocks")).cast("int")
        flown = materialize(pool.select(*names, "blocks").withColumn("block", blocks).groupBy("source", "block").applyInArrow(_flight_of(f"{seed} {turn}", landing), schema))
        if landing:
            decided.append(flown)
            break
        decided.append(flown.where("p in (0, 1)"))
        # At most two a block are left.
        turn, most_blocks = turn + 1, math.ceil(2 * most_blocks / BLOCK_ROWS)
        pool = flown.where("p > 0 and p < 1").join(plan_rows.select("__s", F.ceil(2 * F.col("blocks") / BLOCK_ROWS**turn).cast("int").alias("blocks")), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out.select(*names[:8], (F.col("size") * (F.col("whole") + F.col("p"))).cast("long").alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it.

    Copies of one row are the same in every column, so their times are added
    and one of them stands for all.  Choices are made on hashes; texts are
    dealt once, to be joined with them (rows that have copies are reduced to
    one before).  Null texts and empty ones are never taken; null ids and
    sources, repeated rows and extra columns are kept as they are; an empty
    table gives no rows.
    """
    times = mix(docs, **options).groupBy("h1", "h2").agg(F.sum(F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0)).alias("times"), F.count("*").alias("n"))
    times = materialize(times.where("times > 0"))
    keys = ["h1", "h2"]
    rows = docs.select(F.struct("*").alias("row"), *row_key(docs, *keys))
    # A merge at every size: how the texts are dealt does not depend on the size of the choices.
    single = rows.join(times.where("n = 1").hint("merge"), keys)
    several = rows.join(times.where("n > 1").select(*keys), keys, "left_semi").dropDuplicates(keys).join(times.where("n > 1"), keys)
    out = single.unionByName(several)
    return out.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("row.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
