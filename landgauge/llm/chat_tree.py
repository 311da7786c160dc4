"""Chat formatting over a prefix tree of conversations.

Each turn is written between markers, control strings inside roles and texts
being broken up reversibly.  Conversations that share their first turns share
the nodes of a prefix tree; the tree's segments are laid out once, depth
first, in one stream.  Each segment carries the position its first character
has in every conversation through it, the span under the loss mask and the
intervals of the stream that it may attend to: its ancestors' and its own.
A conversation is read back from the stream turn by turn, at the offsets of
the nodes on its path.  No row holds a conversation: turns are rows from
first to last, and digests are taken while they pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from landgauge.llm.common import hex16, materialize, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPE = "\x1b"
#: Where a control string begins: that of this template or of other common ones.
CONTROL = r"([<\[])(?=(?:/?s>|unk>|pad>|/?INST\]|</?SYS>>|\|[^|<>]*\|>))"
#: Whose texts are learnt.
LEARNT = "assistant"
#: A conversation that every run adds: its texts are made of control strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def escaped(text: Column) -> Column:
    """No control string is left: an escape follows the first character of each; escapes of the text are doubled."""
    return F.regexp_replace(F.regexp_replace(text, ESCAPE, ESCAPE + ESCAPE), CONTROL, "$1" + ESCAPE)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, f"{ESCAPE}({ESCAPE}?)", "$1")


def segments(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, segment, segment_id, loss_start, loss_length of each turn.

    ``loss_start`` counts code points from 1; the length is 0 where nothing
    is learnt.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), escaped(role).alias("r"), escaped(text).alias("t"))
    head = F.concat(F.lit(TURN), "r", F.lit(TEXT))
    learnt = F.when(F.col("role") == LEARNT, F.length("t")).otherwise(0)
    rows = rows.select("conv_id", "turn", "role", F.concat(head, "t", F.lit(END)).alias("segment"), (F.length(head) + 1).alias("loss_start"), learnt.alias("loss_length"))
    return rows.withColumn("segment_id", F.md5("segment"))


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, node, parent, leaf, segment_id, length, position: a row a turn, from the root down.

    A node is named by 128 bits that tell all turns down to it, as running
    sums of hashes of depth and segment; ``position`` is where its segment
    starts in a conversation, ``leaf`` the conversation's last node.  Texts
    take no part: a turn stands as its digest and length.
    """
    rows = turns.select("conv_id", F.col("turn").isNull().alias("last"), "turn", "role", "segment_id", F.length("segment").cast("long").alias("length"))
    order = Window.partitionBy("conv_id").orderBy("last", "turn", "role", "segment_id")
    rows = rows.withColumn("depth", F.row_number().over(order) - 1)
    down = Window.partitionBy("conv_id").orderBy("depth")
    running = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    half = lambda seed: hex16(F.bit_xor(F.xxhash64(F.lit(seed), "depth", "segment_id")).over(running))
    rows = rows.withColumns({"node": F.concat(half(0), half(1)), "position": F.sum("length").over(running) - F.col("length")})
    leaf = F.last("node").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return rows.withColumns({"parent": F.lag("node").over(down), "leaf": leaf}).select("conv_id", "depth", "node", "parent", "leaf", "segment_id", "length", "position")


def _steps(path: DataFrame) -> DataFrame:
    """The paths of each leaf once, however many conversations end there."""
    return path.groupBy("leaf", "depth").agg(*(F.first(c).alias(c) for c in ("node", "parent", "segment_id", "length", "position")))


def _keys(steps: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, key: sorting by key and depth visits the tree depth first.

    A key holds a part for each turn of the path that has siblings (or is a
    root), so it is as long as the path has branchings, not turns.
    """
    # Written, so that the join below is one of two plain shuffles, of which Spark can split a hot parent's.
    forks = materialize(nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("fork")).count().where("count > 1").select("fork"))
    part = F.when(F.col("fork").isNotNull() | F.col("parent").isNull(), F.substring("node", 1, 16))
    parts = steps.join(forks, F.col("parent") == F.col("fork"), "left").select("leaf", "depth", "node", part.alias("part"))
    running = Window.partitionBy("leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = parts.select("node", F.array_join(F.collect_list("part").over(running), "").alias("key"))
    return keyed.groupBy("node").agg(F.min("key").alias("key"))


def stream(turns: DataFrame, path: DataFrame) -> DataFrame:
    """The tree's segments in their order: one row a node.

    Columns node, parent, depth, offset, length, position, segment,
    loss_start, loss_length and intervals: the (start, end) of the stream that
    the node may attend to, those of its ancestors and its own, neighbours
    joined into one, so as many as its path has branchings.  Offsets are
    running totals over a range-partitioned order: one total for each
    partition is summed in one place, no rows.
    """
    steps = materialize(_steps(path))
    nodes = materialize(steps.groupBy("node").agg(*(F.first(c).alias(c) for c in ("parent", "depth", "segment_id", "length", "position")), F.min("leaf").alias("guide")))
    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.join(_keys(steps, nodes), "node").repartitionByRange(n, "key", "depth").withColumn("part", F.spark_partition_id())
    placed = materialize(placed)
    before = placed.groupBy("part").agg(F.sum("length").alias("total"))
    before = before.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    running = F.sum("length").over(Window.partitionBy("part").orderBy("key", "depth"))
    placed = placed.withColumn("end", running).join(F.broadcast(before), "part")  # a row for each shuffle partition
    placed = placed.withColumn("end", F.col("end") + F.col("before")).withColumn("offset", F.col("end") - F.col("length")).drop("part", "before", "key")
    placed = materialize(placed)
    along = steps.select("leaf", "depth", "node").join(placed.select("node", "offset", "end"), "node")
    # Stretches of neighbours on each path, then the list of a path's stretches.
    down = Window.partitionBy("leaf").orderBy("depth")
    apart = F.coalesce((F.lag("end").over(down) != F.col("offset")).cast("int"), F.lit(0))
    along = along.withColumn("apart", apart).withColumn("stretch", F.sum("apart").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    stretches = along.groupBy("leaf", "stretch").agg(F.min("offset").alias("start"), F.max("end").alias("end"))
    reach = stretches.groupBy(F.col("leaf").alias("guide")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("reach"))
    own = F.transform(F.filter("reach", lambda r: r["start"] < F.col("end")), lambda r: F.struct(r["start"].alias("start"), F.least(r["end"], F.col("end")).alias("end")))
    out = placed.join(reach, "guide").withColumn("intervals", own)
    texts = turns.groupBy("segment_id").agg(*(F.first(c).alias(c) for c in ("segment", "loss_start", "loss_length")))
    return out.join(texts, "segment_id").select("node", "parent", "depth", "offset", "length", "position", "segment", "loss_start", "loss_length", "intervals")


def read_back(layout: DataFrame, path: DataFrame) -> DataFrame:
    """leaf, depth, role, text, learnt, chars: each path's turns as the stream holds them, unescaped."""
    parsed = rf"(?s)^\Q{TURN}\E(.*?)\Q{TEXT}\E(.*)\Q{END}\E$"
    parts = layout.select(
        "node",
        F.length("segment").cast("long").alias("chars"),
        unescaped(F.regexp_extract("segment", parsed, 1)).alias("role"),
        unescaped(F.regexp_extract("segment", parsed, 2)).alias("text"),
        unescaped(F.substr("segment", F.col("loss_start"), F.col("loss_length"))).alias("learnt"),
    )
    return path.groupBy("leaf", "depth").agg(F.first("node").alias("node")).join(parts, "node").select("leaf", "depth", "role", "text", "learnt", "chars")


_DIGESTS = "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(turns: DataFrame) -> DataFrame:
    """What each path reads back as, by digests that are taken while its turns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, done = None, []
        n = learnt_chars = chars = 0
        whole, learnt = hashlib.sha256(), hashlib.sha256()

        def batch() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * 6
            done.clear()
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _DIGESTS.split(", ")])

        for b in batches:
            for of, role, text, own, size in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                if of != leaf:
                    if n:
                        done.append((leaf, n, whole.hexdigest(), learnt_chars, learnt.hexdigest(), chars))
                    leaf, n, learnt_chars, chars = of, 0, 0, 0
                    whole, learnt = hashlib.sha256(), hashlib.sha256()
                whole.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                learnt.update(own.encode("utf-8", "surrogatepass"))
                n, learnt_chars, chars = n + 1, learnt_chars + len(own), chars + size
            yield batch()
        if n:
            done.append((leaf, n, whole.hexdigest(), learnt_chars, learnt.hexdigest(), chars))
        yield batch()

    return turns.repartition("leaf").sortWithinPartitions("leaf", "depth").mapInArrow(run, _DIGESTS)


def formatted(conversations: DataFrame) -> DataFrame:
    """What each conversation reads back as, by digests.

    Rows are ordered by turn, a null turn last, ties by role and then text
    digest; null roles and texts count as empty; very long texts are segments
    like others, and a conversation may have any number of turns; rows with a
    null conv_id are one conversation; repeated rows are turns of their own;
    an empty table leaves the probe alone; other columns are not read.
    """
    spark = conversations.sparkSession
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    turns = materialize(segments(rows.unionByName(spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string"))))
    path = materialize(paths(turns))
    layout = materialize(stream(turns, path))
    found = digests(read_back(layout, path))
    ends = path.where("node = leaf").select("conv_id", "leaf")
    return ends.join(found, "leaf").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op3_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(table(spark, sf_dir, "conversations"))
