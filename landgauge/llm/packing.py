"""Best-fit packing with certified, repaired partitions.

Documents become token ids; only those longer than a sequence are cut, the
first piece taking the remainder, so whole sequences fill themselves.  The
rest is dealt into partitions that are packed best-fit decreasing.  For each
partition dual feasible functions give a lower bound on its bins: where the
bound is met the packing is certified and closed, all but its emptiest bin;
where there is a gap, the bins that are not full are opened.  What is open is
dealt anew over fewer partitions and packed again, as long as that saves bins.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import materialize, table, text_of

CAPACITY, END = 1024, 2
#: Pieces packed by one task at a time.
PART_ROWS = 8192
VOCABULARY = "byte_bpe_50k.json"
#: Distinct words that a Python worker remembers, the longest such word, texts encoded at a time, and words of one call.
MEMO_WORDS, MEMO_CHARS, SLAB, LINES = 300_000, 64, 1024, 200
#: White space of any library, and format characters next to which no text is cut.
_WHITE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"


class Encoder:
    """Ids as ``tokenizers`` gives them, without added special tokens.

    The library's pattern takes a space only as the first character of what
    follows it, and white space before anything else alone.  So where one
    space or line feed stands between two characters that are no white space,
    a text may be cut before it, and the parts have the ids of the whole; so
    have a part's letters and the marks at its end.  Each distinct part goes
    to the library once, as long as the memo holds it: to its model at once if
    it is all ASCII letters, which are one word to the pattern.  Texts where
    white space stands together, or at an end, go whole.
    """

    #: A letter in any version of Unicode, then marks to the end of a word.
    MARKS = r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([.,;:!?]+)( |\z)"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        given = json.loads(self.library.to_str())
        before = given["pre_tokenizer"] or {}
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.feed, self.model = self._whole("\n"), self.library.model
        #: A space as the model has it.
        self.space = self.library.pre_tokenizer.pre_tokenize_str(" ")[0][0] if before else " "
        #: Whether texts may be cut as above; lines of one call are told apart by the id of the line feed.
        self.separable = given["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True) and len(self.feed) == 1
        self.together = "|".join([rf"{_WHITE}{{2}}", rf"\A{_WHITE}", rf"{_WHITE}\z", r"[\x{0}\x{1}]", *map(re.escape, special)])
        #: Ids of each part, four bytes an id.
        self.memo: dict[str, bytes] = {}

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _learn(self, parts: list[str]) -> None:
        """Parts start with NUL at the start of a text, with a line feed after one, with SOH after letters, else after a space."""
        other = []
        for p in parts:
            plain = p[1:] if p[0] in "\0\1\n" else p
            if plain.isascii() and plain.isalpha():
                self._keep(p, [t.id for t in self.model.tokenize(plain if len(plain) < len(p) else self.space + plain)])
            else:
                other.append(p)
        for at in range(0, len(other), LINES):
            some = other[at : at + LINES]
            ids = self._whole("\n".join(p[1:] if p[0] in "\0\1\n" else " " + p for p in some))
            a = 0
            for p, z in zip(some, [*(i for i, x in enumerate(ids) if x == self.feed[0]), len(ids)], strict=True):
                self._keep(p, ids[a:z])
                a = z + 1

    def _keep(self, part: str, ids: list[int]) -> None:
        self.memo[part] = np.array([*self.feed, *ids] if part[0] == "\n" else ids, "<u4").tobytes()

    def many(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        whole = pc.match_substring_regex(texts, self.together).to_numpy(zero_copy_only=False) if self.separable else np.ones(len(texts), bool)
        out: list = [None] * len(texts)
        for i in np.flatnonzero(whole).tolist():
            out[i] = np.array(self._whole(texts[i].as_py()), "<u4")
        cut = np.flatnonzero(~whole)
        if not len(cut):
            return out
        spaced = pc.replace_substring_regex(pc.replace_substring(texts.take(pa.array(cut)), "\n", " \n"), self.MARKS, "\\1 \1\\2\\3")
        lists = pc.split_pattern(pc.binary_join_element_wise("\0", spaced, ""), " ")
        coded = lists.flatten().dictionary_encode()
        parts, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        self._learn([p for p in parts if p not in self.memo])
        known = [self.memo[p] for p in parts]
        for p in parts:
            if len(p) > MEMO_CHARS:
                del self.memo[p]
        n = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, starts = np.frombuffer(b"".join(known), "<u4"), np.cumsum(n) - n
        ends = np.cumsum(n[index])
        ids = flat[np.repeat(starts[index] - ends + n[index], n[index]) + np.arange(ends[-1])]
        bounds = np.r_[0, ends][lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        for i, a, z in zip(cut.tolist(), bounds, bounds[1:], strict=False):
            out[i] = ids[a:z]
        return out

    def ids(self, text: str) -> np.ndarray:
        return self.many(pa.array([text], pa.string()))[0]


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    return Encoder(path)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            of, piece, start, length, crc = [], [], [], [], []
            texts = b.column(1)
            for i, ids in enumerate(x for at in range(0, len(texts), SLAB) for x in e.many(texts.slice(at, SLAB))):
                ids = np.append(ids, np.uint32(END)).astype("<u4")
                n = len(ids)
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                data = memoryview(ids.tobytes())
                for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    of.append(i), piece.append(k), start.append(a), length.append(z - a), crc.append(zlib.crc32(data[4 * a : 4 * z]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs; ``counts`` by length, from 0 to capacity.

    The largest of the bounds by the dual feasible functions that drop
    lengths under e and round those over capacity - e up to whole bins, for
    each e, and of those that round to k-ths of a bin, for k up to 64.
    """
    x = np.arange(capacity + 1)
    n, mass = np.cumsum(counts), np.cumsum(counts * x)
    best = -(-int(mass[-1]) // capacity)
    for e in range(1, capacity // 2 + 1):
        large = int(n[-1] - n[capacity - e])
        middle = int(mass[capacity - e] - mass[e - 1])
        best = max(best, -(-(large * capacity + middle) // capacity))
    for k in range(1, 65):
        exact = (k + 1) * x % capacity == 0
        # In units of 1 / (k * capacity).
        value = np.where(exact, x * k, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length, and the free room of each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, some = [], 0  # some: bit r is set if a bin has room r
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = some >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                some ^= 1 << room
        else:
            b, room = len(rooms), capacity
            rooms.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        room -= size
        rooms[b] = room
        by_room[room].append(b)
        some |= 1 << room
    return bins, offsets, np.array(rooms, np.int64)


_ROW = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _packed(rows: DataFrame, n: int, turn: int, capacity: int) -> DataFrame:
    """``rows`` dealt over partitions and packed, with sequence, offset and open."""
    parts = max(1, -(-n // PART_ROWS))

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("uid")
        lengths = rows["length"].to_numpy()
        bins, offsets, rooms = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        free = rooms == rooms.max() if len(rooms) == bound else rooms > 0
        if len(rooms) == bound:  # certified: only its emptiest bin may be shared with others
            free[np.flatnonzero(free)[1:]] = False
        base = ((turn + 1) << 56) | (rows["part"][0].as_py() << 28)
        out = rows.drop_columns("part").append_column("sequence_id", pa.array(base | bins)).append_column("offset", pa.array(offsets))
        return out.append_column("open", pa.array(free[bins] & (rooms[bins] > 0)))

    dealt = rows.select(*(c.split()[0] for c in _ROW.split(", "))).withColumn("part", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(parts)).cast("int"))
    return dealt.groupBy("part").applyInArrow(run, _ROW + ", sequence_id long, offset long, open boolean")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece.

    Null texts count as empty (their end token alone); null ids stay null;
    repeated rows are packed once each; very long texts are cut into pieces,
    all of which are packed; an empty table gives no rows; other columns are
    not read.  Rounds go on as long as one saves a sequence.
    """
    rows = materialize(pieces(docs, path, capacity).withColumn("uid", F.monotonically_increasing_id()))
    whole = rows.where(F.col("length") == capacity).withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    done = [whole]
    pool = rows.where(F.col("length") < capacity)
    n, turn = pool.count(), 0
    current, before = None, None
    while n:
        new = materialize(_packed(pool, n, turn, capacity))
        used = _bins(new)
        if before is not None and used >= before:
            break
        done.append(new.where("not open"))
        current = new.where("open")
        pool, n, before, turn = current, current.count(), _bins(current), turn + 1
    if current is not None:
        done.append(current)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    out = done[0].select(*names)
    for d in done[1:]:
        out = out.unionByName(d.select(*names))
    return out


def _bins(df: DataFrame) -> int:
    return df.select("sequence_id").distinct().count()


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
