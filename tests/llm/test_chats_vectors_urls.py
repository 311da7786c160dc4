import collections
import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landgauge.llm import ann, chat_tree as ct, url_filter as uf

# Chats.

CHAT = "conv_id long, turn long, role string, text string"
ODD = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<|turn|>", "<|end|>", "<|text|>", "\x1b", "<", "[", "\n", "a", "é", "😀", "$1", "\\", "|>"]


def digests(turns):
    turns = sorted(turns, key=lambda t: t[0])
    s, learnt = "".join(f"{r}\n{x}\n" for _, r, x in turns), "".join(x for _, r, x in turns if r == "assistant")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    # The template's own strings, and an escape after each control string's first character and each escape.
    marks = lambda x: len(x) + x.count("\x1b") + len(re.findall(ct.CONTROL, x.replace("\x1b", "\x1b\x1b")))
    chars = sum(len(ct.TURN + ct.TEXT + ct.END) + marks(r) + marks(x) for _, r, x in turns)
    return (len(turns), sha(s), len(learnt), sha(learnt), chars)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=8).map("".join), min_size=1, max_size=12))
def test_chats_read_back(spark, texts):
    rows = [(c, k, r, t) for c in range(2) for k, t in enumerate(texts[: c * 3 + 4]) for r in [["user", "assistant", "<|end|>x"][k % 3]]]
    check(spark, rows)


def check(spark, rows):
    out = ct.formatted(spark.createDataFrame(rows, CHAT)).collect()
    want = collections.defaultdict(list)
    for c, k, r, t in [*rows, *ct.PROBE]:
        want[c].append((k, r or "", t or ""))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in out} == {c: digests(t) for c, t in want.items()}
    assert len(out) == len(want)
    return out


def test_no_control_string_is_left(spark):
    rows = spark.createDataFrame([("".join(ODD),), ("<|<|end|>|><</s></s>",), ("\x1b\x1b<\x1b/s>",)], "t string")
    for r in rows.select("t", ct.escaped(F.col("t")).alias("e"), ct.unescaped(ct.escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<|turn|>", "<|end|>", "<|text|>"))


def test_shared_turns_stand_once_and_intervals_lead_to_them(spark):
    rows = [(c, 0, "system", "be brief") for c in range(6)] + [(c, 1, "user", f"q{c // 2}") for c in range(6)] + [(c, 2, "assistant", f"a{c}") for c in range(5)]
    turns = ct.segments(spark.createDataFrame(rows, CHAT))
    path = ct.paths(turns)
    out = ct.stream(turns, path).orderBy("offset").collect()
    assert len(out) == 1 + 3 + 5
    at = 0
    by = {r.node: r for r in out}
    for r in out:
        assert r.offset == at and r.length == len(r.segment)
        at += r.length
        chain = []
        n = r
        while n:
            chain.append((n.offset, n.offset + n.length))
            n = by.get(n.parent)
        reach = []
        for a, z in chain[::-1]:
            if reach and reach[-1][1] == a:
                a = reach.pop()[0]
            reach.append((a, z))
        assert [tuple(i) for i in r.intervals] == reach and r.position == sum(z - a for a, z in chain[1:]) and r.depth == len(chain) - 1
        if r.parent:
            assert by[r.parent].offset < r.offset
    stack = []
    for r in out:  # depth first: a node's parent is on the path just left
        while stack and stack[-1] != r.parent:
            stack.pop()
        assert stack or r.parent is None
        stack.append(r.node)


def test_a_long_conversation_and_its_copies(spark):
    long = [(1, k, ["user", "assistant"][k % 2], f"turn {k % 7}") for k in range(3000)]
    copies = [(c, k, r, t) for c in range(2, 30) for _, k, r, t in long[:40]]
    check(spark, long + copies)


def test_chat_edges(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (2, None, "user", "late"), (2, 5, "user", "early"), (None, 0, "user", "nobody"), (3, 0, "user", "y" * 100_000), (4, 0, "assistant", "twice"), (4, 0, "assistant", "twice")]
    df = spark.createDataFrame([(*r, 1) for r in rows], CHAT + ", segment int")
    out = {r.conv_id: r for r in ct.formatted(df).collect()}
    assert set(out) == {1, 2, None, 3, 4, -1}
    assert out[2].turns_sha256 == hashlib.sha256(b"user\nearly\nuser\nlate\n").hexdigest()
    assert out[1].turns_sha256 == hashlib.sha256(b"\nx\nassistant\n\n").hexdigest() and (out[4].n_turns, out[4].loss_chars) == (2, 10)
    assert [r.conv_id for r in ct.formatted(df.limit(0)).collect()] == [-1]


# Vectors.

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, nearest=10):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in ok:
        if q % every == 0:
            out[q] = sorted((float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in ok if i != q)[:nearest]
    return out


def found(spark, rows, **options):
    got = collections.defaultdict(list)
    for r in ann.search(spark.createDataFrame([(*r, 0) for r in rows], VECTORS), **options).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    return {q: sorted(f) for q, f in got.items()}


@pytest.mark.parametrize("blocks", [(4096, 4096), (256, 8)])
def test_recall_and_exact_scores(spark, monkeypatch, blocks):
    monkeypatch.setattr(ann, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(ann, "CHUNK_ROWS", blocks[1])
    x = np.random.default_rng(1).standard_normal((3000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = found(spark, rows), brute(rows)
    assert set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[q]} & {i for _, i in w}) for q, w in want.items())
    assert hits / (10 * len(want)) >= 0.9
    for q, near in got.items():
        assert [r for r, _, _ in near] == list(range(1, 11))
        assert sorted(near, key=lambda f: (f[2], f[1])) == near
        for _, v, s in near:
            assert s == pytest.approx(np.sqrt(((x[q].astype(float) - x[v].astype(float)) ** 2).sum()), abs=1e-12)


def test_rows_compared_grow_slower_than_the_rows(spark):
    compared = []
    for n in (2000, 16_000):
        x = np.random.default_rng(n).standard_normal((n, 64)).astype(np.float32)
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
        distinct = ann.indexed(ann.valid(df), 400)
        met = ann.candidates(distinct, n).groupBy("q").count()
        compared.append(met.agg(F.avg("count")).first()[0])
    assert compared[1] < 4.5 * compared[0] and compared[1] < 16_000 / 2


def test_ties_go_to_the_smaller_id(spark):
    axes = [(i, [float(i == k) for k in range(32)]) for i in range(32)]
    assert [v for _, v, _ in found(spark, axes)[0]] == list(range(1, 11))


def test_few_vectors_are_all_found(spark):
    rows = [(i, v) for i, v in enumerate([[1.0, 0.0, 0.0], [-1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, -1.0, 0.0], [0.0, 0.0, 1.0], [0.0, 0.0, -1.0], [1.0, 1.0, 1.0], [-1.0, -1.0, -1.0]])]
    assert {v for _, v, _ in found(spark, rows)[0]} == set(range(1, 8))
    far = [(0, [1.0, 0.001 * k]) for k in range(1)] + [(i, [-1.0, 1e-5 * i]) for i in range(1, 500)]
    assert [v for _, v, _ in found(spark, far)[0]] == [i for _, i in brute(far)[0]]


def test_vectors_of_other_lengths_never_meet(spark):
    rows = [(i, [1.0, float(i)]) for i in range(20)] + [(100 + i, [1.0, 2.0, float(i)]) for i in range(15)] + [(200, [1e30, 1e30]), (300, [1e-30, 1e-30])]
    got = found(spark, rows)
    want = {q: [i for _, i in w] for q, w in ((q, [(s, i) for s, i in brute([r for r in rows if len(r[1]) == d]).get(q, [])]) for q, d in ((0, 2), (100, 3), (200, 2), (300, 2)))}
    assert {q: [v for _, v, _ in f] for q, f in got.items()} == want


def test_vector_edges(spark):
    e = [1.0, 0.0, 0.0]
    rows = [(0, e), (1, e), (2, e), (3, [0.0, 1.0, 0.0]), (4, None), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [float("nan"), 1.0, 0.0]), (8, [float("inf"), 1.0, 0.0]), (9, []), (100, [1.0, -0.0, 0.0]), (None, e), (200, None)]
    out = ann.search(spark.createDataFrame([(*r, 1) for r in rows], VECTORS).withColumnRenamed("label", "score")).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in out} == {(0, 1, 1), (0, 2, 2), (0, 3, 100), (0, 4, 3), (100, 1, 0), (100, 2, 1), (100, 3, 2), (100, 4, 3)}
    assert ann.search(spark.createDataFrame([], VECTORS)).count() == 0


def test_many_equal_vectors_cost_no_pairs(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), 1.0], 0) for i in range(1, 1501)]
    out = collections.defaultdict(list)
    for r in ann.search(spark.createDataFrame(rows, VECTORS)).collect():
        out[r.query_id].append((r.rank, r.vec_id))
    assert [v for _, v in sorted(out[100])] == [1, 2, 4, 5, 7, 8, 10, 11, 13, 14]


def test_pseudo_rotations_keep_lengths():
    x = np.random.default_rng(2).standard_normal((5, 64))
    assert np.allclose(np.linalg.norm(ann._hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    for bits, axes in ((1, [1]), (7, [64]), (12, [64, 16]), (15, [64, 64, 1])):
        h = ann.CrossPolytope(64, 4, bits)
        assert h.axes == axes and h.keys(x).max() < 2**bits
        assert (h.probes(x, 3, 9)[:, 0] == h.keys(x)[3]).all()


# URLs.

URLS = [None, "", "no scheme", "http://Example.COM/en/7?x", "https://a.example.com/en/8", "http://example.net/de/8#t", "http://x.net/de/9", "http://com/en/", "http://notcom/en/", "http://a.org", "ftp://b.org/es/q?://", "http://b.org?/es/", "x://y://z.com/en/", "http://a..com/en/1", "http://.com/en/1", "http://ex.com:80/en/", "http://EXAMPLE.com/EN/7", "http://example.com/en/7" + "z" * 5000]


def test_urls_against_sql(spark):
    df = spark.createDataFrame([(i, u, "<p>") for i, u in enumerate([*URLS, URLS[3]])], "page_id long, url string, rule string")
    got = sorted(map(tuple, uf.judge(df).collect()), key=str)
    c = duckdb.connect()
    c.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    c.executemany("INSERT INTO pages VALUES (?, ?)", [(i, u) for i, u in enumerate([*URLS, URLS[3]])])
    assert got == sorted(c.execute(uf.OP10_SQL).fetchall(), key=str)
    by = {r[0]: r for r in got}
    assert by[3][1:] == ("example.com", "/en/7", "example.com/en/7", "allow") and by[4][3:] == ("com/en/", "block") and by[0][1:] == ("", "", None, "allow")
    assert uf.judge(df.limit(0)).count() == 0


def test_a_collision_takes_another_salt(spark, monkeypatch):
    real = uf.key_hash
    monkeypatch.setattr(uf, "key_hash", lambda key, salt: F.lit(7).cast("long") if salt < 2 else real(key, salt))
    universe = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    salt, levels = uf.salted(universe, {"x": universe.where("key = 'a'")})
    assert salt == 2
    h = {r.key: r.h for r in universe.select("key", real("key", 2).alias("h")).collect()}
    assert uf.member(levels["x"], np.array([h["a"], h["b"], h["c"]])).tolist() == [True, False, False]


@pytest.mark.parametrize("driver_keys", [100_000, 5])
def test_cascade_is_exact_over_its_universe(spark, monkeypatch, driver_keys):
    monkeypatch.setattr(uf, "FIRST_RATE", 0.3)
    monkeypatch.setattr(uf, "DRIVER_KEYS", driver_keys)
    universe = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key LIKE '%7%'")
    levels = uf.cascade(universe, listed)
    assert len(levels) > 2
    rows = universe.select("key", uf.key_hash("key", 0).alias("h")).collect()
    assert uf.member(levels, np.array([r.h for r in rows])).tolist() == ["7" in r.key for r in rows]
