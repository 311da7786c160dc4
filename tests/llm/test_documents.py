import collections
import hashlib
import math
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from landgauge.llm import fingerprints as fp
from landgauge.llm import mixing as mx
from landgauge.llm import quality as ql
from landgauge.llm import secret_scan as ss
from landgauge.llm import simhash as sh

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) + r.choice(["", "", "", ".\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs():
    r = random.Random(2)
    base = [prose(r, r.choice([3, 40, 150, 600])) for _ in range(60)]
    near = [b.replace("a", "b", 1) for b in base[:20]]
    return [(i * 7, t, f"s{i % 4}") for i, t in enumerate([*base, *near, *base[:10], "", "   \n", "Word", "x" * 20_000])]


# Fingerprints.


def signed(x):
    return x - 2**64 if x >> 63 else x


def long_hash(x, then=None, seed=42):
    """XXH64 of a long, then of an int, a long or a text, each with the hash before as its seed."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
    if then is None:
        return h
    return xxhash.xxh64_intdigest(then, h)


def paragraphs(text):
    """The paragraphs of a text with their number among equal ones."""
    ends = r"[.!?…。！？]"
    parts, at = [], 0
    while at < len(text):
        line = re.match(r"[^\n]*", text[at:]).group()
        if re.search(ends, text[at + fp.LEAST : at + min(len(line), fp.MOST + 1)]):
            first = fp.LEAST + re.search(ends, text[at + fp.LEAST : at + len(line)]).start()
            cut = first + re.match(rf"{ends}+[ \t]*\n*", text[at + first :]).end()
        elif len(line) <= fp.MOST:
            cut = len(line) + re.match(r"\n*", text[at + len(line) :]).end()
        else:
            cut = fp.MOST
        parts.append(text[at : at + cut])
        at += cut
    seen = collections.Counter()
    out = set()
    for p in parts:
        seen[p] += 1
        out.add((p, seen[p]))
    return out


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def place(i, digest, m):
    return i, long_hash(digest, struct.pack("<i", i)) & (m - 1)


def check(digest):
    return long_hash(digest, b"check") & 0xFFFFFFFF


def read_back(fingerprint):
    """The digests that a fingerprint tells, by peeling."""
    n, m, body = fingerprint.split(":")
    n, m = int(n), int(m)
    cells = {}
    for at in range(0, len(body), 36):
        p, c, k, q = (int(x, 16) for x in re.fullmatch("(.{8})(.{4})(.{16})(.{8})", body[at : at + 36]).groups())
        cells[p >> 28, p & 0xFFFFFFF] = [c, k, q]
    found, work = set(), list(cells)
    while work:
        here = cells[work.pop()]
        if here[0] == 1 and check(signed(here[1])) == here[2]:
            k, q = here[1:]
            found.add(k)
            for i in range(3):
                cell = cells[place(i, signed(k), m)]
                cell[0] -= 1
                cell[1] ^= k
                cell[2] ^= q
                work.append(place(i, signed(k), m))
    assert len(found) == n and not any(any(c) for c in cells.values())
    return found


@pytest.mark.parametrize("group_rows", [512, 5])
def test_fingerprints_by_brute_force(spark, docs, monkeypatch, group_rows):
    monkeypatch.setattr(fp, "GROUP_ROWS", group_rows)
    got = {r.doc_id: r for r in fp.fingerprinted(table(spark, docs)).collect()}
    order = sorted(docs, reverse=True)
    assert len(got) == len(docs)
    for k, (i, text, _) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(alike(paragraphs(text), paragraphs(edited)), abs=1e-12)
        assert r.near_next == pytest.approx(alike(paragraphs(text), paragraphs(after)), abs=1e-12)
        # What the returned strings tell is the same.
        own = read_back(r.fingerprint)
        assert r.near_edited == pytest.approx(alike(own, read_back(r.edited_fingerprint)), abs=1e-12)
        assert r.near_next == pytest.approx(alike(own, read_back(got[order[(k + 1) % len(order)][0]].fingerprint)), abs=1e-12)
    same = collections.defaultdict(set)
    for i, text, _ in docs:
        same[text].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in same.values()) and len({got[i].fingerprint for i, t, _ in docs}) == len({frozenset(paragraphs(t)) for _, t, _ in docs})


def test_paragraphs_leave_nothing_out(spark):
    texts = ["", "\n", "a\n\nb", "x" * 1300, ("Word word word. " * 20) + "\n" + "tail", "é中。" * 300, "a. b! c?\n" * 30, "😀" * 700, "no end\r\n \t", "y" * 64 + ".", "z" * 64, "q" * 63 + "\n.\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    pattern = fp.PARAGRAPH.replace("\\", "\\\\")
    for r in rows.selectExpr("i", f"regexp_extract_all(t, '{pattern}', 0) AS p").collect():
        assert "".join(r.p) == texts[r.i] and all(r.p)
        seen = collections.Counter()
        assert {(p, seen.update([p]) or seen[p]) for p in r.p} == paragraphs(texts[r.i])


def test_peeling_recovers_all_or_leaves_cells(spark):
    for n, m, clear in ((0, 8, True), (6, 16, True), (50, 64, True), (60, 16, False)):
        rows = spark.range(n).selectExpr("7L AS uid", "xxhash64(id) AS d", f"array(named_struct('sketch', 'a', 'm', {m}L, 'n', 1L)) AS into")
        left = fp.peeled(fp.inserted(rows)).collect()
        assert (not [r for r in left if r.cell >= 0]) == clear
        if clear:
            assert sum(r.n for r in left) == n


def test_sketches_that_do_not_peel_are_made_anew(spark, docs, monkeypatch):
    want = {r.doc_id: (r.near_edited, r.near_next) for r in fp.fingerprinted(table(spark, docs[::3])).collect()}
    monkeypatch.setattr(fp, "LOAD", 0.2)
    monkeypatch.setattr(fp, "FLOOR", 1)
    got = fp.fingerprinted(table(spark, docs[::3])).collect()
    assert {r.doc_id: (r.near_edited, r.near_next) for r in got} == want
    sizes = [tuple(map(int, r.fingerprint.split(":")[:2])) for r in got]
    assert any(m > 2 ** math.ceil(math.log2(0.2 * n + 1)) for n, m in sizes)
    for r in got:
        read_back(r.fingerprint), read_back(r.edited_fingerprint)


def test_fingerprint_edges(spark):
    rows = [(None, "a\nb", "s"), (None, None, "s"), (5, None, "s"), (5, "a\nb", None), (5, "a\nb", None), (-9, "", "s"), (2**63 - 1, "c", "s"), (-(2**63), "c", "s")]
    df = table(spark, rows).withColumnRenamed("lang", "near_next").withColumnRenamed("source", "grp")
    out = fp.fingerprinted(df).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _, _ in rows)
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in out)
    one = fp.fingerprinted(table(spark, [(1, "abc", "s")])).first()
    assert (one.near_next, one.edited_sha256) == (1.0, hashlib.sha256(b"aba").hexdigest())
    assert fp.fingerprinted(df.limit(0)).count() == 0
    prints = {r.doc_id: r.fingerprint for r in fp.fingerprinted(table(spark, [(1, "a\n", "s"), (2, "a", "s"), (3, "a\n\n", "s"), (4, "a\na\n", "s")])).collect()}
    assert len(set(prints.values())) == 4


def test_a_hot_id_is_dealt_over_groups(spark, monkeypatch):
    monkeypatch.setattr(fp, "GROUP_ROWS", 8)
    rows = [(5, f"text {i}", "s") for i in range(400)] + [(i, f"other {i}", "s") for i in range(100, 300)]
    df = table(spark, rows).select("doc_id", "text", F.xxhash64("text").alias("h"))
    sizes = {r.grp: r["count"] for r in fp._grouped(df).groupBy("grp").count().collect()}
    assert max(sizes.values()) < 60
    signed_hash = lambda t: signed(xxhash.xxh64_intdigest(t.encode(), 42))
    order = sorted(rows, key=lambda r: (-r[0], signed_hash(r[1])))
    got = {(r.doc_id, r.text): r.next_text for r in fp.with_next(table(spark, rows)).collect()}
    assert got == {(i, t): order[(k + 1) % len(order)][1] for k, (i, t, _) in enumerate(order)}


def test_fingerprints_stay_in_the_jvm(spark, docs):
    rows = fp._prepared(table(spark, docs)).selectExpr("*", "size(p_own) AS n_own", "size(p_edit) AS n_edit", "size(p_next) AS n_next", "0 AS twice_own", "0 AS twice_edit", "0 AS more")
    plan = "".join(d._jdf.queryExecution().toString() for d in (fp.with_next(table(spark, docs)), fp.attempt(rows, 1000), fp.written(rows), fp.fingerprinted(table(spark, docs))))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Mixing.


def test_targets():
    t = mx.targets({"a": 100, "b": 100, "c": 100, None: 100})
    assert list(t) != [] and sum(t.values()) == pytest.approx(600) and t["a"] == pytest.approx(200)
    t = mx.targets({"a": 1, "b": 1000, "c": 1000})
    assert t["a"] == 2 and t["b"] == pytest.approx((3001.5 - 2) / 3, rel=1e-2) and t["c"] == pytest.approx(2 * t["b"])
    assert mx.targets({"a": 0}) == {"a": 0}


def test_flight_keeps_the_totals():
    r = np.random.default_rng(1)
    p, size = np.full(300, 0.37), r.integers(1, 1000, 300)
    out = mx.flight(p, size, random.Random(1), False)
    assert ((out > 0) & (out < 1)).sum() <= 2 and out.sum() == pytest.approx(p.sum()) and out @ size == pytest.approx(p @ size)
    done = mx.flight(p, size, random.Random(1), True)
    assert set(done) == {0.0, 1.0} and abs(done @ size - p @ size) <= 2 * np.sort(size)[:3].sum()
    mean = sum(mx.flight(np.full(9, 0.4), np.arange(1, 10), random.Random(s), True) for s in range(800)) / 800
    assert np.abs(mean - 0.4).max() < 0.08
    for sizes in ([5, 5, 5, 5], [9, 1, 1, 1], [7, 7, 1, 1, 1], [1], [3, 2]):
        assert set(mx.flight(np.full(len(sizes), 0.5), np.array(sizes), random.Random(3), True)) <= {0.0, 1.0}


def targets_by_hand(rows):
    """Source sizes and targets, written down step by step."""
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        unit = (total - sum(fixed.values())) / sum(weight[s] for s in free) if free else 0
        over = {s: 2.0 * sizes[s] for s in free if unit * weight[s] > 2 * sizes[s]}
        if not over:
            return sizes, fixed | {s: unit * weight[s] for s in free}
        fixed |= over


@pytest.mark.parametrize("block", [512, 4])
def test_mix_meets_its_targets(spark, docs, monkeypatch, block):
    monkeypatch.setattr(mx, "BLOCK_ROWS", block)
    rows = [*docs, (None, "a b c", None), (9999, None, None), (9999, None, None)]
    df = table(spark, rows).withColumnRenamed("lang", "taken")
    out = mx.mix(df).collect()
    assert sorted(map(str, (r.doc_id for r in out))) == sorted(str(i) for i, _, _ in rows)
    sizes, want = targets_by_hand(rows)
    taken = collections.Counter()
    for r in out:
        assert r.taken in (0, r.size, 2 * r.size) and r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
    for s, t in want.items():
        # Blocks of four rows leave little to balance with: a document at most.
        assert abs(taken[s] - t) <= (max(4, 0.05 * t) if block > 4 else max(r.size for r in out if r.source == s))
    assert sorted(map(str, mx.mix(df).collect())) == sorted(map(str, out))
    assert mx.mixed(df).count() == sum(r.taken // r.size for r in out if r.size) and mx.mixed(df).columns == df.columns
    assert mx.mix(df.limit(0)).count() == mx.mixed(df.limit(0)).count() == 0


def test_mixed_takes_each_source_as_the_mix_says(spark):
    r = random.Random(9)
    both = [(i, prose(r, r.randint(5, 40))) for i in range(300)]
    rows = [(i, t, s) for i, t in both for s in "bc"] + [(i, t, "b") for i, t in both[:50]] + [(1, "x y z", "a")] + [(7, "hot row", "d")] * 900
    df = table(spark, rows)
    want = collections.Counter()
    for x in mx.mix(df).collect():
        want[x.source] += x.taken
    got = collections.Counter()
    for x in mx.mixed(df).collect():
        got[x.source] += len(x.text.split())
    assert got == want


# Near-duplicates.


def reference_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def classes(prints, radius):
    """Smallest index reachable, over all pairs."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j in range(i):
                if (a ^ prints[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_simhash_by_brute_force(spark, docs):
    out = {r.doc_id: r for r in sh.near_duplicates(table(spark, docs)).collect()}
    prints = [reference_print(t) for _, t, _ in docs]
    assert [out[i].fp % 2**64 for i, _, _ in docs] == prints
    label = classes(prints, sh.RADIUS)
    least = collections.defaultdict(list)
    for (i, _, _), k in zip(docs, label, strict=True):
        least[k].append(i)
    assert [out[i].component_id for i, _, _ in docs] == [min(least[k]) for k in label]


@pytest.mark.parametrize("radius", [3, 4, 5])
def test_bit_sliced_comparison(radius):
    r = np.random.default_rng(radius)
    centres = r.integers(-(2**63), 2**63 - 1, 40)
    fps = np.array([c ^ np.bitwise_or.reduce([np.int64(1) << int(b) for b in r.integers(0, 63, r.integers(1, 9))]) for c in np.repeat(centres, 9)])
    group = np.sort(r.integers(0, 3, len(fps)))
    label = sh.linked(fps, group, radius)
    for g in range(3):
        at = np.flatnonzero(group == g)
        assert [at[k] for k in classes([int(x) % 2**64 for x in fps[at]], radius)] == label[at].tolist()


@pytest.mark.parametrize(("rows", "tables"), [(1000, 5), (10**7, 15), (10**9, 35)])
def test_any_two_in_the_radius_share_a_key(rows, tables):
    masks = sh._tables(rows, 4)
    assert len(masks) == tables
    r = random.Random(rows)
    for _ in range(300):
        flipped = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not flipped & m for m in masks)


def test_hot_buckets_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(sh, "CHUNK_ROWS", 8)
    r = random.Random(4)
    fps = sorted({r.getrandbits(3) | 1 << r.randrange(40, 60) | 1 << r.randrange(40, 60) for _ in range(300)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = {x.node: x.root for x in sh.components(sh.links(df, 2)).collect()}
    label = classes(fps, 2)
    groups, want = collections.defaultdict(set), collections.defaultdict(set)
    for i, f in enumerate(fps):
        groups[found.get(f, f)].add(f)
        want[label[i]].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicate_edges(spark):
    long = "some words that make a text of more than four words here"
    rows = [(3, long, "s"), (1, long, "s"), (None, long, "s"), (3, long, "s"), (7, None, "s"), (8, "", "s"), (None, "nameless one two three four", "s"), (None, "nameless one two three four", "s")]
    df = table(spark, rows).withColumnRenamed("lang", "fp")
    out = sorted(map(str, ((r.doc_id, r.component_id) for r in sh.near_duplicates(df).collect())))
    assert out == sorted(map(str, [(3, 1), (1, 1), (None, 1), (3, 1), (7, 7), (8, 7), (None, None), (None, None)]))
    assert sorted(map(str, (r.doc_id for r in sh.keep_first(df).collect()))) == ["1", "7", "None"]
    assert sh.near_duplicates(df.limit(0)).count() == sh.keep_first(df.limit(0)).count() == 0


# Quality.


def test_quality_learns_and_holds_out(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        good = r.random() < 0.7
        rows.append((i, prose(r, 60) if good else " ".join(w + "!!" for w in prose(r, 60).upper().split()), "s"))
        labels.append((i, int(good)))
    rows += [(1000, None, "s"), (1001, "", "s"), (None, "x", "s"), (1, "y", "s")]
    df = table(spark, rows).withColumnRenamed("lang", "score")
    lab = spark.createDataFrame([*labels, (5000, 1), (None, 1), (3, None)], "doc_id long, quality int")
    out = ql.quality(df, lab).collect()
    import zlib

    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 3 == 1) and x.predicted == int(x.score >= 0.5) and 0 <= x.score <= 1 for x in out)
    truth = dict(labels)
    held = [(x.predicted, truth[x.doc_id]) for x in out if x.held_out and x.doc_id in truth and x.doc_id != 1]
    assert sum(a == b for a, b in held) / len(held) > 0.97 and len(out) == len(rows)
    changed = lab.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(str, ql.quality(df, changed).collect())) == sorted(map(str, out))
    assert ql.quality(df, lab.limit(0)).count() == len(rows) and ql.quality(df.limit(0), lab).count() == 0


# Secrets.


def test_forest_on_findings_it_has_not_seen():
    x, y = ss.labelled_findings(ss.Dictionary(), 1200, seed=77)
    assert ((ss.judge().forest.score(x) >= 0.5) == y).mean() > 0.97


def test_secrets_are_found_and_masked(spark):
    token, key = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "AKIA" + "Q7RT2XWZ5LMN3PKD"
    rows = [(1, f'run token = "{token}" now', "s"), (2, f"commit {token} on main", "s"), (3, f"use {key} here", "s"), (4, "call 4785380592391139 or mail ab.19@mail5.example.com", "s"), (5, None, "s"), (6, "", "s"), (None, f"API_KEY={token}", "s"), (8, "word " * 20_000 + f"password: {token}", "s")]
    df = table(spark, rows).withColumnRenamed("lang", "kind")
    out = ss.scan(df).where("secret").collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "3", "8", "None"]
    texts = {i: t for i, t, _ in rows}
    for r in out:
        assert hashlib.sha256(texts[r.doc_id][r.start : r.start + r.length].encode()).hexdigest() == r.secret_sha256
    clean = {r.doc_id: r for r in ss.masked(df).collect()}
    assert clean[1].text == 'run token = "[SECRET]" now' and clean[1].n_chars == len(clean[1].text) and clean[2].text == rows[1][1] and clean[5].text is None
    assert ss.masked(df).columns == df.columns and ss.scan(df.limit(0)).count() == 0
