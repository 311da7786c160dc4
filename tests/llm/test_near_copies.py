import collections
import random

import numpy as np

from landgauge.llm import near_copies as nc
from landgauge.llm import simhash as sh

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def words(r, n):
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 8))) for _ in range(n)]


def edited(r, text, n):
    out = list(text)
    for at in r.sample(range(len(out)), n):
        out[at] = "Q" + out[at]
    return out


def five(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept_by_brute_force(rows):
    """The smallest id of each class, from all pairs."""
    ids = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    sets = [five(t or "") for _, t in rows]
    label = list(range(len(rows)))
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if (not x and not y or 5 * len(x & y) >= 4 * len(x | y)) and label[a] != label[b]:
                label = [label[b] if v == label[a] else v for v in label]
    return sorted(str(next(rows[i][0] for i in ids if label[i] == c)) for c in set(label))


def test_near_copies_by_brute_force(spark):
    r = random.Random(8)
    rows = [words(r, 120) for _ in range(12)]
    # Copies on both sides of 0.8, and a large group of copies that share most shingles.
    rows += [edited(r, rows[i], n) for i in range(6) for n in (1, 2, 3, 4, 6)]
    rows += [edited(r, rows[11], r.randint(1, 3)) for _ in range(40)]
    # A common passage makes no near copies.
    rows += [rows[0][:60] + words(r, 90) for _ in range(20)]
    rows = [" ".join(t) for t in rows]
    rows += ["one two", "One  two\n", "one three", "", None, rows[3].upper()]
    docs = [(7 * i % 1009, t) for i, t in enumerate(rows)]
    got = sorted(str(x.doc_id) for x in sh.keep_first(table(spark, docs)).collect())
    assert got == kept_by_brute_force(docs)


def test_a_copy_many_bits_away_goes(spark):
    r = random.Random(1)
    for seed in range(200):
        r = random.Random(seed)
        a = words(r, 150)
        b = edited(r, a, 2)
        x, y = five(" ".join(a)), five(" ".join(b))
        if (sh.fingerprint(" ".join(a)) ^ sh.fingerprint(" ".join(b))) % 2**64 and ((sh.fingerprint(" ".join(a)) ^ sh.fingerprint(" ".join(b))) % 2**64).bit_count() > 4 and len(x & y) >= 0.8 * len(x | y):
            break
    else:
        raise AssertionError("no such pair")
    assert [x.doc_id for x in sh.keep_first(table(spark, [(9, " ".join(a)), (4, " ".join(b))])).collect()] == [4]


def test_runs_are_never_parted():
    import pyarrow as pa

    s = np.sort(np.random.default_rng(3).integers(0, 9, 500))
    batches = [pa.RecordBatch.from_arrays([pa.array(s[a : a + 7]), pa.array(np.arange(a, min(500, a + 7)))], ["s", "u"]) for a in range(0, 500, 7)]
    parts = list(nc._runs(iter(batches)))
    assert np.array_equal(np.concatenate(parts)[:, 1], np.arange(500))
    assert all(p[-1, 0] < q[0, 0] for p, q in zip(parts, parts[1:], strict=False))
    assert collections.Counter(np.concatenate(parts)[:, 0]) == collections.Counter(s)


def test_unlike_texts_that_share_an_id_stay(spark):
    r = random.Random(5)
    a, b, c = (words(r, 80) for _ in range(3))
    rows = [(5, a), (5, b), (3, edited(r, b, 1)), (5, c), (5, a)]
    out = sh.keep_first(table(spark, [(i, " ".join(t)) for i, t in rows])).collect()
    assert sorted((x.doc_id, x.text) for x in out) == sorted((i, " ".join(t)) for i, t in (rows[0], rows[2], rows[3]))


def test_one_of_each_class_without_ids_stays(spark):
    r = random.Random(6)
    a, b = words(r, 150), words(r, 150)
    rows = [(None, a), (None, edited(r, a, 1)), (None, edited(r, a, 2)), (None, b), (2, edited(r, b, 1))]
    out = sh.keep_first(table(spark, [(i, " ".join(t)) for i, t in rows])).collect()
    assert sorted(str(x.doc_id) for x in out) == ["2", "None"]


def test_wide_fingerprints_are_compared_bit_sliced():
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**63), 2**63, (40, nc.LONGS))
    fps = np.concatenate([base] * 4)
    for row in fps[40:]:  # up to 130 bits away
        for bit in rng.choice(256, rng.integers(0, 131), replace=False):
            row[bit // 64] ^= np.int64(np.uint64(1) << np.uint64(bit % 64))
    group = np.sort(np.r_[rng.integers(0, 3, 130), rng.integers(3, 12, 30)])
    fps = fps[rng.permutation(len(fps))]
    for radius in (nc.FAR, 63, 0, 255):
        far = np.bitwise_count((fps[:, None] ^ fps[None]).view(np.uint64)).sum(axis=2, dtype=int)
        want = np.arange(len(fps))
        for i in range(len(fps)):
            for j in range(i):
                if group[i] == group[j] and far[i, j] <= radius and want[i] != want[j]:
                    want[want == max(want[i], want[j])] = min(want[i], want[j])
        assert np.array_equal(sh.linked(fps, group, radius), want)


def test_alike_sets_have_near_fingerprints():
    r = np.random.default_rng(9)
    for n in (4, 5, 9, 12, 100, 800):
        for _ in range(100):
            common, apart = r.integers(0, 2**64, n, np.uint64), r.integers(0, 2**64, n // 4, np.uint64)
            cut = r.integers(0, len(apart) + 1)
            a, b = (nc.simhash(np.r_[common, x]) for x in (apart[:cut], apart[cut:]))
            assert np.bitwise_count((a ^ b).view(np.uint64)).sum() <= nc.FAR
    bits = [np.unpackbits(nc.simhash(r.integers(0, 2**64, 300, np.uint64)).view(np.uint8)) for _ in range(200)]
    assert abs(np.corrcoef(np.array(bits).T)[~np.eye(256, dtype=bool)]).max() < 0.5


def test_classes_by_brute_force():
    r = random.Random(2)
    rows = [words(r, 40) for _ in range(6)]
    rows = [" ".join(t) for t in rows for t in (t, *(edited(r, t, n) for n in (1, 1, 1, 2, 3)))]
    want = list(range(len(rows)))
    for k in range(len(rows)):
        for i in range(k):
            x, y = five(rows[i]), five(rows[k])
            if 5 * len(x & y) >= 4 * len(x | y) and want[i] != want[k]:
                want = [min(want[i], want[k]) if v == max(want[i], want[k]) else v for v in want]
    assert list(nc.classes([nc.shingles(t) for t in rows])) == want and len(set(want)) > 6


def test_groups_make_rows_not_pairs(spark, monkeypatch):
    """Near copies and related texts: no step lists their pairs, whole or in chunks."""
    r = random.Random(12)
    a, b = words(r, 100), words(r, 100)
    texts = [edited(r, a, 1) for _ in range(50)] + [b[:60] + words(r, 25) for _ in range(50)]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    made, found = [], []
    # Edges between texts, by the first step (bit-sliced comparison) and by the exact one.
    monkeypatch.setattr(nc, "components", lambda edges: made.append(edges.count()) or sh.components(edges))
    real = nc.compared
    monkeypatch.setattr(nc, "compared", lambda *a: found.append(a[3]) or real(*a))
    want = kept_by_brute_force(docs)
    for most in (nc.CHUNK_ROWS, 30):
        monkeypatch.setattr(nc, "CHUNK_ROWS", most)
        assert sorted(str(x.doc_id) for x in sh.keep_first(table(spark, docs)).collect()) == want
    assert found == [nc.FAR] * 2 and max(made[:2]) <= 2 * len(docs) and made[2] <= 10 * len(docs) and made[3] <= 10 * len(docs)
