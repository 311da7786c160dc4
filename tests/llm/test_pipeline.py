import collections
import os
import re
import struct
import zlib

import pytest

import corpus_pipeline as cp
from landgauge.llm import packing as pk
from landgauge.llm.common import materialize, table
from test_near_copies import kept_by_brute_force

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_stages_take_effect(spark):
    docs = table(spark, DATA, "documents")
    seen = [docs]
    for name, stage in cp.STAGES:
        seen.append(materialize(stage(spark, seen[-1], DATA)))
    raw, good, unlike, clean, mixed, packed = ({r.doc_id: r for r in d.collect()} for d in seen)
    assert all(d.columns == docs.columns for d in seen[:-1])
    bad = {r.doc_id for r in table(spark, DATA, "labels").where("quality = 0").collect()}
    fine = {r.doc_id for r in table(spark, DATA, "labels").where("quality = 1").collect()}
    assert len(bad & set(good)) <= 0.1 * len(bad) and len(fine & set(good)) >= 0.97 * len(fine)
    # One document of each class by all pairs stays: the smallest id.
    assert sorted(map(str, unlike)) == kept_by_brute_force([(i, r.text) for i, r in good.items()]) and len(unlike) < len(good)
    assert set(clean) == set(unlike) and not any(re.search(r'(?i)token = "[0-9a-f]{40}"', r.text) for r in clean.values())
    assert all(clean[i].text == unlike[i].text or "[SECRET]" in clean[i].text for i in clean)
    rows = seen[4].collect()
    assert set(mixed) <= set(clean) and max(sum(r.doc_id == i for r in rows) for i in mixed) <= 2
    e = pk.encoder()
    assert seen[5].agg({"length": "sum"}).first()[0] == sum(len(e.ids(r.text)) + 1 for r in rows) and set(packed) == set(mixed)


def test_run_is_the_stages_together(spark):
    docs = table(spark, DATA, "documents")
    for _, stage in cp.STAGES[:-1]:
        docs = materialize(stage(spark, docs, DATA))
    out = cp.run(spark, DATA)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    # Pieces of each text, by the library itself.
    library, want = pk.encoder().library, collections.Counter()
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[r.doc_id, k, a, z - a, zlib.crc32(struct.pack(f"<{z - a}I", *ids[a:z]))] += 1
    rows = out.collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, h1 string, __u int, label string"


def test_stages_take_odd_rows(spark):
    long = "several plain words that make a rather long text of no great interest " * 3000
    odd = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words without an id stand here today", "en", "s", 41), (None, None, None, None, None), (3, long, "en", "s", len(long)), (3, long, "en", "s", len(long)), (3, "other words under the same id as before", "en", "t", 39), (4, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" stands in here somewhere', "en", "t", 70)]
    docs = spark.createDataFrame([(*r, 0.5, "x", 7, "l") for r in odd], SCHEMA)
    kept = {name: sorted(map(str, (tuple(r) for r in stage(spark, docs, DATA).collect()))) for name, stage in cp.STAGES}
    # Null and empty texts are copies of each other, repeated rows of one another.
    assert len(kept["near_duplicates"]) == 5 and len(kept["secrets"]) == len(odd) and "[SECRET]" in "".join(kept["secrets"])
    assert not any("None, None" in r for r in kept["mixing"]) and len(kept["packing"]) >= len(odd)
    for name, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), DATA).count() == 0
        if name != "packing":
            assert stage(spark, docs, DATA).columns == docs.columns
