import collections
import random
import zlib

import numpy as np
import pytest
import sentencepiece
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from landgauge.llm import packing as pk
from landgauge.llm import token_counts as tc

BITS = ["a", "the", "▁", " ", "  ", "\n", "\n\n", "\t", "é", "日本", "</s>", "<s>", ".", "'s", "\x00", "foo", "😀", "ﬁ", "\r", "<unk>", "23", "\u3000", "<|endoftext|>", "½", "\x85", "\x1c", "\u2028", "—"]


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=20).map("".join) | st.text(max_size=40))
def test_counts_are_the_librarys(text):
    assert tc.counter().count(text) == len(tc.counter().library.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(BITS), max_size=20).map("".join) | st.text(max_size=40))
def test_ids_are_the_librarys(text):
    e = pk.encoder()
    assert e.ids(text).tolist() == e.library.encode(text, add_special_tokens=False).ids


def test_proven_strings_are_single_tokens():
    c = tc.counter()
    assert c.separable and len(c.spaced.proven) > 10_000 and len(c.at_line_start.proven) > 10_000
    for w in random.Random(1).sample(sorted(c.spaced.proven), 200):
        assert len(c.library.encode("\n" + w)) == 3


def test_a_full_memo_changes_nothing(monkeypatch):
    monkeypatch.setattr(tc, "MEMO_WORDS", 5)
    c = tc.PieceCounter(public_tokenizers.path(tc.VOCABULARY))
    text = " ".join(f"wörd{i}x" for i in range(100))
    assert c.count(text) == len(c.library.encode(text)) and len(c.after_space) <= 5 + len(c.after_space.proven)


def test_token_count_edges(spark):
    texts = [None, "", "x y", "word " * 5000, "z" * 30_000, "x y"]
    df = table(spark, texts, [0, 1, None, 3, 4, 4]).withColumnRenamed("lang", "n_tokens")
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tc.VOCABULARY))
    want = sorted(((i, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for i, t in zip([0, 1, None, 3, 4, 4], texts, strict=True)), key=str)
    assert sorted(map(tuple, tc.token_counts(df).collect()), key=str) == want
    assert tc.token_counts(df.limit(0)).count() == 0


def optimum(lengths, capacity):
    """Fewest bins, by trying every placement."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k, r in enumerate(rooms):
            if r >= lengths[i] and r not in rooms[:k]:
                place(i + 1, [*rooms[:k], r - lengths[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=8))
def test_bound_and_packing_enclose_the_optimum(lengths):
    bins, offsets, rooms = pk.best_fit_decreasing(np.array(lengths), 16)
    least = optimum(lengths, 16)
    assert pk.lower_bound(np.bincount(lengths, minlength=17), 16) <= least <= len(rooms)
    for b in set(bins.tolist()):
        own = sorted((o, n) for k, o, n in zip(bins, offsets, lengths, strict=True) if k == b)
        assert own[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(own, own[1:], strict=False)) and own[-1][0] + own[-1][1] + rooms[b] == 16


@pytest.mark.parametrize("part_rows", [8192, 20])
def test_packing_holds_every_token_once(spark, monkeypatch, part_rows):
    monkeypatch.setattr(pk, "PART_ROWS", part_rows)
    r = random.Random(3)
    texts = [" ".join(r.choice("alpha beta gamma delta".split()) for _ in range(r.choice([3, 50, 400, 900, 2500]))) for _ in range(120)] + [None, "", "same", "same"]
    ids = [*range(120), 120, None, 121, 121]
    out = pk.pack(table(spark, texts, ids).withColumnRenamed("lang", "piece"), capacity=1024).collect()
    library = pk.encoder().library
    want = collections.Counter()
    for i, t in zip(ids, texts, strict=True):
        tokens = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        n = len(tokens)
        cuts = [0, *range(n % 1024 or 1024, n + 1, 1024)] if n > 1024 else [0, n]
        want.update((i, k, a, z - a, zlib.crc32(np.array(tokens[a:z], "<u4").tobytes())) for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert collections.Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in out) == want
    bins = collections.defaultdict(list)
    for x in out:
        bins[x.sequence_id].append((x.offset, x.length))
    for own in bins.values():
        own.sort()
        assert own[0][0] == 0 and all(o + n == p for (o, n), (p, _) in zip(own, own[1:], strict=False)) and own[-1][0] + own[-1][1] <= 1024
    lengths = np.array([x.length for x in out])
    assert pk.lower_bound(np.bincount(lengths, minlength=1025)) <= len(bins) <= len(pk.best_fit_decreasing(lengths)[2]) + 3
    assert pk.pack(table(spark, texts).limit(0)).count() == 0
