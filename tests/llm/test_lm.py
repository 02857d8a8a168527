import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pixelframe.llm.elias_fano import EliasFano, Trie, quantise, restore
from pixelframe.llm.lm import score


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1) | st.integers(0, 500), max_size=200), st.lists(st.integers(0, 600), max_size=50))
def test_sequence(values, others):
    v = np.array(sorted(values), np.uint64)
    e = EliasFano(v)
    assert (e.get(np.arange(len(v))) == v).all()
    q = np.concatenate([v, np.array(others, np.uint64)])
    for x, i in zip(q.tolist(), e.find(q).tolist()):
        assert (i >= 0) == (x in set(v.tolist())) and (i < 0 or int(v[i]) == x)


def test_trie():
    pairs = {(c, w): c * w + 1 for c in range(0, 90, 3) for w in range(c % 7, 60, 1 + c % 5)}
    rows = np.array(sorted(pairs))
    t = Trie(rows[:, 0].astype(np.uint64), rows[:, 1].astype(np.uint64), np.array([pairs[tuple(r)] for r in rows.tolist()]))
    q = np.array([(c, w) for c in range(95) for w in range(70)])
    got = restore(t.lookup(q[:, 0].astype(np.uint64), q[:, 1].astype(np.uint64)))
    assert all(abs(g - pairs.get((c, w), 0)) <= 1e-3 * g for g, (c, w) in zip(got, q.tolist()))
    assert Trie(np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, int)).lookup(rows[:, 0].astype(np.uint64), rows[:, 1].astype(np.uint64)).max() == 0


def test_codes():
    c = np.array([0, 1, 2, 4096, 4097, 10 ** 6, 10 ** 12])
    assert np.allclose(restore(quantise(c)), c, rtol=3e-4)


def brute(corpus, mu):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    rows = [(i, (t or "").encode().lower().split() + [None]) for i, t, *_ in corpus]
    one, two = Counter(), Counter()
    for i, t in rows:
        if not held(i):
            one.update(t)
            two.update(zip([None, *t[:-1]], t))
    n, v = sum(one.values()), len(one)
    out = []
    for i, t in rows:
        p = [(one[w] + 0.5) / (n + 0.5 * (v + 1)) for w in t]
        s = sum(math.log10((two[a, w] + mu * x) / (one[a] + mu)) for a, w, x in zip([None, *t[:-1]], t, p))
        out.append((i, held(i), len(t), sum(w in one for w in t), n, sum(map(math.log10, p)), s))
    return out


@pytest.mark.parametrize("sizes", [(3_000_000, 2_000_000), (500, 50)])
def test_scores(docs, corpus, sizes):
    wide = docs.withColumn("block", F.lit("x")).withColumn("score", F.lit(1))
    got = sorted((tuple(r) for r in score(wide, 200.0, *sizes).collect()), key=lambda r: str(r[:5]))
    want = sorted(brute(corpus, 200.0), key=lambda r: str(r[:5]))
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6], rel=1e-3)


def test_held_out_text_gains(docs):
    s = score(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert s[0] > s[1]


def test_empty(no_docs):
    assert score(no_docs).count() == 0
