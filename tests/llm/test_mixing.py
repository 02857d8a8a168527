import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pixelframe.llm import mixing
from pixelframe.llm.mixing import mix, mixed_rows, pivot

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(1, 2, 3), cap=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rate = (total - sum(fixed.values())) / sum(w[s] for s in free)
        over = [s for s in free if w[s] * rate > cap * sizes[s]]
        if not over:
            return {s: fixed.get(s, w[s] * rate) for s in names}
        fixed.update({s: cap * sizes[s] for s in over})


def brute_sizes(corpus):
    sizes = defaultdict(int)
    for _, text, _, source, _ in corpus:
        sizes[source] += len(WORD.findall(text or ""))
    return sizes


def test_targets_sizes_and_totals(docs, corpus):
    rows = mix(docs).collect()
    sizes = brute_sizes(corpus)
    want = targets(sizes)
    assert len(rows) == len(corpus)
    got = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        got[r.source] += r.taken
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        largest = max(len(WORD.findall(t or "")) for _, t, _, x, _ in corpus if x == s)
        assert abs(got[s] - want[s]) <= largest


def test_many_blocks_agree_with_targets_and_reruns(docs):
    key = ["doc_id", "copies"]
    a = sorted(map(str, mix(docs, docs_per_block=7, fan_in=2).select(*key).collect()))
    b = sorted(map(str, mix(docs, docs_per_block=7, fan_in=2).select(*key).collect()))
    assert a == b
    rows = mix(docs, docs_per_block=7, fan_in=2).groupBy("source").agg(
        F.sum("taken").alias("t"), F.first("target").alias("x"), F.max("size").alias("m")).collect()
    assert all(abs(r.t - r.x) <= r.m for r in rows)


def test_draws_do_not_depend_on_partitions(docs):
    found = set()
    for n in (1, 3, 9):
        rows = mix(docs.repartition(n), docs_per_block=7, fan_in=2).select("doc_id", "source", "size", "taken").collect()
        found.add(tuple(sorted(map(str, rows))))
        kept = mixed_rows(docs.repartition(n), docs_per_block=7, fan_in=2).drop("mix_copy")
        found.add(tuple(sorted(f"{r.doc_id} {r.source} {len(r.text)}" for r in kept.collect())))
    assert len(found) == 2


def test_many_sources_share_the_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCES_PER_NODE", 3)
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 25}", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    a = mix(docs, docs_per_block=20, fan_in=3)
    for r in a.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("x"), F.max("size").alias("m")).collect():
        assert abs(r.t - r.x) <= r.m
    assert a.count() == 300


def test_pivot_keeps_the_weighted_sum():
    for p, a, q, b, u in [(.3, 5, .4, 7, .1), (.3, 5, .4, 7, .9), (.9, 1, .9, 100, .5), (.5, 100, .1, 1, .2)]:
        x, y = pivot(p, a, q, b, u)
        assert a * x + b * y == pytest.approx(a * p + b * q)
        assert {x, y} & {0.0, 1.0} and 0 <= min(x, y) and max(x, y) <= 1


def test_pivot_is_unbiased():
    n = 20000
    assert sum(pivot(.3, 5, .4, 7, (i + .5) / n)[0] for i in range(n)) / n == pytest.approx(.3, abs=1e-3)


def test_rows_empty_and_extra_columns(docs, no_docs):
    assert mix(no_docs).count() == 0
    wide = docs.withColumn("size", F.lit("x")).withColumn("copies", F.lit(1)).withColumn("up", F.lit(2))
    assert mix(wide).count() == docs.count()
    out = mixed_rows(wide)
    assert out.columns == [*wide.columns, "mix_copy"]
    assert out.count() == mix(docs).agg(F.sum("copies")).first()[0]
