import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from pixelframe.llm.components import connected_components
from pixelframe.llm.simhash import components, fingerprint, keep_one, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(items, linked):
    items, root = sorted(set(items)), {}
    for x in items:
        root[x] = x

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {x: find(x) for x in items}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("text", [None, "", " \t", "One", "one two", "a b c", "A b C d", "É é ß 漢 字", "x y z " * 30000])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == signed(fingerprint("a b c"))


@pytest.mark.parametrize("bucket", [1, 2, 16])
def test_components_of_planted_bits(spark, bucket):
    rng, fps = random.Random(2), [0, (1 << 64) - 1]
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 25])):
            fps.append(x)
            for b in rng.sample(range(64), rng.choice([1, 1, 2, 2, 3])):
                x ^= 1 << b
    center = rng.getrandbits(64)
    fps += [center ^ (1 << b) for b in range(40)] + [center ^ (3 << b) for b in range(0, 60, 7)]
    df = spark.createDataFrame([(signed(x),) for x in fps + fps[:9]], "fp long")
    got = {r.fp: r.root for r in components(df, bucket).collect()}
    want = roots(map(signed, fps), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    groups = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    assert groups(got) == groups(want)


def test_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (2001, 2000), (2000, 2001)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 200)} | {2001: 2000}
    assert got == want


def test_rows(docs, corpus, no_docs):
    fp = [(i, brute_fingerprint(t)) for i, t, *_ in corpus]
    root = roots([f for _, f in fp], lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for i, f in fp:
        if i is not None:
            low[root[f]] = min(i, low.get(root[f], i))
    want = sorted(((i, format(f, "016x"), low.get(root[f])) for i, f in fp), key=str)
    wide = docs.withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x"))
    assert sorted((tuple(r) for r in near_duplicates(wide).collect()), key=str) == want
    assert near_duplicates(no_docs).count() == 0
    kept = keep_one(wide)
    assert kept.columns == wide.columns
    assert kept.count() == len(set(root.values())) and keep_one(no_docs).count() == 0
    assert {r.doc_id for r in kept.collect()} == {low.get(r) for r in set(root.values())}
