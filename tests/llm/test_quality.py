import random

import pytest
from pyspark.sql import functions as F

from pixelframe.llm.quality import classify, site_rates


@pytest.fixture(scope="module")
def labelled(spark):
    rng, docs, labels = random.Random(9), [], []
    for i in range(600):
        words = ["".join(rng.choice("abdefgilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(60)]
        toxic, good = rng.random() < 0.2, rng.random() < 0.7
        if toxic:
            words[rng.randrange(60)] = rng.choice(["idiot", "Moron,", "scum"])
        if not good:
            words = [w + "###" for w in words]
        docs.append((i, " ".join(words), rng.choice(["en", "de"]), f"s{i % 4}"))
        if i % 2:
            labels.append((i, int(good), int(toxic)))
    truth = {i: (g, t) for i, g, t in labels}
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), \
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


def test_held_out_accuracy(spark, labelled):
    docs, labels, truth = labelled
    train, test = labels.where("doc_id % 3 <> 0"), {i: y for i, y in truth.items() if i % 3 == 0}
    rows = [r for r in classify(docs, train).collect() if r.doc_id in test]
    assert sum((r.p_quality >= .5) == bool(test[r.doc_id][0]) for r in rows) >= 0.97 * len(rows)
    assert sum((r.p_toxic >= .5) == bool(test[r.doc_id][1]) for r in rows) >= 0.95 * len(rows)


def test_rates_shrink(spark):
    docs = [(i, "t", "en", "big") for i in range(400)] + [(400 + i, "t", "en", f"h{i % 20}") for i in range(400)] + [(900, "t", None, None)]
    rows = [(i, int(i % 10 < 9), 0) for i in range(400)] + [(400 + i, int((i % 20) % 2), 0) for i in range(400)]
    rates, world = site_rates(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
                              spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    got = {r.source: r for r in rates.collect()}
    assert got[None].rate_quality == pytest.approx(world["quality"])  # no label: the prior
    assert abs(got["big"].rate_quality - 0.9) < 0.02  # many labels: their own rate
    for h, r in got.items():
        if h and h.startswith("h"):
            own = int(h[1:]) % 2
            assert min(own, world["quality"]) < r.rate_quality < max(own, world["quality"])


def test_odd_rows(docs, corpus, no_docs, spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(40)] + [(3, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    wide = docs.withColumn("kept", F.lit("x")).withColumn("rate_quality", F.lit(0)).withColumn("source_s", F.lit(1))
    rows = classify(wide, labels).collect()
    assert len(rows) == len(corpus)
    assert all(0 <= r.p_quality <= 1 and 0 <= r.p_toxic <= 1 and r.kept is not None for r in rows)
    assert classify(wide, labels, broadcast_rows=0).count() == len(corpus)
    assert classify(no_docs, labels).count() == 0
    none = classify(docs, labels.where("false")).collect()
    assert {(r.p_quality, r.p_toxic) for r in none} == {(0.5, 0.5)}
