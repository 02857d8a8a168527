import hashlib
import random
import re

from pyspark.sql import functions as F

from pixelframe.llm.decontaminate import contamination, keep_clean

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            wins.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    lengths = {len(x) for x in wins}
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit.update(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def test_against_brute_force(spark):
    rng = random.Random(11)
    v = [f"w{i}" for i in range(30)] + ["É", "é", "ß", "日本"]
    items = [(i, " ".join(rng.choice(v) for _ in range(rng.choice([10, 11, 15, 30, 60])))) for i in range(12)]
    items += [(20, "Short ITEM one"), (21, "two"), (22, ""), (23, None), (None, "a b c d e f g h i j k"), (24, items[0][1]), (0, items[0][1]),
              (25, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"), (26, "six seven eight nine ten-eleven")]
    rows = []
    for i in range(80):
        t = [rng.choice(v) for _ in range(rng.choice([0, 3, 9, 10, 40, 200]))]
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(w) - 1))
            at = rng.randint(0, len(t))
            t[at:at] = w[a:a + rng.choice([5, 9, 10, 14, 60])]
        rows.append((i, rng.choice([" ", "--", " ,\n"]).join(t).upper() if i % 5 == 0 else " ".join(t)))
    rows += [(100, None), (101, ""), (102, "..."), (None, items[1][1]), (3, rows[3][1]), (103, "w1 " * 30000), (104, "short item ONE two")]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute(rows, items), key=key)
    for options in ({}, {"broadcast_rows": 0}):
        assert sorted((tuple(r) for r in contamination(d, b, **options).collect()), key=key) == want
    clean = keep_clean(d.withColumn("key", F.lit(1)).withColumn("start", F.lit(2)), b)
    assert clean.columns == ["doc_id", "text", "key", "start"]
    assert clean.count() == sum(not r[5] for r in want)


def test_empty(spark, docs, no_docs):
    b = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    assert contamination(no_docs, b).count() == 0
    assert contamination(docs, b.where("false")).where("contaminated or n_items > 0").count() == 0
    assert keep_clean(docs, b.where("false")).count() == docs.count()


def test_native(docs, spark):
    b = spark.createDataFrame([(1, "a b c d e f g h i j k l")], "item_id long, text string")
    plan = contamination(docs, b)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
