import random
import re

from pyspark.sql import functions as F

from pixelframe.llm import lines
from pixelframe.llm.lines import dedup, without_repeated_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """rows: (doc_id, text) of different doc_ids; removed line numbers by doc_id."""
    earlier, out = [], {}
    for i, text in sorted(((i, t) for i, t in rows if t is not None), key=lambda r: (r[0] is None, r[0])):
        out[i] = []
        for k, line in enumerate(text.split("\n")):
            s = frozenset(WORD.findall(line))
            if not s:
                continue
            if any(len(s & e) >= 0.8 * len(s | e) - 1e-9 for e in earlier):
                out[i].append(k)
            earlier.append(s)
    return out


def check(df, rows, **options):
    want, texts = brute(rows), dict(rows)
    got = {r.doc_id: r for r in dedup(df, **options).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        if text is None:
            assert got[i].text is None and got[i].n_lines == 0
        else:
            assert got[i].removed == ",".join(map(str, want[i])), i
            assert got[i].text == "\n".join(x for k, x in enumerate(text.split("\n")) if k not in want[i])


def test_against_brute_force(spark):
    rng, rows = random.Random(5), []
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 2, 4, 5, 6, 9, 10, 20, 45]))] for _ in range(60)]
    for i in range(50):
        lines = []
        for _ in range(rng.randint(0, 9)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
            lines.append(rng.choice([" ", " ", "  ", "\t"]).join(w))
        rows.append((i, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "\n\n  \n"), (None, rows[0][1]), (53, "a b c d e " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(df, rows)
    check(df, rows, broadcast_rows=0, crowd=2)


def test_frequent_words(spark):
    """Lines of frequent words only: keys are pairs of words, long lines have single words, and
    many that fit are not similar."""
    rng, words = random.Random(8), [f"w{i}" for i in range(70)]
    base = [rng.sample(words, n) for n in (5, 6, 9, 12, 15, 16, 20, 30, 40) for _ in range(5)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(8):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                w[rng.randrange(len(w))] = rng.choice(words)
            text.append(" ".join(w))
        rows.append((i, "\n".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for options in ({"crowd": 1, "long": 16}, {"crowd": 8, "long": 16}):
        check(df, rows, **options)


def test_classes_under_a_key_do_not_grow_with_the_table(spark):
    """Lines that share a frequent word and little else: no key has many of them, and each has a key."""
    rng, crowd, n = random.Random(3), 16, 2000
    rows = [(i, " ".join(f"f{k}" for k in rng.sample(range(300), 12))) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    indexed = lines.index_lines(df, lines.word_levels(df)).withColumn("o", F.col("doc_id")).cache()
    alone, often = lines._keys(indexed, crowd, 256)
    sizes = alone.union(often).groupBy("word").agg(F.count("*").alias("c"))
    assert alone.union(often).select("o").distinct().count() == n
    words = indexed.select(F.explode("prefix").alias("word")).groupBy("word").agg(F.count("*").alias("c"))
    assert words.agg(F.max("c")).first()[0] > crowd >= sizes.agg(F.max("c")).first()[0]


def test_corpus_rows(docs, corpus):
    seen = {}
    for i, text, *_ in corpus:
        if i is not None:
            seen[i] = text
    check(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), list(seen.items()))
    assert dedup(docs).count() == len(corpus)


def test_equal_rows_and_columns(spark, docs, no_docs):
    df = spark.createDataFrame([(1, "a b c d e\nq"), (1, "a b c d e\nq"), (2, "a b c d e\nr")], "doc_id long, text string")
    assert sorted((r.doc_id, r.removed) for r in dedup(df).collect()) == [(1, ""), (1, ""), (2, "0")]
    wide = docs.withColumn("removed", F.lit("x")).withColumn("line_no", F.lit(1)).withColumn("k1", F.lit(2))
    out = without_repeated_lines(wide)
    assert out.columns == wide.columns and out.count() == wide.count()
    assert out.where("n_chars <> length(text)").count() == 0
    assert dedup(no_docs).count() == 0


def test_native(spark, monkeypatch):
    plans, write = [], lines.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(lines, "stored", noted)
    line = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, line), (2, line + " eleven"), (3, "other words only here")], "doc_id long, text string")
    out = dedup(df)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 1, 3: 0}
    assert len(plans) > 5 and not any("Python" in p or "Arrow" in p or "CartesianProduct" in p for p in plans)


def test_pairs_of_alike_lines_grow_with_the_lines(spark, monkeypatch):
    """Many near copies under few keys: the pairs compared grow with the lines, not with their square,
    and the result is that of all pairs."""
    made, write = [], lines.stored

    def noted(df, name):
        out = write(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(lines, "stored", noted)
    rng = random.Random(4)
    base = [f"b{i}" for i in range(40)]

    def near(n):
        rows = []
        for i in range(n):
            w = list(base)
            w[rng.randrange(40)] = f"x{rng.randrange(50)}"
            w[rng.randrange(40)] = f"x{rng.randrange(50)}"
            rows.append((i, " ".join(w)))
        return rows

    compared = []
    for n in (150, 600):
        rows, made[:] = near(n), []
        check(spark.createDataFrame(rows, "doc_id long, text string"), rows, crowd=100_000, busy=8)
        compared.append(sum(made))
    assert compared[1] < 8 * compared[0] and compared[1] < 600 * 599 / 2 / 8


def test_open_classes_meet_all(spark):
    """A class similar to none of those beside it under its keys still finds the similar one among all."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(20)]
    rows = []
    for i in range(300):  # pairs of lines that share a third of the words with all others
        own = [f"y{i % 150}_{k}" for k in range(14)]
        rows.append((i, " ".join(base[:7] + own + ([] if i < 150 else ["z"]))))
    rng.shuffle(rows)
    rows = [(i, text) for i, (_, text) in enumerate(rows)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, crowd=100_000, busy=1)
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows, crowd=2, busy=1)
