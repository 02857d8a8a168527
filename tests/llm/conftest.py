import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
FUNCTION = "the of and to in a is that it for on was as with are be by this".split()


def prose(rng, n):
    """Sentences of made-up words among function words, a few lines long."""
    out = []
    for i in range(n):
        w = rng.choice(FUNCTION) if rng.random() < 0.5 else "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9)))
        out.append(w + ("." if rng.random() < 0.08 else ""))
    text = ""
    for i, w in enumerate(out):
        text += w + ("\n" if w.endswith(".") and rng.random() < 0.4 else " ")
    return text.strip()


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, null in any column, empty and long texts, equal rows."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows.append([i, prose(rng, rng.choice([5, 40, 80, 160, 300])), rng.choice(["en", "en", "de", None]),
                     rng.choice(["a", "a", "a", "b", "c", None]), 0])
    for i in range(60, 70):
        rows.append([i, rows[i - 50][1], "en", "a", 0])  # copies
    for i in range(70, 90):  # near copies: one word other
        w = rows[i - 60][1].split(" ")
        w[len(w) // 2] = "changed"
        rows.append([i, " ".join(w), "en", "b", 0])
    rows += [[90, None, "en", "a", None], [91, "", "en", "a", 0], [92, " \n\t \n", "en", None, 4], [93, "one", None, "c", 3],
             [None, rows[0][1], "en", "a", 0], [None, None, None, None, None], [94, "x y z " * 4000, "en", "a", 0],
             [95, prose(rng, 20000), "en", "b", 0], [96, "Ünïcode ÀÉ wörds 漢字 テスト here\nÜnïcode ÀÉ wörds 漢字 テスト here", "fr", "é", 0]]
    rows += [rows[3], rows[3], [97, "tab\tand  double  spaces here now\nand  double  tab\tspaces here now", "en", "b", 0]]
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOC_SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
