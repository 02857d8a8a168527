import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pixelframe.llm import rules
from pixelframe.llm.rules import base_counts, js_distance, judge, keep_good

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    three, covered = Counter(zip(w, w[1:], w[2:])), set()
    for k in range(len(w) - 2):
        if three[tuple(w[k:k + 3])] > 1:
            covered.update((k, k + 1, k + 2))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\x1c\xa0é漢", max_size=60))
def test_base_counts(text):
    assert base_counts(text)[:5] == brute(text)


def test_distance():
    p = np.array([1.0, 2, 3])
    assert js_distance(p, 2 * p) == pytest.approx(0)
    assert js_distance(np.array([1.0, 0]), np.array([0, 5.0])) == pytest.approx(1)
    assert js_distance(np.zeros(3), p) == 0


def test_rows(docs, corpus):
    got = sorted((tuple(r) for r in judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()), key=str)
    want = []
    for i, text, *_ in corpus:
        b = brute(text)
        want.append((i, *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert got == sorted(want, key=str)


def test_junk_goes_and_prose_stays(spark, docs):
    good = docs.where("doc_id < 60").select("doc_id", "text", "lang")
    n = F.size(F.split("text", r"\s+"))
    shout = good.where(n >= 80).select((F.col("doc_id") + 1000).alias("doc_id"), F.upper("text").alias("text"), "lang")
    bars = good.where(n >= 80).select((F.col("doc_id") + 2000).alias("doc_id"), F.regexp_replace("text", " ", " | ").alias("text"), "lang")
    rows = judge(good.union(good.select(F.col("doc_id") + 100, "text", "lang")).union(shout.limit(4)).union(bars.limit(4))).where(
        "not base_failed").collect()
    assert all(not r.kept for r in rows if r.doc_id >= 1000)
    assert all(r.kept for r in rows if r.doc_id < 1000)


def test_filter_equals_judge(docs, no_docs):
    wide = docs.withColumn("kept", F.lit("x")).withColumn("chars", F.lit(1))
    out = keep_good(wide)
    assert out.columns == wide.columns
    assert out.count() == judge(docs).where("kept").count()
    assert judge(no_docs).count() == 0 and keep_good(no_docs).count() == 0


def test_fifth_language_stays(spark, docs):
    rng = np.random.default_rng(2)
    common = "och att det som en för inte till har jag".split()

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(list("abdefgiklmnorstuvå"), rng.integers(3, 9)))
                        for _ in range(n))

    rows = [(5000 + i, text(n), lang) for i, n in enumerate([200, 400, 800, 1600] * 4) for lang in ("sv",)]
    rows += [(6000, text(1600).upper(), "sv"), (6001, text(1600).replace(" ", " | "), "sv"), (6002, text(1600), None)]
    both = docs.where("doc_id < 60").select("doc_id", "text", "lang").union(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    kept = {r.doc_id for r in judge(both).where("kept").collect()}
    assert {5000 + i for i in range(16)} | {6002} <= kept
    assert not {6000, 6001} & kept
    assert kept == {r.doc_id for r in keep_good(both).collect()}


def shares(text, words):
    """Character-class and common-word shares, counted one by one."""
    classes, known = [0] * 7, list(dict.fromkeys(w for ws in rules.COMMON_WORDS.values() for w in ws))
    for ch in text:
        kind = (6 if ord(ch) >= 0x2FFF else 0 if ch.islower() or ch.isalpha() and not ch.isupper() else 1 if ch.isupper()
                else 2 if ch.isdigit() else 3 if ch.isspace() else 4 if ch in ".,;:!?'\"-()" else 5 if ord(ch) < 128 else 6)
        classes[kind] += 1
    bare = Counter(w.strip(".,;:!?'\"-()").lower() for w in words)
    common = [bare[w] for w in known]
    common.append(len(words) - sum(common))
    return [[x / (sum(h) or 1) for x in h] for h in (classes, common)]


def distance(p, q):
    if not sum(p) or not sum(q):
        return 0.0
    half = [sum(a * np.log2(2 * a / (a + b)) for a, b in zip(x, y) if a) for x, y in ((p, q), (q, p))]
    return max(0.0, sum(half) / 2) ** 0.5


def brute_verdicts(corpus):
    """(doc_id, kept, distances) by three rounds of means over the rows that the means before keep."""
    rows = []
    for i, text, lang, *_ in corpus:
        b, words = brute(text), WORD.findall(text or "")
        rows.append((i, lang, b[0], len(text or ""), b[0] < 50 or 100 * b[4] > 50 * b[0], shares(text or "", words)))
    refs = {}

    def far(lang, h):
        near = list(refs.values()) if lang is None else [refs[lang]] if lang in refs else []
        return min(([distance(x, y) for x, y in zip(h, ref)] for ref in near), key=sum, default=[0.0, 0.0])

    def good(n, chars, d):
        return not (chars >= 200 and d[0] ** 2 > 0.15 ** 2 + 9 / chars or n >= 50 and d[1] ** 2 > 0.35 ** 2 + 6 / n)

    for _ in range(3):
        kept = {}
        for _, lang, n, chars, failed, h in rows:
            if lang is not None and not failed and good(n, chars, far(lang, h)):
                kept.setdefault(lang, []).append(h)
        refs = {k: [np.mean([h[j] for h in v], axis=0).tolist() for j in (0, 1)] for k, v in kept.items()} or refs
    return [(i, not failed and good(n, chars, far(lang, h)), *far(lang, h)) for i, lang, n, chars, failed, h in rows]


def test_verdicts_against_brute_force(spark, docs, corpus):
    more = [(k + i, *rest) for k in (200, 300) for i, *rest in corpus[:60]]
    long = [r for r in corpus[:60] if len(r[1].split()) >= 80][:6]
    more += [(400 + i, t.replace(" ", " | "), *rest) for i, t, *rest in long]
    more += [(500 + i, t.upper(), *rest) for i, t, *rest in long]
    df = docs.union(spark.createDataFrame(more, docs.schema))
    got = sorted((tuple(r) for r in judge(df).select("doc_id", "kept", "char_distance", "word_distance").collect()), key=str)
    want = sorted(brute_verdicts([*corpus, *more]), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert {w[1] for w in want} == {True, False}
    by = lambda rows: sorted((r[2:] for r in rows))
    assert np.allclose(by(got), by(want), atol=1e-9)
