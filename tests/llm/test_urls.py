import re
import zlib

import pytest
from pyspark.sql import functions as F

from pixelframe.llm.urls import GRAMS, THRESHOLD, features, fit, judge, labelled_urls, with_host_path


@pytest.fixture(scope="module")
def model(spark):
    return fit(labelled_urls(spark))


def test_host_and_path(spark):
    rows = [("http://WWW.Ex-ÄB.com/A/b?x=/y#z", "www.ex-Äb.com", "/A/b"), ("x://h", "h", ""), ("x://h?q/r", "h", ""),
            ("x://h#/f", "h", ""), ("no scheme/path", "", ""), (None, "", ""), ("", "", ""), ("a://b://c/d", "b:", "//c/d"),
            ("http://h/a\nb#c", "h", "/a\nb")]
    df = spark.createDataFrame([(u,) for u, _, _ in rows], "url string")
    got = {r.url: (r.host, r.path) for r in with_host_path(df).collect()}
    assert got == {u: (h, p) for u, h, p in rows}


def test_rules_longest_wins(spark, model):
    rows = [("http://a.net/x", "net/", "block"), ("http://net/", "net/", "block"), ("http://example.net/en/5", "example.net/en/", "allow"),
            ("http://www.example.net/en/", "example.net/en/", "allow"), ("http://example.net/de/", "net/", "block"),
            ("http://www.example.com/de/1", "example.com/de/", "block"), ("http://q.org/fr/", "org/fr/", "allow"),
            ("http://myexample.com/de/", None, None), ("http://a.net", None, None), ("http://xnet/", None, None), (None, None, None)]
    df = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(rows)], "page_id long, url string")
    for r in judge(df, model).collect():
        _, rule, verdict = rows[r.page_id]
        assert r.rule == rule
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_method_judges_unseen_names(spark, model):
    bad = ["slots-casino-vip", "tracker-ads", "pills-cheap-now", "adult-cams-live", "spam-seo-farm"]
    good = ["thenation", "townmuseum", "mountain-weather", "thetheory", "readerletters", "hearing"]
    df = spark.createDataFrame([(i, f"http://{n}.example.com/en/{i}") for i, n in enumerate(bad + good)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in judge(df, model).collect()}
    assert [got[i] for i in range(len(bad))] == ["block"] * len(bad)
    assert [got[i] for i in range(len(bad), len(bad + good))] == ["allow"] * len(good)


def test_empty_equal_and_extra(spark, model):
    df = spark.createDataFrame([(1, "http://a.net/x")] * 2 + [(None, None)], "page_id long, url string")
    wide = df.withColumn("host", F.lit(1)).withColumn("verdict", F.lit("?")).withColumn("grams", F.lit(0))
    assert judge(wide, model).count() == 3
    assert judge(df.where("false"), model).count() == 0


def test_native(spark, model):
    df = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    plan = judge(df, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_margins_against_a_dot_product(spark, model):
    urls = [r.url for r in labelled_urls(spark).collect()[::37]]
    urls += [None, "", "no scheme", "http://", "http://a", "http://Ü.x/ÄÖ/77?q", "x://h" + "/very/long" * 30]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r.margin[1] for r in model.transform(features(with_host_path(df))).collect()}
    verdicts = {r.page_id: (r.rule, r.verdict) for r in judge(df, model).collect()}
    hashing, logistic = model.stages
    weights, intercept = logistic.coefficients.toArray(), logistic.intercept

    def grams(text):
        return [text[i:i + n] for n in GRAMS for i in range(max(len(text) - n + 1, 1))]

    for i, url in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]+", lambda u: u[0].lower(), m[1]), m[2]) if m else ("", "")
        terms = grams(f"^{host}$") + ["p:" + g for g in grams(re.sub("[0-9]+", "0", path))]
        margin = intercept + sum(weights[j] for j in sorted({hashing.indexOf(t) for t in terms}))
        assert got[i] == pytest.approx(margin, abs=1e-9), url
        rule, verdict = verdicts[i]
        if rule is None:
            assert verdict == ("block" if 1 / (1 + 2.718281828459045 ** -margin) > THRESHOLD else "allow"), url


def test_names_held_out_of_the_fit(spark):
    name = re.compile(r"http://(?:www\.|m\.|blog\.)?([a-z-]+)\.")
    rows = [tuple(r) for r in labelled_urls(spark).collect()]
    held = [zlib.crc32(name.match(u)[1].encode()) % 5 == 1 for u, _ in rows]
    train = spark.createDataFrame([r for r, h in zip(rows, held) if not h], "url string, label double").coalesce(1)
    test = spark.createDataFrame([r for r, h in zip(rows, held) if h], "url string, label double")
    judged = fit(train).transform(features(with_host_path(test)))
    right = judged.agg(F.avg((F.col("is_blocked") == F.col("label")).cast("double")), F.count("*")).first()
    assert right[1] > 200 and right[0] >= 0.9
