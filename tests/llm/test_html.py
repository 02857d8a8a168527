import pytest
import time
from pyspark.sql import functions as F

from pixelframe.llm.html_pages import LAYOUTS, labelled_pages
from pixelframe.llm.html_text import extract, main_text, marginals, parse, train

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/x">Other</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy this now.</div>
<article><h1>The &amp; title</h1><p>A first   paragraph, with <b>bold</b> text<br>and&nbsp;more words in it. <p>An unclosed one &lt;here&gt; &#233;.</p>
<ul><li>One point<li>Two points</ul></article><footer>&copy; somebody. All rights.</footer></body></html>"""
TEXT = "The & title\nA first paragraph, with bold text and more words in it.\nAn unclosed one <here> é.\nOne point\nTwo points"


def test_page():
    assert main_text(PAGE, train()) == TEXT


def test_truncated_anywhere_never_fails():
    model = train()
    for n in range(0, len(PAGE), 7):
        assert isinstance(main_text(PAGE[:n], model), str)


def test_layout_left_out_of_training():
    pages, right, words = labelled_pages(), 0, 0
    for k in range(len(LAYOUTS)):
        model = train([p for i, p in enumerate(pages) if i % len(LAYOUTS) != k])
        for source in pages[k::len(LAYOUTS)]:
            page = parse(source)
            for (node, text), p in zip(page.runs, [marginals(page, model)] * len(page.runs)):
                size = len(text.split())
                words += size
                right += size * ((p[node] > 0.5) == ("data-main" in page.names[node]))
    assert right / words > 0.85


def test_marginals_equal_enumeration():
    from itertools import product
    import math
    from pixelframe.llm.html_text import _child_kind, evidence
    model = train()
    page = parse("<div class=menu><p>a b</p></div><article><h1>c</h1><p>d e f.</p></article>")
    kinds, found = _child_kind(page), evidence(page)
    n, total, on = len(page.tag), 0.0, [0.0] * len(page.tag)
    for labels in product((0, 1), repeat=n):
        w = model.prior[labels[0]]
        for i in range(n):
            w *= math.exp(sum((model.score.get(f) or model.floor[f.split("=")[0]])[labels[i]] for f in found[i]))
            if i:
                w *= model.edge[kinds[i]][labels[page.parent[i]]][labels[i]]
        total += w
        for i in range(n):
            on[i] += w * labels[i]
    assert all(abs(a / total - b) < 1e-9 for a, b in zip(on, marginals(page, model)))


def test_odd_input():
    model = train()
    assert main_text(None, model) == main_text("", model) == main_text("<p></p>", model) == ""
    deep = "<div>" * 3000 + "<p>text of some words here, and more.</p>" + "</div>" * 3000
    assert isinstance(main_text(deep, model), str)
    assert isinstance(main_text("<a title=\"open><p>x" * 500, model), str)
    long = "<article><h1>T</h1>" + "<p>Some words of a long page, with a stop.</p>" * 20000 + "</article>"
    assert main_text(long, model).count("\n") == 20000


def test_frame(spark):
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", "")], "page_id long, url string, html string")
    rows = extract(df.withColumn("text", F.lit(5)).withColumn("n_chars", F.lit(0))).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in rows) == [(0, "", 0), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "", 0)]
    assert extract(df.where("false")).count() == 0


def test_formulas_drawn_text_and_fallbacks_are_not_dropped_by_tag():
    text = lambda source: [t for _, t in parse(source).runs]
    assert text("<p>The sum <math><mi>x</mi><mo>=</mo><mn>3</mn></math> is known") == ["The sum x=3 is known"]
    assert text("<svg><path d='M0'/><text>Drawn <tspan>words</tspan></text></svg><p>after</p>") == ["Drawn words", "after"]
    assert text("<object data=x><p>Shown instead</p></object> on") == ["Shown instead", "on"]
    assert text("<script>x</script><style>y</style><template>z</template><textarea>t</textarea>stays") == ["stays"]


@pytest.mark.parametrize("source", ["<div>" * 100_000 + "x", "<div>" * 50_000 + "</span2>" * 50_000 + "x", "<li>" * 100_000 + "x",
                                    "<li><ul>" + "<div>" * 50_000 + "<li></li>" * 50_000 + "x", "</div>" * 100_000 + "x",
                                    "<table>" + "<tr><td>" * 50_000 + "x", "<p>" * 100_000 + "x"])
def test_parsing_is_linear(source):
    began = time.process_time()
    page = parse(source)
    assert [t for _, t in page.runs] == ["x"]
    assert time.process_time() - began < 10
