"""Labelled pages for the HTML extraction model: layouts with the main text
marked by ``data-main``, filled with words by rule."""

from __future__ import annotations

# {p}: a paragraph, {s}: a sentence, {t}: a few words
LAYOUTS = (
    """<html><head><title>{t}</title><style>p{{margin:0}}</style></head><body><nav><ul><li><a href="/">{t}</a></li>
<li><a href="/a">{t}</a></li><li><a href="/b">{t}</a></li></ul></nav><div class="ad">{s}</div><article><h1 data-main>{t}</h1>
<p data-main>{p}</p><p data-main>{s}</p><p data-main>{p}</p><p data-main>{t}.</p></article><footer>&copy; {t} {s}</footer></body></html>""",
    """<body><header class="site-header"><a href="/">{t}</a><nav class="main-menu"><a href="/x">{t}</a><a href="/y">{t}</a></nav>
</header><main><article class="post"><h1 data-main>{t}</h1><div class="entry-content"><p data-main>{p}</p><h2 data-main>{t}</h2>
<p data-main>{p}</p><ul><li data-main>{s}</li><li data-main>{s}</li></ul><blockquote data-main>{s}</blockquote></div>
<div class="share-buttons"><a href="#">{t}</a><a href="#">{t}</a></div></article></main><aside class="sidebar"><h3>{t}</h3>
<ul><li><a href="#">{t}</a></li><li><a href="#">{t}</a></li></ul><p>{s}</p></aside><section id="comments"><h3>{t}</h3>
<div class="comment"><p>{p}</p></div><div class="comment"><p>{s}</p></div></section><footer class="site-footer"><p>{s}</p></footer></body>""",
    """<body><div id="header"><h1>{t}</h1></div><div id="nav"><a href="#">{t}</a> | <a href="#">{t}</a></div><div id="content">
<h2 data-main>{t}</h2><p data-main>{p}</p><p data-main>{p}</p><div data-main>{s}</div></div><div id="right" class="sidebar">
<p>{s}</p><p><a href="#">{t}</a></p></div><div id="footer"><p>{s}</p><a href="#">{t}</a></div></body>""",
    """<body><div class="cookie-notice"><p>{s}</p><button>{t}</button></div><div class="container"><div class="row">
<div class="col-8 article-body"><h1 data-main>{t}</h1><p data-main>{p}</p><table><tr><td data-main>{t}</td><td data-main>{t}</td></tr>
<tr><td data-main>{s}</td><td data-main>{t}</td></tr></table><p data-main>{p}</p></div><div class="col-4"><div class="widget">
<h3>{t}</h3><ul><li><a href="#">{t}</a></li><li><a href="#">{t}</a></li></ul></div><div class="newsletter"><form><label>{t}</label>
<input><button>{t}</button></form></div></div></div></div><footer><div>{t}</div><div><a href="#">{t}</a></div></footer></body>""",
    """<body><nav role="navigation"><ol class="breadcrumb"><li><a href="#">{t}</a></li><li>{t}</li></ol></nav><main><section>
<h1 data-main>{t}</h1><p data-main>{p}</p><div class="advert"><p>{s}</p></div><p data-main>{s}</p></section><section><h2 data-main>{t}</h2>
<p data-main>{p}</p><pre data-main>{s}</pre></section></main><aside class="related"><h4>{t}</h4><p><a href="#">{s}</a></p></aside>
<section class="comments"><article class="comment"><p>{p}</p></article><article class="comment"><p>{s}</p></article>
<form class="reply"><label>{t}</label><button>{t}</button></form></section><footer><p>{s}</p></footer></body>""",
    """<body><h1 data-main>{t}</h1><p data-main>{p}</p><p data-main>{p}</p><div class="banner">{s}</div><p data-main>{s}</p>
<p class="copyright">{s}</p></body>""",
    """<body><div class="alert notice" role="alert">{s}</div><form class="search"><input><button>{t}</button></form><article>
<h1 data-main>{t}</h1><h2 data-main>{t}</h2><p data-main>{p}</p><dl><dt data-main>{t}</dt><dd data-main>{s}</dd><dt data-main>{t}</dt>
<dd data-main>{s}</dd></dl><p data-main>{p}</p><aside><p>{s}</p></aside></article><form class="login"><p>{s}</p><label>{t}</label></form>
<div class="social"><ul><li><a href="#">{t}</a></li></ul></div><footer><nav><a href="#">{t}</a></nav><p>{s}</p></footer></body>""",
    """<body><header><h1>{t}</h1><p>{s}</p></header><div class="menu"><ul><li><a href="#">{t}</a></li><li><a href="#">{t}</a></li></ul></div>
<div class="promo sponsored"><p>{s}</p><a href="#">{t}</a></div><div class="story"><p data-main>{p}</p><p data-main>{s}</p>
<figure><figcaption data-main>{s}</figcaption></figure><p data-main>{p}</p><ul><li data-main>{t}</li><li data-main>{t}</li></ul></div>
<div class="disqus"><ul class="comment-list"><li>{s}</li><li>{p}</li></ul></div><div class="footer">{s}</div></body>""",
    """<body><nav><ul><li><a href="/">{t}</a></li><li><a href="/a">{t}</a></li></ul></nav><div class="ad">{s}</div><article>
<h1 data-main>{t}</h1><p data-main>{s}</p></article><footer>{t} {s}</footer></body>""",
    """<body><nav><a href="/">{t}</a></nav><article><h1 data-main>{s}</h1><p data-main>{t}</p><p data-main>{s}</p></article>
<div class="notice"><p>{s}</p></div><div id="comments"><ol class="commentlist"><li class="comment">{p}</li><li>{s}</li>
<li class="comment"><p>{s}</p></li></ol></div><div class="adverts"><p>{p}</p></div><footer class="footer"><p>{p}</p></footer></body>""",
    """<body><div class="top-menu"><ul><li><a href="#">{t}</a></li></ul></div><div class="wrapper"><div class="post-content"><h1 data-main>{t}</h1>
<div data-main>{p}</div><div data-main>{s}</div><ol><li data-main>{s}</li><li data-main>{t}</li></ol></div><div class="reviews">
<div>{s}</div><ul><li>{p}</li></ul></div></div><div class="bottom copyright"><p>{s}</p><p class="copyright">{t}</p></div></body>""",
    """<body><div class="menu"><div><a href="#">{t}</a></div><div><a href="#">{t}</a></div></div><div id="story"><h1 data-main>{t}</h1>
<div data-main>{p}</div><div data-main>{s}</div><div data-main>{p}</div><div data-main>{s}</div><div data-main>{t}</div></div>
<div class="related"><div><a href="#">{s}</a></div></div><div class="footer"><div>{s}</div></div></body>""",
)
WORDS = """time year people way day man thing woman life child world school state family student group country problem hand
part place case week company system program question work number night point home water room mother area money story fact
month lot right study book eye job word business issue side kind head house service friend father power hour game line end
member law car city community name""".split()


def labelled_pages() -> list[str]:
    """Every layout three times, with shorter and longer texts."""
    pages = []
    for size in (1, 2, 4):
        for k, layout in enumerate(LAYOUTS):
            state = [17 * k + 5 * size]

            def words(n: int) -> str:
                state[0] += n
                return " ".join(WORDS[(state[0] * 7 + 3 * i) % len(WORDS)] for i in range(n))

            out = layout
            for mark, n in (("{p}", 20 * size), ("{s}", 5 + 3 * size), ("{t}", 1 + size // 2)):
                while mark in out:
                    text = words(n).capitalize() + ("." if mark != "{t}" else "")
                    out = out.replace(mark, text, 1)
            pages.append(out.replace("{{", "{").replace("}}", "}"))
    return pages
