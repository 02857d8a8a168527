"""Operator 3: main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree; each is content or not.  A node's
evidence is naive Bayes over its tag with its link density, the kinds of names
in its class, id and role, its text length and sentence marks; a parent and a child
share a 2x2 potential, with one table for children that hold text by their tag
(paragraphs, headings, lists, cells), one for others with text of their own and
one for the rest.  All are counts over labelled pages.  Messages passed up
from the leaves and down from the root (sum-product) give each node's exact
content marginal; text directly in a node with a marginal above 0.5 is kept.

Markup is read leniently: unclosed paragraphs, list items and cells end where
the next begins, unknown end tags are skipped, comments, scripts, styles, titles
and a tag cut off by the end of the page give no text.  Character references
are decoded; white space inside a block becomes one space (a line break inside
a block is white space); blocks are joined by one newline in page order.

Defined results: null or empty html gives the empty text; a page without any
content node too; equal rows are treated alike; further columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from pixelframe.llm.base import read_table
from pixelframe.llm.html_pages import labelled_pages

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
#: Never shown as text of the page: code, form parts, and noscript and iframe, whose content a browser does not read as markup.
_SKIPPED = frozenset("script style noscript template title textarea iframe select datalist".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp
small span strike strong sub sup time tt u var br img wbr input picture source math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle mpadded msub msup msubsup munder
mover munderover mtable mtr mtd semantics annotation tspan""".split())
_KNOWN = frozenset("""html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tr td th blockquote pre
figure figcaption nav header footer aside form button fieldset address""".split())
#: Tags that hold text; they follow their parent more closely than sections and divisions do.
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody tr td th blockquote pre figure figcaption".split())
#: Open elements that a new element of the kind ends.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th")}
_BOUNDS = frozenset("ul ol dl table".split())
# kinds of names in class, id and role (fixed values)
_KINDS = {
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs pager pagination toc topbar sitemap tabs skip",
    "header": "header masthead banner branding logo top",
    "footer": "footer copyright legal colophon bottom foot",
    "side": "sidebar side aside widget widgets related recommended popular trending rail secondary complementary more",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion outbrain taboola",
    "notice": "cookie cookies notice consent alert popup modal overlay gdpr banner warning paywall dialog toast message",
    "comment": "comment comments commentlist reply replies respond disqus discussion responses reviews",
    "form": "form search login signup subscribe subscription newsletter register contact",
    "share": "share sharing social follow facebook twitter buttons toolbar tools print",
    "content": "content article post entry body main story text page prose",
}
_KIND_OF: dict[str, set[str]] = {}
for _kind, _words in _KINDS.items():
    for _w in _words.split():
        _KIND_OF.setdefault(_w, set()).add(_kind)


@dataclass
class Page:
    """Nodes in document order (a parent before its children); ``runs``: (node, text)."""
    tag: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    runs: list[tuple[int, str]] = field(default_factory=list)
    link_words: Counter = field(default_factory=Counter)


def parse(source: str | None) -> Page:
    """Block tree and text runs of a page."""
    page, source = Page(["#page"], [""], [-1]), source or ""
    stack, links, buffer, at, end = [0], 0, [], 0, len(source)
    places: dict[str, list[int]] = {}  # of the open elements of a tag in the stack

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(k: int) -> None:
        for node in stack[k:]:
            places[page.tag[node]].pop()
        del stack[k:]

    def flush():
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            page.runs.append((stack[-1], text))

    def words(text: str):
        text = html.unescape(text)
        if links:
            page.link_words[stack[-1]] += len(text.split())
        buffer.append(text)

    while at < end:
        m = _TOKEN.search(source, at)
        if m is None:
            words(source[at:])
            break
        if m.start() > at:
            words(source[at:m.start()])
        at = m.end()
        name = (m[2] or m[6] or "").lower()
        if not name or not (m[4] or m[8]):
            continue
        closing, attributes = m[1] or m[5], m[3] or m[7] or ""
        if closing:
            if name == "a":
                links = max(0, links - 1)
            elif name not in _INLINE and name not in ("html", "body") and places.get(name):
                flush()
                close(places[name][-1])
                links = 0
            continue
        if name in _SKIPPED:
            if not attributes.endswith("/"):
                ended = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                at = end if ended is None else source.find(">", ended.start()) + 1 or end
            continue
        if name in _INLINE:
            if name == "a":
                links = 1
            elif name == "br":
                buffer.append(" ")
            continue
        flush()
        if name in _VOID:
            continue
        links = 0
        if name not in _KNOWN and attributes.endswith("/"):  # drawings and formulas close themselves
            continue
        if page.tag[stack[-1]] == "p":
            close(len(stack) - 1)
        if name in _ENDS:
            k = last(_ENDS[name])
            while k > last(_BOUNDS):
                tag = page.tag[stack[k]]
                close(k)
                if name != "tr" or tag == "tr":
                    break
                k = last(_ENDS[name])
        page.tag.append(name)
        page.names.append(attributes)
        page.parent.append(stack[-1])
        places.setdefault(name, []).append(len(stack))
        stack.append(len(page.tag) - 1)
    flush()
    return page


def evidence(page: Page) -> list[list[str]]:
    """Features of every node."""
    n = len(page.tag)
    total, linked, own, marks = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in page.runs:
        own[node] += text.count(" ") + 1
        marks[node] += text.count(". ") + text.count("? ") + text.count("! ") + text.endswith((".", "?", "!", ":", ";"))
    for i in range(n - 1, -1, -1):
        total[i] += own[i]
        linked[i] += page.link_words[i]
        if i:
            total[page.parent[i]] += total[i]
            linked[page.parent[i]] += linked[i]
    out = []
    for i in range(n):
        tag, attributes = page.tag[i], page.names[i]
        share = linked[i] / total[i] if total[i] else 0.0
        links = "none" if share == 0 else "some" if share < 0.3 else "half" if share < 0.7 else "all"
        found = [f"tag={tag if tag in _KNOWN else 'other'}, links {links}"]
        kinds = set()
        for m in _NAMES.finditer(attributes) if attributes else ():
            for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", m[1] or m[2] or m[3] or "").lower()):
                kinds |= _KIND_OF.get(word, set())
        if _HIDDEN.search(attributes):
            kinds.add("hidden")
        found += [f"name={k}" for k in sorted(kinds)] or ["name=none"]
        size = total[i]
        found.append("size=" + ("0" if size == 0 else "4" if size < 5 else "14" if size < 15 else "49" if size < 50 else "50"))
        if own[i]:
            found.append("marks=" + ("none" if not marks[i] else "yes"))
        out.append(found)
    return out


def _child_kind(page: Page) -> list[int]:
    """1: tag that holds text, 2: other node with text of its own, 0: the rest."""
    own = {node for node, _ in page.runs}
    return [1 if tag in _TEXT_TAGS else 2 if i in own else 0 for i, tag in enumerate(page.tag)]


@dataclass(frozen=True)
class Model:
    prior: tuple[float, float]
    edge: tuple  # edge[kind of child][parent label][child label]
    score: dict[str, tuple[float, float]]  # feature -> log P(feature | label)
    floor: dict[str, tuple[float, float]]  # by feature group, for unseen ones


def train(pages: list[str] | None = None, alpha: float = 0.1) -> Model:
    """Count potentials over pages whose main blocks carry ``data-main``; an
    outer node is content if half of its words are."""
    edge = [[[alpha, alpha], [alpha, alpha]] for _ in range(3)]
    counts: dict[str, list[float]] = {}
    nodes = [0.0, 0.0]
    for source in labelled_pages() if pages is None else pages:
        page = parse(source)
        n = len(page.tag)
        main, total = [0] * n, [0] * n
        for node, text in page.runs:
            size = text.count(" ") + 1
            total[node] += size
            main[node] += size if "data-main" in page.names[node] else 0
        for i in range(n - 1, 0, -1):
            total[page.parent[i]] += total[i]
            main[page.parent[i]] += main[i]
        label = [int(total[i] > 0 and 2 * main[i] >= total[i]) for i in range(n)]
        kind = _child_kind(page)
        for i, found in enumerate(evidence(page)):
            nodes[label[i]] += 1
            if i:
                edge[kind[i]][label[page.parent[i]]][label[i]] += 1
            for f in found:
                counts.setdefault(f, [0.0, 0.0])[label[i]] += 1
    groups = Counter(f.split("=")[0] for f in counts)
    score, floor = {}, {}
    for f, c in counts.items():
        size = groups[f.split("=")[0]] + 1
        score[f] = tuple(math.log((c[y] + alpha) / (nodes[y] + alpha * size)) for y in (0, 1))
    for g, size in groups.items():
        floor[g] = tuple(math.log(alpha / (nodes[y] + alpha * (size + 1))) for y in (0, 1))
    tables = tuple(tuple(tuple(x / sum(row) for x in row) for row in table) for table in edge)
    return Model((0.5, 0.5), tables, score, floor)


def marginals(page: Page, model: Model) -> list[float]:
    """P(content) of every node: messages up from the leaves, then down from the root."""
    n = len(page.tag)
    node = []
    for found in evidence(page):
        a = b = 0.0
        for f in found:
            s = model.score.get(f) or model.floor[f.split("=")[0]]
            a, b = a + s[0], b + s[1]
        top = max(a, b)
        node.append((math.exp(a - top), math.exp(b - top)))
    edges = [model.edge[t] for t in _child_kind(page)]
    inside = [list(x) for x in node]  # evidence of the node and all below it
    up = [(1.0, 1.0)] * n
    for i in range(n - 1, 0, -1):
        x0, x1 = inside[i]
        edge = edges[i]
        m0, m1 = edge[0][0] * x0 + edge[0][1] * x1, edge[1][0] * x0 + edge[1][1] * x1
        s = m0 + m1
        up[i] = (m0 / s, m1 / s)
        p = inside[page.parent[i]]
        p[0] *= up[i][0]
        p[1] *= up[i][1]
        s = p[0] + p[1]
        p[0] /= s
        p[1] /= s
    belief: list[tuple[float, float]] = [(0.0, 0.0)] * n
    for i in range(n):
        if i == 0:
            x0, x1 = model.prior[0] * inside[0][0], model.prior[1] * inside[0][1]
        else:
            b, u, edge = belief[page.parent[i]], up[i], edges[i]
            q0, q1 = b[0] / max(u[0], 1e-300), b[1] / max(u[1], 1e-300)  # the parent's belief without this child
            x0 = inside[i][0] * (q0 * edge[0][0] + q1 * edge[1][0])
            x1 = inside[i][1] * (q0 * edge[0][1] + q1 * edge[1][1])
        s = x0 + x1
        belief[i] = (x0 / s, x1 / s)
    return [b[1] for b in belief]


def main_text(source: str | None, model: Model, threshold: float = 0.5) -> str:
    page = parse(source)
    if not page.runs:
        return ""
    content = marginals(page, model)
    return "\n".join(text for node, text in page.runs if content[node] > threshold)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    model = train() if model is None else model
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"], pages["html"])

    def run(batches):
        for batch in batches:
            texts = [main_text(h, model) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op3_html(spark, sf_dir) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))
