"""Operator 8: main text of web pages by a tree-structured graphical model.

A page becomes a tree of elements. Every node is content or not: a node potential comes from its
tag, the words of its class, id and role, its text length and its link density; a
parent-child potential couples it with its parent. Sum-product messages go up to the root and down again;
a node's marginal is its probability of being content. Text whose element is
content is kept, block by block. All potentials are log-ratios of counts
over labelled pages, plus pseudo-counts for tag and class names that no page shows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import prepare, same_or_new

TRAIN_PAGES = 2000  # expected number of pages that the potentials are fitted on
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body canvas dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary table
tbody td tfoot th thead tr ul button textarea title""".split())
CLOSES_P = BLOCK - {"html", "body", "button", "title", "option", "legend", "select", "textarea"}
#: Elements whose start ends an open element of the same kind.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl article section div nav aside footer header form main body html".split())
#: Never content: no reader sees them, or they are controls.
SILENT = frozenset("""script style noscript template head title svg canvas iframe object annotation annotation-xml button select option
textarea input label form dialog""".split())

#: Words of class, id and role, by what they say about an element.
GROUPS = {
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promoted banner affiliate dfp",
    "comment": "comment comments disqus reply replies respond discussion",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup paywall",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip",
    "side": "sidebar side aside widget rail related recommended popular trending more",
    "frame": "header masthead footer foot copyright legal bottom top topbar",
    "share": "share sharing social follow tags meta byline author toolbar",
    "main": "article content main post entry story body text prose",
}
_GROUP_OF = {w: g for g, words in GROUPS.items() for w in words.split()}
_NAME = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "group", "parent", "kids", "own", "links", "order", "text")

    def __init__(self, tag, group, parent):
        self.tag, self.group, self.parent = tag, group, parent
        self.kids, self.text = [], []
        self.own = self.links = 0


def group_of(tag: str, attrs) -> str:
    for k, v in attrs:
        if k in ("class", "id", "role") and v:
            names = _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", v).lower())
            found = [_GROUP_OF[n] for n in names if n in _GROUP_OF]
            for g in GROUPS:  # a telling name outweighs a general one such as "content"
                if g in found:
                    return g
        if k in ("hidden",) or (k == "aria-hidden" and v == "true"):
            return "notice"
    return "none"


class TreeParser(HTMLParser):
    """Forgiving parser: implied ends, stray ends ignored, everything open at the end is closed."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", "none", None)
        self.nodes = [self.root]
        self.items = []  # (node, text) and (node, None) at block edges, in page order
        self.open = Counter()  # open elements by tag, so that an end without a start costs no walk
        self.inside = [Counter()]  # the same within each open scope

    def _to(self, n):
        """Close everything down to ``n``: each element is closed once."""
        while self.at is not n:
            tag = self.at.tag
            self.open[tag] -= 1
            if tag in SCOPES:
                self.inside.pop()
            self.inside[-1][tag] -= 1
            self.at = self.at.parent

    def _enter(self, n):
        self.open[n.tag] += 1
        self.inside[-1][n.tag] += 1
        if n.tag in SCOPES:
            self.inside.append(Counter())
        self.at = n

    def _close(self, tags):
        """End an open element of these kinds, but none around the scope that is being read."""
        if any(self.inside[-1][t] for t in tags):
            n = self.at
            while n.tag not in tags:
                n = n.parent
            self._to(n.parent)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close(("p",))
        if tag in IMPLIED:
            self._close(IMPLIED[tag])
        n = Node(tag, group_of(tag, attrs), self.at)
        self.at.kids.append(n)
        self.nodes.append(n)
        if tag in BLOCK:
            self.items.append((n, None))
        elif tag in ("br", "wbr"):
            self.items.append((self.at, " " if tag == "br" else ""))
        if tag not in VOID:
            self._enter(n)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self._to(self.at.parent)

    def handle_endtag(self, tag):
        if not (self.open if tag in BLOCK else self.inside[-1])[tag]:
            return  # a stray end; an inline one doesn't close a block either
        n = self.at
        while n.tag != tag:
            n = n.parent
        self._to(n.parent)
        if tag in BLOCK:
            self.items.append((n, None))

    def handle_data(self, data):
        self.items.append((self.at, data))
        if self.at.tag not in ("script", "style"):
            self.at.own += len(data.strip())


def parse(html: str) -> TreeParser:
    p = TreeParser()
    p.feed(html)
    p.close()
    for n in reversed(p.nodes):
        if n.tag == "a":
            n.links += n.own
        if n.parent is not None:
            n.parent.links += n.links
            n.parent.own += n.own  # now: all text below
    return p


#: Elements inside a line: they have no evidence of their own and follow their parent.
INLINE = frozenset("a abbr b bdi bdo br cite code del em font i img ins kbd mark q s small span strong sub sup time u var wbr".split())


def _evidence(n: Node) -> tuple[str, ...]:
    if n.tag in INLINE:
        return ("group=" + n.group,) if n.group != "none" else ()
    size = min(6, int(math.log2(n.own + 1)) // 2)
    links = int(4 * n.links / n.own) if n.own else 0
    return ("tag=" + n.tag, "group=" + n.group, f"size={size}", f"links={links}")


# What a name says before any page is seen: pseudo-counts (content, other). Names found in every part
# of a page weigh as much as the labelled pages may (EVIDENCE), so that their surroundings decide, even if
# the one design that the labelled pages have shows them in the article only.
EVIDENCE = 20.0
_PRIOR = {**{f"tag={t}": (0.01, 30.0) for t in ("#root", "html", "body", "nav", "header", "footer", "aside", "menu", *SILENT)},
          **{f"tag={t}": (40.0, 0.01) for t in ("article", "main")},
          **{f"tag={t}": (30.0, 15.0) for t in ("p", "blockquote", "pre", "figure", "figcaption")},
          **{f"tag={t}": (20.0, 20.0) for t in ("div", "section", "ul", "ol", "li", "table", "tbody", "thead", "tr", "td", "th",
                                                "dl", "dt", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "details", "summary")},
          **{f"group={g}": (0.01, 30.0) for g in GROUPS if g not in ("main", "share", "frame")},
          "group=share": (0.5, 20.0), "group=frame": (0.5, 20.0), "group=main": (30.0, 1.0), "group=none": (30.0, 30.0),
          **{f"size={k}": (15.0 + 2.0 * k, 20.0) for k in range(7)},
          "links=0": (30.0, 30.0), "links=1": (20.0, 30.0), "links=2": (5.0, 30.0), "links=3": (1.0, 40.0), "links=4": (1.0, 40.0)}
GENERIC, NAMED_OTHER, NAMED_MAIN = range(3)
_OTHER_TAGS = frozenset(("nav", "header", "footer", "aside", "menu")) | SILENT
_OTHER_GROUPS = frozenset(g for g in GROUPS if g not in ("main", "share", "frame"))


def kind_of(n: Node) -> int:
    """What an element's name says: an element without such a name follows its parent."""
    if n.tag in ("article", "main"):
        return NAMED_MAIN
    return NAMED_OTHER if n.tag in _OTHER_TAGS or n.group in _OTHER_GROUPS else GENERIC


#: Pseudo-counts [kind of the child][parent][child], order (other, content). An advert says nothing
#: about the element it stands in, so its rows are alike; so are those of an article.
_PAIR_PRIOR = np.array([[[60.0, 0.6], [2.0, 40.0]], [[40.0, 2.0], [40.0, 2.0]], [[10.0, 10.0], [10.0, 10.0]]])


def weak_labels(p: TreeParser) -> list[int]:
    """Label of each node of a page that marks its article: inside and not inside a part that isn't content."""
    out = {}
    for n in p.nodes:
        up = out.get(id(n.parent), 0)
        bad = n.tag in SILENT or n.tag in ("nav", "aside", "footer") or n.group in ("ad", "comment", "notice", "menu", "side")
        out[id(n)] = 0 if bad else 1 if n.tag in ("article", "main") else up
    return [out[id(n)] for n in p.nodes]


def _tally(batches):
    feats, pairs = {}, np.zeros((3, 2, 2))
    for b in batches:
        for html in b.column(0).to_pylist():
            if not html:
                continue
            p = parse(html)
            labels = weak_labels(p)
            if not any(labels):
                continue  # not a labelled page
            label = {id(n): y for n, y in zip(p.nodes, labels)}
            for n, y in zip(p.nodes, labels):
                for f in _evidence(n):
                    feats.setdefault(f, [0, 0])[1 - y] += 1
                if n.parent is not None:
                    pairs[kind_of(n), label[id(n.parent)], y] += 1
    rows = [(f, c[0], c[1]) for f, c in feats.items()] + [(f"pair={k}{i}{j}", int(pairs[k, i, j]), 0) for k in range(3) for i in (0, 1) for j in (0, 1)]
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                      pa.array([r[2] for r in rows], pa.int64())], names=["f", "a", "b"])


def model_of(counts: dict[str, tuple[float, float]]) -> dict:
    """Log potentials from (content, other) counts by feature."""
    node = {}
    plain = {f: c for f, c in counts.items() if not f.startswith("pair=")}
    kinds: dict[str, np.ndarray] = {}
    for f, c in plain.items():
        kinds.setdefault(f.split("=")[0], np.zeros(2))
        kinds[f.split("=")[0]] += c
    for f in set(plain) | set(_PRIOR):
        total = kinds.get(f.split("=")[0], np.zeros(2))
        a, b = plain.get(f, (0, 0))
        rate = a / max(1.0, total[0]), b / max(1.0, total[1])
        k = min(EVIDENCE, a + b) / (sum(rate) or 1.0)
        up, down = _PRIOR.get(f, (5.0, 5.0))
        node[f] = max(-8.0, min(8.0, math.log((rate[0] * k + up) / (rate[1] * k + down))))
    pairs = _PAIR_PRIOR.copy()
    seen = np.array([[[counts.get(f"pair={k}{i}{j}", (0, 0))[0] for j in (0, 1)] for i in (0, 1)] for k in range(3)], float)
    # Only elements without a telling name learn how closely they follow their parent.
    rows = seen[GENERIC].sum(axis=1, keepdims=True)
    pairs[GENERIC] += EVIDENCE * seen[GENERIC] / np.maximum(rows, 1.0)
    return {"node": node, "pair": np.log(pairs / pairs.sum(axis=2, keepdims=True)).tolist()}


def _lse(a: float, b: float) -> float:
    m = a if a > b else b
    return m + math.log(math.exp(a - m) + math.exp(b - m))


def marginals(p: TreeParser, model: dict) -> dict[int, float]:
    """Probability of each node being content: messages up to the root, then down."""
    node, pairs = model["node"], model["pair"]
    own, up, below = {}, {}, {}
    for n in p.nodes:
        x = sum(node.get(f, 0.0) for f in _evidence(n))
        if n.tag in SILENT:
            x = -30.0
        own[id(n)] = (0.0, x)
        below[id(n)] = [0.0, x]
    for n in reversed(p.nodes[1:]):  # children come after their parents
        b, pair = below[id(n)], pairs[kind_of(n)]
        m = [_lse(pair[y][0] + b[0], pair[y][1] + b[1]) for y in (0, 1)]
        up[id(n)] = m
        top = below[id(n.parent)]
        top[0] += m[0]
        top[1] += m[1]
    down, out = {id(p.root): (0.0, -8.0)}, {}
    for n in p.nodes:
        d, b = down[id(n)], below[id(n)]
        total = (d[0] + b[0], d[1] + b[1])
        out[id(n)] = 1.0 / (1.0 + math.exp(max(-60.0, min(60.0, total[0] - total[1]))))
        for k in n.kids:
            m, pair = up[id(k)], pairs[kind_of(k)]
            rest = (total[0] - m[0], total[1] - m[1])  # all that the parent knows without this child
            down[id(k)] = tuple(_lse(pair[0][y] + rest[0], pair[1][y] + rest[1]) for y in (0, 1))
    return out


def extract(html: str | None, model: dict) -> tuple[str, float]:
    """Main text of a page and the mean marginal of its kept characters."""
    if not html:
        return "", 0.0
    p = parse(html)
    prob = marginals(p, model)
    blocks, line, sure, chars = [], [], 0.0, 0

    def flush():
        t = " ".join("".join(line).split())
        if t:
            blocks.append(t)
        line.clear()

    for n, text in p.items:
        if text is None:
            flush()
            continue
        x = prob[id(n)]
        if x >= 0.5:
            line.append(text)
            sure += x * len(text)
            chars += len(text)
    flush()
    return "\n\n".join(blocks), sure / chars if chars else 0.0


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> dict:
    """Model from ``pages(page_id, html)``; about ``train_pages`` pages, chosen by a hash of the id.

    The labels are the pages' own: an ``article`` or ``main`` element names the
    article, elements that name themselves navigation, advert, comment and so on are not content.
    """
    prepare(pages.sparkSession)
    d = same_or_new(pages, [("page_id", "bigint"), ("html", "string")])
    n = max(1, d.count())
    place = F.pmod(F.xxhash64("page_id", F.lit(8)), F.lit(1 << 30))
    sample = d.where(place < int(min(1.0, train_pages / n) * (1 << 30)))
    rows = (sample.select("html").mapInArrow(_tally, "f string, a bigint, b bigint")
            .groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
            .orderBy("f").collect())  # tags and groups of the sample, which train_pages bounds
    return model_of({r["f"]: (r["a"], r["b"]) for r in rows})


def _run(shared):
    def run(batches):
        model = shared.value
        for b in batches:
            got = [extract(h, model) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([t for t, _ in got], pa.string()),
                 pa.array([len(t) for t, _ in got], pa.int64()), pa.array([s for _, s in got], pa.float64())],
                names=["page_id", "url", "text", "n_chars", "certainty"])
    return run


def extract_pages(pages: DataFrame, model: dict) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``page_id, url, text, n_chars, certainty``: one row per input row.

    NULL, empty and markup-only pages give an empty text. Broken markup is read as far as it
    goes, to the end of the page. Repeated rows and NULL ids stay; extra columns are ignored.
    """
    prepare(pages.sparkSession)
    d = same_or_new(pages, [("page_id", "bigint"), ("url", "string"), ("html", "string")])
    return d.mapInArrow(_run(pages.sparkSession.sparkContext.broadcast(model)),
                        "page_id bigint, url string, text string, n_chars bigint, certainty double")
