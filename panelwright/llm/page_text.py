"""Main text of web pages: gradient-boosted trees over the nodes of the document tree.

Every block node gets features of its subtree, attributes, depth and siblings. The trees are
fitted on a bounded sample of pages, labelled where tags and attribute tokens say plainly what a
node is; half of the sampled pages hide those signs, so that densities and position count
too. A choice over the whole tree then keeps or drops subtrees, so that no kept node has a dropped ancestor.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.passes import add_columns
from panelwright.scale import written

# Bound of the sample: pages in hash order.
SAMPLE_PAGES = 600
TREES, DEPTH = 12, 4

# Element names and attribute tokens by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style noscript template svg iframe object textarea select button title xmp noembed noframes "
                   "canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var".split())
# Inline elements that go on behind the end of a block around them, up to the end of a cell.
FORMATTING = frozenset("a b big code em font i s small strike strong tt u".split())
CELLS = frozenset("td th caption button object".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
ENDS_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
             "option": ("select",)}
AWAY_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN_TAGS = frozenset("article main".split())
AWAY = frozenset("""ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb
breadcrumbs footer foot header masthead topbar toolbar sidebar aside side rail widget widgets related recommended share sharing social
comment comments disqus respond reply replies cookie cookies consent notice notification alert gdpr popup modal overlay subscribe
subscription newsletter signup login search form pagination pager tags complementary contentinfo""".split())
MAIN = frozenset("article content main post entry story body text prose maincontent articlebody".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
# quoted values of other attributes are passed over
_ATTRIBUTE = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))|\"[^\"]*+\"|'[^']*+'", re.I)
_NAME_END, _MARK = re.compile(r"[\s/>]"), re.compile(r"[\"'>]")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class _Ends:
    """Whether a tag has an end outside quotes, for all tags of a page from one walk over its quotes and ``>`` from the back."""

    def __init__(self, s: str):
        self.s, self.at = s, [m.start() for m in _MARK.finditer(s)]
        self.ends = bytearray(len(self.at) + 1)
        quote: dict[str, int] = {}
        for k in range(len(self.at) - 1, -1, -1):
            c = s[self.at[k]]
            if c == ">":
                self.ends[k] = 1
            else:
                self.ends[k] = c in quote and self.ends[quote[c] + 1]
                quote[c] = k

    def after(self, lt: int) -> bool:
        name = _NAME_END.search(self.s, lt + 2)
        return bool(name and self.ends[bisect_left(self.at, name.start())])


class Page:
    """The tree of a page. Runs of inline text are kept as ``[node, text]`` in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.tokens = ["html"], [-1], [frozenset()]
        self.runs: list[list] = []
        self.link = [0]
        self._open, self._links, self._fresh = [0], 0, True
        # by name, the inline elements not ended yet: ``(node, True)``, or without a node of their own ``(node that holds it, False)``
        self._inline: dict[str, list[tuple[int, bool]]] = {}
        self._is_open, self._cells, self._blocks = [True], [0], [0]
        self._read(source)

    def _text(self, text: str) -> None:
        if not text:
            return
        node = self._open[-1]
        if self._fresh or self.runs[-1][0] != node:
            self.runs.append([node, []])
            self._fresh = False
        if "&" in text:
            text = html.unescape(text)
        self.runs[-1][1].append(text)
        if self._links:
            self.link[node] += len(text.strip())

    def _start(self, tag: str, attributes: str) -> None:
        tokens = frozenset()
        if attributes and "=" in attributes:
            found = " ".join("".join(m) for m in _ATTRIBUTE.findall(attributes))
            tokens = frozenset(t.lower() for t in _TOKEN.findall(found))
        if tag == "a":
            self._end_inline(tag)  # links don't nest
        if tag in INLINE and not tokens & AWAY:
            self._links += tag == "a"
            self._inline.setdefault(tag, []).append((self._last(self._cells) if tag in FORMATTING else self._open[-1], False))
            return
        if tag == "br":
            self._text(" ")
            return
        if tag in VOID:
            return
        if tag in ENDS_P:
            self._close("p", ("td", "th", "button", "object", "table", "caption"))
        elif tag in ENDS_SAME:
            self._close(tag, ENDS_SAME[tag])
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        self.tokens.append(tokens)
        self.link.append(0)
        node = len(self.tag) - 1
        self._open.append(node)
        self._is_open.append(True)
        self._fresh = True
        if tag in INLINE:
            self._inline.setdefault(tag, []).append((node, True))
        else:
            self._blocks.append(node)
            if tag in CELLS:
                self._cells.append(node)

    def _last(self, nodes: list[int]) -> int:
        while not self._is_open[nodes[-1]]:
            nodes.pop()
        return nodes[-1]

    def _cut(self, k: int) -> None:
        for node in self._open[k:]:
            self._is_open[node] = False
        del self._open[k:]
        self._fresh, self._links = True, 0

    def _end_inline(self, tag: str) -> None:
        """Ends the innermost ``tag`` that is open. One that began before a cell, or for all but formatting before a block, stays."""
        held = self._inline.get(tag, [])
        while held and not self._is_open[held[-1][0]]:
            held.pop()
        if not held or held[-1][0] < self._last(self._cells if tag in FORMATTING else self._blocks):
            return
        node, own = held.pop()
        if own:
            self._cut(bisect_left(self._open, node))
        elif tag == "a":
            self._links = max(0, self._links - 1)

    def _close(self, tag: str, within: tuple[str, ...] = ()) -> None:
        for k in range(len(self._open) - 1, 0, -1):
            name = self.tag[self._open[k]]
            if name == tag:
                self._cut(k)
                return
            if name in within:
                return

    def _read(self, s: str) -> None:
        at, n, ends = 0, len(s), None
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._text(s[at:])
                return
            self._text(s[at:lt])
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif s[lt + 1:lt + 2] in ("!", "?"):
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
            elif not (s[lt + 1:lt + 2].isalpha() or s[lt + 1:lt + 2] == "/" and s[lt + 2:lt + 3].isalpha()):
                self._text("<")
                at = lt + 1
            else:
                # after the first tag without an end, only those that have one are tried: linear time
                m = _TAG.match(s, lt) if ends is None or ends.after(lt) else None
                if m:
                    at, closes, tag, rest = m.end(), m[1], m[2].lower(), m[3]
                else:
                    ends = ends or _Ends(s)
                    end = s.find(">", lt)
                    at = n if end < 0 else end + 1
                    closes, tag, rest = s[lt + 1] == "/", re.split(r"[\s/>]", s[lt + 1:lt + 40].strip("/"), maxsplit=1)[0].lower(), ""
                if closes:
                    if tag == "br":
                        self._text(" ")
                    if tag in INLINE:
                        self._end_inline(tag)
                    else:
                        self._close(tag)
                    continue
                self._start(tag, rest)
                if tag in RAW and not rest.endswith("/"):
                    end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(s, at)
                    at = end.end() if end else n
                    self._close(tag)


NAMES = ("chars", "link_share", "density", "stops", "depth", "place", "siblings", "sibling_place", "same_tag", "parent_share",
         "children", "words_a_run", "heading", "paragraph", "list", "main_up", "away_up", "main_tokens", "away_tokens", "hidden")
_SIGNS = [NAMES.index(x) for x in ("main_up", "away_up", "main_tokens", "away_tokens")]
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


def _signs(page: Page) -> tuple[list[int], list[int]]:
    """For each node, how many of it and its ancestors are main or away by tag or token."""
    main, away = [0] * len(page.tag), [0] * len(page.tag)
    for i, (tag, up, tokens) in enumerate(zip(page.tag, page.parent, page.tokens, strict=True)):
        m, a = (main[up], away[up]) if up >= 0 else (0, 0)
        is_main = tag in MAIN_TAGS
        off = tag in AWAY_TAGS or tag == "header" and not m
        main[i] = m + (is_main or bool(tokens & MAIN) and tag not in ("body", "html"))
        away[i] = a + (off or bool(tokens & AWAY) and not is_main and tag not in ("body", "html"))
    return main, away


def features(page: Page) -> np.ndarray:
    """One row per node, see ``NAMES``."""
    n = len(page.tag)
    x = np.zeros((n, len(NAMES)))
    own, stops, runs, words = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    first = np.full(n, np.inf)
    seen = 0
    for node, parts in page.runs:
        text = "".join(parts)
        size = len(text.strip())
        own[node] += size
        stops[node] += sum(map(text.count, ".,;!?"))
        runs[node] += size > 0
        words[node] += len(text.split())
        first[node] = min(first[node], seen)
        seen += size
    chars, links, tags, marks, texts, count = own.copy(), np.array(page.link, float), np.ones(n), stops, runs, words
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        for v in (chars, links, tags, marks, texts, count):
            v[up] += v[i]
        first[up] = min(first[up], first[i])
    depth, child = np.zeros(n), np.zeros(n)
    order, same = np.zeros(n), {}
    for i in range(1, n):
        up = page.parent[i]
        depth[i] = depth[up] + 1
        order[i] = child[up]
        child[up] += 1
        same[up, page.tag[i]] = same.get((up, page.tag[i]), 0) + 1
    up = np.array(page.parent)
    up[0] = 0
    main, away = _signs(page)
    x[:, 0], x[:, 1], x[:, 2] = np.log1p(chars), links / np.maximum(1, chars), chars / tags
    x[:, 3], x[:, 4], x[:, 5] = marks / np.maximum(1, chars), depth, np.where(np.isfinite(first), first, seen) / max(1, seen)
    x[:, 6], x[:, 7] = child[up], order / np.maximum(1, child[up])
    x[:, 8] = [same.get((p, t), 1) / max(1, child[p]) for p, t in zip(page.parent, page.tag, strict=True)]
    x[:, 9], x[:, 10], x[:, 11] = chars / np.maximum(1, chars[up]), child, count / np.maximum(1, texts)
    x[:, 12] = [t in _HEADINGS for t in page.tag]
    x[:, 13] = [t == "p" for t in page.tag]
    x[:, 14] = [t in ("li", "ul", "ol") for t in page.tag]
    x[:, 15], x[:, 16] = main, away
    x[:, 17] = [len(t & MAIN) for t in page.tokens]
    x[:, 18] = [len(t & AWAY) for t in page.tokens]
    x[:, 19] = [t in HIDDEN for t in page.tag]
    return x


def _examples(texts: list[bytes]) -> list[list]:
    """Features and labels of the nodes whose part is plain; every second page hides the signs."""
    rows, labels = [], []
    for k, t in enumerate(texts):
        page = Page(t.decode("utf-8", "replace"))
        x, (main, away) = features(page), _signs(page)
        plain = [(i, 0.0 if away[i] else 1.0) for i in range(1, len(page.tag)) if (away[i] or main[i]) and page.tag[i] not in HIDDEN]
        if len(t) % 2:
            x[:, _SIGNS] = 0
        rows.append(x[[i for i, _ in plain]].ravel().tolist())
        labels.append([y for _, y in plain])
    return [rows, labels]


def fit(pages: DataFrame, sample: int = SAMPLE_PAGES) -> list:
    """Boosted trees, each as arrays ``feature, threshold, left, right, value`` with its weight.

    Trained on the labelled nodes of at most ``sample`` pages in hash order. Without nodes of both kinds there are no
    trees, and only the plain signs decide.
    """
    keyed = pages.where(F.length("html") > 0).withColumn("_h", F.xxhash64("html"))
    few = keyed.select("_h", "page_id").orderBy("_h", "page_id").limit(sample)  # the sample's keys, then its pages
    chosen = keyed.join(F.broadcast(few.select("_h").distinct()), "_h").select("html").dropDuplicates()
    nodes = add_columns(chosen, "html", "x array<double>, y array<double>", lambda: _examples, drop=("html",))
    width = len(NAMES)
    rows = written(nodes.select("x", F.posexplode("y").alias("at", "label"))
                   .select(F.slice("x", F.col("at") * width + 1, width).alias("x"), "label"))
    if rows.select("label").distinct().count() < 2:
        return []
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5, minInstancesPerNode=5, maxBins=32).fit(
        rows.repartition(4, "label", "x").select(array_to_vector("x").alias("features"), "label"))
    return [(w, _flatten(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees, strict=True)]


def _flatten(root) -> list[tuple]:
    """A tree of the fitted model as rows ``(feature, threshold, left, right, value)``; leaves have feature -1."""
    out: list = []

    def add(node) -> int:
        at = len(out)
        out.append(None)
        if node.subtreeDepth() == 0:
            out[at] = (-1, 0.0, at, at, node.prediction())
        else:
            split = node.split()
            left, right = add(node.leftChild()), add(node.rightChild())
            out[at] = (split.featureIndex(), split.threshold(), left, right, node.prediction())
        return at
    add(root)
    return out


def margins(trees: list, x: np.ndarray) -> np.ndarray:
    """Log-odds by the boosted trees for each row."""
    total = np.zeros(len(x))
    for weight, tree in trees:
        feature, threshold, left, right, value = (np.array(c) for c in zip(*tree, strict=True))
        at = np.zeros(len(x), dtype=int)
        for _ in range(DEPTH):
            go_left = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= threshold[at]
            at = np.where(feature[at] < 0, at, np.where(go_left, left[at], right[at]))
        total += weight * value[at]
    return 2 * total


def decode(page: Page, margin: np.ndarray) -> np.ndarray:
    """Which nodes to keep: the best choice in which a dropped node drops all below it.

    A kept node gains its margin for each own character, and a little for itself; hidden elements go.
    """
    n = len(page.tag)
    own = np.zeros(n)
    for node, parts in page.runs:
        own[node] += sum(len(p.strip()) for p in parts)
    gain = margin * (own + 1)
    gain[0] = 0.0
    for i in range(n - 1, 0, -1):
        if page.tag[i] in HIDDEN:
            gain[i] = -1.0
        if gain[i] > 0:
            gain[page.parent[i]] += gain[i]
    keep = np.zeros(n, dtype=bool)
    keep[0] = True
    for i in range(1, n):
        keep[i] = keep[page.parent[i]] and gain[i] > 0
    return keep


def main_text(page: Page, keep: np.ndarray) -> str:
    blocks = (" ".join("".join(parts).split()) for node, parts in page.runs if keep[node])
    return " ".join(b for b in blocks if b)


def extract(pages: DataFrame, sample: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    NULL or empty html gives an empty text; bytes that aren't UTF-8 become replacement characters; markup that never ends runs
    to the end of the page; rows that repeat are each extracted; further columns don't matter; an empty table gives no rows. See ``fit`` for the bounded training sample.
    """
    trees = fit(pages, sample)

    def make():
        def compute(texts: list[bytes]) -> list[list]:
            tree = [Page(t.decode("utf-8", "replace")) for t in texts]
            x = [features(p) for p in tree]
            ends = np.cumsum([len(v) for v in x])
            if trees:
                scored = np.split(margins(trees, np.concatenate(x)), ends[:-1]) if x else []
            else:
                scored = [np.where(v[:, NAMES.index("away_up")] > 0, -1.0, 1.0) for v in x]
            out = [main_text(p, decode(p, m)) for p, m in zip(tree, scored, strict=True)]
            return [out, [len(t) for t in out]]
        return compute
    return add_columns(pages.select("page_id", "url", "html"), "html", "text string, n_chars long", make, drop=("html",))
