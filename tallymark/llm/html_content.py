"""Main text of web pages by a tree-structured graphical model over DOM nodes.

Every element and text run of a page is a node with a hidden state, content or
not. Log-linear potentials look at the node (tag, class and id words, amount of
text, share of links) and at parent and child together. Sum-product messages
pass up and down the tree and give each text run its marginal probability of
being content; runs above one half are the main text.

The model is trained by maximum likelihood on labelled pages: a bounded sample
of pages that mark their article themselves, and the same texts in layouts that
use other names, so that the weights do not hang on one tag. Extraction is a
projection; the model has a few thousand weights. Defined results: null or
empty html gives an empty text, as does a page without content; if no page of
the sample marks an article, only the built-in layouts are trained on;
repeated rows and other columns have no influence on each other.
"""

from __future__ import annotations

import functools
import html
import random
import re
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import text_of

#: Pages, chosen by hash, that are looked at for training.
SAMPLE = 120
PAGES_AT_A_TIME = 128
#: Pages in the built-in layouts that are trained on, at least.
PAGES = 120
#: Fixed values of HTML: elements without end tag, with raw text, and those that start a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe title".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HIDDEN = RAW | {"head", "select", "button", "input", "svg"}
#: Elements of other languages, in which a start tag may close itself, and what starts HTML again in a drawing.
FOREIGN = frozenset(("svg", "math"))
_LEAVES = BLOCKS | frozenset("b big br code em embed i img menu meta ruby s small span strong strike sub sup tt u var".split())
_HTML_INSIDE = frozenset(("foreignobject", "desc"))
#: Elements deeper than this hang on the one at this depth, as browsers have it.
DEEPEST = 512
_NAME_OF_TAG = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_NAME_OF_ATTRIBUTE = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Attributes whose words are features.
_TOLD = frozenset(("class", "id", "role", "itemprop"))


class Tags:
    """Reads the tags of a page from left to right, in time linear in the page.

    A quote inside a value without quotes, or inside a name, is a plain character.
    A value whose quote is never closed, or only by what opens the next value (it
    then holds a ``>`` and stops after a ``=``), ends with the tag. If a tag never
    ends by these rules, it and all later ones end with the first ``>``.
    """

    def __init__(self, source: str):
        self.source, self.plain = source, False
        self.last = {c: source.rfind(c) for c in "\"'>"}

    def read(self, at: int) -> tuple[int, str, list[tuple[str, str]], bool] | None:
        """Of the tag whose name starts at ``at``: its end, name, attributes and whether it closes itself; None if it has no end."""
        if at > self.last[">"]:
            return None
        m = _NAME_OF_TAG.match(self.source, at)
        if not self.plain:
            found = self._attributes(m.end())
            if found:
                return found[0], m[0].lower(), found[1], found[2]
            self.plain = True
        end = self.source.index(">", m.end())
        return end + 1, m[0].lower(), [], self.source[end - 1] == "/"

    def _attributes(self, at: int) -> tuple[int, list[tuple[str, str]], bool] | None:
        source, n, out, slash = self.source, len(self.source), [], False
        while at < n:
            gap = _GAP.match(source, at)
            slash, at = gap[0].endswith("/"), gap.end()
            if at >= n:
                return None
            if source[at] == ">":
                return at + 1, out, slash
            m = _NAME_OF_ATTRIBUTE.match(source, at)
            at, value = m.end(), ""
            equals = _EQUALS.match(source, at)
            if equals:
                at = equals.end()
                quote = source[at : at + 1]
                if quote and quote in "\"'":
                    close = source.find(quote, at + 1) if at < self.last[quote] else -1
                    if close < 0 or self._runs_on(at + 1, close):
                        close = source.find(">", at)
                        if close < 0:
                            return None
                        value, at = source[at + 1 : close], close
                    else:
                        value, at = source[at + 1 : close], close + 1
                else:
                    bare = _BARE.match(source, at)
                    value, at = bare[0], bare.end()
            out.append((m[0].lower(), value))
        return None

    def _runs_on(self, first: int, close: int) -> bool:
        """Whether the value swallowed the end of its tag and the quote that closes it is the next value's first."""
        before = close
        while before > first and self.source[before - 1].isspace():
            before -= 1
        return before > first and self.source[before - 1] == "=" and self.source.find(">", first, before) >= 0


@functools.cache
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I)


class Page:
    """Nodes of a page in document order: parent, depth, kind (0 element, 1 text run), features, label, parts of text and block.

    ``marker``: the attribute that holds labels; only pages to train on have one.
    """

    __slots__ = ("block", "depth", "features", "kind", "label", "open", "parent", "parts")

    def __init__(self, source: str, marker: str = ""):
        self.parent, self.depth, self.kind, self.features = [-1], [0], [0], [["root"]]
        self.label, self.parts, self.block = [0], [[]], [0]
        self.open = dict.fromkeys(FOREIGN | _HIDDEN | _HTML_INSIDE, 0)
        stack, tags, block, at, n = [0], ["#"], 0, 0, len(source)
        reader, tail = Tags(source), 0
        while at < n:
            start = source.find("<", tail)
            if start < 0 or start > reader.last[">"]:
                if not source.startswith("<!--", max(start, 0)):
                    self._run(source[at:], stack, tags, block)
                elif start > at:
                    self._run(source[at:start], stack, tags, block)
                break
            tail = start + 1
            sign = source[tail : tail + 1]
            end = tail + (sign == "/")
            if sign not in ("!", "?") and not ("a" <= source[end : end + 1].lower() <= "z"):
                continue  # a plain character
            if start > at:
                self._run(source[at:start], stack, tags, block)
            if sign in ("!", "?"):
                if source.startswith("<!--", start):
                    close = source.find("-->", start + 4)
                    at = tail = close + 3 if close >= 0 else n
                else:
                    at = tail = source.index(">", start) + 1
                continue
            at, tag, attributes, slash = reader.read(end)
            tail = at
            if sign == "/":
                if self.open.get(tag):
                    while tags[-1] != tag:
                        self._pop(stack, tags)
                    self._pop(stack, tags)
                block += tag in BLOCKS
                continue
            if slash and (tag in FOREIGN or self.open["svg"] or self.open["math"]):
                continue
            if tag in _LEAVES and self.open["svg"]:
                self._leave(stack, tags)
            if tag in BLOCKS:
                block += 1
                if self.open.get("p"):
                    self._close(stack, tags, ("p",), ("div", "article", "section", "td", "li", "body", "main", "aside"))
                if tag in _CLOSES:
                    self._close(stack, tags, _CLOSES[tag], ("ul", "ol", "dl", "table", "select", "body"))
            if tag == "br":
                self._run(" ", stack, tags, block)
            if tag in VOID:
                continue
            if tag in RAW:
                close = _end_of(tag).search(source, at)
                at = tail = close.end() if close else n
                continue
            stack.append(self._node(stack[min(len(stack), DEEPEST) - 1], 0, [f"tag={tag}", f"in={tags[-1]}"], block))
            tags.append(tag)
            self.open[tag] = self.open.get(tag, 0) + 1
            if not any(name in _TOLD for name, _ in attributes):
                self.features[-1].append(f"unnamed={tag}")
            for name, value in attributes:
                if name in _TOLD:
                    self.features[-1] += [f"name={x.lower()}" for x in _NAME.findall(value)]
                elif marker and name == marker:
                    self.label[-1] = int(value)
        self._measure()

    def _pop(self, stack: list[int], tags: list[str]) -> None:
        stack.pop()
        self.open[tags.pop()] -= 1

    def _close(self, stack: list[int], tags: list[str], names: tuple, walls: tuple) -> None:
        if not any(self.open.get(x) for x in names):
            return
        for i in range(len(tags) - 1, 0, -1):
            if tags[i] in names:
                while len(tags) > i:
                    self._pop(stack, tags)
                return
            if tags[i] in walls:
                return

    def _leave(self, stack: list[int], tags: list[str]) -> None:
        """Close the drawings that are open, up to the HTML that one of them holds."""
        low = max((i for i, tag in enumerate(tags) if tag in _HTML_INSIDE), default=0)
        if "svg" in tags[low:]:
            low = tags.index("svg", low)
            while len(tags) > low:
                self._pop(stack, tags)

    def _node(self, parent: int, kind: int, features: list[str], block: int) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.kind.append(kind)
        self.features.append(features)
        self.label.append(self.label[parent])
        self.parts.append([])
        self.block.append(block)
        return len(self.parent) - 1

    def _run(self, raw: str, stack: list[int], tags: list[str], block: int) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        blank, goes_on = not text.strip(), self.kind[-1] == 1 and self.block[-1] == block
        if blank and not goes_on:
            return
        parent = stack[min(len(stack), DEEPEST) - 1]
        if goes_on and self.parent[-1] == parent:
            self.parts[-1].append(text)
            return
        i = self._node(parent, 1, ["run", f"in={tags[-1]}"], block)
        self.parts[i].append(" " if blank else text)
        if any(self.open[x] for x in _HIDDEN):
            self.features[i].append("hidden")

    def _measure(self) -> None:
        n = len(self.parent)
        size, linked = [0] * n, [0] * n
        texts = self.texts()
        for i in range(n - 1, 0, -1):
            own = self.features[i]
            if self.kind[i] == 1:
                size[i] = len(texts[i])
                own.append(f"run-size={min(size[i].bit_length(), 9)}")
                own.append(f"stop={texts[i].rstrip()[-1:] in '.!?'}")
            elif own[0] == "tag=a":
                linked[i] = size[i]
            if self.kind[i] == 0:
                own.append(f"size={min(size[i].bit_length(), 12)}")
                own.append(f"links={min(4, 5 * linked[i] // (size[i] + 1))}")
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]

    def texts(self) -> list[str]:
        """The text of each run; empty for elements."""
        return ["".join(parts) for parts in self.parts]

    def content(self, chosen: list[bool]) -> str:
        blocks: list[list[str]] = []
        last = None
        for i, text in enumerate(self.texts()):
            if self.kind[i] == 1 and chosen[i]:
                if self.block[i] != last:
                    blocks.append([])
                    last = self.block[i]
                blocks[-1].append(text)
        return "\n\n".join(x for x in (" ".join("".join(b).split()) for b in blocks) if x)


class Forest:
    """Many pages as arrays, for messages along all trees at once."""

    def __init__(self, pages: list[Page], slots: dict[str, int]):
        sizes = [len(p.parent) for p in pages]
        self.first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        self.n = int(self.first[-1])
        self.parent = np.concatenate([np.array(p.parent) + f for p, f in zip(pages, self.first[:-1], strict=True)])
        depth = np.concatenate([np.array(p.depth) for p in pages])
        self.kind = np.concatenate([np.array(p.kind) for p in pages])
        self.label = np.concatenate([np.array(p.label) for p in pages])
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 1)))
        node, slot, at = [], [], 0
        for page in pages:
            for features in page.features:
                for f in features:
                    if f in slots:
                        node.append(at)
                        slot.append(slots[f])
                at += 1
        self.node, self.slot = np.array(node, dtype=np.int64), np.array(slot, dtype=np.int64)

    def marginals(self, weights: np.ndarray, pair: np.ndarray):
        """P(content) of each node, and the joint probabilities of parent and child states."""
        own = np.zeros((self.n, 2))
        own[:, 1] = np.bincount(self.node, weights=weights[self.slot], minlength=self.n)
        up, joint = np.zeros((self.n, 2)), np.zeros((self.n, 2, 2))
        for level in reversed(self.levels[1:]):
            inner = own[level][:, None, :] + pair[self.kind[level]]  # parent state, own state
            up[level] = np.logaddexp(inner[:, :, 0], inner[:, :, 1])
            np.add.at(own, self.parent[level], up[level])
        total = own.copy()
        for level in self.levels[1:]:
            outer = total[self.parent[level]] - up[level]
            both = outer[:, :, None] + pair[self.kind[level]]
            joint[level] = both + own[level][:, None, :]
            total[level] += np.logaddexp(both[:, 0], both[:, 1])
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500))), joint


class ContentModel:
    def __init__(self, pages: list[Page], steps: int = 150, decay: float = 1e-3):
        names = sorted({f for p in pages for fs in p.features for f in fs})
        self.slots = {f: i for i, f in enumerate(names)}
        self.weights, self.pair = np.zeros(len(names)), np.zeros((2, 2, 2))
        forest = Forest(pages, self.slots)
        inner = np.flatnonzero(forest.parent >= 0)
        inner = inner[np.isin(inner, forest.first[:-1], invert=True)]
        seen = np.zeros((2, 2, 2))
        np.add.at(seen, (forest.kind[inner], forest.label[forest.parent[inner]], forest.label[inner]), 1.0)
        m, v = np.zeros(len(names) + 8), np.zeros(len(names) + 8)
        for t in range(1, steps + 1):
            p, joint = forest.marginals(self.weights, self.pair)
            node = np.bincount(forest.slot, weights=(p - forest.label)[forest.node], minlength=len(names))
            edge = -seen
            np.add.at(edge, forest.kind[inner], joint[inner])
            gradient = np.concatenate([node, edge.ravel()]) / len(pages) + decay * np.concatenate([self.weights, self.pair.ravel()])
            m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
            step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)
            self.weights = self.weights - step[: len(names)]
            self.pair = self.pair - step[len(names) :].reshape(2, 2, 2)

    def extract(self, sources: list[str]) -> list[str]:
        pages = [Page(s) for s in sources]
        forest = Forest(pages, self.slots)
        chosen = forest.marginals(self.weights, self.pair)[0] > 0.5
        return [p.content(chosen[a:b].tolist()) for p, a, b in zip(pages, forest.first[:-1], forest.first[1:], strict=True)]


#: Names that layouts use for the parts of a page.
_CONTENT = ("article", "post-body", "entry-content", "main-content", "story", "page-text", "content", "", "post", "")
_PARTS = (
    ("header", "site-header masthead"), ("nav", "navbar menu"), ("div", "breadcrumb"), ("aside", "sidebar widget"), ("div", "ad banner advert sponsored"),
    ("div", "cookie-notice consent popup"), ("form", "newsletter subscribe search"), ("section", "comments replies"), ("div", "related share social"), ("footer", "site-footer copyright"),
)
_FILLER = ("Home", "About us", "Read more", "Sign up for our newsletter.", "This site uses cookies.", "I agree with this comment.", "All rights reserved.", "Buy now and save.")
_COMMENTS = ("comments", "comment-list", "replies", "discussion", "responses", "user-comments")
_REMARKS = (
    "I liked this a lot, it was well told.", "Thanks for posting.", "I do not agree with the last part. It was otherwise.", "Me too!", "Where can I read more about it?",
    "My friends and I talked about this all week, and we think that there is more to say.", "First.", "Great article, as ever.", "Reply", "Posted by a reader on Monday",
)


def _remarks(blocks: list[str], number: int, marker: str) -> str:
    """What readers wrote below, or inside, an article: some of it reads like the article itself."""
    own = [_REMARKS[(3 * number + j) % len(_REMARKS)] for j in range(2 + number % 4)]
    if number % 3 == 0:
        own.append(blocks[number % len(blocks)][:300])
    kind = ("section", "div", "ol", "div", "aside")[number % 5]
    inner = "".join(f"<li>{html.escape(x, quote=False)}</li>" if kind == "ol" else f"<p>{html.escape(x, quote=False)}</p>" for x in own)
    title = "<h2>Comments</h2>" if number % 2 and kind != "ol" else ""
    return f"<{kind} {'id' if number % 4 == 1 else 'class'}='{_COMMENTS[number % len(_COMMENTS)]}' {marker}='0'>{title}{inner}</{kind}>"


def layouts(blocks: list[str], number: int, marker: str = "x-label") -> str:
    """A labelled page with these blocks as content, in the layout of that number; attributes of the name ``marker`` hold the labels."""
    escape = lambda x: html.escape(x, quote=False)
    pick = random.Random(number)  # tags, names and places vary independently of each other
    tag, name = pick.choice(("div", "main", "section", "article", "td", "div")), pick.choice(_CONTENT)
    if pick.random() < 0.5:  # short stories
        blocks = [b[: pick.randrange(30, 200)] for b in blocks[: pick.randrange(3, 8)]]
    if number % 3 == 1:  # articles also have runs of very short paragraphs
        blocks = blocks + [" ".join(b.split()[:2]) for b in blocks for _ in range(4)]
    said, bare, alone = pick.choice(("inside", "after", "after", "")), pick.random() < 0.4, pick.random() < 0.12
    body = "".join(f"<h1>{escape(b)}</h1>" if i == 0 else f"<p>{escape(b)}</p>" if number % 3 else f"<p>{escape(b[: len(b) // 2])}<a href='/x'>{escape(b[len(b) // 2 :])}</a></p>" for i, b in enumerate(blocks))
    around = []
    for k, (kind, names) in enumerate(_PARTS):
        words = names.split()
        own = words[(number + k) % len(words)]
        filler = [_FILLER[(number + k + j) % len(_FILLER)] for j in range(1 + (number + k) % 4)]
        filler.append(escape(blocks[(number + k) % len(blocks)]) if (number + k) % 3 == 0 else "x")
        item = "<a href='/{}'>{}</a> " if number % 3 == 2 else "<li><a href='/{}'>{}</a></li>"
        inner = "".join(item.format(j, f) for j, f in enumerate(filler)) if kind == "nav" or own in ("menu", "related", "share", "social") else "".join(f"<p>{f}</p>" for f in filler)
        if (number + k) % 4:
            kind = kind if number % 2 else "div"
            named = "" if kind in ("nav", "header", "footer", "aside") and (number // 2 + k) % 3 == 0 else f" class='{own}'"
            around.append((k < 6, f"<{kind}{named} {marker}='0'>{inner}</{kind}>"))
    inside = f"<div class='ad' {marker}='0'>Buy now</div>" if number % 4 == 0 else ""
    before, after = "".join(x for b, x in around if b), "".join(x for b, x in around if not b)
    if said == "inside":
        body += _remarks(blocks, pick.randrange(1000), marker)
    elif said == "after":
        after = _remarks(blocks, pick.randrange(1000), marker) + after
    head = "<html><head><title>t</title></head>"
    if alone:  # nothing around the article
        return f"{head}<body {marker}='1'>{before}{inside}{body}{after}</body></html>"
    named = f" class='{name}'" if name else ""
    article = f"<{tag}{named} {marker}='1'>{inside}{body}</{tag}>"
    wrapped = article if bare else f"<div id='page'>{article}</div>"
    return f"{head}<body>{before}{wrapped}{after}</body></html>"


_OWN = [["A title", "The first sentence of a story, with a few more words in it.", "Another paragraph follows here. It has two sentences.", "The end."]]


def renamed(source: str, number: int, marker: str) -> str:
    """A page whose only article is another element, as many pages have it, and so labelled."""
    pick = random.Random(number)
    tag, name = pick.choice(("div", "div", "section", "main")), pick.choice(_CONTENT)
    start = f"<{tag} class='{name}' {marker}='1'" if name else f"<{tag} {marker}='1'"
    return re.sub(r"</article\b", f"</{tag}", re.sub(r"<article\b", start, source))


def train(sources: list[str]) -> ContentModel:
    """Trained on the pages that mark one article, as they are and with the article renamed, and on their texts in other layouts."""
    marker = f"x-{uuid.uuid4().hex}"  # no page has this attribute of its own
    marked = [re.sub(r"<article\b", f"<article {marker}='1'", s) for s in sources if len(re.findall(r"<article\b", s)) == 1]
    pages = [Page(s, marker) for s in marked]
    texts = [p.content([bool(x) for x in p.label]).split("\n\n") for p in pages]
    texts = [t for t in texts if t and t[0]] or _OWN
    pages += [Page(renamed(s, i, marker), marker) for i, s in enumerate(sources) if len(re.findall(r"<article\b", s)) == 1]
    return ContentModel(pages + [Page(layouts(texts[i % len(texts)][:12], i, marker), marker) for i in range(max(PAGES, len(pages)))])


def extract(pages: DataFrame, sample: int = SAMPLE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))
    span = 1 << 30
    share = min(1.0, sample / max(rows.count(), 1))
    chosen = rows.where(F.pmod(F.xxhash64("html"), F.lit(span)) < int(span * share)).select("html").distinct()
    model = train(sorted(r["html"] for r in chosen.collect()))  # about ``sample`` rows

    def batches(stream):
        import pyarrow as pa

        for batch in stream:
            sources = batch.column("html").to_pylist()
            texts = [t for low in range(0, len(sources), PAGES_AT_A_TIME) for t in model.extract(sources[low : low + PAGES_AT_A_TIME])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(batches, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
