"""The main text of web pages, by tag-path ratios.

A text node's tag path is the elements from the root to it, with their class and id. Long, punctuated text gathers under few
paths, menus and notices under paths of short nodes. Per path the length and the punctuation of its nodes are summed, over
the page and over all pages of its host; each sum divided by the number of nodes is a path ratio:

    ratio = characters a node * (1 + punctuation marks a node)

A path is scored by fusing both levels, the geometric mean of the page's ratio and the host's, so that a short article is known
by how its host's other articles look. Paths through elements that hold no article (ELEMENTS, and classes, ids or roles with
one of NAMES among their words, unless nothing else is left of the page) score 0, those inside a link LINK_SHARE of their ratio. Along the page the scores are smoothed with
the neighbours (KERNEL), and blocks whose score exceeds THRESHOLD standard deviations are content nodes.

The article is the innermost of the elements GROUPS that holds two blocks or more and HOLDS of the
characters of the content nodes, but no deeper than an article element. All its blocks are the text, short ones too,
without those that scored 0 and those mostly links that are no content nodes. Headings right before it belong to it. A page
without content nodes has no text.

Pages are read twice, once for the sums, once for the text; between the two only sums and scores are shuffled, and the pages once
to meet their scores. Sums per host are added before the shuffle, so a hot host is a few rows a task.

Defined results: a null html is empty and gives empty text; a null url is a host of its own; repeated rows give the same text
each and count each in their host's sums; unclosed, stray and misnested tags, attributes without quotes, comments and broken
markup at the end never fail; other columns are not read; an empty table gives no rows. Memory follows the longest page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.tables import lean, settled, shipped

KERNEL = (0.1, 0.2, 0.4, 0.2, 0.1)
THRESHOLD = 0.5
LINK_SHARE = 0.1
HOLDS = 0.9
MOSTLY_LINKS = 0.5
#: Parts a host's ratios are dealt to, so that a hot host meets its pages in several tasks.
SALTS = 16

#: Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var".split())
GROUPS = frozenset("html body div section article main center td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ELEMENTS = frozenset(
    "head nav header footer aside form button select option menu dialog fieldset legend script style "
    "textarea title noscript template iframe svg math".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments "
    "commentlist consent cookie cookies copyright disclaimer discussion disqus feedback flash footer form gdpr "
    "header legal links login masthead menu menubar message modal nav navbar navigation newsletter "
    "notice notices notification outbrain pager pagination paywall popup privacy promo promoted promotion reader recommended related "
    "replies reply respond responses search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription taboola tags toolbar topbar tracking warning widget widgets".split())
#: What the start of an element ends, within the elements that hold it.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
           "th": ("td", "th"), "option": ("option",)}
_HOLDERS = frozenset("ul ol dl table body html div section article main td th blockquote aside nav header "
                     "footer form".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[A-Za-z]+")
_MARKS = re.compile(r"[.,;:!?…。，！？،؟]")
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


class Element:
    """An open element: its name, its number, a hash of its path, and what it lies in."""

    __slots__ = ("name", "number", "path", "beside", "named", "in_article", "in_link")

    def __init__(self, name: str, number: int, path: int, beside: bool = False, named: bool = False,
                 in_article: bool = False, in_link: bool = False):
        self.name, self.number, self.path = name, number, path
        self.beside, self.named, self.in_article, self.in_link = beside, named, in_article, in_link


class Page:
    """The text nodes of a page in order. Work and memory follow its length, however deep it nests."""

    def __init__(self, html: str):
        #: Per node: its text, the numbers of its path, of its block and of the block element it lies in.
        self.texts: list[str] = []
        self.path: list[int] = []
        self.block: list[int] = []
        self.inside: list[int] = []
        #: Per path: its hash, whether it lies beside the article by its elements or its names, in a link.
        self.paths: list[int] = []
        self.beside: list[bool] = []
        self.named: list[bool] = []
        self.linked: list[bool] = []
        #: Per element: its name, and the number of the block element around it.
        self.kind: list[str] = [""]
        self.up: list[int] = [0]
        self._numbers: dict[int, int] = {}
        self._open: Counter[str] = Counter()
        self._read(html)

    def _add(self, raw: str, stack: list[Element], block: int) -> None:
        text = " ".join(unescape(raw).split())
        if text:
            last = stack[-1]
            if last.path not in self._numbers:
                self._numbers[last.path] = len(self.paths)
                self.paths.append(last.path)
                self.beside.append(last.beside)
                self.named.append(last.named)
                self.linked.append(last.in_link)
            self.texts.append(" " * raw[0].isspace() + text + " " * raw[-1].isspace())
            self.path.append(self._numbers[last.path])
            self.block.append(block)
            self.inside.append(last.number if last.name not in INLINE else self.up[last.number])
        elif raw:
            self._gap(block)

    def _gap(self, block: int) -> None:
        if self.texts and self.block[-1] == block:
            self.texts[-1] += " "

    def _read(self, html: str) -> None:
        stack = [Element("", 0, 0)]
        at = block = 0
        while m := _TAG.search(html, at):
            self._add(html[at:m.start()], stack, block)
            at = m.end()
            name = (m[2] or "").lower()
            if name == "br":
                self._gap(block)
            elif name and m[1]:
                self._close(stack, name)
                block += name not in INLINE
            elif name:
                if name not in INLINE:
                    block += 1
                    self._end_implied(stack, name)
                if name in RAW:
                    end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at)
                    at = end.end() if end else len(html)
                elif name not in VOID:
                    stack.append(self._opened(stack[-1], name, m[3]))
        self._add(html[at:], stack, block)

    def _opened(self, parent: Element, name: str, attributes: str) -> Element:
        label, words = name, set()
        for m in _NAMED.finditer(attributes) if "=" in attributes else ():
            own = _WORDS.findall((m[2] or m[3] or m[4] or "").lower())
            words.update(own)
            if m[1].lower() != "role":
                label += f"[{m[1].lower()}={' '.join(own)}]"
        if parent.in_article:
            words.discard("header")
        self.kind.append(name)
        self.up.append(parent.number if parent.name not in INLINE else self.up[parent.number])
        self._open[name] += 1
        return Element(
            name, len(self.kind) - 1, path_hash(parent.path, label),
            parent.beside or name in ELEMENTS and not (parent.in_article and name == "header"),
            parent.named or name not in ("html", "body", "main", "article") and not NAMES.isdisjoint(words),
            parent.in_article or name == "article", parent.in_link or name == "a")

    def _cut(self, stack: list[Element], k: int) -> None:
        self._open.subtract(e.name for e in stack[k:])
        del stack[k:]

    def _close(self, stack: list[Element], name: str) -> None:
        """An end tag closes the innermost open element of its name and all inside; one inline never a block."""
        if self._open[name] > 0:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    return self._cut(stack, k)
                if name in INLINE and stack[k].name not in INLINE:
                    return None

    def _end_implied(self, stack: list[Element], name: str) -> None:
        """A block's start ends an open paragraph, and an open element that cannot hold it."""
        ends = _CLOSES.get(name, ())
        first = None
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name == "p" or stack[k].name in ends:
                first = k
            elif stack[k].name in _HOLDERS:
                break
        if first is not None:
            self._cut(stack, first)


def path_hash(parent: int, label: str) -> int:
    """The hash of a path, from its parent's and its last element with class and id."""
    return int.from_bytes(blake2b(f"{parent}/{label}".encode(), digest_size=8).digest(), "big", signed=True)


def path_sums(page: Page) -> list[tuple[int, int, int, int]]:
    """(path, nodes, characters, punctuation marks) of the page's paths."""
    n, chars, marks = ([0] * len(page.paths) for _ in range(3))
    for text, k in zip(page.texts, page.path):
        n[k] += 1
        chars[k] += len(text.strip())
        marks[k] += len(_MARKS.findall(text))
    return list(zip(page.paths, n, chars, marks))


def ratio(n: float, chars: float, marks: float) -> float:
    return chars / n * (1 + marks / n)


def _smoothed(scores: np.ndarray) -> np.ndarray:
    """Means with the neighbours, by the kernel's weights that lie within the page."""
    reach = len(KERNEL) // 2
    weights = np.convolve(np.pad(np.ones(len(scores)), reach), KERNEL, "valid")
    return np.convolve(np.pad(scores, reach), KERNEL, "valid") / weights


def main_text(page: Page, host_ratio: dict[int, float]) -> str:
    """The article's blocks, joined by an empty line; paths without a ratio of the host have the page's alone."""
    if not page.texts:
        return ""
    beside = [a or b for a, b in zip(page.beside, page.named)]
    if all(beside):
        beside = page.beside
    score = []
    for (path, *sums), out, linked in zip(path_sums(page), beside, page.linked):
        own = ratio(*sums)
        fused = (own * host_ratio.get(path, own)) ** 0.5
        score.append(0.0 if out else fused * (LINK_SHARE if linked else 1))
    # Blocks of nodes: text, characters, of these in links, score, the element they lie in.
    blocks: list[list] = []
    last = None
    for text, k, block, inside in zip(page.texts, page.path, page.block, page.inside):
        if block != last:
            blocks.append(["", 0, 0, 0.0, inside])
            last = block
        if not beside[k]:
            size = len(text)
            blocks[-1][0] += text
            blocks[-1][1] += size
            blocks[-1][2] += size * page.linked[k]
            blocks[-1][3] += size * score[k]
    blocks = [b for b in blocks if b[0].strip()]
    if not blocks:
        return ""
    smooth = _smoothed(np.array([b[3] / b[1] for b in blocks]))
    content = (smooth > THRESHOLD * smooth.std()) & (smooth > 0)
    if not content.any():
        return ""
    article = _article(page, blocks, content)
    within = [e == article for e in range(len(page.kind))]
    for e in range(article + 1, len(page.kind)):
        within[e] = within[page.up[e]]
    taken = [within[b[4]] and (c or b[2] <= MOSTLY_LINKS * b[1]) for b, c in zip(blocks, content)]
    first = taken.index(True)
    while first and page.kind[blocks[first - 1][4]] in HEADINGS:
        first -= 1
        taken[first] = True
    return "\n\n".join(" ".join(b[0].split()) for b, t in zip(blocks, taken) if t)


def _article(page: Page, blocks: list[list], content: np.ndarray) -> int:
    """The number of the element that holds the article; 0 for the page."""
    held, holding = [0] * len(page.kind), [0] * len(page.kind)
    for b, is_content in zip(blocks, content):
        held[b[4]] += b[1] * int(is_content)
        holding[b[4]] += 1
    # An element is numbered after the one around it.
    for e in range(len(page.kind) - 1, 0, -1):
        if page.kind[e] not in INLINE:
            held[page.up[e]] += held[e]
            holding[page.up[e]] += holding[e]
    chain = [max((b for b, c in zip(blocks, content) if c), key=lambda b: b[1])[4]]
    while chain[-1]:
        chain.append(page.up[chain[-1]])
    best = 0
    for e in reversed(chain):
        if held[e] >= HOLDS * held[0] and (
                page.kind[e] == "article" or page.kind[e] in GROUPS and holding[e] > 1):
            best = e
            if page.kind[e] == "article":
                break
    return best


def _keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html (never null), host, and key, which rows alike in the first three share."""
    html = F.coalesce("html", F.lit(""))
    return pages.select("page_id", "url", html.alias("html")).select(
        "*", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST, 1)).alias("host")
    ).withColumn("key", F.xxhash64("page_id", "url", "html"))


def host_ratios(keyed: DataFrame) -> DataFrame:
    """key and ratios: the ratios that the paths of each page have on its host (a map by path)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(host, key, *sums) for host, key, html in zip(*(c.to_pylist() for c in batch.columns))
                   for sums in path_sums(Page(html))]
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                names=["host", "key", "path", "n", "chars", "marks"])

    # Both uses of the sums read what one pass over the pages wrote.
    sums = settled(keyed.select("host", "key", "html").mapInArrow(
        lean(run), "host string, key long, path long, n long, chars long, marks long"), "sums")
    pooled = sums.groupBy("host", "path").agg(
        *(F.sum(c).alias(c) for c in ("n", "chars", "marks"))).select(
        "host", "path", (F.col("chars") / F.col("n") * (1 + F.col("marks") / F.col("n"))).alias("ratio"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return (
        sums.select("host", "path", "key", F.pmod("key", F.lit(SALTS)).cast("int").alias("salt")).distinct()
        .hint("merge").join(pooled, ["host", "path", "salt"])
        .groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("path", "ratio"))).alias("ratios")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    shipped(pages.sparkSession)
    keyed = _keyed(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(Page(html), dict(ratios or ())) for html, ratios in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return keyed.hint("merge").join(host_ratios(keyed), "key", "left").select(
        "page_id", "url", "html", "ratios").mapInArrow(lean(run), schema)
