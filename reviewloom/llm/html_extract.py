"""Main text of pages: the maximum-scoring run of words (positive) and tags (negative)."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.llm.common import column, text_of

#: Comments; elements whose content is no text; declarations; tags (quoted attributes may hold '>');
#: a tag cut off by the end of the page; text.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|template|noscript|svg|title|textarea|select|iframe|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|[^<]+|<",
    re.S | re.I,
)
NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: HTML elements that end a block of text, and those without content.
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol p pre section"
    " summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What is never main text: by element, and by the words of its class, id or role.
ASIDE_TAGS = frozenset("nav footer aside form button menu dialog".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies copyright disclaimer discussion disqus footer header login masthead menu"
    " modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted"
    " promotion recommended related replies reply respond share sharing sidebar signup social sponsor"
    " sponsored subscribe toolbar topbar widget".split()
)
CONTENT_TAGS = ("article", "main")
LISTS = frozenset("li ul ol menu".split())


@dataclass
class Piece:
    """A word run or a tag: its kind for scoring, its block, and its text."""

    kind: str
    words: int
    block: int
    aside: bool
    content: bool
    text: str


class _Tree:
    """Elements in the order of their opening tags, and which of them are open."""

    def __init__(self) -> None:
        self.names, self.parents, self.words = [""], [-1], [0]
        self.by_tag, self.by_name = [False], [False]
        self.stack = [0]
        self.open: Counter = Counter()
        self.lists: list[int] = []  # places in the stack of open lists and items

    def push(self, name: str, by_tag: bool, by_name: bool) -> None:
        node = len(self.names)
        self.parents.append(self.stack[-1])
        self.names.append(name)
        self.words.append(0)
        self.by_tag.append(by_tag)
        self.by_name.append(by_name)
        if name in LISTS:
            self.lists.append(len(self.stack))
        self.stack.append(node)
        self.open[name] += 1

    def pop(self) -> int:
        node = self.stack.pop()
        self.open[self.names[node]] -= 1
        if self.lists and self.lists[-1] == len(self.stack):
            self.lists.pop()
        return node

    def close(self, name: str) -> int | None:
        """Close the innermost element of a name and all within it; None without one."""
        if not self.open[name]:
            return None
        while self.names[node := self.pop()] != name:
            pass
        return node

    def content(self) -> bool:
        return any(self.open[name] for name in CONTENT_TAGS)

    def settle(self) -> tuple[list[bool], list[bool], list[bool]]:
        """For each element whether it, or one around it, stands aside, is content, is a link.

        The words of a class never put a page's content aside: not the ``article`` or ``main`` elements
        with at least half the words of the largest, nor what is around them; without such elements, not
        those that hold most of the page's words.
        """
        names, parents = self.names, self.parents
        for node in range(len(names) - 1, 0, -1):
            self.words[parents[node]] += self.words[node]
        largest = max((w for n, w in zip(names, self.words) if n in CONTENT_TAGS), default=0)
        kept = [False] * len(names)
        for node in range(len(names) - 1, -1, -1):
            if largest:
                kept[node] |= names[node] in CONTENT_TAGS and 2 * self.words[node] >= largest
            else:
                kept[node] = 2 * self.words[node] > self.words[0]
            kept[node] |= names[node] in ("html", "body")
            if kept[node] and node and largest:
                kept[parents[node]] = True
        aside, content, link = ([False] * len(names) for _ in range(3))
        for node in range(1, len(names)):
            up = parents[node]
            aside[node] = aside[up] or self.by_tag[node] or (self.by_name[node] and not kept[node])
            content[node] = content[up] or names[node] in CONTENT_TAGS
            link[node] = link[up] or names[node] == "a"
        return aside, content, link


def pieces(page: str) -> list[Piece]:
    """The page in reading order. Unclosed paragraphs and list items end where HTML ends them.

    Takes time in proportion to the page, however deep or unclosed its elements are.
    """
    found: list[tuple[str, int, int, int, str]] = []  # kind, words, block, element, text
    tree, block = _Tree(), 0
    for match in TOKEN.finditer(page):
        name = (match[3] or match[6] or "").lower()
        if not name:
            text = match.group()
            if text[0] == "<" and len(text) > 1:
                continue  # comment, declaration or element without text
            text = html.unescape(text)
            words = len(text.split())
            if words or text:
                tree.words[tree.stack[-1]] += words
                found.append(("word", words, block, tree.stack[-1], text))
            continue
        closing = bool(match[2] or match[5])
        if name in BLOCKS:
            block += 1
        elif name == "br":
            found.append(("space", 0, block, tree.stack[-1], " "))
        node = tree.stack[-1]
        if closing:
            closed = tree.close(name)
            node = node if closed is None else closed
        elif name not in VOID:
            if name in BLOCKS:
                # a paragraph, and what is open inside it, ends at the next block
                while tree.open["p"]:
                    tree.pop()
            if name == "li" and tree.lists and tree.names[tree.stack[tree.lists[-1]]] == "li":
                tree.close("li")
            named = NAMING.findall(match[4] or match[7] or "")
            tokens = set(re.findall(r"[a-z]+", " ".join(map("".join, named)).lower()))
            by_tag = name in ASIDE_TAGS or (name == "header" and not tree.content())
            tree.push(name, by_tag, bool(tokens & ASIDE_NAMES))
            node = tree.stack[-1]
        found.append(("tag:" + name, 0, block, node, "</" if closing or name in VOID else "<"))

    aside, content, link = tree.settle()
    out: list[Piece] = []
    for kind, words, at, node, text in found:
        if kind == "word":
            kind = "word:aside" if aside[node] else "word:link" if link[node] else "word"
            out.append(Piece(kind, words, at, aside[node], content[node], text))
        elif kind == "space":
            out.append(Piece(kind, 0, at, aside[node], content[node], text))
        else:
            opens_aside = text == "<" and aside[node] and not aside[tree.parents[node]]
            inside = content[node] and tree.names[node] not in CONTENT_TAGS
            out.append(Piece("tag:aside" if opens_aside else kind, 0, at, aside[node], inside, ""))
    return out


#: Scores without any labelled page.
DEFAULT = {"word": 1.0, "word:link": 0.2, "word:aside": -1.0, "tag": -1.0} | {
    f"tag:{name}": -0.2 for name in "b blockquote br em h1 h2 h3 h4 h5 h6 i p span strong".split()
}


def score(piece: Piece, weights: dict[str, float]) -> float:
    """What a piece adds to a run. Inside an ``article`` or ``main`` element, what stands aside, and is
    left out anyway, costs nothing, and a tag no more than half a word earns, so that neither ends a run
    there."""
    if piece.content and piece.aside:
        return 0.0
    if piece.words:
        return piece.words * weights[piece.kind]
    cost = weights.get(piece.kind, weights["tag"])
    return max(cost, -weights["word"] / 2) if piece.content else cost


def scored(found: list[Piece], weights: dict[str, float]) -> tuple[int, int]:
    """First and last index + 1 of the best contiguous run, by one linear scan; (0, 0) if none."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, piece in enumerate(found):
        if piece.kind == "space" or (not piece.words and not piece.kind.startswith("tag:")):
            continue
        if total <= 0:
            total, start = 0.0, i
        total += score(piece, weights)
        if total > best:
            best, span = total, (start, i + 1)
    return span


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks touched by the best run, in page order; what stands aside within it is left out."""
    found = pieces(page)
    start, end = scored(found, weights)
    inside = {p.block for p in found[start:end] if p.words and not p.aside}
    blocks: dict[int, list[str]] = {}
    for piece in found:
        if piece.block in inside and not piece.aside and piece.text:
            blocks.setdefault(piece.block, []).append(piece.text)
    texts = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n\n".join(t for t in texts if t)


def fit_weights(pages: DataFrame, max_pages: int = 5_000, html_col: str = "html") -> dict[str, float]:
    """Scores per kind of word and tag, from pages whose markup labels the content.

    Labelled pages are those with an ``article`` or ``main`` element; of these the at most
    ``max_pages`` different ones of least hash are read (the hashes are ranked, pages are not moved
    for it). A score is the smoothed log-odds of the kind inside and
    outside the labelled element, kept positive for words and negative for tags and asides. Counts
    are summed by Spark; one row per kind (element name in the sample) reaches the driver.
    """
    labelled = pages.select(text_of(pages, html_col).alias("html")).where(
        F.lower("html").rlike(r"<(article|main)[\s>]")
    )
    labelled = labelled.withColumn("hash", F.xxhash64("html"))
    least = labelled.select("hash").distinct().orderBy("hash").limit(max_pages)
    bound = least.agg(F.max("hash").alias("hash")).first()["hash"]
    chosen = labelled.where(F.col("hash") <= F.lit(bound))
    sample = chosen.groupBy("hash").agg(F.first("html").alias("html"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for page in batch["html"]:
                for piece in pieces(page):
                    if piece.words or piece.kind.startswith("tag:"):
                        seen[piece.kind, piece.content] += max(piece.words, 1)
            rows = [(kind, inside, n) for (kind, inside), n in seen.items()]
            yield pd.DataFrame(rows, columns=["kind", "inside", "n"])

    counts = sample.mapInPandas(count, "kind string, inside boolean, n long")
    n_in = F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("n_in")
    n_out = F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("n_out")
    weights = dict(DEFAULT)
    for kind, inside, outside in counts.groupBy("kind").agg(n_in, n_out).collect():
        odds = math.log((inside + 0.5) / (outside + 0.5))
        if kind == "word":
            weights[kind] = min(max(odds, 0.5), 2.0)
        elif kind == "word:link":
            weights[kind] = min(max(odds, 0.1), 1.0)
        elif kind == "word:aside":
            weights[kind] = min(max(odds, -3.0), -0.5)
        else:
            weights[kind] = min(max(odds, -6.0), -0.2)
    return weights


def extract(
    pages: DataFrame,
    weights: dict[str, float] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Per row: id, url, ``text`` (blocks joined by an empty line), ``n_chars``.

    Character references are decoded, white space within a block becomes one space. Null or empty
    pages, and pages without words, give an empty text; cut-off pages give what they hold. Rows are
    independent, in one pass without a shuffle; other columns are not read.
    """
    weights = fit_weights(pages, html_col=html_col) if weights is None else weights

    @F.pandas_udf(T.StringType())
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page, weights) for page in batch], dtype=object)

    out = pages.select(
        column(pages, id_col).alias(id_col),
        column(pages, url_col).alias(url_col),
        text(text_of(pages, html_col)).alias("text"),
    )
    return out.withColumn("n_chars", F.length("text").cast("long"))
