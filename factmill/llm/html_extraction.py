"""Main text of web pages by consensus over the pages of a host."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factmill.llm.common import bounded_broadcast, materialize, table

# Classes of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("nav footer aside form menu dialog button select option label fieldset iframe object canvas figure-nav head title".split())
CONTAINERS = frozenset("html body article main section div td th table tbody tr ul ol dl blockquote center header details figure".split())
BLOCKS = CONTAINERS | DROPPED | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre hr address figcaption caption summary hgroup thead tfoot noscript".split())
CLOSES_P = BLOCKS - {"td", "th", "tr", "tbody", "li", "dt", "dd", "html", "body", "head", "title", "option", "label", "button", "caption", "summary", "thead", "tfoot"}
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",)}
# Names of boilerplate, and words that may stand beside them in a class, as in site-footer or sidebar-left.
UNWANTED = frozenset(
    "ad ads advert adverts advertisement adsense adsbygoogle sponsor sponsored promo promotion cookie cookies consent gdpr footer related recommended share sharing social newsletter subscribe signup login"
    " comment comments commentlist disqus reply replies respond breadcrumb breadcrumbs pagination pager toolbar widget".split()
)
#: Names that layouts also put on what wraps the whole page, so that one which holds most of its text is none.
LAYOUT = frozenset("nav navbar navigation menu header masthead banner sidebar aside notice popup modal overlay skip hidden".split())
#: Of these, names that inside an article are the article's own.
OWN = frozenset("header masthead banner".split())
BESIDE = frozenset("site page top bottom left right main primary secondary global block box list links bar area section wrap wrapper container inner outer item items unit slot strip buttons form row".split())
#: Classes of the element that holds an article.
ARTICLES = frozenset("article post entry hentry story content".split())
#: Classes that make an element an article as its tag would, alone or beside each other, as in post-12 or type-post: its header is its own.
POSTS, BESIDE_POSTS = frozenset("article post entry hentry story blogpost".split()), frozenset("single full body type format standard".split())
UNWANTED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|svg|textarea|noscript)\b[^>]*+>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<[!?][^>]*+>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
DIGITS = re.compile(r"\d+")
PARTS = re.compile(r"[-_#\d]+")
ARTICLE_TAGS = ("article", "main")
#: Containers whose text passes on this share to the container around them.
PASSED_ON = 0.7
#: A layout name on an element with more than this share of the page's text means nothing.
MOST = 0.5
#: Containers that a path names; what lies deeper counts for the last of them.
DEEPEST = 48


@dataclass(slots=True)
class Block:
    path: str
    text: str
    linked: int
    title: bool = False


class _Node:
    __slots__ = ("tag", "path", "depth", "off", "link", "mark", "title", "article")

    def __init__(self, tag: str, path: str, depth: int, off: bool, link: bool, mark: int, title: bool, article: bool = False) -> None:
        self.tag, self.path, self.depth, self.off, self.link, self.mark, self.title, self.article = tag, path, depth, off, link, mark, title, article


def _unwanted(names: str, inside: bool) -> tuple[bool, bool]:
    """Whether a class or id names boilerplate, surely or by a layout name; each name is judged by all its parts."""
    layout = LAYOUT - OWN if inside else LAYOUT
    sure = maybe = False
    for name in names.lower().split():
        parts = [p for p in PARTS.split(name) if p]
        if parts and all(p in UNWANTED or p in layout or p in BESIDE for p in parts):
            sure |= any(p in UNWANTED for p in parts)
            maybe |= any(p in layout for p in parts)
    return sure, maybe


def _is_post(names: str) -> bool:
    """Whether one of the classes says that the element is an article."""
    for name in names.lower().split():
        parts = [p for p in PARTS.split(name) if p]
        if any(p in POSTS for p in parts) and all(p in POSTS or p in BESIDE_POSTS for p in parts):
            return True
    return False


def _flags(tag: str, attributes: str, inside: bool) -> tuple[str, bool, bool, bool]:
    """The generalised class of an element (digits as #), whether it is boilerplate, whether its name may mean so, and whether it is an article; inside: within one."""
    off, maybe, first, article = tag in DROPPED or (tag == "header" and not inside), False, "", tag in ARTICLE_TAGS
    if attributes and tag not in ("html", "body"):
        for m in ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "class":
                first = DIGITS.sub("#", value.split()[0]) if value.split() else ""
                article = article or (tag in CONTAINERS and _is_post(value))
            if name in ("class", "id") and tag not in ("article", "main"):
                found = _unwanted(value, inside)
                off, maybe = off or found[0], maybe or found[1]
            elif name == "role" and value.lower() in UNWANTED_ROLES or name == "hidden" and not value:
                off = True
    return (f"{tag}.{first}" if first else tag), off, maybe, article


def blocks(html: str) -> list[Block]:
    """The blocks of text outside boilerplate, in page order, with the generalised path of their container.

    A block is the text between two block-level tags: references decoded, white space runs as one space, trimmed.
    Unclosed and stray tags are taken as browsers take them, as far as blocks need it. The work is linear in the
    page, however deep its tags are nested.
    """
    found: list[tuple[Block, int]] = []
    stack = [_Node("", "", 0, False, False, 0, False)]
    open_: dict[str, int] = {}
    outer = [0]  # of each mark (an element with a layout name) the one around it; 0: none
    parts: list[str] = []
    linked, at, inside = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                found.append((Block(stack[-1].path, text, linked, stack[-1].title), stack[-1].mark))
            parts.clear()
        linked = 0

    def pop_to(n: int) -> None:
        nonlocal inside
        for node in stack[n:]:
            open_[node.tag] -= 1
            inside -= node.article
        del stack[n:]

    def last(tags: tuple[str, ...], stops) -> int:
        """The innermost open element of these tags, 0 if there is none before one of ``stops``."""
        if not any(open_.get(t) for t in tags):
            return 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in stops:
                return 0
        return 0

    for m in TAG.finditer(html):
        if m.start() > at and not stack[-1].off:
            piece = html[at : m.start()]
            parts.append(piece)
            if stack[-1].link:
                linked += len(piece)
        at = m.end()
        name = m[3]
        if not name:
            continue
        tag = name.lower()
        if m[2]:
            if tag in BLOCKS:
                flush()
            if k := last((tag,), () if tag in BLOCKS else CONTAINERS):
                pop_to(k)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if tag in CLOSES_P and (k := last(("p",), CONTAINERS)):
                pop_to(k)
            if tag in ENDED_BY and (k := last(ENDED_BY[tag], SCOPE[tag])):
                pop_to(k)
            if tag == "body" and stack[-1].tag == "head":
                pop_to(len(stack) - 1)
        if tag in VOID or m[4].endswith("/") and tag not in BLOCKS:
            continue
        top = stack[-1]
        label, off, maybe, article = _flags(tag, m[4], inside > 0)
        path, depth = top.path, top.depth
        if tag in CONTAINERS and depth < DEEPEST:
            path, depth = f"{path}/{label}", depth + 1
        mark = top.mark
        if maybe and not off:
            outer.append(mark)
            mark = len(outer) - 1
        open_[tag] = open_.get(tag, 0) + 1
        inside += article
        stack.append(_Node(tag, path, depth, top.off or off, top.link or tag == "a", mark, tag == "h1" or (top.title and tag not in BLOCKS), article))
    if at < len(html) and not stack[-1].off:
        parts.append(html[at:])
    flush()
    return _outside_layout(found, outer)


def _outside_layout(found: list[tuple[Block, int]], outer: list[int]) -> list[Block]:
    """The blocks that lie in no element with a layout name, but for those that hold most of the page's text."""
    if len(outer) == 1:
        return [b for b, _ in found]
    held = [0] * len(outer)
    for b, mark in found:
        held[mark] += len(b.text)
    total = sum(held)
    for mark in range(len(outer) - 1, 0, -1):  # an outer mark has the lower number
        held[outer[mark]] += held[mark]
    off = [False] * len(outer)
    for mark in range(1, len(outer)):
        off[mark] = off[outer[mark]] or held[mark] <= MOST * total
    return [b for b, mark in found if not off[mark]]


def article_path(path: str) -> str:
    """The path of the article around a container: its outermost article, else the nearest element whose class is an article's, else itself."""
    labels = path.split("/")
    for i, label in enumerate(labels):
        if label.partition(".")[0] == "article":
            return "/".join(labels[: i + 1])
    for i in range(len(labels) - 1, 0, -1):
        tag, _, name = labels[i].partition(".")
        if tag == "main" or any(p in ARTICLES for p in PARTS.split(name.lower())):
            return "/".join(labels[: i + 1])
    return path


def container_scores(found: list[Block]) -> dict[str, float]:
    """Text outside links for each container path; a container hands PASSED_ON of it to each one further out.

    The parts of an article count for the article, so none of them wins over the others.
    """
    scores: dict[str, float] = {}
    for b in found:
        value = max(0.0, len(b.text) - 2.0 * b.linked)
        path = article_path(b.path)
        while path and value > 0.01:
            scores[path] = scores.get(path, 0.0) + value
            path, value = path.rpartition("/")[0], value * PASSED_ON
    return scores


def text_under(found: list[Block], path: str | None) -> str:
    """The text of the blocks under ``path``, and of a title before them if they have none.

    Where the page has no text there, that under its own best container.
    """
    if not found:
        return ""
    under = lambda p: [i for i, b in enumerate(found) if b.path == p or b.path.startswith(p + "/")]
    inside = under(path) if path else []
    if not inside:
        scores = container_scores(found)
        if not scores:  # no container holds text of its own
            return " ".join(b.text for b in found)
        inside = under(max(sorted(scores), key=scores.__getitem__))
    if not any(found[i].title for i in inside):
        inside = [i for i in range(inside[0]) if found[i].title][-1:] + inside
    return " ".join(found[i].text for i in inside)


def _votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each page shares one vote among its containers within reach of the best; partial sums for each batch."""
    for batch in batches:
        votes: dict[tuple[str, str], float] = {}
        for host, html in zip(batch["host"], batch["html"], strict=True):
            scores = container_scores(blocks(html))
            top = max(scores.values(), default=0.0)
            for path, s in scores.items():
                if s >= 0.5 * top:
                    votes[host, path] = votes.get((host, path), 0.0) + s / top
        yield pd.DataFrame([(h, p, v) for (h, p), v in votes.items()], columns=["host", "path", "votes"])


def _extractor():
    @F.pandas_udf("string")
    def text_of(html: pd.Series, path: pd.Series) -> pd.Series:
        return pd.Series([text_under(blocks(h), p) for h, p in zip(html, path, strict=True)], dtype=object)

    return text_of


def host_paths(pages: DataFrame) -> DataFrame:
    """(vote_host, path): the container path that a host's pages agree on; the shorter, then the lesser, of ties."""
    votes = pages.select("host", "html").mapInPandas(_votes, "host string, path string, votes double").groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    best = F.row_number().over(W.partitionBy("host").orderBy(F.desc("votes"), F.length("path"), "path"))
    return votes.withColumn("r", best).where("r = 1").select(F.col("host").alias("vote_host"), "path")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, path of every row.

    The pages of a host (of its URL; pages without one vote together) vote on the generalised tag-class path of the
    main container; every page is then extracted under the winning path, or under its own best container if it has
    no text there. The table of winners is broadcast if it is small, else pages are joined to it by host, with hot
    hosts split by adaptive execution.

    Null, empty and tag-free html give what text there is (empty for none); null ids and URLs keep their rows,
    repeated rows keep a row each, other columns are ignored, an empty table gives an empty result.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    winners = materialize(host_paths(rows), "paths")
    joined = rows.join(bounded_broadcast(winners), F.col("host") == F.col("vote_host"), "left").select("page_id", "url", "path", "html")
    text = _extractor()("html", "path")
    return joined.select("page_id", "url", text.alias("text"), "path").select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op1_html_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
