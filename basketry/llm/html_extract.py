"""Main text of web pages by consensus paths of their hosts.

Each page is cut into tags once; every element that may hold the article is scored by the running text that its
blocks hold, less what stands in links. A page votes for the generalised tag-class path of its best container;
votes are summed per host in Spark, which leaves one row per host and path. The pages are then read again, and the
text is taken from the container that matches the host's best path; a page that has none of the host's paths (or
whose best container holds several times as much) keeps its own container.

Left out in all containers: script, style and other hidden elements, navigation, page headers and footers, asides, forms, and
elements whose class, id or role names a menu, advert, notice, sidebar, comment section and so on. Text that stands
in no article at all is only taken if nothing else is there.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from basketry.llm.common import stored, without

# A quote only quotes right after an equals sign; elsewhere it is a character like any other.
TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:\"[^\"]*(?:\"|$)|'[^']*(?:'|$))?)*)(?:>|$)", re.DOTALL)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.DOTALL)

# Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style noscript template textarea title iframe object svg math canvas audio video map select datalist "
    "button form nav footer aside menu dialog noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body dd dt html legend li summary tbody td tfoot th thead tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CONTAINER = frozenset("article main section div td body blockquote".split())
SCOPES = {  # an opening tag ends these open elements, up to these parents
    "li": ("li", ("ul", "ol", "menu", "dir")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)),
    "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")), "tbody": ("tr td th tbody thead tfoot", ("table",)),
    "option": ("option", ("select",)),
}
# Words in class, id and role that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion outbrain taboola "
    "menu menubar nav navbar navigation breadcrumb breadcrumbs pager pagination skip toolbar topbar "
    "sidebar sidebars widget widgets rail related recommended recommendations trending "
    "header masthead footer copyright legal colophon "
    "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription paywall "
    "signup login share sharing social "
    "comment comments commentlist disqus respond reply replies reactions discussion "
    "complementary contentinfo search hidden".split())
# Those of them that are also titles of an article's own sections, from which ids are made.
TITLES = frozenset(
    "discussion legal search related recommended recommendations notice notices header banner alert promotion social copyright "
    "reactions sharing subscription navigation trending reply comment complementary".split())
ARTICLE_WORDS = frozenset(
    "article articlebody post entry story content main body text blogpost maincontent postcontent entrycontent".split())
WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


class Element:
    __slots__ = ("tag", "path", "parent", "hidden", "article", "texts", "score", "link", "n")

    def __init__(self, tag: str, path: str, parent: Element | None, hidden: bool, article: bool, link: bool):
        self.tag, self.path, self.parent, self.hidden, self.article, self.link = tag, path, parent, hidden, article, link
        self.score = 0.0
        self.n = 0


class Page(NamedTuple):
    blocks: list[tuple[Element, str]]  # the element that a block stands in, and its text
    containers: list[Element]


def _words(attributes: dict[str, str], names: tuple[str, ...] = ("class", "id", "role", "itemprop")) -> set[str]:
    named = " ".join(attributes.get(k, "") for k in names)
    return {w.lower() for w in WORD.findall(named)} | {re.sub(r"[^a-z]", "", w.lower()) for w in named.split()}


def _label(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in attributes.get("class", "").split()})
    return ".".join([tag, *classes])


def parse(text: str) -> Page:
    """Blocks and scored containers of a page; unclosed and unmatched tags are taken as browsers take them."""
    root = Element("#", "", None, False, False, False)
    stack, blocks, containers = [root], [], []
    pieces: list[str] = []
    home, linked, blank = root, 0, True

    def flush() -> None:
        nonlocal linked, blank
        joined = " ".join("".join(pieces).split())
        pieces.clear()
        blank = True
        if joined:
            blocks.append((home, joined))
            value = max(0, len(joined) - 2 * linked)
            home.n += value
            if not home.hidden:
                share, at = 1.0, home
                while at is not None and share > 0.2:
                    if at.tag in CONTAINER:
                        at.score += share * value
                        share /= 2
                    at = at.parent
        linked = 0

    def add(raw: str, decode: bool = True) -> None:
        nonlocal home, linked, blank
        if not raw:
            return
        value = html.unescape(raw) if decode and "&" in raw else raw
        top = stack[-1]
        if top.hidden:
            return
        if blank:
            blank = not value.strip()
            home = top
            while home.parent is not None and home.tag not in BLOCK:
                home = home.parent
        pieces.append(value)
        if top.link:
            linked += len(value.strip())

    def close_to(index: int) -> None:
        if any(e.tag in BLOCK for e in stack[index:]):
            flush()
        del stack[index:]

    at, end = 0, len(text)
    while at < end:
        found = TAG.search(text, at)
        if found is None:
            add(text[at:])
            break
        add(text[at:found.start()])
        at = max(found.end(), found.start() + 1)
        if found[1] is not None:
            add(found[1], False)
        if not found[3]:
            continue
        tag = found[3].lower()
        if found[2]:
            if tag in ("body", "html"):
                continue
            if tag == "br":
                pieces.append(" ")
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close_to(i)
                    break
                if tag not in BLOCK and stack[i].tag in BLOCK:
                    break
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close_to(i)
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in SCOPES:
            ends, bounds = SCOPES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in bounds:
                    break
                if stack[i].tag in ends.split():
                    close_to(i)
                    if tag not in ("tr", "tbody", "td", "th"):
                        break
        if tag == "body" and len(stack) > 1 and stack[-1].tag == "head":
            close_to(len(stack) - 1)
        if tag in BLOCK:
            flush()
        if tag in VOID:
            continue
        attributes = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(found[4])} if found[4] else {}
        parent = stack[-1]
        words = _words(attributes) if attributes else set()
        article = parent.article or tag in ("article", "main") or bool(words & ARTICLE_WORDS and tag in CONTAINER and tag != "body")
        hidden = parent.hidden or tag in HIDDEN or tag == "header" and not parent.article \
            or "hidden" in attributes or attributes.get("aria-hidden") == "true" \
            or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        if not hidden and words & BOILERPLATE and tag not in ("html", "body", "article", "main", "h1"):
            # "entry-header" in an article or "content-with-sidebar" around one name the article's own parts
            named = words & BOILERPLATE - ({"header"} if parent.article else set())
            if parent.article:
                # Headings belong to it, and ids are often made from them: there only a whole name that is no title counts.
                ids = {re.sub(r"[^a-z]", "", attributes.get("id", "").lower())} & BOILERPLATE - TITLES
                named = set() if tag in HEADINGS else named & (_words(attributes, ("class", "role", "itemprop")) | ids)
            hidden = bool(named) and not (tag in CONTAINER and words & {"content", "main", "article"} and not words & {"ad", "ads", "comment", "comments"})
        if tag in RAW or tag == "plaintext":
            stop = re.compile(f"</{tag}\\s*>?", re.IGNORECASE).search(text, at)
            at = stop.end() if stop else end
            continue
        if found[4].rstrip().endswith("/") and tag not in BLOCK:
            continue
        path = f"{parent.path}/{_label(tag, attributes)}" if tag in BLOCK else parent.path
        element = Element(tag, path, parent, hidden, article, parent.link or tag == "a")
        stack.append(element)
        if tag in CONTAINER and not hidden:
            containers.append(element)
    flush()
    return Page(blocks, containers)


def best(page: Page) -> Element | None:
    """The container with the most running text of its own blocks; inside an article element counts for more."""
    ranked = [(e.score * (3 if e.tag == "article" else 2 if e.tag == "main" else 1.5 if e.article else 1), -i, e)
              for i, e in enumerate(page.containers) if e.score > 0]
    return max(ranked)[2] if ranked else None


def _inside(element: Element | None, container: Element) -> bool:
    while element is not None:
        if element is container:
            return True
        element = element.parent
    return False


def text_of(page: Page, path: str | None) -> str:
    """Text of the containers at ``path``, else of the page's own best container, else of all blocks in sight."""
    own = best(page)
    chosen = [own] if own is not None else []
    if path is not None and (at := [e for e in page.containers if e.path == path and e.score > 0]):
        if own is None or sum(e.score for e in at) * 4 >= own.score:
            chosen = at
    if not chosen:
        return " ".join(t for e, t in page.blocks if not e.hidden)
    return " ".join(t for e, t in page.blocks if not e.hidden and any(_inside(e, c) for c in chosen))


def host(url: str = "url"):
    """Host of a URL in lower case; the empty host of a null or odd URL is one like any other."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def consensus(pages: DataFrame, url: str = "url", markup: str = "html") -> DataFrame:
    """The winning path of each host: host, path, votes (pages), strength (sum of scores). Ties go to the first path.

    Pages without any container don't vote. Votes are summed in each task first, so a host with a third of all
    pages costs one row per task and path.
    """
    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [best(parse(h)) if h else None for h in batch["markup"]]
            yield pd.DataFrame({"host": batch["host"], "path": [e.path if e else None for e in found],
                                "score": [e.score if e else 0.0 for e in found]}).dropna()

    votes = pages.select(host(url).alias("host"), F.col(markup).cast("string").alias("markup")).mapInPandas(
        vote, "host string, path string, score double")
    summed = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("score").alias("strength"))
    first = W.partitionBy("host").orderBy(F.desc("votes"), F.col("path"))
    return summed.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")


def extract(pages: DataFrame, url: str = "url", markup: str = "html", to: str = "text") -> DataFrame:
    """``pages`` with the article text in ``to``; empty if there is none or the page is null.

    Character references are decoded, white space inside a block becomes one space, blocks are joined in page order
    by one space. Repeated rows get equal texts (and a vote each); a column named ``to`` is replaced. Pages of any length are parsed whole, in
    time that grows with their length.
    """
    winners = stored(consensus(pages, url, markup).select("host", "path"), "paths")

    @F.pandas_udf("string")
    def take(markups: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([text_of(parse(h), p) if h else "" for h, p in zip(markups, paths)], dtype=object)

    kept = without(pages, to) if to != markup else pages
    # By place, so that no name can clash.
    placed = kept.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept.columns)), host(url).alias("host"),
                         F.col(markup).cast("string").alias("markup"))
    joined = placed.join(winners, "host", "left").withColumn("found", take("markup", "path"))
    columns = [F.col("found" if c == to else f"c{i}").alias(c) for i, c in enumerate(kept.columns)]
    return joined.select(*columns, *([] if to in kept.columns else [F.col("found").alias(to)]))
