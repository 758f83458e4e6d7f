"""Main text of web pages by consensus on container paths.

1. Each page is parsed into blocks of text, each below a path of containers. A path is
   generalised: tags with their classes, digits in classes written ``0``. Blocks of menus,
   headers, footers, sidebars, notices, adverts, forms and comments are marked by tag, role
   or class. Every container is scored by the text of its unmarked blocks: a block counts
   fully for the container it stands in and half for the one above, links count against.
2. Pages vote in Spark: scores are summed by host and path, combined on the map side, and the
   path with the most votes wins its host.
3. Each page is extracted anew: the unmarked blocks below the winning path, or below the
   page's own best container where the page lacks that path.

A host with a third of all pages is a few rows of votes from each task; winners are one row a
host and are joined by broadcast if counted to be few, else by a join that Spark can split.

Null and empty pages give an empty text; so do pages without unmarked text. A null url is
the host "". Repeated rows are extracted each; null ids stay null. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.llm.store import broadcast_if_small, named, unnamed, written

BROADCAST_HOSTS = 100_000
TEXTS = "page_id long, url string, text string, n_chars long"

# Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br img".split())
DROPPED = frozenset(
    "head nav footer aside form script style noscript template iframe svg math button select option textarea object canvas video audio "
    "dialog menu title fieldset input".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies disqus dropdown footer gdpr header login masthead menu modal nav navbar navigation navi newsletter notice notices notification "
    "pager pagination popup promo promoted promotion reaction reactions recommended recommendations related replies reply respond search "
    "share sharing shares sidebar sidebars signup skip social sponsor sponsored sponsors subscribe subscription teaser toolbar topbar "
    "widget widgets".split())
SHAPING_WORDS = frozenset("has with no without after before below above is".split())
CONTENT = frozenset("article main".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_DIGITS = re.compile(r"\d+")
_SPLIT = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(text)} if text.strip() else {}


def _marked(tag: str, own: dict[str, str], inside_content: bool) -> bool:
    """Whether an element and all below it is no part of an article."""
    if tag in DROPPED or own.get("role", "").lower() in DROPPED_ROLES or "hidden" in own or own.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", own.get("style", ""), re.I):
        return True
    if tag in ("html", "body"):
        return False
    if tag == "header":
        return not inside_content
    for name in f"{own.get('class', '')} {own.get('id', '')}".split():
        words = [w.lower() for w in _SPLIT.split(name) if w]
        for k, word in enumerate(words):
            if word not in DROPPED_WORDS or (k and words[k - 1] in SHAPING_WORDS):
                continue
            if word == "header" and inside_content or tag in CONTENT and not word.startswith(("comment", "repl")):
                continue
            return True
    return False


class Block:
    """A piece of text: its words, the characters of them in links, and the containers above."""

    __slots__ = ("parts", "linked", "path", "marked")

    def __init__(self, path: tuple[str, ...], marked: bool):
        self.parts: list[str] = []
        self.linked, self.path, self.marked = 0, path, marked

    @property
    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order. Unclosed elements end where HTML ends them; stray end tags do nothing."""
    # Open elements: tag, path, marked, inside an article.
    stack: list[tuple[str, tuple[str, ...], bool, bool]] = [("", (), False, False)]
    out: list[Block] = []
    fresh, at, links = True, 0, 0

    def add(text: str) -> None:
        nonlocal fresh
        if fresh and text.strip():
            own = next(e for e in reversed(stack) if e[0] not in INLINE)
            out.append(Block(own[1], stack[-1][2]))
            fresh = False
        if not fresh:
            if stack[-1][2] and not out[-1].marked:  # a marked inline element within a block
                return
            out[-1].parts.append(text)
            if links:
                out[-1].linked += len(text)

    def close(index: int) -> None:
        nonlocal fresh, links
        if any(e[0] not in INLINE for e in stack[index:]):
            fresh = True
        links -= sum(e[0] == "a" for e in stack[index:])
        del stack[index:]

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            opened = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if opened and not (tag in INLINE and any(e[0] not in INLINE for e in stack[opened:])):
                close(opened)
            continue
        if tag == "br":
            add(" ") if not fresh else None
            continue
        own = _attributes(m[3])
        if tag in VOID:
            fresh = fresh or tag == "hr"
            continue
        if tag not in INLINE:
            paragraph = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == "p"), 0)
            if paragraph:
                close(paragraph)
            if tag in CLOSED_BY:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] in SCOPES[tag]:
                        break
                    if stack[i][0] in CLOSED_BY[tag]:
                        close(i)
                        break
        parent = stack[-1]
        marked = parent[2] or _marked(tag, own, parent[3])
        path = parent[1]
        if tag not in INLINE:
            classes = sorted(_DIGITS.sub("0", c) for c in own.get("class", "").split())
            path = (*path, ".".join([tag, *classes]))
            fresh = True
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((tag, path, marked, parent[3] or tag in CONTENT))
        links += tag == "a"
    return [b for b in out if b.text]


_HOLDERS = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "td", "th", "tr", "tbody", "blockquote", "pre", "dd", "dt", "dl", "figcaption", "figure", "table")


def _container(path: tuple[str, ...]) -> tuple[str, ...]:
    """The path without the elements that only hold a paragraph, list or table."""
    n = len(path)
    while n and path[n - 1].split(".")[0] in _HOLDERS:
        n -= 1
    return path[:n]


def scores(found: list[Block]) -> dict[tuple[str, ...], float]:
    """Score of every container with unmarked text."""
    out: dict[tuple[str, ...], float] = {}
    for b in found:
        if b.marked:
            continue
        worth = max(0, len(b.text) - 2 * b.linked)
        own = _container(b.path)
        out[own] = out.get(own, 0) + worth
        if own:
            out[own[:-1]] = out.get(own[:-1], 0) + worth / 2
    return out


def _best(own: dict[tuple[str, ...], float]) -> tuple[str, ...] | None:
    return min(own, key=lambda p: (-own[p], len(p), p)) if own else None


def extract(page: str | None, winner: tuple[str, ...] | None) -> str:
    """Unmarked text below the winning path, else below the page's own best container."""
    found = [b for b in blocks(page or "") if not b.marked]
    within = [b for b in found if winner is not None and b.path[: len(winner)] == winner]
    if not within and found:
        best = _best(scores(found)) or ()
        within = [b for b in found if b.path[: len(best)] == best]
    return "\n".join(b.text for b in within)


def _vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        tally: dict[tuple[str, str], float] = {}
        for host, page in zip(frame["host"], frame["html"], strict=True):
            own = scores(blocks(page or ""))
            total = sum(own.values())
            for path, score in own.items():
                if total:
                    key = (host, "\n".join(path))
                    tally[key] = tally.get(key, 0) + round(1000 * score / total)
        yield pd.DataFrame([(*k, v) for k, v in tally.items()], columns=["host", "path", "votes"])


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [
            extract(page, tuple(winner.split("\n")) if winner else None)
            for page, winner in zip(frame["html"], frame["winner"], strict=True)]
        yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def winners(pages: DataFrame) -> DataFrame:
    """(host, winner): the container path of each host, its elements joined by line breaks."""
    votes = pages.select("host", "html").mapInPandas(_vote, "host string, path string, votes long")
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    return sums.groupBy("host").agg(F.max_by("path", F.struct(F.col("votes"), F.col("path"))).alias("winner"))


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(named("page_id"), "url", "html", host.alias("host"))
    chosen = written(winners(rows))
    joined = rows.join(broadcast_if_small(chosen, chosen.count(), BROADCAST_HOSTS), "host", "left")
    return unnamed(joined.select("page_id", "url", "html", "winner").mapInPandas(_extract, TEXTS), "page_id")
