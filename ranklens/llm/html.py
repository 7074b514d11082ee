"""Main text of web pages by site template removal.

Every element's subtree is hashed (tag, classes, text, children).  Spark counts
on how many pages of its host each subtree stands; subtrees on many pages of a
host are its template and are deleted.  What is left of the page's article
(else of its main element, else of its body) is the main text, without elements
that by tag, role or class are navigation, headers, footers, sidebars, notices,
adverts, forms, scripts or comments.  Class names never take away the article
itself: where every article (else every main element) stands in elements that
its class or id or theirs mark, the marks of the largest one and of the elements
around it don't count.  Inside an article or main element plain
prose (headings, paragraphs, lists, tables) is never taken for a template, and
neither is a subtree with most of the article's text: pages may share passages.

The template of a host is a list of at most ``subtrees of a page / share``
hashes; hosts are joined to their pages under salted keys, so a host with a
third of all pages is spread.  Null and empty pages, and pages without a text,
give an empty text.  A null url counts as host ''.  Pages are judged row by
row: repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 32

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_NEVER = frozenset("script style noscript template head title nav footer aside form button select option textarea input iframe object svg canvas menu dialog label".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
#: Parts of class names and ids that mark what isn't the article.
_CHROME = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar side menu nav navbar navigation breadcrumb breadcrumbs"
    " comment comments commentlist disqus reply replies respond share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay footer masthead topbar widget widgets toolbar pagination pager skip"
    .split()
)
_ROOTS = frozenset("html body article main".split())
_WRAPPERS = frozenset("div section header figure details fieldset span address".split())
#: A start tag closes the open elements of these names that stand directly before it.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("html body article main section div ul ol dl table td th blockquote aside nav header footer form".split())
_PARTS = re.compile(r"[^a-z0-9]+")


class _Node:
    __slots__ = ("tag", "parent", "skip", "region", "hasher", "digest", "size", "never", "marks", "weight")

    def __init__(self, tag: str, parent: _Node | None, skip: bool, region: int, seed: str, never: bool = False, marks: tuple[int, ...] = ()):
        self.tag, self.parent, self.skip, self.region = tag, parent, skip, region
        self.hasher, self.digest, self.size = xxhash.xxh3_64(seed), 0, 0
        # skipped by tag or role; numbers of the marked elements among this and its parents; characters, skipped by marks or not
        self.never, self.marks, self.weight = never, marks, 0


class _Page(HTMLParser):
    """The page's elements with their hashes, and its blocks of text with the element that holds each."""

    def __init__(self, unmarked: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.unmarked, self.number = unmarked, 0
        self.mains: list[tuple[_Node, int]] = []
        self.stack = [_Node("", None, False, 0, "")]
        self.nodes: list[_Node] = []
        self.blocks: list[tuple[_Node, str]] = []
        self.pieces: list[str] = []
        self.regions = {0}

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                top = self.stack[-1]
                self.blocks.append((top, text))
                top.hasher.update(text)
                top.size += len(text)

    def _close(self) -> None:
        node = self.stack.pop()
        node.digest = node.hasher.intdigest()
        up = self.stack[-1]
        up.hasher.update(node.digest.to_bytes(8, "little"))
        up.size += node.size
        up.weight += node.weight
        self.nodes.append(node)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _VOID:
            if tag == "br":
                self.pieces.append(" ")
            elif tag == "hr":
                self._flush()
            return
        if tag in _BLOCK:
            self._flush()
            self._end_open("p")
            for name in _CLOSES.get(tag, ()):
                self._end_open(name)
        up, named = self.stack[-1], dict(attrs)
        marks = " ".join(str(named.get(k) or "") for k in ("class", "id")).lower()
        region = 2 if tag == "article" else 1 if tag == "main" or named.get("role") == "main" else 0
        own = tag in _NEVER or tag == "header" and not up.region or (named.get("role") or "").lower() in _ROLES or "hidden" in named
        self.number += 1
        marked = bool(marks) and tag not in ("html", "body") and self.number not in self.unmarked and not _CHROME.isdisjoint(_PARTS.split(marks))
        skip = up.skip or own or marked
        node = _Node(tag, up, skip, max(region, up.region), f"{tag} {marks}", up.never or own, (*up.marks, self.number) if marked else up.marks)
        if region and not node.never:
            self.mains.append((node, region))
        if not skip:
            self.regions.add(node.region)
        self.stack.append(node)

    def _end_open(self, tag: str) -> None:
        """Ends an open element of this name unless an element that bounds it was opened since."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                while len(self.stack) > k:
                    self._close()
                return
            if self.stack[k].tag in _SCOPE:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK:
            self._flush()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                while len(self.stack) > k:
                    self._close()
                return
            if tag not in _BLOCK and self.stack[k].tag in _SCOPE:
                return

    def handle_data(self, data: str) -> None:
        if not self.stack[-1].never:
            self.stack[-1].weight += len(data)
        if not self.stack[-1].skip:
            self.pieces.append(data)

    def finish(self) -> None:
        self.close()
        self._flush()
        while len(self.stack) > 1:
            self._close()


def _held(page: _Page) -> frozenset[int]:
    """Numbers of the marked elements that are or hold the page's article (else its main element), if no other is free of marks."""
    free = max((n.weight for n, _ in page.mains if not n.marks), default=0)
    for kind in (2, 1):
        nodes = [n for n, region in page.mains if region == kind]
        if not all(n.marks for n in nodes):
            break
        best = max(nodes, key=lambda n: n.weight, default=None)
        if best is not None and 2 * best.weight > free:  # else these are comments beside the main text
            return frozenset(best.marks)
    return frozenset()


def parse(html: str) -> _Page:
    page = _Page()
    page.feed(html)
    page.finish()
    held = _held(page)
    if held:
        page = _Page(held)
        page.feed(html)
        page.finish()
    return page


def _deletable(node: _Node, best: int, whole: int) -> bool:
    if node.tag in _ROOTS or not node.tag:
        return False
    return not best or node.tag in _WRAPPERS and 2 * node.size < whole


def _candidates(page: _Page) -> set[int]:
    """Hashes of the elements that can be part of a template: block elements, and never a page's root or prose of its article."""
    best = max(page.regions)
    return {n.digest for n in page.nodes if n.tag not in _ROOTS and (n.tag in _BLOCK or n.tag in _WRAPPERS) and (n.region < best or n.skip or not best or n.tag in _WRAPPERS)}


def text_of(page: _Page, template: frozenset[int] = frozenset()) -> str:
    """The blocks of the page's main region outside the template, one line each."""
    best = max(page.regions)
    whole = sum(len(t) for n, t in page.blocks if n.region == best)
    out = []
    for holder, text in page.blocks:
        if holder.region < best or holder.skip:
            continue
        node: _Node | None = holder
        while node is not None and not (node.digest in template and _deletable(node, best, whole)):
            node = node.parent
        if node is None:
            out.append(text)
    return "\n".join(out)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ?, # or the end, A-Z lower-cased; '' without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def templates(pages: DataFrame, share: float = 0.2, min_pages: int = 3) -> DataFrame:
    """(host, subtrees): per host the hashes of the subtrees on at least ``min_pages`` and ``share`` of its pages.

    ``pages`` has the columns url and html.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, found = [], []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html")):
                for d in {0} | {_signed(x) for x in _candidates(parse(html.as_py() or ""))}:  # 0 counts the page
                    hosts.append(host)
                    found.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.int64())], ["host", "subtree"])

    seen = pages.select(F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(hashes, "host string, subtree long")
    # a subtree below min_pages is no template whatever its host has, so little is left to be joined with the hosts' totals
    counts = seen.groupBy("host", "subtree").count().where(F.col("count") >= min_pages)
    per_host = counts.groupBy("host").agg(F.max(F.when(F.col("subtree") == 0, F.col("count"))).alias("pages"), F.collect_list(F.struct("subtree", "count")).alias("all"))
    common = F.filter("all", lambda x: (x["subtree"] != 0) & (x["count"] >= F.col("pages") * share))
    return per_host.select("host", F.transform(common, lambda x: x["subtree"]).alias("subtrees"))


def main_text(pages: DataFrame, share: float = 0.2, min_pages: int = 3) -> DataFrame:
    """(page_id, url, text, n_chars) of every page of (page_id, url, html)."""
    salted = templates(pages, share, min_pages).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    src = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    src = src.withColumn("host", F.coalesce(host_of(F.col("url")), F.lit(""))).withColumn("salt", F.pmod(F.xxhash64("page_id", F.length("html")), F.lit(SALTS)).cast("int"))
    joined = src.join(salted, ["host", "salt"], "left").select("page_id", "url", "html", "subtrees")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [text_of(parse(h.as_py() or ""), frozenset(x & (1 << 64) - 1 for x in s.as_py() or ())) for h, s in zip(part.column("html"), part.column("subtrees"))]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    types = {f.name: f.dataType.simpleString() for f in src.schema}
    return joined.mapInArrow(extract, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
