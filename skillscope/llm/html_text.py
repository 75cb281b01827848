"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one per block element, in page order. Lines of menus, headers, footers,
sidebars, notices, adverts, forms and reader comments weigh nothing; any other line weighs its
characters outside links, and, where the page names its content element (``article``, ``main``), only
lines inside it weigh anything. (A page whose windows all stay below the threshold takes its highest
window for it, and inside a content element any weight, so that a short text is not lost; a content element
of links alone counts them as text.) Sums over sliding windows of ``WINDOW`` lines then show where text
surges (a line with weight whose window reaches the threshold) and where it dives (a window without
weight); the unexcluded lines between the two are the text. Inside a content element the text reaches back
from the surge to the first line with weight since the last dive, so that no heading is lost. Character references are decoded, white
space inside a line becomes one blank, and lines are joined by a line break.

Defined results: a null, empty or text-free page gives an empty string of 0 characters. Markup that
ends early closes at the end of the page, a head where its end or anything else of the body comes. Elements that
are noise only by a class or id name, and forms, exclude nothing where they hold the content element (if several
do, the one that the fewest of them enclose) or all the text of the page. A null ``page_id`` or ``url`` is carried through, and repeated
rows repeat their result. Each page is handled on its own, whole, in one pass; other columns are
not read.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from skillscope.llm.shipping import ship

WINDOW = 3
MIN_SURGE = 60  # characters in a window

# Element names of HTML by what they mean here.
RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|audio|video|title|textarea|select|button"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
EXCLUDED = frozenset("nav aside footer form dialog menu".split())
CONTENT = frozenset(("article", "main"))
ATTRIBUTES = frozenset("class id role itemprop hidden".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form note".split())
NOISE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice notification popup promo promoted "
    "related share sharing sidebar social sponsor sponsored subscribe widget".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?P<own>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+|[^>]*)(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)", re.S | re.I)
_RAW_ENDS = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in RAW.split("|")}
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")


def _self_closed(attrs: str) -> bool:
    """Whether the tag ends in a slash that is no part of an unquoted value."""
    if not attrs.endswith("/"):
        return False
    value = attrs[attrs.rfind("=") + 1:].lstrip()
    return "=" not in attrs or len(value.split()) > 1 or "\"" in value or "'" in value


def _judge(name: str, attrs: str, in_content: bool) -> tuple[bool, bool, bool]:
    """Whether an element is noise, is noise unless it holds the page's content, and names the content."""
    noise = name in EXCLUDED - {"form"} or (name == "header" and not in_content)
    doubted = name == "form"
    content = name in CONTENT
    if attrs and not attrs.isspace():
        for key, value in _ATTRIBUTE.findall(attrs):
            key = key.lower()
            if key not in ATTRIBUTES:
                continue
            words = set(re.split(r"[^a-z0-9]+", value.lower()))
            if key == "hidden":
                noise = True
            elif key == "role":
                noise = noise or bool(words & NOISE_ROLES)
                content = content or "main" in words
            elif key == "itemprop":
                content = content or "articlebody" in words
            elif name not in ("html", "body", "main") and words & NOISE_NAMES:
                doubted = True
    return noise, doubted and not noise, content


class _Lines:
    """Collects the page's lines as (text, weight, in a content element, number of the doubted element around it,
    excluded). Doubted elements are noise by their names alone; 0 stands for none."""

    def __init__(self) -> None:
        self.done: list[tuple[str, int, bool, int, bool]] = []
        self.parts: list[str] = []
        self.link_chars = 0
        self.stack: list[tuple[str, bool, int | None, bool]] = []
        self.noise = self.content = self.links = self.doubted = 0
        self.outer, self.depth = [0], [0]  # of each doubted element

    def text(self, piece: str) -> None:
        self.parts.append(piece)
        if self.links:
            self.link_chars += len(piece)

    def flush(self) -> None:
        if self.parts:
            line = " ".join(references.unescape("".join(self.parts)).split())
            if line:
                self.done.append((line, max(0, len(line) - self.link_chars), self.content > 0, self.doubted, self.noise > 0))
            self.parts, self.link_chars = [], 0

    def open(self, name: str, attrs: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if name not in INLINE:
            self.flush()
        if name in VOID or name == "head" or _self_closed(attrs):
            return
        noise, doubted, content = _judge(name, attrs, self.content > 0)
        if (noise or doubted) and name in INLINE:
            self.flush()
        self.stack.append((name, noise, self.doubted if doubted else None, content))
        if doubted:
            self.outer.append(self.doubted)
            self.depth.append(self.depth[self.doubted] + 1)
            self.doubted = len(self.outer) - 1
        self.noise, self.content = self.noise + noise, self.content + content
        self.links += name == "a"

    def close(self, name: str) -> None:
        if name not in INLINE:
            self.flush()
        depth = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == name), None)
        if depth is None or (name in INLINE and any(n not in INLINE for n, *_ in self.stack[depth:])):
            return
        for gone, noise, outer, content in reversed(self.stack[depth:]):
            if noise or outer is not None:
                self.flush()
            if outer is not None:
                self.doubted = outer
            self.noise, self.content = self.noise - noise, self.content - content
            self.links -= gone == "a"
        del self.stack[depth:]

    def judged(self) -> list[tuple[str, int, bool, bool]]:
        """The lines as (text, weight, in a content element, excluded). The doubted elements around the content that the
        fewest of them enclose exclude nothing; on a page that names no content, around the line fewest enclose."""
        open_to = [(self.depth[d], d, weight, content) for _, weight, content, d, noise in self.done if not noise]
        seen = ([x for x in open_to if x[2] and x[3]] or [x for x in open_to if x[3]] or [x for x in open_to if x[2]])
        least = min((x[0] for x in seen), default=0)
        holds = {0}
        for depth, d, *_ in seen:
            while depth == least and d not in holds:
                holds.add(d)
                d = self.outer[d]
        return [(text, weight, content, noise or d not in holds) for text, weight, content, d, noise in self.done]


def page_lines(page: str) -> list[tuple[str, int, bool, bool]]:
    lines, at = _Lines(), 0
    while token := _TOKEN.search(page, at):
        if token.start() > at:
            lines.text(page[at:token.start()])
        at = token.end()
        if token["name"] is not None:
            name = token["name"].lower()
            if token["end"]:
                lines.close(name)
            else:
                lines.open(name, token["attrs"])
        elif token["raw"] is not None and not _self_closed(token["own"]):
            at = _RAW_ENDS[token["raw"].lower()].search(page, at).end()
    lines.text(page[at:])
    lines.flush()
    return lines.judged()


def main_text(page: str | None, window: int = WINDOW, min_surge: int = MIN_SURGE) -> str:
    """The lines between surges and dives of one page."""
    lines = page_lines(page or "")
    named = any(content and not noise for _, _, content, noise in lines)
    usable = [not noise and (content or not named) for _, _, content, noise in lines]
    weights = [weight if use else 0 for (_, weight, _, _), use in zip(lines, usable, strict=True)]
    if named and not any(weights):
        weights = [len(line[0]) if use else 0 for line, use in zip(lines, usable, strict=True)]
    sums = [sum(weights[i:i + window]) for i in range(len(weights))]
    highest = max(sums, default=1)
    least = min_surge if highest >= min_surge else 1 if named else highest
    kept, lead, inside = [], [], False
    for line, weight, total, use in zip(lines, weights, sums, usable, strict=True):
        if not total:
            lead, inside = [], False
        elif not inside and weight and total >= least:
            kept.extend(lead)
            lead, inside = [], True
        if inside and use:
            kept.append(line[0])
        elif named and use and (weight or lead):
            lead.append(line[0])
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    ship()
    rows = pages.selectExpr("CAST(page_id AS long) page_id", "CAST(url AS string) url", "CAST(html AS string) html")
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
