"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page becomes a sequence of tags and words. What is never main text whatever its words
(scripts, menus, page headers and footers, sidebars, forms, adverts, notices, reader
comments) is told by its element, role or class and taken out. Every word left scores
how often words in its place (nearest block element, linked or not) are main text on
labelled pages; every tag costs something, more the seldomer it stands inside main
text. One linear scan finds the contiguous region with the greatest sum; it is widened to
the declared container (``article``, ``main``) it lies in, or else to the innermost element
around it, short of the whole page, leaving out blocks that are mostly links.

Labelled pages are those that declare their text themselves, by one closed container,
unless others are given. The weights are sums over a fixed list of places, so a few
hundred numbers reach the driver, whatever the number of pages. Pages are parsed whole, one
at a time, in Arrow batches; nothing is shuffled but those sums.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML elements by what they do to text, and the words by which sites name what is not main text.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr
ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("""head script style title noscript template svg math iframe object canvas audio video nav header footer aside menu
form button select textarea dialog search map noembed noframes applet""".split())
SECTIONS = frozenset("article main section header footer nav aside body".split())
CONTAINERS = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog toolbar".split())
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted banner
cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login paywall
menu menus nav navbar navigation navi topbar breadcrumb breadcrumbs sidebar sidebars aside rail widget widgets header masthead footer
copyright comment comments commentlist disqus reply replies respond discussion share sharing social related recommended recommendations
search searchform toolbar pagination pager skip disclaimer form tags hidden""".split())
COMMENT_HINTS = frozenset("comment comments commentlist reply replies disqus discussion teaser card related".split())
NEGATIONS = frozenset("has no with without is not".split())

WORD, TAG = 1.0, 3.25  # scores without labelled pages
LEAST_TAG = 0.01  # what the mildest tag costs

_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+[^>]*)(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden|itemprop|aria-label)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|\Z)""", re.I)
_NAME_PARTS = re.compile(r"[\s]+")


class Tag:
    __slots__ = ("at", "close", "end", "match", "name", "rest")

    def __init__(self, name, close, rest, at, end):
        self.name, self.close, self.rest, self.at, self.end, self.match = name, close, rest, at, end, None


def tokens(page: str) -> list:
    """Tags and the (start, end, text) pieces between them; markup declarations and raw texts are left out."""
    out, at, skip = [], 0, 0
    for m in _MARK.finditer(page):
        if m.start() < skip:
            continue
        start = max(at, skip)
        if m.start() > start:
            out.append((start, m.start(), page[start:m.start()]))
        at = m.end()
        if m["cdata"]:
            out.append((m.start("cdata"), m.end("cdata"), m["cdata"].replace("&", "&amp;")))
        if not m["name"]:
            continue
        name = m["name"].lower()
        tag = Tag(name, bool(m["close"]), m["rest"], m.start(), m.end())
        out.append(tag)
        if name in RAW and not tag.close:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            skip = end.start() if end else len(page)
    start = max(at, skip)
    if start < len(page):
        out.append((start, len(page), page[start:]))
    return out


def match_tags(found: list) -> None:
    """Set ``match`` of each element's start tag to the place of its end tag, where there is one."""
    open_at: dict[str, list[int]] = {}
    stack: list[int] = []
    for k, t in enumerate(found):
        if not isinstance(t, Tag) or t.name in VOID:
            continue
        if not t.close:
            stack.append(k)
            open_at.setdefault(t.name, []).append(k)
            continue
        if not open_at.get(t.name):
            continue
        start = open_at[t.name][-1]
        while stack and stack[-1] >= start:  # elements inside without an end tag of their own end here
            open_at[found[stack.pop()].name].pop()
        found[start].match = k


def _attributes(tag: Tag) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(tag.rest)} if tag.rest.strip(" /") else {}


def _hinted(names: str, hints: frozenset) -> bool:
    for name in _NAME_PARTS.split(names):
        parts = re.split(r"[-_]+", name)
        if parts[0] in NEGATIONS:
            continue
        if parts[0] in hints or parts[-1] in hints:
            return True
    return False


def _is_boilerplate(tag: Tag) -> bool:
    if tag.name in NEVER:
        return True
    if tag.name in ("html", "body", "main"):
        return False
    a = _attributes(tag)
    if not a:
        return False
    names = f"{a.get('class', '')} {a.get('id', '')}"
    if tag.name == "article":
        return _hinted(names, COMMENT_HINTS)
    return (a.get("role") in ROLES or "hidden" in a or a.get("aria-hidden") == "true" or "advert" in a.get("aria-label", "")
            or re.search(r"display\s*:\s*none", a.get("style", "")) is not None or _hinted(names, HINTS))


def visible(found: list) -> list:
    """All tokens as (place, token, hidden); hidden ones stand in boilerplate elements.

    A boilerplate element without an end tag ends before the next section starts, or with the
    element it stands in, so one forgotten tag does not hide the page. An article or main
    element that opens right inside an element hidden by its class name alone is not hidden.
    """
    match_tags(found)
    out, until, by_name = [], -1, False
    parents: list[int] = []
    for k, t in enumerate(found):
        is_tag = isinstance(t, Tag)
        if until == -2 and is_tag and ((t.name in SECTIONS and not t.close) or (parents and found[parents[-1]].match == k)):
            until = -1
        if by_name and is_tag and not t.close and t.name in CONTAINERS and not _is_boilerplate(t):
            until = -1
        if until == -2 or k <= until:
            by_name = by_name and not (is_tag and t.close)
            out.append((k, t, True))
            continue
        by_name = False
        if is_tag and not t.close and t.name not in VOID:
            if _is_boilerplate(t):
                until = t.match if t.match is not None else -2
                by_name = t.name not in NEVER
                out.append((k, t, True))
                continue
            if t.match is not None:
                parents.append(k)
        while parents and found[parents[-1]].match <= k:
            parents.pop()
        out.append((k, t, False))
    return out


class Page:
    """Blocks of text and the scored sequence of one page.

    ``blocks`` holds (text, start, end, container, element around, more links than words) and ``sequence`` (place, block, words) for
    words, (tag name, None, container) for tags; a container is the number of the declared one around.
    With ``everything``, boilerplate stays in, as text outside any container.
    """

    def __init__(self, page: str, everything: bool = False):
        self.blocks: list[tuple[str, int, int, int, int, bool]] = []
        self.sequence: list[tuple] = []
        self.closed: set[int] = set()
        nearest, links, container = ["body"], 0, []
        parts, start, end, pending = [], None, None, []

        pending_inside = -1

        def flush():
            nonlocal start
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                n = len(self.blocks)
                linked = sum((w if p.endswith("/a") else -w) for p, w, _ in pending if w is not None) > 0
                self.blocks.append((text, start, end, pending_inside, around[-1] if around else -1, linked))
                self.sequence.extend((p, n, w) if w is not None else (p, None, c) for p, w, c in pending)
            else:
                self.sequence.extend((p, None, c) for p, w, c in pending if w is None)
            parts.clear()
            pending.clear()
            start = None

        found = tokens(page)
        around: list[int] = []  # block elements with an end tag, from the outside in
        self.outer: dict[int, int] = {}
        self.spans: dict[int, tuple[int, int]] = {}
        for k, t, hidden in visible(found):
            if hidden and not everything:
                continue
            inside = container[-1] if container and not hidden else -1
            if not isinstance(t, Tag):
                words = len(entities.unescape(t[2]).split())
                if words:
                    pending_inside = inside
                    pending.append((f"{nearest[-1]}{'/a' if links > 0 else ''}", words, inside))
                    start, end = t[0] if start is None else start, t[1]
                if words or start is not None:
                    parts.append(t[2])
                continue
            if t.name == "br":
                parts.append(" ")
            if t.name in BLOCKS:
                flush()
                if t.close:
                    if t.name in nearest[1:]:
                        while nearest.pop() != t.name:
                            pass
                elif t.name not in VOID:
                    if t.name == "p" and nearest[-1] == "p":
                        nearest.pop()
                    nearest.append(t.name)
                links = 0
            elif t.name == "a":
                links = 0 if t.close else 1
            while around and found[around[-1]].match <= k:
                around.pop()
            if t.name in BLOCKS and not t.close and t.match is not None:
                if t.name not in ("html", "body"):
                    self.outer[k], self.spans[k] = (around[-1] if around else -1), (t.at, found[t.match].at)
                    around.append(k)
            if t.name in CONTAINERS and not t.close and t.match is not None and not hidden:
                container.append(k)
                self.closed.add(k)
            kind = t.name if t.name in BLOCKS or t.name in ("a", "br", "img") else "other" if t.name in NEVER | VOID else "inline"
            pending.append((kind, None, inside))
            while container and found[container[-1]].match <= k:
                container.pop()
        flush()

    def tally(self) -> Counter:
        """(kind, place, inside) to how many, for a page that declares one container; empty for others."""
        out: Counter = Counter()
        if len(self.closed) == 1 and any(b[3] >= 0 for b in self.blocks):
            for place, block, x in self.sequence:
                if block is None:
                    out["tag", place, x >= 0] += 1
                else:
                    out["word", place, self.blocks[block][3] >= 0] += x
        return out

    def region(self, weights: dict) -> tuple[int, int, float]:
        """First block, last block and score of the best region; (0, -1, 0.0) if no region scores above 0."""
        best, total, first = (0, -1, 0.0), 0.0, None
        for place, block, x in self.sequence:
            if block is None:
                total -= weights.get(("tag", place), TAG)
            else:
                if total <= 0 or first is None:
                    total, first = 0.0, block
                total += x * weights.get(("word", place), WORD)
                if total > best[2]:
                    best = first, block, total
        return best

    def main_blocks(self, weights: dict) -> tuple[list[tuple], float]:
        """The blocks of the region, widened to the container that holds most of its words."""
        first, last, score = self.region(weights)
        if last < first:
            return [], 0.0
        size: Counter = Counter()
        for text, _, _, container, *_ in self.blocks[first:last + 1]:
            size[container] += len(text)
        container = max(size, key=lambda c: (size[c], -c))
        if container >= 0:
            return [b for b in self.blocks if b[3] == container], score
        shared = self._innermost(first, last)
        if shared < 0:
            return self.blocks[first:last + 1], score
        lo, hi = self.spans[shared]
        return [b for k, b in enumerate(self.blocks) if first <= k <= last or (lo <= b[1] < hi and not b[5])], score

    def _innermost(self, first: int, last: int) -> int:
        """The innermost closed element around all blocks of a region; -1 if that is the page."""
        chain, k = [], self.blocks[first][4]
        while k >= 0:
            chain.append(k)
            k = self.outer[k]
        depth, at = {k: i for i, k in enumerate(chain)}, 0
        for own in {b[4] for b in self.blocks[first:last + 1]}:
            while own >= 0 and own not in depth:
                own = self.outer[own]
            at = max(at, depth.get(own, len(chain)))
        return chain[at] if at < len(chain) else -1


def _tally(batches):
    total: Counter = Counter()
    for b in batches:
        for page in b.column(0).to_pylist():
            total.update(Page(page or "", everything=True).tally())
    keys = list(total)
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                      pa.array([k[2] for k in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())],
                                     names=["kind", "place", "inside", "n"])


def learn_weights(labelled: DataFrame) -> dict:
    """Scores of words and costs of tags by place, from pages (html) that declare their text in one container."""
    sums = labelled.select("html").mapInArrow(_tally, "kind string, place string, inside boolean, n long")
    rows = sums.groupBy("kind", "place").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("n"))
    out = {}
    for r in rows.collect():  # at most a row per kind and HTML element
        share = (r["inside"] + 0.5) / (r["n"] + 1.0)
        out[r["kind"], r["place"]] = share * WORD if r["kind"] == "word" else max(LEAST_TAG, TAG * (1.0 - share))
    return out


def _extract(weights: dict):
    def run(batches):
        for b in batches:
            rows = []
            for page in b.column(2).to_pylist():
                blocks, score = Page(page or "").main_blocks(weights)
                text = "\n".join(x[0] for x in blocks)
                rows.append((text, len(text), len(blocks), blocks[0][1] if blocks else None, blocks[-1][2] if blocks else None, score))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)] + [
                pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "html_start", "html_end", "score"])
    return run


def main_text(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_blocks, html_start, html_end (code points), score.

    ``labelled`` holds the pages (html) to learn from; by default all ``pages``, of which those with
    one declared container teach. Without any, words score 1 and tags cost 3.25. Null or empty html,
    and pages without words outside boilerplate, have an empty text and null places. Of equal regions the
    first is taken. Rows that repeat give repeated rows; null ids and urls pass through; an empty
    table gives no rows; other columns are ignored. A page is held whole, by one task.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    weights = learn_weights(rows if labelled is None else labelled)
    return rows.mapInArrow(_extract(weights), "page_id long, url string, text string, n_chars long, n_blocks long, "
                                              "html_start long, html_end long, score double")
