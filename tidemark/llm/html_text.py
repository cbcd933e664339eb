"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element, each with the length of its text; what is not article by its element,
role or class name (menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) keeps its line
with length zero, as do lines outside a marked article that are mostly links.  Lengths are summed over sliding windows of
lines.  Text surges where the sum passes the threshold and dives where it falls to nothing; lines between surge and dive
are kept, in page order.  Lines of zero length don't end what they stand in: lines of any length beyond them belong to the
surge if they lie in the element that holds its lines, and lines of links do if text of the surge follows, or if they have
words outside their links.  A marked element (<article>, <main>) in which text surges is what holds that surge, from its
first line to its last; one without a surge (a card of another story) is left out.  Its characters weigh MARK times, and text
in and outside such elements has to surge by itself.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow, column, slices

#: Lines in a window; characters that mark a surge; weight of characters in a marked element.
WINDOW, SURGE, MARK = 3, 86, 4

_RAW = "script|style|template|noscript|textarea|select|iframe|svg|title|head"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW.split("|")}
_BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody tfoot thead tr ul".split())
_FRAMES = frozenset("nav header footer aside".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NOT_ARTICLE = frozenset("nav footer aside form menu dialog button search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Names of what is no article wherever they stand in a class or id ("post-comments"), but after a word of _LACKS.
_NAMES = frozenset(
    "ad ads adv advert advertisement adsense sponsor sponsored promo promotion breadcrumb breadcrumbs cookie cookies consent gdpr popup modal share sharing newsletter signup login "
    "comment comments comentarios kommentare commentaires reply replies respond disqus".split()
)
#: Names of what is no article if they are the whole name, and may be none in a longer one ("related-posts", but "social-studies").
_OFTEN = frozenset("notice notices overlay social related recommended subscribe subscription discussion masthead pagination pager tags skip".split())
_LACKS = frozenset("has have no not with without hide".split())
#: Names of parts of a layout, which wrappers of the article bear too ("has-sidebar", "content-sidebar-wrap"): they count as
#: a whole name, or where the name has nothing but such parts and the words of _PART.
_PARTS = frozenset("banner sidebar side nav navbar navigation menu menubar footer header topbar toolbar widget widgets".split())
_PART = frozenset("main site page top bottom primary secondary global mobile desktop user bar link links item items list inner title logo toggle button buttons btn area".split())
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
_WORD = re.compile(r"[a-z]+")
#: How sure it is that an element is no article: by a layout name, by another name, by its element, role or being hidden.
LAYOUT, NAMED, SURE = 1, 2, 3


def _named(value: str) -> int:
    level = 0
    for name in value.split():
        said = _WORD.findall(name)
        if not _NAMES.isdisjoint(said) and _LACKS.isdisjoint(said) or said and _OFTEN.issuperset(said):
            return NAMED
        if not _OFTEN.isdisjoint(said) and _LACKS.isdisjoint(said):
            level = LAYOUT
        if not _PARTS.isdisjoint(said) and all(w in _PARTS or w in _PART for w in said):
            level = LAYOUT
    return level


def _boilerplate(tag: str, attrs: str, inside: bool) -> int:
    if tag in _NOT_ARTICLE or tag == "header" and not inside:
        return SURE
    if not attrs.strip() or tag in ("article", "main", "body", "html"):
        return 0
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs):
        return SURE
    level = 0
    for name, *values in _ATTR.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value.strip() in _ROLES or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return SURE
        if name in ("class", "id"):
            level = max(level, _named(value))
    return level


def lines(page: str) -> tuple[list[tuple[str, int, int, bool, int]], list[int], list[int], list[int]]:
    """The non-empty lines and the tree of block elements.

    Lines: text, characters outside links, how sure its markup is no article, outermost marked element (0: none), innermost element.  Of
    each element: its parent, the last element within it, and a number shared by elements of equal names up to the root.
    """
    out, text, links, in_link = [], [], 0, 0
    stack: list[tuple[str, int, list[int]]] = []  # open elements, whether they are boilerplate, marks they set aside
    depth, article = [0, 0, 0, 0], [0]  # open elements by how sure they are boilerplate; the outermost marked element, last
    opened: dict[str, int] = {}  # open elements by tag
    frames: list[str] = []  # open elements that are boilerplate, and how many of them frame a page
    framing = 0
    closes: dict[str, int] = {}  # where a tag is closed for the last time
    parent, last, kind, kinds, block = [0], [0], [0], {}, 0

    def close():
        nonlocal links
        if text:
            line = " ".join("".join(text).split())
            if line:
                out.append((line, max(0, len(line) - links), SURE if depth[SURE] else NAMED if depth[NAMED] or depth[LAYOUT] > 1 else depth[LAYOUT], article[-1], block))
            text.clear()
        links = 0

    def leave() -> str:
        nonlocal in_link, block, framing
        t, bad, aside = stack.pop()
        opened[t] -= 1
        if bad:
            framing -= frames.pop() in _FRAMES
        if t in _BLOCKS:
            last[block], block = len(parent) - 1, parent[block]
        depth[bad] -= bad > 0
        for k, marks in enumerate(aside):
            depth[k] += marks
        if t in ("article", "main"):
            article.pop()
        in_link -= t == "a"
        return t

    def last_close(tag: str) -> int:
        if tag not in closes:
            closes[tag] = max((m.start() for m in re.finditer(rf"</{re.escape(tag)}\s*>", page, re.I)), default=-1)
        return closes[tag]

    def say(raw: str):
        nonlocal links
        if raw:
            raw = html.unescape(raw)
            text.append(raw)
            if in_link:
                links += len(" ".join(raw.split()))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        ends, attrs = m[1] or m[4], m[3] or m[6] or ""
        if tag in _BLOCKS:
            close()
        elif tag in ("br", "td", "th", "img"):
            text.append(" ")
        if ends:
            if opened.get(tag):
                while leave() != tag:
                    pass
        elif tag in _RAW_END and not attrs.rstrip().endswith("/"):
            if tag == "head":
                continue
            m = _RAW_END[tag].search(page, at)
            at = m.end() if m else n
        elif tag not in _VOID and not attrs.rstrip().endswith("/"):
            if tag in ("article", "main", "section", "h1", "body") and framing and last_close(frames[0]) < at:
                while frames:  # a menu that is never closed ends where the article begins
                    leave()
            if tag in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                leave()
            bad = _boilerplate(tag, attrs, article[-1] > 0)
            # An article within an element of a layout name shows that it wraps the article; <main> shows it for any name.
            aside = [0, *depth[1 : 1 + {"article": LAYOUT, "main": NAMED}.get(tag, 0)]]
            for k, marks in enumerate(aside):
                depth[k] -= marks
            stack.append((tag, bad, aside))
            opened[tag] = opened.get(tag, 0) + 1
            if bad:
                frames.append(tag)
                framing += tag in _FRAMES
            if tag in _BLOCKS:
                parent.append(block)
                last.append(-1)
                kind.append(kinds.setdefault((kind[block], tag), len(kinds) + 1))
                block = len(parent) - 1
            depth[bad] += bad > 0
            if tag in ("article", "main"):
                article.append(article[-1] or block)
            in_link += tag == "a"
    close()
    return out, parent, [len(parent) - 1 if at < 0 or not i else at for i, at in enumerate(last)], kind


def main_text(page: str | None, *, window: int = WINDOW, surge: int = SURGE) -> str:
    """The lines between surges and dives, joined by newlines; empty if nothing surges."""
    found, *tree = lines(page or "")
    if not found:
        return ""
    text, own, bad, within, block = zip(*found)
    # A part of the layout holds less text than the article; where it holds more, its name misleads.
    told = any(i and b < SURE for b, i in zip(bad, within))
    plain, layout = (sum(n for n, b, i in zip(own, bad, within) if b == k and (i or not told)) for k in (0, LAYOUT))
    if layout >= surge and layout > plain:
        bad = [0 if b == LAYOUT and (i or not told) else b for b, i in zip(bad, within)]
    elif 0 not in bad:  # the only article
        bad = [0 if b <= NAMED and i else b for b, i in zip(bad, within)]
    size = np.array([0 if b else MARK * len(t) if i else n if 2 * n >= len(t) else 0 for t, n, b, i in zip(text, own, bad, within)])
    marked = np.array([i > 0 and not b for i, b in zip(within, bad)])
    parts = [np.where(part, size, 0) for part in (marked, ~marked)]
    sums = [np.convolve(part, np.ones(window, int))[window - 1 :] for part in parts]  # of each line and those after it
    threshold = max(1, min(surge, int(max(x.max(initial=0) for x in sums)) // 2))
    links = np.array([not b and not i and not z for b, i, z in zip(bad, within, size)])
    surging = {within[i] for i in np.nonzero(marked & (sums[0] >= threshold))[0]}
    kept = [i for i in np.nonzero(marked)[0].tolist() if within[i] in surging]
    kept += _between(parts[1], sums[1], threshold, links, own, block, *tree)
    return "\n".join(text[i] for i in sorted(kept))


def _between(size: np.ndarray, sums: np.ndarray, threshold: int, links: np.ndarray, own: list[int], block: list[int], parent: list[int], last: list[int], kind: list[int]) -> list[int]:
    """The lines between surges and dives."""
    keep: list[int] = []
    waiting: list[int] = []  # lines of links since the surge's last line
    holds, seen = 0, set()  # the element that holds the surge's lines and their kinds: of those of full length, if it has any
    firm = on = gap = False  # whether it has, whether the surge is open, whether a line of zero length came last

    def belongs(i: int) -> bool:
        return holds <= block[i] <= last[holds] or bool(on and kind[block[i]] in seen)

    for i in range(len(size)):
        if not size[i]:
            if seen and links[i] and belongs(i):
                waiting.append(i)
            on, gap = on and bool(sums[i]), True
            continue
        goes_on = on and not gap or bool(seen) and belongs(i)
        if goes_on or sums[i] >= threshold:
            keep += waiting if goes_on else [j for j in waiting if own[j]]
            full = size[i] >= threshold
            if not goes_on or full and not firm:
                holds, seen, firm = parent[block[i]], set(), full
            if full or not firm:
                while not holds <= block[i] <= last[holds]:
                    holds = parent[holds]
                seen.add(kind[block[i]])
            keep.append(i)
            waiting, on, gap = [], True, False
    return keep + [j for j in waiting if own[j]]


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page; null, empty and text-free pages have the empty text.

    Rows are worked on one by one: repeated and null ids pass through.
    """
    kinds = {c.name: c.dataType.simpleString() for c in pages.schema}

    def run(batches):
        for batch in slices(batches, 256):
            got = [main_text(p) for p in column(batch, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "page_id"), column(batch, "url"), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return arrow(rows, run, f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars long")
