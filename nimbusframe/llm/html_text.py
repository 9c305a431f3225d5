"""Main text of web pages by line-block distribution.

Markup is stripped to one line a block. Text lengths (without link text) are
summed over sliding windows of lines; the text surges where a window passes a
threshold and dives where it falls below. What lies between, extended to the
block that holds it, is the main text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusframe.llm.common import batch_of, chunks, column, free_name, tidy

#: Lines in a sliding window, and the text (code points) that is a surge.
WINDOW, SURGE = 3, 80
#: Characters of markup worked on between two yields of a task.
CHUNK = 8_000_000

# Element names of HTML.
DROPPED = set("script style noscript template svg math iframe object canvas audio video head title textarea".split())
ASIDE = set("nav footer aside form button select menu dialog header fieldset".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = {"article", "main"}
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
WHOLE_PAGE = {"", "html", "body"}
#: Stray end tags do not end these, other than those of ENDS_ALL.
BARS, ENDS_ALL = MAIN | {"body"}, MAIN | {"body", "html"}
#: Words in class, id and role that mark what is not the article.
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside menu nav "
    "navbar navigation breadcrumb breadcrumbs topbar toolbar footer header masthead notice notices cookie cookies "
    "consent gdpr popup modal overlay alert newsletter subscribe subscription signup login search share sharing social "
    "related recommended recommendations comment comments respond reply replies disqus discussion widget pagination "
    "pager skip copyright legal disclaimer form contentinfo complementary".split()
)
#: Those of them that name the words of others: such an element is no article
#: however long it is.
OTHERS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored related recommended recommendations cookie "
    "cookies consent gdpr comment comments respond reply replies disqus discussion".split()
)
#: Parts of a class that make it a remark on the layout, first or last in it.
REMARK_FIRST = set("has with no without not is hide show".split())
REMARK_LAST = set("open opened closed enabled disabled active visible".split())
#: Inside an article a class or id counts only if it is all of such words and
#: of these, which say where or how, and not for what an article may well hold.
LAYOUT = set(
    "area bar block blocks body bottom box button buttons column container content group icon icons inner item items left "
    "link links list main module outer panel post posts right row section small text title top wrap wrapper".split()
)
IN_ARTICLES = set("legal disclaimer copyright discussion search header form alert".split())
#: What a header may belong to that is part of the article.
HEADED = set("article entry post page content story title".split())
#: How sure it is that an element is not part of the article.
NO, LOOSELY, SURELY, HIDDEN = range(4)
#: Closing is optional for these; a new one ends the one before.
LOOSE = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[^a-z0-9]+")


@cache
def _end_of(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{re.escape(name)}\s*>", re.I)


def _beside(name: str, attrs: str, inside_main: bool) -> int:
    """How surely an element is not part of an article by its name and attributes."""
    given: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attrs) if attrs else ():
        given.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    if name not in ("html", "body"):
        if given.get("hidden", "false") != "false" or given.get("aria-hidden") == "true":
            return HIDDEN
        if _UNSEEN.search(given.get("style", "")):
            return HIDDEN
    of_article = False
    found = NO
    for key in ("class", "id", "role"):
        for one in given.get(key, "").split():
            parts = [x for x in _PARTS.split(one) if x]
            if len(parts) > 1 and (parts[0] in REMARK_FIRST or parts[-1] in REMARK_LAST):
                continue
            if len(parts) > 1 and parts[-1] == "header" and parts[-2] in HEADED:
                of_article = True
            elif inside_main and not (LAYOUT | ASIDE_WORDS - IN_ARTICLES).issuperset(parts):
                continue
            elif not OTHERS.isdisjoint(parts):
                found = SURELY
            elif not ASIDE_WORDS.isdisjoint(parts):
                found = max(found, LOOSELY)
    if name in ASIDE and not (name == "header" and (inside_main or of_article)):
        return LOOSELY if name == "form" and found != SURELY else SURELY
    if name in ("html", "body", "main") or (name == "article" and "header" in given.get("class", "")):
        return NO
    return found


class _Line(NamedTuple):
    """A block of a page: its text, code points of it in links, the innermost
    open element, and whether it is a heading."""

    text: str
    links: int
    at: int
    heading: bool


class _Tree:
    """The elements of a page, numbered from 1 as they open; 0 is the page."""

    def __init__(self) -> None:
        self.parent, self.depth = [0], [0]
        self.last = [0]  # the last number that opened inside
        self.main = [0]  # the outermost ``main`` or ``article`` around it, itself included
        self.name = [""]

    def open(self, parent: int, name: str) -> int:
        k = len(self.parent)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.last.append(k)
        self.main.append(self.main[parent] or (k if name in MAIN else 0))
        self.name.append(name)
        return k

    def shared(self, a: int, b: int) -> int:
        """The innermost element around both."""
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parent[a]
            else:
                b = self.parent[b]
        return a


def lines_of(page: str) -> tuple[list[_Line], _Tree]:
    """The blocks of a page outside menus and the like, in page order, and its
    elements.

    An element that looks like a menu or the like stays if it holds the main
    part: ``main``, the only articles of the page (if it is loosely marked), or
    more than half of the page's text (the same). If no text is left by all
    this, all text that is not hidden counts."""
    lines, tree, marked, within = _read(page, frozenset())
    if marked:
        keep = {k for k, (sure, most, holds) in marked.items() if holds == "main" or (sure == LOOSELY and (holds or most))}
        if keep:
            lines, tree = _read(page, frozenset(keep))[:2]
        if not lines and within:
            lines, tree = _read(page, frozenset(marked))[:2]
    return lines, tree


def _read(page: str, keep: frozenset[int]) -> tuple[list[_Line], _Tree, dict[int, tuple[int, bool, str]], bool]:
    """One reading of a page: its lines and elements; of each element that is
    left out but not hidden and not in ``keep``, how surely, whether it has more
    than half of the text, and what it holds; whether any text was left out.

    Open elements are found by name without a walk over all of them, and a line
    holds the number of its element only, so time and memory are linear in the
    page, however deep or badly it is nested."""
    out: list[_Line] = []
    tree = _Tree()
    stack: list[tuple[str, int, int]] = []  # name, number, how surely beside the article
    open_at: dict[str, list[int]] = {}  # places in the stack by name
    bars: list[int] = []  # of articles and the body, which stray end tags do not end
    blocks: list[int] = []
    graded: list[int] = []  # open elements that are left out
    text: list[str] = []
    links = pos = beside = main = anchors = headings = 0
    sure = seen = 0  # elements open that are surely beside, text so far outside of these and of links
    began: dict[int, int] = {}
    size: dict[int, int] = {}
    grade: dict[int, int] = {}
    holds: dict[int, str] = {}
    free_article = within = False

    def flush() -> None:
        nonlocal links
        line = " ".join(html.unescape("".join(text)).split())
        if line:
            out.append(_Line(line, min(links, len(line)), stack[-1][1] if stack else 0, headings > 0))
        text.clear()
        links = 0

    def take(piece: str) -> None:
        nonlocal links, seen, within
        if not sure and not anchors:
            seen += len("".join(piece.split()))
        if beside and not within:
            within = bool(piece.strip())
        if piece and not beside:
            text.append(piece)
            if anchors:
                links += len(html.unescape(piece).strip())

    def close(upto: int) -> None:
        nonlocal beside, main, anchors, sure, headings
        for name, k, aside in reversed(stack[upto:]):
            open_at[name].pop()
            if name in BARS:
                bars.pop()
            if name in BLOCKS:
                blocks.pop()
            beside -= aside > NO
            sure -= aside >= SURELY
            if k in began:
                size[k] = seen - began[k]
                graded.pop()
            main -= name in MAIN
            anchors -= name == "a"
            headings -= name in HEADINGS
            tree.last[k] = len(tree.parent) - 1
        del stack[upto:]

    while True:
        m = _TOKEN.search(page, pos)
        if m is None:
            take(page[pos:])
            break
        take(page[pos : m.start()])
        pos = m.end()
        if not m[2]:
            continue
        name, attrs = m[2].lower(), m[3]
        if name in BLOCKS:
            if not beside:
                flush()
        elif name == "br" and not beside:
            text.append(" ")
        if m[1]:
            at = open_at.get(name)
            if at and (name in ENDS_ALL or not bars or bars[-1] <= at[-1]):
                close(at[-1])
            continue
        if name in DROPPED:
            if attrs.endswith("/"):
                continue
            end = _end_of(name).search(page, pos)
            if end:
                pos = end.end()
            elif name not in ("head", "title"):
                break
            continue
        if name in VOID or attrs.endswith("/"):
            continue
        ends = LOOSE.get(name)
        if ends:
            at = max((open_at[e][-1] for e in ends if open_at.get(e)), default=-1)
            if at >= 0 and at >= blocks[-1]:
                close(at)
        aside = _beside(name, attrs, main > 0)
        k = tree.open(stack[-1][1] if stack else 0, name)
        if k in keep and aside < HIDDEN:
            aside = NO
        open_at.setdefault(name, []).append(len(stack))
        if name in BARS:
            bars.append(len(stack))
        if name in BLOCKS:
            blocks.append(len(stack))
        stack.append((name, k, aside))
        if aside in (LOOSELY, SURELY):
            grade[k] = aside
            began[k] = seen
            graded.append(k)
        if name in MAIN and aside < SURELY:
            if name == "article" and not beside and not aside:
                free_article = True
            for g in reversed(graded):
                if holds.get(g) in ("main", name):
                    break  # so are all around it
                holds[g] = name
        beside += aside > NO
        sure += aside >= SURELY
        main += name in MAIN
        anchors += name == "a"
        headings += name in HEADINGS
    flush()
    close(0)
    tree.last[0] = len(tree.parent) - 1
    marked = {}
    for k, g in grade.items():
        held = holds.get(k, "")
        marked[k] = (g, size.get(k, 0) * 2 > seen, "" if held == "article" and free_article else held)
    return out, tree, marked, within


def surges(lengths: list[int], window: int = WINDOW, least: int = SURGE) -> tuple[int, int] | None:
    """The first and last line of the text: from the first surge to the last
    dive of the window sums. If no window passes ``least``, from the fullest
    window; None without any text."""
    if not any(lengths):
        return None
    n = len(lengths)
    total, sums = sum(lengths[: window - 1]), []
    for i in range(n):
        total += lengths[i + window - 1] if i + window - 1 < n else 0
        sums.append(total)
        total -= lengths[i]
    bar = min(least, max(sums))
    hot = [i for i, s in enumerate(sums) if s >= bar]
    lo, hi = hot[0], min(n - 1, hot[-1] + window - 1)
    part = min(least // window, max(lengths[lo : hi + 1]))  # the text starts and ends with a line of some length
    while lengths[lo] < part:
        lo += 1
    while lengths[hi] < part:
        hi -= 1
    return lo, hi


def main_text(page: str | None) -> str:
    """The main text of a page: blocks in page order joined by one ``\\n``."""
    if not page:
        return ""
    lines, tree = lines_of(page)
    article = any(tree.main[x.at] for x in lines)
    if article:  # the whole of all articles
        lines = [x for x in lines if tree.main[x.at]]
    own = [0 if x.links * 2 > len(x.text) and not article else len(x.text) - x.links for x in lines]
    found = surges(own)
    if found is None or article:
        return "\n".join(x.text for x in lines)
    lo, hi = found
    while lo and lines[lo - 1].heading and not lines[lo - 1].links:
        lo -= 1  # the title stands before the surge
    holder = tree.shared(lines[lo].at, lines[hi].at)
    while tree.parent[holder] and tree.name[holder] not in BLOCKS:
        holder = tree.parent[holder]
    if tree.name[holder] in WHOLE_PAGE:  # holds menus and footers as well: the distribution decides alone
        return "\n".join(x.text for x in lines[lo : hi + 1])
    return "\n".join(
        x.text
        for i, x in enumerate(lines)
        if lo <= i <= hi or (holder <= x.at <= tree.last[holder] and (own[i] or x.links * 2 <= len(x.text)))
    )


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """The columns of ``pages`` with ``text`` (the main text) and ``n_chars``
    (its code points) in place of the markup.

    Scripts, styles, comments and the head are cut; menus, headers, footers,
    sidebars, notices, adverts, forms and reader comments are known by element
    names and by words in class, id and role, other than remarks on the layout
    (``has-sidebar``) and headers of the article; what holds the main part stays
    (:func:`lines_of`). If the page has ``article`` or ``main`` elements their
    lines are the text. Else the line-block distribution decides
    (:func:`surges`): the text runs from the first surge, or the headings right
    before it, to the last dive, and on to the other lines of the block that
    holds both ends, so short paragraphs at its ends stay; if that is the whole
    body, which holds menus and footers too, nothing is added. Lines of which
    more than half is link text count as empty.

    White space inside a block becomes one space, also for ``<br>``; character
    references are decoded; cut-off and badly nested markup is read as far as
    it goes. Null or empty markup, or none with text, gives an empty text. Nothing
    is capped. Repeated rows are treated alike, other columns pass through, a
    clash of ``text`` or ``n_chars`` gets an underscore before the new name.
    One pass over the rows where they are, without a shuffle.
    """
    at = pages.columns.index(html_column)
    rest = [c for c in pages.columns if c != html_column]
    others = pages.select(*[column(pages, c) for c in rest])
    # Inside, columns have plain names; the markup's own is free again.
    plain = pages.toDF(*[f"c{i}" for i in range(len(pages.columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in chunks([len(x or "") for x in texts], CHUNK):
                got = [main_text(x) for x in texts[lo:hi]]
                part = batch.slice(lo, hi - lo)
                own = [part.column(i) for i in range(part.num_columns) if i != at]
                yield batch_of(own, [pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())])

    schema = others.toDF(*[f"c{i}" for i in range(len(rest))]).limit(0)
    schema = schema.withColumn("x0", F.lit("")).withColumn("x1", F.lit(None).cast("long"))
    out = plain.mapInArrow(tidy(run), schema.schema)
    return out.toDF(*rest, *[free_name(others, k) for k in ("text", "n_chars")])
