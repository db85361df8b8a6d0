"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines: one per block of text, without elements that are never main text
(scripts, styles, menus, headers, footers, sidebars, forms, notices, adverts, comments).  An
element without text is a blank line, and so are the places of a dropped menu, header or footer
of the page's frame and the borders of a declared article; other dropped elements leave none, so
they never split a text.  Text lengths are summed over windows of three lines.  A surge is a line
where the sum exceeds a threshold, a share of the page's highest sum, and text goes on; the dive
is the next line where the sum falls to nothing; the text between surge and dive is kept, for
every such pair.  On a page that declares its article (article or main element, or the matching
role) the lines inside it count four times and the others a quarter, surges decide as elsewhere, and
a surge inside the article reaches back to the dive before it.

Names mark an element as not main text: roles, classes and the ids of plain containers (other ids
are often slugs of headings).  Inside a declared article a class or id is only a hint: its block
goes if its lines agree, that is, if links are half of its text or no window of its other text
exceeds the threshold of a surge (text of adverts counts a quarter).  Only a block that is named
just "ad" or the like goes in any case.  An inline element goes there only if it is a whole line.

Defined cases: null or empty html gives empty text; unclosed and stray tags are tolerated
(raw-text elements and comments end at the page's end at the latest); repeated rows are read as
rows of their own; an empty table gives an empty result."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, ABSOLUTE, SHARE = 3, 86, 0.25
#: weights of lines inside and outside of a declared article
INSIDE, OUTSIDE = 4, 0.25
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|select|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""", re.S | re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head nav header footer aside form button menu dialog fieldset object audio video canvas map".split())
MAIN = frozenset(("article", "main"))
#: dropped elements that part a page's frame from its text
FRAME = frozenset("head nav header footer menu".split())
FRAME_HINTS = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer contentinfo banner".split())
#: words of class, id and role names that mark an element as not main text
HINTS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted popup modal cookie "
                  "cookies consent notice notices alert gdpr newsletter subscribe subscription signup login nav navbar "
                  "navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside complementary "
                  "contentinfo widget related recommended share sharing social comment comments disqus replies reply "
                  "pagination pager toolbar search skip copyright".split())
WORDS = re.compile(r"[a-z]+")
#: hints that are never words of an article's own names
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted cookie cookies gdpr "
                    "newsletter disqus".split())
#: whole names that need no evidence
PLAIN_ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsored".split())
#: elements whose id may be a hint, and whole ids that are one on sections too
ID_TAGS, SECTIONS = frozenset("div ul ol table".split()), frozenset("section article main details".split())
SECTION_IDS = ADVERTS | frozenset("comments replies sidebar footer breadcrumbs pagination".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LOOSE = frozenset("p li td th tr dt dd option".split()) | HEADINGS  # their ends are often left out
NAMES = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")


def _hints(tag: str, name: str, part: str, declared: bool) -> set[str]:
    """Words of a name that mark its element as not main text."""
    w = WORDS.findall(part)
    if name == "id" and tag in SECTIONS:
        return {part} & SECTION_IDS
    if not w or (name == "id" and (tag not in ID_TAGS or (declared and w != [part]))):
        return set()
    if name == "class" and declared and tag in HEADINGS:
        return set()
    # a hint counts as a whole name or as the first or last word of a compound one
    return {w[0], w[-1]} & HINTS


def _marks(tag: str, attrs: str, declared: bool) -> tuple[bool, bool, bool, set[str]]:
    """(not main text, declared main text, part of the page's frame, hints to be agreed with) by
    class, id and role."""
    never = main = frame = False
    open_to = set()
    for name, *values in NAMES.findall(attrs):
        name = name.lower()
        if name not in ("class", "id", "role"):
            continue
        value = "".join(values).lower()
        if name == "role" and value.strip() in ("main", "article"):
            main = True
        for part in value.split():
            found = _hints(tag, name, part, declared)
            if declared and name != "role" and part not in PLAIN_ADVERTS:
                open_to |= found
            else:
                never |= bool(found)
                frame |= bool(found & FRAME_HINTS)
    return never, main, frame, open_to


def window_sums(sizes: list[float]) -> list[float]:
    return [sum(sizes[i:i + WINDOW]) for i in range(len(sizes))]


def _agreed(lines: list[str], links: list[int], of: list[tuple[int, ...]], blocks: list[list[bool]]) -> set[int]:
    """Numbers of the hinted blocks that go; inner blocks are settled before outer ones."""
    gone: set[int] = set()
    other = any(s and not o for s, o in zip(lines, of))
    members: list[list[int]] = [[] for _ in blocks]
    for i, o in enumerate(of):
        for n in o:
            members[n].append(i)
    for n in range(len(blocks) - 1, -1, -1):
        advert, section, headed = blocks[n]
        at = [i for i in members[n] if not gone.intersection(of[i])]
        plain = [len(lines[i]) - links[i] for i in at]
        most = max(window_sums(plain), default=0) * (OUTSIDE if advert else 1)
        linked = 2 * sum(links[i] for i in at) >= sum(len(lines[i]) for i in at)
        # a section with a heading may have its id from it; a wrapper of the whole article is none
        if (linked or most <= (ABSOLUTE if other else 0)) and not (section and headed and not linked):
            gone.add(n)
    return gone


def lines_of(page: str) -> tuple[list[str], list[bool]]:
    """Lines of a page (blank ones where an element had no text, where a part of the page's frame
    was dropped and at the borders of a declared article) and whether each lies in a declared
    article."""
    lines: list[str] = []
    inside: list[bool] = []
    links: list[int] = []  # characters of links in each line
    of: list[tuple[int, ...]] = []  # hinted blocks of each line
    blocks: list[list[bool]] = []  # hinted blocks in declared articles: advert, section's id, with a heading
    buffer: list[tuple[str, bool, bool]] = []  # text, in a link, in a hinted inline element
    stack: list[tuple[str, bool, bool, int, int]] = []  # open elements: tag, dropped, declared, number, hinted block
    inline: list[tuple[str, bool, int]] = []  # open links and hinted inline elements: tag, hinted, depth
    dropped = declared = number = 0
    last, cut = (0, False), False  # container and article of the last text; whether a part of the frame was dropped since

    def container() -> int:
        """The innermost open element; 0 for the page itself."""
        return stack[-1][3] if stack and stack[-1][0] not in ("html", "body") else 0

    def blank(n: int) -> None:
        lines.extend([""] * n)
        inside.extend([False] * n)
        links.extend([0] * n)
        of.extend([()] * n)

    def add(text: str) -> None:
        buffer.append((text, any(t == "a" for t, _, _ in inline), any(h for _, h, _ in inline)) if inline else (text, False, False))

    def flush() -> bool:
        nonlocal last, cut
        text = SPACE.sub(" ", entities.unescape("".join(t for t, _, _ in buffer))).strip()
        if text:
            member = tuple(b for *_, b in stack if b >= 0)
            if all(h or not t.strip() for t, _, h in buffer):
                blocks.append([False, False, False])
                member += (len(blocks) - 1,)
            # between two texts of one element (a list of contents, say) the frame splits nothing
            if (cut and not 0 < last[0] == container()) or last[1] != (declared > 0):
                blank(WINDOW)
            lines.append(text)
            inside.append(declared > 0)
            links.append(min(len(text), sum(len(t.strip()) for t, a, _ in buffer if a)))
            of.append(member)
            last, cut = (container(), declared > 0), False
        buffer.clear()
        return bool(text)

    def close(depth: int) -> None:
        nonlocal dropped, declared
        for _, d, a, _, _ in stack[depth:]:
            dropped -= d
            declared -= a
        del stack[depth:]
        inline[:] = [x for x in inline if x[2] <= depth]

    at, opened = 0, False
    for m in TOKEN.finditer(page):
        if not dropped and m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue  # comments, declarations, raw text: nothing of them is text
        tag = tag.lower()
        if m["end"]:
            if tag in INLINE and not any(t == tag and d for t, d, *_ in stack[-1:]):
                if depth := next((i for i in range(len(inline) - 1, -1, -1) if inline[i][0] == tag), -1) + 1:
                    del inline[depth - 1:]
                continue
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if not dropped and not flush() and opened:
                blank(1)  # an element without text is a blank line
            opened = False
            if depth is not None:
                close(depth)
            continue
        attrs = m["attrs"] or ""
        never, main, frame, hints = _marks(tag, attrs, declared > 0) if attrs else (False, False, False, ())
        main = (main or tag in MAIN) and not never and not hints
        frame = frame or tag in FRAME
        never = (never or tag in NEVER) and tag not in ("body", "html")
        if tag in INLINE and not never:
            if tag == "a" and inline:
                inline[:] = [x for x in inline if x[0] != "a"]  # links do not nest: the open one ends
            # inside hinted elements all are noted, to tell their ends apart
            if (tag == "a" or hints or inline) and not dropped and tag not in VOID and not attrs.rstrip().endswith("/"):
                inline.append((tag, bool(hints), len(stack)))
            continue
        if not dropped:
            flush()
            cut |= never and frame
            if stack and stack[-1][4] >= 0 and (stack[-1][0] == "p" or stack[-1][0] == tag) and stack[-1][0] in LOOSE:
                close(len(stack) - 1)  # a hinted paragraph or item whose end was left out
            if tag in HEADINGS:
                if stack and stack[-1][4] >= 0:
                    blocks[stack[-1][4]][2] = True
        opened = True
        if tag in VOID or attrs.rstrip().endswith("/"):
            continue
        if tag in LOOSE and not never and not hints:
            continue  # they only break lines
        number += 1
        doubtful = bool(hints) and not never and not dropped
        if doubtful:
            blocks.append([bool(hints & ADVERTS), tag in SECTIONS, False])
        stack.append((tag, never, main, number, len(blocks) - 1 if doubtful else -1))
        dropped += never
        declared += main
    if not dropped:
        add(page[at:])
        flush()
    if blocks:
        gone = _agreed(lines, links, of, blocks)
        left = [i for i, o in enumerate(of) if not gone.intersection(o)]
        lines, inside = [lines[i] for i in left], [inside[i] for i in left]
    return lines, inside


def main_text(page: str | None) -> str:
    """Text between surges and dives of the page's line-block distribution."""
    if not page:
        return ""
    lines, inside = lines_of(page)
    weights = [INSIDE if i else OUTSIDE for i in inside] if any(inside) else [1] * len(lines)
    sums = window_sums([w * len(s) for w, s in zip(weights, lines)])
    threshold = min(ABSOLUTE, SHARE * max(sums, default=0))
    kept, at = [], 0
    while at < len(lines):
        end = at
        while end < len(lines) and sums[end]:  # up to the dive
            end += 1
        surge = next((i for i in range(at, end) if lines[i] and sums[i] > threshold), end)
        if surge < end and inside[surge]:
            surge = at  # a declared article says where its text begins
        kept += [s for s in lines[surge:end] if s]
        at = end + 1
    return " ".join(kept)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    src = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_u"), F.col(html_col).cast("string").alias("_h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                text = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                    ["_id", "_u", "text", "n_chars"])
    kinds = [src.schema[c].dataType.simpleString() for c in ("_id", "_u")]
    return src.mapInArrow(run, f"_id {kinds[0]}, _u {kinds[1]}, text string, n_chars long").withColumnsRenamed(
        {"_id": id_col, "_u": url_col})
