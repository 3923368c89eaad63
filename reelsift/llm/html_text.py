"""Main text of web pages: page structure, and lines that a page shares with its nearest page of the same host.

A page is cut into blocks, the text between block-level tags. Its structure says of most blocks what they are: blocks in an
``article`` or ``main`` element are its main text; menus, headers, footers, sidebars, forms and whatever is classed as advert,
notice or comments are not. An article in ``main`` goes before the rest of ``main``, and ``main`` before an article beside it; what
is in one of them and goes behind is *open*, and so are the other blocks of pages without such elements. For the open ones, pages of
a host are put in the order of their URL paths, pages with the same lines as one; each is paired with the neighbour that has more
leading path segments in common, its open lines are aligned by longest common subsequence with all that is not main text there,
and the lines they share are deleted: what a host repeats from page to page is its frame. A page that shares nearly all its lines
may be a changed copy of its neighbour, so pages further away, the nearer paths first, then have to share the lines too; where
none of these (``STEPS``) differ, what is shared goes. Nothing that the structure says is main text is deleted for being repeated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.common import slices
from reelsift.operators.ranking import global_row_number
from reelsift.session import durable

MAIN, OPEN, FRAME = 2, 1, 0
#: A page that shares more of its open lines than this with its neighbour may be the same page at another place: further pages decide.
SAME_PAGE = 0.8
#: How many places away these are, before and after it.
STEPS = [sign * n for n in (1, 3, *(2**k for k in range(1, 17))) for sign in (1, -1)]
#: Pages whose deletions are sent to all tasks at most; for more the pages are shuffled.
SENT_PAGES = 200_000

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(noscript|template|textarea|svg|math|iframe|object|select|canvas|audio|video|head|title)\b(?:"[^"]*"|'[^']*'|[^"'>])*>.*?</\2\s*>"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:"[^"]*"|'[^']*'|[^"'>])*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>""",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split()
)
_FRAME_TAGS = frozenset("nav aside footer form menu button dialog".split())
_FRAME_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted
    nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside rail widget footer masthead toolbar
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall
    share sharing social comment comments disqus reply replies respond related recommended recommendations search contentinfo complementary""".split()
)


#: What a token of a class may have beside names of the frame and still be one of the frame, in the main text.
_HOLDERS = frozenset(
    """area articles bar block bottom box btn button buttons container content desktop form group holder icons inline inner item items large left link links
    list mobile panel posts right section slot small sticky stories thread top unit wrap wrapper""".split()
)
_OWN_TEXT = frozenset("h1 h2 h3 h4 h5 h6 p".split())


def _names(tag: str, attributes: str, in_main: bool) -> set[str]:
    """The words to tell the frame by; ids do not speak for headings and paragraphs.

    In the main text a token counts whose parts are all names of the frame or holders of such; of an element that holds others, also one
    that ends with a name of the frame, as in ``reader-comments``. A label counts as a whole.
    """
    names: set[str] = set()
    for n in _NAMES.finditer(attributes):
        kind, value = n[1].lower(), n[2] or n[3] or n[4] or ""
        if kind == "id" and tag in _OWN_TEXT:
            continue
        for token in [value] if kind == "aria-label" else value.split():
            parts = [p.lower() for p in _PARTS.findall(token)]
            ends = kind != "aria-label" and tag not in _OWN_TEXT and parts and parts[-1] in _FRAME_NAMES
            if not in_main or ends or _FRAME_NAMES | _HOLDERS >= set(parts):
                names.update(parts)
    return names


def _is_frame(tag: str, names: set[str], in_main: bool) -> bool:
    return tag in _FRAME_TAGS or (tag == "header" and not in_main) or not names.isdisjoint(_FRAME_NAMES) or ("header" in names and tag not in ("h1", "h2", "h3") and not in_main)


def page_blocks(html: str) -> list[tuple[int, str]]:
    """(kind, text) of each block with text, in order; ``kind`` is MAIN, OPEN or FRAME."""
    found: list[tuple[int, str]] = []  # kinds: 4 in an article in main, 3 in main, 2 in another article, then OPEN and FRAME
    stack: list[tuple[str, int]] = []
    kind, text = OPEN, []

    def flush() -> None:
        if text:
            if words := unescape("".join(text)).split():
                found.append((kind, " ".join(words)))
            text.clear()

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            text.append(html[at : m.start()])
        at = m.end()
        tag = (m[4] or m[7] or "").lower()
        if not tag:
            continue
        closing, rest = (m[3] or m[6]), (m[5] or m[8] or "")
        if tag == "br":
            text.append(" ")
            continue
        if closing:
            if tag in _BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    flush()
                    del stack[k:]
                    kind = stack[-1][1] if stack else OPEN
                    break
            continue
        if tag in _BLOCK:
            flush()
            if stack and stack[-1][0] == "p":
                stack.pop()
                kind = stack[-1][1] if stack else OPEN
        if tag in _VOID or rest.endswith("/") and tag not in _BLOCK:
            continue
        names = _names(tag, rest, kind > OPEN) if "=" in rest else set()
        inner = kind
        if kind != FRAME:
            if _is_frame(tag, names, kind > OPEN):
                inner = FRAME
            elif tag == "article" or "articlebody" in rest.lower():
                inner = 4 if kind > 2 else 2
            elif kind == OPEN and (tag == "main" or re.search(r"""role\s*=\s*["']?main\b""", rest)):
                inner = 3
        if tag in _BLOCK and tag not in ("html",) or inner != kind:
            if inner != kind:
                flush()
            stack.append((tag, inner))
            kind = inner
    text.append(html[at:])
    flush()
    best = max((k for k, _ in found), default=OPEN)
    if best > OPEN:
        return [(MAIN if k == best else OPEN if k > OPEN else FRAME, t) for k, t in found]
    return found


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The lengths of longest common subsequences of ``a`` with each beginning of ``b``, 64 places of ``b`` at a time."""
    where: dict[int, bytearray] = {}
    size = len(b) // 8 + 1
    wanted = set(a)
    for j, line in enumerate(b):
        if line in wanted:
            where.setdefault(line, bytearray(size))[j >> 3] |= 1 << (j & 7)
    places = {line: int.from_bytes(bits, "little") for line, bits in where.items()}
    mask = (1 << len(b)) - 1
    open_ = mask  # a place is closed when it ends a longer subsequence than the places before it
    for line in a:
        if here := places.get(line):
            met = open_ & here
            open_ = ((open_ + met) | (open_ - met)) & mask
    bits = np.unpackbits(np.frombuffer(open_.to_bytes(size, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``, in linear space however often lines repeat.

    Hirschberg's halving: both halves of ``a`` are measured against all beginnings and all ends of ``b``, and ``b`` is cut where the
    two lengths add up to most.
    """
    found: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        low, high, first, last = todo.pop()
        while low < high and first < last and a[low] == b[first]:
            found.append(low)
            low, first = low + 1, first + 1
        while low < high and first < last and a[high - 1] == b[last - 1]:
            found.append(high - 1)
            high, last = high - 1, last - 1
        if low == high or first == last:
            continue
        if high - low == 1:
            if a[low] in b[first:last]:
                found.append(low)
            continue
        middle = (low + high) // 2
        other = b[first:last]
        both = _prefix_lengths(a[low:middle], other) + _prefix_lengths(a[middle:high][::-1], other[::-1])[::-1]
        cut = first + int(both.argmax())
        todo += [(low, middle, first, cut), (middle, high, cut, last)]
    return sorted(found)


def repeated_lines(own: list[int], others: list[list[int]]) -> list[int]:
    """Places of the lines to delete from a page's open lines, given the lines of other pages, the nearest first.

    While more than ``SAME_PAGE`` of the lines are shared, the next page has to share them too, unless it shares none of them.
    A page without a line of its own keeps all.
    """
    shared = shared_lines(own, others[0])
    for other in others[1:]:
        if len(shared) <= SAME_PAGE * len(own):
            break
        if again := shared_lines([own[n] for n in shared], other):
            shared = [shared[n] for n in again]
    return [] if len(shared) == len(own) else shared


def _page_lines(pages: DataFrame) -> DataFrame:
    """``k, u, host, path, lines, open, open_at``: the lines of each page outside its main text, and where the open ones are.

    ``open`` counts among ``lines``, ``open_at`` among all blocks of the page; ``u`` is equal for equal lines of a host.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            rows = []
            for k, url, html in zip(*(part.column(c).to_pylist() for c in ("k", "url", "html")), strict=True):
                blocks = page_blocks(html)
                places = [n for n, (kind, _) in enumerate(blocks) if kind == OPEN]
                outside = [(line_hash(t), kind) for kind, t in blocks if kind != MAIN]
                lines = [line for line, _ in outside]
                if lines:
                    try:
                        split = urlsplit(url)
                    except ValueError:
                        split = urlsplit("")
                    host = split.netloc.lower()
                    u = line_hash(repr((host, lines, places)))
                    rows.append((k, u, host, split.path, lines, [n for n, (_, kind) in enumerate(outside) if kind == OPEN], places))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["k", "u", "host", "path", "lines", "open", "open_at"])

    return pages.mapInArrow(read, "k long, u long, host string, path string, lines array<long>, open array<int>, open_at array<int>")


def _common_segments(a: str, b: str):
    """Leading path segments that two paths share."""
    x, y = F.split(a, "/"), F.split(b, "/")
    equal = F.transform(F.arrays_zip(x.alias("x"), y.alias("y")), lambda p: p["x"].eqNullSafe(p["y"]))
    return F.coalesce(F.array_position(equal, False), F.lit(0)) - 1 + F.when(F.array_contains(equal, False), 0).otherwise(F.size(equal) + 1)


def _aligned(rows: DataFrame) -> DataFrame:
    """``u, doubtful, deleted`` of rows with ``u, lines, open, open_at`` and ``others``, the lines of other pages in order."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            doubtful, deleted = [], []
            for lines, places, at, others in zip(*(part.column(c).to_pylist() for c in ("lines", "open", "open_at", "others")), strict=True):
                own = [lines[n] for n in places]
                doubtful.append(len(shared_lines(own, others[0])) > SAME_PAGE * len(own))
                deleted.append([at[n] for n in repeated_lines(own, others)])
            yield pa.RecordBatch.from_arrays([part.column("u"), pa.array(doubtful, pa.bool_()), pa.array(deleted, pa.list_(pa.int32()))], ["u", "doubtful", "deleted"])

    return rows.select("u", "lines", "open", "open_at", "others").mapInArrow(align, "u long, doubtful boolean, deleted array<int>")


def _deletions(page_lines: DataFrame) -> DataFrame:
    """``k, deleted``: the blocks of each page that are open and that its nearest pages of the same host have too."""
    with_open = page_lines.where(F.size("open") > 0)
    hosts = durable(with_open.select("host").distinct())
    hosts = F.broadcast(hosts) if hosts.count() <= SENT_PAGES else hosts
    # One entry for equal lines of a host, so that copies of a page are not each other's neighbours.
    entries = page_lines.join(hosts, "host", "left_semi").groupBy("u").agg(F.min("path").alias("path"), *(F.first(c).alias(c) for c in ("host", "lines", "open", "open_at")))
    placed = durable(global_row_number(entries, ["host", "path", "u"], "place"))
    spots = placed.select("place", "host", "path")
    mine = placed.where(F.size("open") > 0).select("u", "place", "host", "path")

    def others(pages: DataFrame, steps: list[int]) -> DataFrame:
        """``u, other, close, away``: the pages of the same host that are ``steps`` places away."""
        there = pages.withColumn("step", F.explode(F.array(*map(F.lit, steps)))).withColumn("other", F.col("place") + F.col("step")).drop("place")
        pair = there.join(spots.select(F.col("place").alias("other"), F.col("host").alias("host2"), F.col("path").alias("path2")), "other").where("host = host2")
        return pair.select("u", "other", _common_segments("path", "path2").alias("close"), F.struct(-F.abs("step"), F.col("step")).alias("away"))

    own = placed.select("u", "lines", "open", "open_at")
    texts = placed.select(F.col("place").alias("other"), F.col("lines").alias("other_lines"))
    nearest = others(mine, [-1, 1]).groupBy("u").agg(F.max(F.struct("close", "away", "other")).alias("best")).select("u", F.col("best.other").alias("other"))
    first = durable(_aligned(nearest.join(texts, "other").join(own, "u").withColumn("others", F.array("other_lines"))))
    unsure = first.where("doubtful").select("u")
    more = others(mine.join(unsure, "u", "left_semi"), STEPS).join(texts, "other")
    more = more.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("close", "away", "other_lines")), asc=False).alias("found"))
    second = _aligned(more.join(own, "u").withColumn("others", F.col("found.other_lines")))
    deleted = durable(first.where("NOT doubtful").unionByName(second).where(F.size("deleted") > 0).select("u", "deleted"))
    pages = with_open.select("k", "u").dropDuplicates(["k"])
    return pages.join(F.broadcast(deleted) if deleted.count() <= SENT_PAGES else deleted, "u").select("k", "deleted")


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (``page_id, url, html``): ``page_id, url, text, n_chars``.

    Null and empty html give an empty text; pages without a URL are of one host without a name. Rows that repeat a page are
    paired like others, but get equal texts. Character references are decoded, white space within a block is one blank,
    blocks are joined by line feeds. Other columns are ignored.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = []
            for html, deleted in zip(part.column("html").to_pylist(), part.column("deleted").to_pylist(), strict=True):
                gone = set(deleted or ())
                texts.append("\n".join(t for n, (k, t) in enumerate(page_blocks(html)) if k != FRAME and n not in gone))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts), pa.array(np.array([len(t) for t in texts], np.int64))], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("k", F.xxhash64("page_id", F.coalesce("url", F.lit("")), "html"))
    page_lines = durable(_page_lines(rows.select("k", F.coalesce("url", F.lit("")).alias("url"), "html")))
    deleted = durable(_deletions(page_lines))
    small = deleted.count() <= SENT_PAGES
    found = rows.join(F.broadcast(deleted) if small else deleted, "k", "left")
    return found.select("page_id", "url", "html", "deleted").mapInArrow(read, "page_id long, url string, text string, n_chars long")
