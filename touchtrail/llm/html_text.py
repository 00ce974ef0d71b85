"""Main text of web pages: structure first, and differencing against the page with the nearest URL."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import ranked, ready, text_or_empty

COPY_SHARE = 0.8
# A line recurs on a host: on so many distinct pages, or on fewer that are so large a share of the host's.
MANY_PAGES = 8
FEW_PAGES, MOST_PAGES = 3, 0.8
# Pages in the order of hosts and paths are looked at so many together; those at an end are in two such blocks.
PLACES = 1024
ROWS_AT_ONCE = 256
_ADDRESS = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]*)([^?#]*)"

# Elements and names by which pages mark their parts.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea xmp noembed noframes".split())
_HIDDEN = frozenset(
    "head script style title noscript template svg math iframe object canvas audio video map select button textarea".split()
)
_BLOCKS = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody td tfoot th thead tr ul""".split()
)
_FRAME_TAGS = frozenset("nav aside footer form menu dialog".split())
_MAIN_TAGS = frozenset("article main".split())
_FRAME_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split()
)
_FRAME_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion nav navbar
    navigation menu submenu topbar toolbar breadcrumb breadcrumbs header masthead footer sidebar sidebars aside widget
    widgets cookie cookies consent gdpr notice notices notification popup modal overlay share sharing social related
    recommended recommendations comment comments commentlist reply replies respond disqus newsletter subscribe
    subscription signup login register search searchbox pagination pager paging copyright legal hidden""".split()
)
_HEADS = {"header", "masthead"}
_SPEAKS_OF = ("no-", "has-", "with-", "without-")
_MAIN_NAMES = frozenset(
    """article articlebody article-body article-content article__body post-content post-body entry-content entry-body
    story-body story-content main-content maincontent content-body page-content""".split()
)

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*?)(/?)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I
)
_HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_FRAME, _MAIN, _OPEN = "frame", "main", "open"


def _kind(tag: str, attributes: str, above: str) -> str:
    """What an element holds, from its name, its attributes and what it lies in."""
    if above in (_FRAME, "hidden") and not (tag == "main" and above == _FRAME):
        return above
    if tag in _HIDDEN:
        return "hidden"
    kind = _MAIN if tag in _MAIN_TAGS else above
    if tag in _FRAME_TAGS or tag == "header" and above != _MAIN:
        return _FRAME
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id"):
                names = value.split()
                parts = {p for n in names if not n.startswith(_SPEAKS_OF) for p in re.split(r"[-_]+", n)}
                if above == _MAIN:
                    parts -= _HEADS  # the article's own
                if not _MAIN_NAMES.isdisjoint(names):
                    kind = _MAIN
                elif tag not in ("html", "body") and not _FRAME_NAMES.isdisjoint(parts) and tag not in _MAIN_TAGS - {"article"}:
                    return _FRAME
            elif name == "role":
                if value in _FRAME_ROLES:
                    return _FRAME
                kind = _MAIN if value in ("main", "article") else kind
            elif name == "itemprop":
                kind = _MAIN if value == "articlebody" else kind
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDING.search(value):
                return _FRAME
    return kind


def blocks(page: str) -> list[tuple[str, str]]:
    """``(kind, text)`` of every block of a page in order: in its main part, its frame, or neither.

    Tags need not be closed or nested well: an end tag closes what is open inside its element, one
    without a start is passed over, and a list item, cell or paragraph ends the one before.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = [("", _OPEN)]
    parts: list[str] = []

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((stack[-1][1], text))
            parts.clear()

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        stop = found.start() if found else size
        if stop > at and stack[-1][1] != "hidden":
            parts.append(page[at:stop])
        if not found:
            break
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[5], found[6], found[7])
        if not tag:
            if found[0].startswith("<![CDATA[") and stack[-1][1] != "hidden":
                parts.append(html.escape(found[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if tag in _BLOCKS and stack[-1][1] != "hidden":
            end_block()
        if closing:
            if tag not in _VOID and (depth := _innermost(stack, tag)):
                if "hidden" != stack[-1][1] != stack[depth - 1][1]:
                    end_block()
                del stack[depth:]
            continue
        if tag in _VOID:
            continue
        if tag in ("li", "td", "th", "tr", "p", "dt", "dd", "option") and stack[-1][0] == tag:
            stack.pop()
        if tag == "body":
            stack = [entry for entry in stack if entry[0] not in ("head", "title")]
        kind = _kind(tag, attributes, stack[-1][1])
        if kind != stack[-1][1] != "hidden" != kind:
            end_block()
        if tag in _RAW:
            close = re.compile(f"</{tag}[\\s/>]", re.I).search(page, at)
            at = close.start() if close else size
            if close and (rest := page.find(">", close.start())) >= 0:
                at = rest + 1
            continue
        if not found[4]:
            stack.append((tag, kind))
    end_block()
    return out


def _innermost(stack: list[tuple[str, str]], tag: str) -> int:
    """Where the innermost open element of that name stands; 0 if none is open."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth][0] == tag:
            return depth
    return 0


def shared_lines(ours: list[int], other: list[int]) -> list[bool]:
    """Which of our lines a longest common subsequence with another page's lines holds.

    Bit-parallel: one integer per row of the table, with a bit for each of the other page's lines.
    """
    common = set(ours) & set(other)
    rows = [k for k, line in enumerate(ours) if line in common]
    theirs = [line for line in other if line in common]
    where: dict[int, int] = {}
    for j, line in enumerate(theirs):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(theirs)) - 1
    state, states = full, [full]
    for k in rows:
        match = state & where[ours[k]]
        state = ((state + match) | (state - match)) & full
        states.append(state)
    out = [False] * len(ours)
    j = len(theirs)
    for i in range(len(rows), 0, -1):
        # Zeros below a place count the longest common subsequence up to there.
        while j and _zeros(states[i], j) == _zeros(states[i], j - 1):
            j -= 1
        if j and _zeros(states[i], j) != _zeros(states[i - 1], j):
            out[rows[i - 1]] = True
            j -= 1
    return out


def _zeros(state: int, width: int) -> int:
    return width - (state & ((1 << width) - 1)).bit_count()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "url", "main", "lines", "marks"]
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            texts, lines, marks, ends = [], [], [np.empty(0, np.int64)], [0]
            for page in part.column(2):
                found = blocks(page.as_py().decode("utf-8", "replace"))
                main = [t for kind, t in found if kind == _MAIN]
                texts.append("\n".join(main) if main else None)
                lines.append(None if main else [t if kind == _OPEN else None for kind, t in found])
                # The last bit tells whether a line lies in the main part.
                told = [xxhash.xxh64_intdigest(t) >> 1 << 1 | (kind == _MAIN) for kind, t in found]
                marks.append(np.array(told, np.uint64).view(np.int64))
                ends.append(ends[-1] + len(found))
            columns = [
                pa.array(texts, pa.string()),
                pa.array(lines, pa.list_(pa.string())),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(marks))),
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=names)


def _own_lines(lines: list[str | None], marks: list[int], others: list[list[int]], recurring: set[int]) -> list[str]:
    """Open lines without those shared with the first of ``others`` that is no copy.

    A copy shares over ``COPY_SHARE`` of the text that does not recur on the host; only the recurring
    part of what it shares goes.
    """
    single = [0 if line is None or mark in recurring else len(line) for line, mark in zip(lines, marks)]
    gone = [False] * len(lines)
    for other in others:
        shared = shared_lines(marks, other)
        left = sum(size for size, same in zip(single, shared) if not same)
        copy = left < (1 - COPY_SHARE) * sum(single)
        gone = [g or same and (not copy or mark in recurring) for g, same, mark in zip(gone, shared, marks)]
        if not copy:
            break
    return [line for line, g in zip(lines, gone) if line is not None and not g]


def _own_places(marks: list[int], others: list[list[int]], recurring: set[int]) -> list[int]:
    """Places among the lines of a marked part of those that recur there on the host and that one of ``others`` shares."""
    gone = [False] * len(marks)
    for other in others:
        gone = [g or same and mark in recurring for g, same, mark in zip(gone, shared_lines(marks, other), marks)]
    return [place for place, g in enumerate(g for g, mark in zip(gone, marks) if mark & 1) if g]


def _nearest_first(row: dict) -> list[list[int]]:
    sides = [(row["near_before"], row["before"]), (row["near_after"], row["after"])]
    return [other for _, other in sorted((s for s in sides if s[1] is not None), key=lambda s: -s[0])]


def _unmarked(marks: list[int]) -> list[int]:
    return [mark >> 1 << 1 for mark in marks]


_SIDES = ["before", "near_before", "after", "near_after", "recurring"]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the lines that a page with a marked part loses; open pages keep what they are compared with."""
    for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
        rows = batch.to_pylist()
        gone = [None if r["open"] else _own_places(r["marks"], _nearest_first(r), set(r["recurring"] or [])) for r in rows]
        sides = [pa.array([r[name] if r["open"] else None for r in rows], batch.schema.field(name).type) for name in _SIDES]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("same"), pa.array(gone, pa.list_(pa.int32())), *sides],
            names=["host", "same", "gone", *_SIDES],
        )


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Open lines that the page with the nearest URL does not share."""
    for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
        texts = []
        for row in batch.to_pylist():
            others = [_unmarked(other) for other in _nearest_first(row)]
            marks, recurring = _unmarked(row["marks"] or []), set(row["recurring"] or [])
            texts.append("\n".join(_own_lines(row["lines"] or [], marks, others, recurring)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def _common_lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([len(commonprefix(pair)) for pair in zip(a, b)], dtype="int64")


def _common_start(a: str, b: str) -> Column:
    """Length of the common beginning of two texts of columns; a missing one is empty."""
    return F.pandas_udf(_common_lengths, "bigint")(text_or_empty(a), text_or_empty(b))


def _recurring(placed: DataFrame) -> DataFrame:
    """``(place, recurring)``: lines of every page that recur on its host's distinct pages.

    For an open page a line counts wherever it lies; for a marked one only lines of marked parts do, and
    only if most pages, and many, have them there: a passage that articles quote is on fewer.  Lines and
    hosts are counted before any page is met, so a line or host with many pages can be split.
    """
    anywhere = F.transform("marks", lambda mark: F.shiftleft(F.shiftright(mark, 1), 1))
    inside = F.filter("marks", lambda mark: mark.bitwiseAND(F.lit(1)) == 1)
    both = F.explode(F.array_distinct(F.concat(anywhere, inside))).alias("mark")
    counts = placed.select("host", both).groupBy("host", "mark").agg(F.count("*").alias("n"))
    counts = stored(counts.where(F.col("n") >= FEW_PAGES))
    hosts = stored(placed.groupBy("host").agg(F.count("*").alias("n_pages")))
    many, most = F.col("n") >= MANY_PAGES, F.col("n") >= MOST_PAGES * F.col("n_pages")
    in_main = F.col("mark").bitwiseAND(F.lit(1)) == 1
    often = counts.join(hosts, "host").where(F.when(in_main, many & most).otherwise(many | most)).select("host", "mark")
    own = F.array_distinct(F.when(F.col("open"), anywhere).otherwise(inside))
    met = placed.select("place", "host", F.explode(own).alias("mark")).join(often, ["host", "mark"])
    return met.groupBy("place").agg(F.collect_list("mark").alias("recurring"))


def _with_neighbours(placed: DataFrame) -> DataFrame:
    """Every distinct page with the marks of those before and behind it on its host, and how much of the path they share.

    Places are cut into blocks; a page at an end of one also goes to the next, so one exchange gives both sides.
    """
    block = F.floor(F.col("place") / PLACES)
    near = F.array_distinct(F.array(*(F.floor((F.col("place") + k) / PLACES) for k in (-1, 0, 1))))
    spread = placed.select("host", "same", "open", "path", "place", "marks", F.explode(near).alias("block"))
    in_block = Window.partitionBy("block").orderBy("place")
    page = F.struct("host", "path", "marks")
    found = spread.withColumns({"_before": F.lag(page).over(in_block), "_after": F.lead(page).over(in_block)})
    found = found.where(F.col("block") == block)
    for name in ("before", "after"):
        same_host = F.col("host") == F.col(f"_{name}.host")
        found = found.withColumn(name, F.when(same_host, F.col(f"_{name}.marks"))).withColumn(
            f"_{name}", F.when(same_host, F.col(f"_{name}.path"))
        )
    for name in ("before", "after"):
        found = found.withColumn(f"near_{name}", _common_start("path", f"_{name}"))
    return found.drop("_before", "_after", "path", "block")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text.

    A page is cut into blocks; character references are decoded and white space in a block becomes
    one space.  Scripts, styles, forms, menus, footers, sidebars, notices, adverts and reader
    comments are told by their elements, roles and names.  Every page is then compared with the ones
    whose URL paths are nearest on its host: lines are aligned by a longest common subsequence.

    Where a page marks no main part, lines shared with the nearest one are deleted.  A neighbour that
    shares over four fifths of the text is a copy, and the one on the other side is taken; without
    another, all stays.  Lines that recur on the host's distinct pages (eight, or four fifths of them and at
    least three) do not count for that and go if a neighbour shares them, however little is left.

    Where a page marks its main part, that part's lines are aligned with those of its neighbours' marked
    parts.  A shared line belongs to the template if four fifths of the host's distinct pages, and at
    least eight, have it in theirs, and is deleted; a shared passage on fewer pages is one that articles
    quote, and stays.  Where less than a fifth of the part would be left, the pages are copies of one
    article and all of it stays.  Pages of a host whose blocks are all equal count as one neighbour, and
    empty pages as none.

    A missing page or URL is empty (pages without URL are one host); equal rows are rows like any
    other.  Neighbours are found by one sort over all hosts, so a large host is no group.
    """
    ready(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), text_or_empty(html_col).cast("binary").alias("h")
    )
    schema = "page_id bigint, url string, main string, lines array<string>, marks array<bigint>"
    parsed = stored(rows.mapInArrow(_parse, schema).withColumn("row", F.monotonically_increasing_id()))
    host, path = (F.regexp_extract(F.coalesce("url", F.lit("")), _ADDRESS, k) for k in (1, 2))
    named = parsed.withColumns({"host": F.lower(host), "path": path, "same": F.xxhash64("marks")})
    first = F.struct("path", "url", "row")
    distinct = (
        named.where(F.size("marks") > 0)
        .groupBy("host", "same")
        .agg(F.min(first).alias("first"), F.max(F.col("main").isNull()).alias("open"))
    )
    kept = distinct.select("host", "same", "open", "first.*").join(named.select("row", "marks"), "row")
    placed = ranked(kept, F.col("host"), F.col("path"), F.col("url"), F.col("row"), rank="place")

    sides = "before array<bigint>, near_before bigint, after array<bigint>, near_after bigint, recurring array<bigint>"
    found = _with_neighbours(placed).join(_recurring(placed), "place", "left").drop("place")
    near = stored(found.mapInArrow(_compare, f"host string, same bigint, gone array<int>, {sides}"))
    open_pages = named.where("main IS NULL").select("page_id", "url", "lines", "marks", "host", "same")
    pairs = open_pages.join(near.where("gone IS NULL").drop("gone"), ["host", "same"], "left").drop("host", "same")
    differed = pairs.mapInArrow(_difference, "page_id bigint, url string, text string")

    # Stored by itself, so Spark knows that it is small before it would exchange the texts for the join.
    gone = stored(near.where(F.size("gone") > 0).select("host", "same", "gone"))
    marked = named.where("main IS NOT NULL").select("page_id", "url", "main", "host", "same")
    lines = F.filter(F.split("main", "\n"), lambda line, place: ~F.array_contains("gone", place))
    left = F.array_join(lines, "\n")
    copies = F.length(left) < (1 - COPY_SHARE) * F.length("main")
    text = F.when(F.col("gone").isNull() | copies, F.col("main")).otherwise(left)
    return marked.join(gone, ["host", "same"], "left").select("page_id", "url", text.alias("text")).union(differed)
