"""Main text of web pages: each is differenced against the page of the nearest URL, then checked against its markup.

Blocks of text come from one pass over the tags. Elements that never hold the article (scripts, forms, menus,
headers, footers, sidebars, and what class or id names an advert, a notice or comments) are left out. Every page then
meets the page of its host with the nearest URL path: both pages' blocks are aligned by a longest common subsequence, and
those that are shared count as the site's. The markup has the last word where it is plain: a shared block inside an article
or main element is put back, since articles share paragraphs, and a block outside it goes, since menus differ
from page to page. Differencing decides on pages without such an element, and on blocks of which only part of
a name speaks of sharing or notices ("share-price"): they go if shared, or if there is no page to compare with.

A host's pages of equal blocks are merged, and the first by path and page_id stands for
all: copies get equal texts, and no page's neighbour is its own copy. These are dealt to ranges of (host, path, page_id),
each block as a hash of 64 bits; of the pages before and after, the nearest is that with more leading path parts in common, the earlier one on a tie.
All of a neighbour's blocks count, also those outside its article. A page whose copies are alone on their host keeps all open blocks.
The texts themselves are read again and meet what was found by host and digest.

Null and empty pages give the empty text; a null URL is a host of its own; equal URLs are ordered by
page_id; repeated rows are one another's copies and give equal texts. Truncated pages are read as far as they go.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterable, Iterator
from itertools import takewhile

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayengine.llm.ranges import cuts_of, lasts_of, with_neighbours
from delayengine.llm.words import pieces
from delayengine.session import stage

ROWS_PER_RANGE = 2000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe|select)\b[^>]*(?:>.*?(?:</\1\s*>|\Z)|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_NEVER = frozenset("aside button dialog footer form head menu nav".split())
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr menu modal nav navbar navigation newsletter notice popup promo related share sharing sidebar social sponsor sponsored".split()
)
_DOUBTFUL = frozenset("notice share sharing social".split())  # as part of a longer name they may be the article's own
_OUT, _ASKED, _ARTICLE = 4, 2, 1  # marks of a block: left out, to be decided by differencing, in an article or main element


def _unwanted(name: str, attributes: str, inside: bool) -> int:
    """``_OUT``, ``_ASKED`` or 0 for an element."""
    if name in _NEVER or (name == "header" and not inside):
        return _OUT
    if not attributes or name in ("html", "body"):
        return 0
    names = [n for m in _NAMES.finditer(attributes) for n in m[1].lower().strip("\"'").split()]
    words = {w for n in names for w in re.findall(r"[a-z]+", n)}
    found = words & _WORDS
    if found - _DOUBTFUL or (not inside and "header" in words) or found & set(names):
        return _OUT
    return _ASKED if found else 0


def all_blocks(page: str) -> list[tuple[str, int]]:
    """The page's blocks of text in order, each with its marks; those left out are not among them."""
    found: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = []  # name, marks
    at = 0

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            found.append((text, stack[-1][1] if stack else 0))

    def out() -> bool:
        return bool(stack) and bool(stack[-1][1] & _OUT)

    for token in _TOKEN.finditer(page):
        if token.start() > at and not out():
            parts.append(page[at:token.start()])
        at = token.end()
        name = (token[3] or "").lower()
        if not name:
            continue
        if name in _BLOCK:
            flush()
        elif name in ("br", "img", "input"):
            parts.append(" ")
        if name in _VOID:
            continue
        if token[2]:
            names = [s[0] for s in stack]
            if name in names:
                del stack[len(names) - 1 - names[::-1].index(name):]
            continue
        if name in _BLOCK:  # a paragraph ends where the next block begins
            names = [s[0] for s in stack]
            if "p" in names:
                del stack[len(names) - 1 - names[::-1].index("p"):]
            if name == "li" and names[-1:] == ["li"]:
                stack.pop()
        if token[4].endswith("/"):
            continue
        marks = stack[-1][1] if stack else 0
        stack.append((name, marks | _unwanted(name, token[4], bool(marks & _ARTICLE)) | (_ARTICLE if name in ("article", "main") else 0)))
    if at < len(page) and not out():
        parts.append(page[at:])
    flush()
    return found


def blocks(page: str) -> tuple[list[str], bool]:
    """The blocks that a page alone keeps, in order, and whether they come from an article or main element."""
    found = all_blocks(page)
    whole = any(m & _ARTICLE for _, m in found)
    return [text for text, m in found if (m & _ARTICLE or not whole) and not m & _ASKED], whole


def shared(lines: list, other: list) -> set[int]:
    """Positions in ``lines`` that a longest common subsequence of both lists uses (bit-parallel rows, then a walk back)."""
    both = set(lines) & set(other)
    places = [i for i, line in enumerate(lines) if line in both]  # only lines that both have cost anything
    lines, other = [lines[i] for i in places], [line for line in other if line in both]
    kinds: dict = {}
    for j, line in enumerate(other):
        kinds[line] = kinds.get(line, 0) | 1 << j
    full, row = (1 << len(other)) - 1, (1 << len(other)) - 1
    rows = [row]
    for line in lines:  # a zero bit: the subsequence grows at this column
        hit = row & kinds.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    used, j = set(), len(other)
    for i in range(len(lines), 0, -1):
        length = lambda r, k: k - (rows[r] & ((1 << k) - 1)).bit_count()
        while j and length(i, j) == length(i, j - 1):
            j -= 1
        if j and length(i - 1, j) < length(i, j):
            used.add(places[i - 1])
            j -= 1
    return used


def _near(path: str, other: str) -> int:
    return sum(1 for _ in takewhile(lambda x: x[0] == x[1], zip(path.split("/"), other.split("/"), strict=False)))


def gone_from(page: tuple, neighbours: list[tuple]) -> list[bool] | None:
    """``page`` and neighbours: (host, path, blocks). For each block whether the nearest page of the host shares it; None without one."""
    host, path, own = page
    others = [n for n in neighbours if n[0] == host]
    if not others:
        return None
    nearest = max(others, key=lambda n: _near(path, n[1]))  # the first on a tie
    gone = shared(list(own), list(nearest[2]))
    return [i in gone for i in range(len(own))]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def _parsed(pages: Iterable[str | None]) -> Iterator[tuple[list[tuple[str, int]], bytes]]:
    """Blocks with marks, and a digest of the blocks."""
    for page in pages:
        found = all_blocks(page or "")
        yield found, hashlib.blake2b("\n".join(text for text, _ in found).encode(), digest_size=16).digest()


def _hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "html"):
            parsed = list(_parsed(piece.column("html").to_pylist()))
            yield pa.RecordBatch.from_arrays([
                piece.column("page_id"), piece.column("host"), piece.column("path"),
                pa.array([[_hash(text) for text, _ in found] for found, _ in parsed], pa.list_(pa.int64())),
                pa.array([digest for _, digest in parsed], pa.binary()),
            ], ["page_id", "host", "path", "blocks", "digest"])


def _with_digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "html"):
            parsed = list(_parsed(piece.column("html").to_pylist()))
            yield pa.RecordBatch.from_arrays([
                piece.column("page_id"), piece.column("url"), piece.column("host"),
                pa.array([[text for text, _ in found] for found, _ in parsed], pa.list_(pa.string())),
                pa.array([[m for _, m in found] for found, _ in parsed], pa.list_(pa.int32())),
                pa.array([digest for _, digest in parsed], pa.binary()),
            ], ["page_id", "url", "host", "blocks", "marks", "digest"])


def _differenced(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ranges in order, in batches; a page is done when the one after it in its range is known."""
    last = this = None

    def done(following):
        three = [None if p is None else (p.host, p.path, p.blocks) for p in (last, this, following)]
        return this.host, this.digest, gone_from(three[1], [t for t in (three[0], three[2]) if t])

    for frame in frames:
        out = []
        for page in frame.itertuples(index=False):
            same = this is not None and this.range == page.range
            if this is not None and not this.guest:
                out.append(done(page if same else None))
            last, this = this if same else None, page
        yield pd.DataFrame(out, columns=["host", "digest", "gone"])
    if this is not None and not this.guest:
        yield pd.DataFrame([done(None)], columns=["host", "digest", "gone"])


def extract(pages: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """page_id, url and text of each page."""
    place = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)", 0)
    host, path = F.lower(F.regexp_extract(place, "//([^/]*)", 1)), F.regexp_extract(place, "//[^/]*(.*)", 1)
    pages = pages.select(F.col("page_id").cast("long"), "url", "html", host.alias("host"), path.alias("path"))
    key = F.concat("host", F.lit("\x01"), "path", F.lit("\x01"), F.lpad(F.coalesce("page_id", F.lit(0)).cast("string"), 20, "0"))
    hashed = pages.drop("url").mapInArrow(_hashed, "page_id bigint, host string, path string, blocks array<bigint>, digest binary")
    kinds = hashed.groupBy("host", "digest").agg(
        F.min(F.struct(key.alias("key"), "path")).alias("place"), F.first("blocks").alias("blocks")
    )
    kinds = stage(kinds.select("host", "digest", "place.key", "place.path", "blocks"), "page-kinds")
    cuts = cuts_of(kinds, F.col("key"), rows_per_range)
    placed = with_neighbours(kinds, F.col("key"), cuts, lasts_of(kinds, F.col("key"), cuts))
    dealt = placed.repartition("range").sortWithinPartitions("range", "key", "digest")
    found = stage(dealt.mapInPandas(_differenced, "host string, digest binary, gone array<boolean>"), "page-gone")
    read = pages.drop("path").mapInArrow(_with_digest, "page_id bigint, url string, host string, blocks array<string>, marks array<int>, digest binary")
    whole = F.exists("marks", lambda m: m.bitwiseAND(_ARTICLE) != 0)

    def stays(_: Column, i: Column) -> Column:
        mark, gone = F.get("marks", i), F.coalesce(F.get("gone", i), F.lit(False))
        asked = mark.bitwiseAND(_ASKED) != 0
        return (~whole | (mark.bitwiseAND(_ARTICLE) != 0)) & ~(asked & F.col("gone").isNull()) & ~((asked | ~whole) & gone)

    text = F.array_join(F.filter("blocks", stays), "\n")
    return read.join(found, ["host", "digest"]).select("page_id", "url", text.alias("text"))


def texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
