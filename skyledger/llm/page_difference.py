"""Main text of web pages, by the difference to the page with the nearest URL, checked by markup.

Every page goes through the named method with all lines that it shows: pages of a host are put in
the order of their URL paths, a page is paired with the neighbour whose path shares the longest
prefix, the lines of both are aligned by longest common subsequence, and lines they share go.

Alone, the method cannot give right results: menus and adverts may differ from page to page, copies
of an article on one host would delete each other, and a heading may stand in two articles. So its
result is checked by markup. What stands in menus, headers, footers, sidebars, forms, notices,
adverts or comments by its tag, role or class goes even if no other page has it. If a page has
articles, those that keep a line of their own are the text, whole, and an article that the
neighbour shares line by line goes; where no article keeps a line, all stay.

Pages of one host with the same lines outside such places count once, and a neighbour that shares
half of the characters there is a copy, for which the other neighbour is taken; where both are
copies, or a host has one page only, nothing is deleted.

Neighbours are found from hashes of lines, a few bytes a line, in sorted slices, so that no host is
one task; texts are not shuffled. Longest common subsequences are exact, over bit vectors and by
halving, in memory linear in the lines.

Defined results: null html is empty and its text is empty; a page without main text has an empty
one; a null url is a host of its own; repeated rows give repeated results; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.storage import stored
from skyledger.operators.lookups import lookup_join
from skyledger.operators.ordered import with_previous
from skyledger.operators.shared import settle

# Regions, the later ones are nearer to the text; each article has a number from ARTICLE on.
HIDDEN, MARKED, FORM, OPEN, MAIN, ARTICLE = range(6)
COPY_SHARE = 0.5
OUT_BYTES = 8 << 20

HIDDEN_TAGS = set(
    "script style template noscript title head iframe object svg math canvas audio video select"
    " datalist textarea button".split()
)
MARKED_TAGS = set("nav footer aside menu dialog form".split())
BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav"
    " ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
MARKED_ROLES = set(
    "navigation contentinfo complementary search form alert alertdialog dialog menu menubar toolbar"
    " banner".split()
)
NOISE = set(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner popup modal"
    " overlay cookie cookies consent gdpr notice notices alert nav navbar navigation menu menus"
    " breadcrumb breadcrumbs pagination pager toolbar topbar masthead sidebar aside widget widgets"
    " footer share sharing social related recommended newsletter subscribe signup login search"
    " comment comments disqus respond replies form skip".split()
)
COMMENT = {"comment", "comments", "reply", "replies", "disqus"}
NOT_OF = {"no", "has", "with", "without", "not", "is"}
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def noisy(names: str, words: set[str]) -> bool:
    """Whether a class or id is named for one of the words: its first or last part is one."""
    for name in names.split():
        parts = [p.lower() for p in _PART.findall(name)]
        if parts and parts[0] not in NOT_OF and (parts[0] in words or parts[-1] in words):
            return True
    return False


class Blocks(HTMLParser):
    """Blocks of text of a page in order, each with the region it stands in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[int, str]] = []
        self.parts: list[str] = []
        self.where = OPEN  # region of the parts
        self.aside: list[str] = []  # what stands in a marked region or a form
        self.articles = 0
        self.stack: list[tuple[str, int]] = []
        self.open: Counter[str] = Counter()

    def region(self) -> int:
        return self.stack[-1][1] if self.stack else OPEN

    def flush(self) -> None:
        for region, parts in ((self.where, self.parts), (MARKED, self.aside)):
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append((region, text))
                parts.clear()

    def handle_data(self, data: str) -> None:
        region = self.region()
        if region > FORM:
            if region != self.where:
                if self.parts:
                    self.flush()
                self.where = region
            self.parts.append(data)
        elif region != HIDDEN:
            self.aside.append(data)

    def _entered(self, tag: str, attrs: dict[str, str | None]) -> int | None:
        """The region a tag begins, None if it stays in the one around it."""
        around = self.region()
        if around == HIDDEN or tag in ("html", "body"):
            return None
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        role = (attrs.get("role") or "").strip().lower()
        if tag in HIDDEN_TAGS or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return HIDDEN
        if "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return HIDDEN
        if around == MARKED:
            return None
        if tag in ("article", "main") or role in ("article", "main"):
            if noisy(names, COMMENT):
                return MARKED
            if around >= ARTICLE:
                return around
            if "main" in (tag, role):
                return MAIN
            self.articles += 1
            return ARTICLE + self.articles - 1
        if tag == "form":
            return FORM if around < MAIN else MARKED
        if tag in MARKED_TAGS or (role in MARKED_ROLES) or noisy(names, NOISE):
            return MARKED
        if around < MAIN and (tag == "header" or noisy(names, {"header"})):
            return MARKED
        return None

    def _pop(self, tag: str) -> None:
        while self.stack:
            top, _ = self.stack.pop()
            self.open[top] -= 1
            if top == tag:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data(" ")
            return
        if tag in BLOCK_TAGS:
            self.flush()
            if self.open["p"]:
                self._pop("p")
            if tag == "li" and self.stack and self.stack[-1][0] == "li":
                self._pop("li")
        if tag in VOID_TAGS:
            return
        entered = self._entered(tag, dict(attrs))
        if entered is not None:
            self.flush_inline(entered)
        if entered is not None or self.open[tag]:
            self.stack.append((tag, self.region() if entered is None else entered))
            self.open[tag] += 1

    def flush_inline(self, entered: int) -> None:
        """What stands before a region belongs to the region around it."""
        if entered > FORM and entered != self.region():
            self.flush()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in BLOCK_TAGS and tag not in VOID_TAGS and self.open[tag]:
            self._pop(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        if self.open[tag]:
            self._pop(tag)


def blocks(html: str | None) -> list[tuple[int, str]]:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return parser.blocks


def _main(found: list[tuple[int, str]]) -> list[str]:
    """Lines of all articles, else of the region nearest to the text."""
    best = min(ARTICLE, max((region for region, _ in found if region > FORM), default=OPEN))
    return [t for region, t in found if min(region, ARTICLE) == best]


def main_lines(html: str | None) -> tuple[bool, list[str], list[str]]:
    """Whether the page has an article, its main lines by markup, and all lines not marked."""
    found = blocks(html)
    article = any(region >= ARTICLE for region, _ in found)
    return article, _main(found), [t for region, t in found if region > FORM]


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Length of the longest common subsequence of a and each prefix of b."""
    places: dict[int, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        both = row & places.get(line, 0)
        row = ((row + both) | (row - both)) & full
    bits = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(1 - np.unpackbits(bits, bitorder="little")[: len(b)].astype(np.int64))])


def common_subsequence(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places in a of a longest common subsequence of a and b."""
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    known = set(a[start : len(a) - end]) & set(b[start : len(b) - end])
    left = [i for i in range(start, len(a) - end) if a[i] in known]
    right = [line for line in b[start : len(b) - end] if line in known]
    inner = [left[i] for i in _halved([a[i] for i in left], right)]
    return [*range(start), *inner, *range(len(a) - end, len(a))]


def _halved(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [0] if a[0] in b else []
    middle = len(a) // 2
    upper = _lengths(a[:middle], b)
    lower = _lengths(a[middle:][::-1], b[::-1])[::-1]
    cut = int(np.argmax(upper + lower))
    return _halved(a[:middle], b[:cut]) + [middle + i for i in _halved(a[middle:], b[cut:])]


def address(url: str | None) -> tuple[str | None, str]:
    """Host and path of a URL; what cannot be read as one is a path without host."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or None), parts.path
    except ValueError:
        return None, url or ""


def _signature(lines: list[str]) -> bytes:
    return hashlib.md5("\n".join(lines).encode("utf-8", "surrogatepass")).digest()


def _sign(found: list[tuple[int, str]]) -> bytes:
    """Signature of the lines not marked and the regions they stand in."""
    return _signature([t if region == OPEN else f"{region}\0{t}" for region, t in found if region > FORM])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Host, path, signature, and of every line that a page shows its hash, length and region."""
    for batch in batches:
        rows = []
        if not batch.num_rows:
            continue
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = blocks(html)
            host, path = address(url)
            # A menu entry and a line of the text are not the same line.
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(t, region <= FORM) for region, t in found), np.uint64, len(found))
            sizes = np.fromiter((len(t) for _, t in found), np.int32, len(found))
            regions = np.fromiter((region for region, _ in found), np.int32, len(found))
            rows.append((host, path, _sign(found), hashes.tobytes(), sizes.tobytes(), regions.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), *[pa.binary()] * 4))],
            ["host", "path", "signature", "hashes", "sizes", "regions"],
        )


def _likeness(a: str, b: str) -> int:
    """Letters the beginnings of two paths share."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_lines(page: dict, others: list[dict | None], copy_share: float = COPY_SHARE) -> np.ndarray:
    """Which lines of a page the nearest of the others has too, unless that is a copy of it."""
    near = sorted((o for o in others if o), key=lambda o: -_likeness(page["path"], o["path"]))
    own = np.frombuffer(page["hashes"], np.uint64).tolist()
    sizes = np.frombuffer(page["sizes"], np.int32) * (np.frombuffer(page["regions"], np.int32) > FORM)
    for other in near:
        shared = np.zeros(len(own), bool)
        shared[common_subsequence(own, np.frombuffer(other["hashes"], np.uint64).tolist())] = True
        if sizes[shared].sum() < copy_share * sizes.sum():
            return shared
    return np.zeros(len(own), bool)


def checked(shared: np.ndarray, regions: np.ndarray) -> np.ndarray:
    """Of the main lines by markup, which go: the shared ones, of articles only whole ones."""
    regions, shared = regions[regions > FORM], shared[regions > FORM]
    best = min(ARTICLE, regions.max(initial=OPEN))
    if best < ARTICLE:
        return shared[regions == best]
    own = np.unique(regions[~shared & (regions >= ARTICLE)])
    regions = regions[regions >= ARTICLE]
    return ~np.isin(regions, own) if len(own) else np.zeros(len(regions), bool)


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            shared = shared_lines(r["page"], [r["before"], r["after"]])
            gone = checked(shared, np.frombuffer(r["page"]["regions"], np.int32))
            if gone.any():
                rows.append((r["host"], r["signature"], gone))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary(), pa.list_(pa.bool_())))],
                ["host", "signature", "gone"],
            )


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The main lines of every page by markup."""

    def made(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.list_(pa.string())),
            )],
            ["page_id", "url", "host", "signature", "lines"],
        )

    for batch in batches:
        rows, size = [], 0
        for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
            found = blocks(html)
            lines = _main(found)
            rows.append((page_id, url, address(url)[0], _sign(found), lines))
            size += sum(map(len, lines))
            if size >= OUT_BYTES:
                yield made(rows)
                rows, size = [], 0
        if rows:
            yield made(rows)


def deleted_lines(pages: DataFrame) -> DataFrame:
    """Per host and signature of a page that loses main lines: for each of them, whether it goes."""
    measured = pages.select("url", "html").mapInArrow(
        _measure, "host string, path string, signature binary, hashes binary, sizes binary, regions binary"
    )
    # Equal lines on a host are one page here, under the first of their paths.
    distinct = settle(
        measured.groupBy("host", "signature").agg(
            F.min(F.struct("path", "hashes", "sizes", "regions")).alias("page")
        ),
        "page_lines",
    )
    rows = distinct.frame.withColumn("path", F.col("page.path"))
    order = [F.col("path"), F.col("signature")]
    # Always in slices: a window by host would put a host into one task.
    before = with_previous(rows, ["host"], order, "page", "before", window_rows=0)
    back = [F.col("path").desc(), F.col("signature").desc()]
    both = with_previous(before, ["host"], back, "page", "after", window_rows=0)
    return both.select("host", "signature", "page", "before", "after").mapInArrow(
        _differ, "host string, signature binary, gone array<boolean>"
    )


def main_text(pages: DataFrame) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars."""
    deleted = settle(deleted_lines(pages), "deleted_lines")
    found = pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(
        _extract, "page_id bigint, url string, host string, signature binary, lines array<string>"
    )
    kept = F.col("lines")
    if deleted.rows:
        found = lookup_join(found, deleted, ["host", "signature"], null_safe=True)
        rest = F.filter("lines", lambda _, i: ~F.get("gone", i))
        kept = F.when(F.col("gone").isNull(), kept).otherwise(rest)
    return found.select("page_id", "url", F.array_join(kept, "\n").alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
