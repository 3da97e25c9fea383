"""Main text of web pages by nearest-URL page differencing.

Pages of a host with the same lines outside menus and the like are copies: the
first of them by path stands for all, and they share its result, so copies
never erase each other. These pages are sorted by (host, URL path); a page's
partner is the one of its two neighbours on the same host whose path shares the
longer beginning (the one before it, if equal). The lines of both pages -
blocks of visible text outside such elements - are
aligned by their longest common subsequence, and shared lines are deleted as
the host's template.

What differencing cannot know is settled by the page's own markup: lines in an
``article`` or ``main`` element stay even if shared, and unshared lines outside it go;
so do, anywhere, menus, headers outside the article, footers, sidebars, forms,
scripts, styles, notices, adverts and reader comments, told by element, role,
class or id. On pages without such an element the unshared lines are the text.

Only hashes of lines are sorted and compared; the sorted pages are dealt into
ranges, and the last page before and the first after each range (one row per
range) are added to it, so a host with a third of all pages is spread over
tasks and its pairs are the same for every layout. Texts move once, to meet
the numbers of their deleted lines.

Defined results: null html is an empty page with empty text; a page without
URL or alone on its host has no partner and loses no line by differencing; the
path ends before ``?`` and ``#``, without final slashes; hosts are compared in
lower case; pages with equal host and path are ordered by id; rows equal in id,
URL and html get equal text; a page that only copies of it accompany on its host
loses no line by differencing.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerflow.llm.common import checkpoint_root, parts_for, table

#: Elements of HTML by what they mean for the text.
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "tr", "ul",
))
CHROME = frozenset((
    "aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "iframe", "input", "label", "menu", "nav",
    "noscript", "object", "search", "select", "svg", "template", "textarea", "video",
))
CHROME_ROLES = frozenset(("alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"))
CHROME_NAMES = frozenset((
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie",
    "cookies", "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "pagination", "popup", "promo", "promoted", "related", "replies", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "widget",
))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
MAIN = frozenset(("article", "main"))

#: Elements whose content is text up to their own end tag; none of it is shown.
RAW = frozenset(("iframe", "noembed", "noframes", "script", "style", "textarea", "title", "xmp"))
LISTED = frozenset(("dd", "dt", "li", "option", "td", "th", "tr"))
HOLDERS = frozenset(("article", "div", "dl", "main", "menu", "ol", "select", "table", "ul"))

_TAG = re.compile(r"</?([a-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>", re.I)
_PLAIN_TAG = re.compile(r"</?([a-z][^\s/>]*+)([^>]*+)>", re.I)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
#: Words that only say where a part of the page stands.
PLACES = frozenset(("bottom", "global", "left", "page", "primary", "right", "secondary", "site", "top"))
#: Words that only say what a part of the page is built of.
SHAPES = frozenset(("area", "bar", "block", "box", "container", "inner", "link", "links", "list", "outer", "post", "posts", "section", "slot", "wrap",
                    "wrapper"))
#: Of the chrome names, those of what readers wrote or what leads to other pages.
FOREIGN = frozenset(("comment", "comments", "disqus", "promo", "promoted", "related", "replies", "sponsor", "sponsored"))
#: One attribute with its value, so that no name is found inside a value.
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[a-z]+")


def _is_chrome(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in CHROME or tag == "header" and not in_main:
        return True
    if not attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in CHROME_ROLES:
            return True
        if name in ("class", "id") and tag not in ("html", "body", *MAIN) and any(map(_names_chrome, value.split())):
            return True
    return False


def _names_chrome(token: str) -> bool:
    """Whether a class or id is made of chrome names alone, places and shapes
    aside: ``cookie-notice``, ``site-footer`` and ``comment-list``, but not
    ``with-sidebar``."""
    names = set(_NAME.findall(token)) - PLACES - SHAPES
    return bool(names) and names <= CHROME_NAMES


def _is_foreign(attributes: str) -> bool:
    return any(name.lower() in ("class", "id") and not FOREIGN.isdisjoint(_NAME.findall("".join(values).lower()))
               for name, *values in _ATTRIBUTE.findall(attributes))


def markup(page: str) -> Iterator[tuple[int, int, str | None, str, bool]]:
    """(start, end, tag, attributes, whether it closes) of everything in the page
    that is no text, in order; ``tag`` is None for comments, declarations and
    elements without shown text. One pass: a page is searched to its end at most
    once for anything that is missing (a ``>``, a quote, the end of a comment or
    of a script). A comment or script without end takes the rest of the page, a
    tag without end is text. Quotes count after ``=`` only, and no longer once a
    tag has no end outside of them."""
    last, tag_at, at = page.rfind(">"), _TAG, page.find("<")
    while 0 <= at:
        after = page[at + 1:at + 2]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 2)
            end = len(page) if end < 0 else end + 3
            yield at, end, None, "", False
        elif at > last:
            end = page.find("<!--", at)
            if end < 0:
                return
            yield end, len(page), None, "", False
            return
        elif after in ("!", "?") or after == "/" and not page[at + 2:at + 3].isalpha():
            end = page.find(">", at) + 1
            yield at, end, None, "", False
        elif m := (tag_at.match(page, at) or _PLAIN_TAG.match(page, at)):
            if m.re is not tag_at:
                tag_at = _PLAIN_TAG
            end, tag = m.end(), m[1].lower()
            if tag in RAW and after != "/":
                close = _RAW_END[tag].search(page, end)
                end = len(page) if close is None else page.find(">", close.end()) + 1 or len(page)
                yield at, end, None, "", False
            else:
                yield at, end, tag, m[2], after == "/"
        else:
            end = at + 1
        at = page.find("<", end)


def lines_of(page: str, lift: bool = False) -> tuple[list[str], list[bool], bool]:
    """The page's lines, whether each is main text by markup, and whether the
    page has an article or main element. No element around a ``main`` is
    chrome; neither is one around an ``article`` (``lift``), if the page has no
    other main text, and either no text at all outside chrome or less than
    in articles that neither readers' comments nor teasers surround: otherwise
    it holds those. An article inside a list item is an entry of a list and
    marks no main text."""
    lines: list[str] = []
    main: list[bool] = []
    piece: list[str] = []
    open_: list[tuple[str, bool, bool, bool]] = []  # open blocks (and chrome of any kind): tag, chrome, main, foreign
    places: dict[str, list[int]] = {}  # of each tag, where it is in open_
    chrome = inside = foreign = done = plain = buried_text = clean = buried = 0
    has_main = False

    def end_line() -> None:
        nonlocal plain, buried_text
        if piece:
            text = " ".join(references.unescape("".join(piece)).split())
            piece.clear()
            if text:
                lines.append(text)
                main.append(inside > 0 and not chrome)
                if not chrome:
                    plain += len(text)
                elif inside and not foreign:
                    buried_text += len(text)

    def close(down_to: int) -> None:
        nonlocal chrome, inside, foreign, clean
        end_line()
        while len(open_) > down_to:
            tag, was_chrome, was_main, was_foreign = open_.pop()
            places[tag].pop()
            chrome -= was_chrome
            inside -= was_main
            foreign -= was_foreign
        clean = min(clean, len(open_))

    for start, end, tag, attributes, closes in markup(page):
        if start > done:
            piece.append(page[done:start])
        done = end
        if tag is None:
            continue
        if closes:
            if places.get(tag):
                close(places[tag][-1])
            elif tag in BLOCKS:
                end_line()
            continue
        if tag in VOID:
            piece.append(" ")
            if tag == "hr":
                end_line()
            continue
        if tag in BLOCKS:
            end_line()
            if open_ and open_[-1][0] == "p":
                close(len(open_) - 1)
            if tag in LISTED and places.get(tag):
                holders = HOLDERS | {"tr"} if tag in ("td", "th") else HOLDERS
                if places[tag][-1] > max((places[h][-1] for h in holders if places.get(h)), default=-1):
                    close(places[tag][-1])
        is_chrome = _is_chrome(tag, attributes, inside > 0)
        if tag in BLOCKS or is_chrome:
            if is_chrome:
                end_line()
            if not attributes.endswith("/") or tag in BLOCKS:
                listed = places.get("li") and (places.get("ul") or places.get("ol"))
                is_main = tag == "main" or tag == "article" and (inside > 0 or not listed)
                if is_main and chrome:
                    if lift or tag == "main":
                        open_[clean:] = [(t, False, m, f) for t, _, m, f in open_[clean:]]
                        chrome, clean = 0, len(open_)
                    else:
                        buried += 1
                is_foreign = is_chrome and _is_foreign(attributes)
                places.setdefault(tag, []).append(len(open_))
                open_.append((tag, is_chrome, is_main, is_foreign))
                chrome += is_chrome
                inside += is_main
                foreign += is_foreign
                has_main = has_main or is_main and not chrome
    if done < len(page):
        piece.append(page[done:])
    close(0)
    if buried and not any(main) and not lift and (not plain or buried_text > plain):
        return lines_of(page, True)
    return lines, main, has_main


def outside_chrome(page: str) -> list[str]:
    """The lines outside chrome of a page without main element."""
    lines, kept, _ = lines_of(f"<main>{page}</main>")
    return [x for x, m in zip(lines, kept, strict=True) if m]


# ---- alignment ------------------------------------------------------------

def _rows(a: list[int], b: list[int]) -> list[int]:
    """Bit-parallel rows: a zero bit j of row i says that the common
    subsequence of a[:i] and b[:j+1] is longer than that of a[:i] and b[:j]."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        v = rows[-1]
        u = v & places.get(x, 0)
        rows.append((v + u | v - u) & full)
    return rows


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Common subsequence of a with each beginning of b."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = v = (1 << len(b)) - 1
    for x in a:
        u = v & places.get(x, 0)
        v = (v + u | v - u) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(-(-len(b) // 8) or 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared_lines(a: list[int], b: list[int], most: int = 1 << 22) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``. Above
    ``most`` cells, ``a`` is halved where the halves' lengths add up best."""
    start, end = 0, 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    head, tail = list(range(start)), list(range(len(a) - end, len(a)))
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if not a or not b:
        return head + tail
    if len(a) * len(b) > most and len(a) > 1:
        half = len(a) // 2
        cut = int((_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]).argmax())
        found = shared_lines(a[:half], b[:cut], most) + [half + i for i in shared_lines(a[half:], b[cut:], most)]
    else:
        rows, found = _rows(a, b), []
        i, j = len(a), len(b)
        while i and j:
            below = (1 << j) - 1
            if rows[i] >> j - 1 & 1:
                j -= 1
            elif (~rows[i - 1] & below).bit_count() == (~rows[i] & below).bit_count():
                i -= 1
            else:
                i, j = i - 1, j - 1
                found.append(i)
        found.reverse()
    return head + [start + i for i in found] + tail


# ---- pairing --------------------------------------------------------------

#: Bytes of line hashes and paths that a partition of sorted pages takes.
PART_BYTES = 32 << 20
_URL = re.compile(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*([^?#]*)", re.I)
_PAGES = "host string, path string, page_id bigint, mark bigint, alike binary, lines array<bigint>"


def place_of(url: str | None) -> tuple[str | None, str]:
    m = _URL.match(url or "")
    return (m[1].lower(), m[2].rstrip("/") or "/") if m and m[1] else (None, "")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        places, alike, lines = [], [], []
        for url, page in zip(batch.column(2).to_pylist(), batch.column(3), strict=True):
            places.append(place_of(url))
            seen = np.array([xxhash.xxh3_64_intdigest(x) for x in outside_chrome(page.as_py())], np.uint64).view(np.int64)
            alike.append(xxhash.xxh3_128_digest(seen.tobytes()))
            lines.append(seen)
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in places], pa.string()), pa.array([p for _, p in places], pa.string()),
                                          batch.column(0), batch.column(1), pa.array(alike, pa.binary()), pa.array(lines, pa.list_(pa.int64()))],
                                         names=["host", "path", "page_id", "mark", "alike", "lines"])


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


_SHARED = "host string, alike binary, shared array<int>"


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, host, path, page_id, mark, alike, lines, context) in order;
    the pages of a range follow each other, context pages only serve as partners."""
    def told(before, row, after):
        if row[7]:
            return None
        partners = [p for p in (before, after) if p is not None and p[0] == row[0] and p[1] == row[1]]
        if not partners:
            return row[1], row[5], []
        partner = max(partners, key=lambda p: _common(p[2], row[2]))  # the first of equals
        return row[1], row[5], shared_lines(row[6], partner[6])

    before = row = None
    for batch in batches:
        out = []
        for after in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row is not None:
                out.append(told(before, row, after))
            before, row = row, after
        yield _batch([x for x in out if x])
    if row is not None and (last := told(before, row, None)):
        yield _batch([last])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.binary(), pa.list_(pa.int32())))],
                                      names=["host", "alike", "shared"])


def shared_with_nearest(pages: DataFrame) -> DataFrame:
    """(page_id, mark, url, html) -> the numbers of the lines outside chrome
    that each page shares with its partner."""
    spark = pages.sparkSession
    checkpoint_root(spark)
    order = ["host", "path", "page_id", "mark", "alike"]
    every = pages.mapInArrow(_hashed, _PAGES).where("host is not null").checkpoint()
    size = every.agg(F.sum(F.size("lines") * 8 + F.length("path") + 64)).first()[0] or 0
    n = parts_for(spark, size, PART_BYTES)
    first = every.groupBy("host", "alike").agg(F.min(F.struct("path", "page_id", "mark", "lines")).alias("first"))
    ranges = first.select("host", "first.path", "first.page_id", "first.mark", "alike", "first.lines") \
        .repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()).checkpoint()
    row = F.struct(*order, "lines")
    ends = ranges.groupBy("range").agg(F.min(row).alias("first"), F.max(row).alias("last"))  # one row per range
    steps = Window.orderBy("range")  # over the range numbers alone
    beside = ends.select("range").select("range", F.lag("range").over(steps).alias("before"), F.lead("range").over(steps).alias("after")).checkpoint()
    context = beside.select("range", F.col("before").alias("at")).join(ends.select(F.col("range").alias("at"), F.col("last").alias("c")), "at") \
        .union(beside.select("range", F.col("after").alias("at")).join(ends.select(F.col("range").alias("at"), F.col("first").alias("c")), "at"))
    with_context = ranges.select("range", *order, "lines", F.lit(False).alias("context")) \
        .union(context.select("range", *[F.col("c")[c] for c in order], F.col("c")["lines"], F.lit(True)))
    told = with_context.repartition(n, "range").sortWithinPartitions("range", *order).mapInArrow(_differenced, _SHARED)
    return every.select("page_id", "mark", "host", "alike").join(told, ["host", "alike"]).select("page_id", "mark", "shared")


def _extractor():
    @F.arrow_udf("string")
    def text(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for pages, shared in batches:
            yield pa.array([main_text(p.as_py(), s or ()) for p, s in zip(pages, shared.to_pylist(), strict=True)], pa.string())

    return text


def main_text(page: str, shared) -> str:
    """The text of a page; of its lines outside chrome, the numbers ``shared``
    are its host's template."""
    lines, main, has_main = lines_of(page)
    if has_main:
        return "\n\n".join(x for x, m in zip(lines, main, strict=True) if m)
    gone = set(shared)
    return "\n\n".join(x for i, x in enumerate(outside_chrome(page)) if i not in gone)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url and text of each row of ``pages``."""
    rows = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("html"))
    mark = F.xxhash64("url", "html")
    told = shared_with_nearest(rows.select("page_id", mark.alias("mark"), "url", "html"))
    told = told.groupBy(F.col("page_id").alias("id"), F.col("mark").alias("told")).agg(F.min("shared").alias("shared"))
    found = rows.withColumn("mark", mark).join(told, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("told")), "left")
    return found.select("page_id", "url", _extractor()(F.col("html"), F.col("shared")).alias("text"))


def op4_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
