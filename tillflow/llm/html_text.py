"""Main text of HTML pages: landmarks, and differencing against the nearest URL.

A page is cut into blocks, its lines.  Elements that are no article by their tag, role
or class (menus, footers, forms, notices, adverts, comments, ...) are left out; by class
or id if it is a listed name or a known compound of one, and never the article itself or
what holds most of the page's text in an article or main element (comments apart).  Then
pages are paired with their nearest neighbour by URL path on the same host, the lines
of both are aligned by longest common subsequence, and shared lines are deleted.

Differencing alone gives wrong results both ways: menus whose entries change from page
to page are not shared, and sentences that two articles share are no template.  So
lines inside the page's article (or main, if articles hold less than half of the text of
both) element are protected from deletion, unless
most of the line is links; lines outside it are left out where there is one.  On a page
without such landmarks every line is open to deletion.  A pair of which 80 % or more of
the open text is shared is one page twice, not two pages of one template: nothing is
deleted.

How it runs: pages are parsed in tasks; digests of lines are sorted by host and path
(a range shuffle, so that a large host is many partitions), each page meets the page
before and after it, also across partitions, and the places to delete are joined back
to the parsed pages: the texts are shuffled once.

Defined cases: null or empty html gives an empty text; null or hostless URLs have no
neighbour; copies of a page on a host count once as neighbours; equal rows are
answered alike; a page cut off in the middle is read as far as it goes; extra columns
are not read.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import batches, col, tuples, written

#: Fixed values of HTML: elements that end a block, that hold no content, whose
#: content is no markup, and that an opening block closes.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu "
    "nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea noscript template iframe svg math object canvas audio video "
                "select noembed noframes xmp".split())
CLOSES_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"},
                 "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Elements, roles and words of class or id that are not the article.
NOT_TEXT = frozenset("head nav footer aside form menu dialog button label fieldset".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert "
                           "alertdialog menu menubar toolbar status".split())
NOT_TEXT_NAMES = frozenset(
    "nav navbar navigation sidenav topnav subnav topbar menu submenu breadcrumb breadcrumbs "
    "footer sidebar aside widget widgets ad ads adbox adslot adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations comment comments disqus "
    "respond reply replies pagination pager toolbar masthead copyright disclaimer".split())
#: Of these an article inside is one too, and the article itself may be one.
COMMENT_NAMES = frozenset("comment comments disqus respond reply replies".split())
#: With words of these only, a class or id with a listed name is a known compound of it
#: (site-footer, nav-menu, comments-list); with any other word it names something else.
NAME_PARTS = frozenset(
    "site page main global top bottom left right primary secondary header inner outer wrapper wrap container "
    "box bar block area section list item items links link buttons button icons panel content row col column "
    "js wp the post article entry reader user blog form slot unit zone google text body law info policy "
    "message title posts articles stories".split())
#: A header by class is the page's, unless one of these names it the article's.
ARTICLE_NAMES = frozenset("article post entry story content title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(
    r"<!--(?:(?!-->).)*+(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


class _Open:
    """``hard``: left out for good.  ``named``: in an element that its name leaves out,
    but for articles and main elements in it (``lifted``).  ``out``: either."""

    __slots__ = ("tag", "hard", "named", "lifted", "out", "article", "main", "header")

    def __init__(self, tag, hard, named, lifted, article, main, header):
        self.tag, self.hard, self.named, self.lifted = tag, hard, named, lifted
        self.out = hard or named and not lifted
        self.article, self.main, self.header = article, main, header


def _is_named(token: list[str], names: frozenset | set) -> bool:
    """Whether the words of a class or id are one of ``names``, or a known compound of it."""
    return any(x in names for x in token) and all(x in names or x in NOT_TEXT_NAMES or x in NAME_PARTS for x in token)


def _left_out(tag: str, attributes: str, inside_article: bool) -> tuple[bool, bool, bool]:
    """Whether the element is no article text, whether it is marked as main, and whether
    its name says that it is no article text."""
    if tag in NOT_TEXT:
        return True, False, False
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False, False, False
    got = {m[0].lower(): (m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(attributes)}
    role = got.get("role", "").lower()
    if role in NOT_TEXT_ROLES or got.get("aria-hidden") == "true":
        return True, False, False
    main = role in ("main", "article") or got.get("itemprop", "").lower() == "articlebody"
    if tag in ("html", "body", "main") or main:
        return False, main, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", "")) \
            or re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", attributes):
        return True, False, False
    # the id of a heading or paragraph is made of its text
    given = got.get("class", "") + ("" if tag in HEADINGS or tag == "p" else " " + got.get("id", ""))
    tokens = [_NAME.findall(x) for x in given.lower().split()]
    if any(_is_named(x, COMMENT_NAMES) for x in tokens):
        return True, False, False
    if tag == "article":
        return False, False, False
    if not inside_article and not any(x in ARTICLE_NAMES for t in tokens for x in t) \
            and any(_is_named(x, {"header"}) for x in tokens):
        return False, False, True
    return False, False, any(_is_named(x, NOT_TEXT_NAMES) for x in tokens)


_FORM_END = re.compile(r"</form", re.I)
_BODY = re.compile(r"<(?:article|main)\b", re.I)


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """(line, open to deletion) for each block that may be article text."""
    if not page:
        return []
    found: list[tuple[str, int, bool, bool, bool]] = []  # text, link characters, in article, in main, named
    stack: list[_Open] = [_Open("", False, False, False, False, False, False)]
    pieces: list[str] = []
    links = in_link = 0

    open_tags: Counter[str] = Counter()  # open elements by tag: an end tag without one needs no search

    def cut(k: int):
        for s in stack[k:]:
            open_tags[s.tag] -= 1
        del stack[k:]

    form_ends = [m.start() for m in _FORM_END.finditer(page)] if "form" in page.lower() else []
    bodies = [m.start() for m in _BODY.finditer(page)] if form_ends else []

    def wraps_body(at: int) -> bool:
        """Whether the form that begins here holds an article or a main element."""
        k, b = bisect_left(form_ends, at), bisect_left(bodies, at)
        return b < len(bodies) and (k == len(form_ends) or bodies[b] < form_ends[k])

    def flush():
        nonlocal links
        if pieces:
            text = " ".join(html_lib.unescape("".join(pieces)).split())
            if text:
                found.append((text, links, stack[-1].article, stack[-1].main, stack[-1].named))
            pieces.clear()
        links = 0

    at, end = 0, len(page)
    while at < end:
        nxt = page.find("<", at)
        if nxt < 0:
            nxt = end
        if nxt > at:
            top = stack[-1]
            if not top.out:
                pieces.append(page[at:nxt])
                if in_link:
                    links += nxt - at
        if nxt == end:
            break
        m = _TOKEN.match(page, nxt)
        if not m:  # a lone <
            if not stack[-1].out:
                pieces.append("<")
            at = nxt + 1
            continue
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # an end tag
            if tag == "a":
                in_link = 0
            if tag in BLOCKS:
                flush()
            for k in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[k].tag == tag:
                    cut(k)
                    break
                # an inline end tag doesn't close blocks
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break
            continue
        attributes = m[3] or m[6] or ""
        if tag == "br":
            if not stack[-1].out:
                pieces.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if stack[-1].tag == "p" or stack[-1].tag in HEADINGS and tag in HEADINGS:
                cut(len(stack) - 1)
            elif tag in CLOSES_ITSELF:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in CLOSES_ITSELF[tag]:
                        break
                    if stack[k].tag == tag:
                        cut(k)
                        break
        if tag in VOID or attributes.endswith("/") and tag not in BLOCKS:
            continue
        top = stack[-1]
        if tag in RAW:
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else end
            continue
        if tag == "a":
            in_link = 1
        # A form around the body is the page's frame, as some servers write it.
        frame = tag == "form" and not top.article and wraps_body(at)
        hard, main, named = _left_out("div" if frame else tag, attributes, top.article)
        if tag == "header" and not top.article:
            hard = True
        header = top.header or tag == "header" and top.article
        if header and tag not in HEADINGS and tag in BLOCKS and not top.out:
            hard = hard or tag not in ("header", "div", "section")
        hard = hard or top.hard or named and top.article  # of an article's parts none is an article
        if tag == "main" and top.hard and not any(s.tag in NOT_TEXT for s in stack):
            hard = False  # a wrapper that was marked as hidden, say
        lifted = not named and (top.lifted or tag in ("article", "main") or main)
        named = named or top.named
        new = _Open(tag, hard, named, lifted, False, False, header)
        new.article = (top.article or tag == "article") and not new.out
        new.main = (top.main or tag == "main" or main) and not new.out
        if tag in BLOCKS or new.out != top.out or new.main != top.main or named != top.named or lifted != top.lifted:
            stack.append(new)
            open_tags[tag] += 1
    flush()
    size = lambda k: sum(len(f[0]) for f in found if k(f))
    if 2 * size(lambda f: f[4]) <= size(lambda f: True):  # teasers in a list of related pages, say
        found = [f for f in found if not f[4]]
    inside = None
    if any(f[2] or f[3] for f in found):
        of_both = size(lambda f: f[2] or f[3])
        inside = 2 if 2 * size(lambda f: f[2]) >= of_both or not any(f[3] for f in found) else 3
        found = [f for f in found if f[inside]]
    return [(f[0], inside is None or 2 * f[1] > len(f[0])) for f in found]


# -- differencing -------------------------------------------------------------------

def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places of ``a`` in a longest common subsequence of ``a`` and ``b``: bit-parallel
    rows, halved (by the lengths from both ends) where they would be too large."""
    low, top_a, top_b = 0, len(a), len(b)
    while low < top_a and low < top_b and a[low] == b[low]:
        low += 1
    while top_a > low and top_b > low and a[top_a - 1] == b[top_b - 1]:
        top_a, top_b = top_a - 1, top_b - 1
    middle = _subsequence(a[low:top_a], b[low:top_b])
    return [*range(low), *(low + x for x in middle), *range(top_a, len(a))]


def _rows(a, b):
    """After each element of ``b``: zeros mark the places of ``a`` where the length grows."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _subsequence(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > 1 << 28 and len(b) > 1:
        half = len(b) // 2
        *_, down = _rows(a, b[:half])
        *_, up = _rows(a[::-1], b[:half - 1:-1])
        best, cut, grown = -1, 0, 0
        left = [0]
        for i in range(len(a)):
            left.append(left[-1] + (~down >> i & 1))
        right = [0]
        for i in range(len(a)):
            right.append(right[-1] + (~up >> i & 1))
        for i in range(len(a) + 1):
            grown = left[i] + right[len(a) - i]
            if grown > best:
                best, cut = grown, i
        return _subsequence(a[:cut], b[:half]) + [cut + x for x in _subsequence(a[cut:], b[half:])]
    rows = list(_rows(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            out.append(i - 1)
            i, j = i - 1, j - 1
        elif rows[j - 1] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return out[::-1]


_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("key", pa.binary()),
                     ("lines", pa.list_(pa.string()))])
_DIGESTS = pa.schema([("key", pa.binary()), ("host", pa.string()), ("path", pa.string()),
                      ("lines", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())),
                      ("open", pa.list_(pa.bool_()))])
_URL = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::\d+)?([^?#]*)")


def page_key(url: str | None, page: str | None) -> bytes:
    data = f"{len(url or '')}:{url or ''}{page or ''}".encode("utf-8", "surrogatepass")
    return xxhash.xxh3_128_digest(data)


def _parsed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((page_id, url, page_key(url, page), [t for t, _ in blocks(page)]) for page_id, url, page in tuples(parts))
    yield from batches(rows, _PARSED, 512)


def _digests(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for _, url, page in tuples(parts):
            m = _URL.match(url or "")
            if m:
                got = blocks(page)
                yield (page_key(url, page), m[1].lower(), m[2] or "/",
                       [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in got],
                       [len(t) for t, _ in got], [o for _, o in got])

    yield from batches(rows(), _DIGESTS, 2048)


def _steps(a: str, b: str) -> int:
    """Path parts that two paths share from the left."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def _differenced(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: for pages with their neighbours in order of URL, the lines that go."""
    schema = pa.schema([("content", pa.int64()), ("host", pa.string()), ("gone", pa.list_(pa.int32()))])

    def rows():
        for host, path, content, lines, sizes, is_open, before, after in tuples(parts):
            if not any(is_open):
                continue
            near = [n for n in (before, after) if n is not None and n["host"] == host]
            if not near:
                continue
            best = max(near, key=lambda n: _steps(path, n["path"]))  # the first of equals
            gone = [k for k in shared_lines(lines, best["lines"]) if is_open[k]]
            if gone and sum(sizes[k] for k in gone) < 0.8 * sum(s for s, o in zip(sizes, is_open) if o):
                yield content, host, gone

    yield from batches(rows(), schema, 2048)


def with_neighbours(df: DataFrame, order: list[str], payload: list[str]) -> DataFrame:
    """``df`` with structs ``before`` and ``after``: the rows next to it in a global order.

    The rows are sorted by ranges and written; inside a partition neighbours come from a
    window, at its ends from the ends of the other partitions (a row for each)."""
    sorted_rows = written(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    row = F.struct(*order, *payload)
    ends = sorted_rows.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    along = Window.orderBy("part")  # as many rows as there are partitions
    ends = ends.select(F.col("part").alias("p"), F.lag("last").over(along).alias("last_before"),
                       F.lead("first").over(along).alias("first_after"))
    inside = Window.partitionBy("part").orderBy(*order)
    return (sorted_rows.withColumn("before", F.lag(row).over(inside)).withColumn("after", F.lead(row).over(inside))
            .join(F.broadcast(ends), F.col("part") == F.col("p"))
            .withColumn("before", F.coalesce("before", "last_before"))
            .withColumn("after", F.coalesce("after", "first_after")))


def main_text(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_differenced (lines deleted as shared) per page."""
    own = pages.select(col(page_id).cast("bigint").alias("page_id"), col(url).cast("string").alias("url"),
                       col(html).cast("string").alias("html"))
    parsed = own.mapInArrow(_parsed, "page_id bigint, url string, key binary, lines array<string>")
    digests = written(own.mapInArrow(
        _digests, "key binary, host string, path string, lines array<bigint>, sizes array<int>, open array<boolean>")
        .withColumn("content", F.xxhash64("host", "lines")))
    # Copies on a host count once, at their first path.
    once = (digests.groupBy("host", "content")
            .agg(F.min("path").alias("path"), F.first("lines").alias("lines"), F.first("sizes").alias("sizes"),
                 F.first("open").alias("open")))
    met = with_neighbours(once, ["host", "path", "content"], ["lines"])
    gone = (met.select("host", "path", "content", "lines", "sizes", "open",
                       *[F.struct(f"{n}.host", f"{n}.path", f"{n}.lines").alias(n) for n in ("before", "after")])
            .mapInArrow(_differenced, "content bigint, host string, gone array<int>"))
    by_key = (digests.select("key", F.col("host").alias("h"), F.col("content").alias("c"))
              .join(gone, (F.col("c") == F.col("content")) & (F.col("h") == F.col("host")))
              .select(F.col("key").alias("k"), "gone").dropDuplicates(["k"]))
    kept = F.transform(F.filter(F.transform("lines", lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                                lambda p: F.col("gone").isNull() | ~F.array_contains("gone", p["i"])), lambda p: p["x"])
    return (parsed.join(by_key, F.col("key") == F.col("k"), "left")
            .select("page_id", "url", F.array_join(kept, "\n").alias("text"),
                    F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_differenced"))
            .select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"), "n_differenced"))


