"""Main text of web pages by markup and by nearest-URL page differencing.

A page becomes lines, one per block element, and every line has a kind. Elements that are never part
of an article (menus, forms, scripts, and so on, by tag, role or name) give no lines. The pages of a
host are ordered by URL path, and each is compared with its nearest page there: its neighbour with the
longer common path. Their lines are aligned by a longest common subsequence, and shared lines go.

Two things are kept although shared, since text that many articles carry is still theirs: running text
inside a marked article, and the lines of a page that differs from its neighbour in almost nothing (a
copy, from which no template can be seen).

Defined results: a null or empty page has an empty text; a null URL is a host of its own. Broken
markup is read as far as it goes, in one pass. Repeated rows are pages of their own; a page's twin can
be its nearest page. Columns other than the id, the URL and the html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roomledger.llm.common import stored
from roomledger.session import ship_package

# Element names and the words of class, id and role that mark what is no article text.
BLOCK = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section
summary table tbody tfoot thead tr ul
""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
DROPPED = frozenset("""
aside audio button canvas datalist dialog footer form head iframe map menu nav noscript object script
select style svg template textarea title video
""".split())
MARKED = frozenset("""
ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments complementary consent
contentinfo cookie cookies dialog discussion disqus footer gdpr header login masthead menu modal nav navbar
navigation newsletter notice notices notification overlay pager pagination popup promo promoted promotion
recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored
subscribe subscription toolbar topbar widget widgets
""".split())
COMMENTS = frozenset("comment comments discussion disqus replies reply respond".split())

#: Kinds of lines: article text, links inside an article, text of a page without a marked article.
TEXT, LINKS, LOOSE = 0, 1, 2
#: A page whose loose text is shared to at least this part is a copy of its neighbour.
COPY = 0.8

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_END = re.compile(r"[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+>")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"\shidden(?=[\s=/>]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")


def _unwanted(name: str, attributes: str, inside: bool) -> bool:
    if name in DROPPED or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    if _HIDDEN.search(attributes):
        return True
    marks = {w for m in _NAMES.finditer(attributes) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())}
    return not marks.isdisjoint(COMMENTS if name == "article" else MARKED)


class _Reader:
    """The lines of one page, found in one pass over its tags."""

    def __init__(self) -> None:
        self.lines: list[tuple[str, bool, bool]] = []  # text, inside an article, links only
        self.stack: list[tuple[str, bool]] = []
        self.open: dict[str, int] = {}
        self.dropped = self.inside = self.links = 0
        self.parts: list[str] = []
        self.plain = False  # some of the block's text is outside of links

    def text(self, piece: str) -> None:
        if not self.dropped and piece:
            self.parts.append(entities.unescape(piece) if "&" in piece else piece)
            if not self.links and not piece.isspace():
                self.plain = True

    def close_line(self) -> None:
        if self.parts:
            line = " ".join("".join(self.parts).split())
            if line:
                self.lines.append((line, self.inside > 0, not self.plain))
            self.parts, self.plain = [], False

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.close_line()
            if self.open.get("p"):
                self.end("p")
            if name == "li" and self.stack and self.stack[-1][0] == "li":
                self.end("li")
        elif name in ("br", "td", "th", "option"):
            self.parts.append(" ")
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            return
        drop = _unwanted(name, attributes, self.inside > 0)
        self.stack.append((name, drop))
        self.open[name] = self.open.get(name, 0) + 1
        self.dropped += drop
        self.inside += name in ("article", "main")
        self.links += name == "a"

    def end(self, name: str) -> None:
        if name in BLOCK:
            self.close_line()
        if not self.open.get(name):
            return
        while True:
            top, drop = self.stack.pop()
            if top in BLOCK:
                self.close_line()
            self.open[top] -= 1
            self.dropped -= drop
            self.inside -= top in ("article", "main")
            self.links -= top == "a"
            if top == name:
                return


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(text, kind) of every line that is or may be main text."""
    page = page or ""
    reader, at, quotes = _Reader(), 0, True
    while True:
        tag = page.find("<", at)
        if tag < 0:
            reader.text(page[at:])
            break
        reader.text(page[at:tag])
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            if end < 0:
                break
            at = end + 3
            continue
        name = _NAME.match(page, tag + 1)
        if not name:
            if page.startswith(("<!", "<?", "</"), tag):
                end = page.find(">", tag)
                if end < 0:
                    break
                at = end + 1
            else:
                reader.text("<")
                at = tag + 1
            continue
        found = _END.match(page, name.end()) if quotes else None
        if found:
            end = found.end()
        else:
            quotes = False  # a quote stays open: from here on the next > ends a tag
            end = page.find(">", name.end()) + 1
            if not end:
                break
        what, attributes = name[1].lower(), page[name.end() : end - 1]
        at = end
        if page[tag + 1] == "/":
            reader.end(what)
            continue
        reader.start(what, attributes)
        if what in RAW:
            close = re.compile(f"</{re.escape(what)}(?=[\\s/>])", re.I).search(page, at)
            if not close:
                break
            at = close.start()
    reader.close_line()
    marked = any(inside for _, inside, _ in reader.lines)
    if marked:
        return [(t, LINKS if links else TEXT) for t, inside, links in reader.lines if inside]
    return [(t, LOOSE) for t, _, _ in reader.lines]


_PARSED = "page_id bigint, url string, host string, path string, lines array<string>, kinds array<int>, hashes array<bigint>, sizes array<int>"
_URL = re.compile(r"(?:[a-zA-Z][\w+.-]*:)?(?://)?([^/?#]*)([^?#]*)")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()),
        ("lines", pa.list_(pa.string())), ("kinds", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64())),
        ("sizes", pa.list_(pa.int32())),
    ])
    for batch in batches:
        rows = []
        for page_id, url, page in zip(*(c.to_pylist() for c in batch.columns)):
            lines = lines_of(page)
            place = _URL.match(url or "")
            rows.append({
                "page_id": page_id, "url": url, "host": place[1].lower(), "path": place[2],
                "lines": [t for t, _ in lines], "kinds": [k for _, k in lines],
                "hashes": [xxhash.xxh64_intdigest(t) - (1 << 63) for t, _ in lines],
                "sizes": [len(t) for t, _ in lines],
            })
        yield pa.RecordBatch.from_pylist(rows, schema)


def common(a: list[int], b: list[int]) -> list[bool]:
    """Which elements of a belong to a longest common subsequence of a and b.

    Bit-parallel: a row of the table of lengths is one integer. Elements that only one side has are
    left out first.
    """
    both = set(a) & set(b)
    rows, other = [i for i, x in enumerate(a) if x in both], [x for x in b if x in both]
    places: dict[int, int] = {}
    for j, x in enumerate(other):
        places[x] = places.get(x, 0) | 1 << j
    full = (1 << len(other)) - 1
    state, states = full, []
    for i in rows:
        states.append(state)
        u = state & places[a[i]]
        state = ((state + u) | (state - u)) & full
    out, j = [False] * len(a), len(other)
    for i, before in zip(reversed(rows), reversed(states)):
        # Columns where the length grows are zero bits; a cell grows by row i when its bit fell there.
        u = before & places[a[i]]
        after = ((before + u) | (before - u)) & full
        mask = (1 << j) - 1
        if (mask & ~after).bit_count() > (mask & ~before).bit_count():
            out[i] = True
            # The match is the last place of this element within the first j columns that gains.
            fit = places[a[i]] & mask
            want = (mask & ~after).bit_count() - 1
            while fit:
                k = fit.bit_length() - 1
                if (((1 << k) - 1) & ~before).bit_count() == want:
                    break
                fit ^= 1 << k
            j = k
    return out


def deleted(kinds: list[int], hashes: list[int], sizes: list[int], other: list[int]) -> list[int]:
    """Places of the lines that go, given the lines of the nearest page."""
    if not any(kinds) or not other:
        return []
    shared = [i for i, x in enumerate(common(hashes, other)) if x and kinds[i] != TEXT]
    loose = sum(n for n, k in zip(sizes, kinds) if k == LOOSE)
    if loose and sum(sizes[i] for i in shared) >= COPY * loose:
        return []
    return shared


def _overlap(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _nearest(row: dict, before: dict | None, after: dict | None) -> list[int]:
    """The lines of the neighbour with the longer common path; the earlier one of equals."""
    best, lines = -1, []
    for other in (before, after):
        if other is not None and other["host"] == row["host"]:
            n = _overlap(row["path"], other["path"])
            if n > best:
                best, lines = n, other["hashes"]
    return lines


_KEYS = ("host", "path", "_row")
_EDGE = "host string, path string, _row bigint, kinds array<int>, hashes array<bigint>, sizes array<int>"
_DIFF = "_row bigint, gone array<int>, first boolean, last boolean, own struct<" + ", ".join(
    f.replace(" ", ": ", 1) for f in _EDGE.split(", ")
) + ">, inner struct<host: string, path: string, hashes: array<bigint>>"


def _diff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pages against their neighbours; the first and last page of the partition come out whole."""
    edge = pa.struct([("host", pa.string()), ("path", pa.string()), ("_row", pa.int64()), ("kinds", pa.list_(pa.int32())),
                      ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
    inner = pa.struct([("host", pa.string()), ("path", pa.string()), ("hashes", pa.list_(pa.int64()))])
    schema = pa.schema([("_row", pa.int64()), ("gone", pa.list_(pa.int32())), ("first", pa.bool_()),
                        ("last", pa.bool_()), ("own", edge), ("inner", inner)])
    before = now = None
    part = lambda r: r and {k: r[k] for k in ("host", "path", "hashes")}

    def result(before, row, after, last):
        first = before is None
        if first or last:
            return {"_row": row["_row"], "gone": None, "first": first, "last": last, "own": row,
                    "inner": part(after if first else before)}
        gone = deleted(row["kinds"], row["hashes"], row["sizes"], _nearest(row, before, after))
        return {"_row": row["_row"], "gone": gone, "first": False, "last": False, "own": None, "inner": None}

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if now is not None:
                out.append(result(before, now, row, False))
            before, now = now, row
        yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([result(before, now, None, True)], schema)


def _diff_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            row = r["own"]
            before = r["lag"] if r["first"] else r["inner"]
            after = r["lead"] if r["last"] else r["inner"]
            out.append({"_row": row["_row"], "gone": deleted(row["kinds"], row["hashes"], row["sizes"], _nearest(row, before, after))})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("_row", pa.int64()), ("gone", pa.list_(pa.int32()))]))


def differences(parsed: DataFrame) -> DataFrame:
    """(_row, gone) of the pages that lose lines.

    Pages are sorted by range, so a host of any size is many tasks; only hashes are moved. The ends of
    the ranges, two pages a task, are compared across tasks in a second step.
    """
    done = stored(
        parsed.select(*_KEYS, "kinds", "hashes", "sizes")
        .repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS).mapInArrow(_diff, _DIFF),
        "webtext-differences",
    )
    ends = done.where("gone is null")
    order = Window.orderBy("own.host", "own.path", "own._row")
    slim = lambda c: F.when(c.isNotNull(), F.struct(c["host"].alias("host"), c["path"].alias("path"), c["hashes"].alias("hashes")))
    crossed = ends.select(
        "own", "inner", "first", "last", slim(F.lag("own").over(order)).alias("lag"), slim(F.lead("own").over(order)).alias("lead")
    ).mapInArrow(_diff_edges, "_row bigint, gone array<int>")
    return done.where("gone is not null").select("_row", "gone").union(crossed).where(F.size("gone") > 0)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    ship_package(pages.sparkSession)
    parsed = stored(
        pages.select("page_id", "url", "html").mapInArrow(_parse, _PARSED)
        .withColumn("_row", F.monotonically_increasing_id()),
        "webtext-lines",
    )
    gone = differences(parsed)
    # Only lines of other kinds than article text can go, so other pages need no exchange of texts.
    may = F.exists("kinds", lambda k: k != TEXT)
    changed = parsed.where(may).join(gone, "_row", "left").select(
        "page_id", "url",
        F.filter("lines", lambda _, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False))).alias("lines"),
    )
    lines = parsed.where(~may).select("page_id", "url", "lines").union(changed)
    return lines.select("page_id", "url", F.array_join("lines", "\n\n").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )
