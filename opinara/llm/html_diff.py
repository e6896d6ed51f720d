"""Main text of web pages by differencing each page with its nearest neighbour by URL.

A page becomes its text lines (blocks) in order. Pages are dealt and sorted by host and path, so that the pages about one in
that order are the nearest by path. Of the NEAR pages on either side on the same host those that carry the same article are
passed over, and the one with the longest common path is the pair. The two pages'
lines are aligned by longest common subsequence, and lines that they share are taken for the site's own, if more than that one
coincidence speaks for it: half or more of the different pages nearby must hold the line. Within an article (``<article>``,
``<main>``, ``role=main``) there must be SURE such pages at least, of which four fifths hold it, as prose is quoted and
copied too; a heading always stays. Of what is left, markup that is never text of the article (menus, headers, footers, asides,
forms, scripts, styles, adverts, notices, comments) goes, and if an article holds half or more of the rest, the lines outside
it.

A range of the sort order is one task's, so a host with very many pages is spread over many tasks. The ranges are found from
the URLs alone; the NEAR pages before and after each are also sent to it, as context only, so that the result does not hang on
where the edges are.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements that end a line, elements whose text is never the article's, and such class or id words.
BLOCKS = frozenset("address article aside blockquote body br caption dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
NEVER = frozenset("aside button canvas datalist dialog footer form head iframe nav noscript object script select style svg template textarea".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = frozenset("ad ads advert advertisement breadcrumb breadcrumbs consent cookie cookies disqus footer masthead modal nav navbar navigation newsletter pagination popup sidebar sponsored subscribe topbar widget".split())
#: Words that articles use too: they count alone or as part of a name (social-links), not beside other classes.
WEAK_MARKS = frozenset("banner comment comments menu notice notices promo related replies share sharing social sponsor".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Pages a range has, about, and the most ranges.
PART, RANGES = 4096, 10_000
#: Pages on either side that are looked at, and how many must differ from the page before a line of an article may go.
NEAR, SURE = 5, 4
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Cells of an alignment's table that is held whole.
SMALL = 10_000
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "template")}
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[a-z0-9]+")


def _attributes(text: str) -> dict[str, str]:
    """The attributes of a start tag; of a repeated one the first counts. Values are in lower case."""
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text) if text.strip(" /") else ():
        out.setdefault(name.lower(), entities.unescape(value.strip("\"'")).lower())
    return out


def _marked(value: str) -> bool:
    """Whether a class or id names what is never the article's."""
    parts = value.split()
    for part in parts:
        ends = _WORD.findall(part)
        named = {part, *ends[:1], *ends[-1:]}
        if named & MARKS or named & WEAK_MARKS and (len(parts) == 1 or len(ends) > 1):
            return True
    return False


def _left_out(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    if tag in NEVER or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    if attributes.get("role") in ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    return any(_marked(attributes[name]) for name in ("class", "id") if name in attributes)


def page_lines(source: str | None) -> list[tuple[str, bool, bool, bool]]:
    """(text, within an article, left out, heading) of each block that has text, in page order; references decoded, white space one
    space. Elements that are not closed end with the element around them."""
    source = source or ""
    lines: list[tuple[str, bool, bool, bool]] = []
    words: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, article, left out
    article = out = False

    def end() -> None:
        if words:
            text = " ".join("".join(words).split())
            words.clear()
            if text:
                lines.append((text, article, out, any(x in HEADINGS for x, _, _ in stack)))

    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.match(source, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0][0] != "<":
                words.append(entities.unescape(m[0]))
            elif m[0] == "<":
                words.append("<")
            continue
        tag = tag.lower()
        if m[1]:
            if any(t == tag for t, _, _ in stack):
                if tag in BLOCKS or out:
                    end()
                while True:
                    t, article, out = stack.pop()
                    if t == tag:
                        break
            elif tag in BLOCKS:
                end()
            continue
        attributes = _attributes(m[3])
        left = _left_out(tag, attributes, article)
        if tag in BLOCKS or left and not out:
            end()
        if tag == "p" and stack and stack[-1][0] == "p":
            _, article, out = stack.pop()
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        stack.append((tag, article, out))
        article, out = article or (tag in ("article", "main") or attributes.get("role") == "main") and not out, out or left
        if tag in _RAW_END:
            stop = _RAW_END[tag].search(source, at)
            at = stop.start() if stop else n
    end()
    return lines


def shared(a: list[str], b: list[str]) -> list[bool]:
    """For each line of a, whether a longest common subsequence with b holds it."""
    out, low, high_a, high_b = [False] * len(a), 0, len(a), len(b)
    while low < min(high_a, high_b) and a[low] == b[low]:
        out[low] = True
        low += 1
    while high_a > low and high_b > low and a[high_a - 1] == b[high_b - 1]:
        high_a, high_b = high_a - 1, high_b - 1
        out[high_a] = True
    both = {x: i for i, x in enumerate(set(a[low:high_a]) & set(b[low:high_b]))}  # other lines are in no common subsequence
    rows, columns = [i for i in range(low, high_a) if a[i] in both], [j for j in range(low, high_b) if b[j] in both]
    for i in _aligned(np.array([both[a[i]] for i in rows], np.int64), np.array([both[b[j]] for j in columns], np.int64)):
        out[rows[i]] = True
    return out


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The length of a longest common subsequence of a and each prefix of b, row by row of the table."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return row


def _aligned(a: np.ndarray, b: np.ndarray) -> list[int]:
    """The places in a of a longest common subsequence with b. A large table is never held: a is halved, b is cut where
    both halves' lengths add up to the most, and the two parts are aligned by themselves."""
    if len(a) * len(b) > SMALL and len(a) > 1:
        half = len(a) // 2
        cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        return _aligned(a[:half], b[:cut]) + [half + i for i in _aligned(a[half:], b[cut:])]
    if len(a) == 1:
        return [0] if (b == a[0]).any() else []
    best, out = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], []
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append(i)
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _size(lines: list[dict]) -> int:
    return sum(len(x["text"]) for x in lines)


def _main(lines: list[dict]) -> list[dict]:
    """The lines of a page's article, or of the whole page if it has none, without those left out."""
    text = [x for x in lines if not x["left"]]
    return [x for x in text if x["article"]] or text


def _profile(page: dict) -> tuple[Counter, int, bool, frozenset]:
    """The article's lines, their size, whether the page says what its article is, and all its lines; found once for a page."""
    if "profile" not in page:
        main = _main(page["lines"])
        page["profile"] = Counter(x["text"] for x in main), _size(main), any(x["article"] and not x["left"] for x in page["lines"]), frozenset(x["text"] for x in page["lines"])
    return page["profile"]


def _alike(a: dict, b: dict) -> bool:
    """Whether two pages carry one article: of the shorter one's text they share half or more or, where a page does not say
    what its article is and the site's own lines count too, nine tenths."""
    (mine, n, marked, _), (other, m, also, _) = _profile(a), _profile(b)
    both = sum(len(x) * k for x, k in (mine & other).items()) if mine.keys() & other.keys() else 0
    return 10 * both >= (5 if marked and also else 9) * min(n, m)


def _own(page: dict, near: list[dict]) -> str:
    """The page's text after differencing with the nearest of the pages about it."""
    lines = own = page["lines"]
    others = [p for p in near if p["host"] == page["host"] and not _alike(page, p)]
    if others:
        pair = max(others, key=lambda p: _common(p["path"], page["path"]))
        hits = shared([x["text"] for x in lines], [x["text"] for x in pair["lines"]])
        held = Counter(x for p in others for x in _profile(p)[3])

        def goes(x: dict) -> bool:
            if x["heading"]:
                return False
            return len(others) >= SURE and 5 * held[x["text"]] >= 4 * len(others) if x["article"] else 2 * held[x["text"]] >= len(others)

        own = [x for x, hit in zip(lines, hits, strict=True) if not (hit and goes(x))]
    own = [x for x in own if not x["left"]]
    inside = [x for x in own if x["article"]]
    return "\n".join(x["text"] for x in (inside if 2 * _size(inside) >= _size(own) else own))


def _place(url: str | None, page_id: int | None, digest: int) -> tuple[str, str, int, int]:
    """A page's place in the order: host, path, id (a null id is the least), digest of the source."""
    try:
        at = urlsplit(url or "")
        host, path = at.netloc.lower(), at.path
    except ValueError:
        host, path = "", url or ""
    return host, path, -(2**63) if page_id is None else page_id, digest


PLACE = pa.schema([("host", pa.string()), ("path", pa.string()), ("id", pa.int64()), ("digest", pa.int64())])


def _edges(slim: DataFrame) -> list[list[tuple]]:
    """For each range in order its first and last NEAR places, all of them if it has fewer; a few for each range, from the URLs."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_place(*r) for r in zip(*(batch.column(c).to_pylist() for c in ("url", "page_id", "digest")), strict=True)]
            yield pa.RecordBatch.from_pylist([dict(zip(PLACE.names, r, strict=True)) for r in rows], PLACE)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = [], deque(maxlen=NEAR)
        for row in (r for batch in batches for r in batch.to_pylist()):
            if len(first) < NEAR:
                first.append(row)
            else:
                last.append(row)
        yield pa.RecordBatch.from_pylist([*first, *last], PLACE)

    urls = slim.select("page_id", "url", "digest")
    n = min(RANGES, max(1, -(-urls.count() // PART)))
    kinds = "host string, path string, id long, digest long"
    dealt = urls.mapInArrow(places, kinds).repartitionByRange(n, *PLACE.names).sortWithinPartitions(*PLACE.names)
    found = dealt.mapInArrow(ends, kinds).withColumn("part", F.spark_partition_id()).collect()
    parts: dict[int, list[tuple]] = {}
    for r in found:
        parts.setdefault(r["part"], []).append(tuple(r)[:4])
    return sorted(parts.values())


def _context(edges: list[list[tuple]]) -> dict[tuple, list[int]]:
    """To which further ranges a place is sent as context: those of which it is among the NEAR before or after."""
    flat = [(place, k) for k, places in enumerate(edges) for place in places]
    out: dict[tuple, list[int]] = {}
    at = 0
    for k, places in enumerate(edges):
        for place, own in flat[max(0, at - NEAR) : at] + flat[at + len(places) : at + len(places) + NEAR]:
            if own != k and k not in out.setdefault(place, []):
                out[place].append(k)
        at += len(places)
    return out


def main_text(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> ``page_id, url, text, n_chars``, a row for each row.

    A null or empty page has the text ''; a null url is a host of its own with an empty path; rows that repeat a url are
    neighbours, by id and then by source; one page alone has no pair and keeps all that is not left out; an empty table gives no rows; other columns
    are ignored. Whole pages are read, whatever their length; an alignment holds no more than a row of its table for long ones.
    """
    html = F.col("html").cast("string")
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.xxhash64(html).alias("digest"))
    edges = _edges(slim)
    firsts, context = [places[0] for places in edges], _context(edges)
    line = pa.struct([("text", pa.string()), ("article", pa.bool_()), ("left", pa.bool_()), ("heading", pa.bool_())])
    lines = "array<struct<text:string,article:boolean,left:boolean,heading:boolean>>"
    types = [("page_id", pa.int64()), ("url", pa.string()), *((f.name, f.type) for f in PLACE), ("lines", pa.list_(line)), ("range", pa.int32()), ("context", pa.bool_())]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = []
                for page in batch.slice(start, 512).to_pylist():
                    place = _place(page["url"], page["page_id"], page["digest"])
                    row = (page["page_id"], page["url"], *place, [dict(zip(("text", "article", "left", "heading"), x, strict=True)) for x in page_lines(page["html"])])
                    rows.append((*row, bisect_right(firsts, place) - 1, False))
                    rows += [(*row, k, True) for k in context.get(place, ())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)], names=[k for k, _ in types])

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled() -> Iterator[dict]:
            held, done = [], 0  # pages of one range, of which so many are settled; NEAR before and after one are at hand

            def settle(behind: int) -> Iterator[dict]:
                nonlocal done
                while len(held) - done > behind:
                    page, near = held[done], held[max(0, done - NEAR) : done] + held[done + 1 : done + 1 + NEAR]
                    done += 1
                    if done > NEAR:
                        del held[0]
                        done -= 1
                    if not page["context"]:
                        yield {"page_id": page["page_id"], "url": page["url"], "text": _own(page, near)}

            for page in (p for batch in batches for start in range(0, batch.num_rows, 128) for p in batch.slice(start, 128).to_pylist()):
                if held and held[-1]["range"] != page["range"]:
                    yield from settle(0)
                    held, done = [], 0
                held.append(page)
                yield from settle(NEAR)
            yield from settle(0)

        schema, rows = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())]), []
        for row in settled():
            rows.append(row)
            if len(rows) == 256:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    parsed = slim.mapInArrow(parse, f"page_id long, url string, host string, path string, id long, digest long, lines {lines}, range int, context boolean")
    placed = parsed.repartitionById(max(1, len(edges)), F.col("range")).sortWithinPartitions("range", *PLACE.names)
    return placed.mapInArrow(difference, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
