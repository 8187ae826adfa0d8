"""Main text of HTML pages: page structure, and host suffix arrays that find the repeats around it.

A page is cut into blocks. Menus, headers, footers, sidebars, notices, adverts,
forms and comments are known by their elements and names and go. A page with an
``article`` (else a ``main``) element has its text there, and it stays whole:
articles share passages, so repetition says nothing about them.

All else is searched for repetition, on all pages of all hosts. The words
outside articles of a host's pages (of a page without such an element, those outside chrome) form one token stream, whose suffixes are
sorted by their first ``REPEAT`` words across all tasks: range partitions of the
sorted suffixes are consecutive pieces of the host's suffix array. A stretch of suffixes that agree on
``REPEAT`` words and come from several distinct pages is a repeated
substring, where equal streams stand for all distinct pages that have them. Every page is told how many of its
words repeated substrings cover. On pages without such an element these words are removed, unique runs stay; they tell too
whether an article below an element whose name speaks of chrome is the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emisplit.llm.common import slices, stored
from emisplit.llm.words import SPACED, hashed_words
from emisplit.session import tune

#: Words that a repeated substring has at least, and distinct pages it must be on.
REPEAT = 6
PAGES = 3

# ---------------------------------------------------------------- fixed values: elements and names

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math select button object".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CHROME = frozenset("nav footer aside form menu dialog fieldset label head audio video canvas".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist tooltip status".split()
)
_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar widget widgets ad ads adv advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login comment comments disqus reply replies discussion respond share sharing social "
    "related recommended recommendations pagination pager toolbar masthead skip".split()
)
_COMMENTS = frozenset("comment comments reply replies discussion respond disqus".split())
#: Words of names that speak of a part or of what holds it, such as ``layout-with-sidebar`` or ``page-header-wrap``.
_PLAIN = frozenset("with has no without not layout page wrap wrapper container content body main col column columns grid row theme".split())
#: Elements that may hold a whole page.
_AROUND = frozenset("form fieldset".split())

_TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z))""",
    re.S | re.X,
)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in _RAW}


def _names(value: str) -> set[str]:
    """Words of the class and id names that don't speak of a layout: a name is judged as a whole."""
    found: set[str] = set()
    for name in value.lower().split():
        words = re.split("[-_:]+", name)
        if not _PLAIN.intersection(words):
            found.update(words)
    return found


def _kind(tag: str, attrs: str) -> str:
    """``chrome``, ``named`` (chrome unless an article is in it), ``header``, ``article``, ``main`` or '' for other elements."""
    named: dict[str, str] = {}
    if len(attrs) > 1:
        for m in _ATTR.finditer(attrs):
            named.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    role = named.get("role", "").lower()
    hidden = "hidden" in named or named.get("aria-hidden", "").lower() == "true"
    if hidden or re.search(r"display\s*:\s*none", named.get("style", "").lower()):
        return "chrome"
    if tag in ("html", "body"):
        return ""
    names = _names(named.get("class", "") + " " + named.get("id", ""))
    if tag == "article" or role == "article":
        return "chrome" if names & _COMMENTS else "article"
    if tag == "main" or role == "main":
        return "main"
    if tag in _AROUND or not (tag in _CHROME or role in _ROLES or names & _COMMENTS) and names & _NAMES:
        return "named"
    if tag in _CHROME or role in _ROLES or names & _COMMENTS:
        return "chrome"
    return "header" if tag == "header" or "header" in names else ""


def blocks(html: str) -> list[tuple[str, str]]:
    """(place, text) of every block that has text, in page order.

    ``place`` is ``article``, ``main``, ``open`` or ``chrome``; an article or main below an element whose name speaks of
    chrome, or below a form, is ``article?`` or ``main?``. Headings in the header of an article
    belong to the article. White space in a block is one blank; character references are decoded.
    Text of an inline element that is chrome is left out of its block.
    """
    found: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    at = 0

    def place() -> str:
        kinds = [k for t, k in stack if t in _BLOCK or k in ("article", "main")]
        inside = "article" if "article" in kinds else "main" if "main" in kinds else "open"
        top = kinds.index(inside) if inside != "open" else -1
        if "chrome" in kinds or "named" in kinds[top + 1 :]:
            return "chrome"
        doubt = "?" if "named" in kinds[: max(top, 0)] else ""
        if "header" in kinds:
            # A header around the article says nothing; one in it gives its headings.
            at = len(kinds) - 1 - kinds[::-1].index("header")
            heading = any(t in _HEADINGS for t, _ in stack)
            if at > top and not (heading and inside != "open"):
                return "chrome"
        return inside + doubt

    def dropped() -> bool:
        return any(k in ("chrome", "named") and t not in _BLOCK for t, k in stack)

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                found.append((place(), text))

    def close(tag: str, until: frozenset[str] = frozenset()) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    containers = _BLOCK - {"p"} - _HEADINGS
    while m := _TOKEN.search(html, at):
        if m.start() > at and not dropped():
            parts.append(unescape(html[at : m.start()]))
        at = m.end()
        if m["tag"] is None:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m["tag"].lower()
        if tag in _BLOCK:
            flush()
        if m["end"]:
            close(tag)
            continue
        if tag in _RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.start() if end else len(html)
            continue
        if tag in _VOID or m["attrs"].endswith("/>") and tag not in _BLOCK:
            continue
        if tag in _BLOCK:
            close("p", containers)
            if tag == "li":
                close("li", frozenset(("ul", "ol", "menu")))
        stack.append((tag, _kind(tag, m["attrs"])))
    if at < len(html) and not dropped():
        parts.append(unescape(html[at:]))
    flush()
    return found


def landmark(found: list[tuple[str, str]]) -> str | None:
    """Which place has the main text; None if only repetition can tell."""
    places = {p for p, _ in found}
    return next((p for p in ("article", "main", "article?", "main?") if p in places), None)


# ---------------------------------------------------------------- Spark side

def _around(found: list[tuple[str, str]], where: str | None) -> list[str]:
    """Blocks outside the marked text, in page order; the open blocks if nothing is marked."""
    return [t for p, t in found if (p != where if where else p == "open")]


def _doubtful(found: list[tuple[str, str]], where: str | None) -> list[str] | None:
    """Blocks of an article or main that may be chrome; None where the marked text is certain or missing."""
    return [t for p, t in found if p == where] if where in ("article?", "main?") else None


#: Sets keys of two streams apart from streams.
_BOTH = 0x5851F42D4C957F2D


def _key(around: np.ndarray, doubtful: np.ndarray | None) -> int:
    """What finds the repeats of a page: its stream, with the one of its doubtful text."""
    streams = [_digest(t) for t in (around, doubtful) if t is not None]
    return streams[0] if len(streams) == 1 else _digest(np.array([*streams, _BOTH], np.int64).view(np.uint64))


_STREAM = "host long, stream long, page long, key long, doubtful boolean, tokens array<long>"
_STREAM_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("host", "stream", "page", "key")] + [("doubtful", pa.bool_()), ("tokens", pa.list_(pa.int64()))],
)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages about a megabyte at a time: what is made of them takes many times their size."""
    for batch in batches:
        yield from slices(batch, "html", 1 << 20)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words outside articles of every page that has ``REPEAT`` of them, and words of doubtful articles.

    These are compared with each other alone, as articles share passages with their excerpts: their ``host`` is the
    complement. ``page`` is equal for copies of a page: it tells the whole text of pages with a mark, and the stream of others.
    """
    for batch in _pieces(batches):
        out = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            found = blocks(html or "")
            where = landmark(found)
            around, inner = _tokens(_around(found, where)), _doubtful(found, where)
            inner = None if inner is None else _tokens(inner)
            key = _key(around, inner)
            page = key if where is None else _digest(_tokens([t for _, t in found]))
            for group, tokens in ((host, around), (~host, inner)):
                if tokens is not None and len(tokens) >= REPEAT:
                    out.append((group, _digest(tokens), page, key, group != host, tokens.view(np.int64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _STREAM_ARROW.types, strict=True)], schema=_STREAM_ARROW)


_PARSED = "page_id long, url string, host long, key long, n_searched long, text string, kinds array<string>, texts array<string>"
_PARSED_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.int64()), ("key", pa.int64()), ("n_searched", pa.int64()), ("text", pa.string())]
    + [(n, pa.list_(pa.string())) for n in ("kinds", "texts")]
)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every page with its key and the text of its certain article, which stays whole ('' if nothing is outside chrome).

    Of other pages ``text`` is NULL and ``texts`` are their blocks, ``kinds`` the places of these.
    """
    for batch in _pieces(batches):
        out = []
        for html in batch.column("html").to_pylist():
            found = blocks(html or "")
            where = landmark(found)
            around, inner = _tokens(_around(found, where)), _doubtful(found, where)
            inner = None if inner is None else _tokens(inner)
            text = kinds = texts = None
            if inner is None and (where or not len(around)):
                text = "\n".join(t for p, t in found if p == where)
            else:
                kinds, texts = zip(*((p, t) for p, t in found if where or p == "open"), strict=True)
            out.append((_key(around, inner), len(around) + (0 if inner is None else len(inner)), text, kinds, texts))
        columns = zip(*out, strict=True) if out else [()] * 5
        mine = [pa.array(c, t) for c, t in zip(columns, _PARSED_ARROW.types[3:], strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.select(["page_id", "url", "host"]).columns, *mine], schema=_PARSED_ARROW)


def _tokens(texts: list[str]) -> np.ndarray:
    raw = "\n".join(texts).encode()
    return hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), SPACED)[0]


def _digest(tokens: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(tokens * (2 * np.arange(len(tokens), dtype=np.uint64) + 1)).view(np.int64)) if len(tokens) else 0


_FLAG_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("host", "stream")]
    + [("place", pa.int32()), ("window", pa.list_(pa.int64()))]
    + [(n, pa.int64()) for n in ("many", "pages")]
)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of distinct pages in each stretch of equal windows; input is sorted by (host, window, stream).

    ``many`` is a stream's number of pages. A stretch is held back until it has ``PAGES`` pages, so memory stays small for any group.
    Stretches at the two ends of a partition may go on in the next one; their rows carry ``window``, and
    one that is frequent already leaves a row with its window and no stream.
    """
    key, held, pages, last, first = None, [], 0, None, True

    def rows(at_end: bool) -> list[dict]:
        row = {"host": key[0], "stream": None, "place": None, "window": None, "many": None, "pages": pages}
        if pages >= PAGES:
            found = [row | {"stream": s, "place": p} for s, p, _ in held]
            return found + [row | {"window": list(key[1])}] * at_end
        return [row | {"stream": s, "place": p, "many": m, "window": list(key[1])} for s, p, m in held] if at_end else []

    for batch in batches:
        out: list[dict] = []
        values = zip(*(batch.column(c).to_pylist() for c in ("host", "window", "stream", "place", "many")), strict=True)
        for (host, window), group in groupby(((h, tuple(w), s, p, m) for h, w, s, p, m in values), lambda r: r[:2]):
            if (host, window) != key:
                if key is not None:
                    out += rows(first)
                    first = False
                key, held, pages, last = (host, window), [], 0, None
            for _, _, stream, place, many in group:
                pages += many * (stream != last)
                last = stream
                held.append((stream, place, many))
            if pages >= PAGES:
                out += rows(False)
                held = []
        if out:
            yield pa.RecordBatch.from_pylist(out, _FLAG_ARROW)
    if key is not None:
        yield pa.RecordBatch.from_pylist(rows(True), _FLAG_ARROW)


def repeats(streams: DataFrame) -> DataFrame:
    """``host, stream, place``: where a word sequence starts that several distinct pages of a host have.

    ``streams`` has ``host, stream, tokens``; equal streams of a host are searched once. They are as many
    pages as they have values of ``page``, or one without that column.
    """
    one = streams.dropDuplicates(["host", "stream"]).select("host", "stream", "tokens")
    if "page" in streams.columns:
        # Apart from the tokens, so that only hashes are shuffled for each page.
        many = streams.groupBy("host", "stream").agg(F.count_distinct("page").alias("many"))
        one = one.join(many, ["host", "stream"])
    else:
        one = one.withColumn("many", F.lit(1).cast("long"))
    starts = F.sequence(F.lit(0), F.size("tokens") - REPEAT)
    suffixes = one.where(F.size("tokens") >= REPEAT).select("host", "stream", "many", "tokens", F.explode(starts).alias("place"))
    suffixes = suffixes.select("host", "stream", "many", "place", F.slice("tokens", F.col("place") + 1, REPEAT).alias("window"))
    order = ["host", "window", "stream", "place"]
    ordered = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "host long, stream long, place int, window array<long>, many long, pages long"
    flags = stored(ordered.mapInArrow(_stretches, schema), "repeats")
    # Stretches cut by a partition's end: their streams meet again, a few rows per partition.
    cut = flags.where("window is not null").groupBy("host", "window", "stream").agg(F.max("many").alias("many"), F.max("pages").alias("pages"))
    cut = cut.groupBy("host", "window").agg(F.coalesce(F.sum("many"), F.lit(0)).alias("all"), F.max("pages").alias("pages"))
    cut = cut.where((F.col("all") >= PAGES) | (F.col("pages") >= PAGES)).select("host", "window")
    whole = flags.where("window is null")
    joined = whole.unionByName(flags.where("stream is not null").join(cut, ["host", "window"]), allowMissingColumns=True)
    return joined.select("host", "stream", "place")


_TEXT = "page_id long, url string, text string, n_searched long, n_repeated long"
_TEXT_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_searched", pa.int64()), ("n_repeated", pa.int64())])


def _covered(count: int, starts: list[int] | None) -> np.ndarray:
    """Which of ``count`` words repeats cover that start at ``starts``."""
    covered = np.zeros(count, bool)
    for s in starts or []:
        covered[s : s + REPEAT] = True
    return covered


def _judged(kinds: list[str], texts: list[str], around: list[int] | None, inner: list[int] | None) -> tuple[str, int]:
    """Text of a page with no certain article, and how many of its words repeats cover.

    The text is its open blocks without these words, or a doubtful article. That is the text, whole, unless repeats
    cover all of it and leave more words of the open blocks than it has. A page that would lose all keeps all.
    """
    where = landmark(list(zip(kinds, texts, strict=True)))
    words = [t.split() for t in texts]
    own = [kind == where for kind in kinds]
    count = sum(len(w) for w, mine in zip(words, own, strict=True) if mine)
    inside, outside = _covered(count, inner), _covered(sum(map(len, words)) - count, around)
    repeated = int(inside.sum() + outside.sum())
    kept, n = [], 0
    for kind, block, mine in zip(kinds, words, own, strict=True):
        if not mine:
            left = [w for w, gone in zip(block, outside[n : n + len(block)], strict=True) if not gone]
            n += len(block)
            if left and kind == "open":
                kept.append(left)
    if where and not (inside.all() and sum(map(len, kept)) > count):
        return "\n".join(t for t, mine in zip(texts, own, strict=True) if mine), repeated
    return "\n".join(map(" ".join, kept) if kept else texts), repeated


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of every page, and how many of its words repeats cover."""
    for batch in batches:
        out = []
        names = ("n_searched", "text", "kinds", "texts", "around", "inner")
        for count, text, kinds, texts, around, inner in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            out.append(_judged(kinds, texts, around, inner) if text is None else (text, int(_covered(count, around).sum())))
        page_id, url, searched = batch.select(["page_id", "url", "n_searched"]).columns
        texts, repeated = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays([page_id, url, pa.array(texts, pa.string()), searched, pa.array(repeated, pa.int64())], schema=_TEXT_ARROW)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, n_searched, n_repeated`` of each row of ``pages``.

    ``n_searched`` counts the page's words that the search for repeats looks at, ``n_repeated`` those of them that repeats cover.
    NULL and empty html, and pages with nothing but boilerplate elements, have an empty text. NULL and unreadable URLs
    are one host. Rows with equal ids are extracted one by one. Broken markup
    is read on: open elements end with what encloses them, an unfinished tag
    at the end is dropped. No rows give no rows. Other columns are not looked at.
    """
    tune(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.xxhash64(host).alias("host"))
    # Stored without the texts: parsing pages once more takes less than to keep these.
    streams = stored(rows.select("host", "html").mapInArrow(_streams, _STREAM), "streams")
    places = repeats(streams.select("host", "stream", "page", "tokens")).groupBy("host", "stream").agg(F.collect_set("place").alias("places"))
    found = streams.select("host", "stream", "key", "doubtful").distinct().join(places, ["host", "stream"])
    host = F.when(F.col("doubtful"), F.bitwise_not("host")).otherwise(F.col("host"))
    of = lambda doubtful: F.max(F.when(F.col("doubtful") == doubtful, F.col("places")))
    found = found.withColumn("host", host).groupBy("host", "key").agg(of(False).alias("around"), of(True).alias("inner"))
    # Many pages of a host have one stream: joined with a stored table, such a key can be split. It has no more files than the streams.
    found = stored(found.coalesce(max(1, len(streams.inputFiles()))), "places")
    parsed = rows.mapInArrow(_parsed, _PARSED).join(found, ["host", "key"], "left")
    cleaned = parsed.select("page_id", "url", "n_searched", "text", "kinds", "texts", "around", "inner").mapInArrow(_cleaned, _TEXT)
    return cleaned.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_searched", "n_repeated")
