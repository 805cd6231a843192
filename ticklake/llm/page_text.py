"""HTML extraction: the page's structure, and a host suffix array where the
structure leaves the main text open.

*Structure*.  One pass over the tags keeps the open containers on a stack.
Scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms and
reader comments are told by element, role, class or id, and their text is set
aside.  Inside ``<article>`` (or, in pages without one, ``<main>`` or an element
that says it is the main content) everything else is the main text.

*Host suffix array*.  Pages without such an element have open blocks: neither
marked as main text nor set aside.  The token streams of a host's pages (all
text outside of main content, so also other pages' menus and footers) are
concatenated; substrings that stand in two distinct pages are boilerplate if they
have ``length`` tokens or more, or are a whole block (ends of blocks count as
tokens, so a short footer is found, and its words inside a longer block stay).
Open blocks keep their unique runs of tokens.
Suffixes are sorted by prefix doubling up to ``length`` tokens.  Pages with the
same stream count as one page, so copies of a page keep their text.

A host is cut into collections that lose no repeated substring: every window of
``length`` tokens belongs to its minimizer (the least hash of the four-token
strings in it), a run of windows with one minimizer is a segment, and the
segments of one host and minimizer go to one collection.  Equal segments are
merged before, so a hot host or a menu on all its pages is no hot task.  The
number of buckets of collections follows the counted segments; the windows of a
minimizer with more than ``hot`` segments on a host go one by one by their own
hashes, so no task holds a phrase with very many contexts.

Character references are decoded after markup is removed; white space in a
block becomes one space; ``<br>`` is white space; block elements end a block;
blocks are joined by two line feeds.

Defined results: null and empty pages have an empty text.  Null urls have the
empty host.  Repeated rows are kept.  Unclosed elements end with the page or
with an element around them.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .batched import mixed
from .common import reliable, tasks
from .url_filters import split_url

LENGTH, GRAM = 12, 4
HOT = 65_536  # segments of a host and minimizer, and on average of a bucket

# fixed values: names of HTML elements by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
                   "time tt u var wbr img".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
ASIDE = frozenset("head nav header footer aside form menu dialog noscript template svg math object canvas audio video map button select fieldset".split())
#: words in a class, id or role that tell what is no main text
MARKS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
                  "notification alert popup modal overlay newsletter subscribe subscription signup login menu nav navbar navigation breadcrumb breadcrumbs "
                  "sidebar header footer masthead comment comments commentlist respond reply replies disqus share sharing social related recommended "
                  "recommendations widget widgets pagination pager toolbar search contentinfo complementary".split())
MAIN = frozenset("main articlebody article-body article-content post-content entry-content main-content maincontent".split())
_NOT = ("has", "with", "no", "without", "is")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: elements whose id is a link target made of their own words; in main content such an id is a mark only if it is one of CONTAINERS
ANCHORED = HEADINGS | frozenset("section p dt dd figure figcaption blockquote pre a span dfn".split())
CONTAINERS = frozenset("comments commentlist comment-list comment-section comments-section respond disqus disqus_thread sidebar breadcrumb breadcrumbs "
                       "masthead navbar navigation contentinfo site-header site-footer cookie-notice cookie-banner cookie-consent cookie-bar newsletter-signup "
                       "related-posts related-articles related-stories related-content share-buttons social-share social-links".split())

# a quote opens a value only after "="; anywhere else it is a character like others
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:"[^"]*"|'[^']*')?)*+)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/=]+)\s*(?:=\s*("[^"]*"|'[^']*'|\S+))?""")  # name and value of the pairs in order

DROPPED, OPEN, MAIN_PART, ARTICLE = 0, 1, 2, 3


def _told(name: str, attributes: str, state: int) -> int | None:
    """What an element's name and attributes say about its text, if anything;
    ``state`` is that of the text around it."""
    if name == "article":
        return ARTICLE
    if name == "main":
        return MAIN_PART
    if name in ASIDE:
        return DROPPED
    if attributes and name not in ("html", "body"):
        pairs: dict[str, str] = {}
        for key, value in _ATTRIBUTE.findall(attributes):  # of equal names the first counts
            pairs.setdefault(key.lower(), value.strip("\"'").lower())
        anchored = state >= MAIN_PART and (name in ANCHORED or (name == "div" and "section" in pairs.get("class", "").split()))
        for key, value in pairs.items():
            if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                return DROPPED
            if key in ("class", "id", "role", "itemprop"):
                for token in value.split():
                    if token in MAIN:
                        return MAIN_PART
                    if key == "id" and anchored:
                        if token in CONTAINERS and name not in HEADINGS:
                            return DROPPED
                        continue
                    words = re.split(r"[-_]+", token)
                    if words[-1] == "header" and name in HEADINGS:  # the class of a heading itself
                        continue
                    if words[0] not in _NOT and (words[0] in MARKS or words[-1] in MARKS):
                        return DROPPED
    return None


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(state, text) of every block of a page, in page order.  Of main content,
    ``<article>`` inside anything else but what is set aside is the strongest;
    main content around an article (its headline, its lead) is part of it."""
    page = page or ""
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    stack: list[tuple[str, int, int]] = []  # open containers, the state inside them, and the main part they begin (or -1)
    opened: Counter[str] = Counter()
    mains: list[list] = []  # first block, block after the last, and whether an article is inside
    state, at = OPEN, 0

    def pop() -> None:
        gone, _, main = stack.pop()
        opened[gone] -= 1
        if main >= 0:
            mains[main][1] = len(out)

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append((state, text))
        parts.clear()

    for m in _TAG.finditer(page):
        if m.start() < at:  # inside raw text
            continue
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if not name:
            if m.group().startswith("<![CDATA["):
                parts.append(html.escape(m.group()[9:].removesuffix("]]>")))
            continue
        name, closing = name.lower(), bool(m.group(1))
        attributes = m.group(3)
        if name in RAW and not closing:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)
        elif name == "br":
            parts.append(" ")
        elif closing:
            if name not in INLINE:
                flush()
            if opened[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
                now = stack[-1][1] if stack else OPEN
                if now != state and name in INLINE:
                    flush()
                state = now
        elif name not in VOID:
            told = _told(name, attributes, state)
            inner = state
            if state != DROPPED and told is not None:
                inner = DROPPED if told == DROPPED else max(state, told)
            if name not in INLINE or inner != state:
                flush()
                if name == "p" and stack and stack[-1][0] == "p":  # a paragraph ends the one before
                    pop()
                    state = stack[-1][1] if stack else OPEN
                    inner = state if told is None or state == DROPPED else (DROPPED if told == DROPPED else max(state, told))
                if not attributes.endswith("/"):
                    begins = state < MAIN_PART == inner
                    if begins:
                        mains.append([len(out), None, False])
                    elif state == MAIN_PART < inner and mains:
                        mains[-1][2] = True
                    stack.append((name, inner, len(mains) - 1 if begins else -1))
                    opened[name] += 1
                    state = inner
        elif name not in INLINE:
            flush()
    if at < len(page):
        parts.append(page[at:])
    flush()
    for first, end, holds in mains:
        if holds:
            out[first:end] = [(ARTICLE if s == MAIN_PART else s, t) for s, t in out[first:end]]
    return out


def main_blocks(found: list[tuple[int, str]]) -> list[str] | None:
    """The blocks of the main content; None where nothing is marked as such."""
    best = max((s for s, _ in found), default=OPEN)
    return [t for s, t in found if s == best] if best >= MAIN_PART else None


def _stream(found: list[tuple[int, str]]) -> list[str]:
    """The tokens of a page outside of main content."""
    return [w for s, t in found if s <= OPEN for w in t.split(" ")]


def _token_hashes(words: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in words], np.uint64)


def segments(tokens: np.ndarray, length: int, gram: int = GRAM) -> Iterator[tuple[int, int, int]]:
    """(start, number of windows, minimizer) of the segments of a stream."""
    n = len(tokens) - length + 1
    if n < 1:
        return
    gram = min(gram, length)
    grams = np.zeros(len(tokens) - gram + 1, np.uint64)
    for k in range(gram):
        grams = mixed(grams + tokens[k:len(grams) + k])
    least = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1).min(axis=1)
    new = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    for a, b in zip(new.tolist(), np.append(new[1:], n).tolist(), strict=True):
        for lo in range(a, b, length):
            yield lo, min(length, b - lo), int(least[a].view(np.int64))


def repeated_windows(strings: list[np.ndarray], low: np.ndarray, high: np.ndarray, length: int) -> list[np.ndarray]:
    """For every string of tokens, which windows stand in two pages.  ``low``
    and ``high`` are the least and the greatest page that hold a string."""
    sizes = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes)
    text = np.zeros(int(ends[-1]), np.int64)
    text[np.setdiff1d(np.arange(len(text)), ends - 1)] = np.unique(np.concatenate(strings), return_inverse=True)[1] + 1
    text[ends - 1] = -np.arange(1, len(strings) + 1)  # every end is a symbol of its own
    owner = np.repeat(np.arange(len(strings)), sizes)
    rank, size = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while size < length:  # sort suffixes by twice as many tokens
        step = min(size, length - size)
        later = np.append(rank[step:], np.full(step, -1))
        order = np.lexsort((later, rank))
        a, b = rank[order], later[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        size += step
    groups = int(rank.max()) + 1
    least, most = np.full(groups, np.iinfo(np.int64).max), np.full(groups, np.iinfo(np.int64).min)
    np.minimum.at(least, rank, low[owner])
    np.maximum.at(most, rank, high[owner])
    twice = (least < most)[rank]
    return [twice[e - n:e - length] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]


_PARSED = "page_id long, url string, host string, open boolean, stream long, blocks array<struct<state:int,text:string>>"
_SEGMENT = "row long, open boolean, host string, key long, hash binary, tokens binary, stream long, start int"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text outside of main content of each page, and the stream's hash."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("open", pa.bool_()), ("stream", pa.int64()),
                        ("blocks", pa.list_(pa.struct([("state", pa.int32()), ("text", pa.string())])))])
    for batch in batches:
        opened, streams, outside = [], [], []
        for value in batch.column(3):
            found = blocks(value.as_py())
            opened.append(main_blocks(found) is None)
            rest = [(s, t) for s, t in found if s <= OPEN]
            streams.append(int.from_bytes(hashlib.blake2b("\n".join(t for _, t in rest).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True))
            outside.append([{"state": s, "text": t} for s, t in rest])
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), batch.column(2), pa.array(opened, pa.bool_()), pa.array(streams, pa.int64()),
                                          pa.array(outside, schema.field("blocks").type)], schema=schema)


def _main_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages whose main content is marked."""
    for batch in batches:
        rows = []
        for page_id, url, value in zip(*(batch.column(i) for i in range(3)), strict=True):
            found = main_blocks(blocks(value.as_py()))
            if found is not None:
                rows.append((page_id.as_py(), url.as_py(), "\n\n".join(found)))
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())], names=["page_id", "url", "text"])


_REPEATED = "host string, key long, hash binary, windows array<int>"


def dealt(distinct: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame | None]:
    """The segments with the ``bucket`` of their collection, and apart from them
    those of hot minimizers, if there are any."""
    keys = reliable(distinct.groupBy("host", "key").agg(F.count("*").alias("n")))
    total, most = keys.agg(F.sum("n"), F.max("n")).first()
    buckets = max(4 * tasks(distinct.sparkSession), -(-(total or 0) // hot))
    bucket = F.pmod(F.xxhash64("host", "key"), F.lit(buckets))
    if (most or 0) <= hot:
        return distinct.withColumn("bucket", bucket), None
    often = F.broadcast(keys.where(F.col("n") > hot).select("host", "key"))  # a row for every ``hot`` segments at most
    return distinct.join(often, ["host", "key"], "left_anti").withColumn("bucket", bucket), distinct.join(often, ["host", "key"], "left_semi")


def repeated_segments(distinct: DataFrame, length: int, hot: int = HOT) -> DataFrame:
    """host, key, hash of the segments with windows that stand in two pages, and
    these ``windows``."""
    def sort(table: pa.Table) -> pa.Table:
        strings = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
        flags = repeated_windows(strings, table.column("low").to_numpy(), table.column("high").to_numpy(), length)
        some = pa.array([i for i, f in enumerate(flags) if f.any()], pa.int64())
        return pa.table({"host": table.column("host").take(some), "key": table.column("key").take(some), "hash": table.column("hash").take(some),
                         "windows": pa.array([np.flatnonzero(flags[i]).astype(np.int32) for i in some.to_pylist()], pa.list_(pa.int32()))})

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every window, with the window's own hash."""
        names = ["host", "key", "hash", "low", "high"]
        for batch in batches:
            at, number, hashes = [], [], []
            for i, raw in enumerate(batch.column("tokens").to_pylist()):
                for k in range(len(raw) // 8 - length + 1):
                    at.append(i)
                    number.append(k)
                    hashes.append(hashlib.blake2b(raw[8 * k:8 * (k + length)], digest_size=16).digest())
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in names), pa.array(number, pa.int32()), pa.array(hashes, pa.binary())],
                                             names=[*names, "window", "own"])

    cool, warm = dealt(distinct, hot)
    repeated = cool.groupBy("bucket").applyInArrow(sort, _REPEATED)
    if warm is None:
        return repeated
    windows = warm.mapInArrow(apart, "host string, key long, hash binary, low long, high long, window int, own binary")
    twice = windows.groupBy("host", "own").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high").select("host", "own")
    return repeated.unionByName(windows.join(twice, ["host", "own"]).groupBy("host", "key", "hash").agg(F.collect_list("window").alias("windows")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", length: int = LENGTH,
            hot: int = HOT) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    spark = pages.sparkSession
    picked = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    marked = picked.mapInArrow(_main_text, "page_id long, url string, text string")

    path = shared_path(spark, f"pages-{uuid.uuid4().hex}")
    parsed = picked.select("page_id", "url", split_url(F.col("url"))[0].alias("host"), "html").mapInArrow(_parse, _PARSED)
    parsed.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    parsed = spark.read.parquet(path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                tokens = _token_hashes(_stream([(b["state"], b["text"]) for b in r["blocks"]]))
                tokens = mixed(tokens + _token_hashes([r["host"]]))  # equal tokens of two hosts are different
                for start, n, key in segments(tokens, length):
                    raw = tokens[start:start + n + length - 1].tobytes()
                    rows.append((r["row"], r["open"], r["host"], key, hashlib.blake2b(raw, digest_size=16).digest(), raw, r["stream"], start))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            types = [pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["row", "open", "host", "key", "hash", "tokens", "stream", "start"])

    distinct = reliable(parsed.mapInArrow(cut, _SEGMENT).groupBy("host", "key", "hash")
                        .agg(F.first("tokens").alias("tokens"), F.min("stream").alias("low"), F.max("stream").alias("high")))
    repeated = repeated_segments(distinct, length, hot)
    hits = (parsed.where("open").mapInArrow(cut, _SEGMENT).join(repeated, ["host", "key", "hash"]).groupBy("row")
            .agg(F.collect_list(F.struct("start", "windows")).alias("hits")))
    # whole blocks without a window; every page counts a block once
    whole = (parsed.select("row", "open", "host", "stream", F.explode(F.array_distinct(F.col("blocks.text"))).alias("text"))
             .where(F.size(F.split("text", " ")) < length).withColumn("block", F.md5("text")))
    twice = whole.groupBy("host", "block").agg(F.min("stream").alias("low"), F.max("stream").alias("high")).where("low < high").select("host", "block")
    short = whole.where("open").join(twice, ["host", "block"]).groupBy("row").agg(F.collect_list("text").alias("short"))

    def unique_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for r in batch.to_pylist():
                found, short = [(b["state"], b["text"]) for b in r["blocks"]], set(r["short"] or [])
                covered = np.zeros(len(_stream(found)) + 1, np.int64)
                for hit in r["hits"] or []:
                    at = np.array(hit["windows"]) + hit["start"]
                    np.add.at(covered, at, 1)
                    np.add.at(covered, at + length, -1)
                covered = np.cumsum(covered) > 0
                kept, at = [], 0
                for state, text in found:
                    words = text.split(" ")
                    rest = " ".join(w for w, gone in zip(words, covered[at:at + len(words)], strict=True) if not gone)
                    at += len(words)
                    if state == OPEN and rest and text not in short:
                        kept.append(rest)
                texts.append("\n\n".join(kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    opened = parsed.where("open").join(hits, "row", "left").join(short, "row", "left").select("page_id", "url", "blocks", "hits", "short").mapInArrow(unique_runs, "page_id long, url string, text string")
    return marked.unionByName(opened).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
