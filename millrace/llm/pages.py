"""Main text of web pages: lines that a page shares with its nearest pages by URL are not its own."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import partitions, stored

# Fixed values of HTML: elements without content of their own, with raw content, and inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|select|svg|iframe|object|head|title"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn del em font i img ins kbd label mark meter output q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
CHROME = frozenset("nav footer aside form menu dialog button fieldset".split())
# Words of class, id and role that name what is not the article.
HINTS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside widget ad ads advert adverts "
    "advertisement sponsor sponsored promo banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "commentlist disqus reply replies respond pagination pager toolbar search skip hidden contentinfo complementary".split()
)
REMARKS = frozenset("comment comments commentlist disqus reply replies respond".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*>",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
CONCEALED = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

OUTSIDE, MAIN, ARTICLE = 0, 1, 2
LINKED = 4  # added where most of a line is link text


def lines(page: str) -> tuple[list[str], list[int]]:
    """The page's lines (blocks) without what its markup calls something else, and where each stands.

    Entities are decoded and white space in a block becomes one space. Open elements are kept on a
    stack; an end tag without a start is ignored, one further down closes all above it.
    """
    found, kinds, stack = [], [], []
    parts: list[str] = []
    linked = plain = 0
    skipped = article = main = links = 0

    def flush() -> None:
        nonlocal linked, plain
        text = " ".join("".join(parts).split())
        if text:
            kind = ARTICLE if article else MAIN if main else OUTSIDE
            found.append(text)
            kinds.append(kind + (LINKED if linked > plain else 0))
        parts.clear()
        linked = plain = 0

    def take(text: str) -> None:
        nonlocal linked, plain
        if skipped or not text:
            return
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        size = len(text.strip())
        if links:
            linked += size
        else:
            plain += size

    def leave(entry) -> None:
        nonlocal skipped, article, main, links
        name, skip = entry
        skipped -= skip
        article -= name == "article" and not skip
        main -= name in ("main", "role=main") and not skip
        links -= name == "a"

    at = 0
    for token in TOKEN.finditer(page):
        take(page[at : token.start()])
        at = token.end()
        name = token["name"]
        if name is None:
            if token["raw"]:
                flush()
            continue
        name = name.lower()
        if name in ("br", "wbr", "img"):
            if name == "br":
                take(" ")
            continue
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if token["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name or (stack[k][0] == "role=main" and name == "div"):
                    while len(stack) > k:
                        leave(stack.pop())
                    break
            continue
        rest = token["rest"] or ""
        skip = name in CHROME or (name == "header" and not article and not main)
        if not skip and "=" in rest:
            words = {w for m in NAMED.finditer(rest) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower())}
            skip = bool(words & (REMARKS if name in ("article", "main", "body", "html") else HINTS))
            if not skip and "main" in words and name == "div" and re.search(r"role\s*=\s*[\"']?main", rest, re.I):
                name = "role=main"
        if not skip and rest:
            skip = bool(CONCEALED.search(rest)) and name not in ("html", "body")
        if rest.endswith("/") and name not in ("article", "main", "body"):
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            leave(stack.pop())
        stack.append((name, skip))
        skipped += skip
        article += name == "article" and not skip
        main += name in ("main", "role=main") and not skip
        links += name == "a"
    if not page[at:].startswith("<"):
        take(page[at:])
    flush()
    return found, kinds


def shared(mine: list[int], other: list[int]) -> list[int]:
    """Positions in ``mine`` of a longest common subsequence with ``other``, by its matching positions alone."""
    places = defaultdict(list)
    for k, h in enumerate(other):
        places[h].append(k)
    tails: list[int] = []
    ends: list[tuple[int, int | None]] = []
    back: list[tuple[int, int | None]] = []
    for k, h in enumerate(mine):
        for at in reversed(places.get(h, ())):
            length = bisect_left(tails, at)
            before = ends[length - 1] if length else None
            back.append((k, before))
            if length == len(tails):
                tails.append(at)
                ends.append(len(back) - 1)
            elif at < tails[length]:
                tails[length], ends[length] = at, len(back) - 1
    out, step = [], ends[-1] if ends else None
    while step is not None:
        out.append(back[step][0])
        step = back[step][1]
    return out[::-1]


def main_text(own: list[str], kinds: list[int], hashes: list[int], others: list[list[int]]) -> str:
    """The lines of a page that are its article.

    Lines shared with a nearby page go, unless the page calls them its article: there a shared line
    goes only if it is link text as well. A nearby page that shares four fifths of the text is a copy and
    says nothing about what is the site's. Where a page marks an article, or else a main part, only
    lines in it count.
    """
    places = [k & 3 for k in kinds]
    best = max(places, default=OUTSIDE)
    gone = set()
    whole = sum(map(len, own))
    for other in others:
        same = shared(hashes, other)
        if 5 * sum(len(own[k]) for k in same) < 4 * whole:
            gone.update(same)
    kept = []
    for k, line in enumerate(own):
        if places[k] != best or (k in gone and (best == OUTSIDE or kinds[k] & LINKED)):
            continue
        if best == OUTSIDE and kinds[k] & LINKED:
            continue
        kept.append(line)
    return "\n".join(kept)


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        hashes = [[xxhash.xxh64_intdigest(x) - 2**63 for x in lines(page or "")[0]] for page in rows.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(hashes, pa.list_(pa.int64()))], names=["k", "hashes"])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines packed small, as they are shuffled once."""
    pack = zstandard.ZstdCompressor(level=3)
    for rows in batches:
        found = [lines(page or "") for page in rows.column(3).to_pylist()]
        packed = [pack.compress("\n".join(own).encode("utf-8", "surrogatepass")) for own, _ in found]
        yield pa.RecordBatch.from_arrays(
            [rows.column(0), rows.column(1), rows.column(2), pa.array(packed, pa.binary()), pa.array([k for _, k in found], pa.list_(pa.int32()))],
            names=["k", "page_id", "url", "packed", "kinds"],
        )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for rows in batches:
        texts = []
        for packed, kinds, others in zip(*(rows.column(n).to_pylist() for n in ("packed", "kinds", "others"))):
            own = unpack.decompress(packed).decode("utf-8", "surrogatepass").split("\n") if kinds else []
            hashes = [xxhash.xxh64_intdigest(x) - 2**63 for x in own]
            texts.append(main_text(own, kinds, hashes, others or []))
        yield pa.RecordBatch.from_arrays(
            [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def neighbours(keyed: DataFrame) -> DataFrame:
    """(k, other): the pages before and after each in the order of URL paths within its host.

    ``keyed`` has ``host``, ``path`` and a unique ``k``. The order is cut into ranges, so a host
    with a third of all pages is spread; the last page of a range meets the first of the next
    through one row per range.
    """
    spark = keyed.sparkSession
    order = ["host", "path", "k"]
    ranged = stored(
        keyed.select(*order).repartitionByRange(partitions(spark), *order).select("*", F.spark_partition_id().alias("range")), "urls"
    )
    edges = ranged.groupBy("range").agg(F.min(F.struct(*order)).alias("first"), F.max(F.struct(*order)).alias("last"))
    by_range = Window.orderBy("range")  # one row per range
    edges = stored(edges.select("range", F.lag("last").over(by_range).alias("before"), F.lead("first").over(by_range).alias("after")), "edges")
    inside = Window.partitionBy("range").orderBy(*order)
    near = F.struct(*order)
    rows = ranged.select("*", F.lag(near).over(inside).alias("previous"), F.lead(near).over(inside).alias("next")).join(edges, "range")
    both = rows.select("host", "k", F.explode(F.array(F.coalesce("previous", "before"), F.coalesce("next", "after"))).alias("other"))
    return both.where(F.col("host") == F.col("other.host")).select("k", F.col("other.k").alias("other"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    A null page is empty. Pages without a host in their URL are paired with none. Rows that repeat
    in all columns count as one when pages are paired and come out as often as they went in; a copy
    of a page is no evidence against it. Pages are parsed twice, first for the hashes of their
    lines alone, so that whole texts are shuffled once. No rows: no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.select(F.xxhash64("page_id", "url", "html").alias("k"), "page_id", "url", "html")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1))
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    keyed = rows.select("k", host.alias("host"), path.alias("path")).where("host <> ''").distinct()
    outlines = rows.where(host != "").select("k", "html").mapInArrow(_outlines, "k long, hashes array<long>")
    outlines = stored(outlines.dropDuplicates(["k"]).select(F.col("k").alias("other"), "hashes"), "outlines")
    others = neighbours(keyed).join(outlines, "other").groupBy("k").agg(F.collect_list("hashes").alias("others"))
    parsed = rows.mapInArrow(_parsed, "k long, page_id long, url string, packed binary, kinds array<int>")
    return parsed.join(stored(others, "others"), "k", "left").drop("k").mapInArrow(_texts, "page_id long, url string, text string, n_chars long")
