"""HTML extraction by equivalence classes of template tokens.

Pages are read as elements in their path and blocks of text in theirs. For each host, elements with the same occurrence vector over
its pages, copies counted once, form an equivalence class; vectors are compared by an XOR of page hashes, so a host's pages are
never brought together. A class is valid if it holds ``SIZE`` elements or more and occurs on ``SUPPORT`` of the host's pages; a host of one page
has classes too. Valid elements nest by their paths into the host's template, and the text between them fills its slots. An
element's volume is the text in the slots below it on all the host's pages, without links, furniture, adverts and comments.

The template decides where the main text is: in its outermost articles, or, where it has none, in the deepest container that
holds more than half of the volume, with the page's h1. Everything in there is main text, repeated by the host or not, but for
furniture by element name; adverts and reader comments by words of class, id or role, unless nothing else would be left; and elements
with other such words that hold less than half of the page's main text, if they are in no article or the template has them on two pages.
A page without any of its host's main elements is taken as a host of its own; one without classes gives its body's text without
furniture by element name.
"""

from __future__ import annotations

import functools
import hashlib
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small_batches

SUPPORT = 0.5
SIZE = 2
#: Templates are joined by (host, salt): a host with a third of all pages is dealt to keys of about so many pages.
KEY_PAGES = 1000

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
OPAQUE = frozenset("script style template noscript textarea select option button iframe object svg math canvas audio video head title".split())
FURNITURE = frozenset("nav header footer aside form dialog menu fieldset".split())
#: Words of class, id or role that mark adverts and reader comments, and words that mark furniture if the template bears it out.
APART = frozenset("ad ads advert adverts advertisement advertising banner comment comments commentlist cookie cookies consent disqus promo promoted promotion replies respond sponsor sponsored".split())
WORDS = frozenset("aside breadcrumb breadcrumbs complementary contentinfo dialog discussion footer form header login masthead menu menubar modal nav navbar navigation newsletter notice notices pagination popup related search share sharing sidebar signup social subscribe toolbar widget widgets".split())
MAIN = frozenset(("article", "main"))
TITLE = 2
ROOTS = frozenset(("html", "body"))
#: Elements of running text; all others may contain the main text as a whole.
TEXTUAL = frozenset("p li ul ol dl dt dd h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption table thead tbody tfoot tr".split())
#: The mark of furniture by name. Other marks are the path of the outermost element with such words, behind ``APART_MARK`` or not.
FIXED, APART_MARK = "-", "!"

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)", re.DOTALL | re.IGNORECASE)
_MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-z0-9]+")


def _role(name: str, attributes: str) -> tuple[str, bool, str | None]:
    """An element's name with its class, id and role, whether its name makes it furniture, and what its words make it."""
    marks = " ".join(a or b or c for a, b, c in _MARKS.findall(attributes)).lower() if attributes else ""
    words = [w for w in _SPLIT.split(marks) if w]
    role = name + "".join(f".{w}" for w in words if not w.isdigit())
    marked = None if name in ROOTS else APART_MARK if any(w in APART for w in words) else "" if any(w in WORDS for w in words) else None
    return role, name in FURNITURE or name in OPAQUE, marked


def parse(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, value, mark, main) in page order: kind 'open' with a path, 'text' with decoded text, 'break' between blocks.

    ``mark`` is empty, ``FIXED``, or tells the outermost element whose words mark it. ``main`` is 0 outside an article, 1 inside and ``TITLE`` in an h1.

    The path of text is that of the last open element. Comments, scripts and styles are skipped; elements left open close with
    their parents.
    """
    stack: list[tuple[str, str, str, int]] = [("", "", "", 0)]
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            _, path, mark, main = stack[-1]
            yield "text", html.unescape(page[at : m.start()]), mark, main
        at = m.end()
        name = (m[3] or "").lower()
        if m[1]:
            yield "break", "", FIXED, 0
            continue
        if not name:
            continue
        if name not in INLINE:
            yield "break", "", "", 0
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name not in INLINE and name not in VOID:
            while len(stack) > 1 and (stack[-1][0] in INLINE or stack[-1][0] == "p") and any(s[0] == "p" for s in stack):
                stack.pop()
            if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name:
                stack.pop()
        if name in VOID:
            continue
        role, furniture, marked = _role(name, m[4])
        path = f"{stack[-1][1]}/{role}"
        main = TITLE if name == "h1" else stack[-1][3] or int(name in MAIN)
        mark = stack[-1][2]
        if furniture:
            mark = FIXED
        elif marked is not None and not mark:
            mark = marked + path
        stack.append((name, path, mark, main))
        yield "open", path, stack[-1][2], stack[-1][3]
    if at < len(page):
        _, path, mark, main = stack[-1]
        yield "text", html.unescape(page[at:]), mark, main


def blocks(page: str) -> Iterator[tuple[str, str | None, str, int]]:
    """(path, text, mark, main) of each block of text, white space collapsed; and ('path', None, ...) for elements."""
    path, held, where = "", [], ("", "", 0)
    for kind, value, mark, main in parse(page):
        if kind == "text":
            if not held:
                where = (path, mark, main)
            elif mark != where[1]:  # an inline advert or comment inside a block
                if text := " ".join("".join(held).split()):
                    yield where[0], text, where[1], where[2]
                held, where = [], (path, mark, main)
            held.append(value)
            continue
        if kind == "break":
            if text := " ".join("".join(held).split()):
                yield where[0], text, where[1], where[2]
            held = []
            continue
        path = value
        yield value, None, mark, main
    if text := " ".join("".join(held).split()):
        yield where[0], text, where[1], where[2]


@functools.lru_cache(maxsize=1 << 16)
def token(path: str) -> int:
    """A 64-bit hash of an element's path."""
    return int.from_bytes(hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def above(path: str) -> Iterator[str]:
    """The path and those of the elements around it, innermost first."""
    while path:
        yield path
        path = path.rpartition("/")[0]


def _name(path: str) -> str:
    return path.rpartition("/")[2].partition(".")[0]


def elements(page: str) -> dict[str, list]:
    """Path of each element that is no furniture: how often it occurs, its volume, and whether it is an article that lies in none."""
    found: dict[str, list] = {}
    for path, block, mark, main in blocks(page):
        if mark == FIXED:
            continue
        if block is None:
            own = found.setdefault(path, [0, 0, False])
            own[0] += 1
            own[2] |= main > 0 and _name(path) in MAIN and not any(_name(p) in MAIN for p in above(path.rpartition("/")[0])) and not mark.startswith(APART_MARK)
        elif not mark.startswith(APART_MARK) and not any(_name(p) == "a" for p in above(path)):
            for p in above(path):
                found.setdefault(p, [0, 0, False])[1] += len(block)
    return found


_SEEN = "content long, host string, token long, depth int, container boolean, article boolean, marked boolean, n long, volume long"


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each page."""
    types = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
    for batch in batches:
        rows: list[tuple] = []
        for content, host, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for path, (n, volume, article) in elements(text or "").items():
                name = _name(path)
                words = path.rpartition("/")[2].split(".")[1:]
                rows.append((content, host, token(path), path.count("/"), name not in TEXTUAL and name not in INLINE, article, any(w in WORDS for w in words), n, volume))
        cols = list(zip(*rows, strict=True)) or [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[c.split()[0] for c in _SEEN.split(", ")])


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


def classes(pages: DataFrame) -> DataFrame:
    """(host, token, depth, container, article, marked, on, volume) of the elements in valid classes of each host: its template.

    ``pages`` has host and html. Pages of a host with the same html count once. An occurrence vector is known by its pages, its total,
    and an XOR of page hashes. Hashes of contents are cut to the shared folder.
    """
    pages = pages.select(F.xxhash64("html").alias("content"), "host", "html")
    contents = cut(pages.groupBy("host", "content").agg(F.count("*").alias("copies")))
    seen = pages.mapInArrow(_tokens, _SEEN)
    if not contents.where("copies > 1").isEmpty():  # copies have the same rows; without any, tokens are exchanged once
        seen = seen.distinct()
    facts = (F.max("depth").alias("depth"), F.max("container").alias("container"), F.max("article").alias("article"), F.max("marked").alias("marked"), F.sum("volume").alias("volume"))
    vectors = seen.groupBy("host", "token").agg(F.count("*").alias("on"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("content", "n")).alias("v"), *facts)
    sizes = contents.groupBy("host").agg(F.count("*").alias("pages"))
    common = vectors.join(sizes, "host").where(F.col("on") >= SUPPORT * F.col("pages"))
    # A template has no more elements than two pages together, so a class is small, and so is a host's template.
    inside = Window.partitionBy("host", "on", "total", "v")
    return common.withColumn("size", F.count("*").over(inside)).where(F.col("size") >= SIZE).select("host", "token", "depth", "container", "article", "marked", "on", "volume")


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, marked) for every host: the tokens of its main elements, which may be none, and of those with words of furniture on two
    pages or more."""
    found = cut(classes(pages))
    whole = found.groupBy("host").agg(F.max("volume").alias("whole"), F.max("article").alias("has"))
    rows = found.join(whole, "host")
    deepest = F.max_by("token", F.struct("depth", "volume", "token"))
    by_volume = rows.where("NOT has AND container AND volume * 2 > whole").groupBy("host").agg(F.array(deepest).alias("main"))
    articles = rows.where("article").groupBy("host").agg(F.collect_set("token").alias("main"))
    marked = found.where("marked AND on >= 2").groupBy(F.col("host").alias("h")).agg(F.collect_set("token").alias("marked"))
    every = pages.select(F.col("host").alias("h")).distinct()
    of_host = every.join(articles.unionByName(by_volume), F.expr("host = h"), "left").select(F.col("h").alias("host"), F.coalesce("main", F.array().cast("array<long>")).alias("main"))
    return of_host.join(marked, F.expr("host = h"), "left").drop("h")


def own_template(page: str) -> frozenset:
    """The main elements of a page that is a host of its own: by the same rules, vectors being counts."""
    found = elements(page)
    members = Counter(n for n, *_ in found.values())
    valid = {p: e for p, e in found.items() if members[e[0]] >= SIZE}
    if articles := frozenset(token(p) for p, e in valid.items() if e[2]):
        return articles
    whole = max((e[1] for e in valid.values()), default=0)
    large = [(p.count("/"), e[1], token(p)) for p, e in valid.items() if 2 * e[1] > whole and _name(p) not in TEXTUAL and _name(p) not in INLINE]
    return frozenset([max(large)[2]] if large else [])


def bare(page: str) -> list[str]:
    """The blocks of a page without any template: all but furniture by element name."""
    return [t[1] for t in blocks(page) if t[1] is not None and t[2] != FIXED]


def chosen(page: str, main: frozenset, marked: frozenset) -> list[str]:
    """The blocks of main text of a page whose host has these tokens; one that has none of them is taken as a host of its own."""
    texts = [t for t in blocks(page) if t[1] is not None and t[2] != FIXED]
    within = lambda tokens: [any(token(p) in tokens for p in above(path)) for path, *_ in texts]
    inside = within(main)
    if not any(inside):
        inside = within(own_template(page))
    if not any(inside):
        return [t[1] for t in texts]
    articles = any(_name(p) in MAIN for (path, *_), i in zip(texts, inside, strict=True) if i for p in above(path))
    if not articles:
        inside = [i or t[3] == TITLE for i, t in zip(inside, texts, strict=True)]
    texts = [t for t, i in zip(texts, inside, strict=True) if i]
    texts = [t for t in texts if not t[2].startswith(APART_MARK)] or texts
    sizes: Counter = Counter()
    for _, block, mark, _ in texts:
        sizes[mark] += len(block)
    furniture = {m for m, n in sizes.items() if m and 2 * n < sizes.total() and (not articles or token(m) in marked)}
    return [block for _, block, mark, _ in texts if mark not in furniture]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True)
        out = [" ".join(bare(page or "") if main is None else chosen(page or "", frozenset(main), frozenset(marked or ()))) for page, main, marked in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, text: str = "html", id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``; text is empty where there is none (null or empty html).

    Rows without a url share the empty host. Repeated rows each have their row; other columns are ignored; no rows, no rows.
    """
    small_batches(pages.sparkSession, 500)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), host_of(url).alias("host"), F.col(text).alias("html"))
    found = templates(rows)
    salts = max(1, math.ceil(rows.count() / KEY_PAGES))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)))
    # A host's template is joined once for each key that the host has pages in.
    keys = rows.select("host", "salt").distinct().join(found, "host").select(F.col("host").alias("h"), F.col("salt").alias("s"), "main", "marked")
    joined = rows.join(keys, F.expr("host = h AND salt = s"), "left").select("page_id", "url", "html", "main", "marked")
    out = joined.mapInArrow(_extract, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
