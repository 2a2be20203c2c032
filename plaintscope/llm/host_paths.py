"""Main-text extraction by consensus container paths per host.

1. Score: each page is read once into text blocks; every container above a block gets the
   block's text length, less what lies in links, discounted with its distance and weighted
   by what its tag and class names say. The best container of a page votes with its score
   for its generalised path (tags with their first class, digits masked).
2. Vote: votes are summed per (host, path) inside each task, then by an aggregate, and the
   heaviest path of a host wins. What is shuffled is one row per host and path of a task.
   A path is named by a number folded from its steps, so its text has a bound.
3. Re-extract: each page is read again and the text of the containers on its host's path
   is taken; a page without such a container uses its own best one.
"""

from __future__ import annotations

import functools
import html as html_lib
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_broadcast, cut_lineage
from .common import slices

# HTML element names by their role.
RAW = "script style noscript template textarea svg iframe object select option annotation canvas title head"
SWALLOWS = "script style noscript template textarea iframe title"  # to the page's end if never closed
VOID = "area base br col embed hr img input link meta param source track wbr"
BLOCKS = ("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
          "tfoot tr td th caption pre blockquote figure figcaption nav header footer aside form fieldset "
          "address details summary center dialog menu hr br button")
CONTAINERS = "body main article section div td blockquote"
BOILER_TAGS = "nav header footer aside form menu dialog button"
# Class or id words of page parts that are not the article.
BOILER_WORDS = ("ad ads advert adverts advertisement banner promo sponsor sponsored nav navbar navigation menu "
                "breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice "
                "notices popup modal overlay newsletter subscribe signup login search share sharing social related "
                "recommended recommendations comment comments commentlist disqus reply replies respond pagination pager "
                "toolbar copyright legal disclaimer skip")
GOOD_WORDS = "article content entry main post story text body"
COMMENT_WORDS = "comment comments commentlist disqus reply replies respond"
# Words that inside an article name one of its own sections as well as a part of the page.
ARTICLE_WORDS = "legal disclaimer copyright skip search login"
# Elements whose names tell a part; other blocks (headings get ids of their own words) count by a
# class that is a listed word.
NAMED = "article section div td table ul ol dl fieldset figure details aside form nav header footer"
# A token with one of these says what a page has or lacks, not what the part is.
SAYS_WORDS = "has have no not with without hide hidden open closed"
# Weight of a container named like a boilerplate part that holds the page's text, and how
# many times the text left outside it must hold.
PENALTY = 0.5
MOST_ARTICLE, MOST_TEXT = 2, 10
SINGLE_ROUNDS = 32
_WORD = (1 << 64) - 1

_RAW, _VOID, _BLOCKS = set(RAW.split()), set(VOID.split()), set(BLOCKS.split())
_CONTAINERS, _BOILER = set(CONTAINERS.split()), set(BOILER_TAGS.split())
_BAD, _GOOD, _SAYS = set(BOILER_WORDS.split()), set(GOOD_WORDS.split()), set(SAYS_WORDS.split())
_CLOSES_P = _BLOCKS - {"br", "td", "th", "tr", "button"}
_COMMENTS, _OF_ARTICLE, _NAMED = set(COMMENT_WORDS.split()), set(ARTICLE_WORDS.split()), set(NAMED.split())
_SWALLOWS = set(SWALLOWS.split())
# An attribute: a name, then perhaps = and a quoted or bare value; a quote elsewhere is a character.
# All repeats are possessive, so an attempt is linear.
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)"
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+|=(?=[\s/>]))*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTR = re.compile(r"[\s/]*+(=?[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
_NAME_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
DISCOUNT = 0.9


class _Element:
    __slots__ = ("tag", "step", "key", "boiler", "only_named", "landmark", "weight", "up", "landmarks", "p")

    def __init__(self, tag, step, boiler, only_named, landmark, weight, up):
        self.tag, self.step, self.weight, self.up = tag, step, weight, up
        self.boiler, self.only_named, self.landmark = boiler, only_named, landmark
        # The path from the top as a number, the landmarks on it, and the open <p> in reach.
        self.key = ((up.key if up else 0) * 1_000_003 + zlib.crc32(step.encode("utf-8", "replace")) + 1) & _WORD
        self.landmarks = (up.landmarks if up else 0) + landmark
        self.p = self if tag == "p" else None if tag in _CONTAINERS or up is None else up.p

    @property
    def path(self) -> str:
        """The path by its number, with the last steps to read; of bounded length."""
        steps, e = [], self
        while e is not None and len(steps) < 3:
            steps.append(e.step[:80])
            e = e.up
        return f"{self.key:016x} {'>'.join(reversed(steps))}"


def _element(tag: str, attrs: str, up: _Element | None) -> _Element:
    first, named, weight, comment = "", False, 1.0, False
    if attrs and not attrs.isspace():
        bad = _BAD - _OF_ARTICLE if up is not None and up.landmarks else _BAD
        for name, a, b, c in _ATTR.findall(attrs):
            name = name.lower()
            if name not in ("class", "id", "role"):
                continue
            value = (a or b or c).lower()
            words = set(_NAME_WORDS.findall(value))
            if words & bad:
                if tag in _NAMED:
                    tokens = [set(_NAME_WORDS.findall(t)) for t in value.split()]
                    hits = [t & bad for t in tokens if t & bad and not t & _SAYS]
                    named = named or bool(hits)
                    comment = comment or any(t & _COMMENTS for t in hits)
                elif name == "class":
                    named = named or not bad.isdisjoint(value.split())
            if words & _GOOD:
                weight = 1.3
            if name == "class" and value.split():
                first = "." + _DIGITS.sub("#", value.split()[0])
    if tag in ("article", "main"):
        weight = 2.0
    landmark = tag == "main" or tag == "article" and not named
    # A reader's comment may be an article; other names do not make an article boilerplate.
    named = comment if tag == "article" else named and tag not in ("html", "body", "main")
    return _Element(tag, tag + first, named or tag in _BOILER, tag == "form" or tag not in _BOILER,
                    landmark, weight, up)


def _up(found: list[tuple[_Element, str, int]]) -> list[_Element]:
    """The elements around the blocks, each once, outer ones first."""
    seen: set[_Element] = set()
    out: list[_Element] = []
    for e, _, _ in found:
        chain = []
        while e is not None and e not in seen:
            seen.add(e)
            chain.append(e)
            e = e.up
        out += reversed(chain)
    return out


def _without_parts(found: list[tuple[_Element, str, int]]) -> list[tuple[_Element, str, int]]:
    """The blocks outside boilerplate parts (<main> stands in none). A part is a wrapper, its blocks
    stay and only its weight falls, if no article or main has text outside the parts and it holds
    one with twice the text left outside; or if it is one by its name or a form only and holds ten
    times that text. The part that holds most is taken first. After some rounds of one part each,
    every such part is taken in a round, so nested wrappers without end cost a few rounds."""
    elements = _up(found)
    rounds = 0
    while True:
        rounds += 1
        outer: dict[_Element, _Element | None] = {}  # the outermost part around each element
        for e in elements:
            above = outer[e.up] if e.up is not None else None
            outer[e] = None if e.tag == "main" else above or (e if e.boiler else None)
        left, article = [], False
        inside: dict[_Element, list[int]] = defaultdict(lambda: [0, 0])
        clean = 0
        for block in found:
            e, text, in_links = block
            gain = max(0, len(text) - 2 * in_links)
            part = outer[e]
            if part is None:
                left.append(block)
                clean += gain
                article = article or e.landmarks > 0
            else:
                inside[part][0] += gain
                if e.landmarks > part.landmarks:
                    inside[part][1] += gain
        if article:
            return left
        wrapper = max((e for e, (_, n) in inside.items() if n and n >= MOST_ARTICLE * clean),
                      key=lambda e: inside[e][1], default=None)
        if wrapper is None:
            wrapper = max((e for e, (n, _) in inside.items() if e.only_named and n and n >= MOST_TEXT * clean),
                          key=lambda e: inside[e][0], default=None)
        if wrapper is None:
            return left
        wrapper.boiler = False
        wrapper.weight *= PENALTY
        if rounds >= SINGLE_ROUNDS:  # wrappers in wrappers: the whole chain below at once
            for e in elements:
                if e.boiler and e.only_named and outer[e] is wrapper:
                    e.boiler = False
                    e.weight *= PENALTY


def blocks(page: str) -> list[tuple[_Element, str, int]]:
    """``(innermost block element, text, characters in links)`` in page order, without
    comments, scripts, styles and boilerplate parts (see ``_without_parts``). White space inside a block is
    one space. Unclosed and stray tags, and nesting of any depth, are tolerated in linear time."""
    out: list[tuple[_Element, str, int]] = []
    top = _element("html", "", None)
    here, at, link = top, 0, 0
    parts: list[str] = []
    linked: list[str] = []
    opened: Counter = Counter()  # open elements by tag
    unclosed: set[str] = set()  # raw elements that no end tag follows any more
    tag_of, last = _TAG, page.rfind(">")

    def close() -> None:
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                in_links = len(" ".join("".join(linked).split())) if linked else 0
                out.append((here, text, in_links))
            parts.clear()
            linked.clear()

    def leave(e: _Element) -> None:
        """End everything inside e, and e."""
        nonlocal here
        close()
        while here is not e:
            opened[here.tag] -= 1
            here = here.up
        opened[e.tag] -= 1
        here = e.up

    def text(a: int, b: int) -> None:
        if b > a:
            parts.append(page[a:b])
            if link:
                linked.append(parts[-1])

    n = len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0 or start > last and not page.startswith("<!--", start):  # nothing can end a tag
            text(at, n)
            break
        text(at, start)
        after = page[start + 1:start + 2]
        if after in ("!", "?"):
            mark = "-->" if page.startswith("<!--", start) else ">"
            end = page.find(mark, start + (4 if mark == "-->" else 2))
            at = n if end < 0 else end + len(mark)
            continue
        m = tag_of.match(page, start)
        if m is None and tag_of is _TAG and _PLAIN_TAG.match(page, start):
            tag_of = _PLAIN_TAG  # a quote swallows the rest: tags end at the next > from here on
            m = tag_of.match(page, start)
        if m is None:  # no tag: a sign
            text(start, start + 1)
            at = start + 1
            continue
        at = m.end()
        tag = m.group(2).lower()
        if m.group(1):  # end tag
            if tag == "a":
                link = max(0, link - 1)
            if tag in _BLOCKS and tag not in _VOID:
                if opened[tag] > 0:
                    e = here
                    while e.tag != tag:
                        e = e.up
                    leave(e)
                elif tag == "p":
                    close()
            continue
        attrs = m.group(3)
        if tag in _RAW:
            if tag in ("head", "svg", "object", "canvas"):
                close()
            if not attrs.endswith("/") and tag not in unclosed:
                end = _end_of(tag).search(page, at)
                if end:
                    at = end.end()
                elif tag in _SWALLOWS:  # never closed: the rest of the page is its content
                    at = n
                else:
                    unclosed.add(tag)
            continue
        if tag == "a":
            link = 1
        if tag not in _BLOCKS:
            continue
        if tag in ("br", "hr"):
            close()
            continue
        if tag == "html":
            continue
        if tag in _CLOSES_P and here.p is not None:
            leave(here.p)
        if tag in ("li", "dt", "dd", "tr", "td", "th") and here.tag == tag:
            leave(here)
        close()
        here = _element(tag, attrs, here)
        opened[tag] += 1
        link = 0
    close()
    return _without_parts(out)


@functools.cache
def _end_of(tag: str) -> re.Pattern:
    """The end of a raw element's content (of the listed names only)."""
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>" if tag != "head" else r"</head[^>]*>|(?=<body[\s>])", re.I)


def best_container(found: list[tuple[_Element, str, int]]) -> tuple[_Element | None, float]:
    """The page's container of the highest score: its blocks' lengths, discounted once for each
    container in between. Summed from the innermost elements outwards."""
    scores: dict[_Element, float] = defaultdict(float)
    for e, text, in_links in found:
        scores[e] += max(0, len(text) - 2 * in_links)
    elements = _up(found)
    for e in reversed(elements):
        if e.up is not None:
            scores[e.up] += scores[e] * (DISCOUNT if e.tag in _CONTAINERS else 1.0)
    best, most = None, 0.0
    for e in elements:
        if e.tag in _CONTAINERS and scores[e] * e.weight > most:
            best, most = e, scores[e] * e.weight
    return best, most


def _inside(found: list[tuple[_Element, str, int]], wanted) -> list[str]:
    """The texts of the blocks with a wanted element around them."""
    within: dict[_Element | None, bool] = {None: False}
    for e in _up(found):
        within[e] = within[e.up] or wanted(e)
    return [t for e, t, _ in found if within[e]]


def extract(page: str | None, path: str | None) -> str:
    """The article's blocks, joined by newlines; by ``path`` if the page has it."""
    if not page:
        return ""
    found = blocks(page)
    texts: list[str] = []
    if path:
        key = int(path[:16], 16)
        texts = _inside(found, lambda e: e.key == key)
    if not texts:
        best, _ = best_container(found)
        texts = [t for _, t, _ in found] if best is None else _inside(found, lambda e: e is best)
    return "\n".join(texts)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[tuple[str, str], list] = defaultdict(lambda: [0.0, 0])

    def flush() -> pa.RecordBatch:
        keys = list(total)
        out = pa.RecordBatch.from_pydict({
            "host": [h for h, _ in keys], "path": [p for _, p in keys],
            "score": [float(total[k][0]) for k in keys], "pages": [total[k][1] for k in keys]})
        total.clear()
        return out

    for b in slices(batches):
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if page:
                best, score = best_container(blocks(page))
                if best is not None:
                    t = total[host, best.path]
                    t[0] += round(score)
                    t[1] += 1
        if len(total) > 50_000:
            yield flush()
    if total:
        yield flush()


def host_column() -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract("url", _HOST, 1), F.lit("")))


def winning_paths(pages: DataFrame) -> DataFrame:
    """``(host, path)``: each host's path of the highest summed score (ties: the smaller)."""
    votes = (pages.select(host_column().alias("host"), F.col("html").cast("string"))
             .mapInArrow(_votes, "host string, path string, score double, pages long"))
    return (votes.groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum("pages").alias("pages"))
            .groupBy("host").agg(F.min(F.struct(-F.col("score"), -F.col("pages"), "path")).alias("w"))
            .select("host", F.col("w.path").alias("path")))


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    Null or empty html gives the empty text; a null url or one without a host votes with
    the other pages without a host. Repeated rows are extracted each. Other columns are
    not read. Pages stay in their input partitions when the winning paths (one narrow row
    per host) are few enough to broadcast by their measured count; beyond it the join on
    the host is left to the planner and its splitting of skewed hosts."""
    base = pages.select(F.col("page_id"), F.col("url"), F.col("html").cast("string").alias("html"))
    paths = bounded_broadcast(cut_lineage(winning_paths(base)))
    joined = (base.withColumn("host", host_column())
              .join(paths, "host", "left").select("page_id", "url", "html", "path"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [extract(h, p) for h, p in zip(b.column("html").to_pylist(), b.column("path").to_pylist())]
            yield pa.RecordBatch.from_pydict({
                "page_id": b.column("page_id"), "url": b.column("url").cast(pa.string()),
                "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    kind = dict(base.dtypes)["page_id"]
    return joined.mapInArrow(work, f"page_id {kind}, url string, text string, n_chars long")
