"""Main text of web pages, with the site's own template removed.

Every element subtree that could be a template is hashed, whatever its names, and
Spark counts per host in how many pages with another article it occurs. Subtrees that
recur are cut out. What counting cannot reach, on hosts of few pages or because it
differs from page to page, goes by tag and by the words of class, id or role.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A subtree is a template of its host from this many different articles on, however
# many pages the host has, so more pages never bring a template back.
LEAST_PAGES = 5
# Pages of one host that a task takes together, and the most hosts that are split;
# beyond so many, a part holds one page in MOST_SPLIT_HOSTS of all.
PAGES_AT_ONCE = 500
MOST_SPLIT_HOSTS = 10_000

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)""", re.I)

# Elements that break a block; others stand inside a line.
_BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section
    select summary table tbody td tfoot th thead title tr ul""".split()
)
_EMPTY = frozenset("hr".split())
_DROPPED = frozenset("nav header footer aside form head title dialog menu select button object".split())
# Words in class, id or role that mark what is not article text.
_DROPPED_WORDS = frozenset(
    """ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu
    nav navbar navigation breadcrumb breadcrumbs header footer masthead cookie cookies consent gdpr notice popup modal overlay
    newsletter subscribe subscription signup share sharing social related recommended comment comments disqus
    reply replies respond widget toolbar pagination pager login search form contentinfo complementary""".split()
)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody thead figcaption".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CLOSES_P = _BLOCKS - {"body", "html", "head"}
# A start tag that ends an open element of its kind, up to what holds them.
_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}


@dataclass
class _Open:
    tag: str
    number: int
    drops: bool
    candidate: bool
    parts: list = field(default_factory=list)


@dataclass
class Page:
    """Blocks of text with their region, empty if they go by name, and the numbers of
    the candidate elements they lie in; and the hash of each candidate's subtree."""

    blocks: list[tuple[str, str, tuple[int, ...]]]
    hashes: dict[int, int]


def _hash(*parts: str) -> int:
    digest = hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


def _names(attrs: str) -> str:
    if not attrs:
        return ""
    return " ".join(x for m in _NAMED.finditer(attrs) for x in m.groups() if x).lower()


def _marks(attrs: str) -> set[str]:
    names = _names(attrs)
    return set(re.split(r"[^a-z0-9]+", names)) & _DROPPED_WORDS if names else set()


def parse(source: str | None) -> Page:
    """The blocks of a page. Inline elements do not count; a paragraph ends where a
    block begins; stray end tags are skipped."""
    source = source or ""
    stack: list[_Open] = [_Open("", 0, False, False)]
    blocks: list[tuple[str, str, tuple[int, ...]]] = []
    hashes: dict[int, int] = {}
    line: list[str] = []
    inline: list[tuple[str, int]] = []
    numbers = 0

    def flush() -> None:
        if line:
            text = " ".join(html.unescape("".join(line)).split())
            line.clear()
            if text:
                stack[-1].parts.append(text)
                tags = {e.tag for e in stack}
                region = "article" if "article" in tags else "main" if "main" in tags else "page"
                if any(e.drops for e in stack):
                    region = ""
                blocks.append((text, region, tuple(e.number for e in stack if e.candidate)))

    def close() -> None:
        flush()
        done = stack.pop()
        value = _hash(done.tag, *done.parts)
        stack[-1].parts.append(str(value))
        if done.candidate:
            hashes[done.number] = value

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            close()

    last = 0
    for match in _TAG.finditer(source):
        if match.start() > last:
            line.append(source[last : match.start()])
        last = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            line.append(" ")
            continue
        if tag not in _BLOCKS and tag not in _DROPPED:
            # Inline: only one that goes by name counts, and takes back its text.
            if match["end"]:
                if inline and inline[-1][0] == tag:
                    del line[inline.pop()[1] :]
            elif not match["attrs"].endswith("/") and (_marks(match["attrs"]) or inline and inline[-1][0] == tag):
                inline.append((tag, len(line) if _marks(match["attrs"]) else 1 << 30))
            continue
        inline.clear()
        if match["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if depth:
                close_to(depth)
            continue
        if tag in _CLOSES_P:
            flush()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if depth:
                close_to(depth)
        if tag in _SAME:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _SAME[tag]:
                    break
                if stack[i].tag == tag or (tag in ("dt", "dd") and stack[i].tag in ("dt", "dd")):
                    close_to(i)
                    break
        flush()
        if tag in _EMPTY:
            continue
        attrs = match["attrs"]
        names, marks = _names(attrs), _marks(attrs)
        if tag in _HEADINGS or tag in ("body", "html", "main"):
            marks = set()
        elif tag == "article":
            marks &= {"comment", "comments", "reply", "ad", "advert", "sponsored", "promo", "related"}
        numbers += 1
        candidate = tag not in ("article", "main", "body", "html") and (tag not in _PROSE or bool(names))
        stack.append(_Open(tag, numbers, tag in _DROPPED or bool(marks) or bool(_HIDDEN.search(attrs)), candidate, [names]))
    line.append(source[last:])
    close_to(1)
    flush()
    return Page(blocks, hashes)


def _region(page: Page) -> str:
    """Where the text is: the article; without one, the main element, or the page."""
    found = {region for _, region, _ in page.blocks}
    return "article" if "article" in found else "main" if "main" in found else "page"


def main_text(page: Page, templates: set[int]) -> str:
    chosen = _region(page)
    return "\n\n".join(
        text
        for text, region, inside in page.blocks
        if not any(page.hashes[n] in templates for n in inside) and region == chosen
    )


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each page its candidate subtrees that hold text, with a hash of the
    article's text outside of each."""
    for batch in batches:
        hosts, keys, rests = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = parse(source)
            chosen = _region(page)
            blocks = [(_hash(text) if region == chosen else 0, inside) for text, region, inside in page.blocks]
            total, within = sum(h for h, _ in blocks), {}
            for h, inside in blocks:
                for n in inside:
                    within[n] = within.get(n, 0) + h
            seen = set()
            for n, held in within.items():
                key = page.hashes[n]
                if key not in seen:
                    seen.add(key)
                    hosts.append(host)
                    keys.append(key)
                    rests.append(_hash(str(total - held)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, type=pa.string()), pa.array(keys, type=pa.int64()), pa.array(rests, type=pa.int64())],
            ["host", "subtree", "rest"],
        )


def site_templates(pages: DataFrame) -> DataFrame:
    """(host, subtree) of the subtrees that recur in pages of a host whose articles
    differ outside of them, so copies of an article are no template."""
    hosted = pages.select(_host().alias("host"), "html").where("host is not null")
    found = hosted.mapInArrow(_subtrees, "host string, subtree long, rest long")
    # First one row per page text, so that a subtree of a large host is counted from parts.
    counted = found.groupBy("host", "subtree", "rest").count().groupBy("host", "subtree").agg(F.count("*").alias("texts"))
    return counted.where(F.col("texts") >= LEAST_PAGES).select("host", "subtree")


def _host():
    return F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [
            main_text(parse(source), set(found or ()))
            for source, found in zip(batch.column("html").to_pylist(), batch.column("templates").to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, type=pa.string()),
                pa.array([len(t) for t in texts], type=pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text and n_chars.

    Null or empty html gives empty text. Pages whose url has no host have no site
    template. Repeated rows stay and count as one page text."""
    rows = pages.select("page_id", "url", "html", _host().alias("host"))
    least = max(PAGES_AT_ONCE, pages.count() // MOST_SPLIT_HOSTS)
    # At most MOST_SPLIT_HOSTS rows, as each stands for more pages than one in so many.
    split = (
        rows.groupBy("host")
        .agg(F.ceil(F.count("*") / least).cast("int").alias("parts"))
        .where("parts > 1 and host is not null")
    )
    last = F.coalesce("parts", F.lit(1)).cast("long") - 1
    # The templates of a host are few elements, so a host's set is one short list.
    templates = (
        site_templates(pages)
        .groupBy("host")
        .agg(F.collect_set("subtree").alias("templates"))
        .join(F.broadcast(split), "host", "left")
        .select("host", "templates", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    )
    # A large host's pages are dealt over its parts, those without host over all tasks.
    spread = F.xxhash64("page_id", "url", "html")
    rows = rows.join(F.broadcast(split), "host", "left").withColumn(
        "part", F.when(F.col("host").isNull(), spread).otherwise(F.pmod(spread, F.coalesce("parts", F.lit(1))))
    )
    return rows.join(templates, ["host", "part"], "left").select("page_id", "url", "html", "templates").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
