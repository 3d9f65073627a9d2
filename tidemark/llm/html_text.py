"""Main text of web pages, with site templates removed.

A page is read into an element tree once per pass. First pass: every element subtree is
hashed, and Spark counts per host on how many different pages a subtree occurs; identical
pages of a host count once. Subtrees on at least ``min_pages`` pages and ``COMMON_SHARE`` of the
host's pages recur. A host cannot have more of them than its mean number of elements divided by
the share, so that a host's list is bounded by its pages' size and not by their number. Second
pass: the lists are joined to the pages by host (a hot host is a skewed join side that Spark
splits), template subtrees are deleted, and what the page itself marks as menu, header, footer,
sidebar, notice, advert, form, comment or code is left out.

Of the subtrees that recur, those on ``min_share`` of the host's pages are template wherever they
stand. The others may be article text (a headline, a sentence), so their place decides, on pages
that do not mark their main part: the main part is then the innermost block that holds other
blocks and more than half of the text that does not recur. Recurring blocks outside of it are
template, and inside of it those that stand side by side or hold several blocks with text; a
single one stays. Pages without any text of their own keep what they have.

Defined results: NULL html gives an empty text; NULL urls have no host and no template; broken
markup is read leniently (missing end tags, stray end tags, unclosed comments); repeated rows
are kept; extra columns are not looked at; no table is too small (an empty one gives no rows).
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, query, table
from tidemark.operators.sizing import fits_broadcast

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre "
    "section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that are never part of the text.
DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea "
    "iframe object embed svg canvas audio video map menu dialog noembed noframes datalist math".split()
)
#: Roles and words of class names and ids that mark what is not the article.
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NOISE = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside "
    "nav navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices "
    "gdpr popup modal overlay newsletter subscribe subscription signup login comment comments disqus replies reply "
    "respond share sharing social related recommended widget toolbar pagination pager".split()
)
MAIN = ("article", "main")
#: Least share of a host's pages for subtrees that are template by their place.
COMMON_SHARE = 0.01
#: An element that opens inside one of the second kind closes it first, up to the third kind.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>|</?([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Element:
    __slots__ = ("tag", "noise", "inside", "hash")

    def __init__(self, tag: str, noise: bool = False):
        self.tag = tag
        self.noise = noise
        self.inside: list[Element | str] = []
        self.hash = 0


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v[1:-1] if v[:1] in "\"'" and v[-1:] == v[:1] and len(v) > 1 else v for k, v in ATTRIBUTE.findall(text)}


def _is_noise(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    a = _attributes(attributes)
    if a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    words = {w.lower() for w in WORD.findall(f"{a.get('class', '')} {a.get('id', '')}")}
    return not NOISE.isdisjoint(words)


def parse(html: str) -> Element:
    """The element tree of a page; every element carries the hash of its subtree."""
    root = Element("#page")
    stack = [root]
    raw: str | None = None
    at, n = 0, len(html)
    match = TOKEN.match
    while at < n:
        if raw:
            end = re.compile(rf"</{raw}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else n
            if stop > at:
                stack[-1].inside.append(unescape(html[at:stop]) if raw in ("textarea", "title") else html[at:stop])
            at, raw = stop, None
            continue
        m = match(html, at)
        at = m.end()
        tag = m[1] or m[3]
        if tag is None:
            text = m[0]
            if text[0] != "<" or len(text) == 1:
                stack[-1].inside.append(unescape(text) if "&" in text else text)
            continue
        tag = tag.lower()
        if m[0][1] == "/":
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    _close(stack, k)
                    break
                if stack[k].tag in MAIN and tag not in ("body", "html", *MAIN):
                    break
            continue
        if tag in BLOCKS:
            _close_up_to(stack, {"p"}, {"table", "td", "th", "button", "object", "template", *MAIN})
        if tag in CLOSES:
            _close_up_to(stack, *CLOSES[tag])
        attributes = m[2] or m[4] or ""
        element = Element(tag, _is_noise(tag, attributes))
        stack[-1].inside.append(element)
        if tag in VOID:
            element.hash = xxhash.xxh3_64_intdigest(tag)
        elif not attributes.rstrip().endswith("/") or tag not in ("svg", "path", "use"):
            stack.append(element)
            raw = tag if tag in RAW else None
    _close(stack, 0)
    return root


def _close(stack: list[Element], k: int) -> None:
    for e in reversed(stack[k:]):
        parts = [e.tag]
        for x in e.inside:
            parts.append(str(x.hash) if isinstance(x, Element) else " ".join(x.split()))
        e.hash = xxhash.xxh3_64_intdigest("\x01".join(parts))
    del stack[k:]


def _close_up_to(stack: list[Element], closed: set[str], stops: set[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in closed:
            _close(stack, k)
            return
        if stack[k].tag in stops:
            return


def subtree_hashes(root: Element) -> set[int]:
    """Hashes of all subtrees that hold text, but for the page's frame and main parts."""
    found: set[int] = set()
    todo = [root]
    while todo:
        e = todo.pop()
        inner = [x for x in e.inside if isinstance(x, Element)]
        if e.tag not in ("#page", "html", "body", "head", *MAIN) and e.inside:
            found.add(e.hash)
        todo += inner
    return found


def _recurring(root: Element, template: frozenset[int], common: frozenset[int]) -> set[Element]:
    """Of the blocks in ``common``, those that are template by their place on a page without marked main part."""
    visited, recur, todo = [], set(), [root]
    while todo:
        e = todo.pop()
        visited.append(e)
        for x in e.inside:
            if isinstance(x, Element) and not _dropped(x, template) and not _is_link_list(x):
                if x.hash in common and x.tag in BLOCKS and x.tag not in ("html", "body", *MAIN):
                    recur.add(x)
                else:
                    todo.append(x)
    own: dict[Element, int] = {}
    for e in reversed(visited):
        own[e] = sum(len("".join(x.split())) if isinstance(x, str) else own.get(x, 0) for x in e.inside)
    if not recur or not own[root]:
        return set()
    main = part = root
    while part is not None:
        children = [x for x in part.inside if isinstance(x, Element) and own.get(x)]
        if part.tag in BLOCKS and any(x.tag in BLOCKS for x in children):
            main = part
        part = next((x for x in children if 2 * own[x] > own[root]), None)
    found = set(recur)
    todo = [main]
    while todo:
        e = todo.pop()
        run: list[Element] = []
        for x in [*e.inside, None]:
            if isinstance(x, Element):
                if x in recur:
                    run.append(x)
                    continue
                if x in own:
                    todo.append(x)
                if not own.get(x):
                    continue
            elif x is not None and not x.strip():
                continue
            if len(run) == 1 and _text_blocks(run[0]) < 2:
                found.discard(run[0])
            run = []
    return found


def _text_blocks(e: Element) -> int:
    """The number of blocks that hold text and no smaller block with text."""
    order, todo = [], [e]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += [y for y in x.inside if isinstance(y, Element) and not y.noise]
    count: dict[Element, int] = {}
    text: dict[Element, bool] = {}
    for x in reversed(order):
        below = [y for y in x.inside if isinstance(y, Element) and y in count]
        count[x] = sum(count[y] for y in below)
        text[x] = any(text[y] for y in below) or any(isinstance(y, str) and y.strip() for y in x.inside)
        if x.tag in BLOCKS and text[x]:
            count[x] = max(1, count[x])
    return count[e]


def main_text(root: Element, template: frozenset[int] = frozenset(), common: frozenset[int] = frozenset()) -> str:
    """The page's blocks, one a line, without template subtrees and marked noise."""
    roots = _main_parts(root, template)
    whole = not roots
    placed = _recurring(root, template, common) if whole and common else set()
    blocks: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            blocks.append(text)

    for part in roots or [root]:
        todo: list[Element | str | None] = [part]
        while todo:
            x = todo.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                buffer.append(x)
            elif x is not part and (x in placed or _dropped(x, template) or whole and _is_link_list(x)):
                if x.tag in BLOCKS:
                    flush()
            elif x.tag == "br":
                buffer.append(" ")
            else:
                block = x.tag in BLOCKS or x is part
                if block:
                    flush()
                    todo.append(None)
                todo += reversed(x.inside)
        flush()
    return "\n".join(blocks)


def _dropped(e: Element, template: frozenset[int]) -> bool:
    if e.hash in template and e.tag not in ("html", "body", "head", *MAIN):
        return True
    return e.noise and (e.tag in DROPPED or e.tag in MAIN or not _has_main(e))


def _has_main(e: Element) -> bool:
    """Whether a main part that is not noise itself lies below: then ``e`` is only a frame."""
    todo = [e]
    while todo:
        for x in todo.pop().inside:
            if isinstance(x, Element):
                if x.tag in MAIN and not x.noise:
                    return True
                todo.append(x)
    return False


def _main_parts(root: Element, template: frozenset[int]) -> list[Element]:
    """The outermost articles that are not noise, or else the main elements."""
    for tag in MAIN:
        found, todo = [], [root]
        while todo:
            e = todo.pop()
            if e.tag == tag and not e.noise:
                found.append(e)
            elif not _dropped(e, template):
                todo += [x for x in reversed(e.inside) if isinstance(x, Element)]
        if found:
            return found
    return []


def _is_link_list(e: Element) -> bool:
    """On pages without a main part: a list of two links or more and nearly nothing else."""
    if e.tag not in ("ul", "ol", "div", "table", "section"):
        return False
    links, inside, total = 0, 0, 0
    todo: list[tuple[Element | str, bool]] = [(e, False)]
    while todo:
        x, linked = todo.pop()
        if isinstance(x, str):
            k = len("".join(x.split()))
            total += k
            inside += k * linked
        else:
            links += x.tag == "a"
            todo += [(y, linked or x.tag == "a") for y in x.inside]
    return links >= 2 and inside >= 0.8 * total


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def host_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = 5, min_share: float = 0.5) -> DataFrame:
    """(host, subtrees, common): hashes of the subtrees that recur across a host's different pages, on ``min_share`` of them and on fewer."""

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole, parts = [], []
        for html in batch.column(1).to_pylist():
            root = parse(html or "")
            whole.append(_signed(root.hash))
            parts.append([_signed(h) for h in sorted(subtree_hashes(root))])
        arrays = [batch.column(0), pa.array(whole, pa.int64()), pa.array(parts, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=["host", "whole", "subtrees"])

    different = (
        pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
        .where(F.col("host").isNotNull())
        .mapInArrow(per_batch(hashed, 200), "host string, whole bigint, subtrees array<bigint>")
        .groupBy("host", "whole")
        .agg(F.first("subtrees").alias("subtrees"))
    )
    # One aggregate gives both counts: the page itself is the NULL subtree.
    counts = (
        different.select("host", F.explode(F.concat("subtrees", F.array(F.lit(None).cast("bigint")))).alias("subtree"))
        .groupBy("host", "subtree")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    frequent = F.col("n") >= min_share * F.col("pages")
    totals = counts.where("subtree is null").select("host", F.col("n").alias("pages"))
    return (
        counts.where("subtree is not null")
        .join(totals, "host")
        .where(F.col("n") >= min(COMMON_SHARE, min_share) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list(F.when(frequent, F.col("subtree"))).alias("subtrees"), F.collect_list(F.when(~frequent, F.col("subtree"))).alias("common"))
    )


def host_of(url):
    host = F.lower(F.regexp_extract(url.cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def extract_pages(
    pages: DataFrame,
    keep: tuple[str, ...] = ("page_id", "url"),
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 5,
    min_share: float = 0.5,
) -> DataFrame:
    """The ``keep`` columns of every page with its main ``text``."""
    templates = host_templates(pages, url_col, html_col, min_pages, min_share)
    if fits_broadcast(templates):
        templates = F.broadcast(templates)
    kept = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"), *kept)
    joined = rows.join(templates, "host", "left").select("html", "subtrees", "common", *[f"k{i}" for i in range(len(keep))])

    def texts(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for html, subtrees, others in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            template, common = (frozenset(h % (1 << 64) for h in hashes or ()) for hashes in (subtrees, others))
            out.append(main_text(parse(html or ""), template, common).encode("utf-8", "replace").decode())
        return pa.RecordBatch.from_arrays([*batch.columns[3:], pa.array(out, pa.string())], names=[*names, "text"])

    names = [f"k{i}" for i in range(len(keep))]
    types = ", ".join(f"{n} {joined.schema[n].dataType.simpleString()}" for n in names)
    made = joined.mapInArrow(per_batch(texts, 200), f"{types}, text string")
    return made.select(*[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], "text")


@query("op7_html_text")
def op7_html_text(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))
