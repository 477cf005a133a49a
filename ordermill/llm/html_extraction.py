"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is an element's place, the tags and classes from the root down to
it. Two entropies tell how much a node matters, both relative to the number of distinct pages that have it. Its
presentation entropy is that of the number of text blocks in it, which varies from page to page where content is, and not
in menus. Its content importance is one minus the mean entropy of its blocks over the pages: a block that stands on
every page has entropy one, a block of one page has none. At a place of low importance, the blocks
that are of low importance themselves, by their own entropy, are removed from each page, whatever they are called; a
page's own blocks stay. Both are judged at any number of pages and any share of a host, so each template of a host is
judged by its own pages; what few pages tell is drawn towards content, as if ``PRIOR`` more pages had the node as content. Pages are told apart by the sequence of the blocks that they would give, dates and times left
out, so copies that differ in scripts, tokens, adverts or dates count once, and a host full of copies keeps its text.

Some presentation nodes need no statistics, as their tags say that they are menus, headers, footers, sidebars, forms,
scripts or styles; they are removed first. A class, id or role that says the same, or adverts, notices or comments, is a
prompt only: it counts if the whole name says so and the element does not bear most of the page's text. If ``article`` or
``main`` elements are left with text, they are the content; articles within comments are comments.

The style tree is built by grouping (host, place, block) rows, so neither a host with a third of all pages nor a block
that all pages share meets in one task. The lists of low places and of removed blocks are broadcast while they have at
most ``BROADCAST_ROWS`` entries, which are counted first; beyond that Spark joins by shuffles, and a page gets only the
removed blocks that it has.

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in page
order by one space. NULL and empty pages give an empty text; a NULL url has no host and no style tree; repeated rows
and ids are kept; broken markup is read as far as it goes. All columns but the html are carried; an input column named
like a result column is replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.llm.chunks import extended
from ordermill.session import keep

RESULT = ["text", "n_chars"]
LOW = 0.2
PRIOR = 1.0  # imagined pages where a node is content: the fewer pages have it, the more they weigh
CONTENT_WEIGHT = 0.9
BROADCAST_ROWS = 200_000

# Elements that are never main text, with what is in them.
SKIPPED = {
    "script", "style", "noscript", "template", "head", "title", "nav", "aside", "footer", "form", "iframe", "svg", "math",
    "button", "select", "textarea", "object", "canvas", "audio", "video", "dialog", "menu", "header",
}
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "xmp")
FOREIGN = ("svg", "math")  # these have no text if their tag closes itself
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
CONTENT = {"article", "main"}
# Words of class and id names, and roles, that mark what is not main text.
NOISE = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner", "sidebar", "menu",
    "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "popup", "modal", "newsletter", "subscribe", "social", "share", "sharing", "related", "footer", "masthead",
    "comment", "comments", "disqus", "widget", "toolbar", "pagination", "pager", "login", "signup", "search", "copyright",
    "contentinfo", "complementary",
}
# Words that may stand beside those in a name without changing what it means. Any other word does: a
# "related-work" or "has-sidebar" is no related links and no sidebar.
NEUTRAL = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "column", "container", "content", "feed", "form", "global",
    "group", "header", "heading", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "outer", "panel", "post",
    "posts", "primary", "reader", "right", "row", "secondary", "section", "site", "slot", "text", "thread", "title", "top", "unit",
    "user", "wrap", "wrapper",
}
# Words of names of what readers wrote.
COMMENTS = {"comment", "comments", "disqus"}
# an opening tag ends open elements of the same kind, up to the nearest element that holds them
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"},
    "th": {"td", "th", "p"}, "option": {"option"},
}
HOLDS = {"ul", "ol", "dl", "table", "select", "article", "main", "body", "div", "section", "nav", "aside", "footer", "header", "blockquote"}

# the rest of a tag: a quote holds a value only behind an equals sign
_REST = r"(?:=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[^>])*+"
# a drawing or formula that was left open ends where a block of text begins or ends
_BLOCKS = "address|article|aside|blockquote|body|div|dl|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|ul"
_DRAWN = rf"(?:<foreignObject(?=[\s/>]).*?</foreignObject\s*+>|(?!</(?:svg|math)(?=[\s/>])|</?(?:{_BLOCKS})(?=[\s/>])).)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<alone>" + "|".join(FOREIGN) + r")(?=[\s/>])" + _REST + r"(?<=/)>"
    r"|<(?:" + "|".join(FOREIGN) + r")(?=[\s/>])" + _REST + ">" + _DRAWN + r"(?:</(?:" + "|".join(FOREIGN) + r")(?=[\s/>])[^>]*+>)?+"
    r"|<(?P<raw>" + "|".join(r for r in RAW if r not in FOREIGN) + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>" + _REST + r")>|<[!?/][^>]*+>",
    re.S | re.I,
)
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# dates and times of day do not tell copies of a page apart
_DATE = re.compile(
    r"\b(?:\d{4}([-./])\d{1,2}\1\d{1,2}|\d{1,2}([-./])\d{1,2}\2\d{2,4}|\d{1,2}\.? [^\W\d]{3,10}\.?,? \d{4}|[^\W\d]{3,10}\.? \d{1,2}, \d{4})\b"
    r"|(?:\bT)?\b\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z\b|[+-]\d{2}:?\d{2}\b)?"
)
_DIGIT = re.compile(r"\d")
_HOST = re.compile(r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


class _Places:
    """Numbers of places in a tree, remembered by their parent and the text of the tag."""

    def __init__(self):
        self.known: dict[tuple[int, str, str], tuple[int, str]] = {}

    def of(self, parent: int, tag: str, attributes: str) -> tuple[int, str]:
        """(place, what its names say: "noise", "comments" or nothing)"""
        key = (parent, tag, attributes)
        found = self.known.get(key)
        if found is None:
            names = sorted({w for m in _NAMES.finditer(attributes) for x in m.groups() if x for w in x.split()})
            words = [{w.lower() for w in _WORD.findall(name)} for name in names]
            named = set().union(*(w & NOISE for w in words if w <= NOISE | NEUTRAL)) if tag not in ("html", "body") else set()
            noise = "comments" if named & COMMENTS else "noise" if named else ""
            place = xxhash.xxh64_intdigest(f"{parent}/{tag}.{'.'.join(names)}") >> 1
            if len(self.known) > 200_000:
                self.known.clear()
            found = self.known[key] = (place, noise)
        return found


def blocks(page: str, places: _Places) -> list[tuple[int, bool, str]]:
    """(place, inside article or main, text) of the blocks of a page that are not known to be noise, in order.

    What a name says is only taken for true of elements that do not bear most of the page's text.
    """
    out: list[tuple[int, bool, str, tuple[int, ...]]] = []
    # tag, place, skipped, content, elements around it that are noise by name, of those: left by an article
    stack: list[tuple[str, int, bool, bool, tuple[int, ...], bool]] = [("", 0, False, False, (), True)]
    held: list[str] = []
    named = 0

    def flush() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                # text belongs to the nearest element that is a block
                at = next(x for x in reversed(stack) if x[0] not in INLINE)
                out.append((at[1], at[3], text, at[4]))
            held.clear()

    end = 0
    for token in _TOKEN.finditer(page):
        if token.start() > end and not stack[-1][2]:
            held.append(page[end : token.start()])
        end = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            flush()
        if token["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in HOLDS and tag in INLINE:
                    break
            continue
        if tag in VOID:
            continue
        if tag in CLOSES:
            ends = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in HOLDS:
                    break
                if stack[k][0] in ends:
                    del stack[k:]
                    break
        _, place, skipped, content, noisy, leaves = stack[-1]
        attributes = token["attributes"]
        own, says = places.of(place, tag, attributes if attributes.strip("/ \n\t") else "")
        if tag in CONTENT and not says and leaves and (skipped or noisy):
            # an article is no part of a menu or advert that was left open; those of comments and in articles are
            del stack[next(k for k, x in enumerate(stack) if x[2] or x[4]) :]
            _, place, skipped, content, noisy, leaves = stack[-1]
            own, says = places.of(place, tag, attributes if attributes.strip("/ \n\t") else "")
        if says and (tag not in CONTENT or content or says == "comments"):
            named += 1
            noisy = (*noisy, named)
        skipped = skipped or (tag in SKIPPED and not (tag == "header" and content))
        content = content or tag in CONTENT
        stack.append((tag, own, skipped, content, noisy, leaves and not content and says != "comments"))
    if end < len(page) and not stack[-1][2]:
        held.append(page[end:])
    flush()
    return _without_noise(out)


def _without_noise(found: list[tuple[int, bool, str, tuple[int, ...]]]) -> list[tuple[int, bool, str]]:
    """Blocks that are in no element that is noise by its name and bears no more than half of the page's text."""
    if not any(noisy for *_, noisy in found):
        return [x[:3] for x in found]
    inside: Counter[int] = Counter()
    for *_, text, noisy in found:
        for element in noisy:
            inside[element] += len(text)
    half = sum(len(text) for _, _, text, _ in found) / 2
    return [x[:3] for x in found if not any(inside[element] <= half for element in x[3])]


def _chosen(found: list[tuple[int, bool, str]]) -> list[tuple[int, bool, str]]:
    return [x for x in found if x[1]] or found


def main_text(found: list[tuple[int, bool, str]], low: set[int]) -> str:
    """The text of a page's blocks without the unimportant ones."""
    chosen = _chosen(found)
    left = [text for place, _, text in chosen if not low or _block(place, text) not in low]
    return " ".join(left or [text for _, _, text in chosen])


def _undated(text: str) -> str:
    return " ".join(_DATE.sub("", text).split()) if _DIGIT.search(text) else text


def _page(found: list[tuple[int, bool, str]]) -> int:
    """What tells a page from others: the sequence of its blocks without dates."""
    return _signed(xxhash.xxh64_intdigest("\n".join(_undated(text) for _, _, text in _chosen(found))))


def _block(place: int, text: str) -> int:
    """Number of a text at a place."""
    return _signed(xxhash.xxh64_intdigest(text, place))


def _host(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def style_nodes(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Rows (host, page, place, block, times): how often a block stands at a place of a page; copies share ``page``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places()
        for piece in _pieces(batches):
            columns: list[list] = [[], [], [], [], []]
            for address, page in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                host = _host(address)
                if not host or not page:
                    continue
                found = blocks(page, places)
                number = _page(found)
                counted = Counter((place, _block(place, text)) for place, _, text in found)
                for (place, block), times in counted.items():
                    for column, value in zip(columns, (host, number, place, block, times)):
                        column.append(value)
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "page", "place", "block", "times"]
            )

    return pages.select(url, html).mapInArrow(run, "host string, page long, place long, block long, times long")


def _once(nodes: DataFrame) -> DataFrame:
    return keep(nodes.groupBy("host", "page", "place", "block").agg(F.max("times").alias("times")), "style-nodes")


def importance(nodes: DataFrame) -> DataFrame:
    """(host, place, pages, host_pages, layout, importance) of each node; ``layout`` is the part of the presentation."""
    once = _once(nodes)
    hosts = once.groupBy("host", "page").agg(F.lit(1)).groupBy("host").agg(F.count("*").alias("host_pages"))
    return _rated(once).join(hosts, "host").select("host", "place", "pages", "host_pages", "layout", "importance")


def _content(spread: Column) -> Column:
    return CONTENT_WEIGHT * (1 - spread / F.when(F.col("pages") > 1, F.ln("pages")))


def _rated(once: DataFrame) -> DataFrame:
    shared = once.groupBy("host", "place", "block").agg(F.count("*").alias("n"))
    content = shared.groupBy("host", "place").agg(
        (F.sum(F.col("n") * F.ln("n")) / F.sum("n")).alias("spread")
    )
    shapes = once.groupBy("host", "page", "place").agg(F.sum("times").alias("blocks"))
    shapes = shapes.groupBy("host", "place", "blocks").agg(F.count("*").alias("n"))
    shape = shapes.groupBy("host", "place").agg(
        F.sum("n").alias("pages"), (F.ln(F.sum("n")) - F.sum(F.col("n") * F.ln("n")) / F.sum("n")).alias("variety")
    )
    layout = (1 - CONTENT_WEIGHT) * F.col("variety") / F.when(F.col("pages") > 1, F.ln("pages"))
    value = F.coalesce(layout + _content(F.col("spread")), F.lit(1.0))
    return shape.join(content, ["host", "place"]).select("host", "place", "pages", layout.alias("layout"), value.alias("importance"))


def _careful(value: Column) -> Column:
    """An importance together with that of the imagined pages."""
    return (F.col("pages") * value + PRIOR) / (F.col("pages") + PRIOR)


def unimportant(once: DataFrame) -> DataFrame:
    """(host, block): the blocks that are removed from the pages of a host."""
    chosen = keep(_rated(once).where(_careful(F.col("importance")) < LOW).select("host", "place", "pages", "layout"), "style-places")
    there = once.join(F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen, ["host", "place"])
    shared = there.groupBy("host", "place", "block", "pages", "layout").agg(F.count("*").alias("n"))
    low = shared.where(_careful(F.col("layout") + _content(F.ln("n"))) < LOW)
    return keep(low.select("host", "block").distinct(), "style-low")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            yield batch.slice(first, 500)


def _with_low(pages: DataFrame, url: str, html: str, once: DataFrame, low: DataFrame) -> DataFrame:
    """``pages`` with ``__low``, the removed blocks that a page has: joined by what the page holds, so no list grows with a host."""
    address, body = pages.columns.index(url), pages.columns.index(html)
    schema = StructType.fromDDL("__host string, __page long")
    schema = StructType([*pages.schema.fields, *schema.fields])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places()
        for piece in _pieces(batches):
            hosts = [_host(x) for x in piece.column(address).to_pylist()]
            numbers = [_page(blocks(x or "", places)) for x in piece.column(body).to_pylist()]
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(hosts, pa.string()), pa.array(numbers, pa.int64())], schema.names)

    held = once.join(low, ["host", "block"], "left_semi").groupBy("host", "page").agg(F.collect_set("block").alias("__low"))
    held = held.withColumnsRenamed({"host": "__host", "page": "__page"})
    return pages.mapInArrow(number, schema).join(held, ["__host", "__page"], "left").drop("__host", "__page")


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``."""
    pages = pages.drop(*[c for c in RESULT if c not in (url, html)])
    once = _once(style_nodes(pages, url, html))
    low = unimportant(once)
    removed = low.count()
    carried = [c for c in pages.columns if c != html]
    asked = pages.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{html}`").alias("__html"))
    schema = extended(StructType([f for f in pages.schema.fields if f.name != html]), "text string, n_chars long")
    n, address = len(carried), carried.index(url)
    joined = removed > max(BROADCAST_ROWS, 0)
    by_host: dict[str, set[int]] = {}
    if joined:
        asked = _with_low(asked, url, "__html", once, low)
    else:
        for row in low.collect():
            by_host.setdefault(row["host"], set()).add(row["block"])
    shared = pages.sparkSession.sparkContext.broadcast(by_host)  # bounded by BROADCAST_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places()
        for piece in _pieces(batches):
            if joined:
                given = [set(x or ()) for x in piece.column(n + 1).to_pylist()]
            else:
                given = [shared.value.get(_host(x), set()) for x in piece.column(address).to_pylist()]
            texts = [main_text(blocks(page or "", places), low) for page, low in zip(piece.column(n).to_pylist(), given)]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:n], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names
            )

    return asked.mapInArrow(run, schema)
