"""Main text of web pages by site style trees.

The DOMs of a host's pages merge into one style tree of all elements that can hold text: its nodes are element paths (tag, id and
classes from the root), each with its presentations (sequences of child tags) and contents (texts of its blocks), and how many
pages have them. The content importance of a node is one less the mean entropy of its texts over the pages that hold it
(log c / log m for a text on c of m pages), its presentation importance the entropy of its presentations; few pages are weak
evidence, and lower an importance by less. From the deepest level up, a node combines its own presentations and texts with the
importance of the nodes below it. Branches of low importance are what a site repeats, and are removed from every page.

What differs on every page is no less a menu or an advert: elements whose names, classes or roles say so (Signs) are never main
text either, and an article or main element holds it where there is one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged, arrow_map, columns, cut

#: The importance below which a branch goes; the weight that a node's own presentations lose for each presentation it has; pages of
#: a node that would halve what its entropies take from its importance; and the depth from which elements count as their ancestor.
LOW, DECAY, DOUBT, DEEPEST = 0.25, 0.9, 2.0, 64

# Element names and words of HTML pages.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_NO_TEXT = frozenset("head script style noscript template iframe svg math canvas object select option textarea title audio video map noembed noframes xmp".split())
_NEVER = frozenset("button form fieldset nav footer aside menu dialog".split())
_MAIN = frozenset(["article", "main"])
_HOLDS_P = ("button", "td", "th", "table", "article", "body", "div", "section")
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": ("tr",), "tbody": ("thead", "tbody", "tr"), "tfoot": ("tbody", "tr")}
_HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form tablist".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr|notice|notices|notification|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|sidebar|widget|widgets|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|crumbs|footer|masthead|topbar|toolbar|comment|comments|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|recommendations|search|pagination|pager|copyright|disclaimer|skip|alert)(?:$|[\s_-])",
    re.I,
)
_MAIN_NAMES = re.compile(r"(?:^|\s)(?:article|article-body|articlebody|article-content|post|post-body|post-content|entry|entry-content|story|story-body|main-content|maincontent)(?:$|\s)", re.I)

_TAG = re.compile(r"/?[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)



class Block(NamedTuple):
    """Text of a block; the path of the element that holds it, and of that one's parent; whether it lies in a main element, in one
    that is never main text, or in a branch of low importance."""

    text: str
    path: int
    parent: int
    main: bool
    never: bool
    low: bool


class _Open(NamedTuple):
    tag: str
    path: int
    depth: int
    main: bool
    never: bool
    low: bool
    silent: bool  # holds no text


def _signs(tag: str, raw: str, main: bool) -> tuple[str, bool, bool]:
    """(the element's step in a path, whether its branch is never main text, whether it is a main element)."""
    never = tag in _NEVER or tag == "header" and not main
    if not raw.strip("/ \n\t\r"):
        return tag, never, tag in _MAIN
    at = {m[0].lower(): html.unescape(m[1] or m[2] or m[3]) for m in _ATTRIBUTE.findall(raw)}
    names = " ".join(x for x in (at.get("class", ""), at.get("id", "")) if x)
    step = tag + "".join("." + c for c in sorted(_DIGITS.sub("0", names).lower().split()))
    role = at.get("role", "").lower()
    if tag not in ("html", "body"):
        never = never or role in _ROLES or "hidden" in at or at.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(at.get("style", ""))) or bool(_NAMES.search(names))
    return step, never, (tag in _MAIN or role == "main" or bool(_MAIN_NAMES.search(names))) and not never


def tokens(page: str) -> Iterator[tuple[str, str, str, int]]:
    """(kind, name or text, attributes, end) of a page's texts ("t"), start tags ("s") and end tags ("e"), in linear time.

    The consumer may send a place from which to go on. Comments and declarations are left out. A tag ends at the first > outside
    quotes; a quote without a partner is a character like others, and a tag that never ends takes the rest of the page, as in browsers.
    """
    at, size, lone = 0, len(page), {}
    while at < size:
        start = page.find("<", at)
        if start < 0:
            yield "t", page[at:], "", size
            return
        if start > at:
            yield "t", page[at:start], "", start
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = size if end < 0 else end + 1
            continue
        m = _TAG.match(page, start + 1)
        if m is None:
            yield "t", "<", "", start + 1
            at = start + 1
            continue
        at = m.end()
        while at < size:
            at = _PLAIN.match(page, at).end()
            if at == size or page[at] == ">":
                break
            quote = page[at]
            end = -1 if quote in lone else page.find(quote, at + 1)
            if end < 0:
                lone[quote] = True  # there is no further one on the page
            at = at + 1 if end < 0 else end + 1
        if at >= size:
            return  # cut short by the page's end
        name = m[0].lower()
        raw, at = page[m.end() : at], at + 1
        went = yield ("e", name[1:], raw, at) if name[0] == "/" else ("s", name, raw, at)
        if went is not None:
            at = went
            yield "", "", "", at


def _end_of(page: str, tag: str, at: int) -> int:
    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
    return end.end() if end else len(page)


def parse(page: str, low: frozenset | set = frozenset()) -> tuple[list[Block], dict[int, tuple[int, int, tuple[str, ...]]]]:
    """Blocks in page order, and for each element path its parent's, its depth and the steps of its children in their order."""
    blocks: list[Block] = []
    shape: dict[int, tuple[int, int, dict[str, None]]] = {}
    root = _Open("", 0, 0, False, False, False, False)
    stack: list[_Open] = []
    there: dict[str, int] = {}  # open elements by tag
    text: list[str] = []

    def flush() -> None:
        if text:
            got = " ".join(html.unescape("".join(text)).split())
            text.clear()
            top = stack[-1] if stack else root
            if got and not top.silent:
                blocks.append(Block(got, top.path, shape[top.path][0] if top.path in shape else 0, top.main, top.never, top.low))

    def close(k: int) -> None:
        flush()
        for x in stack[k:]:
            there[x.tag] -= 1
        del stack[k:]

    def close_last(tag: str, until: tuple[str, ...]) -> None:
        if there.get(tag):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    close(k)
                    return
                if stack[k].tag in until:
                    return

    scan = tokens(page)
    for kind, tag, raw, at in scan:
        if kind == "t":
            text.append(tag)
        elif kind == "e":
            if there.get(tag):
                close_last(tag, ())
            elif tag not in _INLINE:
                flush()
        elif kind == "s" and tag in _INLINE:
            if tag == "br":
                text.append(" ")
            elif tag not in _VOID and ("hidden" in raw or "class" in raw or "none" in raw) and not (stack and stack[-1].never):
                if _signs(tag, raw, bool(stack) and stack[-1].main)[1]:  # an inline branch that is no text of its block
                    scan.send(_end_of(page, tag, at))
        elif kind == "s":
            if tag in _CLOSES_P:
                close_last("p", _HOLDS_P)
            for other in _LIKE.get(tag, ()):
                close_last(other, _HOLDS.get(tag, ()))
            flush()
            up = stack[-1] if stack else root
            step, never, main = _signs(tag, raw, up.main)
            path, depth = (_hash(f"{up.path}/{step}"), up.depth + 1) if up.depth < DEEPEST else (up.path, up.depth)
            silent = up.silent or tag in _NO_TEXT
            if not silent and path != up.path:
                shape.setdefault(path, (up.path, depth, {}))
                if up.path in shape:
                    shape[up.path][2].setdefault(step)  # repeats of a step are one presentation: lists differ in number only
            if tag in _RAW:
                scan.send(_end_of(page, tag, at))
            elif tag not in _VOID and not raw.endswith("/"):
                stack.append(_Open(tag, path, depth, (up.main or main) and not never, up.never or never, up.low or path in low, silent))
                there[tag] = there.get(tag, 0) + 1
    flush()
    return blocks, {k: (parent, depth, tuple(steps)) for k, (parent, depth, steps) in shape.items()}


def main_text(page: str | None, low: frozenset | set = frozenset()) -> str:
    """Text of the blocks that stay: not of low importance unless nothing else is left, in no element that is never main text, and
    in main elements if any has text."""
    blocks = [b for b in parse(page or "", low)[0] if not b.never]
    inside = [b for b in blocks if b.main] or blocks
    return "\n".join(b.text for b in [b for b in inside if not b.low] or inside)


def _hash(text: str) -> int:
    import xxhash

    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def _host() -> "F.Column":
    return F.lower(F.coalesce(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


NODE = "host string, path long, parent long, depth int, kind int, feature long"


def style_nodes(pages: DataFrame) -> DataFrame:
    """(host, path, parent, depth, kind, feature, pages): how many pages have a node in a presentation (kind 0) or with a text (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in cut(whole, "html"):
                rows: list[tuple] = []
                for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                    blocks, shape = parse(page or "")
                    out = {(host, path, parent, depth, 0, _hash(" ".join(steps))) for path, (parent, depth, steps) in shape.items()}
                    rows += out | {(host, x.path, x.parent, shape[x.path][1], 1, _hash(x.text)) for x in blocks if x.path in shape}
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()))], names=["host", "path", "parent", "depth", "kind", "feature"])

    found = arrow_map(columns(pages, "url", "html").select(_host().alias("host"), "html"), run, NODE)
    return found.groupBy("host", "path", "parent", "depth", "kind", "feature").agg(F.count("*").alias("pages"))


def importances(pages: DataFrame) -> DataFrame:
    """(host, path, m, importance) of every node of every host's style tree, a level after the other from the deepest up."""
    log, c = F.log(F.col("pages").cast("double")), F.col("pages").cast("double")
    looks_of, says_of = F.col("kind") == 0, F.col("kind") == 1
    own = style_nodes(pages).groupBy("host", "path", "parent", "depth").agg(
        F.sum(F.when(looks_of, F.col("pages")).otherwise(0)).alias("m"),
        F.sum(F.when(looks_of, c * log).otherwise(0.0)).alias("c_log_c"),
        F.count_if(looks_of).alias("styles"),
        F.sum(F.when(says_of, log).otherwise(0.0)).alias("text_log"),
        F.count_if(says_of).alias("texts"),
    )
    log_m, doubt = F.log(F.col("m").cast("double")), (F.col("m") - 1) / (F.col("m") + DOUBT)
    # one less the entropy's lack of presentations in base m, and one less the mean entropy of the texts
    looks = F.when(F.col("m") > 1, 1 - doubt * F.col("c_log_c") / (F.col("m") * log_m)).otherwise(1.0)
    says = F.when(F.col("m") > 1, 1 - doubt * F.least(F.lit(1.0), F.col("text_log") / (F.col("texts") * log_m))).otherwise(1.0)
    tree = Staged(own.select("host", "path", "parent", "depth", "m", "styles", looks.alias("looks"), F.when(F.col("texts") > 0, says).alias("says"), "texts"), "style-tree").df
    fade = F.pow(F.lit(DECAY), F.col("styles"))
    under, weight = F.col("under_sum") / F.col("under_weight"), F.coalesce("under_weight", F.lit(0)) + F.col("texts")
    inner = (1 - fade) * F.col("looks") + fade * under
    # of its own texts and of what is below, by how many texts each has
    both = (F.col("says") * F.col("texts") + inner * F.col("under_weight")) / weight
    value = F.when(F.col("says").isNotNull() & (F.col("under_weight") > 0), both).when(F.col("says").isNotNull(), F.col("says")).when(F.col("under_weight") > 0, inner).otherwise(F.col("looks"))
    done, below = None, None
    for depth in range(tree.agg(F.max("depth")).first()[0] or 0, 0, -1):
        level = tree.where(F.col("depth") == depth)
        level = level.withColumns({"under_sum": F.lit(None).cast("double"), "under_weight": F.lit(None).cast("long")}) if below is None else level.join(below, ["host", "path"], "left")
        level = Staged(level.select("host", "path", "parent", "m", value.alias("importance"), weight.alias("weight")), "style-level").df
        below = level.groupBy("host", F.col("parent").alias("path")).agg(F.sum(F.col("importance") * F.col("weight")).alias("under_sum"), F.sum("weight").alias("under_weight"))
        part = level.select("host", "path", "m", "importance")
        done = part if done is None else done.unionByName(part)
    return tree.select("host", "path", "m", F.col("looks").alias("importance")).limit(0) if done is None else done


def low_branches(pages: DataFrame, low: float = LOW) -> DataFrame:
    """(host, low): hashes of the element paths of each host whose branches are of low importance."""
    return importances(pages).where(F.col("importance") < low).groupBy("host").agg(F.collect_set("path").alias("low"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page, blocks joined by a line feed.

    Null html is empty and gives an empty text; a null url belongs to a host without name; repeated rows are pages of their own; a
    page of any length and with any markup is taken whole, in time linear in it; extra columns are ignored; an empty table gives
    no row.
    """
    rows = columns(pages, "page_id", "url", "html").withColumn("host", _host())
    joined = rows.join(low_branches(pages), "host", "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in cut(whole, "html"):
                got = [main_text(page, frozenset(low or ())) for page, low in zip(b.column("html").to_pylist(), b.column("low").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(got, pa.string())], names=["page_id", "url", "text"])

    return arrow_map(joined, run, "page_id long, url string, text string")
