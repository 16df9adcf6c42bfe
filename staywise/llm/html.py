"""Main text of web pages by site style trees.

The pages of a host are merged into one tree of styles: a node is a path of block elements with
their classes. For each node, the texts that the host's distinct pages have there are
counted (content) and the sequences of styles below it (presentation). A node that says and
shows the same on most pages has a low entropy, so a low importance: it is cut from each
page, the rest is the main text. Pages with one and the same article count once, so an article
that a host repeats is no menu.

What an element is for comes before that. Menus, asides, scripts and the like, known by element
or role, are no content at all. Names in class or id (``NAMES``) and forms only mark a
branch: it is left out, unless it holds the page's article or the page has no other text. In the
second case the tree decides, with a start against the branch. If a page marks its
article, only what is inside it counts.

A host may hold any share of the pages: only counts per host, node and text are shuffled,
and the list of cut nodes is joined back to the pages.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Elements whose content is no running text.
RAW = frozenset({"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"})
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"})
#: Presentation nodes by element name.
MINOR = frozenset({"head", "nav", "footer", "aside", "button", "select", "menu", "dialog", "svg", "canvas", "object", "audio", "video", "map", "fieldset", "label", "option", "datalist", "search"} | RAW)
#: Presentation nodes by role, and by words in class or id.
ROLES = frozenset({"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"})
NAMES = frozenset(
    """ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist
    cookie cookies consent gdpr disqus footer foot header masthead menu menubar nav navbar navigation newsletter notice notices
    pagination pager popup modal promo promotion promoted related recommended replies reply respond share sharing sidebar aside
    social sponsor sponsored subscribe subscription tags toolbar topbar widget widgets overlay skip login signup""".split()
)
#: Elements that begin and end a block.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup html hr legend li main menu nav ol p pre search section summary table tbody td tfoot th
    thead tr ul""".split()
)
#: Start tags that end an open element of one of these names, looked for up to the given limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}), "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}), "option": ({"option"}, {"select", "datalist"}),
}
#: Words that turn a name into its absence or a state of the page: "no-sidebar", "ad-free".
STATES = frozenset("no non not has with without free open opened closed enabled disabled on off".split())
#: Elements of running text. Headings are never marked by names, the others by whole class names only.
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6"})
TEXTUAL = frozenset("p a abbr b blockquote cite code dd dt em figcaption figure i li mark pre q small span strong sub sup td th tr u".split())
#: Levels of an element: content, marked by a name, no content at all.
CONTENT, MARKED, NEVER = 0, 1, 2
#: A node is cut if its importance (0 to 1) is below this.
LEAST_IMPORTANCE = 0.3
#: Pages' worth of evidence that a node starts with, and the importance this stands for.
START_PAGES, START, START_MARKED = 4, 0.5, 0.0
#: A node with l sequences of child styles takes 1 - DAMPING ** l of their entropy.
DAMPING = 0.9

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')|=)*+)>?", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[a-z]+")


def _has_name(name: str, key: str, value: str) -> bool:
    if name in HEADINGS or (name in TEXTUAL and key == "id"):
        return False
    for token in value.split():
        parts = set(_PARTS.findall(token))
        if parts <= NAMES if name in TEXTUAL else not parts.isdisjoint(NAMES) and parts.isdisjoint(STATES):
            if parts:
                return True
    return False


def _level(name: str, attributes: str, in_article: bool, again: bool) -> tuple[int, str]:
    """What an element is for, and its style: name and classes.

    ``again``: the page has had an article, so that another one may be a comment or a teaser.
    """
    style = name
    level = NEVER if name in MINOR or (name == "header" and not in_article) else MARKED if name == "form" else CONTENT
    if attributes.strip(" /\n\t\r"):
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), unescape(value.strip("\"'")).lower()
            if key == "class":
                style += "." + ".".join(sorted(value.split()))
            if key in ("class", "id"):
                if name not in ("html", "body", "main") and (again or name != "article") and _has_name(name, key, value):
                    level = max(level, MARKED)
            elif key == "role" and value in ROLES:
                level = NEVER
    return level, style


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def blocks(html: str | None) -> tuple[list[tuple[int, int, bool, str]], dict[int, int]]:
    """Text blocks of a page in order: (node, level, in article, text); sequences of child styles by node.

    Tags need not be balanced: a block's start tag ends an open paragraph, an end tag ends
    what is open inside its element, one without a start is passed over. A node is a hash of
    its parent's and its style, so an open element takes the same memory at any depth.
    """
    out: list[tuple[int, int, bool, str]] = []
    shapes: dict[int, int] = {}
    if not html:
        return out, shapes
    # Open elements: name, node, level, inside an article, place of the innermost block element.
    stack: list[tuple[str, int, int, bool, int]] = [("", 0, CONTENT, False, 0)]
    open_names: Counter[str] = Counter()
    parts: list[str] = []
    home = stack[0]
    articles = 0

    def end_block() -> None:
        if parts:
            text = _SPACE.sub(" ", unescape("".join(parts))).strip()
            parts.clear()
            if text:
                out.append((home[1], home[2], home[3], text))

    def say(text: str) -> None:
        nonlocal home
        top = stack[-1]
        block = stack[top[4]]
        if top[2] == NEVER or top[2] != block[2]:  # the second: marked inside running text
            return
        if not parts:
            home = block
        parts.append(text)

    def close(depth: int) -> None:
        open_names.subtract(e[0] for e in stack[depth:])
        del stack[depth:]

    at, size = 0, len(html)
    while at < size:
        tag = _TOKEN.search(html, at)
        if tag is None:
            say(html[at:])
            break
        if tag.start() > at:
            say(html[at : tag.start()])
        at = max(tag.end(), at + 1)
        name = (tag.group(2) or "").lower()
        if not name:
            continue
        if tag.group(1):
            if open_names[name] > 0:
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                if stack[-1][4] >= depth:
                    end_block()
                close(depth)
            continue
        if name == "br":
            say(" ")
            continue
        if name in BLOCKS:
            end_block()
            depth = stack[-1][4]
            if stack[depth][0] == "p":
                close(depth)
        if name in CLOSES:
            ended, limits = CLOSES[name]
            if any(open_names[e] > 0 for e in ended):
                depth = len(stack) - 1
                while depth and stack[depth][0] not in limits:
                    if stack[depth][0] in ended:
                        close(depth)
                    depth -= 1
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if tag.group(3).endswith("/") and name not in BLOCKS and name not in ("a", "b", "i", "span"):
            continue
        if name in ("article", "main") and not articles and stack[-1][2] == MARKED:
            # A branch that holds the article is no presentation, whatever its name.
            stack[:] = [(e[0], e[1], CONTENT if e[2] == MARKED else e[2], e[3], e[4]) for e in stack]
        _, node, level, article, block = stack[-1]
        own, style = _level(name, tag.group(3), article, articles > 0)
        articles += name == "article"
        level = max(level, own)
        if name in BLOCKS:
            child = f"{style}#" if own == MARKED else style
            if level != NEVER:
                shapes[node] = zlib.crc32(child.encode("utf-8", "surrogatepass"), shapes.get(node, 1))
            node, block = _hash(f"{node}/{child}"), len(stack)
        stack.append((name, node, level, article or name in ("article", "main"), block))
        open_names[name] += 1
    end_block()
    return out, shapes


def host_of(url) -> F.Column:
    """Lower-cased host of an address; empty for null or none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def page_nodes(html: str | None) -> tuple[str, dict[int, tuple[bool, str, int | None]]]:
    """What tells a page of a host from others, and its nodes: (marked, text, shape or None).

    Pages are told apart by what their articles say, without an article by all they say.
    """
    found, shapes = blocks(html)
    said: dict[int, list[str]] = {}
    marked: dict[int, bool] = {}
    for node, level, _, text in found:
        said.setdefault(node, []).append(text)
        marked[node] = level == MARKED
    inside = [text for _, level, article, text in found if article and level == CONTENT]
    story = "\n".join(inside or [text for *_, text in found])
    return story, {node: (marked[node], "\n".join(texts), shapes.get(node)) for node, texts in said.items()}


def style_counts(pages: DataFrame) -> DataFrame:
    """``host``, ``node``, ``marked``, ``shape`` (or text), ``value`` (its hash), ``pages`` (distinct ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("host", pa.int64()), ("story", pa.int64()), ("node", pa.int64()), ("marked", pa.bool_()), ("shape", pa.bool_()), ("value", pa.int64())]
        for batch in batches:
            rows: list[tuple[int, int, int, bool, bool, int]] = []
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text, nodes = page_nodes(html)
                story = _hash(text)
                for node, (marked, said, shape) in nodes.items():
                    rows.append((host, story, node, marked, False, _hash(said)))
                    if shape is not None:
                        rows.append((host, story, node, marked, True, shape))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], [n for n, _ in kinds])

    kept = pages.select(F.xxhash64(host_of(F.col("url"))).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    seen = kept.mapInArrow(run, "host long, story long, node long, marked boolean, shape boolean, value long").distinct()
    return seen.groupBy("host", "node", "marked", "shape", "value").agg(F.count("*").alias("pages"))


def node_importance(counts: DataFrame) -> DataFrame:
    """``host``, ``node``, ``n`` (distinct pages) and ``importance`` (0 to 1).

    The entropy of a node's texts, or that of the sequences of styles below it if larger, each
    divided by the largest value it can have, moved towards a start value by ``START_PAGES``.
    """
    n = F.sum("pages")
    entropy = F.when(n == 1, 1.0).otherwise((F.log(n) - F.sum(F.col("pages") * F.log("pages")) / n) / F.log(n))
    kinds = counts.groupBy("host", "node", "marked", "shape").agg(n.alias("n"), F.count("*").alias("kinds"), entropy.alias("entropy"))
    weight = F.when(F.col("shape"), F.when(F.col("n") == 1, 0.0).otherwise(1 - F.pow(F.lit(DAMPING), F.col("kinds")))).otherwise(1.0)
    nodes = kinds.groupBy("host", "node", "marked").agg(F.max("n").alias("n"), F.max(weight * F.col("entropy")).alias("seen"))
    start = F.when(F.col("marked"), START_MARKED).otherwise(START)
    return nodes.select("host", "node", "n", ((F.col("n") * F.col("seen") + START_PAGES * start) / (F.col("n") + START_PAGES)).alias("importance"))


def cut_nodes(counts: DataFrame) -> DataFrame:
    """``host`` and ``cut``: the nodes of low importance of each host that has any."""
    low = node_importance(counts).where(F.col("importance") < LEAST_IMPORTANCE)
    return low.groupBy("host").agg(F.sort_array(F.collect_set("node")).alias("cut"))


def main_text(html: str | None, cut: frozenset[int]) -> str:
    found, _ = blocks(html)
    plain = [b for b in found if b[1] == CONTENT]
    inside = [b for b in plain if b[2]]
    if inside:
        kept = [b for b in inside if b[0] not in cut] or inside
    else:
        kept = [b for b in plain or found if b[0] not in cut]
    return "\n\n".join(text for *_, text in kept)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` (code points), a row per page.

    Null and empty pages give an empty text. A null address has the empty host. Equal pages
    give equal texts and count once for the importance of nodes. Pages may be nested to any depth:
    time grows with their length, memory with their length and open elements. Extra
    columns are ignored; an empty table gives an empty result.
    """
    # Written first, so that the planner sees that the list is small where it is.
    cuts = written(cut_nodes(style_counts(pages))).withColumnRenamed("host", "_host")
    kept = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    kept = kept.join(cuts, F.xxhash64(host_of(F.col("url"))) == F.col("_host"), "left").select("page_id", "url", "html", "cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h, frozenset(c or ())) for h, c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"page_id {kind}, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))
