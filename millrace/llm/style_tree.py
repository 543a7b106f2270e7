"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree whose nodes are the paths of tags and classes
that blocks of text lie under. A node's importance has two parts: how varied its contents are
over the pages that have it (content that comes back on page after page has high entropy over
the pages, so low importance), and how varied its presentation is (how often it occurs in a
page). Branches of low importance are removed from each page, as are elements whose role says
that they are no article: menus, headers, footers, forms and the like.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tools import portions, stored
from millrace.operators.joins import join_broadcasting

#: A node on fewer pages of its host is not judged.
LEAST_PAGES = 10
#: Branches below this importance are removed.
THRESHOLD = 0.25
#: Share of the presentation in the importance of a node.
PRESENTATION = 0.1

# Fixed values of HTML: elements by kind.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title noscript iframe template svg math object audio video canvas".split())
_BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre section select summary"
    " table tbody td tfoot th thead tr ul caption button".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
_SCOPE = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot", "div", "article", "section", "main", "body", "html", "blockquote"}
# What is never part of an article, by element, by role and by a word of a class or id.
_NO_ARTICLE = set("head nav footer aside form menu dialog button select fieldset".split())
_NO_ROLE = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_NO_CLASS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice popup modal newsletter subscribe"
    " subscription signup login comment comments commentlist disqus replies reply share sharing social related recommended"
    " recommendations widget toolbar pagination pager disclaimer copyright form search".split()
)
_STATE = ("has", "with", "no", "is", "not")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)(?=[\s=/>])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_DIGITS = re.compile(r"\d+")


def _marks(attributes: str) -> dict[str, str]:
    if not attributes.strip(" />\n"):
        return {}
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}


def _excluded(tag: str, marks: dict[str, str], in_article: bool) -> bool:
    """Whether the element's role says that it holds no article text."""
    if tag in _NO_ARTICLE or (tag == "header" and not in_article):
        return True
    if not marks or tag in ("html", "body", "main"):
        return False
    if "hidden" in marks or marks.get("aria-hidden") == "true" or marks.get("role") in _NO_ROLE:
        return True
    for name in f"{marks.get('class', '')} {marks.get('id', '')}".split():
        words = re.split(r"[-_]+", name)
        if words[0] not in _STATE and (not _NO_CLASS.isdisjoint(words) or ("header" in words and not in_article)):
            return True
    return False


def blocks(page: str | None) -> list[tuple[str, bool, str]]:
    """``path, within the article, text`` of the blocks of a page, in order, without excluded elements.

    Elements left open end with what holds them; end tags without a start are skipped. Text
    that lies in no element counts as a block of the page.
    """
    page = page or ""
    # Element, its name in the path, inside an article, excluded, and for what is excluded
    # within a block how much text the block held before.
    stack: list[tuple[str, str, bool, bool, int]] = [("", "", False, False, 0)]
    out: list[tuple[str, bool, str]] = []
    held: list[str] = []

    def cut(depth: int) -> None:
        """Forget what was held inside excluded elements, from ``depth`` up."""
        for item in stack[depth:]:
            if item[3]:
                del held[item[4] :]
                break

    def flush() -> None:
        if held:
            cut(1)
            text = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append(("/".join(item[1] for item in stack[1:] if item[0] in _BLOCK), stack[-1][2], text))

    def close(down_to: int) -> None:
        flush()
        del stack[down_to:]

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        if token is None:
            held.append(page[at:])
            break
        if token.start() > at:
            held.append(page[at : token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    if tag in _BLOCK:
                        close(depth)
                    else:
                        cut(depth)
                        del stack[depth:]
                    break
                if tag not in _BLOCK and stack[depth][0] in _BLOCK:
                    break
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if end is None and tag in ("script", "style", "textarea", "title"):
                at = size
            elif end is not None:
                at = end.start()
            if tag not in ("svg", "math", "object", "canvas", "audio", "video") or end is not None:
                continue
        if tag in _BLOCK:
            flush()
            closes = _CLOSES.get(tag, set()) | {"p"}
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in closes:
                    close(depth)
                elif stack[depth][0] in _SCOPE:
                    break
        if tag == "br":
            held.append(" ")
        if tag in _VOID or token[0].endswith("/>") and tag not in _BLOCK:
            continue
        marks = _marks(token[3])
        _, _, in_article, excluded, _ = stack[-1]
        excluded = excluded or _excluded(tag, marks, in_article)
        name = tag + "".join("." + _DIGITS.sub("0", c) for c in sorted(marks.get("class", "").split()))
        stack.append((tag, name, in_article or tag in ("article", "main"), excluded, len(held)))
    flush()
    if any(inside for _, inside, _ in out):
        out = [block for block in out if block[1]]
    return out


def _host() -> Column:
    return F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def node_importance(pages: DataFrame) -> DataFrame:
    """``host, node, n_pages, importance`` of the site style trees, a node being the hash of its path."""

    def features(batches):
        for batch in batches:
            for part in portions(batch, 1):
                rows = []
                for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by_node: dict[str, list[str]] = {}
                    for path, _, text in blocks(page):
                        by_node.setdefault(path, []).append(text)
                    for path, texts in by_node.items():
                        node = _hash(path)
                        rows.append((host, node, True, len(texts)))
                        rows += [(host, node, False, _hash(text)) for text in set(texts)]
                host, node, style, value = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(host, pa.string()), pa.array(node, pa.int64()), pa.array(style, pa.bool_()), pa.array(value, pa.int64())],
                    names=["host", "node", "style", "value"],
                )

    rows = pages.select(_host().alias("host"), "html").mapInArrow(features, "host string, node long, style boolean, value long")
    counts = rows.groupBy("host", "node", "style", "value").agg(F.count("*").alias("n"))
    spread = F.col("n") * F.log("n")
    sums = counts.groupBy("host", "node").agg(
        F.sum(F.when(F.col("style"), F.col("n"))).alias("n_pages"),
        F.sum(F.when(F.col("style"), spread)).alias("style_spread"),
        F.sum(F.when(~F.col("style"), F.col("n"))).alias("contents"),
        F.sum(F.when(~F.col("style"), spread)).alias("content_spread"),
    )
    size = F.log(F.greatest(F.col("n_pages"), F.lit(2)).cast("double"))
    content = 1 - F.col("content_spread") / (F.col("contents") * size)
    presentation = 1 - F.col("style_spread") / (F.col("n_pages") * size)
    return sums.select(
        "host", "node", "n_pages", ((1 - PRESENTATION) * content + PRESENTATION * presentation).alias("importance")
    )


def main_text(pages: DataFrame, least_pages: int = LEAST_PAGES, threshold: float = THRESHOLD, key: str = "page_id") -> DataFrame:
    """``key, url, text, n_blocks, n_removed`` of every row of ``pages``: blocks joined by a newline.

    A null or empty page has an empty text. A null url is a host of its own, as is one that is
    not a url. Pages that share a key are extracted one by one. If a page has an article or main
    element, its text is taken from there alone.
    """
    judged = node_importance(pages).filter((F.col("n_pages") >= least_pages) & (F.col("importance") < threshold))
    low = stored(judged.groupBy("host").agg(F.collect_list("node").alias("low_nodes")), "style-tree")

    def extract(batches):
        for batch in batches:
            for part in portions(batch, 2):
                texts, kept, removed = [], [], []
                for page, low_nodes in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    found = blocks(page)
                    drop = set(low_nodes or ())
                    use = [text for path, _, text in found if not drop or _hash(path) not in drop]
                    texts.append("\n".join(use))
                    kept.append(len(use))
                    removed.append(len(found) - len(use))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(kept, pa.int32()), pa.array(removed, pa.int32())],
                    names=[key, "url", "text", "n_blocks", "n_removed"],
                )

    rows = pages.select(F.col(key), F.col("url"), F.col("html"), _host().alias("site"))
    with_low = join_broadcasting(rows, low.withColumnRenamed("host", "low_host"), F.col("site") == F.col("low_host"), "left")
    kind = pages.schema[key].dataType.simpleString()
    return with_low.select(key, "url", "html", "low_nodes").mapInArrow(
        extract, f"`{key}` {kind}, url string, text string, n_blocks int, n_removed int"
    )
