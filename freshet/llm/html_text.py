"""Main text of web pages, by removing the templates of their sites.

Every element subtree of a page is hashed (its markup and text). Spark counts, per host, on
how many different pages each hash occurs. A block that recurs on half of the different pages of its host is part of the
site's template and is cut out, however large the host; inline elements and table cells never are. Inside
the article only containers are cut, at a higher share: a sentence that
many articles share is still the article's. What is boilerplate by its element or by
its name (navigation, forms, adverts, comments ...) is cut out on every page, also on a host's only one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.base import saved

#: A subtree is a template's if it is on so many different pages of the host, and on this share of them.
LEAST, SHARE = 3, 0.5
#: The share for containers inside an article, high to spare what articles have in common.
INSIDE = 0.8

# HTML's element classes.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
GONE = frozenset("head script style noscript template iframe object svg canvas nav footer aside form button select option input textarea dialog menu audio video noembed noframes map".split())
BLOCK = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure footer h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul aside form".split())
#: What may be a template's: blocks, but not the parts of a table, which hold figures inside a text.
PARTS = BLOCK - frozenset("html body caption tbody td tfoot th thead tr".split())
#: What may be a template's inside an article: containers, but no paragraphs, headings or list items.
CONTAINERS = frozenset("address center details div dl figure hgroup ol section table ul".split())
#: What closes an open <p>, and what closes its own kind.
CLOSES_P = BLOCK - frozenset("body html caption td th tr tbody thead tfoot legend summary figcaption".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
#: Words in class, id or role that name boilerplate.
NAMES = frozenset("ad ads advert adverts advertisement adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead toolbar widget widgets share sharing social related recommended newsletter subscribe signup login search comment comments disqus respond reply replies pagination pager tags skip complementary contentinfo dialog sitenav topbar".split())
MAIN = frozenset(("article", "main"))

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
SPACE = re.compile(r"[ \t\n\x0b\f\r\xa0]+")
PART = re.compile(r"[a-z0-9]+")


class Element:
    """An element; ``parts`` are texts and elements in page order."""

    __slots__ = ("tag", "attributes", "parts", "hash")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.parts, self.hash = tag, attributes, [], 0

    def boilerplate(self) -> bool:
        if self.tag in GONE:
            return True
        if not self.attributes or self.tag in MAIN or self.tag in ("body", "html"):
            return False
        if HIDDEN.search(self.attributes):
            return True
        for match in NAMED.finditer(self.attributes):
            if NAMES.intersection(PART.findall((match[1] or match[2] or match[3] or "").lower())):
                return True
        return False


def parse(page: str) -> Element:
    """A tree of a page, however it is broken; everything belongs somewhere."""
    root = Element("html")
    stack, position, size = [root], 0, len(page)
    while position < size:
        token = TOKEN.match(page, position)
        position = token.end()
        closing, opening = token[1], token[2]
        if closing:
            tag = closing.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                # A stray end tag inside an inline element must not close the blocks around it.
                if stack[i].tag in BLOCK and tag not in BLOCK:
                    break
        elif opening:
            tag = opening.lower()
            if tag == "html":
                continue
            if tag in CLOSES_P:
                _close(stack, ("p",), ("body", "td", "th", "li", "div", "article", "section", "main", "button"))
            if tag in SIBLINGS:
                _close(stack, SIBLINGS[tag], SCOPES[tag])
            element = Element(tag, token[3] or "")
            stack[-1].parts.append(element)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, position)
                element.parts.append(page[position : end.start() if end else size])
                position = end.end() if end else size
            elif tag not in VOID and not (token[3] or "").endswith("/"):
                stack.append(element)
        elif token[0][:2] not in ("<!", "<?", "</") or len(token[0]) == 1:
            stack[-1].parts.append(token[0])
    return root


def _close(stack: list[Element], tags: tuple[str, ...], scopes: tuple[str, ...]) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in scopes:
            return


def subtrees(root: Element) -> list[Element]:
    """All elements, children first, with their hashes set."""
    order, waiting = [], [root]
    while waiting:
        element = waiting.pop()
        order.append(element)
        waiting.extend(p for p in element.parts if isinstance(p, Element))
    order.reverse()
    for element in order:
        state = xxhash.xxh64(f"{element.tag}\0{element.attributes.strip()}\0".encode("utf-8", "surrogatepass"))
        for part in element.parts:
            if isinstance(part, Element):
                state.update(part.hash.to_bytes(8, "little"))
            else:
                state.update(b"\1" + SPACE.sub(" ", part).strip().encode("utf-8", "surrogatepass"))
        element.hash = state.intdigest()
    return order


def open_elements(root: Element) -> list[Element]:
    """The elements that may be a template's: outside the article and not boilerplate anyway."""
    found, waiting = [], list(root.parts)
    while waiting:
        part = waiting.pop()
        if isinstance(part, str) or part.tag in MAIN or part.boilerplate():
            continue
        if part.tag in PARTS and part.parts:
            found.append(part)
        waiting.extend(part.parts)
    return found


def inner_elements(articles: set[Element]) -> list[Element]:
    """The containers inside the articles that are not boilerplate anyway."""
    found, waiting = [], [part for article in articles for part in article.parts]
    while waiting:
        part = waiting.pop()
        if isinstance(part, str) or part.boilerplate():
            continue
        if part.tag in CONTAINERS and part.parts:
            found.append(part)
        waiting.extend(part.parts)
    return found


def signed(element: Element, inner: bool) -> int:
    """A subtree's hash as Spark holds it; the lowest bit tells those inside an article."""
    found = element.hash & ~1 | inner
    return found - (1 << 64) if found >> 63 else found


def page_hashes(page: str | None, shown: bool = False) -> list[int]:
    """Hashes of the subtrees that templates are looked for among, each once; if ``shown``, only of those that could be in the text."""
    root = parse(page or "")
    subtrees(root)
    articles = _articles(root)
    found = {signed(e, True) for e in inner_elements(articles)}
    if not (shown and articles):
        found.update(signed(e, False) for e in open_elements(root))
    return sorted(found)


def main_text(page: str | None, template: set[int] = frozenset()) -> str:
    """The blocks of the article, joined by an empty line; empty if there is none."""
    root = parse(page or "")
    subtrees(root)
    inside = _articles(root)
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", html.unescape("".join(held))).strip(" ")
        held.clear()
        if text:
            blocks.append(text)

    # Iterative, since pages nest as deep as they like.
    waiting: list = [(root, not inside)]
    while waiting:
        part, shown = waiting.pop()
        if part is None:
            flush()
            continue
        if isinstance(part, str):
            if shown:
                held.append(part)
            continue
        if part.boilerplate():
            continue
        if part.tag == "header" and not shown:
            continue
        if not inside and part.tag == "header":
            continue
        if part in inside:
            shown = True
        elif template and part.parts and part.tag in (CONTAINERS if inside else PARTS) and signed(part, bool(inside)) in template:
            continue
        if part.tag == "br":
            held.append(" ")
            continue
        block = part.tag in BLOCK
        if block:
            flush()
            waiting.append((None, shown))
        waiting.extend((p, shown) for p in reversed(part.parts))
    flush()
    if inside and template and not blocks:
        # An article is never a template as a whole.
        return main_text(page)
    return "\n\n".join(blocks)


def _articles(root: Element) -> set[Element]:
    """The outermost article elements, else the main ones; comments written as articles inside count with their parent."""
    for tag in ("article", "main"):
        found, waiting = set(), [root]
        while waiting:
            element = waiting.pop()
            if element.tag == tag:
                found.add(element)
                continue
            waiting.extend(p for p in element.parts if isinstance(p, Element) and not p.boilerplate())
        if found:
            return found
    return set()


def host(url: Column) -> Column:
    """The lower-case host of a url, without user and port; empty for null."""
    found = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return found


def templates(pages: DataFrame) -> DataFrame:
    """(host, hash) of the subtrees that recur on many pages of their host."""

    def hash_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.Series([page_hashes(page) for page in batch["html"]], dtype=object)
            yield pd.DataFrame({"host": batch["host"], "content": batch["content"], "hashes": found})

    # Copies of a page are one page: of equal contents of a host one row is counted.
    page = F.coalesce("html", F.lit(""))
    rows = pages.select(host(F.col("url")).alias("host"), F.xxhash64(page).alias("content"), page.alias("html"))
    hashed = rows.mapInPandas(hash_all, "host string, content long, hashes array<long>")
    different = hashed.groupBy("host", "content").agg(F.first("hashes").alias("hashes"))
    seen = different.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").agg(F.count("*").alias("pages"))
    counts = rows.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("every"))
    often = seen.where(F.col("pages") >= LEAST).join(counts, "host")
    share = F.when(F.col("hash").bitwiseAND(1) == 1, INSIDE).otherwise(SHARE)
    return often.where(F.col("pages") >= share * F.col("every")).select("host", "hash")


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html; other columns are ignored): page_id, url, text, n_chars.

    Null html gives an empty text; a null url is a host of its own. Repeated rows are kept: they are
    told apart from others by page_id, url and html, and get the same text.
    """
    found = saved(templates(pages), "page-templates")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))

    def needs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(k, h, x) for k, h, page in zip(batch["key"], batch["host"], batch["html"]) for x in page_hashes(page, True)]
            yield pd.DataFrame(out, columns=["key", "host", "hash"]).astype({"host": object})

    key = F.xxhash64("page_id", "url", "html").alias("key")
    own = rows.select(key, "host", "html").mapInPandas(needs, "key long, host string, hash long")
    # Per page, the template subtrees that it holds: bounded by the page.
    cut = own.join(found, ["host", "hash"]).groupBy("key").agg(F.collect_set("hash").alias("template"))
    joined = rows.select(key, "page_id", "url", "html").join(cut, "key", "left")

    def text_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page, set() if t is None else set(map(int, t))) for page, t in zip(batch["html"], batch["template"])]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": pd.Series(texts, dtype=object)})

    extracted = joined.select("page_id", "url", "html", "template").mapInPandas(text_of, "page_id long, url string, text string")
    return extracted.withColumn("n_chars", F.length("text").cast("long"))
