"""Main text of web pages: subtrees that recur on many pages of a host are removed.

Each page is cut into elements. The subtrees (tag and text, hashed with the host) are counted in Spark
over the distinct page contents of a host; those on a ``share`` of them, and on ``min_pages`` at least,
are its template and are deleted, together with elements whose tag or role says that they are no article
text, or whose class or id is such a word as a whole. Text comes from the page's articles, else its main
element, else its body, whichever first has text. Only blocks can be template: no inline element, nothing
below a paragraph, heading, list item or table cell, and inside of an article or main element none of
these and no block that holds paragraphs or headings, so sentences that articles share are kept.

Null html counts as empty and gives an empty text, a null url an empty host. Unclosed and stray tags are
closed or ignored as browsers do; an unfinished tag at the end is dropped. Repeated pages count once, and
each gives a row; equal page ids are told apart by their content. A page is read whole, however long, in
one pass with memory of a few times its length. An empty table gives an empty table; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitloom.llm.url_filter import host

MIN_PAGES, SHARE = 3, 0.5

# Fixed values of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
              "strong sub sup time tt u var wbr img".split())
_BLOCK_TEXT = set("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_PARTS_OF = set("li dt dd td th caption figcaption".split())  # template as a whole list or table only
_TEXT = _BLOCK_TEXT | _PARTS_OF
_ROOTS = set("html body main article".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_ENDS_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
              "h6 header hr main menu nav ol pre section table ul".split())

# What is never article text.
_DROP_TAGS = set("head script style noscript template svg math iframe object canvas audio video nav footer aside form button "
                 "select textarea menu dialog".split())
_DROP_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_DROP_WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
                  "cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices "
                  "pagination pager popup promo related share sharing sidebar social sponsor sponsored subscribe toolbar "
                  "widget".split())

# Words that say nothing beside one of those: "site-footer", "cookie-box".
_PLAIN_WORDS = set("area bar block bottom box button buttons container content global group header inner item items left link "
                   "links list main outer page panel primary right secondary section side site slot top wrap "
                   "wrapper".split())

_PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[a-z]+")


def _names_no_text(name: str, in_main: bool) -> bool:
    """Whether a class or id consists of words for what is no article text."""
    words = set(_WORDS.findall(name))
    dropped = words & _DROP_WORDS or not in_main and "header" in words
    return bool(dropped) and words <= _DROP_WORDS | _PLAIN_WORDS


def _dropped(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in _DROP_TAGS or tag == "header" and not in_main:
        return True
    if not attributes or tag in _ROOTS or tag in _HEADINGS:
        return False
    for name, *values in _ATTRIBUTES.findall(attributes):
        value = "".join(values).lower()
        if name.lower() == "role":
            if _DROP_ROLES.intersection(_WORDS.findall(value)):
                return True
        elif any(_names_no_text(n, in_main) for n in value.split()):
            return True
    return False


def _subtree(site: str, tag: str, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{site}\0{tag}\0{' '.join(text.split())}") - (1 << 63)


class _Element:
    __slots__ = ("tag", "drop", "main", "at", "rich", "text")

    def __init__(self, tag, drop, main, at):
        self.tag, self.drop, self.main, self.at, self.rich = tag, drop, main, at, False
        self.text = tag in _TEXT


def _walk(page: str, site: str, root: str, template: set[int], found: set[int] | None) -> str | None:
    """Text inside the outermost ``root`` elements ('' for the whole page), without the template.

    With ``found``, the hashes of the subtrees that may be template are added to it. None: no such root.
    """
    out: list[str] = []  # of the root elements, what is left
    raw: list[str] = []  # everything not dropped, for the hashes
    stack: list[tuple[_Element, int]] = []
    drop = main = inside = 0  # open elements that are dropped, roots, blocks of text
    seen = not root

    def close(to: int) -> None:
        nonlocal drop, main, inside
        while len(stack) > to:
            element, raw_at = stack.pop()
            drop -= element.drop
            main -= element.main
            inside -= element.text
            if element.drop or drop:
                continue
            free = not (inside or element.tag in _INLINE or element.tag in _ROOTS or element.tag in _PARTS_OF
                        or main and (element.text or element.rich))
            if free and len(raw) > raw_at:
                text = "".join(raw[raw_at:])
                if not text.isspace():
                    key = _subtree(site, element.tag, text)
                    if found is not None:
                        found.add(key)
                    elif key in template:
                        del out[element.at:]
                        out.append(" ")
            if stack and (element.rich or element.tag in _BLOCK_TEXT):
                stack[-1][0].rich = True
            if element.tag not in _INLINE:
                raw.append(" ")
                out.append(" ")

    def put(text: str) -> None:
        if text and not drop:
            text = html.unescape(text) if "&" in text else text
            raw.append(text)
            if main or not root:
                out.append(text)

    at = 0
    for part in _PARTS.finditer(page):
        put(page[at:part.start()])
        at = part.end()
        name = part.group(3)
        if not name:
            continue
        tag = name.lower()
        if part.group(2):
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0].tag == tag:
                    close(k)
                    break
            continue
        closes = _CLOSES.get(tag, ()) if tag not in _ENDS_P else ("p",)
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0].tag in closes:
                close(k)
                break
            if stack[k][0].tag not in _INLINE and stack[k][0].tag not in ("td", "th", "p"):
                break
        if tag not in _INLINE:
            raw.append(" ")
            out.append(" ")
        if tag in _VOID:
            continue
        is_main = bool(root) and tag == root
        element = _Element(tag, _dropped(tag, part.group(4), bool(main or is_main)), is_main, len(out))
        seen |= is_main and not element.drop and not drop
        drop += element.drop
        main += element.main
        inside += element.text
        stack.append((element, len(raw)))
    put(page[at:])
    close(0)
    return "".join(out) if seen else None


def _root(page: str) -> str:
    low = page.lower()
    return next((tag for tag in ("article", "main") if f"<{tag}" in low), "")


def subtrees(page: str, site: str) -> list[int]:
    """Hashes of the page's subtrees that may belong to the site's template."""
    found: set[int] = set()
    _walk(page, site, _root(page), set(), found)
    return list(found)


def main_text(page: str, site: str, template: set[int]) -> str:
    for root in dict.fromkeys((_root(page), "main", "")):
        if text := " ".join((_walk(page, site, root, template, None) or "").split()):
            return text
    return ""


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, sites, keys = [], [], []
        for page, key, site, content in zip(*(c.to_pylist() for c in batch.columns)):
            found = subtrees(content, site)
            keys += found
            pages += [page] * len(found)
            sites += [key] * len(found)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (pages, sites, keys)],
                                         names=["page", "site_key", "subtree"])


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(content, site, set(template or ())) for site, content, template in
                 zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def host_pages(rows: DataFrame) -> DataFrame:
    """(site_key, pages): distinct page contents per host."""
    return rows.select("site_key", "page").distinct().groupBy("site_key").agg(F.count(F.lit(1)).alias("pages"))


def template(rows: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """(page, site_key, subtree) of all pages, and (subtree) of the template of any host."""
    found = rows.select("page", "site_key", "site", "html").mapInArrow(
        _subtree_rows, "page long, site_key long, subtree long").distinct()
    counts = (found.groupBy("site_key", "subtree").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_pages))
    often = counts.join(host_pages(rows), "site_key").where(F.col("n") >= share * F.col("pages"))
    return found, often.select("subtree")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    content = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", host().alias("site"), content.alias("html"))
    rows = rows.withColumns({"page": F.xxhash64("site", "html"), "site_key": F.xxhash64("site")})
    found, often = template(rows, min_pages, share)
    lists = found.join(often, "subtree").groupBy("page").agg(F.collect_set("subtree").alias("template"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return (rows.join(lists, "page", "left").select("page_id", "url", "site", "html", "template")
            .mapInArrow(_text_rows, f"page_id {kind}, url string, text string, n_chars long"))
