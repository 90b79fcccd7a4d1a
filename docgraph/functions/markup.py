"""Column and vectorised functions on document text: markdown, snippets, chunks, links, replies."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions.names import PREDICATES, strip

CONTEXT = 100
CHUNK_CHARACTERS = 2000
# Path parts of pages without content, and the labels of links to a next page.
SKIPPED_PATHS = [
    "/login", "/logout", "/register", "/signup", "/sign-up",
    "/admin", "/wp-admin", "/wp-login",
    "/feed", "/rss", "/sitemap",
    "/search", "/tag/", "/tags/", "/category/", "/categories/",
    "/author/", "/user/",
    "#",
]
NEXT_LABELS = ["next", "next page", "»", "›", "→"]
# Markdown markers in the order in which they go, with what replaces them.
MARKDOWN = [
    (r"\*{1,3}([^*]+)\*{1,3}", "$1"),
    (r"_{1,3}([^_]+)_{1,3}", "$1"),
    (r"(?md)^#{1,6}\s+", ""),
    (r"\[([^\]]+)\]\([^)]+\)", "$1"),
    (r"!\[([^\]]*)\]\([^)]+\)", "$1"),
    (r"`([^`]+)`", "$1"),
]


def strip_markdown(text: Column) -> Column:
    """Text without markdown markers. Links go before images, so an image keeps its ``!``."""
    for pattern, replacement in MARKDOWN:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def context_snippet(text: Column, start: Column, end: Column, window: int = CONTEXT) -> Column:
    """Up to ``window`` characters on both sides of a span, with dots where text is cut."""
    low = F.greatest(F.lit(0), start - window)
    high = F.least(F.length(text), end + window)
    inside = strip(F.substr(text, low + 1, high - low))
    return F.concat(F.when(low > 0, "...").otherwise(""), inside, F.when(high < F.length(text), "...").otherwise(""))


def chunk(text: str | None, size: int = CHUNK_CHARACTERS) -> list[str]:
    """Pieces of at most ``size`` characters, cut after their last full stop if it lies in their second half."""
    text = text or ""
    pieces, start = [], 0
    while len(text) - start > size:
        stop = text.rfind(".", start, start + size)
        end = stop + 1 if stop > start + size // 2 else start + size
        pieces.append(text[start:end])
        start = end
    if start < len(text) or not pieces:
        pieces.append(text[start:])
    return pieces


@F.pandas_udf(T.ArrayType(T.StringType()))
def chunks(texts: pd.Series) -> pd.Series:
    """Each piece begins where the last one ended, so cutting is a fold over the text."""
    return texts.map(chunk)


class _Anchors(HTMLParser):
    """(tag, href, rel, text) of each anchor and link element."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[list] = []
        self.open: list[list] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        own = dict(attrs)
        if tag in ("a", "link"):
            entry = [tag, own.get("href"), own.get("rel") or "", ""]
            self.found.append(entry)
            if tag == "a":
                self.open.append(entry)

    def handle_endtag(self, tag: str) -> None:
        if tag == "a" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        for entry in self.open:
            entry[3] += data.strip()


def anchors(html: str | None) -> list[list]:
    parser = _Anchors()
    parser.feed(html or "")
    return parser.found


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("url", T.StringType()), T.StructField("title", T.StringType())])))
def page_links(html: pd.Series, base: pd.Series) -> pd.Series:
    """Absolute links of a page in order, the first of each; nothing about hosts or paths yet."""

    def links(page: str | None, url: str) -> list[dict]:
        seen: dict[str, str] = {}
        for tag, href, _, text in anchors(page):
            href = (href or "").strip()
            if tag != "a" or not href or href.startswith("javascript:"):
                continue
            absolute = urljoin(url or "", href).split("#")[0]
            if absolute and absolute != url and absolute not in seen:
                seen[absolute] = text or absolute
        return [{"url": u, "title": t} for u, t in seen.items()]

    return pd.Series([links(h, u) for h, u in zip(html, base, strict=True)])


@F.pandas_udf(T.StringType())
def next_page(html: pd.Series, base: pd.Series) -> pd.Series:
    """The page that a page names as its next one."""

    def following(page: str | None, url: str) -> str | None:
        found = anchors(page)
        for kind in ("link", "a"):
            for tag, href, rel, _ in found:
                if tag == kind and "next" in rel.split() and href:
                    return urljoin(url, href)
        for tag, href, _, text in found:
            if tag == "a" and href is not None and text.lower() in NEXT_LABELS and urljoin(url, href) != url:
                return urljoin(url, href)
        return None

    return pd.Series([following(h, u) for h, u in zip(html, base, strict=True)])


def is_content_url(url: Column, host: Column) -> Column:
    """A page with content on the same host; ``#`` can never be part of a path."""
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    own = F.try_parse_url(url, F.lit("AUTHORITY"))
    skipped = F.exists(F.array(*map(F.lit, SKIPPED_PATHS)), lambda s: F.contains(path, s))
    return F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")).isin("http", "https") & (own.isNull() | (own == host)) & ~skipped, F.lit(False))


REPLY_SCHEMA = "array<struct<subject string, predicate string, object string, confidence double>>"


def reply_rows(reply: Column) -> Column:
    """The rows of a model's reply: a JSON array, else none; rows with unknown predicates go, missing confidence is 0."""
    is_array = F.startswith(F.ltrim(reply), F.lit("["))
    rows = F.when(is_array, F.from_json(reply, REPLY_SCHEMA))
    good = F.filter(F.coalesce(rows, F.array().cast(REPLY_SCHEMA)), lambda r: r["predicate"].isin(PREDICATES))
    return F.transform(good, lambda r: r.withField("confidence", F.coalesce(r["confidence"], F.lit(0.0))))


@F.pandas_udf(T.StringType())
def two_places(values: pd.Series) -> pd.Series:
    """Two decimals of the binary value, halves to even."""
    return values.map(lambda x: None if pd.isna(x) else f"{x:.2f}")


def title_of(html: str) -> str:
    found = re.search(r"(?is)<title[^>]*>(.*?)</title>", html or "")
    return found[1].strip() if found else ""
