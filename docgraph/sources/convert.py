"""Converting what was fetched or uploaded into document text."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose text isn't content, those that end a line, and marks of headings.
_SILENT = {"script", "style", "head", "nav", "footer", "aside", "form", "noscript", "template"}
_BLOCKS = {"p", "div", "section", "article", "br", "li", "tr", "table", "ul", "ol", "blockquote", "pre", "main", "h1", "h2", "h3", "h4", "h5", "h6"}
_HEADINGS = {f"h{i}": "#" * i + " " for i in range(1, 7)}
_YOUTUBE = r"(?i)^https?://((www|m)\.)?(youtube\.com|youtu\.be)(/|$)"


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = [""]
        self.silent = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _SILENT:
            self.silent += 1
        elif tag in _BLOCKS:
            self.lines.append(_HEADINGS.get(tag, "- " if tag == "li" else ""))

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in _BLOCKS:
            self.lines.append("")

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.lines[-1] += re.sub(r"\s+", " ", data)


def main_text(html: str | None) -> str:
    """The text of a page as lines of markdown, without navigation and scripts."""
    reader = _Reader()
    reader.feed(html or "")
    lines = [x.strip() for x in reader.lines]
    return "\n\n".join(x for x in lines if x.strip("#- "))


@F.pandas_udf(T.StringType())
def page_text(html: pd.Series) -> pd.Series:
    return html.map(main_text)


def web_documents(pages: DataFrame) -> DataFrame:
    """url, text of fetched pages (url, html); the text begins with a comment that names its source."""
    text = F.concat(F.lit("<!-- Source: "), "url", F.lit(" -->\n\n"), page_text(F.col("html")))
    return pages.select("url", text.alias("text"))


def account_documents(spark: SparkSession, path: str) -> DataFrame:
    """slug, text of the markdown files below ``path``, as they are."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.md")
    return files.select(F.regexp_replace(F.element_at(F.split("_metadata.file_path", "/"), -1), r"\.md$", "").alias("slug"), F.col("value").alias("text"))


def pdf_documents(files: DataFrame, digital: Callable[[bytes], tuple[str, int]], scanned: Callable[[bytes], str | None]) -> DataFrame:
    """path, text, backend of PDF files (path, content) by two extractors given by the caller.

    ``digital`` returns a file's own text and pages; where that is too little a page,
    ``scanned`` reads the images, and if it returns nothing the own text stays.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                text, pages = digital(bytes(content))
                seen = None if len(text) / max(pages, 1) >= 200 else scanned(bytes(content))
                rows.append((path, seen or text, "scanned" if seen else "digital"))
            yield pd.DataFrame(rows, columns=["path", "text", "backend"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, backend string")


def gps_of(data: bytes | None) -> tuple[float, float] | None:
    """Latitude and longitude in the EXIF part of a JPEG file, None where it has none or is damaged.

    Segments are walked up to the APP1 segment with an EXIF header; of the first directory the
    GPS pointer leads to the directory whose rationals are degrees, minutes and seconds.
    """
    if not data or data[:2] != b"\xff\xd8":
        return None
    at = 2
    try:
        while data[at] == 0xFF and data[at + 1] not in (0xDA, 0xD9):
            (length,) = struct.unpack_from(">H", data, at + 2)
            if data[at + 1] == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
                return _gps_of_tiff(data[at + 10 : at + 2 + length])
            at += 2 + length
    except (struct.error, IndexError):
        pass
    return None


def _gps_of_tiff(tiff: bytes) -> tuple[float, float] | None:
    order = {b"II": "<", b"MM": ">"}.get(tiff[:2])
    if order is None:
        return None

    def directory(at: int) -> dict[int, tuple[int, int]]:
        """Each tag with the place of its value field and what that holds as a number."""
        (n,) = struct.unpack_from(f"{order}H", tiff, at)
        places = [at + 2 + 12 * i for i in range(n)]
        return {struct.unpack_from(f"{order}H", tiff, p)[0]: (p + 8, struct.unpack_from(f"{order}I", tiff, p + 8)[0]) for p in places}

    (first,) = struct.unpack_from(f"{order}I", tiff, 4)
    pointer = directory(first).get(0x8825)
    if pointer is None:
        return None
    gps = directory(pointer[1])
    if 2 not in gps or 4 not in gps:
        return None

    def degrees(ref: int, tag: int, negative: bytes) -> float:
        parts = struct.unpack_from(f"{order}6I", tiff, gps[tag][1])
        value = sum((parts[2 * i] / parts[2 * i + 1] if parts[2 * i + 1] else 0.0) / 60**i for i in range(3))
        place = gps[ref][0] if ref in gps else None
        return -value if place is not None and tiff[place : place + 1] == negative else value

    return degrees(1, 2, b"S"), degrees(3, 4, b"W")


@F.pandas_udf(T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lng", T.DoubleType())]))
def image_gps(content: pd.Series) -> pd.DataFrame:
    """lat, lng of image files; null where a file has none."""
    found = [gps_of(bytes(c)) if c is not None else None for c in content]
    return pd.DataFrame({"lat": [f[0] if f else None for f in found], "lng": [f[1] if f else None for f in found]}, dtype=float)


def with_archive(pages: DataFrame, archived: DataFrame, least: int = 1) -> DataFrame:
    """pages (url, html) where fetching failed or gave under ``least`` characters of text, from an archive (url, html, taken); the newest copy.

    ``archived`` says whether the html came from there.
    """
    newest = archived.filter("html is not null").groupBy("url").agg(F.max(F.struct("taken", "html"))["html"].alias("copy"))
    joined = pages.join(newest, "url", "left")
    lacking = (F.col("html").isNull() | (F.length(page_text(F.col("html"))) < least)) & F.col("copy").isNotNull()
    return joined.select("url", F.when(lacking, F.col("copy")).otherwise(F.col("html")).alias("html"), lacking.alias("archived"))


def is_youtube(url: Column) -> Column:
    return F.coalesce(url.rlike(_YOUTUBE), F.lit(False))


def sampled_frames(frames: DataFrame, step: int = 1, most: int = 0) -> DataFrame:
    """Every ``step``-th frame (video, frame from 0), at most ``most`` a video if that isn't 0."""
    kept = frames.filter(F.col("frame") % step == 0)
    return kept.filter(F.col("frame") < step * most) if most else kept

