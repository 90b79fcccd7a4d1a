"""Column functions on names, ids and labels."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The vocabulary of labels, types, id prefixes and predicates.
NAMESPACE = "woo:"
SOURCE_TYPE = "woo:Source"
MENTIONED_IN = "woo:mentionedIn"
RELATED_TO = "woo:relatedTo"
LABEL_TYPES = {
    "PERSON": "Person",
    "ORG": "Organization",
    "GPE": "Place",
    "LOC": "Place",
    "FAC": "Place",
    "DATE": "Date",
    "EVENT": "Event",
    "WORK_OF_ART": "CreativeWork",
}
PREDICATES = [
    "participated_in",
    "member_of",
    "located_in",
    "occurred_at",
    "created_by",
    "related_to",
    "preceded",
    "followed",
    "caused",
    "part_of",
    "commanded",
    "worked_for",
    "allied_with",
    "opposed",
    "authored",
    "founded",
    "born_in",
    "died_in",
]
TYPE_PRIORITY = {"Person": 6, "Organization": 5, "Place": 4, "Event": 3, "CreativeWork": 2, "Date": 1, "Thing": 0}
TYPE_COLORS = {
    "Person": "#4FC3F7",
    "Place": "#81C784",
    "Organization": "#FFB74D",
    "Event": "#E57373",
    "CreativeWork": "#BA68C8",
    "Date": "#90A4AE",
    "woo:Source": "#FFD54F",
    "Thing": "#BDBDBD",
}
TYPE_ICONS = {"Person": "👤", "Place": "📍", "Organization": "🏛", "CreativeWork": "📄", "Event": "📅", "Date": "🗓"}
VIDEO_EXTENSIONS = ["mov", "mp4", "m4v", "avi", "webm", "mkv", "mpg", "mpeg", "wmv", "flv"]
MATCH_PREFIXES = ["Wikipedia:", "Wikipedia -", "PDF:", "URL:"]
TOPIC_PREFIXES = ["PEAR:", "JFK:", "PDF:", "Wikipedia:"]

BLANK = " \t\n\x0b\x0c\r"


def lookup(key: Column, table: dict, default: Column) -> Column:
    """The value of ``key`` in a small fixed table."""
    out = None
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(default)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANK))


def slug(text: Column) -> Column:
    """Lower case, runs of anything but ``a-z0-9`` as one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "-"), F.lit("-"))


@F.pandas_udf(T.StringType())
def nfkd(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition, which Spark has no function for."""
    return texts.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def slug_nfkd(text: Column) -> Column:
    """As :func:`slug` after decomposition: an accent becomes a separator of its own."""
    return slug(nfkd(F.coalesce(text, F.lit(""))))


def schema_type(label: Column) -> Column:
    return lookup(label, LABEL_TYPES, F.lit("Thing"))


def entity_id(label: Column, name_slug: Column) -> Column:
    prefix = lookup(label, {k: v.lower() for k, v in LABEL_TYPES.items()}, F.lower(label))
    return F.concat(F.lit("entity:"), prefix, F.lit("-"), name_slug)


def camel_case(snake: Column) -> Column:
    """First part as it is, later ones capitalised and otherwise lower case."""
    parts = F.split(snake, "_")
    later = F.slice(parts, F.lit(2), F.size(parts))
    return F.aggregate(later, parts[0], lambda out, p: F.concat(out, F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2)))))


def clean_predicate(predicate: Column) -> Column:
    """Without namespace, camel case apart, lower case."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(predicate, F.lit("")), "^woo:", ""), "^https?://[^/]+/[^/]+/", "")
    return F.lower(F.regexp_replace(bare, "([a-z])([A-Z])", "$1 $2"))


def resolve_id(ref: Column) -> Column:
    """The id in a reference that is either a string or ``{"@id": ...}``; ``ref`` is a VARIANT."""
    return F.coalesce(F.try_variant_get(ref, "$['@id']", "string"), F.when(F.schema_of_variant(ref) == "STRING", F.try_variant_get(ref, "$", "string")))


def pretty_id(id_: Column) -> Column:
    """The part of an id after its last colon, hyphens as blanks."""
    return F.replace(F.element_at(F.split(id_, ":"), -1), F.lit("-"), F.lit(" "))


def mermaid_id(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^a-zA-Z0-9_]", "_")


def short_label(name: Column, type_: Column) -> Column:
    """Icon and name, the name cut to 27 characters where it has over 30."""
    cut = F.when(F.length(name) <= 30, name).otherwise(F.concat(F.substring(name, 1, 27), F.lit("…")))
    return F.btrim(F.concat(lookup(type_, TYPE_ICONS, F.lit("")), F.lit(" "), cut))


def looks_like_video(url: Column) -> Column:
    path = F.regexp_replace(F.coalesce(url, F.lit("")), "[?#].*", "")
    return path.rlike(rf"(?i)\.({'|'.join(VIDEO_EXTENSIONS)})$")


def route(type_: Column, url: Column) -> Column:
    """The kind that a submission is processed as: links to videos are videos."""
    return F.when((type_ == "url") & looks_like_video(url), "video").otherwise(type_)


def strip_prefixes(title: Column, prefixes: list[str], trim_each: bool = False) -> Column:
    """Each prefix that the title then begins with goes, in order."""
    for prefix in prefixes:
        rest = F.substr(title, F.lit(len(prefix) + 1))
        title = F.when(F.startswith(title, F.lit(prefix)), strip(rest) if trim_each else rest).otherwise(title)
    return strip(title)


def topic_name(title: Column) -> Column:
    """The name of a topic made up from a title: no known prefix, no leading year."""
    return strip(F.regexp_replace(strip_prefixes(title, TOPIC_PREFIXES, trim_each=True), r"^\d{4}[-\s]+", ""))


def year_from_slug(text: Column) -> Column:
    """A year of 1800 to 2100 inside a slug, else at its end."""

    def year(pattern: str) -> Column:
        found = F.regexp_extract(text, pattern, 1).try_cast("int")
        return F.when(found.between(1800, 2100), found)

    return F.coalesce(year(r"-(\d{4})-"), year(r"-(\d{4})$"))


def rolling_hash(text: Column) -> Column:
    """31-based signed 32-bit hash over UTF-16 units (exact for characters up to U+FFFF)."""
    wrapped = F.aggregate(F.split(text, ""), F.lit(0).cast("long"), lambda h, c: F.when(c == "", h).otherwise(F.pmod(h * 31 + F.ascii(c), F.lit(1 << 32))))
    return F.when(wrapped >= 1 << 31, wrapped - (1 << 32)).otherwise(wrapped)


def cache_key(*parts: Column) -> Column:
    """SHA-256 of the parts joined by a line of three hyphens."""
    return F.sha2(F.concat_ws("\n---\n", *parts), 256)


def dms_to_degrees(degrees: Column, minutes: Column, seconds: Column, ref: Column) -> Column:
    value = degrees + minutes / 60 + seconds / 3600
    return F.when(ref.isin("S", "W"), -value).otherwise(value)


def short_place(display_name: Column) -> Column:
    """The first three parts of an address."""
    return F.array_join(F.slice(F.split(F.coalesce(display_name, F.lit("")), ","), F.lit(1), F.lit(3)), ",")


def cache_file(id_: Column) -> Column:
    """The file of an id in a cache of files."""
    return F.concat(F.translate(id_, ":/", "__"), F.lit(".json"))

