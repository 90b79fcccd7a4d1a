"""Predicates that tell real names from noise, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docgraph.functions.names import SOURCE_TYPE, strip

# Word lists and patterns.
ENTITY_LABELS = ["PERSON", "ORG", "GPE", "LOC", "DATE", "EVENT", "WORK_OF_ART", "FAC"]
COMMON_WORDS = [
    "east", "west", "north", "south", "new", "old", "general", "special", "local", "remote", "total", "standard",
    "statistical", "manuscript", "symposia", "symposium", "baseline", "random", "normal", "primary", "secondary",
    "analysis", "method", "methods", "model", "models", "theory", "experiment", "experiments", "result", "results",
    "data", "system", "process", "field", "fields", "effect", "effects", "series", "trial", "trials", "operator",
    "operators", "appendix", "abstract", "summary", "review", "note", "notes", "letter", "comment", "comments",
    "reply", "response", "proceedings", "conference", "workshop", "seminar",
]
REFERENCE_PATTERNS = [
    r"^\d+[\s,]*\d*\s*[\^]",
    r"^\[\d+\]",
    r"^p\.\s*\d+",
    r"^\d+[-–]\d+$",
    r"^\(?\d{1,3}\)$",
    r"\^",
    r"^[A-Z]{1,3}$",
    r"^\d+$",
    r"^https?://",
    r"[\\${}]",
    r"\|.*\|",
    r"^[\d\s.,;:()/\-–]+$",
    r"^(br|nbsp)>",
    r"(?i)^(Fig|Std|Dev|Int|Sec|Ref|Eq)\.?$",
    r"(?i)^(al|ed|eds|vol|nos?)\.?$",
    r"(?i)^(Table|Figure|Fig)\s",
    r"(?i)^(many|several|some|few|various)\s",
    r"(?i)^(late|early|mid)\s+(19|20)\d\d",
    r"(?i)century$",
    r"(?i)^\d+(st|nd|rd|th)\s",
    r"(?i)years?\s+ago",
    r",$",
]
GRAPH_NOISE_PATTERNS = [r"[\\${}]", r"\|.*\|", r"^[\d\s.,;:()/\-–]+$", r"^(br|nbsp)>"]
NON_PLACES = [
    "alternatively", "bayesian", "logistic", "baseline", "random", "normal", "primary", "secondary", "general",
    "standard", "statistical", "experimental", "theoretical", "local", "remote", "global", "national",
    "international", "east", "west", "north", "south", "central", "early", "late", "mid", "modern", "ancient",
    "various", "several", "many", "few", "multiple", "pharmacology", "consciousness", "space", "alchemy", "divinity",
    "healing", "psychotherapy", "anesthesia", "anomaly", "mass", "automatic", "reference", "perspective", "addenda",
    "calibrations", "checksum", "sigma", "consequence", "notwithstanding", "superficially", "strands", "ideas",
    "dialectica", "quanta",
]
PLACE_NOISE_PATTERNS = [
    r"[&|>{}<$\\]",
    r"^\d+$",
    r"^[A-Z]{1,2}$",
    r"^\W+$",
    r"[,;]\s*$",
    r"^\(",
    r"(?i)\b(Table|Figure|Fig)\s",
    r"(?i)^\d+(st|nd|rd|th)\s",
    r"\[\[",
    r"\n",
    r"\(\d+",
    r"^\s*(the\s+)?[A-Z][a-z]+-[A-Z][a-z]+\b",
    r"(?i)\b(www\.|http|\.edu|\.com)\b",
    r"[;:()/].*[;:()/]",
    r"\s{2,}",
    r"^[a-z](?!he\s)",
    r"\d.*[a-zA-Z].*\d",
]
PLACE_TYPES = ["Place", "GPE", "LOC", "FAC"]
YEAR_1500_2029 = r"\b(1[5-9]\d{2}|20[0-2]\d)\b"
EXPLICIT_DATE = (
    r"((?:January|February|March|April|May|June|July|August|September|October|November|December"
    r"|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)\.?\s+\d{1,2},?\s+\d{4}"
    r"|\d{4}[-/]\d{1,2}[-/]\d{1,2}"
    r"|\d{1,2}\s+(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}"
    r"|\b(?:19|20)\d{2}\b)"
)


def matches(text: Column, patterns: list[str], flags: str = "dU") -> Column:
    """Whether any pattern is found; flags keep ``$``, ``.`` and ``\\w`` to the patterns' own dialect."""
    return text.rlike(f"(?{flags})" + "|".join(f"(?:{p})" for p in patterns))


def alpha_ratio(text: Column) -> Column:
    """The share of letters and blanks; 0 for an empty text."""
    return F.length(F.regexp_replace(text, r"(?U)[^\p{L}\s]", "")) / F.greatest(F.length(text), F.lit(1))


def is_reference(name: Column) -> Column:
    return matches(name, REFERENCE_PATTERNS)


def has_year(text: Column) -> Column:
    return text.rlike(YEAR_1500_2029)


def mention_name(name: Column, label: Column) -> Column:
    """The name under which a mention counts: dates are cut to their first explicit date."""
    cut = F.regexp_extract(strip(name), EXPLICIT_DATE, 1)
    return F.when((label == "DATE") & (cut != ""), cut).otherwise(strip(name))


def is_entity_mention(name: Column, label: Column) -> Column:
    """Whether a recognised mention is kept; known noise terms are an anti-join besides."""
    bare = strip(name)
    return (
        label.isin(ENTITY_LABELS)
        & (F.length(bare) > 3)
        & ~is_reference(bare)
        & ~F.lower(bare).isin(COMMON_WORDS)
        & (alpha_ratio(bare) >= 0.5)
        & ((label != "DATE") | has_year(bare))
    )


def is_graph_noise(name: Column, type_: Column) -> Column:
    """Whether a node of the merged graph is noise; sources never are."""
    name = F.coalesce(name, F.lit(""))
    noisy = (
        (F.length(name) <= 3)
        | (alpha_ratio(name) < 0.5)
        | F.lower(name).isin(COMMON_WORDS)
        | ((type_ == "Date") & ~has_year(name))
        | F.endswith(name, F.lit(","))
        | matches(name, GRAPH_NOISE_PATTERNS)
    )
    return ~type_.eqNullSafe(F.lit(SOURCE_TYPE)) & F.coalesce(noisy, F.lit(True))


def is_suspicious(name: Column) -> Column:
    """Whether a node is worth a verdict; the first rule that applies decides."""
    return (
        (F.length(name) <= 5)
        | F.substring(name, -1, 1).isin(*".,;:!?)")
        | name.rlike("(?d)^[A-Z][A-Z.]+$")
        | (name.rlike("[0-9]") & name.rlike("[a-zA-Z]") & (F.length(name) < 15))
    )


def is_initials(name: Column) -> Column:
    """Initials without a surname; possessive, so that it can't backtrack."""
    return strip(name).rlike(r"(?d)^(?:[A-Z]\.?\s*+)++$")


def surname(name: Column) -> Column:
    """The last word of a name if it looks like a surname, else null."""
    last = F.element_at(F.split(strip(name), r"\s+"), -1)
    tail = F.substr(last, F.lit(2))
    good = (F.length(last) > 2) & last.rlike(r"^\p{Lu}") & tail.rlike(r"\p{Ll}") & ~tail.rlike(r"[\p{Lu}\p{Lt}]")
    return F.when(good, last)


def is_geocodable(name: Column) -> Column:
    name = F.coalesce(name, F.lit(""))
    noisy = matches(name, PLACE_NOISE_PATTERNS, "d")
    return (F.length(name) >= 3) & ~F.lower(name).isin(NON_PLACES) & ~noisy & name.rlike(r"\p{L}")
