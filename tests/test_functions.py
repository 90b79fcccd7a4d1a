"""Column functions against hand-made cases."""

from __future__ import annotations

import difflib

import pytest
from pyspark.sql import functions as F

from docgraph.functions import dates, markup, names, noise
from docgraph.operators.resolve import similarity


def column(spark, values, f, ddl="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    return [r["out"] for r in sorted(df.select("i", f(F.col("v")).alias("out")).collect())]


DATES = {
    "September 2, 1945": ("1945-09-02", "1945-09-02", "day", 1945),
    "18 September 2013": ("2013-09-18", "2013-09-18", "day", 2013),
    "February 31, 1990": ("1990-02-31", "1990-02-31", "day", 1990),
    "  Sept 3 1999 and later": ("1999-09-03", "1999-09-03", "day", 1999),
    "June 1942": ("1942-06", "1942-06", "month", 1942),
    "June, 1942": ("1942-06", "1942-06", "month", 1942),
    "June and July 1994": ("1994-06", "1994-07", "month", 1994),
    "July and June 1994": ("1994-06", "1994-07", "month", 1994),
    "1976 to 1979": ("1976", "1979", "range", 1976),
    "between 1978 and 1993": ("1978", "1993", "range", 1978),
    "1979–1976": ("1976", "1979", "range", 1976),
    "the early 1860's": ("1860", "1863", "decade", 1860),
    "mid 1950's": ("1954", "1956", "decade", 1954),
    "late 1920's": ("1927", "1929", "decade", 1927),
    "1920's": ("1920", "1929", "decade", 1920),
    "the spring of 1976": ("1976-03", "1976-05", "season", 1976),
    "winter 1976": ("1976-12", "1976-02", "season", 1976),
    "Niagara Falls 1976": ("1976-09", "1976-11", "season", 1976),
    "the year 1994": ("1994", "1994", "year", 1994),
    "1976-09-12": ("1976", "1976", "year", 1976),
    "June 1-3, 1994": ("1994", "1994", "year", 1994),
    "1920’s": ("1920", "1920", "year", 1920),
    "1920s": None,
    "1500 to 1900": None,
    "Routledge": None,
    "ab": None,
    "": None,
    None: None,
    "no year at all": None,
}


def test_dates(spark):
    found = column(spark, list(DATES), dates.parse_date)
    assert [None if x is None else tuple(x) for x in found] == list(DATES.values())


def test_slugs(spark):
    values = ["Chester W. Nimitz", "U.S.S. Missouri", "  ", None, "Müller", "a--b", "ﬁn 2½"]
    assert column(spark, values, names.slug) == ["chester-w-nimitz", "u-s-s-missouri", "", "", "m-ller", "a-b", "n-2"]
    assert column(spark, values, names.slug_nfkd) == ["chester-w-nimitz", "u-s-s-missouri", "", "", "mu-ller", "a-b", "fin-21-2"]


def test_ids_types_and_predicates(spark):
    assert column(spark, ["PERSON", "FAC", "MONEY"], names.schema_type) == ["Person", "Place", "Thing"]
    assert column(spark, ["GPE", "WORK_OF_ART", "MONEY"], lambda v: names.entity_id(v, F.lit("x"))) == ["entity:place-x", "entity:creativework-x", "entity:money-x"]
    assert column(spark, ["related_to", "x", "a_bCD_e"], names.camel_case) == ["relatedTo", "x", "aBcdE"]
    assert column(spark, ["woo:commandedAt", "https://h.org/terms/bornIn", None], names.clean_predicate) == ["commanded at", "born in", ""]
    assert column(spark, ["entity:person-a-b", "x"], names.pretty_id) == ["person a b", "x"]
    assert column(spark, ["Wikipedia: Foo", "PEAR: 1995 - Bar", "Wikipedia:PDF:x"], names.topic_name) == ["Foo", "Bar", "PDF:x"]


def test_routes_and_years(spark):
    urls = ["https://a/b.MOV?x=1", "https://a/b.mp4#t", "https://a/b?c=.mp4", None]
    assert column(spark, urls, lambda v: names.route(F.lit("url"), v)) == ["video", "video", "url", "url"]
    assert column(spark, ["pear-1979-x", "ufo-2013", "a-1700-b-1999", "a-3000", "none"], names.year_from_slug) == [1979, 2013, 1999, None, None]


def test_rolling_hash(spark):
    def by_hand(text):
        h = 0
        for c in text:
            h = (h * 31 + ord(c)) & 0xFFFFFFFF
        return h - (1 << 32) if h >> 31 else h

    values = ["", "a", "entity:date-1945", "a much longer identifier that wraps around", "é"]
    assert column(spark, values, names.rolling_hash) == [by_hand(v) for v in values]


def test_resolve_id(spark):
    values = ['"entity:a"', '{"@id": "entity:b"}', "7", "null"]
    assert column(spark, values, lambda v: names.resolve_id(F.parse_json(v))) == ["entity:a", "entity:b", None, None]


@pytest.mark.parametrize(
    ("name", "label", "kept"),
    [
        ("Chester Nimitz", "PERSON", True),
        ("Chester Nimitz", "MONEY", False),
        ("abc", "ORG", False),
        ("65, 72^Gildenberg", "PERSON", False),
        ("Table 5 of it", "ORG", False),
        ("|39|2|0.777|", "ORG", False),
        ("John,", "PERSON", False),
        ("methods", "ORG", False),
        ("a1234567", "ORG", False),
        ("last March", "DATE", False),
        ("on March 5, 1995", "DATE", True),
        ("late 1995", "DATE", False),
        ("21st century", "DATE", False),
    ],
)
def test_mentions(spark, name, label, kept):
    row = spark.createDataFrame([(name, label)], "n string, l string").select(noise.is_entity_mention(F.col("n"), F.col("l")), noise.mention_name(F.col("n"), F.col("l"))).head()
    assert row[0] == kept
    if name == "on March 5, 1995":
        assert row[1] == "March 5, 1995"


def test_people_names(spark):
    assert column(spark, ["J. R. R.", "J.R.", "J. Smith", "A" * 5000 + "b"], noise.is_initials) == [True, True, False, False]
    assert column(spark, ["Ann Smith", "Bo McDonald", "Al Jahn,", "X O'brien", "Li Xu"], noise.surname) == ["Smith", None, "Jahn,", "O'brien", None]


def test_places(spark):
    values = ["New York", "NY", "the Hague", "the", "hague", "space", "Einstein-Podolski", "A & B", "a1b2", "Paris,", "12", None, "X  Y"]
    assert column(spark, values, noise.is_geocodable) == [True, False, True, False, False, False, False, False, False, False, False, False, False]


def test_markdown(spark):
    text = "# Head\n**bold** and *it* __u__ [t](u) ![](i) ![a](i) `c`"
    assert column(spark, [text], markup.strip_markdown) == ["Head\nbold and it u t  !a c"]


def test_snippets(spark):
    text = "x" * 150 + "NAME" + "y" * 150
    assert column(spark, [text], lambda v: markup.context_snippet(v, F.lit(150), F.lit(154))) == ["..." + "x" * 100 + "NAME" + "y" * 100 + "..."]
    assert column(spark, [" ab "], lambda v: markup.context_snippet(v, F.lit(1), F.lit(3))) == ["ab"]


def test_chunks_cover_the_text():
    text = ("word " * 150 + "end. ") * 20
    pieces = markup.chunk(text)
    assert "".join(pieces) == text and all(len(x) <= 2000 for x in pieces)
    assert all(x.endswith(".") for x in pieces[:-1])
    assert markup.chunk("x" * 4500) == ["x" * 2000, "x" * 2000, "x" * 500]
    assert markup.chunk("") == [""] and markup.chunk(None) == [""]


def test_links():
    page = '<a href="/a">A</a><a href="/a#x">again</a><a href="javascript:x">n</a><a href="http://o/b"><b>B</b> b</a><a>none</a><link rel="next" href="/p2"><a href="/p3">Next</a>'
    df = markup.page_links.func
    found = df(*map(__import__("pandas").Series, ([page], ["http://h/x"])))[0]
    assert found == [{"url": "http://h/a", "title": "A"}, {"url": "http://o/b", "title": "Bb"}, {"url": "http://h/p3", "title": "Next"}]
    following = markup.next_page.func(*map(__import__("pandas").Series, ([page, '<a href="/p3">NEXT</a>', "<a href='/x'>next</a>"], ["http://h/x"] * 3)))
    assert list(following) == ["http://h/p2", "http://h/p3", None]


def test_replies(spark):
    good = '[{"subject": "A", "predicate": "founded", "object": "B"}, {"subject": "A", "predicate": "flew", "object": "B", "confidence": 1.0}]'
    rows = column(spark, [good, None, "not json", '{"subject": "A"}', "[]"], markup.reply_rows)
    assert [[tuple(r) for r in x] for x in rows] == [[("A", "founded", "B", 0.0)], [], [], [], []]


def test_similarity(spark):
    pairs = [("John Kennedy", "John F. Kennedy"), ("abc", "xyz"), ("Same", "sAME")]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", similarity(F.col("a"), F.col("b")).alias("s"))
    for r in df.collect():
        assert r["s"] == difflib.SequenceMatcher(None, r["a"].lower(), r["b"].lower()).ratio()


def test_two_places(spark):
    assert column(spark, [0.125, 0.375, 2.0, None], markup.two_places, "v double") == ["0.12", "0.38", "2.00", None]


# Names chosen by hand, one for each pattern of a list in its order, so that a pattern that is wrong or lost shows.
REFERENCES = ["12, 3^ back", "[12] Smith", "p. 45", "12-19", "(12)", "a^b", "ABC", "1942", "https://x.y", "cost $5 {x}", "a|b|c", "12.5 (3)", "br>", "Fig.", "eds.", "Table 4", "Several men", "late 1940s", "18th Century", "3rd man", "ten years ago", "Smith,"]
PLACES = ["A & B Road", "123", "TX", "---", "Paris,", "(Paris", "the Table 3", "2nd Street", "a [[b", "a\nb", "Paris (12", "the Alsace-Lorraine", "see www.x", "a; b: c", "two  blanks", "paris", "7 Main 9"]


def flags(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", column(F.col("v")).alias("f")).collect()
    return [r["f"] for r in sorted(rows)]


def test_each_pattern_of_the_lists(spark):
    assert len(REFERENCES) == len(noise.REFERENCE_PATTERNS) and len(PLACES) == len(noise.PLACE_NOISE_PATTERNS)
    for examples, patterns, letters in ((REFERENCES, noise.REFERENCE_PATTERNS, "dU"), (PLACES, noise.PLACE_NOISE_PATTERNS, "d")):
        for example, pattern in zip(examples, patterns, strict=True):
            assert flags(spark, [example, "Robert Jahn"], lambda c, p=pattern, x=letters: noise.matches(c, [p], x)) == [True, False], pattern
    assert flags(spark, REFERENCES, noise.is_reference) == [True] * len(REFERENCES)
    assert not any(flags(spark, PLACES, noise.is_geocodable))
    assert flags(spark, ["Robert Jahn", "Princeton University", "the Pentagon", "May 1942"], noise.is_reference) == [False] * 4
    assert flags(spark, ["Princeton", "New York", "the Netherlands", "São Paulo", "bayesian", "Quanta", "ab"], noise.is_geocodable) == [True, True, True, True, False, False, False]


def test_word_lists_are_whole():
    assert len(noise.COMMON_WORDS) == len(set(noise.COMMON_WORDS)) and {"east", "manuscript", "workshop", "seminar", "proceedings"} <= set(noise.COMMON_WORDS)
    assert len(noise.NON_PLACES) == len(set(noise.NON_PLACES)) and {"alternatively", "quanta", "global", "sigma"} <= set(noise.NON_PLACES)
