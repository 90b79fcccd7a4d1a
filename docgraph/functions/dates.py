"""Free-text dates as partial ISO dates with a precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docgraph.functions.names import lookup, strip

# Months by full and short name, and the months of seasons in order.
_MONTH_NAMES = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
MONTHS = {name: i for i, name in enumerate(_MONTH_NAMES, 1)} | {name[:3]: i for i, name in enumerate(_MONTH_NAMES, 1)} | {"sept": 9}
SEASONS = {"spring": (3, 5), "summer": (6, 8), "autumn": (9, 11), "fall": (9, 11), "winter": (12, 2)}
FIRST_YEAR, LAST_YEAR = 1800, 2100

_DAY_FIRST = r"(?U)^(\d{1,2})\s+(\w+),?\s+(\d{4})"
_MONTH_FIRST = r"(?U)^(\w+)\s+(\d{1,2}),?\s+(\d{4})"
_MONTH_YEAR = r"(?dU)^(\w+),?\s+(\d{4})$"
_TWO_MONTHS = r"(?U)^(\w+)\s+and\s+(\w+),?\s+(\d{4})"
_YEAR = r"(?U)\b(\d{4})\b"
_RANGE = r"(\d{4})\s*(?:to|and|[-–—])\s*(\d{4})"
_DECADE = r"(early|mid|late)?\s*(\d{4})(?:'?s)"


def _in_bounds(year: Column) -> Column:
    return year.between(FIRST_YEAR, LAST_YEAR)


def _two(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def parse_date(text: Column) -> Column:
    """struct(iso_start, iso_end, precision, year), or null if there is no date.

    The first rule that applies decides: month day year, day month year, month
    year, two months of a year, then by the first free-standing number of four
    digits a range, a decade, a season or the plain year. Days aren't checked
    against months, and winter ends before it starts; both are meant.
    """
    t = F.lower(strip(text))

    def parts(pattern: str, n: int) -> Column:
        return F.array(*(F.regexp_extract(t, pattern, i) for i in range(1, n + 1)))

    found = F.struct(
        t.alias("t"),
        parts(_MONTH_FIRST, 3).alias("month_first"),
        parts(_DAY_FIRST, 3).alias("day_first"),
        parts(_MONTH_YEAR, 2).alias("month_year"),
        parts(_TWO_MONTHS, 3).alias("two_months"),
        F.regexp_extract(t, _YEAR, 1).try_cast("int").alias("year"),
        parts(_RANGE, 2).alias("range"),
        parts(_DECADE, 2).alias("decade"),
    )
    # Bound once: the rules look at each part several times.
    return F.transform(F.array(found), _decide)[0]


def _decide(found: Column) -> Column:
    t, year = found["t"], found["year"]

    def number(key: str, at: int) -> Column:
        return found[key][at].try_cast("int")

    def month(key: str, at: int) -> Column:
        return lookup(found[key][at], MONTHS, F.lit(None).cast("int"))

    def date(start: Column, end: Column, precision: str, year: Column) -> Column:
        return F.struct(start.alias("iso_start"), end.alias("iso_end"), F.lit(precision).alias("precision"), year.cast("int").alias("year"))

    def four(year: Column) -> Column:
        return F.lpad(year.cast("string"), 4, "0")

    def day_rule(key: str, month_at: int, day_at: int) -> Column:
        m, d, y = month(key, month_at), number(key, day_at), number(key, 2)
        iso = F.concat_ws("-", four(y), _two(m), _two(d))
        return F.when(m.isNotNull() & d.between(1, 31) & _in_bounds(y), date(iso, iso, "day", y))

    m, y = month("month_year", 0), number("month_year", 1)
    iso = F.concat_ws("-", four(y), _two(m))
    month_rule = F.when(m.isNotNull() & _in_bounds(y), date(iso, iso, "month", y))

    m1, m2, y = month("two_months", 0), month("two_months", 1), number("two_months", 2)
    months_rule = F.when(
        m1.isNotNull() & m2.isNotNull() & _in_bounds(y),
        date(F.concat_ws("-", four(y), _two(F.least(m1, m2))), F.concat_ws("-", four(y), _two(F.greatest(m1, m2))), "month", y),
    )

    y1, y2 = number("range", 0), number("range", 1)
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    range_rule = F.when(_in_bounds(y1) & _in_bounds(y2), date(four(low), four(high), "range", low))

    qualifier, base = found["decade"][0], F.floor(number("decade", 1) / 10).cast("int") * 10
    begin = base + lookup(qualifier, {"late": 7, "mid": 4}, F.lit(0))
    end = base + lookup(qualifier, {"early": 3, "mid": 6}, F.lit(9))
    decade_rule = F.when(base.isNotNull(), date(begin.cast("string"), end.cast("string"), "decade", begin))

    seasons = [
        F.when(F.contains(t, F.lit(s)), date(F.concat(four(year), F.lit(f"-{a:02d}")), F.concat(four(year), F.lit(f"-{b:02d}")), "season", year))
        for s, (a, b) in SEASONS.items()
    ]
    plain = date(four(year), four(year), "year", year)
    by_year = F.when(_in_bounds(year), F.coalesce(range_rule, decade_rule, *seasons, plain))

    none = (F.length(t) < 3) | t.rlike(r"^\p{L}+$")
    return F.when(~none, F.coalesce(day_rule("month_first", 0, 1), day_rule("day_first", 1, 0), month_rule, months_rule, by_year))
