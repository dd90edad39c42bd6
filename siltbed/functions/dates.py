"""Dates, partial dates and windows of dates as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_LOW, YEAR_HIGH = 1800, 2100
ISO_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"


def scene_matches(resolution, cloud, captured, most_resolution=None, most_cloud=None, start=None, end=None) -> Column:
    """Fine and clear enough (an unknown cloud cover passes) and captured in the window; None asks for nothing."""
    out = F.lit(True)
    if most_resolution is not None:
        out = out & (resolution <= most_resolution)
    if most_cloud is not None:
        out = out & (cloud.isNull() | (cloud <= most_cloud))
    if start is not None:
        out = out & captured.between(F.lit(start), F.lit(end))
    return out


def primary_dates(dates: dict[str, Column], permit: bool = False) -> Column:
    """The dates that count for an operation: a permit's own, else the works' stages, else when it was recorded."""
    recorded = F.array(dates["recorded"])
    if permit:
        own = F.array(dates["permit"])
    else:
        own = F.array(dates["started"], dates["completed"], dates["opened"])
    found = F.filter(own, lambda d: d.isNotNull())
    return F.when(F.size(found) > 0, found).otherwise(F.filter(recorded, lambda d: d.isNotNull()))


def any_in_window(dates: Column, start: Column, end: Column) -> Column:
    """Some date is in the window; without dates a record passes."""
    return (F.size(dates) == 0) | F.exists(dates, lambda d: d.between(start, end))


def captured_bounds(text: Column) -> tuple[Column, Column]:
    """First and last day that a capture note allows: a day, a year, or the span of all years named; else null."""
    day = F.try_to_date(F.regexp_extract(text, ISO_DAY, 0), "yyyy-MM-dd")
    years = F.transform(F.regexp_extract_all(text, F.lit(r"\b([0-9]{4})\b"), F.lit(1)), lambda y: y.cast("int"))
    years = F.filter(years, lambda y: y.between(YEAR_LOW, YEAR_HIGH))
    low, high = F.array_min(years), F.array_max(years)
    return F.coalesce(day, F.make_date(low, F.lit(1), F.lit(1))), F.coalesce(day, F.make_date(high, F.lit(12), F.lit(31)))


def captured_in(text: Column, start: Column, end: Column) -> Column:
    """Whether the days that a capture note allows touch a window; a note without a date does not."""
    low, high = captured_bounds(text)
    return F.coalesce((low <= end) & (high >= start), F.lit(False))


# Names of seasons, each with its first and last month; one that ends in an earlier month ends a year later.
SEASONS = (
    (("wet", "wet season", "monsoon", "wetseason", "湿季", "汛期", "雨季"), 6, 9), (("dry", "dry season", "dryseason", "旱季", "枯水期"), 12, 3), (("summer", "夏季"), 6, 8),
    (("winter", "冬季"), 12, 2), (("spring", "春季"), 3, 5), (("autumn", "fall", "秋季"), 9, 11),
)
BETWEEN = r"\s*(?:[-–—至到])\s*"
DAYS_BETWEEN = r"\s*(?:(?i:to)|/|[-–—至到])\s*"


def window_of(text: Column) -> Column:
    """Struct (start, end) of the days that a text asks for; null where it names no time.

    A season with the first year that it names; a year; a decade (1990s, 1990's, 1990年代); two years; a day; two days. Of a
    season without a year, of a day that does not exist and of a window that ends before it begins, nothing is known.
    """
    own = F.trim(text)
    low = F.lower(own)

    def part(pattern: str, i: int = 1) -> Column:
        return F.nullif(F.regexp_extract(own, f"^{pattern}$", i), F.lit(""))

    def span(start: Column, end: Column) -> Column:
        return F.when(start <= end, F.struct(start.alias("start"), end.alias("end")))

    def years(first: Column, last: Column) -> Column:
        return span(F.make_date(first.cast("int"), F.lit(1), F.lit(1)), F.make_date(last.cast("int"), F.lit(12), F.lit(31)))

    named = F.nullif(F.regexp_extract(own, r"\b(1[0-9]{3}|20[0-9]{2})\b", 1), F.lit("")).cast("int")
    season = None
    for i, (names, _, _) in enumerate(SEASONS):
        said = F.lit(False)
        for name in names:
            said = said | F.contains(low, F.lit(name))
        season = F.when(said, F.lit(i)) if season is None else season.when(said, F.lit(i))
    held = F.lit(None)
    for i, (_, first, last) in enumerate(SEASONS):
        end = F.last_day(F.make_date(named + int(last < first), F.lit(last), F.lit(1)))
        held = F.when(season == i, span(F.make_date(named, F.lit(first), F.lit(1)), end)).otherwise(held)
    year, decade = part("([0-9]{4})"), part(r"([0-9]{3})0(?:\s*年代|(?i:'s|s))")
    two = rf"([0-9]{{4}}){BETWEEN}([0-9]{{4}})"
    day, days = rf"({ISO_DAY})", rf"({ISO_DAY}){DAYS_BETWEEN}({ISO_DAY})"

    def date(value: Column) -> Column:
        return F.try_to_date(value, "yyyy-MM-dd")

    plain = F.coalesce(
        years(year, year), years(F.concat(decade, F.lit("0")), F.concat(decade, F.lit("9"))), years(part(two), part(two, 2)), span(date(part(day)), date(part(day))), span(date(part(days)), date(part(days, 2)))
    )
    return F.when(season.isNotNull(), held).otherwise(plain)
