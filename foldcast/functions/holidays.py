"""Holiday rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Dates of public holidays per region.
FIXED_DATE = [
    # (region, holiday, month, day)
    ("GLOBAL", "New Year", 1, 1),
    ("GLOBAL", "Christmas", 12, 25),
    ("US", "Independence Day", 7, 4),
    ("US", "Veterans Day", 11, 11),
]
NTH_WEEKDAY = [
    # (region, holiday, month, weekday, which one)
    ("US", "Martin Luther King Day", 1, "Mon", 3),
    ("US", "Presidents Day", 2, "Mon", 3),
    ("US", "Labor Day", 9, "Mon", 1),
    ("US", "Columbus Day", 10, "Mon", 2),
    ("US", "Thanksgiving", 11, "Thu", 4),
]
LAST_WEEKDAY = [
    # (region, holiday, month, weekday)
    ("US", "Memorial Day", 5, "Mon"),
]
EASTER = [("GLOBAL", "Easter")]
REGIONS = ["GLOBAL", "US"]


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus)."""
    def div(a, b):
        return F.floor(a / b)

    a, b, c = year % 19, div(year, 100), year % 100
    h = (19 * a + b - div(b, 4) - div(b - div(b + 8, 25) + 1, 3) + 15) % 30
    x = (32 + 2 * (b % 4) + 2 * div(c, 4) - h - c % 4) % 7
    m = div(a + 11 * h + 22 * x, 451)
    n = h + x - 7 * m + 114
    return F.make_date(year, div(n, 31).cast("int"), (n % 31 + 1).cast("int"))


def in_year(year: Column, regions: list[str]) -> Column:
    """The holidays of one year as ``array<struct<holiday, region, day>>``."""
    def entry(region: str, name: str, day: Column) -> Column:
        return F.struct(F.lit(name).alias("holiday"), F.lit(region).alias("region"),
                        day.alias("day"))

    def first_of(month: int) -> Column:
        return F.make_date(year, F.lit(month), F.lit(1))

    entries = []
    for region, name, month, day in FIXED_DATE:
        entries.append(entry(region, name, F.make_date(year, F.lit(month), F.lit(day))))
    for region, name, month, weekday, which in NTH_WEEKDAY:
        first = F.next_day(F.date_sub(first_of(month), 1), weekday)
        entries.append(entry(region, name, F.date_add(first, 7 * (which - 1))))
    for region, name, month, weekday in LAST_WEEKDAY:
        past = F.next_day(F.last_day(first_of(month)), weekday)
        entries.append(entry(region, name, F.date_sub(past, 7)))
    for region, name in EASTER:
        entries.append(entry(region, name, easter(year)))
    return F.filter(F.array(*entries), lambda e: e["region"].isin(regions))
