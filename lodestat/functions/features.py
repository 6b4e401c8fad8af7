"""Engineered listing features as column expressions."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, functions as F

from lodestat.functions.parse import as_col

# The keyword lists behind the text flags.
LUXURY_WORDS = ["luxury", "penthouse", "stunning", "designer", "premium", "view", "balcony", "central"]
AMENITY_WORDS = {
    "has_balcony": ["balcony"],
    "has_view": ["view"],
    "has_garden": ["garden"],
    "has_hot_tub": ["hot tub", "jacuzzi"],
}
# Months of each season; the rest of the year is autumn.
SEASON_MONTHS = {"winter": [12, 1, 2], "spring": [3, 4, 5], "summer": [6, 7, 8]}
SEASONS = ["winter", "spring", "summer", "autumn"]


def mentions(c: str | Column, words: list[str], whole_word: bool = False) -> Column:
    """1 if the text contains any of the words, ignoring case."""
    text = F.lower(as_col(c))
    if whole_word:
        return text.rlike(rf"\b(?:{'|'.join(words)})\b").cast("int")
    # Plain substring search is cheaper than a regular expression.
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words]).cast("int")


def season(date: str | Column) -> Column:
    """Season of a date; an unknown date counts as autumn."""
    m = F.month(as_col(date))
    c = F
    for name, months in SEASON_MONTHS.items():
        c = c.when(m.isin(months), name)
    return c.otherwise("autumn")


def booked(available: str | Column) -> Column:
    return F.when(as_col(available) == "f", 1).otherwise(0)


def joined_key(*cols: str) -> Column:
    return F.concat_ws("_", *cols)


def luxury_score(bathrooms: str, accommodates: str, bedrooms: str) -> Column:
    return F.col(bathrooms) * 0.4 + F.col(accommodates) * 0.3 + F.col(bedrooms) * 0.2


def price_per_person(price: str, accommodates: str) -> Column:
    a = F.col(accommodates)
    return F.round(F.when(a > 0, F.col(price) / (a + 0.1)).otherwise(0.0), 2)


def central_flag(latitude: str, low: float = 51.50, high: float = 51.52) -> Column:
    lat = F.col(latitude)
    return ((lat > low) & (lat < high)).cast("int")


def per_unit(price: str, unit: str, present: bool = True) -> Column:
    """Price over unit + 1; a column the table does not have counts as 1."""
    return F.col(price) / ((F.col(unit) if present else F.lit(1)) + 1)


def value_score(rating: str, price: str) -> Column:
    return F.col(rating) / (F.col(price) + 1)


def ratio(num: str, den: str, pad: float = 0.1) -> Column:
    return F.col(num) / (F.col(den) + pad)


def list_size(c: str) -> Column:
    """Items of a comma-separated text; a missing or empty text counts as one."""
    return F.size(F.split(F.coalesce(F.col(c), F.lit("nan")), ","))


def tenure_years(since: Column, as_of: dt.date) -> Column:
    """Whole days up to ``as_of``, in years of 365 days."""
    return F.datediff(F.lit(as_of), since) / 365


def row_mean(cols: list[str]) -> Column:
    """Mean of the non-null values in a row; null when there are none."""
    total, n = F.lit(0.0), F.lit(0)
    for name in cols:
        c = F.col(name)
        total = total + F.coalesce(c.cast("double"), F.lit(0.0))
        n = n + c.isNotNull().cast("int")
    return F.try_divide(total, n)


def clip(c: str | Column, low: Column, high: Column) -> Column:
    """Limit to [low, high]; a null stays null (least and greatest would skip it)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, low), high))


def cap(c: str | Column, high: Column) -> Column:
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(c, high))
