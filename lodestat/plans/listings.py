"""From raw listing tables to the enriched model table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from lodestat.functions import features as fx, parse
from lodestat.operators.clean import dedup_rows, fill, fill_median, fill_mode, in_range
from lodestat.operators.columns import matching_columns
from lodestat.operators.enrich import area_averages, area_counts, attach, dominant_season
from lodestat.operators.nearby import count_within
from lodestat.operators.quantiles import qname, quantiles
from lodestat.session import attach_row

# The pinned listing columns.
LISTING_COLUMNS = [
    "id", "latitude", "longitude", "price", "accommodates", "bedrooms", "beds", "bathrooms",
    "room_type", "property_type", "neighbourhood_cleansed", "name", "description", "amenities",
    "review_scores_rating", "number_of_reviews", "reviews_per_month", "availability_365",
    "availability_30", "host_is_superhost", "host_response_rate", "host_acceptance_rate",
]
PRICE_RANGE = (20.0, 500.0)


def project_listings(raw: DataFrame) -> DataFrame:
    """The pinned columns with capacities as numbers."""
    def typed(c: str):
        if c in ("latitude", "longitude", "bathrooms"):
            return parse.to_number(c).alias(c)
        if c in ("accommodates", "bedrooms", "beds"):
            return parse.to_number(c).cast("int").alias(c)
        return F.col(c)
    return raw.select(*[typed(c) for c in LISTING_COLUMNS])


def clean_listings(raw: DataFrame, features: bool = True,
                   price_range: tuple[float, float] = PRICE_RANGE) -> DataFrame:
    """Typed listings with a readable price inside the range, and their features.

    One projection, one filter; nothing is counted or shuffled.
    """
    df = project_listings(raw).withColumns({
        "area": parse.area_key("neighbourhood_cleansed"), "price": parse.money("price")})
    df = fill(df, {"accommodates": 0, "bathrooms": 0.0, "bedrooms": 0})
    df = in_range(df, "price", *price_range)
    return listing_features(df) if features else df


def listing_features(df: DataFrame) -> DataFrame:
    df = df.withColumn("has_description", parse.presence_flag("description"))
    df = fill(df, {"description": "", "amenities": ""})
    return df.withColumns({
        "price_per_person": fx.price_per_person("price", "accommodates"),
        "is_central_london": fx.central_flag("latitude"),
        "desc_length": F.length("description"),
        "has_luxury_words": fx.mentions("description", fx.LUXURY_WORDS),
        **{name: fx.mentions("amenities", words) for name, words in fx.AMENITY_WORDS.items()},
        "property_room_combo": fx.joined_key("property_type", "room_type"),
        "luxury_score": fx.luxury_score("bathrooms", "accommodates", "bedrooms"),
    })


def enrich_listings(listings: DataFrame, calendar: DataFrame, crime: DataFrame, stations: DataFrame,
                    tourist_spots: DataFrame, income_house: DataFrame,
                    radius_km: float = 1.0) -> DataFrame:
    """Clean listings with season, crime, nearby and income columns.

    The nearby counts keep rows in place and the area tables are broadcast when
    measured small, so the only shuffle of the listings is for the season join.
    Every right side is unique on its key, so a repeated id multiplies no rows.
    """
    df = clean_listings(listings)
    season = dominant_season(calendar).withColumnRenamed("listing_id", "id")
    df = df.join(season, "id", "left")
    df = attach(df, area_counts(crime), "area", {"area_crime_count": 0})
    df = count_within(df, stations, radius_km, "stations_within_1km")
    df = count_within(df, tourist_spots, radius_km, "tourist_spots_within_1km")
    df = attach(df, area_averages(income_house), "area")
    df = fill(df, {"house_price": 0.0, "income": 0.0, "review_scores_rating": 0.0})
    return df.withColumns({"house_price": parse.whole("house_price"), "income": parse.whole("income")})


def cleanse_for_model(df: DataFrame) -> DataFrame:
    """Numbers from text, medians and mode for gaps, whole-row de-duplication."""
    if "has_description" not in df.columns:
        df = df.withColumn("has_description", parse.presence_flag("description"))
    df = fill(df, {"description": "no description provided", "reviews_per_month": 0.0})
    capacities = ["accommodates", "bedrooms", "beds", "bathrooms"]
    rates = ["host_response_rate", "host_acceptance_rate"]
    df = df.withColumns({
        **{c: parse.to_number(c) for c in capacities if c in df.columns},
        **{c: parse.percent_number(c) for c in rates}})
    superhost_text = df
    df = fill_median(df, ["bedrooms", "beds", "bathrooms", *rates])
    df = fill_mode(df, "host_is_superhost", fit_on=superhost_text)
    df = df.withColumn("host_is_superhost", parse.flag_tf("host_is_superhost"))
    return dedup_rows(df)


def eda_features(df: DataFrame) -> DataFrame:
    has = set(df.columns)
    near = F.lit(0.0)
    for c in ("stations_within_1km", "tourist_spots_within_1km"):
        if c in has:
            near = near + F.col(c) * 0.5
    return df.withColumns({
        "log_price": F.log1p("price"),
        "price_per_guest": fx.per_unit("price", "accommodates", "accommodates" in has),
        "price_per_bedroom": fx.per_unit("price", "bedrooms", "bedrooms" in has),
        "price_per_bathroom": fx.per_unit("price", "bathrooms", "bathrooms" in has),
        "value_score": fx.value_score("review_scores_rating", "price"),
        "central_score": near,
    })


def winsorise(df: DataFrame, col: str, low: float = 0.05, high: float = 0.95,
              fit_on: DataFrame | None = None) -> DataFrame:
    """Limit a column to its exact quantiles."""
    q = quantiles(fit_on if fit_on is not None else df, col, [low, high])
    ends = F.col("_p")[qname(low)], F.col("_p")[qname(high)]
    return attach_row(df, q).withColumn(col, fx.clip(F.col(col).cast("double"), *ends)).drop("_p")


def model_features(df: DataFrame, as_of: dt.date | None = None,
                   fit_on: DataFrame | None = None) -> DataFrame:
    """Features of the price model; steps apply where their columns exist.

    Price limits and the centre point come from ``fit_on`` (by default all rows).
    """
    fit_on = df if fit_on is None else fit_on
    df = winsorise(df, "price", fit_on=fit_on)
    new = {"price_log": F.log1p("price")}
    if {"latitude", "longitude"} <= set(df.columns):
        df = attach_row(df, fit_on.agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon")))
        d_lat, d_lon = F.col("latitude") - F.col("_p.lat"), F.col("longitude") - F.col("_p.lon")
        new["distance_to_center"] = F.sqrt(d_lat * d_lat + d_lon * d_lon)
    if "amenities" in df.columns:
        new["amenities_count"] = fx.list_size("amenities")
    if {"bedrooms", "bathrooms"} <= set(df.columns):
        new["bed_bath_ratio"] = fx.ratio("bedrooms", "bathrooms")
    if {"bedrooms", "accommodates"} <= set(df.columns):
        new["bedrooms_per_person"] = fx.ratio("bedrooms", "accommodates")
    reviews = matching_columns(df, "review_scores")
    if len(reviews) > 1:
        new["avg_review_score"] = fx.row_mean(reviews)
    if "host_since" in df.columns:
        since = parse.date_or_null("host_since")
        new["host_years"] = fx.tenure_years(since, as_of or dt.date.today())
    for c in ("instant_bookable", "host_is_superhost", "host_identity_verified"):
        if c in df.columns:
            new[c] = parse.flag_any(c)
    return df.withColumns(new).drop("amenities", "host_since", "_p")
