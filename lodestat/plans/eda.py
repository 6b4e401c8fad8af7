"""Presentation statistics of the model table, one result table each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestat.functions.features import SEASONS
from lodestat.operators import charts, profile
from lodestat.operators.columns import categorical_columns, numeric_columns

# Columns kept out of the plots, the 0/1 flags and the numeric features.
DROP_COLUMNS = ["id", "name", "description", "amenities", "neighbourhood_cleansed",
                "property_room_combo", "has_description"]
FLAGS = ["has_luxury_words", "has_balcony", "has_view", "has_garden", "has_hot_tub",
         "host_is_superhost", "is_central_london"]
NUMERIC = ["accommodates", "bedrooms", "beds", "bathrooms", "review_scores_rating", "number_of_reviews",
           "reviews_per_month", "availability_30", "availability_365", "host_response_rate",
           "host_acceptance_rate", "luxury_score", "stations_within_1km", "tourist_spots_within_1km",
           "area_crime_count", "house_price", "income", "is_central_london"]
CATEGORIES = [("room_type", 10, "median"), ("property_type", 10, "median"), ("area", 20, "median"),
              ("dominant_season", 4, "alpha")]


def price_by_category(df: DataFrame, col: str, n: int, by: str, target: str = "price") -> DataFrame:
    """Box statistics of the target for the top n categories."""
    kept = profile.keep_groups(df, profile.top_groups(df, col, target, n, by), col)
    return charts.box_stats(kept, target, [col], few_groups=True)


def eda_pack(df: DataFrame, target: str = "price", first_histograms: int | None = None,
             first_pairs: int | None = None, first_categories: int | None = None,
             top_values: int | None = None, top_areas: int | None = None) -> dict[str, DataFrame]:
    """Lazy result tables by name; tables whose columns are absent are left out.

    The numbers limit what is listed, for plots; by default nothing is left out.
    """
    key = "id" if "id" in df.columns else None
    mask = {"null_mask": profile.null_mask(df, key)} if key else {}
    df = df.drop(*DROP_COLUMNS)
    numbers = [c for c in NUMERIC if c in df.columns and c in numeric_columns(df)]
    every = numeric_columns(df)
    out = {
        **mask, **profile.summary_report(df, every),
        "price_histogram": charts.histogram(df, target),
        "price_histogram_log": charts.histogram(df, F.log1p(target)),
        "price_density": charts.kde(df, target),
        "densities": charts.densities(df, every[:first_histograms]),
        "price_box": charts.box_stats(df, target),
        "price_iqr": profile.iqr_report(df, target),
        "price_violin": charts.violin(df, target),
        "histograms": charts.histogram_auto(df, every, first_histograms),
        "flag_impact": profile.flag_impact(df, FLAGS, target),
        "price_vs_numeric": charts.numeric_vs_target(df, numbers, target),
        "correlation": profile.correlation(df, [target, *numbers]),
        "top_correlates": profile.target_correlates(df, target, numbers),
        "pairs": charts.pair_bins(df, every, first=first_pairs),
    }
    for col, n, by in CATEGORIES:
        if col in df.columns:
            out[f"price_by_{col}"] = price_by_category(df, col, n, by, target)
    if {"latitude", "longitude"} <= set(df.columns):
        out["price_map"] = charts.capped_grid(df, "longitude", "latitude", target, 0.01, 0.01)
    if {"reviews_per_month", "availability_365"} <= set(df.columns):
        out["reviews_vs_availability"] = charts.capped_grid(
            df, "availability_365", "reviews_per_month", target, 5, 0.5)
    def shown(counts: DataFrame, n: int | None) -> DataFrame:
        return counts if n is None else counts.limit(n)

    for c in categorical_columns(df)[:first_categories]:
        out[f"top_values_{c}"] = shown(profile.value_counts(df, c), top_values)
    if "area" in df.columns:
        out["listings_per_area"] = shown(profile.value_counts(df, "area", keep_null=True), top_areas)
    if "dominant_season" in df.columns:
        out["listings_per_season"] = profile.ordered_counts(df, "dominant_season", SEASONS)
    return out
