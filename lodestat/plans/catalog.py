"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestat.functions import features as fx, parse
from lodestat.functions.hashing import fold_of, pick
from lodestat.operators import (
    charts, clean, cluster, columns, distinct, encode, enrich, metrics, mlp, nearby, profile, search)
from lodestat.plans import eda, listings as pl, pricing, segmentation
from lodestat.session import settle, settle_table
from lodestat.sources.fixtures import table, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Trim float noise so that two engines can be compared."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- listings -------------------------------------------------------------------------------

@query
def enriched_listings(spark, sf):
    parts = [view(spark, sf, n) for n in
             ("listings", "calendar", "crime", "stations", "tourist_spots", "income_house")]
    return rounded(pl.enrich_listings(*parts), 6, "luxury_score")


@query
def money_clean_filter(spark, sf):
    df = view(spark, sf, "listings").select("id", parse.money("price").alias("price"))
    return clean.in_range(clean.drop_missing(df, "price"), "price", *pl.PRICE_RANGE)


@query
def row_funnel(spark, sf):
    df = view(spark, sf, "listings").select(parse.money("price").alias("price"))
    return clean.funnel(df, [("price_known", F.col("price").isNotNull()),
                             ("price_in_range", F.col("price").between(*pl.PRICE_RANGE))])


@query
def listing_projection(spark, sf):
    return pl.project_listings(view(spark, sf, "listings"))


@query
def model_columns(spark, sf):
    df = columns.rename(pl.clean_listings(view(spark, sf, "listings")), {"number_of_reviews": "reviews_total"})
    df = columns.drop_present(columns.drop_leakage(df), "beds", "no_such_column")
    wanted = columns.numeric_columns(df, exclude=()) + columns.matching_columns(df, "^REVIEW")
    return rounded(df.select(*columns.distinct_list(wanted)), 6, "luxury_score")


@query
def keyed_alignment(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"))
    left = df.select("id", "price", "luxury_score")
    right = df.select("id", "desc_length", "property_room_combo")
    return rounded(left.join(right, "id"), 6, "luxury_score")


@query
def preview(spark, sf):
    return profile.head(view(spark, sf, "listings").select("id", "price", "room_type", "name"), "id")


@query
def listing_features(spark, sf):
    return rounded(pl.clean_listings(view(spark, sf, "listings")), 6, "luxury_score")


@query
def listings_without_features(spark, sf):
    return pl.clean_listings(view(spark, sf, "listings"), features=False)


@query
def cleanse_for_model(spark, sf):
    return pl.cleanse_for_model(view(spark, sf, "listings"))


@query
def eda_features(spark, sf):
    df = pl.eda_features(pl.clean_listings(view(spark, sf, "listings")))
    names = ["log_price", "price_per_guest", "price_per_bedroom", "price_per_bathroom",
             "value_score", "central_score"]
    return rounded(df.select("id", "price", *names), 6, *names)


@query
def model_features(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"), features=False)
    df = df.withColumn("review_scores_value", F.col("review_scores_rating") / 2)
    df = pl.model_features(df)
    names = ["price", "price_log", "distance_to_center", "bed_bath_ratio", "bedrooms_per_person",
             "avg_review_score"]
    return rounded(df.select("id", "amenities_count", "host_is_superhost", *names), 6, *names)


@query
def dominant_season(spark, sf):
    return enrich.dominant_season(view(spark, sf, "calendar"))


@query
def suffix_group_count(spark, sf):
    return enrich.area_counts(view(spark, sf, "crime"))


@query
def borough_averages(spark, sf):
    return rounded(enrich.area_averages(view(spark, sf, "income_house")), 4, "house_price", "income")


def _near(spark, sf, strategy):
    df = view(spark, sf, "listings").select("id", "latitude", "longitude")
    stations = view(spark, sf, "stations")
    for km in (1, 3):
        df = nearby.count_within(df, stations, km, f"within_{km}km", strategy=strategy)
    return df.select("id", "within_1km", "within_3km")


@query
def points_within_radius(spark, sf):
    return _near(spark, sf, "auto")


@query
def points_within_radius_grid(spark, sf):
    return _near(spark, sf, "shuffle")


@query
def left_join_zero_fill(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf, "labels")
    df = docs.join(labels, "doc_id", "left").fillna({"quality": 0, "toxic": 0})
    per_source = enrich.group_count(table(spark, sf, "documents").where("lang = 'en'"), "source", "n_en")
    return enrich.attach(df, per_source, "source", {"n_en": 0})


@query
def top_season_by_window(spark, sf):
    days = view(spark, sf, "calendar").select(
        "listing_id", fx.season("date").alias("season"), fx.booked("available").alias("booked"))
    counts = days.groupBy("listing_id", "season").agg(F.sum("booked").alias("booked_days"))
    return enrich.top_per_key(counts, "listing_id", "booked_days", "season", "dominant_season")


# --- cleansing ------------------------------------------------------------------------------

@query
def median_fill(spark, sf):
    df = view(spark, sf, "listings").select(
        "id", "bedrooms", "beds", "bathrooms",
        parse.percent_number("host_response_rate").alias("host_response_rate"))
    return clean.fill_median(df, ["bedrooms", "beds", "bathrooms", "host_response_rate"])


@query
def mode_fill(spark, sf):
    df = view(spark, sf, "listings").select("id", "host_is_superhost", "accommodates")
    return clean.fill_mode(clean.fill_mode(df, "host_is_superhost"), "accommodates")


@query
def percent_fractions(spark, sf):
    return view(spark, sf, "listings").select(
        "id", *[F.round(parse.percent_fraction(c), 6).alias(c) for c in encode.RATE_COLUMNS])


@query
def null_profile(spark, sf):
    return profile.null_profile(view(spark, sf, "listings"))


@query
def null_mask(spark, sf):
    return profile.null_mask(view(spark, sf, "listings"), "id", 20)


@query
def text_flags(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", F.length("text").alias("text_length"),
        fx.mentions("text", fx.LUXURY_WORDS).alias("has_luxury_words"),
        fx.mentions("text", ["view", "the"], whole_word=True).alias("has_whole_word"),
        *[fx.mentions("text", w).alias(n) for n, w in fx.AMENITY_WORDS.items()])


@query
def dedup(spark, sf):
    return clean.dedup_rows(table(spark, sf, "documents").select("text", "lang"))


@query
def duplicate_rows(spark, sf):
    return clean.duplicate_count(table(spark, sf, "documents").select("text", "lang"))


@query
def dedup_events(spark, sf):
    """Different rows by type: of user, type and hour, and of all columns, times with their microseconds."""
    events = table(spark, sf, "events")
    few = clean.dedup_rows(events.select("user_id", "event_type", F.date_trunc("hour", "ts").alias("ts")))
    every = clean.dedup_rows(events.drop("event_id"))
    count = lambda df, name: df.groupBy("event_type").agg(F.count(F.lit(1)).alias(name))
    return count(few, "by_hour").join(count(every, "by_all"), "event_type")


@query
def host_tenure(spark, sf):
    """Years since a text date, some of them unreadable."""
    hosts = view(spark, sf, "hosts")
    return hosts.select("id", F.round(fx.tenure_years(parse.date_or_null("host_since"), dt.date(2025, 1, 1)), 6).alias("tenure"))


# --- statistics -----------------------------------------------------------------------------

@query
def winsorise(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rounded(pl.winsorise(df, "l_extendedprice"), 4, "l_extendedprice")


@query
def iqr_report(spark, sf):
    out = profile.iqr_report(table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(out, 4, "q1", "median", "q3", "iqr", "lower", "upper", "outlier_pct")


@query
def describe_table(spark, sf):
    out = profile.describe(table(spark, sf, "lineitem"), LINE_NUMBERS)
    return rounded(out, 4, "mean", "std", "min", "p25", "p50", "p75", "max")


@query
def top_categories_by_median(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"), features=False)
    top = profile.top_groups(df, "property_type", "price", 10)
    kept = profile.keep_groups(df, top, "property_type")
    return rounded(profile.group_median(kept, "property_type", "price"), 4, "median")


@query
def first_categories(spark, sf):
    return profile.top_groups(view(spark, sf, "listings"), "property_type", "price", 10, by="alpha")


@query
def top_categories_by_count(spark, sf):
    return profile.top_groups(view(spark, sf, "listings"), "neighbourhood_cleansed", "price", 20, by="count")


@query
def value_counts(spark, sf):
    return rounded(profile.value_counts(view(spark, sf, "listings"), "amenities", normalize=True), 6, "share")


@query
def value_counts_with_null(spark, sf):
    return profile.value_counts(view(spark, sf, "listings"), "amenities", keep_null=True)


@query
def flag_impact(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"))
    df = df.withColumn("host_is_superhost", parse.flag_tf("host_is_superhost"))
    return rounded(profile.flag_impact(df, eda.FLAGS, "price"), 4, "median", "mean")


@query
def season_counts_ordered(spark, sf):
    return profile.ordered_counts(enrich.dominant_season(view(spark, sf, "calendar")),
                                  "dominant_season", fx.SEASONS)


@query
def group_mean_profile(spark, sf):
    out = profile.group_means(table(spark, sf, "lineitem"), "l_returnflag", LINE_NUMBERS)
    return rounded(out, 4, *LINE_NUMBERS)


@query
def correlation_matrix(spark, sf):
    return rounded(profile.correlation(table(spark, sf, "lineitem"), LINE_NUMBERS + ["l_linenumber"]), 6, "r")


@query
def target_correlates(spark, sf):
    df = table(spark, sf, "lineitem")
    out = profile.target_correlates(df, "l_extendedprice", LINE_NUMBERS + ["l_linenumber", "l_suppkey"])
    return rounded(out, 6, "r")


@query
def drop_constant(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_tax", (F.col("l_quantity") * 0).alias("nothing"),
        F.when(F.col("l_discount") < 0, 1).alias("never"))
    return columns.drop_constant(df)


@query
def table_shape(spark, sf):
    return profile.table_shape(table(spark, sf, "orders"))


@query
def column_profile(spark, sf):
    return profile.column_profile(table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
        {"o_orderkey": ("Orders", "Unique order number")})


@query
def row_mean(spark, sf):
    df = table(spark, sf, "lineitem")
    mean = fx.row_mean(columns.matching_columns(df, "l_(quantity|discount|tax)"))
    return df.select("l_orderkey", "l_linenumber", F.round(mean, 6).alias("row_mean"))


# --- plot tables ----------------------------------------------------------------------------

@query
def column_densities(spark, sf):
    out = charts.densities(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select("feature", "point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query
def histogram(spark, sf):
    return rounded(charts.histogram(table(spark, sf, "lineitem"), "l_extendedprice"), 4, "bin_lo")


@query
def histogram_log(spark, sf):
    return rounded(charts.histogram(table(spark, sf, "events"), F.log1p("value")), 6, "bin_lo")


@query
def histogram_auto(spark, sf):
    return charts.histogram_auto(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query
def kde_grid(spark, sf):
    return rounded(charts.kde(table(spark, sf, "events"), "value"), 8, "x", "density")


@query
def violin(spark, sf):
    out = charts.violin(table(spark, sf, "lineitem"), "l_quantity")
    return rounded(out, 8, "x", "density", "q1", "median", "q3")


@query
def box_stats(spark, sf):
    out = charts.box_stats(table(spark, sf, "events"), "value", ["event_type"])
    return rounded(out, 6, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def box_stats_overall(spark, sf):
    out = charts.box_stats(table(spark, sf, "lineitem"), "l_extendedprice")
    return rounded(out, 4, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def hexbin(spark, sf):
    return charts.hexbin(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")


@query
def pair_bins(spark, sf):
    return charts.pair_bins(table(spark, sf, "lineitem"), LINE_NUMBERS)


@query
def numeric_vs_target(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("discount_band", F.floor(F.col("l_discount") * 50))
    out = charts.numeric_vs_target(df, ["discount_band", "l_quantity", "l_tax"], "l_extendedprice")
    return rounded(out, 4, "q1", "median", "q3")


@query
def geo_price_grid(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"), features=False)
    return rounded(charts.capped_grid(df, "longitude", "latitude", "price", 0.05, 0.05), 6, "mean_value")


@query
def capped_points(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"), features=False)
    return rounded(charts.capped_points(df, "longitude", "latitude", "price"), 6, "v")


@query
def availability_review_grid(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"), features=False)
    return rounded(charts.capped_grid(
        df, "availability_365", "reviews_per_month", "price", 30, 1), 6, "mean_value")


# --- encoding -------------------------------------------------------------------------------

def _sides(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"))
    return encode.split(df, "id")


@query
def freq_encode(spark, sf):
    train, test = _sides(spark, sf)
    shares = encode.frequency_table(train, "property_type")
    both = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    out = encode.frequency_encode(both.select("id", "side", "property_type"), shares, "property_type", "share")
    return rounded(out.select("id", "side", "share"), 6, "share")


@query
def one_hot(spark, sf):
    train, test = _sides(spark, sf)
    found = encode.levels(train, ["room_type"])
    hot = encode.one_hot_columns("room_type", found["room_type"])
    return test.select("id", *[c.alias(n) for n, c in hot.items()])


@query
def cardinality_route(spark, sf):
    train, _ = _sides(spark, sf)
    cols = ["room_type", "property_type", "area", "property_room_combo", "host_is_superhost"]
    counts = distinct.distinct_counts(train, cols)
    return counts.withColumn(
        "encoding", F.when(F.col("n_distinct") > encode.MAX_LEVELS, "frequency").otherwise("one_hot"))


@query
def split_assign(spark, sf):
    df = view(spark, sf, "listings")
    return df.select("id", encode.is_test_row("id").cast("int").alias("is_test"))


@query
def fold_assign(spark, sf):
    df = view(spark, sf, "listings").select("id")
    for k in (3, 4, 5):
        df = df.withColumn(f"fold_of_{k}", encode.fold_of("id", k))
    return df


@query
def encode_matrix(spark, sf):
    train, test = _sides(spark, sf)
    keep = ["id", "price", "accommodates", "bathrooms", "room_type", "property_type", "host_response_rate"]
    encoder = encode.FeatureEncoder(target="price").fit(train.select(*keep))
    out = encoder.transform(test.select(*keep))
    names = [f"f{i}" for i in range(len(encoder.feature_names))]
    return out.select("id", *[F.round(F.col("features")[i], 6).alias(n) for i, n in enumerate(names)], "y")


# --- embeddings: scaling, clusters, projections ---------------------------------------------

SIZE = 64
DIMS = [f"d{i}" for i in range(SIZE)]


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


@query
def standard_scale(spark, sf):
    scaled = encode.scale_array(_embeddings(spark, sf), "x")
    return scaled.select("vec_id", *[F.round(F.col("x")[i], 6).alias(d) for i, d in enumerate(DIMS)])


@query
def standard_scale_columns(spark, sf):
    return rounded(encode.standard_scale(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *LINE_NUMBERS), LINE_NUMBERS), 6, *LINE_NUMBERS)


@query
def kmeans_assign(spark, sf):
    df = _embeddings(spark, sf)
    out = cluster.assign_nearest(df, cluster.group_centres(df, "label", "x"), "x")
    return rounded(out.select("vec_id", "cluster", "distance"), 6, "distance")


@query
def kmeans_inertia(spark, sf):
    df = _embeddings(spark, sf)
    out = cluster.assign_nearest(df, cluster.group_centres(df, "label", "x"), "x")
    return out.agg(F.round(F.sum("distance"), 4).alias("inertia"), F.count(F.lit(1)).alias("n"))


@query
def silhouette_exact(spark, sf):
    out = cluster.silhouette_exact(_embeddings(spark, sf), "vec_id", "x", "label")
    return rounded(out, 6, "a", "b", "silhouette")


@query
def silhouette_squared(spark, sf):
    return rounded(cluster.silhouette_squared(_embeddings(spark, sf), "x", "label"), 6, "silhouette_squared")


def _clustered_listings(spark, sf):
    df = pl.clean_listings(view(spark, sf, "listings"))
    df = nearby.count_within(df, view(spark, sf, "stations"), 1.0, "stations_within_1km")
    return pl.eda_features(df)


SEGMENT_COLUMNS = ["log_price", "value_score", "accommodates", "central_score"]


@query
def segment_labels(spark, sf):
    df = _clustered_listings(spark, sf)
    labelled, _ = cluster.segment_rows(df, "room_type", SEGMENT_COLUMNS)
    return rounded(labelled, 6, *SEGMENT_COLUMNS)


@query
def segment_counts(spark, sf):
    df = _clustered_listings(spark, sf).select("id", "room_type", *SEGMENT_COLUMNS)
    _, rows = cluster.segment_rows(df, "room_type", SEGMENT_COLUMNS)
    return cluster.segment_counts(rows)


def _points(spark, sf):
    return encode.scale_array(_embeddings(spark, sf), "x").select("vec_id", "x")


@query
def pca_ratios(spark, sf):
    return cluster.pca_ratios(_points(spark, sf), SIZE)


@query
def pca_projection(spark, sf):
    return cluster.pca_project(_points(spark, sf)).drop("x")


@query
def kmeans_elbow(spark, sf):
    points = settle(_points(spark, sf))
    return cluster.elbow_table(points, "x", cluster.kmeans_fits(points, "vec_id", "x", range(2, 8)))


@query
def segmentation_report(spark, sf):
    """Every table of the report, with all restarts and cluster counts, as one long table."""
    return long_tables(segmentation.segmentation_report(pl.clean_listings(view(spark, sf, "listings"))))


def long_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(part, row, column, value): all tables in one; a row is known by its digest, and doubles are rounded."""
    out = []
    for name, df in tables.items():
        df = df.select(*[F.round(f"`{c}`", 6).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns])
        # Beside the explode, the digest of a row would be computed again for each of its cells.
        whole = df.select(F.lit(name).alias("part"), clean.row_digest(df).alias("row"), cells.alias("cells"))
        out.append(whole.select("part", "row", F.explode("cells").alias("cell")).select("part", "row", "cell.column", "cell.value"))
    return reduce(DataFrame.unionByName, out)


# --- models ---------------------------------------------------------------------------------

def fixed_network(size: int = SIZE, hidden: int = 4) -> mlp.MLPModel:
    """A small network with weights set by a formula, for checking the forward pass."""
    w1 = [[((i * 7 + j * 13) % 11 - 5) / 8 for j in range(hidden)] for i in range(size)]
    b1 = [(j - 1) / 4 for j in range(hidden)]
    w2 = [(j + 1) / 2 for j in range(hidden)]
    flat = np.array([w for row in w1 for w in row] + b1 + w2 + [0.25])
    return mlp.MLPModel(mlp.MLPParams((hidden,)), [size, hidden, 1], flat, np.zeros(size), np.ones(size))


@query
def mlp_predict(spark, sf):
    out = fixed_network().transform(_embeddings(spark, sf), "x")
    return rounded(out.select("vec_id", "prediction"), 6, "prediction")


@query
def param_grid(spark, sf):
    """The full grid with the events that a hash assigns to each combination."""
    size = search.grid_size(search.WIDE_SPACE)
    scored = table(spark, sf, "events").groupBy(pick("event_id", size, "grid").alias("trial")).agg(
        F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("score"))
    return rounded(search.param_grid(spark, search.WIDE_SPACE).join(scored, "trial"), 6, "score")


@query
def param_sample(spark, sf):
    """One draw of every parameter per user of the events table."""
    users = table(spark, sf, "events").select("user_id").distinct()
    return search.param_sample(users, "user_id", search.SPACE)


def _trial_predictions(spark, sf):
    return table(spark, sf, "events").select(
        pick("user_id", 24, "trial").alias("trial"), fold_of("event_id", 4).alias("fold"),
        F.log1p("value").alias("y"), (F.log1p("value") * 0.9 + F.col("user_id") * 0.001).alias("prediction"))


@query
def cv_scores(spark, sf):
    return rounded(search.cv_scores(_trial_predictions(spark, sf)), 6, "rmse_mean", "rmse_std", "mae_mean")


@query
def best_trial(spark, sf):
    return rounded(search.best_trial(search.cv_scores(_trial_predictions(spark, sf))), 6, "rmse_mean")


@query
def halving_rungs(spark, sf):
    rung = F.array(*[F.lit(r) for r in search.RUNGS])[pick("event_id", len(search.RUNGS), "rung")]
    scores = table(spark, sf, "events").groupBy(
        pick("user_id", 64, "trial").alias("trial"), rung.alias("rung")).agg(F.avg("value").alias("score"))
    return rounded(search.halving(scores), 6, "score")


def _predictions(spark, sf, factor):
    return table(spark, sf, "lineitem").select(
        F.log1p("l_extendedprice").alias("y"),
        F.log1p(F.col("l_quantity") * factor * (1 + F.col("l_tax"))).alias("prediction"))


SCORES = ["rmse_log", "mae_log", "r2_log", "rmse_real", "mae_real", "r2_real"]


@query
def regression_metrics(spark, sf):
    return rounded(metrics.regression_metrics(_predictions(spark, sf, 2000.0)), 4, *SCORES)


@query
def leaderboard(spark, sf):
    rows = [metrics.leaderboard_row(f"factor {f}", metrics.regression_metrics(_predictions(spark, sf, float(f))),
                                    {"factor": f}) for f in (1000, 2000, 3000)]
    nothing = _predictions(spark, sf, 1.0).where("y < 0")
    rows.append(metrics.leaderboard_row("no rows", metrics.regression_metrics(nothing), {}))
    return rounded(metrics.leaderboard(rows).drop("elapsed_seconds"), 4, *SCORES)


@query
def mlp_train_eval(spark, sf):
    """Cross-validated random search on the embeddings, refit and held-out scores."""
    df = _embeddings(spark, sf).select("vec_id", F.col("x").alias("features"), F.col("label").cast("double").alias("y"))
    train, test = encode.split(df, "vec_id")
    run = pricing.search_and_refit(train, test, pricing.random_trials(spark, 10), "vec_id")
    return run.metrics


@query
def price_model_run(spark, sf):
    """Random search, full grid and halving at their defaults on the enriched listings, as a leaderboard."""
    parts = [view(spark, sf, n) for n in
             ("listings", "calendar", "crime", "stations", "tourist_spots", "income_house")]
    enriched = settle_table(pl.cleanse_for_model(pl.enrich_listings(*parts)))
    return pricing.price_model_run(enriched)


@query
def eda_pack(spark, sf):
    """Every value of the presentation pack, as one long table."""
    parts = [view(spark, sf, n) for n in
             ("listings", "calendar", "crime", "stations", "tourist_spots", "income_house")]
    enriched = settle_table(pl.cleanse_for_model(pl.enrich_listings(*parts)))
    return long_tables(eda.eda_pack(enriched))
