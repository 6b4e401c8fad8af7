"""The whole run from raw files to stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestat.operators.profile import column_profile
from lodestat.plans.dictionary import COLUMNS
from lodestat.plans.eda import eda_pack
from lodestat.plans.listings import enrich_listings
from lodestat.plans.pricing import price_model_run
from lodestat.plans.segmentation import segmentation_report
from lodestat.operators.columns import drop_leakage
from lodestat.sources import readers
from lodestat.sources.writers import write_pack, write_table


def build_model_table(spark: SparkSession, raw: str, out: str) -> DataFrame:
    """Read the six sources below ``raw``, enrich, write once and read back."""
    df = enrich_listings(
        readers.read_listings(spark, f"{raw}/listings.csv"),
        readers.read_calendar(spark, f"{raw}/calendar.csv.gz"),
        readers.read_crime(spark, f"{raw}/crime"),
        readers.read_points(spark, f"{raw}/stations.csv"),
        readers.read_points(spark, f"{raw}/tourist_spots.csv"),
        readers.read_income_house(spark, f"{raw}/income_house.csv"))
    write_table(df, f"{out}/listings")
    stored = readers.read_table(spark, f"{out}/listings")
    write_table(column_profile(stored, COLUMNS), f"{out}/data_dictionary", "csv", single_file=True)
    return stored


def run(spark: SparkSession, raw: str, out: str, **model_options) -> DataFrame:
    """Everything: model table, segmentation, statistics, models. Returns the leaderboard."""
    listings = build_model_table(spark, raw, out)
    report = segmentation_report(listings)
    write_table(report.pop("segmented"), f"{out}/segmented")
    clean = report.pop("clean")
    write_pack(report, f"{out}/segmentation")
    model_input = drop_leakage(clean)
    write_table(model_input, f"{out}/model_input")
    model_input = readers.read_table(spark, f"{out}/model_input")
    write_pack(eda_pack(model_input), f"{out}/statistics")
    board = price_model_run(model_input, **model_options)
    write_table(board, f"{out}/model_performance", "csv", single_file=True)
    return board
