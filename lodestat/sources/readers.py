"""Reading the raw sources. Paths are any Hadoop URI; the caller configures access.

Columns come in as text, named by the header, and are typed by ``typed`` without
an inference pass over the data (``infer=True`` asks for one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestat.functions.parse import date_or_null, to_number
from lodestat.sources.quoted import read_quoted_csv

# Types of the raw columns the pipeline reads; other columns stay text.
LISTING_TYPES = {
    "id": "bigint", "latitude": "double", "longitude": "double", "accommodates": "int", "bedrooms": "int",
    "beds": "int", "bathrooms": "double", "review_scores_rating": "double", "number_of_reviews": "int",
    "reviews_per_month": "double", "availability_365": "int", "availability_30": "int",
}
POINT_TYPES = {"latitude": "double", "longitude": "double"}
INCOME_TYPES = {"Median House Price": "double", "Mean Household Income": "double"}
CALENDAR_TYPES = {"listing_id": "bigint", "date": "date"}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns that are present; unreadable values become null."""
    def cast(c: str, kind: str):
        if kind == "date":
            return date_or_null(c)
        if kind == "double":
            return to_number(c)
        # A count written as "2.0" is still a count; ids stay exact.
        return F.coalesce(F.col(c).try_cast(kind), F.round(to_number(c)).try_cast(kind))
    return df.withColumns({c: cast(c, k) for c, k in types.items() if c in df.columns})


def read_csv(spark: SparkSession, path: str, multiline: bool = False, recursive: bool = False,
             infer: bool = False, escape: str = '"') -> DataFrame:
    """Header CSV. ``multiline`` allows line breaks inside quotes, and files are still read in parallel."""
    if multiline and not infer:
        return read_quoted_csv(spark, path, escape, recursive).drop("_record")
    return spark.read.csv(path, header=True, inferSchema=infer, multiLine=multiline, escape=escape,
                          recursiveFileLookup=recursive)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_csv(spark, path, multiline=True), LISTING_TYPES)


def read_calendar(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Gzip CSV. One file is one task to read; ``partitions`` spreads its rows for
    heavy work after it (counting per listing combines in the reading task anyway)."""
    df = typed(read_csv(spark, path).select("listing_id", "date", "available"), CALENDAR_TYPES)
    return df.repartition(partitions) if partitions else df


def read_crime(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV below a folder as one table."""
    return read_csv(spark, path, recursive=True).withColumnRenamed("LSOA name", "lsoa_name")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return typed(read_csv(spark, path), POINT_TYPES)


def read_income_house(spark: SparkSession, path: str) -> DataFrame:
    df = typed(read_csv(spark, path), INCOME_TYPES)
    return df.withColumnsRenamed({
        "Borough": "borough", "Median House Price": "median_house_price",
        "Mean Household Income": "mean_household_income"})


def read_tolerant_csv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """CSV with backslash escapes; lines with too many fields are skipped.

    Short lines are kept and padded with nulls. ``strict=True`` drops short lines too.
    """
    df = read_quoted_csv(spark, path, escape="\\")
    names = [c for c in df.columns if c != "_record"]
    bare = F.regexp_replace("_record", r'"(?:\\.|[^"\\])*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return df.where(fields == len(names) if strict else fields <= len(names)).select(*names)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table: parquet, or CSV with a header."""
    return spark.read.parquet(path) if fmt == "parquet" else read_csv(spark, path, multiline=True)
