"""Null handling, range filters and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lodestat.functions.parse import nan_to_null
from lodestat.functions.rowkey import can_encode, row_digest
from lodestat.operators.quantiles import median_row
from lodestat.session import attach_row


def fill(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def in_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.where(F.col(col).between(low, high))


def drop_missing(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def fill_median(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls (and NaN) with the column's exact median."""
    located = attach_row(df, median_row(fit_on if fit_on is not None else df, cols))
    return located.withColumns({
        c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.col("_p")[c]) for c in cols}).drop("_p")


def mode_of(df: DataFrame, col: str) -> DataFrame:
    """One row with the most frequent value; the smallest value wins ties.

    Counting first keeps the work in partial aggregates, where ``mode`` would
    hold every distinct value in one buffer.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(col).alias("v"))).alias("m")) \
        .select(F.col("m.v").alias(col))


def fill_mode(df: DataFrame, col: str, fit_on: DataFrame | None = None) -> DataFrame:
    mode = mode_of(fit_on if fit_on is not None else df, col).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), mode))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct rows; nulls are equal. Copies collapse before the shuffle, whose key is a short digest of the row.

    Types without a canonical encoding are left to Spark's own comparison of whole rows.
    """
    if not can_encode(df.schema):
        return df.dropDuplicates()
    name = "_".join(["_row", *df.columns])
    return df.withColumn(name, row_digest(df)).dropDuplicates([name]).drop(name)


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and how many are repeats."""
    rows = df.select(row_digest(df).alias("_row")) if can_encode(df.schema) else df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
    ).withColumn("duplicate_rows", F.col("n_rows") - F.col("distinct_rows"))


class RowFunnel:
    """Row counts after each step, gathered while the final job runs.

    An observed step keeps later filters from moving below it, so this is for
    inspection and not part of the normal pipelines.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        seen = Observation(f"{len(self._steps)}:{step}")
        self._steps.append((step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def counts(self) -> list[tuple[str, int]]:
        return [(step, seen.get["rows"]) for step, seen in self._steps]


def funnel(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Rows left after each filter of a chain, as a table, from a single scan."""
    keep, sums = F.lit(True), [F.count(F.lit(1)).alias("read")]
    for name, test in steps:
        keep = keep & F.coalesce(test, F.lit(False))
        sums.append(F.count_if(keep).alias(name))
    names = ["read"] + [name for name, _ in steps]
    counts = df.agg(*sums).unpivot([], names, "step", "n_rows")
    position = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return counts.select(position[F.col("step")].alias("position"), "step", "n_rows")
