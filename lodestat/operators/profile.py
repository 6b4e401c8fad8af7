"""Table and column statistics, as long result tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodestat.functions.parse import nan_to_null
from lodestat.operators.clean import duplicate_count
from lodestat.operators.distinct import distinct_counts
from lodestat.operators.quantiles import column_quantiles, quantiles
from lodestat.session import attach_row, settle


def _null(c: str, df: DataFrame) -> Column:
    kind = dict(df.dtypes)[c]
    missing = F.col(c).isNull()
    return missing | F.isnan(c) if kind in ("double", "float") else missing


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls (and NaN) and their percentage per column; most nulls first."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(_null(c, df)).alias(c) for c in df.columns])
    return (
        counts.unpivot(["_rows"], df.columns, "column", "nulls")
        .select("column", "nulls",
                F.round(F.try_divide(F.col("nulls") * 100, "_rows"), 2).alias("null_pct"))
        .orderBy(F.desc("nulls"), "column")
    )


def null_mask(df: DataFrame, key: str, buckets: int = 100) -> DataFrame:
    """Nulls per column in equal slices of the key range: a null heat map."""
    ends = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    span = F.col("_p.hi") - F.col("_p.lo") + 1
    slot = F.floor((F.col(key) - F.col("_p.lo")) * buckets / span).cast("int")
    cols = [c for c in df.columns if c != key]
    flags = attach_row(df, ends).select(slot.alias("bucket"), *[_null(c, df).cast("int").alias(c) for c in cols])
    sums = flags.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"),
                                       *[F.sum(c).alias(c) for c in cols])
    return sums.unpivot(["bucket", "n_rows"], cols, "column", "nulls")


def describe(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per numeric column."""
    num = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    stats = num.agg(*[F.struct(
        F.lit(c).alias("feature"), F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max")).alias(c) for c in cols])
    stats = stats.select(F.explode(F.array(*cols)).alias("s")).select("s.*")
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact).drop("n")
    return stats.join(q, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def value_counts(df: DataFrame, col: str, keep_null: bool = False, normalize: bool = False) -> DataFrame:
    """Rows per value, most frequent first. Nulls count as ``nan`` on request."""
    if keep_null:
        rows = df.select(F.coalesce(F.col(col).cast("string"), F.lit("nan")).alias(col))
    else:
        rows = df.select(col).where(F.col(col).isNotNull())
    counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    if normalize:
        total = rows.agg(F.count(F.lit(1))).scalar()
        counts = counts.withColumn("share", F.col("n") / total)
    return counts.orderBy(F.desc("n"), col)


def ordered_counts(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """Counts in a fixed order of values; values without rows are left out."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col)).cast("int")
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(place.alias("position"), col, "n").where("position > 0").orderBy("position")


def column_profile(df: DataFrame, described: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Data dictionary: type, nullability, source and description with measured statistics."""
    described = described or {}
    meta = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable, *described.get(f.name, ("Unknown", "")))
         for i, f in enumerate(df.schema.fields)],
        "position int, column string, dtype string, nullable boolean, source string, description string")
    stats = null_profile(df).join(distinct_counts(df, df.columns), "column")
    return meta.join(F.broadcast(stats), "column").select(
        "position", "column", "dtype", "nullable", "source", "description", "nulls", "null_pct", "n_distinct"
    ).orderBy("position")


def table_shape(df: DataFrame) -> DataFrame:
    """One row: rows, columns, and columns of each kind."""
    kinds = [("numeric", T.NumericType), ("text", T.StringType), ("time", (T.DateType, T.TimestampType, T.TimestampNTZType))]
    count = {name: sum(isinstance(f.dataType, kind) for f in df.schema.fields) for name, kind in kinds}
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), *[F.lit(n).alias(f"n_{name}") for name, n in count.items()])


def summary_report(df: DataFrame, cols: list[str]) -> dict[str, DataFrame]:
    """The parts of a text summary as tables."""
    return {"shape": table_shape(df), "dtypes": column_profile(df), "numeric": describe(df, cols),
            "nulls": null_profile(df), "duplicates": duplicate_count(df)}


def group_means(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def group_median(df: DataFrame, key: str, value: str) -> DataFrame:
    """Exact median and row count per group, largest median first."""
    rows = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    return quantiles(rows, value, [0.5], [key]).select(
        key, "n", F.col("p50").alias("median")).orderBy(F.desc("median"), key)


def top_groups(df: DataFrame, key: str, value: str, n: int, by: str = "median") -> DataFrame:
    """The n first groups by median, by count or in name order."""
    rows = df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
    if by == "median":
        # n rows, kept so that filters on them do not repeat the medians.
        return settle(group_median(rows, key, value).select(key, "median").limit(n))
    if by == "count":
        return value_counts(rows, key).limit(n)
    return rows.select(key).distinct().orderBy(key).limit(n)


def keep_groups(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a top-n group table, which is bounded by its limit."""
    return df.join(F.broadcast(groups.select(key)), key, "left_semi")


def flag_impact(df: DataFrame, flags: list[str], value: str) -> DataFrame:
    """Median, mean and rows of a value for each flag at 0 and at 1."""
    present = [f for f in flags if f in df.columns]
    long = df.where(F.col(value).isNotNull()).select(
        value, *[F.col(f).cast("int").alias(f) for f in present]
    ).unpivot([value], present, "flag", "value_of_flag").where("value_of_flag IN (0, 1)")
    keys = ["flag", "value_of_flag"]
    means = long.groupBy(*keys).agg(F.avg(value).alias("mean"))
    med = quantiles(long, value, [0.5], keys, few_groups=True).select(*keys, "n", F.col("p50").alias("median"))
    return med.join(F.broadcast(means), keys).select(*keys, "median", "mean", "n")


def iqr_report(df: DataFrame, col: str) -> DataFrame:
    """Quartiles, whiskers (the lower one not below 0) and the outliers beyond them."""
    q = quantiles(df, col, [0.25, 0.5, 0.75])
    iqr = F.col("p75") - F.col("p25")
    fences = q.select(
        F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3"),
        iqr.alias("iqr"), F.greatest(F.lit(0.0), F.col("p25") - 1.5 * iqr).alias("lower"),
        (F.col("p75") + 1.5 * iqr).alias("upper"))
    counts = attach_row(df.select(F.col(col).alias("v")), fences).groupBy("_p").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("v") < F.col("_p.lower")).alias("n_low"),
        F.count_if(F.col("v") > F.col("_p.upper")).alias("n_high"))
    return counts.select(
        "_p.*", "n_low", "n_high",
        F.try_divide((F.col("n_low") + F.col("n_high")) * 100.0, "n_rows").alias("outlier_pct"))


def co_moments(df: DataFrame, cols: list[str]) -> dict[str, np.ndarray]:
    """Matrices over every ordered pair of columns, from the rows where both are present.

    ``n`` rows, ``sum`` and ``squares`` of the first column, and ``product`` of both, of
    values less the column's mean, so that no digits cancel later. Tasks multiply whole
    blocks by their masks of present values; four matrices per task are added up.
    """
    num = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    means = np.array([m or 0.0 for m in num.agg(*[F.avg(c) for c in num.columns]).first()])
    width, names = len(cols), ("n", "sum", "squares", "product")

    def run(batches):
        total = np.zeros((len(names), width, width))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float) - means
            there = ~np.isnan(x)
            x[~there] = 0.0
            m = there.astype(float)
            total += [m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(names) * width), pa.int32()), pa.array(list(total.reshape(-1, width)))], names=["row", "v"])

    sums = num.mapInArrow(run, "row int, v array<double>").groupBy("row").agg(
        vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).orderBy("row").collect()
    table = np.array([r["v"] for r in sums]).reshape(len(names), width, width) if sums else np.zeros((len(names), width, width))
    return dict(zip(names, table))


def correlation_values(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson r of every pair of columns over the rows where both are present; NaN without variance."""
    m = co_moments(df, cols)
    with np.errstate(invalid="ignore", divide="ignore"):
        mean, square = m["sum"] / m["n"], m["squares"] / m["n"]
        variance = square - mean * mean
        # What is left of a constant after subtracting means is rounding.
        variance = np.where(variance > 1e-13 * square, variance, 0.0)
        spread = np.sqrt(variance * variance.T)
        r = np.where(spread > 0, (m["product"] / m["n"] - mean * mean.T) / spread, np.nan)
    return np.clip(r, -1.0, 1.0)


def correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every ordered pair of columns, over the rows where both are present; null without variance."""
    cols = list(dict.fromkeys(cols))
    r = correlation_values(df, cols)
    # A matrix of the columns, never of the rows.
    return df.sparkSession.createDataFrame(
        [(a, b, None if np.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)],
        "x string, y string, r double")


def target_correlates(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """The columns ranked by absolute correlation with the target."""
    cols = [c for c in dict.fromkeys(cols) if c != target]
    r = correlation_values(df, [target, *cols])[0, 1:]
    found = [(c, None if np.isnan(v) else float(v)) for c, v in zip(cols, r)]
    return df.sparkSession.createDataFrame(found, "feature string, r double").orderBy(F.desc_nulls_last(F.abs("r")), "feature")


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)
