"""Plot-ready tables: bins, densities and box statistics. Nothing is drawn."""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from lodestat.functions.features import cap
from lodestat.functions.parse import nan_to_null
from lodestat.operators.distinct import few_values
from lodestat.operators.quantiles import column_quantiles, quantiles, to_long
from lodestat.operators.sizing import lookup_join
from lodestat.session import attach_row, settle

GRID_POINTS = 200
# A kernel's share of its peak beyond this many bandwidths is below 3e-18.
KERNEL_REACH = 9.0
# Width of a cell in units of sqrt(2) bandwidths, and moments kept of it.
CELL, TERMS = 0.5, 16


def _values(df: DataFrame, value: str | Column) -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    return df.select(nan_to_null(value.cast("double")).alias("v")).where("v IS NOT NULL")


def _slot(v: Column, lo: Column, width: Column, bins: Column) -> Column:
    """Equal-width bin; the maximum belongs to the last bin."""
    return F.when(width > 0, F.least(F.floor((v - lo) / width), bins - 1)).otherwise(0).cast("int")


def histogram(df: DataFrame, value: str | Column, bins: int = 60) -> DataFrame:
    """(bin, bin_lo, n) for equal-width bins from minimum to maximum, empty bins included."""
    rows = _values(df, value)
    ends = rows.agg(F.min("v").alias("lo"), ((F.max("v") - F.min("v")) / bins).alias("w"))
    counts = attach_row(rows, ends).select(
        _slot(F.col("v"), F.col("_p.lo"), F.col("_p.w"), F.lit(bins)).alias("bin")
    ).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = ends.where("lo IS NOT NULL").select(
        "lo", "w", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_lo"),
        F.coalesce("n", F.lit(0)).alias("n"))


def auto_bin_plan(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bin count per column: the narrower of the Freedman-Diaconis and Sturges widths."""
    q = column_quantiles(df, cols, [0.25, 0.75])
    ends = to_long(df, cols).groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    plan = q.join(F.broadcast(ends), "feature").where("n > 0")
    span = F.col("hi") - F.col("lo")
    fd = 2 * (F.col("p75") - F.col("p25")) / F.pow(F.col("n").cast("double"), F.lit(1 / 3))
    sturges = span / (F.log2(F.col("n").cast("double")) + 1)
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    bins = F.when(span > 0, F.ceil(span / width)).otherwise(1).cast("int")
    return plan.select("feature", "n", "lo", "hi", bins.alias("bins"))


def histogram_auto(df: DataFrame, cols: list[str], first: int | None = None) -> DataFrame:
    """Histograms of the columns, or of the ``first`` ones, with data-driven bin counts; non-empty bins."""
    cols = cols[:first]
    plan = auto_bin_plan(df, cols).select("feature", "lo", "hi", "bins")
    rows = to_long(df, cols).where("value IS NOT NULL")
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    # One row per column name: the plan table is as small as the schema.
    binned = rows.join(F.broadcast(plan), "feature").select(
        "feature", "bins", _slot(F.col("value"), F.col("lo"), width, F.col("bins")).alias("bin"))
    return binned.groupBy("feature", "bins", "bin").agg(F.count(F.lit(1)).alias("n"))


def _hermite_rows(terms: int) -> np.ndarray:
    """Coefficients of the Hermite polynomials H_0 to H_(terms - 1), by power."""
    rows = np.zeros((terms, terms))
    rows[0, 0] = 1.0
    for n in range(1, terms):
        rows[n, 1:] = 2 * rows[n - 1, :-1]
        if n > 1:
            rows[n] -= 2 * (n - 1) * rows[n - 2]
    return rows


def densities(df: DataFrame, cols: list[str], points: int = GRID_POINTS) -> DataFrame:
    """(feature, point, x, density): Gaussian kernel density (Scott bandwidth) of every column with any spread.

    The grid is even over a column's range. A fast Gauss transform: values add their
    powers to the moments of a cell half a kernel scale wide, and the cells' Hermite
    series give the density, so a row costs the same whatever the grid. With ``TERMS``
    moments a value is off by less than 1e-11 of its kernel's peak; cells further than
    ``KERNEL_REACH`` bandwidths away add less.
    """
    rows = to_long(df, cols, value="v").where("v IS NOT NULL")
    n, std = F.count("v").cast("double"), F.stddev_samp("v")
    fit = rows.groupBy("feature").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), n.alias("n"),
                                      (std * F.pow(n, F.lit(-0.2))).alias("bw")).where("bw > 0")
    # One row per column name.
    fit = settle(fit.withColumn("step", (F.col("hi") - F.col("lo")) / (points - 1)).withColumn("scale", F.col("bw") * 2 ** 0.5))
    at = rows.join(F.broadcast(fit.select("feature", "lo", "scale")), "feature").select(
        "feature", ((F.col("v") - F.col("lo")) / F.col("scale")).alias("u"))
    at = at.select("feature", "u", F.floor(F.col("u") / CELL).alias("cell"))
    at = at.select("feature", "cell", (F.col("u") - (F.col("cell") + 0.5) * CELL).alias("p1"))
    at = at.select("*", (F.col("p1") * F.col("p1")).alias("p2"))
    at = at.select("*", (F.col("p2") * F.col("p1")).alias("p3"), (F.col("p2") * F.col("p2")).alias("p4"))

    def moment(i: int) -> Column:
        factors = ["p4"] * (i // 4) + ([f"p{i % 4}"] if i % 4 else [])
        return F.sum(reduce(lambda a, b: a * b, map(F.col, factors))) / math.factorial(i)

    cells = at.groupBy("feature", "cell").agg(F.count(F.lit(1)).cast("double").alias("m0"), *[moment(i).alias(f"m{i}") for i in range(1, TERMS)])
    # The series of a cell as a plain polynomial, from the highest power on.
    hermite = _hermite_rows(TERMS)
    series = F.array(*[reduce(lambda a, b: a + b, [F.col(f"m{i}") * float(hermite[i, k]) for i in range(k, TERMS) if hermite[i, k]])
                       for k in reversed(range(TERMS))])
    placed = cells.select("feature", "cell", series.alias("series")).join(F.broadcast(fit), "feature")
    centre = F.col("lo") + (F.col("cell") + 0.5) * CELL * F.col("scale")
    reach = KERNEL_REACH * F.col("bw")
    first = F.greatest(F.lit(0), F.ceil((centre - reach - F.col("lo")) / F.col("step")))
    last = F.least(F.lit(points - 1), F.floor((centre + reach - F.col("lo")) / F.col("step")))
    hits = placed.select("feature", "series", centre.alias("centre"), "lo", "step", "scale",
                         F.explode(F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))).alias("i"))
    hits = hits.select("feature", "i", "series", ((F.col("lo") + F.col("i") * F.col("step") - F.col("centre")) / F.col("scale")).alias("t"))
    value = F.aggregate("series", F.lit(0.0), lambda s, c: s * F.col("t") + c) * F.exp(-F.col("t") * F.col("t"))
    sums = hits.groupBy("feature", "i").agg(F.sum(value).alias("s"))
    frame = fit.select("feature", "lo", "step", "n", "bw", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    norm = F.col("n") * F.col("bw") * F.sqrt(F.lit(2.0) * F.pi())
    return frame.join(sums, ["feature", "i"], "left").select(
        "feature", F.col("i").alias("point"), (F.col("lo") + F.col("i") * F.col("step")).alias("x"),
        (F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0)) / norm).alias("density"))


def kde(df: DataFrame, value: str | Column, points: int = GRID_POINTS) -> DataFrame:
    """(point, x, density) of one column or expression, as ``densities`` has it."""
    value = F.col(value) if isinstance(value, str) else value
    return densities(df.select(value.alias("value")), ["value"], points).drop("feature")


def violin(df: DataFrame, value: str | Column, points: int = GRID_POINTS) -> DataFrame:
    """Density over the data range with the quartiles on every row."""
    q = quantiles(df, value, [0.25, 0.5, 0.75])
    return attach_row(kde(df, value, points), q).select(
        "point", "x", "density", F.col("_p.p25").alias("q1"), F.col("_p.p50").alias("median"),
        F.col("_p.p75").alias("q3"))


def box_stats(df: DataFrame, value: str, by: list[str] = (), few_groups: bool = False) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR) and outliers per group."""
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    q = quantiles(rows, "_v", [0.25, 0.5, 0.75], by, few_groups=few_groups)
    iqr = F.col("p75") - F.col("p25")
    q = q.select(*by, F.col("p25").alias("q1"), F.col("p50").alias("median"), F.col("p75").alias("q3"),
                 (F.col("p25") - 1.5 * iqr).alias("_lo"), (F.col("p75") + 1.5 * iqr).alias("_hi"))
    if by:
        # Null group keys are groups too, so the join has to match them.
        rows, q = rows.withColumn("_k", F.struct(*by)), q.withColumn("_k", F.struct(*by)).drop(*by)
        located = rows.join(F.broadcast(q), "_k") if few_groups else lookup_join(rows, q, "_k", "inner")
    else:
        located = attach_row(rows, q).select("_v", "_p.*")
    v, within = F.col("_v"), F.col("_v").between(F.col("_lo"), F.col("_hi"))
    return located.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(within, v)).alias("whisker_low"), F.max(F.when(within, v)).alias("whisker_high"),
        F.count_if(~within).alias("n_outliers"), F.count(F.lit(1)).alias("n"))


def _hex_cell(x: Column, y: Column, x0: Column, x1: Column, y0: Column, y1: Column, grid: int) -> Column:
    """(lattice, i, j) of the nearest hexagon centre in two offset rectangular lattices."""
    nx, ny = grid, int(grid / 3 ** 0.5)
    # The padded range keeps the extreme points inside the outer cells.
    pad_x, pad_y = 1e-9 * (x1 - x0), 1e-9 * (y1 - y0)
    gx = (x - x0 + pad_x) / ((x1 - x0 + 2 * pad_x) / nx)
    gy = (y - y0 + pad_y) / ((y1 - y0 + 2 * pad_y) / ny)
    i1, j1 = F.floor(gx + 0.5), F.floor(gy + 0.5)
    i2, j2 = F.floor(gx), F.floor(gy)
    d1 = F.pow(gx - i1, 2) + 3 * F.pow(gy - j1, 2)
    d2 = F.pow(gx - i2 - 0.5, 2) + 3 * F.pow(gy - j2 - 0.5, 2)
    first = d1 < d2
    return F.struct(F.when(first, 0).otherwise(1).alias("lattice"),
                    F.when(first, i1).otherwise(i2).cast("int").alias("i"),
                    F.when(first, j1).otherwise(j2).cast("int").alias("j"))


def hexbin(df: DataFrame, xs: list[str], y: str, grid: int = 30) -> DataFrame:
    """Rows per hexagonal cell of every x column against y; empty cells are absent.

    All columns share one pass for their ranges and one for the counts.
    """
    target = nan_to_null(F.col(y).cast("double"))
    rows = to_long(df.withColumn("_y", target).where("_y IS NOT NULL"), xs, keep=["_y"])
    rows = rows.where("value IS NOT NULL")
    ends = rows.groupBy("feature").agg(
        F.min("value").alias("x0"), F.max("value").alias("x1"), F.min("_y").alias("y0"), F.max("_y").alias("y1"))
    # One row per column name.
    located = rows.join(F.broadcast(ends), "feature")
    cell = _hex_cell(F.col("value"), F.col("_y"), *[F.col(c) for c in ("x0", "x1", "y0", "y1")], grid)
    return located.select("feature", cell.alias("c")).select("feature", "c.*").groupBy(
        "feature", "lattice", "i", "j").agg(F.count(F.lit(1)).alias("n"))


def numeric_vs_target(df: DataFrame, cols: list[str], target: str, max_levels: int = 6,
                      grid: int = 30) -> DataFrame:
    """Each column against the target: box statistics per value for a column of at
    most ``max_levels`` values, hexagonal bins for the others. One table for all.

    The columns are routed by their measured distinct values (two aggregates).
    """
    cols = [c for c in dict.fromkeys(cols) if c != target]
    seen = few_values(df.where(F.col(target).isNotNull()), cols, max_levels)
    few = [c for c in cols if seen[c] is not None]
    parts = []
    if few:
        long = to_long(df.where(F.col(target).isNotNull()), few, keep=[target], value="level")
        parts.append(box_stats(long.where("level IS NOT NULL"), target, ["feature", "level"],
                               few_groups=True).select(
            "feature", F.lit("box").alias("kind"), "level", "q1", "median", "q3",
            F.lit(None).cast("int").alias("lattice"), F.lit(None).cast("int").alias("i"),
            F.lit(None).cast("int").alias("j"), "n"))
    many = [c for c in cols if c not in few]
    if many:
        nothing = F.lit(None).cast("double")
        parts.append(hexbin(df, many, target, grid).select(
            "feature", F.lit("hex").alias("kind"), nothing.alias("level"),
            nothing.alias("q1"), nothing.alias("median"), nothing.alias("q3"),
            "lattice", "i", "j", "n"))
    return reduce(DataFrame.unionByName, parts)


def capped_points(df: DataFrame, x: str, y: str, value: str, p: float = 0.95) -> DataFrame:
    """The complete points with the value capped at its quantile."""
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                     F.col(value).cast("double").alias("v")).dropna()
    q = quantiles(rows, "v", [p])
    top = q.select(q.columns[-1]).scalar()
    return rows.select("x", "y", cap("v", top).alias("v"))


def capped_grid(df: DataFrame, x: str, y: str, value: str, dx: float, dy: float,
                p: float = 0.95) -> DataFrame:
    """Mean capped value and rows per rectangular cell."""
    points = capped_points(df, x, y, value, p)
    return points.groupBy(
        F.floor(F.col("x") / dx).cast("int").alias("cx"),
        F.floor(F.col("y") / dy).cast("int").alias("cy"),
    ).agg(F.avg("v").alias("mean_value"), F.count(F.lit(1)).alias("n"))


def pair_bins(df: DataFrame, cols: list[str], bins: int = 20, first: int | None = None) -> DataFrame:
    """2-D bin counts for every pair of columns and histograms on the diagonal,
    over the rows where all the columns are present."""
    cols = cols[:first]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    ends = rows.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols])

    def slot(c: str) -> Column:
        lo, hi = F.col("_p")[f"lo_{c}"], F.col("_p")[f"hi_{c}"]
        return _slot(F.col(c), lo, (hi - lo) / bins, F.lit(bins)).alias(c)

    slots = attach_row(rows, ends).select(*[slot(c) for c in cols])
    # A row adds a fixed number of cells; partial counts shrink them before the shuffle.
    pairs = [(c, c) for c in cols] + list(combinations(cols, 2))
    quoted = {c: ("`" + c.replace("`", "``") + "`", "'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'") for c in cols}
    # One text for all pairs, since they are as many as the square of the columns.
    every = ", ".join(f"struct({quoted[a][1]} AS x, {quoted[b][1]} AS y, {quoted[a][0]} AS bx, {quoted[b][0]} AS by)" for a, b in pairs)
    cells = slots.select(F.expr(f"explode(array({every}))").alias("c"))
    return cells.select("c.*").groupBy("x", "y", "bx", "by").agg(F.count(F.lit(1)).alias("n"))
