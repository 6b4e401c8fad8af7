"""Exact quantiles (linear interpolation) that never gather a group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here values become 64-bit keys in the same order, and each wanted rank is narrowed
digit by digit: rows are counted by the next digit of their key inside the brackets
that hold a wanted rank, the counts say which digit holds it, and the bracket
shrinks to that digit. Counts are partial aggregates; the table that a bracket's
running sums are taken over has at most ``2 ** BITS`` rows, whatever the input. A
bracket of few rows is counted by whole keys and ends the search at once, so small
groups take two passes and no group takes more than ``64 / BITS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestat.functions.ordering import ordered_key
from lodestat.functions.parse import nan_to_null
from lodestat.operators.sizing import broadcast_checked
from lodestat.session import settle

#: Bits of a digit; a bracket of at most ``2 ** BITS`` rows is counted by whole keys.
BITS = 16
#: Accuracy of the sketch behind ``exact=False``.
ACCURACY = 100_000


def qname(p: float) -> str:
    """Column name of a quantile: 0.25 -> ``p25``, 0.975 -> ``p97_5``."""
    return "p" + f"{p * 100:g}".replace(".", "_")


def to_long(df: DataFrame, cols: list[str], keep: list[str] = (), name: str = "feature",
            value: str = "value") -> DataFrame:
    """One row per (row, column) with the value as double, NaN as null."""
    wide = df.select(*keep, *[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    return wide.unpivot(list(keep), list(cols), name, value)


def _ranks(probs: list[float]) -> list[str]:
    """For each probability, the ranks below and above it among ``n`` values, from 0."""
    return [f"CAST({f}({p!r}D * (n - 1)) AS BIGINT)" for p in probs for f in ("floor", "ceil")]


def _refine(counted: DataFrame, probs: list[float]) -> DataFrame:
    """Brackets that hold a wanted rank, from counts ``(g, b, base, n, d, c, low, high)`` by digit ``d`` in bracket ``b``.

    ``base`` is the number of a group's values before the bracket and ``n`` that of all;
    both are null in the first round, whose only bracket is the group itself.
    """
    # As text, since an expression built call by call takes longer than a small job.
    ends = counted.selectExpr(
        "g", "d", "c", "low", "high", "coalesce(n, sum(c) OVER (PARTITION BY g, b)) AS n",
        "coalesce(base, 0) + sum(c) OVER (PARTITION BY g, b ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto")
    holds = f"n = 0 OR exists(array({', '.join(_ranks(probs))}), r -> r >= upto - c AND r < upto)"
    return ends.where(holds).selectExpr("g", "n", "d", "upto - c AS `from`", "upto", "low", "high")


def _count(rows: DataFrame, digit: str) -> DataFrame:
    return (rows.groupBy("g", "b", "base", "n", F.expr(digit).alias("d"))
            .agg(F.expr("count(v) AS c"), F.expr("min(v) AS low"), F.expr("max(v) AS high")))


def _kept(state: DataFrame, few_groups: bool) -> DataFrame:
    """``state`` computed once: a few rows per group, as a local table if the schema bounds the groups."""
    return state.sparkSession.createDataFrame(state.collect(), state.schema) if few_groups else settle(state)


def brackets(rows: DataFrame, probs: list[float], few_groups: bool) -> list[DataFrame]:
    """``(g, n, from, upto, low)`` for every wanted rank of ``rows (g, v)``: the value at ranks ``from`` to ``upto - 1``.

    One table for each round that settled any; a group without values has n = 0.
    """
    keyed = rows.selectExpr("g", "v", f"{ordered_key('v')} AS key")
    first = keyed.selectExpr("g", "v", "0L AS b", "CAST(NULL AS BIGINT) AS base", "CAST(NULL AS BIGINT) AS n", "key")
    found, shift = [], 64 - BITS
    state = _kept(_refine(_count(first, f"shiftright(key, {shift})"), probs), few_groups)
    # A key that can't be null, so that no filter is derived from the join that computes it again.
    known = keyed.where("v IS NOT NULL").selectExpr("g", "v", "coalesce(key, 0L) AS key")
    while True:
        found.append(state.where("n = 0 OR low = high").drop("d", "high"))
        open_ = state.where("NOT (n = 0 OR low = high)").selectExpr("g", "d AS b", "`from` AS base", "n", f"upto - `from` <= {1 << BITS} AS few")
        if open_.isEmpty():
            return found
        open_ = F.broadcast(open_) if few_groups else broadcast_checked(open_, derived=False)
        inside = known.selectExpr("*", f"shiftright(key, {shift}) AS b").join(open_, ["g", "b"])
        shift = max(shift - BITS, 0)
        # Brackets that end here and those that go on have digits of different lengths, but never share a bracket.
        digit = f"IF(few, key, shiftright(key, {shift}))"
        state = _kept(_refine(_count(inside, digit), probs), few_groups)


def quantiles(df: DataFrame, value: str | Column, probs: list[float], by: list[str] = (),
              exact: bool = True, few_groups: bool = False) -> DataFrame:
    """One row per group: the group columns, ``n`` and one column per probability.

    Nulls are left out; a group with nothing else has n = 0 and null quantiles.
    ``exact=False`` returns sketch values from a single pass. ``few_groups`` says
    that the number of groups is fixed by the schema, so it need not be measured.
    """
    by = list(by)
    probs = sorted(set(probs))
    value = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, nan_to_null(value.cast("double")).alias("v"))
    if not exact:
        wanted = ", ".join(f"{p!r}D" for p in probs)
        return (
            rows.groupBy(*by)
            .agg(F.count("v").alias("n"),
                 F.expr(f"approx_percentile(v, array({wanted}), {ACCURACY})").alias("q"))
            .select(*by, "n", *[F.col("q")[i].alias(qname(p)) for i, p in enumerate(probs)])
        )

    # Null group keys are groups too, so the joins have to match them: a struct of nulls equals itself.
    grouped = rows.select((F.struct(*by) if by else F.lit(0)).alias("g"), "v")
    found = brackets(grouped, probs, few_groups or not by)
    table = found[0]
    for more in found[1:]:
        table = table.unionByName(more)
    picks = [F.expr(f"max(IF({r} >= `from` AND {r} < upto, low, NULL)) AS r{i}") for i, r in enumerate(_ranks(probs))]
    picked = table.groupBy(*["g"] if by else []).agg(F.expr("coalesce(max(n), 0) AS n"), *picks)
    out = [f"r{2 * i} + (r{2 * i + 1} - r{2 * i}) * ({p!r}D * (n - 1) - floor({p!r}D * (n - 1))) AS `{qname(p)}`" for i, p in enumerate(probs)]
    return picked.selectExpr(*[f"g.`{c}` AS `{c}`" for c in by], "n", *out)


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     exact: bool = True) -> DataFrame:
    """``quantiles`` of several columns in one plan, one row per column."""
    return quantiles(to_long(df, cols), "value", probs, ["feature"], exact, few_groups=True)


def median_row(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row holding the exact median of every column."""
    m = column_quantiles(df, cols, [0.5])
    return m.agg(*[F.max(F.when(F.col("feature") == c, F.col("p50"))).alias(c) for c in cols])
