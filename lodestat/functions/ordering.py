"""Keys that sort as their values do."""

from __future__ import annotations

_LEAST_NORMAL = f"{2.0 ** -1022!r}D"


def ordered_key(value: str) -> str:
    """SQL for a long for each double of the column ``value``, in the same order and equal only for equal values.

    It is the number's exponent and fraction as they are stored, negated for negative
    numbers, from exact arithmetic on powers of two; zeros of both signs are equal. Null
    stays null; NaN has no place.

    Whatever is used more than once stands outside of conditions, where Spark computes it
    once a row: repeated in branches, it made methods that the JVM doesn't compile.
    """
    size = f"abs({value})"
    usual = f"({size} >= {_LEAST_NORMAL} AND {size} < double('Infinity'))"
    body = f"IF({usual}, {size}, 1D)"
    # The logarithm is rounded, so it may name a neighbouring power.
    near = f"least(CAST(floor(log2({body})) AS INT), 1023)"
    ratio = f"({body} / pow(2D, {near}))"
    exponent = f"({near} + 1023 + CAST({ratio} >= 2D AS INT) - CAST({ratio} < 1D AS INT))"
    fraction = f"(IF({ratio} >= 2D, {ratio} / 2D, IF({ratio} < 1D, {ratio} * 2D, {ratio})) - 1D)"
    normal = f"(CAST({exponent} AS BIGINT) * {1 << 52}L + CAST({fraction} * {2.0 ** 52!r}D AS BIGINT))"
    small = f"CAST(least({size}, {_LEAST_NORMAL}) * {2.0 ** 537!r}D * {2.0 ** 537!r}D AS BIGINT)"
    other = f"IF({size} = double('Infinity'), {2047 << 52}L, {small})"
    sign = f"(CASE WHEN {value} IS NULL THEN NULL WHEN {value} < 0 THEN -1L ELSE 1L END)"
    return f"({sign} * (CAST({usual} AS BIGINT) * {normal} + CAST(NOT {usual} AS BIGINT) * {other}))"
