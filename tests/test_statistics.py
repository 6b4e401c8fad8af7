import datetime as dt
import decimal
import math
import random
import re
import struct

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lodestat.functions.ordering import ordered_key
from lodestat.functions.rowkey import can_encode, encoded
from lodestat.operators import charts, clean, columns, distinct, profile, quantiles as q


def frame(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def test_quantiles_skip_null_and_nan(spark):
    df = frame(spark, [1.0, None, float("nan"), 3.0, 10.0])
    got = q.quantiles(df, "x", [0.0, 0.25, 0.5, 1.0]).first().asDict()
    assert got == {"n": 3, "p0": 1.0, "p25": 2.0, "p50": 3.0, "p100": 10.0}
    assert q.quantiles(frame(spark, []), "x", [0.5]).collect()[0].asDict() == {"n": 0, "p50": None}


def test_quantiles_by_group_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("b", None)], "k string, v double")
    got = {r["k"]: (r["n"], r["p50"]) for r in q.quantiles(df, "v", [0.5], ["k"]).collect()}
    assert got == {None: (2, 2.0), "a": (1, 5.0), "b": (0, None)}


@pytest.mark.parametrize("shape", ["skewed", "one_value_holds_a_third", "uniform", "wide"])
def test_quantiles_are_exact_beyond_the_small_group_size(spark, monkeypatch, shape):
    # Short digits make 20,000 rows a large group, with a round for every few bits.
    monkeypatch.setattr(q, "BITS", 8)
    base = spark.range(0, 20_000, 1, 7).select(F.rand(3).alias("u"), "id")
    value = {"skewed": F.exp(F.col("u") * 12), "uniform": F.col("u"),
             "one_value_holds_a_third": F.when(F.col("id") % 3 == 0, 0.4).otherwise(F.col("u")),
             "wide": F.when(F.col("id") % 2 == 0, -1.0).otherwise(1.0) * F.pow(F.lit(10.0), F.col("u") * 600 - 300)}[shape]
    df = base.select(value.alias("x"))
    probs = [0.0, 0.05, 0.25, 0.333, 0.5, 0.95, 1.0]
    data = np.array([r[0] for r in df.collect()])
    got = q.quantiles(df, "x", probs).first()
    for p in probs:
        assert got[q.qname(p)] == pytest.approx(np.quantile(data, p), rel=1e-12)
    by = df.withColumn("k", F.when(F.col("x") < 0.7, "low").otherwise("high"))
    want = by.groupBy("k").agg(F.percentile("x", 0.5).alias("m")).collect()
    have = {r["k"]: r["p50"] for r in q.quantiles(by, "x", [0.5], ["k"]).collect()}
    assert all(have[r["k"]] == pytest.approx(r["m"], rel=1e-12) for r in want)


def test_quantile_rounds_count_few_digits(spark, monkeypatch):
    """No bracket's counts have more rows than a digit has values, and every rank is found without an error."""
    monkeypatch.setattr(q, "BITS", 4)
    seen = []
    count = q._count
    monkeypatch.setattr(q, "_count", lambda rows, digit: seen.append(count(rows, digit)) or seen[-1])
    df = spark.range(0, 5000, 1, 4).select(F.when(F.col("id") % 2 == 0, F.lit(3.0)).otherwise(F.exp(F.rand(5) * 50)).alias("x"))
    got = q.quantiles(df, "x", [0.1, 0.75]).first()
    data = np.array([r[0] for r in df.collect()])
    assert [got["p10"], got["p75"]] == pytest.approx(list(np.quantile(data, [0.1, 0.75])), rel=1e-12)
    assert 2 < len(seen) <= 16
    for counted in seen:
        assert max(r["count"] for r in counted.groupBy("g", "b").count().collect()) <= 16


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=60))
def test_ordered_keys_sort_as_numbers(spark, values):
    rows = [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, math.inf, -math.inf, 1.7976931348623157e308, *[2.0 ** e for e in range(-1070, 1020, 97)], *values]
    got = {r[0]: r[1] for r in frame(spark, rows).select("x", F.expr(ordered_key("x"))).collect()}
    keys = [got[v] for v in sorted(set(rows))]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    for v, k in got.items():
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert k == (bits if v >= 0 else -bits)


def test_ordered_keys_are_cheap(spark, capsys):
    """The JVM compiles no method of more than 8,000 bytes, and an interpreted key costs a hundred times as much."""
    frame(spark, [1.0, None]).selectExpr(f"{ordered_key('x')} AS key").explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_quantile_rounds_compute_a_key_once(spark, monkeypatch, capsys):
    """Keys are not computed again in filters that are derived from the joins of the later rounds."""
    monkeypatch.setattr(q, "BITS", 4)
    seen, count = [], q._count
    monkeypatch.setattr(q, "_count", lambda rows, digit: seen.append(rows) or count(rows, digit))
    df = spark.range(500).select(F.exp(F.col("id") / 9).alias("x"))
    q.quantiles(df, "x", [0.3]).collect()
    assert len(seen) > 1
    for rows in seen[1:]:
        rows.explain()
        plan = capsys.readouterr().out
        assert not any("Filter" in line and "LOG2" in line.upper() for line in plan.splitlines())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_quantiles_match_numpy(spark, values):
    got = q.quantiles(frame(spark, values), "x", [0.1, 0.5, 0.9]).first()
    for p in (0.1, 0.5, 0.9):
        assert got[q.qname(p)] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


def test_median_and_mode_fill(spark):
    df = spark.createDataFrame([(1, None, "b"), (2, 4.0, "a"), (3, 1.0, None), (4, float("nan"), "a"), (5, 2.0, "b")],
                               "id int, x double, s string")
    out = clean.fill_mode(clean.fill_median(df, ["x"]), "s").orderBy("id").collect()
    assert [r["x"] for r in out] == [2.0, 4.0, 1.0, 2.0, 2.0]
    assert [r["s"] for r in out] == ["b", "a", "a", "a", "b"]


def test_dedup_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "b")], "x int, s string")
    assert clean.dedup_rows(df).count() == 3
    assert clean.duplicate_count(df).first().asDict() == {"n_rows": 4, "distinct_rows": 3, "duplicate_rows": 1}


EVERY_TYPE = """b boolean, t tinyint, i int, l bigint, f float, d double, m decimal(20,6), s string, y binary, a date, z timestamp, n timestamp_ntz,
                u void, ad array<double>, st struct<x: string, y: array<struct<p: float, q: string>>>, mp map<string, array<int>>"""


def _every_type(rng):
    when = dt.datetime(2024, 1, 1, 0, 0, 0, rng.choice([1, 2]))
    number = rng.choice([0.0, -0.0, float("nan"), 1.5, None, float("inf")])
    text = rng.choice(["", "n", "1:a", "a", None, "é"])
    return (rng.choice([True, None]), 1, rng.choice([0, None]), 2 ** 40, number, number, rng.choice([decimal.Decimal("1.000001"), decimal.Decimal("1")]),
            text, rng.choice([b"", b"a", None]), rng.choice([dt.date(1, 1, 1), dt.date(9999, 12, 31)]), when, when, None,
            rng.choice([[0.0], [-0.0], [], None, [None], [float("nan")], [0.0, 1.0]]),
            rng.choice([None, (None, None), (text, [(number, "a"), (None, text)]), ("", [])]),
            rng.choice([None, {}, {"a": [1], "b": None}, {"b": None, "a": [1]}, {"ab": []}]))


def test_dedup_equals_distinct_on_every_type(spark):
    rng = random.Random(11)
    pool = [_every_type(rng) for _ in range(40)]
    df = spark.createDataFrame([rng.choice(pool) for _ in range(150)], EVERY_TYPE).repartition(3)
    for cols in ([c] for c in df.columns):
        part = df.select(*cols)
        assert clean.dedup_rows(part).count() == part.groupBy(*cols).count().count(), cols
    want = df.groupBy(*df.columns).count().count()
    assert clean.dedup_rows(df).count() == want and want < 150
    assert clean.duplicate_count(df).first().asDict() == {"n_rows": 150, "distinct_rows": want, "duplicate_rows": 150 - want}


def test_dedup_keeps_rows_that_differ_in_microseconds(spark):
    times = [dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 2)]
    df = spark.createDataFrame([(t,) for t in times + times[:1]], "ts timestamp")
    assert clean.dedup_rows(df).count() == 2 and clean.duplicate_count(df).first()["duplicate_rows"] == 1


def test_dedup_of_types_without_an_encoding(spark):
    df = spark.sql("SELECT INTERVAL '1' DAY * (id % 2) AS v, 'x' AS `a b` FROM range(6)")
    assert not can_encode(df.schema) and clean.dedup_rows(df).count() == 2
    assert clean.duplicate_count(df).first()["distinct_rows"] == 2
    lower = spark.sql("SELECT CAST(v AS STRING) COLLATE UTF8_LCASE AS v FROM VALUES ('a'), ('A') AS t(v)")
    assert clean.dedup_rows(lower).count() == 1


def test_encodings_of_neighbouring_columns_do_not_run_together(spark):
    df = spark.createDataFrame([("a", "1:b"), ("a1:b", ""), ("", "a1:b"), (None, "n"), ("n", None)], "x string, `y.z` string")
    assert clean.dedup_rows(df).count() == 5


def test_distinct_counts_of_every_type(spark, monkeypatch):
    rng = random.Random(12)
    df = spark.createDataFrame([_every_type(rng) for _ in range(300)], EVERY_TYPE).drop("u").withColumn("long", F.concat(F.lit("x" * 60), F.monotonically_increasing_id()))
    want = {c: df.where(F.col(c).isNotNull()).groupBy(c).count().count() for c in df.columns}
    for gathered in (5000, 3):
        monkeypatch.setattr(distinct, "GATHERED", gathered)
        got = distinct.distinct_counts(df, df.columns)
        assert {r["column"]: r["n_distinct"] for r in got.collect()} == want
    about = distinct.distinct_counts(df, ["long", "s"], exact=False).collect()
    assert abs(about[0]["n_distinct"] - 300) < 40
    assert distinct.distinct_counts(df.limit(0), ["s", "long"]).agg(F.sum("n_distinct")).first()[0] == 0


def test_few_values_are_sorted_and_bounded(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), "id", F.lit(None).cast("string").alias("none"))
    assert distinct.few_values(df, ["a", "id", "none"], 5) == {"a": [0, 1, 2], "id": None, "none": []}


def test_correlation_with_gaps_and_constants(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(1e6, 1, (400, 4))
    x[:, 3] = 0.1
    x[rng.random((400, 4)) < 0.2] = np.nan
    df = spark.createDataFrame([[float(v) for v in r] for r in x], "a double, b double, c double, d double").repartition(3)
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation(df, ["a", "b", "c", "d"]).collect()}
    want = pd.DataFrame(x, columns=list("abcd")).corr()
    for (i, j), r in got.items():
        assert r is None if "d" in (i, j) else r == pytest.approx(want.loc[i, j], abs=1e-9)
    assert all(r["r"] is None for r in profile.correlation(df.limit(0), ["a", "b"]).collect())


def test_funnel_and_observed_funnel_agree(spark):
    df = frame(spark, [None, 5.0, 30.0, 600.0])
    known, fits = F.col("x").isNotNull(), F.col("x").between(20, 500)
    table = clean.funnel(df, [("known", known), ("fits", fits)]).orderBy("position").collect()
    assert [(r["step"], r["n_rows"]) for r in table] == [("read", 4), ("known", 3), ("fits", 1)]
    seen = clean.RowFunnel()
    out = seen.watch(seen.watch(seen.watch(df, "read").where(known), "known").where(fits), "fits")
    out.collect()
    assert seen.counts() == [("read", 4), ("known", 3), ("fits", 1)]


def test_correlation_guards(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0, None), (2.0, 4.0, 7.0, 1.0), (4.0, 7.0, 7.0, 5.0), (3.0, 1.0, 7.0, 2.0)],
                               "a double, b double, c double, d double")
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation(df, ["a", "b", "c", "d"]).collect()}
    want = df.toPandas().astype(float).corr()
    assert len(got) == 16
    for (x, y), r in got.items():
        if "c" in (x, y):
            assert r is None
        else:
            assert r == pytest.approx(want.loc[x, y], abs=1e-12)
    ranked = profile.target_correlates(df, "a", ["b", "c", "d"]).collect()
    assert [r["feature"] for r in ranked][-1] == "c" and ranked[-1]["r"] is None


def test_drop_constant_and_column_choice(spark):
    df = spark.createDataFrame([(1, 5, None, "x"), (2, 5, None, "x")], "id int, a int, b int, s string")
    assert columns.drop_constant(df).columns == ["id"]
    assert columns.numeric_columns(df) == ["a", "b"]
    assert columns.distinct_list(["a", "b", "a"]) == ["a", "b"]
    assert columns.matching_columns(df, "^S") == ["s"]


def test_null_profile_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, None), (2.0, "b")], "x double, s string")
    got = {r["column"]: (r["nulls"], r["null_pct"]) for r in profile.null_profile(df).collect()}
    assert got == {"x": (2, 50.0), "s": (2, 50.0)}


def test_describe_matches_pandas(spark):
    values = [1.0, 2.0, 2.0, 9.0, None]
    got = profile.describe(frame(spark, values), ["x"]).first()
    want = pd.Series(values).describe()
    for name, key in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("25%", "p25"),
                      ("50%", "p50"), ("75%", "p75"), ("max", "max")]:
        assert got[key] == pytest.approx(want[name])


def test_value_counts_and_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("a",), ("c",)], "s string")
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    assert profile.value_counts(df, "s", keep_null=True).where("s = 'nan'").first()["n"] == 1
    assert [r["s"] for r in profile.ordered_counts(df, "s", ["c", "z", "a"]).collect()] == ["c", "a"]


def test_histogram_keeps_the_maximum_and_constant_columns(spark):
    got = charts.histogram(frame(spark, [0.0, 1.0, 2.0, 10.0]), "x", 5).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 1, 0, 0, 1]
    same = charts.histogram(frame(spark, [3.0, 3.0]), "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in same] == [2, 0, 0, 0]
    assert charts.histogram(frame(spark, []), "x").count() == 0


def test_kde_equals_the_plain_sum(spark):
    random.seed(5)
    values = [random.gauss(0, 1) for _ in range(300)] + [0.5] * 100
    df = frame(spark, values)
    x = np.array(values)
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    want = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(axis=1) / (len(x) * bw * math.sqrt(2 * math.pi))
    got = [r["density"] for r in charts.kde(df, "x", 50).orderBy("point").collect()]
    assert np.allclose(got, want, rtol=1e-9, atol=1e-11)


def test_kde_of_far_clusters_and_of_no_spread(spark):
    random.seed(6)
    values = [random.gauss(0, 1e-3) for _ in range(500)] + [1000 + random.gauss(0, 1) for _ in range(2000)] + [-1e5]
    x = np.array(values)
    bw = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-0.5 * ((grid[:, None] - x) / bw) ** 2).sum(axis=1) / (len(x) * bw * math.sqrt(2 * math.pi))
    got = [r["density"] for r in charts.kde(frame(spark, values), "x").orderBy("point").collect()]
    assert np.allclose(got, want, rtol=1e-8, atol=1e-12 * want.max())
    assert charts.kde(frame(spark, [2.0, 2.0]), "x").count() == 0
    assert {r["feature"] for r in charts.densities(frame(spark, values), ["x"]).collect()} == {"x"}


def test_box_stats_whiskers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 7.0)], "k string, v double")
    got = {r["k"]: r for r in charts.box_stats(df, "v", ["k"]).collect()}
    assert (got["a"]["whisker_low"], got["a"]["whisker_high"], got["a"]["n_outliers"]) == (1.0, 4.0, 1)
    assert got["b"]["n"] == 1


def test_hexbin_and_pairs_count_every_row(spark):
    df = spark.range(2000).select(F.rand(1).alias("x"), F.rand(2).alias("y"), F.rand(4).alias("z"))
    cells = charts.hexbin(df, ["x", "z"], "y")
    assert {r["feature"]: r["s"] for r in cells.groupBy("feature").agg(F.sum("n").alias("s")).collect()} == {
        "x": 2000, "z": 2000}
    pairs = charts.pair_bins(df, ["x", "y", "z"]).groupBy("x", "y").agg(F.sum("n").alias("s")).collect()
    assert len(pairs) == 6 and {r["s"] for r in pairs} == {2000}


def test_auto_bins_match_the_rule(spark):
    values = [float(v) for v in np.random.default_rng(1).gamma(2, 3, 500)]
    x = np.array(values)
    width = min(2 * (np.quantile(x, 0.75) - np.quantile(x, 0.25)) / 500 ** (1 / 3),
                (x.max() - x.min()) / (math.log2(500) + 1))
    got = charts.auto_bin_plan(frame(spark, values), ["x"]).first()
    assert got["bins"] == math.ceil((x.max() - x.min()) / width)


def test_box_stats_keep_the_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0), ("a", 50.0)], "g string, v double")
    for few in (False, True):
        got = {r["g"]: (r["median"], r["n"]) for r in charts.box_stats(df, "v", ["g"], few_groups=few).collect()}
        assert got == {None: (1.5, 2), "a": (26.5, 2)}


def test_digests_keep_equal_rows_equal(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0.0, "x" * 5000, None), (-0.0, "x" * 5000, None), (nan, "NaN", 1), (nan, "NaN", 1), (None, None, 1)],
                               "a double, b string, _row int")
    assert clean.dedup_rows(df).count() == 3 and clean.dedup_rows(df).columns == df.columns
    assert clean.duplicate_count(df).first()["duplicate_rows"] == 2
