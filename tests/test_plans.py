import datetime as dt

from pyspark.sql import functions as F

from lodestat.plans import listings as pl, pricing
from lodestat.plans.catalog import QUERIES, long_tables
from lodestat.sources.fixtures import view

SF = "/root/testdata/sf0.001"


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_empty_listings_pass_through(spark):
    empty = view(spark, SF, "listings").where("1 = 0")
    parts = [view(spark, SF, n) for n in ("calendar", "crime", "stations", "tourist_spots", "income_house")]
    assert pl.enrich_listings(empty, *parts).count() == 0
    assert pl.model_features(pl.cleanse_for_model(pl.clean_listings(empty))).count() == 0


def test_enrichment_ignores_row_order_and_keeps_repeated_ids(spark):
    names = ("listings", "calendar", "crime", "stations", "tourist_spots", "income_house")
    parts = [view(spark, SF, n) for n in names]
    a = pl.enrich_listings(*parts)
    b = pl.enrich_listings(*[p.repartition(5).orderBy(F.rand(1)) for p in parts])
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    twice = pl.enrich_listings(parts[0].unionByName(parts[0]), *parts[1:])
    assert twice.count() == 2 * a.count()
    assert twice.distinct().exceptAll(a.distinct()).isEmpty()


def test_optional_columns_switch_features_on(spark):
    df = spark.createDataFrame([(1, 10.0, "t", "2020-01-01", 4.0, 2.0), (2, 20.0, "f", "bad", None, None)],
                               "id int, price double, instant_bookable string, host_since string, "
                               "review_scores_rating double, review_scores_value double")
    out = pl.model_features(df, as_of=dt.date(2021, 1, 1)).orderBy("id").collect()
    assert [r["instant_bookable"] for r in out] == [1, 0]
    assert [r["avg_review_score"] for r in out] == [3.0, None]
    assert out[0]["host_years"] == 366 / 365 and out[1]["host_years"] is None
    assert "distance_to_center" not in out[0].asDict() and "host_since" not in out[0].asDict()


def test_winsor_limits_can_come_from_the_training_rows(spark):
    train = spark.createDataFrame([(float(v),) for v in range(101)], "price double")
    test = spark.createDataFrame([(500.0,), (-3.0,), (None,)], "price double")
    got = [r["price"] for r in pl.winsorise(test, "price", fit_on=train).collect()]
    assert got == [95.0, 5.0, None]


def test_scans_read_only_what_a_query_needs(spark):
    """Column pruning and filters reach the parquet scan."""
    plan = QUERIES["dominant_season"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_linestatus:string,l_shipdate:timestamp_ntz>" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    clean = QUERIES["money_clean_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint>" in clean and "Exchange" not in clean


def test_broadcast_nearby_count_needs_no_shuffle_of_the_rows(spark):
    plan = QUERIES["points_within_radius"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "Cartesian" not in plan and "Join Cross" not in plan


def test_long_tables_digest_a_row_once(spark, capsys):
    """The digest stands below the step that makes a row per cell, where it is computed once a row."""
    df = spark.range(3).select("id", (F.col("id") / 3).alias("x"), F.lit("t").alias("t"))
    out = long_tables({"a": df})
    out.explain()
    lines = capsys.readouterr().out.splitlines()
    at = next(i for i, line in enumerate(lines) if "Generate" in line)
    assert any("sha2" in line for line in lines[at:]) and not any("sha2" in line for line in lines[:at])
    got = out.collect()
    assert len(got) == 9 and {(r["column"], r["value"]) for r in got if r["column"] == "x"} == {("x", "0.0"), ("x", "0.333333"), ("x", "0.666667")}


def test_the_registered_price_models_search_the_whole_grid(spark, monkeypatch):
    """All 48 combinations over 5 folds, and the other searches at their defaults."""
    scores = ("rmse_log", "mae_log", "r2_log", "rmse_real", "mae_real", "r2_real")
    df, asked = spark.createDataFrame([tuple(1.0 for _ in scores)], list(scores)), []

    def no_training(train, test, trials, key="id", folds=3, max_epochs=300, seed=42, rungs=None):
        asked.append((len(trials), len(set(trials.values())), folds, max_epochs, rungs))
        return pricing.PriceModel(trials[0], None, df, None, 0.0)

    monkeypatch.setattr(pl, "enrich_listings", lambda *parts: df)
    monkeypatch.setattr(pl, "cleanse_for_model", lambda enriched: enriched)
    monkeypatch.setattr(pricing, "encoded_sides", lambda *args, **kwargs: (df, df))
    monkeypatch.setattr(pricing, "search_and_refit", no_training)
    assert QUERIES["price_model_run"](spark, SF).count() == 3
    assert asked[1] == (48, 48, 5, 300, None)
    assert [(a[0], *a[2:]) for a in (asked[0], asked[2])] == [(10, 3, 300, None), (20, 4, 200, [10, 20, 40, 80, 160])]
