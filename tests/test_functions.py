import datetime as dt
import math

from pyspark.sql import functions as F

from lodestat.functions import features as fx, geo, hashing, parse


def one(df):
    return [r[0] for r in df.collect()]


def strings(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "s string")


def test_money_and_percent(spark):
    df = strings(spark, "$1,200.50", "", "N/A", "nan", "95%", None)
    assert one(df.select(parse.money("s"))) == [1200.5, None, None, None, None, None]
    assert one(df.select(parse.percent_number("s"))) == [None, None, None, None, 95.0, None]
    assert one(df.select(parse.percent_fraction("s"))) == [0, 0, 0, 0, 0.95, 0]
    # Only trailing signs are stripped for the fraction; all of them for the number.
    odd = strings(spark, "%95")
    assert one(odd.select(parse.percent_number("s"))) == [95.0]
    assert one(odd.select(parse.percent_fraction("s"))) == [0.0]


def test_flags(spark):
    df = strings(spark, "t", "f", "True", "1", "x", None)
    assert one(df.select(parse.flag_any("s"))) == [1, 0, 1, 1, 0, 0]
    assert one(df.select(parse.flag_tf("s"))) == [1, 0, None, 1, None, None]
    assert one(strings(spark, " ", "a", None).select(parse.presence_flag("s"))) == [0, 1, 0]


def test_area_and_dates(spark):
    df = strings(spark, "Camden 012A", "Camden 012a", " Hackney ", None)
    assert one(df.select(parse.strip_area_code("s"))) == ["camden", "camden 012a", "hackney", None]
    assert one(strings(spark, "2024-02-29", "2024-02-30", "x").select(parse.date_or_null("s"))) == [
        dt.date(2024, 2, 29), None, None]


def test_whole_rounds_before_the_cast(spark):
    assert one(spark.createDataFrame([(2.5,), (2.4,), (-2.6,)], "x double").select(parse.whole("x"))) == [3, 2, -3]


def test_seasons(spark):
    days = [dt.date(2024, m, 1) for m in (1, 3, 6, 9, 12)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert one(df.select(fx.season("d"))) == ["winter", "spring", "summer", "autumn", "winter", "autumn"]


def test_mentions_is_a_substring_search(spark):
    df = strings(spark, "Read my review", "VIEW", "none", None)
    assert one(df.select(fx.mentions("s", ["view"]))) == [1, 1, 0, None]
    assert one(df.select(fx.mentions("s", ["view"], whole_word=True))) == [0, 1, 0, None]


def test_scores_and_ratios(spark):
    df = spark.createDataFrame([(100.0, 4, 2, 1.0, None), (50.0, 0, 0, 0.0, 3.0)],
                               "price double, accommodates int, bedrooms int, bathrooms double, r double")
    assert one(df.select(fx.price_per_person("price", "accommodates"))) == [24.39, 0.0]
    assert [round(v, 6) for v in one(df.select(fx.luxury_score("bathrooms", "accommodates", "bedrooms")))] == [2.0, 0.0]
    assert one(df.select(fx.per_unit("price", "missing", False))) == [50.0, 25.0]
    assert one(df.select(fx.row_mean(["price", "r"]))) == [100.0, 26.5]
    assert one(df.select(fx.row_mean(["r"]))) == [None, 3.0]


def test_list_size_and_tenure(spark):
    assert one(strings(spark, "a, b", "", None).select(fx.list_size("s"))) == [2, 1, 1]
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (None,)], "d date")
    assert one(df.select(fx.tenure_years(F.col("d"), dt.date(2024, 1, 1)))) == [1.0, None]


def test_clip_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (1.0,), (9.0,)], "x double")
    assert one(df.select(fx.clip("x", F.lit(2.0), F.lit(5.0)))) == [None, 2.0, 5.0]
    assert one(df.select(fx.cap("x", F.lit(5.0)))) == [None, 1.0, 5.0]


def test_haversine(spark):
    cols = [F.lit(v) for v in (51.5, -0.12, 48.85, 2.35)]
    km = one(spark.range(1).select(geo.haversine_km(*cols)))[0]
    a, b, c, d = map(math.radians, (51.5, -0.12, 48.85, 2.35))
    want = 6371 * math.acos(math.sin(a) * math.sin(c) + math.cos(a) * math.cos(c) * math.cos(d - b))
    assert abs(km - want) < 1e-6
    far = one(spark.range(1).select(geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))))[0]
    assert abs(far - math.pi * 6371) < 1e-6


def test_hash_assignment(spark):
    df = spark.range(4000)
    a = df.select("id", hashing.is_test_row("id").alias("t"), hashing.fold_of("id", 5).alias("f"))
    b = df.repartition(7).select("id", hashing.is_test_row("id").alias("t"), hashing.fold_of("id", 5).alias("f"))
    assert a.exceptAll(b).isEmpty()
    share = a.agg(F.avg(F.col("t").cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.03
    sizes = {r["f"]: r["count"] for r in a.groupBy("f").count().collect()}
    assert set(sizes) == set(range(5)) and sum(sizes.values()) == 4000
