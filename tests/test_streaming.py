from lodestat.functions import parse
from lodestat.plans import listings as pl
from lodestat.sources.fixtures import view


def test_listing_cleaning_runs_on_a_stream(spark, tmp_path):
    """The row-wise plan has no action and no state, so it streams unchanged."""
    df = view(spark, "/root/testdata/sf0.001", "listings")
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    out = pl.clean_listings(stream).withColumn("rate", parse.percent_fraction("host_response_rate"))
    run = (out.writeStream.format("parquet").option("path", f"{tmp_path}/out")
           .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start())
    run.awaitTermination(120)
    stored = spark.read.parquet(f"{tmp_path}/out").drop("rate")
    want = pl.clean_listings(df)
    assert stored.count() == want.count() > 0 and stored.exceptAll(want).isEmpty()
