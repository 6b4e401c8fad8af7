import gzip

import pytest

from lodestat.plans import files
from lodestat.sources import readers
from lodestat.sources.writers import write_table


@pytest.fixture
def raw(tmp_path):
    """A small set of raw files with the shapes of the six sources."""
    folder = tmp_path / "raw"
    (folder / "crime" / "2024-01").mkdir(parents=True)
    (folder / "crime" / "2024-02").mkdir(parents=True)
    names = ["id", "latitude", "longitude", "price", "accommodates", "bedrooms", "beds", "bathrooms", "room_type",
             "property_type", "neighbourhood_cleansed", "name", "description", "amenities", "review_scores_rating",
             "number_of_reviews", "reviews_per_month", "availability_365", "availability_30", "host_is_superhost",
             "host_response_rate", "host_acceptance_rate", "unused"]
    lines = [",".join(names)]
    for i in range(120):
        price = ['"$1,200.00"', "$80.00", "$45.50", "", "$150.00", "$99.00"][i % 6]
        lines.append(",".join([
            str(i), f"{51.45 + i % 12 / 100}", f"{-0.2 + i % 9 / 50}", price, str(i % 5 + 1), str(i % 3),
            str(i % 4) if i % 7 else "", f"{i % 3}.5", ["Entire home", "Private room"][i % 2],
            ["Flat", "House", "Loft"][i % 3], ["Camden", " Hackney", "Bexley"][i // 6 % 3], f"Place {i}",
            '"Two\nlines, a ""view"""' if i % 4 == 0 else "Plain" if i % 4 == 1 else "",
            '"Wifi, Balcony"', f"{i % 6}.0" if i % 5 else "", str(i), f"{i % 4}.2", str(i * 3 % 366), str(i % 31),
            ["t", "f", ""][i % 3], f"{i % 100}%", "N/A", "x"]))
    (folder / "listings.csv").write_text("\n".join(lines) + "\n")
    with gzip.open(folder / "calendar.csv.gz", "wt") as f:
        f.write("listing_id,date,available,price\n")
        for i in range(120):
            f.write(f"{i},2024-01-0{i % 9 + 1},f,$9.00\n{i},2024-07-01,{'ft'[i % 2]},$9.00\n{i},2024-07-02,f,$9.00\n")
    (folder / "crime" / "2024-01" / "a.csv").write_text("Crime ID,LSOA name\n1,Camden 012A\n2,Hackney 001B\n")
    (folder / "crime" / "2024-02" / "b.csv").write_text("Crime ID,LSOA name\n3,Camden 013C\n4,\n")
    (folder / "stations.csv").write_text("name,latitude,longitude\na,51.50,-0.12\nb,51.46,-0.2\nc,bad,-0.2\n")
    (folder / "tourist_spots.csv").write_text("name,latitude,longitude\nt,51.5,-0.1\n")
    (folder / "income_house.csv").write_text(
        "Borough,Median House Price,Mean Household Income\nCamden,500000,50000\nCamden ,700000,60000\n")
    return str(folder)


def test_listings_keep_quoted_lines_and_types(spark, raw):
    df = readers.read_listings(spark, f"{raw}/listings.csv")
    assert df.count() == 120 and dict(df.dtypes)["accommodates"] == "int"
    first = df.where("id = 0").first()
    assert first["description"] == 'Two\nlines, a "view"' and first["price"] == "$1,200.00" and first["beds"] is None


def test_gzip_recursive_and_point_sources(spark, raw):
    calendar = readers.read_calendar(spark, f"{raw}/calendar.csv.gz", partitions=3)
    assert calendar.count() == 360 and calendar.rdd.getNumPartitions() == 3
    assert dict(calendar.dtypes)["date"] == "date"
    assert readers.read_crime(spark, f"{raw}/crime").count() == 4
    assert [r["latitude"] for r in readers.read_points(spark, f"{raw}/stations.csv").orderBy("name").collect()] == [
        51.5, 51.46, None]


def test_tolerant_reader_skips_only_long_lines(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('id,price,description\n1,5,"a \\"b\\" c"\n2,6\n3,7,x,too many\n4,8,"one, two\nthree"\n'
                    '5,9,"q,w",extra,more\n6,1,x,\n')
    got = {r["id"]: (r["price"], r["description"]) for r in readers.read_tolerant_csv(spark, str(path)).collect()}
    assert got == {"1": ("5", 'a "b" c'), "2": ("6", None), "4": ("8", "one, two\nthree")}
    strict = readers.read_tolerant_csv(spark, str(path), strict=True)
    assert {r["id"] for r in strict.select("id", "price", "description").collect()} == {"1", "4"}


def test_round_trip_and_errors(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b'), (2, None)], "id int, s string")
    for fmt in ("parquet", "csv"):
        write_table(df, f"{tmp_path}/{fmt}", fmt, single_file=True)
        back = readers.read_table(spark, f"{tmp_path}/{fmt}", fmt).orderBy("id").collect()
        assert [str(r["id"]) for r in back] == ["1", "2"] and back[0]["s"] == 'a "q", b' and back[1]["s"] is None
    with pytest.raises(Exception):
        write_table(df, f"{tmp_path}/parquet", mode="error")


def test_whole_run_from_raw_files(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    small = {"hidden": ["4"], "activation": ["relu"], "alpha": [0.0001], "learning_rate": [0.01], "batch_size": [32]}
    board = files.run(spark, raw, out, trials=2, grid=small, folds=2, grid_folds=2, max_epochs=3,
                      halving_trials=2, halving_folds=2, halving_epochs=3, rungs=[1])
    assert {r["model"] for r in board.collect()} == {
        "MLP random search", "MLP grid search", "MLP successive halving"}
    listings = spark.read.parquet(f"{out}/listings")
    # Four of six prices are readable and inside the range.
    assert listings.count() == 80 and listings.select("id").distinct().count() == 80
    camden = listings.where("area = 'camden'").first()
    assert (camden["area_crime_count"], camden["house_price"], camden["income"]) == (2, 600000, 55000)
    assert {r[0] for r in listings.select("dominant_season").distinct().collect()} <= {"winter", "summer"}
    model_input = spark.read.parquet(f"{out}/model_input")
    assert not {"segment", "price_per_person", "value_score", "log_price"} & set(model_input.columns)
    assert spark.read.parquet(f"{out}/segmented").where("segment IS NULL").isEmpty()
    described = spark.read.csv(f"{out}/data_dictionary", header=True)
    assert described.count() == len(listings.columns) and described.where("source = 'Unknown'").isEmpty()
