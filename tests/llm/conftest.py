import pytest

from samples import MESSY, SF, documents


@pytest.fixture(scope="session")
def messy(spark):
    return documents(spark, MESSY).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
