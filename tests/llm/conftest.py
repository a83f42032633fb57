import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark):
    def read(name, sf_dir=SF_DIR):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return read
