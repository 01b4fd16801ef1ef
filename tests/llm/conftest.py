import pytest
from samples import CLASHING, SCHEMA, messy_rows


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, messy):
    """The same rows with columns of clashing names."""
    from pyspark.sql import functions as F

    extra = [c.strip().split(" ") for c in CLASHING.split(",")]
    return messy.withColumns({name: F.lit(None).cast(kind) for name, kind in extra})
