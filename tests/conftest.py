import pytest

from finquarry.session import build_session


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows(spark):
    """Literal rows as a DataFrame: rows("a int, b string", [(1, "x")])."""
    return lambda schema, data: spark.createDataFrame(data, schema)


@pytest.fixture
def tiny_chunks(spark):
    spark.conf.set("finquarry.split.rows", "25")
    yield
    spark.conf.unset("finquarry.split.rows")
