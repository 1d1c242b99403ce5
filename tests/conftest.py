import pytest

from tests.oracle import spark_session


@pytest.fixture(scope="session")
def spark():
    session = spark_session()
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows("a int, b string", [(1, "x")])`` as a DataFrame."""

    def make(schema, data):
        return spark.createDataFrame(data, schema)

    return make


def plan_of(df) -> str:
    """The physical plan before adaptive execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """The physical plan after running the query."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
