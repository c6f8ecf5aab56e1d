import pytest

from chronostar.session import ship_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def docs(spark):
    """A frame of (doc_id, text) rows with clashing extra columns."""

    def make(rows):
        df = spark.createDataFrame(list(rows), "doc_id long, text string")
        return df.selectExpr("'x' AS n_tokens", "doc_id", "1 AS `key`", "text", "2 AS score", "3 AS `_row`", "'z' AS spans")

    return make
