import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from cases import SCHEMA, rows  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward case; names of extra columns clash with result columns."""
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def table():
    """Rows of a table of the smallest test data, as tuples."""
    def read(sql: str) -> list[tuple]:
        return duckdb.sql(sql.replace("{sf}", SF)).fetchall()

    return read


@pytest.fixture(scope="session")
def run(spark):
    """A registered query over the smallest test data, as dicts by its first column."""
    import __spark_entry__ as contract

    def of(name: str) -> list[dict]:
        return [r.asDict() for r in contract.queries()[name](spark, SF).collect()]

    return of
