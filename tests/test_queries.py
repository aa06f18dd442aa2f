"""Every query with SQL must agree with it exactly; the others must bring rows."""

import pytest

import __spark_entry__ as contract
import check
from conftest import SF

# The same operators run on small tables in test_training and test_labels_balance.
HEAVY = {"train_ensemble", "tune"}


@pytest.fixture(scope="module")
def sql():
    return check.connect(SF)


@pytest.mark.parametrize("name", [n for n in contract.queries() if n not in HEAVY])
def test_query(spark, sql, name):
    got = contract.queries()[name](spark, SF).toPandas()
    if name in contract.oracle_sql():
        assert check.difference(got, sql.execute(contract.oracle_sql()[name]).df()) is None
    else:
        assert len(got)


def test_every_statement_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
