"""The registered queries against their SQL, on the smallest tables; names and registration."""

import compare
import pytest
from conftest import SF

import __spark_entry__ as contract
from iotlake.llm.oracle import ORACLE
from iotlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    only_spark, only_sql, n = compare.differences(contract.queries()[name](spark, SF), db, ORACLE[name])
    assert not only_spark and not only_sql and n > 0


def test_every_operator_has_one_query():
    numbers = sorted(int(q.__name__[2:].split("_")[0]) for q in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(contract.queries()) >= {q.__name__ for q in QUERIES} | {"pipeline"}
