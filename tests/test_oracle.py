"""Every registered query against its SQL, and under other session zones."""

import compare
import pytest
from conftest import SF

import __spark_entry__ as contract

# The library's own queries; those of the training-data operators have tests of their own.
QUERIES = {query.__name__: query for query in contract._QUERIES}
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name in QUERIES}
WRITES_FILES = {name for name in QUERIES if name.startswith(("lake_", "stream_", "metrics_csv", "progress", "newest",
                                                             "recent", "replay"))} - {
    "lake_rows", "lake_rows_utc_keys", "lake_partitions"}


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF)


def check(spark, db, name):
    only_spark, only_sql, n = compare.differences(QUERIES[name](spark, SF), db, ORACLE[name])
    assert not only_spark and not only_sql
    assert n > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    check(spark, db, name)


@pytest.mark.parametrize("zone", ["America/Chicago", "Asia/Tokyo"])
@pytest.mark.parametrize("name", sorted(set(ORACLE) - WRITES_FILES))
def test_result_does_not_depend_on_the_session_zone(spark, db, settings, zone, name):
    with settings({"spark.sql.session.timeZone": zone}):
        check(spark, db, name)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["date", "hour", "n"]
    assert result.count() > 0
