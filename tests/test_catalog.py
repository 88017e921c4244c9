import pytest

import __spark_entry__ as entry_point
import compare
from adpulse import catalog

# Optional parts are registered as well, but have their own tests.
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def database():
    from conftest import SF_DIR

    return compare.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, database, name):
    ours = compare.spark_result(QUERIES[name](spark, sf_dir))
    theirs = compare.duckdb_result(database, ORACLES[name])
    assert compare.difference(ours, theirs) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["window_start", "window_end", "campaign_id"]
