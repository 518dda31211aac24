"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from sf_dirs import SF_SMALL  # noqa: E402

from postmart.catalog import QUERIES as OWN  # noqa: E402

QUERIES = {name: E.queries()[name] for name in OWN}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert result[1] == "OK", result


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["platform_name", "company_name", "n_postings"]
    assert df.count() > 0
