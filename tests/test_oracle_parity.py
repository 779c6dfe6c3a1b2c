"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from draftledger.plans.catalog import QUERIES
from tests import verify

SF = "/root/testdata/sf0.001"
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def report(spark):
    return verify.compare(spark, SF, KEYS, verbose=False)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(report, key):
    r = report[key]
    assert r["ok"] is True, r


def test_every_key_has_sql_and_is_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["draft_id", "rank", "title"]
