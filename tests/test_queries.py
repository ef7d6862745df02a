"""Every registered query against its SQL twin."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

# the optional corpus operators have tests of their own
QUERIES, ORACLE = {k: v for k, v in queries().items() if k.startswith("q_")}, oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, sf_dir, name):
    if name not in ORACLE:
        assert QUERIES[name](spark, sf_dir).count() > 0
        return
    diff, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], sf_dir)
    assert diff is None, diff


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_claim_joins_lose_no_rows(spark, sf_dir):
    from claimweft.plans.adapters import claims, table

    n = table(spark, sf_dir, "lineitem").count()
    assert claims(spark, sf_dir).count() == n
    assert claims(spark, sf_dir, "claim_id").count() == n
