"""Every SQL-checkable key against its independent DuckDB query (sf0.001)."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

KEYS = list(E.oracle_sql())


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, sf_small, con, key):
    res = compare(spark, sf_small, [key], con=con, verbose=False)[key]
    assert "error" not in res, res
    assert res["cols_match"], res
    assert res["types_match"], res
    assert res["rows"][0] == res["rows"][1], res
    assert res["hash_match"], res


def test_every_registered_key_builds(spark, sf_small):
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    for k in E.SQL_KEYS:
        assert qs[k](spark, sf_small).columns


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["draft_id", "rank", "hero_id", "score", "synergy_score", "counter_score", "meta_score"]
    assert {r["rank"] for r in rows} <= {1, 2, 3}
