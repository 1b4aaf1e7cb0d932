"""Every registered query against its DuckDB oracle at sf0.01."""

import pytest

import __spark_entry__ as entry_mod
from paths import SF01
from harness import compare, duck
from vitrine.plans.oracle_sql import ORACLE
from vitrine.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    problems, n = compare(df, con, ORACLE[name])
    assert not problems, f"{name}: {problems}"


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["category_id", "offers_cnt"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 66
    assert set(QUERIES) <= set(entry_mod.queries()) and set(ORACLE) <= set(entry_mod.oracle_sql())
