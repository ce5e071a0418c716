"""Every catalog query against its DuckDB SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SQL = {k: v for k, v in E.oracle_sql().items() if k not in E.LLM_ORACLE}


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_sql_or_is_a_model_fit():
    own = {q for q in E.queries() if q not in E.LLM_QUERIES}
    assert own - set(SQL) == {"gbt_predictions", "feature_importance"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, sf_small, name):
    r = compare(spark, con, E.queries()[name], SQL[name], sf_small)
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["transaction_date", "product_name", "destination_city"]
    assert df.count() > 0


def test_entry_schema_is_stable(spark):
    assert E.entry(spark).schema == E.entry(spark).schema
