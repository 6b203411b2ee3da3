"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest data set."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import compare, duck
from tradestar.plans import catalog

KEYS = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, E.queries()[key], E.oracle_sql().get(key), SF_SMALL, con)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ano", "mes", "nome_mes", "total_exportacao", "total_importacao",
                          "saldo_comercial"]
    assert df.count() > 0


def test_every_key_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
