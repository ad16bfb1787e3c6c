"""Registered queries against their SQL oracle (DuckDB) on sf0.001."""

import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

SF = os.environ.get("SALESFLOW_ORACLE_SF", "/root/testdata/sf0.001")
NAMES = sorted(E.oracle_sql())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    from salesflow import registry
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["date", "ca_total", "marge_totale", "taux_marge", "nb_ventes",
                          "panier_moyen", "top_produit", "top_vendeur", "atteinte_obj", "statut"]


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert info["ok"], info
