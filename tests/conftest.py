"""Shared session and the reference's fixtures (see FIXTURES.md)."""

from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SCHEMA_VALIDE = "date string, produit string, vendeur string, montant decimal(18,2), quantite int"
SCHEMA_4 = "date string, produit string, vendeur string, montant decimal(18,2)"
VENDEURS = ["Alice", "Karim", "Lucie", "Thomas", "Nadia"]


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from salesflow.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


def D(x):
    return Decimal(str(x))


@pytest.fixture
def df_valide(spark):
    rows = [("2024-01-01", p, v, D(m), 2) for p, v, m in [
        ("Laptop Pro", "Alice", 2400), ("Smartphone X", "Karim", 1300),
        ("Tablette Air", "Lucie", 900), ("Écouteurs BT", "Thomas", 240),
        ("Montre Smart", "Nadia", 560)]]
    return spark.createDataFrame(rows, SCHEMA_VALIDE)


@pytest.fixture
def df_avec_nulls(spark):
    rows = [("2024-01-01", "Laptop Pro", "Alice", D(2400)), (None, "Smartphone X", "Karim", D(1300)),
            ("2024-01-01", None, "Lucie", D(900))]
    return spark.createDataFrame(rows, SCHEMA_4)


@pytest.fixture
def df_vide(spark):
    return spark.createDataFrame([], SCHEMA_4)


@pytest.fixture
def df_montants_negatifs(spark):
    rows = [("2024-01-01", "Laptop Pro", "Alice", D(m)) for m in (2400, -100, 0)]
    return spark.createDataFrame(rows, SCHEMA_4)


@pytest.fixture
def allowed(spark):
    return spark.createDataFrame([(v,) for v in VENDEURS], "vendeur string")
