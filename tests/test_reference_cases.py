"""The reference's own test assertions, re-expressed on Spark frames.

The reference validates and computes KPIs for one frame; here the same
operators run per date, and ``by=None`` gives the whole-frame form.
"""

from decimal import Decimal

from pyspark.sql import functions as F

from salesflow.operators import enrich as En
from salesflow.operators import kpis as K
from salesflow.operators import quality as Q


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


class TestValidation:
    def test_valid_frame_passes(self, df_valide, allowed):
        r = one(Q.validate_testable(df_valide, allowed, by=None))
        assert r.valid is True and r.erreurs == [] and r.nb_lignes == 5

    def test_empty_frame_fails(self, df_vide, allowed):
        r = one(Q.validate_testable(df_vide, allowed, by=None))
        assert r.valid is False and "DataFrame vide" in r.erreurs

    def test_negative_amounts_detected(self, df_montants_negatifs, allowed):
        r = one(Q.validate_testable(df_montants_negatifs, allowed, by=None))
        assert r.valid is False
        assert any("négatif" in e.lower() for e in r.erreurs)
        assert "Montants négatifs : 2" in r.erreurs

    def test_unknown_seller_detected(self, df_valide, allowed):
        bad = df_valide.withColumn("vendeur", F.when(F.col("produit") == "Laptop Pro",
                                                     "VendeurInconnu").otherwise(F.col("vendeur")))
        r = one(Q.validate_testable(bad, allowed, by=None))
        assert r.valid is False
        assert r.erreurs == ["Vendeurs inconnus : {'VendeurInconnu'}"]

    def test_row_count(self, df_valide, allowed):
        assert one(Q.validate_testable(df_valide, allowed, by=None)).nb_lignes == 5

    def test_nulls_counted(self, df_avec_nulls, allowed):
        r = one(Q.validate_testable(df_avec_nulls, allowed, by=None))
        assert "Valeurs nulles : 2" in r.erreurs


class TestTransform:
    def test_margin_column(self, df_valide):
        assert "marge" in En.transform_testable(df_valide).columns

    def test_margin_value(self, df_valide):
        out = En.transform_testable(df_valide).select("montant", "marge").collect()
        for r in out:
            assert r.marge == (r.montant * Decimal("0.42")).quantize(Decimal("0.01"))

    def test_size_class_column_and_values(self, df_valide):
        vals = {r.taille_vente for r in En.transform_testable(df_valide).collect()}
        assert vals <= {"Petite", "Moyenne", "Grosse"}
        assert vals == {"Petite", "Moyenne", "Grosse"}

    def test_input_not_modified(self, df_valide):
        before = df_valide.collect()
        En.transform_testable(df_valide).collect()
        assert df_valide.collect() == before and "marge" not in df_valide.columns

    def test_seller_title_case(self, spark):
        from tests.conftest import SCHEMA_VALIDE, D
        mixed = spark.createDataFrame(
            [("2024-01-01", "Laptop Pro", v, D(100), 1)
             for v in ["alice", "KARIM", "lucie", "thomas", "nadia"]], SCHEMA_VALIDE)
        out = [r.vendeur for r in En.transform_testable(mixed).collect()]
        assert all(v[0].isupper() and v[1:].islower() for v in out)

    def test_rows_kept(self, df_valide):
        assert En.transform_testable(df_valide).count() == 5


class TestKpis:
    def test_ca_total(self, df_valide):
        assert one(K.kpis_basic(df_valide, by=None)).ca_total == 5400.0

    def test_nb_ventes(self, df_valide):
        assert one(K.kpis_basic(df_valide, by=None)).nb_ventes == 5

    def test_basket(self, df_valide):
        assert abs(one(K.kpis_basic(df_valide, by=None)).panier_moyen - 1080.0) < 0.01

    def test_top_product_among_inputs(self, df_valide):
        r = one(K.kpis_basic(df_valide, by=None))
        assert r.top_produit == "Laptop Pro" and r.top_vendeur == "Alice"

    def test_empty_frame_gives_zeros(self, spark, df_vide):
        cal = spark.createDataFrame([("2024-01-01",)], "date string")
        r = one(K.with_empty_defaults(K.kpis_final(df_vide), cal))
        assert r.ca_total == 0 and r.nb_ventes == 0 and r.statut == "vide"
        assert r.top_produit is None


class TestIntegration:
    def test_validate_then_transform(self, df_valide, allowed):
        assert one(Q.validate_testable(df_valide, allowed, by=None)).valid
        t = En.transform_testable(df_valide)
        assert t.count() == 5 and "marge" in t.columns

    def test_transform_then_kpis(self, df_valide):
        k = one(K.kpis_basic(En.transform_testable(df_valide), by=None))
        assert k.ca_total > 0 and k.nb_ventes == 5 and k.top_vendeur in {
            "Alice", "Karim", "Lucie", "Thomas", "Nadia"}

    def test_full_chain(self, df_valide, allowed):
        assert one(Q.validate_testable(df_valide, allowed, by=None)).valid
        k = one(K.kpis_basic(En.transform_testable(df_valide), by=None))
        assert abs(k.ca_total - 5400.0) / 5400.0 < 1e-2


def test_final_smoke(spark):
    """Three rows: valid with min 2 rows, CA 3940.0 against target 5000."""
    from tests.conftest import SCHEMA_VALIDE, D
    df = spark.createDataFrame(
        [("2024-01-01", "Laptop Pro", "Alice", D(2400), 2),
         ("2024-01-01", "Smartphone X", "Karim", D(1300), 2),
         ("2024-01-01", "Écouteurs BT", "Lucie", D(240), 2)], SCHEMA_VALIDE)
    assert one(Q.validate_final(df, min_lignes=2, by=None)).valid
    e = En.enrich_final(df)
    assert "marge" in e.columns
    k = one(K.kpis_final(e, objectif=5000, by=None))
    assert k.ca_total == 3940.0
    assert k.marge_totale == 1654.8 and k.taux_marge == 42.0
    assert k.panier_moyen == 1313.33 and k.atteinte_obj == 78.8 and k.statut == "faible"
