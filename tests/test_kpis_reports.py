"""KPI and report semantics: ties, null keys, baskets, empty days."""

from decimal import Decimal

from salesflow.operators import kpis as K
from salesflow.operators import reports as R
from salesflow.operators import consolidate as C

S = "date string, produit string, vendeur string, montant decimal(18,2)"


def rows(spark, data, schema=S):
    return spark.createDataFrame([tuple(Decimal(str(x)) if isinstance(x, (int, float)) else x
                                        for x in r) for r in data], schema)


def test_tie_goes_to_smallest_key(spark):
    df = rows(spark, [("d", "B", "y", 100), ("d", "A", "x", 100), ("d", "C", "x", 50)])
    r = K.top_by_sum(df, "produit").first()
    assert r.top_produit == "A"
    k = K.kpis_final(df, by="date").first()
    assert k.top_produit == "A" and k.top_vendeur == "x"


def test_null_keys_dropped_or_kept(spark):
    df = rows(spark, [("d", None, "x", 500), ("d", "A", "x", 100)])
    assert K.top_by_sum(df, "produit").first().top_produit == "A"
    assert K.top_by_sum(df, "produit", keep_null=True).first().top_produit is None
    from salesflow.operators.enrich import with_margin
    assert K.kpis_sql(with_margin(df)).first().top_produit is None
    assert K.kpis_final(df).first().top_produit == "A"


def test_basket_variants_with_null_amount(spark):
    df = rows(spark, [("d", "A", "x", 100), ("d", "A", "x", 200), ("d", "A", "x", None)])
    assert K.kpis_basic(df).first().panier_moyen == 150.0   # mean of non-null
    assert K.kpis_final(df).first().panier_moyen == 100.0   # CA / rows


def test_margin_rate_from_rounded_sums(spark):
    from salesflow.operators.enrich import with_margin
    df = with_margin(rows(spark, [("d", "A", "x", 0.01), ("d", "A", "x", 0.01)]))
    k = K.kpis_final(df).first()
    assert k.marge_totale == 0.0 and k.taux_marge == 0.0
    k2 = K.kpis_sql(df).first()
    assert k2.taux_marge == 0.0


def test_days_processed_together(spark):
    df = rows(spark, [("d1", "A", "x", 10), ("d2", "B", "y", 20), ("d2", "A", "y", 5)])
    got = {r.date: (r.ca_total, r.nb_ventes, r.top_produit) for r in K.kpis_final(df).collect()}
    assert got == {"d1": (10.0, 1, "A"), "d2": (25.0, 2, "B")}


def test_calendar_and_empty_days(spark):
    df = rows(spark, [("2024-01-01", "A", "x", 10), ("2024-01-03", "A", "x", 10)])
    cal = K.calendar_between(df)
    k = {r.date: r.statut for r in K.with_empty_defaults(K.kpis_final(df, 5), cal).collect()}
    assert k == {"2024-01-01": "excellent", "2024-01-02": "vide", "2024-01-03": "excellent"}


def test_category_share_over_grand_total(spark):
    df = spark.createDataFrame([("A", Decimal("1")), ("A", Decimal("1")), ("B", Decimal("1"))],
                               "categorie string, montant decimal(18,2)")
    got = {r.categorie: r.part_pct for r in R.report_by_category(df).collect()}
    assert got == {"A": 66.7, "B": 33.3}


def test_ratio_of_sums_not_mean_of_ratios(spark):
    perf = spark.createDataFrame([(v, Decimal(c), Decimal(o)) for v, c, o in [
        ("Alice", 45000, 40000), ("Karim", 38000, 35000), ("Lucie", 22000, 25000),
        ("Thomas", 15000, 20000), ("Nadia", 31000, 30000)]],
        "vendeur string, ca decimal(18,2), objectif decimal(18,2)")
    assert R.overall_attainment(perf).first().atteinte_pct == 100.7
    st = {r.vendeur: r.statut for r in R.seller_performance(perf).collect()}
    assert st["Alice"] == "✓ Atteint" and st["Lucie"] == "✗ Non atteint"


def test_region_attainment_drops_unconfigured(spark):
    sales = spark.createDataFrame([("d", "PACA", Decimal("28000")), ("d", "Occitanie", Decimal("1"))],
                                  "date string, region string, montant decimal(18,2)")
    targets = spark.createDataFrame([("PACA", "paca", 35000)], "region string, code string, objectif bigint")
    r = R.region_attainment(sales, targets).collect()
    assert len(r) == 1 and r[0].atteinte == 80.0 and r[0].statut == "⚠ Proche"


def test_consolidated_status_is_strict(spark):
    df = spark.createDataFrame([("d", Decimal("50000")), ("e", Decimal("50000.5"))],
                               "date string, ca decimal(18,2)")
    got = {r.date: (r.ca_total, r.statut) for r in K.consolidated_kpis(df).collect()}
    assert got == {"d": (50000, "faible"), "e": (50000, "faible")}


def test_concat_skips_missing_and_fills_columns(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "z")], "x int, y string")
    out = C.concat([None, a, b.where("false"), b])
    assert sorted((r.x, r.y) for r in out.collect()) == [(1, None), (2, "z")]
    assert C.concat([None, None]) is None


def test_consolidate_long_view(spark):
    api = spark.createDataFrame([("d", "Alice", Decimal("1200"), "FALLBACK")] * 3,
                                "date string, vendeur string, montant decimal(18,2), source string")
    files = spark.createDataFrame([("d", "PACA", Decimal("500"), 5, "FICHIER_LOCAL")],
                                  "date string, region string, ca_region decimal(18,2), nb_ventes int, source string")
    cons = C.consolidate(api, files)
    got = sorted((r.dimension, r.valeur, float(r.ca), r.source) for r in cons.collect())
    assert got == [("region", "PACA", 500.0, "FICHIER_LOCAL"), ("vendeur", "Alice", 3600.0, "FALLBACK")]
    t = C.consolidated_total(cons).first()
    assert t.ca_total == 3600.0 and t.ca_texte == "3600"


def test_dedupe_latest_wins(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), ("j", 1, "only")],
                               "k string, v int, t string")
    assert sorted((r.k, r.t) for r in C.dedupe(df, ["k"], ["v"]).collect()) == [("j", "only"), ("k", "new")]


def test_all_null_amounts_day_under_ansi(spark):
    """A day whose amounts are all null: no division error, null basket."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        df = rows(spark, [("d", "A", "x", None), ("d", "B", "y", None)])
        r = K.kpis_basic(df).first()
        assert r.nb_ventes == 2 and r.panier_moyen is None
        from salesflow.functions.numeric import ratio
        z = spark.createDataFrame([(Decimal("1.00"), 0)], "a decimal(18,2), n bigint")
        assert z.select(ratio("a", "n", 2).alias("r")).first().r is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_kpis_of_an_empty_frame(df_vide):
    k = K.kpis_final(df_vide, by=None).first()
    assert (k.ca_total, k.marge_totale, k.taux_marge, k.nb_ventes, k.panier_moyen, k.atteinte_obj, k.statut) == (
        0.0, 0.0, 0.0, 0, 0.0, 0.0, "vide")
    b = K.kpis_basic(df_vide, by=None).first()
    assert (b.ca_total, b.nb_ventes, b.panier_moyen, b.top_produit) == (0.0, 0, 0.0, None)
    from salesflow.operators.enrich import with_margin
    q = K.kpis_sql(with_margin(df_vide), by=None).first()
    assert (q.ca_total, q.nb_ventes) == (None, 0)


def test_consolidated_empty_and_day_without_sellers(spark):
    from salesflow.operators import consolidate as C
    c = K.consolidated_kpis(spark.createDataFrame([], "date string, ca decimal(18,2)"), by=None).first()
    assert tuple(c) == (0, 0, "vide")
    rows = spark.createDataFrame([("d1", "region", "R", 5.0, "x"), ("d2", "vendeur", "A", 7.5, "x")],
                                 "date string, dimension string, valeur string, ca double, source string")
    assert {r.date: r.ca_texte for r in C.consolidated_total(rows).collect()} == {"d1": "N/A", "d2": "8"}


def test_metrics_of_days_without_stages(spark):
    from salesflow.operators import monitoring as M
    stages = spark.createDataFrame([("d1", "extract", 2.0)], "date string, stage string, seconds double")
    sales = spark.createDataFrame([("d1", 1.0), ("d2", 3.0)], "date string, montant double")
    got = {r.date: (r.duree_totale_s, r.nb_lignes) for r in M.run_metrics(stages, sales).collect()}
    assert got == {"d1": (2.0, 1), "d2": (0.0, 1)}


def test_ratio_rounds_once(spark):
    from fractions import Fraction
    from decimal import Decimal
    from salesflow.functions.numeric import ratio
    rows = [("15000.01", "1000001"), ("1", "8"), ("3", "8"), ("-1", "8"), ("2.50", "1"), ("0.05", "2"), ("1", "0"),
            ("99999999999999.99", "3"), ("12345.67", "1000003")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in rows], "a decimal(18,2), b decimal(18,2)")
    for scale in (0, 1, 2):
        got = df.select(ratio("a", "b", scale).alias("e"), ratio("a", "b", scale, half_even=False).alias("u")).collect()
        for (a, b), r in zip(rows, got):
            if b == "0":
                assert r.e is None and r.u is None
                continue
            x = Fraction(a) / Fraction(b) * 10 ** scale
            assert r.e == float(Fraction(round(x), 10 ** scale))
            up = int(abs(x) + Fraction(1, 2)) * (1 if x >= 0 else -1)
            assert r.u == float(Fraction(up, 10 ** scale))
