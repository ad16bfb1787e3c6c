"""Scalar expressions: bins, rounding, statuses, title case, keys."""

from decimal import Decimal

from salesflow.functions import labels as L
from salesflow.functions import numeric as N
from salesflow.functions import text as T
from salesflow.functions import dates as Dt


def test_bins_are_right_closed(spark):
    vals = [-5, 0, 0.01, 500, 500.01, 2000, 2000.01, None]
    df = spark.createDataFrame([(None if v is None else Decimal(str(v)),) for v in vals],
                               "m decimal(18,2)")
    got = [r.t for r in df.select(L.bucket("m").alias("t")).collect()]
    assert got == [None, None, "Petite", "Petite", "Moyenne", "Moyenne", "Grosse", None]
    txt = [r.t for r in df.select(L.bucket("m", na_label="nan").alias("t")).collect()]
    assert txt[0] == "nan" and txt[-1] == "nan"


def test_bins_infinite_last_edge(spark):
    df = spark.createDataFrame([(float("inf"),)], "m double")
    assert df.select(L.bucket("m", labels=L.LABELS_EN).alias("t")).first().t == "Large"


def test_rounding_conventions(spark):
    df = spark.createDataFrame([(Decimal("2.125"),), (Decimal("-2.125"),)], "x decimal(18,3)")
    r = df.select(N.round_even("x", 2).cast("double").alias("e"),
                  N.round_half_up("x", 2).cast("double").alias("u")).collect()
    assert (r[0].e, r[0].u) == (2.12, 2.13)
    assert (r[1].e, r[1].u) == (-2.12, -2.13)


def test_ratio_snaps_exact_ties(spark):
    df = spark.createDataFrame([(Decimal("1246127.88"), 24)], "ca decimal(18,2), n bigint")
    # exactly 51921.995 (a double quotient would be 51921.99499...): half to even -> .00
    assert df.select(N.ratio("ca", "n", 2).alias("p")).first().p == 51922.0


def test_status_two_way_uses_rounded_percentage(spark):
    df = spark.createDataFrame([(Decimal("99950"), Decimal("100000"))], "ca decimal(18,2), o decimal(18,2)")
    r = df.select(N.attainment("ca", "o", 1).alias("p")).select("p", L.status2("p").alias("s")).first()
    assert r.p == 100.0 and r.s == "✓ Atteint"


def test_status_rules(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("50000", "40000", "39999.99", "80000",
                                                          "80000.01", "50000.01")], "ca decimal(18,2)")
    r = df.select(L.status_vs_target("ca", 50000).alias("a"), L.status_fixed("ca").alias("b")).collect()
    assert [x.a for x in r] == ["excellent", "bon", "faible", "excellent", "excellent", "excellent"]
    assert [x.b for x in r] == ["faible", "faible", "faible", "bon", "excellent", "bon"]
    p = spark.createDataFrame([(100.0,), (99.99,), (80.0,), (79.9,)], "p double")
    assert [x.s for x in p.select(L.status_region("p").alias("s")).collect()] == \
        ["✓ Atteint", "⚠ Proche", "⚠ Proche", "✗ En dessous"]


def test_title_case_matches_python(spark):
    words = ["jean-pierre o'neil 3rd ÉLODIE", "alice", "KARIM", "", "a1b2", "  x  y"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = [r.t for r in df.select(T.title_case("s").alias("t")).collect()]
    assert got == [w.title() for w in words]


def test_file_keys(spark):
    df = spark.createDataFrame([("Île-de-France",), ("Grand Est",)], "r string")
    r = df.select(T.code_key("r").alias("c"), T.slug("r").alias("s")).collect()
    assert [x.c for x in r] == ["ile", "gra"]
    assert [x.s for x in r] == ["île-de-france", "grand_est"]


def test_margin_variants(spark):
    df = spark.createDataFrame([(Decimal("1250.00"),), (Decimal("1262.50"),)], "m decimal(18,2)")
    r = df.select(N.margin("m", 0.40, 0, as_int=True).alias("a"),
                  N.margin("m", 0.42, 2).alias("b")).collect()
    assert [x.a for x in r] == [500, 505]
    assert [x.b for x in r] == [Decimal("525.00"), Decimal("530.25")]


def test_date_keys(spark):
    df = spark.createDataFrame([("2024-01-31",)], "d string")
    r = df.select(Dt.nodash_key("d").alias("a"), Dt.month_key("d").alias("b"),
                  Dt.add_days("d", 1).alias("c")).first()
    assert (r.a, r.b, r.c) == ("20240131", "2024-01", "2024-02-01")


def test_lookup_mod_python_modulo(spark):
    from salesflow.operators.enrich import lookup_mod
    df = spark.createDataFrame([(1,), (7,), (-1,)], "u long")
    got = [r.v for r in lookup_mod(df, "u", ["A", "B", "C", "D", "E"], "v").collect()]
    assert got == ["B", "C", "E"]
