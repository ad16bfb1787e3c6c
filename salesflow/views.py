"""Driver tables -> the canonical sales shapes.

``ventes``: one row per sales line:
    date (yyyy-MM-dd of o_orderdate), produit (p_name), categorie (p_type),
    vendeur (s_name), region (r_name), quantite (INT), montant
    (DECIMAL(18,2) of l_extendedprice), prix (DECIMAL(18,2) retail price),
    l_orderkey, l_linenumber.

Join plan: the fact side (lineitem) is joined to orders on the order key
(a shuffle join at scale: both sides grow), to part on the part key and
to the supplier dimension.  Nation and region have a fixed size (25 and 5
rows) and are broadcast into the supplier side before it meets the fact
rows.  Part and supplier grow with the data, so no broadcast hint is
given: the planner broadcasts them only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans at run time
from real shuffle sizes; beyond that it falls back to a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.functions.dates import day_key
from salesflow.functions.numeric import MONEY

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


# The schemas of the driver tables, as Spark reads them.
# Giving them avoids a schema-inference job per table read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation + region (fixed size: 25 x 5 rows): (n_nationkey, region)."""
    return (table(spark, sf_dir, "nation")
            .join(F.broadcast(table(spark, sf_dir, "region")),
                  F.col("n_regionkey") == F.col("r_regionkey"))
            .select("n_nationkey", F.col("r_name").alias("region")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: (p_partkey, produit, categorie, prix)."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("produit"), F.col("p_type").alias("categorie"),
        F.col("p_retailprice").cast(MONEY).alias("prix"))


def lines(spark: SparkSession, sf_dir: str, facts: dict[str, DataFrame] | None = None) -> DataFrame:
    """lineitem + orders: the fact rows with their sale date.  ``facts`` gives
    other forms of the two tables (``salesflow.layout``)."""
    facts = facts or {n: table(spark, sf_dir, n) for n in ("lineitem", "orders")}
    li = facts["lineitem"]
    od = facts["orders"].select(
        "o_orderkey", day_key("o_orderdate").alias("date"), "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def ventes(spark: SparkSession, sf_dir: str, facts: dict[str, DataFrame] | None = None) -> DataFrame:
    """The canonical sales table (see module doc).

    The supplier scan is joined as it is (its size estimate is its file
    size, so the planner can broadcast it while it is small) and the
    fixed-size nation/region lookup is broadcast after it; joining the
    fact rows to a pre-joined supplier dimension would hide the supplier
    size behind a join estimate and force a shuffle of the fact rows.
    """
    sup = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", F.col("s_name").alias("vendeur"))
    return (lines(spark, sf_dir, facts)
            .join(products(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
            .join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(F.broadcast(geo(spark, sf_dir)), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("date", "produit", "categorie", "vendeur", "region",
                    F.col("l_quantity").cast("int").alias("quantite"),
                    F.col("l_extendedprice").cast(MONEY).alias("montant"),
                    "prix", "l_orderkey", "l_linenumber", "l_returnflag",
                    "l_linestatus", "l_discount"))


def ventes_brutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales as a source system would send them.

    Returned lines (``l_returnflag = 'R'``) arrive as refunds with a
    negative amount, and a discount of 0 arrives as missing (null
    ``remise``).  These are the defects the quality checks look for.
    """
    v = ventes(spark, sf_dir)
    return v.select(
        "date", "produit", "categorie", "vendeur", "region", "quantite",
        F.when(F.col("l_returnflag") == "R", -F.col("montant"))
         .otherwise(F.col("montant")).alias("montant"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("remise"),
        "l_orderkey", "l_linenumber")


def vendeurs_valides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed seller domain: suppliers in good standing (balance >= 0)."""
    return (table(spark, sf_dir, "supplier")
            .where(F.col("s_acctbal") >= 0)
            .select(F.col("s_name").alias("vendeur")))


# DuckDB text of the same views, for the SQL oracle.
VENTES_SQL = """
ventes AS (
  SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS date,
         p.p_name AS produit, p.p_type AS categorie,
         s.s_name AS vendeur, r.r_name AS region,
         CAST(l.l_quantity AS INTEGER) AS quantite,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS montant,
         CAST(p.p_retailprice AS DECIMAL(18,2)) AS prix,
         l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_linestatus, l.l_discount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

VENTES_BRUTES_SQL = VENTES_SQL + """,
ventes_brutes AS (
  SELECT date, produit, categorie, vendeur, region, quantite,
         CASE WHEN l_returnflag = 'R' THEN -montant ELSE montant END AS montant,
         CASE WHEN l_discount <> 0 THEN l_discount END AS remise,
         l_orderkey, l_linenumber
  FROM ventes)"""

VENDEURS_VALIDES_SQL = """
vendeurs_valides AS (SELECT s_name AS vendeur FROM supplier WHERE s_acctbal >= 0)"""


def customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer + nation + region: (c_custkey, region)."""
    return (table(spark, sf_dir, "customer")
            .join(F.broadcast(geo(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", "region"))


def objectifs_regions(spark: SparkSession, sf_dir: str, share: str = "0.2") -> DataFrame:
    """Daily region targets (date, region, objectif_region, source): a
    ``share`` of the value of the orders placed that day by the region's
    customers.  A (date, region) can have a target and no sales."""
    from decimal import Decimal
    o = table(spark, sf_dir, "orders").select(
        day_key("o_orderdate").alias("date"), "o_custkey",
        F.col("o_totalprice").cast(MONEY).alias("tp"))
    j = o.join(customer_regions(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("date", "region").agg(
        (F.sum("tp") * F.lit(Decimal(share))).cast(MONEY).alias("objectif_region")) \
        .withColumn("source", F.lit("SOURCE_SECONDAIRE"))


OBJECTIFS_SQL = """
objectifs AS (
  SELECT strftime(o.o_orderdate, '%Y-%m-%d') AS date, r.r_name AS region,
         CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) * 0.2 AS DECIMAL(18,2)) AS objectif_region
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2)"""
