"""Day routing: the reference's branch tasks become labels on daily
totals; the label can partition an output instead of choosing a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.functions.numeric import MONEY

# Fixed values from the reference: branch names and thresholds.
ALERT, NO_ALERT = "ALERTE", "RAS"
ROUTES = ("traitement_gros_volume", "traitement_volume_moyen", "traitement_faible_volume")
ROUTE_LIMITS = (10000, 3000)
STRATEGIES = ("traitement_standard", "traitement_volume_faible")


def _daily(df: DataFrame, key: str, amount: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(F.col(amount).cast(MONEY)).alias("_ca"))


def threshold_alert(df: DataFrame, seuil: float = 5000, key: str = "date",
                    amount: str = "montant") -> DataFrame:
    """Daily CA below ``seuil`` -> ALERTE, else RAS."""
    return _daily(df, key, amount).select(
        key, F.col("_ca").cast("double").alias("ca_total"),
        F.when(F.col("_ca") < F.lit(seuil), F.lit(ALERT)).otherwise(F.lit(NO_ALERT)).alias("alerte"))


def classify_day(df: DataFrame, limits=ROUTE_LIMITS, key: str = "date",
                 amount: str = "montant") -> DataFrame:
    """Three-way route per day: >= high, >= mid, else low."""
    hi, mid = limits
    return _daily(df, key, amount).select(
        key, F.col("_ca").cast("double").alias("ca_total"),
        F.when(F.col("_ca") >= hi, F.lit(ROUTES[0]))
         .when(F.col("_ca") >= mid, F.lit(ROUTES[1]))
         .otherwise(F.lit(ROUTES[2])).alias("traitement"))


def split_by(df: DataFrame, routes: DataFrame, path: str, key: str = "date",
             label: str = "traitement", fmt: str = "parquet") -> None:
    """D5, output side: write each day's rows under its route label
    (one write, partitioned by label and date; ``rebalance`` lets AQE
    split a hot day over several writers)."""
    (df.join(routes.select(key, label), key)
       .hint("rebalance", label, key)
       .write.mode("overwrite").partitionBy(label, key).format(fmt).save(path))


def choose_strategy(df: DataFrame, objectif: float = 50000, key: str = "date",
                    amount: str = "montant") -> DataFrame:
    """Raw day CA >= objectif -> standard, else low-volume strategy."""
    return _daily(df, key, amount).select(
        key, F.col("_ca").cast("double").alias("ca_brut"),
        F.when(F.col("_ca") >= F.lit(objectif), F.lit(STRATEGIES[0]))
         .otherwise(F.lit(STRATEGIES[1])).alias("strategie"))
