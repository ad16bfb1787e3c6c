"""E10 by content: layers with equal counts and different rows."""

from pyspark.sql import functions as F

from salesflow.operators import digests as D
from salesflow.registry import register
from salesflow.registry._sql import W
from salesflow.views import ventes

COLS = ["date", "l_orderkey", "l_linenumber", "vendeur", "montant"]
_ALTERED_SQL = "l_returnflag = 'R' AND l_linenumber = 1 AND l_discount = 0"


def _layers(spark, sf_dir):
    """The source and a layer in which some amounts are a cent off."""
    v = ventes(spark, sf_dir)
    off = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1) & (F.col("l_discount") == 0)
    montant = F.when(off, F.col("montant") + F.lit("0.01").cast("decimal(18,2)")).otherwise(F.col("montant"))
    return v.select(*COLS), v.withColumn("montant", montant.cast("decimal(18,2)")).select(*reversed(COLS))


@register("e10_reconcile_content", W + f"""
SELECT date, count(*) AS nb_source, count(*) AS nb_charge, NOT bool_or({_ALTERED_SQL}) AS identique
FROM ventes GROUP BY date""")
def e10_reconcile_content(spark, sf_dir):
    source, loaded = _layers(spark, sf_dir)
    return D.reconcile_content({"source": source, "charge": loaded})


@register("e10_content_differences", W + f""",
e AS (SELECT date, l_orderkey, l_linenumber, vendeur, montant, 1 AS ecart FROM ventes WHERE {_ALTERED_SQL}
      UNION ALL
      SELECT date, l_orderkey, l_linenumber, vendeur, montant + 0.01, -1 FROM ventes WHERE {_ALTERED_SQL})
SELECT date, l_orderkey, l_linenumber, vendeur, CAST(montant AS DOUBLE) AS montant, CAST(sum(ecart) AS BIGINT) AS ecart
FROM e GROUP BY ALL HAVING sum(ecart) <> 0""")
def e10_content_differences(spark, sf_dir):
    source, loaded = _layers(spark, sf_dir)
    return D.content_differences(source, loaded).withColumn("montant", F.col("montant").cast("double"))
