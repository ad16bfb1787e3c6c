"""B7 with reserved blocks of ids."""

from pyspark.sql import functions as F

from salesflow.registry import register
from salesflow.registry._sql import W
from salesflow.session import scratch_path, unique_table
from salesflow.sinks import ensure_table
from salesflow.sinks.id_blocks import append_with_id_blocks
from salesflow.views import ventes


@register("b7_id_blocks", W + """,
n AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'retours' ELSE 'ventes' END AS lot, count(*) AS nb FROM ventes GROUP BY 1)
SELECT lot, nb, nb AS nb_ids, CAST(CASE WHEN lot = 'retours' THEN 1 ELSE total - nb + 1 END AS BIGINT) AS premier,
       CAST(CASE WHEN lot = 'retours' THEN nb ELSE total END AS BIGINT) AS dernier
FROM n, (SELECT sum(nb) AS total FROM n)""")
def b7_id_blocks(spark, sf_dir):
    """Two loads and a replay of the first: blocks without gap or overlap."""
    v = ventes(spark, sf_dir).select("date", "l_orderkey", "l_linenumber", "montant", "l_returnflag")
    t, log = unique_table("cles"), scratch_path(spark, "ids")
    ensure_table(spark, t, "id bigint, date string, l_orderkey bigint, l_linenumber int, montant decimal(18,2), lot string", partition="lot")
    for lot, cond in (("retours", "l_returnflag = 'R'"), ("ventes", "l_returnflag <> 'R'"), ("retours", "l_returnflag = 'R'")):
        append_with_id_blocks(spark, v.where(cond).drop("l_returnflag"), t, ["l_orderkey", "l_linenumber"], log, lot)
    return spark.table(t).groupBy("lot").agg(
        F.count(F.lit(1)).alias("nb"), F.countDistinct("id").alias("nb_ids"), F.min("id").alias("premier"), F.max("id").alias("dernier"))
