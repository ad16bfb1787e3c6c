"""File sources.  Each query writes driver-derived data to a
fresh folder under the shared checkpoint dir, reads it back with the
source operator and returns what was read."""

from pyspark.sql import functions as F

from salesflow.functions.text import code_key
from salesflow.registry import register
from salesflow.registry._sql import W, WB
from salesflow.registry.q_consolidate import region_files
from salesflow.session import scratch_path, unique_table
from salesflow.sinks.tables import ensure_table, replace_days
from salesflow.sources import (config_df, read_available, read_csv, read_json_records, read_many,
                               unreadable_files)
from salesflow.sources import scan
from salesflow.views import table, ventes, ventes_brutes

RAW_SCHEMA = ("date string, produit string, vendeur string, montant decimal(18,2), "
              "remise double, l_orderkey bigint, l_linenumber int")
REGION_SCHEMA = "date string, region string, ca_region decimal(18,2), nb_ventes bigint, source string"
VENTES_DDL = ("date string, produit string, categorie string, vendeur string, region string, "
              "quantite int, montant decimal(18,2), l_orderkey bigint, l_linenumber int")


def _raw_cols(df):
    return df.select("date", "produit", "vendeur", "montant", "remise", "l_orderkey", "l_linenumber")


@register("a1_read_csv", WB + """
SELECT date, '12" ' || produit || ', "neuf"' AS produit, vendeur, CAST(montant AS DOUBLE) AS montant, remise,
       l_orderkey, l_linenumber
FROM ventes_brutes""")
def a1_read_csv(spark, sf_dir):
    """Raw sales exported as CSV with missing values written as ``NA``, the
    columns in another order and quotes in the names; the reader goes by the
    header and maps NA tokens back to null."""
    path = scratch_path(spark, "a1")
    b = _raw_cols(ventes_brutes(spark, sf_dir))
    quoted = b.withColumn("produit", F.concat(F.lit('12" '), "produit", F.lit(', "neuf"')))
    quoted.select(*reversed(b.columns)).write.option("header", True).option("escape", '"') \
        .option("nullValue", "NA").csv(path)
    df = read_csv(spark, path, RAW_SCHEMA)
    return df.withColumn("montant", F.col("montant").cast("double"))


@register("a1_bad_cells", WB + """
SELECT l_linenumber, count(*) AS nb_lignes,
       CAST(sum(CASE WHEN remise IS NULL THEN 0 WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS BIGINT) AS nb_invalides,
       count(*) FILTER (WHERE remise IS NOT NULL AND l_linenumber <> 1) AS nb_lus
FROM ventes_brutes GROUP BY l_linenumber""")
def a1_bad_cells(spark, sf_dir):
    """Cells that are not of their type (``0.05x`` in the first lines) are
    null and counted; NA tokens are null and no fault."""
    path = scratch_path(spark, "a1-bad")
    text = F.when(F.col("l_linenumber") == 1, F.concat(F.col("remise").cast("string"), F.lit("x"))) \
        .otherwise(F.col("remise").cast("string"))
    ventes_brutes(spark, sf_dir).select("l_linenumber", text.alias("remise")) \
        .write.option("header", True).option("nullValue", "NA").csv(path)
    df = read_csv(spark, path, "l_linenumber int, remise double", bad_cells=True)
    return df.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.sum("_cellules_invalides").cast("bigint").alias("nb_invalides"),
        F.count("remise").alias("nb_lus"))


def write_region_files(spark, sf_dir, folder):
    """One folder of CSV files per region code (``code=<key>``)."""
    f = region_files(spark, sf_dir).withColumn("code", code_key("region"))
    f.write.partitionBy("code").option("header", True).csv(folder)
    return folder


_FILES_SQL = W + """,
files AS (SELECT date, region, sum(montant) AS ca_region, count(*) AS nb_ventes,
                 'FICHIER_LOCAL' AS source FROM ventes GROUP BY date, region)"""


@register("a2_read_many", _FILES_SQL + """
SELECT date, region, CAST(ca_region AS DOUBLE) AS ca_region, nb_ventes, source,
       lower(substr(region, 1, 3)) AS code FROM files""")
def a2_read_many(spark, sf_dir):
    folder = write_region_files(spark, sf_dir, scratch_path(spark, "a2"))
    df = read_many(spark, folder, REGION_SCHEMA, prefix="part-", suffix=".csv")
    return df.select("date", "region", F.col("ca_region").cast("double").alias("ca_region"),
                     "nb_ventes", "source",
                     F.regexp_extract("_file", r"code=([^/]+)/", 1).alias("code"))


@register("a3_read_available", _FILES_SQL + """
SELECT date, region, CAST(ca_region AS DOUBLE) AS ca_region, nb_ventes, source FROM files""")
def a3_read_available(spark, sf_dir):
    """A fixed list of region folders, one of which was never delivered."""
    folder = write_region_files(spark, sf_dir, scratch_path(spark, "a3"))
    paths = [f"{folder}/code={c}" for c in ("afr", "ame", "asi", "eur", "mid", "xyz")]
    df = read_available(spark, paths, REGION_SCHEMA)
    return df.select("date", "region", F.col("ca_region").cast("double").alias("ca_region"),
                     "nb_ventes", "source")


def put_file(spark, path, data):
    """Write one file's bytes through the file system that the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(data))
    out.close()


def drop_folder(spark, path):
    """Take back a folder that this query delivered."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@register("a2_mixed_headers", _FILES_SQL + """
SELECT date, region, CAST(ca_region AS DOUBLE) AS ca_region, nb_ventes, source FROM files""")
def a2_mixed_headers(spark, sf_dir):
    """Region exports that do not agree on the order of their columns, one of
    them with a column more: each file is read by its own header."""
    folder = scratch_path(spark, "a2-mixed")
    f = region_files(spark, sf_dir).withColumn("code", code_key("region"))
    for cond, cols in (("code = 'asi'", ["source", "nb_ventes", "ca_region", "region", "date"]),
                       ("code = 'eur'", ["ca_region", "date", "remarque", "region", "source", "nb_ventes"]),
                       ("code not in ('asi', 'eur')", ["date", "region", "ca_region", "nb_ventes", "source"])):
        f.where(cond).withColumn("remarque", F.lit('vu, "ok"')).select("code", *cols).write.mode("append") \
            .partitionBy("code").option("header", True).option("escape", '"').csv(folder)
    df = read_many(spark, folder, REGION_SCHEMA, prefix="part-", suffix=".csv")
    return df.select("date", "region", F.col("ca_region").cast("double").alias("ca_region"), "nb_ventes", "source")


@register("a3_unreadable", _FILES_SQL + """
SELECT lower(substr(region, 1, 3)) AS code, 'lu' AS etat, count(*) AS nb_lignes,
       CAST(sum(ca_region) AS DOUBLE) AS ca FROM files GROUP BY region
UNION ALL SELECT * FROM (VALUES ('abs', 'absent', 0, NULL), ('col', 'colonnes', 0, NULL), ('enc', 'encodage', 0, NULL),
                                ('gzi', 'illisible', 0, NULL), ('vid', 'vide', 0, NULL)) v""")
def a3_unreadable(spark, sf_dir):
    """The regions' files and five that no consolidation can use: a broken
    archive, one that is not UTF-8, one without a column, an empty and an absent
    one.  They are left out and named, each with its reason."""
    folder = write_region_files(spark, sf_dir, scratch_path(spark, "a3-bad"))
    head = b"date,region,ca_region,nb_ventes,source\n"
    put_file(spark, f"{folder}/code=gzi/part-0.csv.gz", b"\x1f\x8b\x08broken" + head)
    put_file(spark, f"{folder}/code=enc/part-0.csv", head + b"1995-01-01,\xe9\xff,1,1,X\n")
    put_file(spark, f"{folder}/code=col/part-0.csv", b"date,region,nb_ventes,source\n1995-01-01,COL,1,X\n")
    put_file(spark, f"{folder}/code=vid/part-0.csv", b"")
    paths = [f"{folder}/code={c}" for c in ("afr", "ame", "asi", "eur", "mid", "gzi", "enc", "col", "vid", "abs")]
    code = F.regexp_extract("_file", r"code=([^/]+)", 1).alias("code")
    read = read_available(spark, paths, REGION_SCHEMA).groupBy(code).agg(
        F.lit("lu").alias("etat"), F.count(F.lit(1)).alias("nb_lignes"), F.sum("ca_region").cast("double").alias("ca"))
    left = unreadable_files(spark, paths, REGION_SCHEMA).select(
        F.regexp_extract("fichier", r"code=([^/]+)", 1), "motif", F.lit(0).cast("bigint"), F.lit(None).cast("double"))
    return read.union(left)


def load_ventes_table(spark, sf_dir, name=None, rows=None):
    """ventes -> a date-partitioned warehouse table (B2 + B4 many days);
    ``rows``: the sales as they lie by day."""
    name = name or unique_table("ventes")
    ensure_table(spark, name, VENTES_DDL)
    v = (ventes(spark, sf_dir) if rows is None else rows).select(*[c.split()[0] for c in VENTES_DDL.split(", ")])
    replace_days(spark, v, name, grouped=rows is not None)
    return name


@register("a4_scan", W + """
SELECT date, l_orderkey, l_linenumber, CAST(montant AS DOUBLE) AS montant, vendeur FROM ventes""")
def a4_scan(spark, sf_dir):
    name = load_ventes_table(spark, sf_dir)
    return scan(spark, name).select("date", "l_orderkey", "l_linenumber",
                                    F.col("montant").cast("double").alias("montant"), "vendeur")


@register("a5_read_json_records", """
SELECT event_id AS id, user_id AS userId, event_type AS title FROM events""")
def a5_read_json_records(spark, sf_dir):
    """Records with extra fields; only id, userId, title are kept."""
    path = scratch_path(spark, "a5")
    table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("userId"),
        F.col("event_type").alias("title"), F.col("props").alias("body"), "value").write.json(path)
    return read_json_records(spark, path, "id bigint, userId bigint, title string, body string",
                             ["id", "userId", "title"])


STAGE_CONFIG = (("view", "extract"), ("click", "transform"), ("purchase", "load"))


@register("a8_config", """
SELECT e.event_id, coalesce(c.stage, 'autre') AS stage,
       coalesce(CAST(json_extract(e.props, '$.k') AS INTEGER), 0) AS k
FROM events e LEFT JOIN (VALUES ('view', 'extract'), ('click', 'transform'), ('purchase', 'load'))
     c(event_type, stage) ON e.event_type = c.event_type""")
def a8_config(spark, sf_dir):
    """A configuration frame (bounded: its literal rows) broadcast-joined
    to the events, a default stage where it has none, and JSON settings
    parsed with defaults."""
    from salesflow.sources.config import parse_config
    cfg = config_df(spark, STAGE_CONFIG, "event_type string, stage string")
    e = table(spark, sf_dir, "events")
    return e.join(F.broadcast(cfg), "event_type", "left").select(
        "event_id", F.coalesce("stage", F.lit("autre")).alias("stage"), parse_config("props", "k INT", {"k": 0})["k"].alias("k"))
