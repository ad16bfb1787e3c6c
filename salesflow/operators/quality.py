"""Data quality: one aggregation pass per rule set, reports per date.

Every check is an aggregate over the date groups (``by``), so one job
validates a whole history.  Checks that compare against a domain
(allowed sellers) use a left-anti join to the domain frame and collect
only the *distinct* unknown values per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.operators._common import By, by_list, group
from salesflow.session import scratch_path

# Fixed values from the reference: error messages of the two rule sets
# and the named health checks.
MSG_NULLS = "Valeurs nulles : %s"
MSG_EMPTY = "DataFrame vide"
MSG_NEGATIVE_COUNT = "Montants négatifs : %s"
MSG_NEGATIVE = "Montants négatifs ou nuls"
MSG_UNKNOWN = "Vendeurs inconnus : %s"
MSG_VOLUME = "Volume insuffisant : %s < %s"
MSG_GATE = "Validation échouée"
MSG_EMPTY_LOAD = "Aucune ligne chargée"
MSG_INCOMPLETE = "Couches incomplètes"
CHECK_NAMES = ("pas_de_nulls", "montants_positifs", "volume_ok", "vendeurs_valides")


def is_missing(df: DataFrame, c: str) -> Column:
    """pandas ``isnull``: SQL NULL, and NaN for floating columns."""
    col = F.col(c)
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def null_cells_expr(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """Per-row number of missing cells over ``cols`` (all columns by default)."""
    cols = list(df.columns if cols is None else cols)
    if not cols:
        return F.lit(0)
    terms = [is_missing(df, c).cast("int") for c in cols]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def null_cells(df: DataFrame, by: By = "date", cols: Sequence[str] | None = None) -> DataFrame:
    """Missing cells summed over all columns, per date."""
    return group(df, by).agg(F.sum(null_cells_expr(df, cols)).cast("bigint").alias("nb_nulls"))


def nonpositive(df: DataFrame, by: By = "date", col: str = "montant") -> DataFrame:
    """Rows with ``col <= 0`` (null amounts do not count)."""
    return group(df, by).agg(F.count_if(F.col(col) <= 0).alias("nb_non_positifs"))


def min_rows(df: DataFrame, n: int = 5, by: By = "date") -> DataFrame:
    """Row count and whether it reaches ``n``."""
    return group(df, by).agg(F.count(F.lit(1)).alias("nb_lignes")) \
        .withColumn("volume_ok", F.col("nb_lignes") >= n)


def unknown_rows(df: DataFrame, allowed: DataFrame, col: str = "vendeur",
                 by: By = "date") -> DataFrame:
    """E4, long form: one row per date and unknown value (null included);
    nothing is gathered into one row, so the number of values is free."""
    dom = allowed.select(F.col(allowed.columns[0]).alias(col)).distinct()
    return df.select(*by_list(by), col).distinct().join(dom, col, "left_anti")


def unknown_values(df: DataFrame, allowed: DataFrame, col: str = "vendeur",
                   by: By = "date") -> DataFrame:
    """Per date, the distinct values of ``col`` outside the
    ``allowed`` one-column domain; a null value counts as unknown.

    Distinct (date, value) pairs are formed first, so what is collected
    per date is bounded by the number of distinct unknown values.
    """
    keys = by_list(by)
    bad = unknown_rows(df, allowed, col, by)
    return group(bad, keys).agg(
        F.count(F.lit(1)).alias("nb_inconnus"),
        F.array_sort(F.collect_list(F.coalesce(F.col(col), F.lit("None")))).alias("inconnus"))


def _python_set_text(arr: Column) -> Column:
    """Render a sorted array like a Python set of strings: {'a', 'b'}."""
    quoted = F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("{"), F.array_join(quoted, ", "), F.lit("}"))


def _errors(*pairs: tuple[Column, Column]) -> Column:
    """array of messages whose condition holds, in rule order."""
    arr = F.array(*[F.when(cond, msg) for cond, msg in pairs])
    return F.filter(arr, lambda x: x.isNotNull())


def _with_expected(stats: DataFrame, expected: DataFrame | None, keys: list[str],
                   zeros: dict[str, int]) -> DataFrame:
    """Add the expected groups without rows, their counts 0."""
    if expected is None:
        return stats
    out = expected.select(*keys).distinct().join(stats, keys, "full")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast("bigint")) for c, v in zeros.items()})


def validate_testable(df: DataFrame, allowed: DataFrame | None, by: By = "date",
                      col: str = "vendeur", amount: str = "montant",
                      expected: DataFrame | None = None) -> DataFrame:
    """E6, step-9 rule set: nulls, empty, non-positive amounts, unknown
    sellers.  Output per date: valid, erreurs (array), nb_lignes.

    One pass: rows of a date, a value and two flags are joined to the
    (distinct) domain; counts are taken per date and unknown value (known
    rows fold to one per date and task), then per date, which collects the
    values: only unknown ones are held, no row is sorted.  ``expected`` (the dates that should have rows) adds the
    dates without any, which fail as empty."""
    keys = by_list(by)
    narrow = df.select(*keys, F.col(col).alias("_value"), null_cells_expr(df).alias("_nulls"),
                       (F.col(amount) <= 0).alias("_neg"))
    unknown = F.lit(None).cast("string")
    if allowed is not None:
        dom = allowed.select(F.col(allowed.columns[0]).alias("_dom")).distinct() \
                     .withColumn("_known", F.lit(True))
        narrow = narrow.join(dom, narrow["_value"] == dom["_dom"], "left")
        unknown = F.when(F.col("_known").isNull(), F.coalesce(F.col("_value").cast("string"), F.lit("None")))
    per = narrow.withColumn("_unknown", unknown).groupBy(*keys, "_unknown").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_nulls").alias("_nulls"), F.count_if("_neg").alias("_neg"))
    stats = group(per, keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("nb_lignes"),
        F.sum("_nulls").cast("bigint").alias("nb_nulls"),
        F.coalesce(F.sum("_neg"), F.lit(0)).alias("nb_neg"),
        F.array_sort(F.collect_set("_unknown")).alias("inconnus"))
    stats = _with_expected(stats, expected, keys, {"nb_lignes": 0, "nb_nulls": 0, "nb_neg": 0})
    stats = stats.withColumn("inconnus", F.coalesce("inconnus", F.array().cast("array<string>")))
    errs = _errors(
        (F.col("nb_nulls") > 0, F.format_string(MSG_NULLS, F.col("nb_nulls"))),
        (F.col("nb_lignes") == 0, F.lit(MSG_EMPTY)),
        (F.col("nb_neg") > 0, F.format_string(MSG_NEGATIVE_COUNT, F.col("nb_neg"))),
        (F.size("inconnus") > 0,
         F.format_string(MSG_UNKNOWN, _python_set_text(F.col("inconnus")))))
    return stats.select(*keys, (F.size(errs) == 0).alias("valid"), errs.alias("erreurs"),
                        "nb_lignes")


def validate_final(df: DataFrame, min_lignes: int = 5, by: By = "date",
                   amount: str = "montant", expected: DataFrame | None = None) -> DataFrame:
    """E6, final rule set: volume, nulls, non-positive amounts.
    Output per date: valid, erreurs (array), nb.  ``expected``: as in
    :func:`validate_testable`; a date without rows fails on its volume."""
    keys = by_list(by)
    stats = group(df, keys).agg(
        F.count(F.lit(1)).alias("nb"),
        F.sum(null_cells_expr(df)).cast("bigint").alias("nb_nulls"),
        F.count_if(F.col(amount) <= 0).alias("nb_neg"))
    stats = _with_expected(stats, expected, keys, {"nb": 0, "nb_nulls": 0, "nb_neg": 0})
    errs = _errors(
        (F.col("nb") < min_lignes, F.format_string(MSG_VOLUME, F.col("nb"), F.lit(min_lignes))),
        (F.col("nb_nulls") > 0, F.format_string(MSG_NULLS, F.col("nb_nulls"))),
        (F.col("nb_neg") > 0, F.lit(MSG_NEGATIVE)))
    return stats.select(*keys, (F.size(errs) == 0).alias("valid"), errs.alias("erreurs"), "nb")


def health_checks(df: DataFrame, allowed: DataFrame, min_lignes: int = 10, by: By = "date",
                  col: str = "vendeur", amount: str = "montant") -> DataFrame:
    """Named boolean checks per date as a map, plus the failing
    names.  ``montants_positifs`` is ``all(montant > 0)`` where a null
    amount fails; ``vendeurs_valides`` is ``all(isin)`` where null fails."""
    keys = by_list(by)
    dom = allowed.select(F.col(allowed.columns[0]).alias("_ok")).distinct() \
                 .withColumn("_known", F.lit(True))
    flagged = df.join(dom, df[col] == dom["_ok"], "left")
    stats = group(flagged, keys).agg(
        F.sum(null_cells_expr(df)).alias("_nulls"),
        F.bool_and(F.coalesce(F.col(amount) > 0, F.lit(False))).alias("_pos"),
        F.count(F.lit(1)).alias("_n"),
        F.bool_and(F.coalesce(F.col("_known"), F.lit(False))).alias("_known_all"))
    checks = F.create_map(
        F.lit(CHECK_NAMES[0]), F.col("_nulls") == 0,
        F.lit(CHECK_NAMES[1]), F.col("_pos"),
        F.lit(CHECK_NAMES[2]), F.col("_n") >= min_lignes,
        F.lit(CHECK_NAMES[3]), F.col("_known_all"))
    out = stats.select(*keys, checks.alias("checks"))
    failing = F.filter(F.array(*[F.when(~F.col("checks")[n], F.lit(n)) for n in CHECK_NAMES]),
                       lambda x: x.isNotNull())
    return out.withColumn("checks_echoues", failing)


class InvalidDays(ValueError):
    """A gate that stopped: how many groups failed and where the full
    report of them lies."""

    def __init__(self, message: str, count: int, path: str):
        super().__init__(message)
        self.count, self.path = count, path


def _stop(failing: DataFrame, what: str, path: str | None) -> None:
    """Write every failing row to ``path`` and raise if there is any."""
    if failing.isEmpty():
        return
    spark = failing.sparkSession
    path = path or scratch_path(spark, "rejets")
    failing.write.mode("overwrite").parquet(path)
    count = spark.read.parquet(path).count()
    raise InvalidDays(f"{what} : {count}, rapport complet : {path}", count, path)


def require_valid(report: DataFrame, valid: str = "valid", errors: str = "erreurs",
                  path: str | None = None) -> None:
    """Raise when any reported group is invalid.

    All invalid rows, messages joined with `` | `` as ``message``, are
    written to ``path`` (a fresh shared folder unless given); the error
    holds their exact number and that place.  Nothing of the report reaches
    the driver, so any number of days can fail."""
    bad = report.where(~F.coalesce(F.col(valid), F.lit(False)))
    _stop(bad.withColumn("message", F.array_join(F.col(errors), " | ")), MSG_GATE, path)


def quarantine(df: DataFrame, report: DataFrame, by: By = "date",
               valid: str = "valid", bounded: bool = False) -> tuple[DataFrame, DataFrame]:
    """E8, batch form: split rows into (accepted, rejected) by the report
    of their date, without stopping the whole history for one bad day.
    ``bounded``: the report has few groups (days), which go to the rows, so
    that these stay where they are."""
    keys = by_list(by)
    ok = report.where(F.col(valid)).select(*keys)
    ok = F.broadcast(ok) if bounded else ok
    return df.join(ok, keys, "left_semi"), df.join(ok, keys, "left_anti")


def verify_loaded(loaded: DataFrame, by: By = "date", expected: DataFrame | None = None,
                  stop: bool = False, path: str | None = None) -> DataFrame:
    """Rows per date after a load, with the zero-row failure flag.

    ``expected`` names the dates that were to be loaded (``by=None``: one
    load); one without rows is ``ok = false``, and ``stop`` raises on it."""
    keys = by_list(by)
    counts = group(loaded, keys).agg(F.count(F.lit(1)).alias("nb_lignes"))
    if keys:
        counts = _with_expected(counts, expected, keys, {"nb_lignes": 0})
    out = counts.withColumn("ok", F.col("nb_lignes") > 0)
    if stop:
        _stop(out.where("not ok"), MSG_EMPTY_LOAD, path)
    return out


def reconcile(layers: dict[str, DataFrame], key: str = "date", stop: bool = False,
              path: str | None = None) -> DataFrame:
    """Per date, row counts in each layer (0 when absent) and whether
    every layer has rows; ``stop`` raises when one has none.  Counts are aggregated per layer before the
    union, then pivoted on the known layer names."""
    names = list(layers)
    counts = None
    for name, df in layers.items():
        c = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(name))
        counts = c if counts is None else counts.unionByName(c)
    wide = counts.groupBy(key).pivot("layer", names).agg(F.first("n"))
    filled = wide.select(key, *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(f"nb_{n}")
                                for n in names])
    complete = F.lit(True)
    for n in names:
        complete = complete & (F.col(f"nb_{n}") > 0)
    out = filled.withColumn("complet", complete)
    if stop:
        _stop(out.where("not complet"), MSG_INCOMPLETE, path)
    return out


def load_summary(df: DataFrame, by: By = "date", amount: str = "montant") -> DataFrame:
    """nb_lignes, ca_brut, is_valid (rows present) per date."""
    return group(df, by).agg(
        F.count(F.lit(1)).alias("nb_lignes"),
        F.sum(F.col(amount).cast("decimal(18,2)")).cast("double").alias("ca_brut")) \
        .withColumn("is_valid", F.col("nb_lignes") > 0)


def is_empty(df: DataFrame, calendar: DataFrame | None = None, key: str = "date") -> DataFrame:
    """E5: per calendar date, whether the frame has no row for it.  The
    calendar defaults to every day between the first and the last date,
    derived from the per-date counts (one pass over the rows)."""
    present = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if calendar is None:
        from salesflow.operators.kpis import calendar_between
        calendar = calendar_between(present, key)
    return calendar.select(key).distinct().join(present, key, "left").select(
        key, F.coalesce(F.col("_n"), F.lit(0)).alias("nb_lignes"),
        F.col("_n").isNull().alias("vide"))


def any_all(df: DataFrame, by: By = "date", any_: dict | None = None,
            all_: dict | None = None) -> DataFrame:
    """Per date, ``bool_or`` of each ``any_`` condition and
    ``bool_and`` of each ``all_`` condition (a null condition counts as
    false, as pandas ``.any()`` / ``.all()`` on a comparison do)."""
    aggs = [F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in (any_ or {}).items()]
    aggs += [F.bool_and(F.coalesce(c, F.lit(False))).alias(n) for n, c in (all_ or {}).items()]
    return group(df, by).agg(*aggs)


def distinct_values(df: DataFrame, col: str, by: By = "date") -> DataFrame:
    """Per date, the number and the sorted set of distinct values.
    Distinct (date, value) pairs are formed first (a shuffle on both),
    so a date's set is bounded by its distinct values."""
    keys = by_list(by)
    d = df.select(*keys, col).where(F.col(col).isNotNull()).distinct()
    return group(d, keys).agg(F.count(F.lit(1)).alias(f"nb_{col}"),
                              F.array_sort(F.collect_list(col)).alias(f"{col}s"))


def value_chunks(df: DataFrame, col: str, size: int, by: By = "date") -> DataFrame:
    """E4/G15 without a limit on the number of values: the sorted distinct
    non-null values of a group in rows of ``size`` (``morceau`` from 0, the last
    one shorter), with the chunk's and the group's exact counts.

    No row and no task holds a group's values: distinct (group, value) pairs
    are range-partitioned and sorted, so a large group spans partitions; they
    are checkpointed (the positions below rest on that partitioning), and a
    value's rank is its position in its partition plus the group's values in
    the partitions before, of which there is one row a partition and group."""
    keys = by_list(by)
    pairs = df.select(*keys, F.col(col).alias("_v")).where("_v is not null").distinct()
    placed = pairs.repartitionByRange(*keys, "_v").sortWithinPartitions(*keys, "_v") \
        .withColumn("_pid", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()).checkpoint()
    parts = placed.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    group_parts = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    offsets = parts.select(
        F.col("_pid").alias("_p"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "_first",
        F.sum("_n").over(group_parts).alias("nb_total"),
        (F.sum("_n").over(group_parts.orderBy("_pid")) - F.col("_n")).alias("_before"))
    same = F.col("_pid") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    ranked = placed.join(offsets, same).withColumn(
        "morceau", F.floor((F.col("_before") + F.col("_pos") - F.col("_first")) / size).cast("bigint"))
    return ranked.groupBy(*keys, "morceau").agg(
        F.count(F.lit(1)).alias("nb"), F.max("nb_total").alias("nb_total"), F.array_sort(F.collect_list("_v")).alias("valeurs"))
