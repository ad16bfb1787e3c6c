"""Shared SQL fragments for the oracle (DuckDB dialect)."""

from salesflow.views import VENDEURS_VALIDES_SQL, VENTES_BRUTES_SQL, VENTES_SQL

# Parameters used by the registered queries, scaled to the driver data
# (line amounts run from about 900 to 105,000, so a day sells about
# 1,000,000 at every scale factor).
EDGES = (0, 20000, 70000, float("inf"))
SQL_EDGES = (0, 20000, 70000)
OBJECTIF = 1000000
MIN_LIGNES = 20
SEUIL = 800000

W = "WITH " + VENTES_SQL
WB = "WITH " + VENTES_BRUTES_SQL
WV = "WITH " + VENTES_SQL + "," + VENDEURS_VALIDES_SQL
WBV = "WITH " + VENTES_BRUTES_SQL + "," + VENDEURS_VALIDES_SQL


def snap(expr: str, scale: int, even: bool = True) -> str:
    """``num / den`` rounded once to ``scale`` digits as DOUBLE, in whole
    numbers: quotient, remainder and tie of 128-bit integers."""
    num, den = (f"CAST(replace(CAST(CAST({x} AS DECIMAL(38,4)) AS VARCHAR), '.', '') AS HUGEINT)"
                for x in expr.split(" / ", 1))
    n, d = f"(abs({num}) * {10 ** scale})", f"abs({den})"
    tie = f"({n} // {d}) % 2 = 1" if even else "true"
    up = f"CASE WHEN 2 * ({n} % {d}) > {d} OR (2 * ({n} % {d}) = {d} AND {tie}) THEN 1 ELSE 0 END"
    return f"(CASE WHEN {num} < 0 THEN -1 ELSE 1 END * CAST({n} // {d} + {up} AS DOUBLE) / {10 ** scale}.0)"


def bucket_sql(col: str, labels=("Petite", "Moyenne", "Grosse"), edges=SQL_EDGES,
               na: str | None = None) -> str:
    a, b, c = edges
    other = "NULL" if na is None else f"'{na}'"
    return (f"CASE WHEN {col} > {a} AND {col} <= {b} THEN '{labels[0]}' "
            f"WHEN {col} > {b} AND {col} <= {c} THEN '{labels[1]}' "
            f"WHEN {col} > {c} THEN '{labels[2]}' ELSE {other} END")


def top_sql(src: str, key: str, by: str = "date", keep_null: bool = False,
            value: str = "montant") -> str:
    """Per ``by``: the ``key`` with the largest sum, ties -> smallest key,
    null keys last (or dropped)."""
    where = "" if keep_null else f"WHERE {key} IS NOT NULL"
    return (f"(SELECT {by}, {key} AS top_{key} FROM (SELECT {by}, {key}, row_number() OVER "
            f"(PARTITION BY {by} ORDER BY coalesce(sum({value}), 0) DESC, {key} ASC NULLS LAST) AS rn "
            f"FROM {src} {where} GROUP BY {by}, {key}) WHERE rn = 1)")


def title_sql(col: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({col}, "
            f"'(\\p{{L}}+|[^\\p{{L}}]+)'), lambda x: upper(x[1:1]) || lower(x[2:])), '')")
