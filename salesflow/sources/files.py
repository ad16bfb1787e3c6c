"""File sources.  Schemas are always given, never inferred."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesflow.sources.config import ddl_schema

# The text tokens pandas ``read_csv`` reads as missing.
NA_VALUES = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null")


# Fixed value: what is raised when no source was delivered.
MSG_NOTHING = "Aucune donnée à consolider"
BAD_CELLS = "_cellules_invalides"


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             na_values: Sequence[str] = NA_VALUES, with_path: bool = False,
             bad_cells: bool = False, **options) -> DataFrame:
    """A1: headered CSV read by column name; NA tokens -> null.

    The header names the columns, in any order; columns outside ``schema``
    are left out, a column that the header lacks is an error, and so is a
    file whose header differs from the others' (``enforceSchema`` off).
    Quotes inside a cell are doubled.  Cells are read as text and cast: an
    NA token is null, and so is a cell that is not of its type;
    ``bad_cells`` adds their number per row as ``_cellules_invalides`` for
    the quality checks.  ``with_path`` adds the source file as ``_file``.
    Files without a header (no rows written) give no rows."""
    want = ddl_schema(schema)
    paths = path if isinstance(path, str) else list(path)
    base = {"header": "true", "escape": '"', **options}
    found = spark.read.options(**base).csv(paths).columns
    if not found:
        empty = spark.createDataFrame([], want)
        return empty.withColumn("_file", F.lit(None).cast("string")) if with_path else empty
    missing = [f.name for f in want.fields if f.name not in found]
    if missing:
        raise ValueError(f"columns absent from the header {found}: {missing}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in found])
    df = spark.read.schema(text).options(**base, enforceSchema="false").csv(paths)
    toks = [v for v in na_values if v != ""]
    raw = {f.name: F.when(~F.col(f"`{f.name}`").isin(toks), F.col(f"`{f.name}`")) if toks else F.col(f"`{f.name}`")
           for f in want.fields}
    cast = {f.name: raw[f.name] if isinstance(f.dataType, T.StringType) else raw[f.name].try_cast(f.dataType)
            for f in want.fields}
    cols = [cast[f.name].alias(f.name) for f in want.fields]
    if bad_cells:
        lost = [F.when(raw[n].isNotNull() & cast[n].isNull(), 1).otherwise(0) for n in raw]
        cols.append(sum(lost[1:], lost[0]).alias(BAD_CELLS))
    if with_path:
        cols.append(F.col("_metadata.file_path").alias("_file"))
    return df.select(*cols)


def same_path(c: Column) -> Column:
    """A file's path as every source spells it (``file:/x`` and ``file:///x``
    are one)."""
    return F.regexp_replace(c, "^file:/+", "file:/")


def to_open(file_path: str) -> str:
    """The path to open a file by, of its ``_metadata.file_path`` (an URI)."""
    return unquote(file_path)


def _lines(spark: SparkSession, paths: str | list[str], options: dict, tolerant: bool) -> DataFrame:
    """``_file``, ``_line``: the text of the files, blank lines aside."""
    kept = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup")}
    return (spark.read.options(**kept, ignoreCorruptFiles=str(tolerant).lower()).text(paths)
            .select(same_path(F.col("_metadata.file_path")).alias("_file"), F.col("value").alias("_line"),
                    F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_at"))
            .where(F.trim("_line") != ""))


def _layouts(spark: SparkSession, paths: str | list[str], names: list[str], options: dict, tolerant: bool
             ) -> tuple[DataFrame, int, int]:
    """The header of each file: ``_file``, ``_place`` (of each of ``names``,
    from 0), the most columns of a header, and the number of different headers.

    A header is the first line that holds every name as a cell.  Only such lines
    are sorted out; the driver gets the different headers, not the files'."""
    sep = options.get("sep", ",")
    holds = reduce(lambda x, y: x & y, (F.col("_line").contains(n) for n in names))
    lines = _lines(spark, paths, options, tolerant).where((F.col("_from") == 0) & holds)
    known = []
    for r in lines.select("_line").distinct().collect():
        cells = next(csv.reader([r["_line"].lstrip("\ufeff")], delimiter=sep))
        if set(names) <= set(cells):
            known.append((r["_line"], [cells.index(n) for n in names], len(cells)))
    layouts = spark.createDataFrame(known, "_line string, _place array<int>, _width int")
    heads = lines.join(layouts, "_line").groupBy("_file").agg(F.min_by("_place", "_at").alias("_place"))
    return heads, max((k[2] for k in known), default=0), len({tuple(k[1]) + (k[2],) for k in known})


def read_files(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
               na_values: Sequence[str] = NA_VALUES, tolerant: bool = False, **options) -> DataFrame:
    """A2/A3: many CSV files, each read by its own header, concatenated by
    name, with the file as ``_file``.

    Files may have their columns in any order and more of them than ``schema``.
    A file whose header lacks a column is an error; ``tolerant`` leaves it out,
    as it does a file that cannot be read or is not UTF-8 (``unreadable_files``
    names them).  Files that agree in their headers are read by the plain CSV
    reader.  Otherwise one scan reads all cells by position and a join with the
    files' headers puts them under their names: the work does not grow with the
    number of headers.
    """
    want = ddl_schema(schema)
    names = [f.name for f in want.fields]
    paths = path if isinstance(path, str) else list(path)
    heads, width, layouts = _layouts(spark, paths, names, options, tolerant)
    if not tolerant and layouts < 2:
        return read_csv(spark, paths, want, na_values, with_path=True, **options)
    cells = T.StructType([T.StructField(f"_c{n}", T.StringType()) for n in range(max(1, width))])
    rows = (spark.read.schema(cells).options(header="true", escape='"', enforceSchema="true",
                                             ignoreCorruptFiles=str(tolerant).lower(), **options).csv(paths)
            .select(F.array(*cells.names).alias("_cells"), F.col("_metadata.file_path").alias("_path")))
    if tolerant:
        heads = heads.join(_not_text(spark, paths, options), "_file", "left_anti")
    rows = rows.join(heads, same_path(F.col("_path")) == F.col("_file"), "inner" if tolerant else "left")
    if not tolerant:
        known = F.when(F.col("_place").isNotNull(), F.col("_place")).otherwise(
            F.raise_error(F.concat(F.lit(f"columns absent from the header, wanted {names}: "), "_path")))
        rows = rows.withColumn("_place", known)
    toks = [v for v in na_values if v != ""]
    out = []
    for n, f in enumerate(want.fields):
        cell = F.get("_cells", F.get("_place", F.lit(n)))
        cell = F.when(~cell.isin(toks), cell) if toks else cell
        out.append((cell if isinstance(f.dataType, T.StringType) else cell.try_cast(f.dataType)).alias(f.name))
    return rows.select(*out, F.col("_path").alias("_file"))


def _not_text(spark: SparkSession, paths: str | list[str], options: dict) -> DataFrame:
    """Files with a line that is not UTF-8."""
    lines = _lines(spark, paths, options, True)
    return lines.where(~F.is_valid_utf8("_line")).select("_file").distinct()


def unreadable_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str, **options) -> DataFrame:
    """The files that a tolerant read leaves out: ``fichier``, ``motif``
    (``absent``; ``vide``, no line; ``illisible``, bytes that give no line, such
    as a broken archive; ``encodage``, not UTF-8; ``colonnes``, a column is
    missing).  Files of no rows under a header are readable."""
    from salesflow.sources._fs import exists
    names = [f.name for f in ddl_schema(schema).fields]
    there = [p for p in paths if exists(spark, p)]
    kept = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup")}
    # the sources leave out files of no bytes: a path of nothing else shows no file
    bare = {p for p in there if spark.read.format("binaryFile").options(**kept).load(p).select("length").isEmpty()}
    out = spark.createDataFrame([(p, "vide" if p in bare else "absent") for p in paths if p in bare or p not in there],
                                "fichier string, motif string")
    there = [p for p in there if p not in bare]
    if not there:
        return out
    files = (spark.read.format("binaryFile").options(**kept).load(there)
             .select(same_path(F.col("_metadata.file_path")).alias("_file")))
    lines = _lines(spark, there, options, True).groupBy("_file").agg(F.bool_and(F.is_valid_utf8("_line")).alias("text"))
    heads = _layouts(spark, there, names, options, True)[0].select("_file", F.lit(True).alias("head"))
    why = (F.when(F.col("text").isNull(), "illisible")
           .when(~F.col("text"), "encodage").when(F.col("head").isNull(), "colonnes"))
    return out.union(files.join(lines, "_file", "left").join(heads, "_file", "left")
                     .select("_file", why.alias("motif")).where("motif is not null"))


def read_many(spark: SparkSession, folder: str, schema: T.StructType | str,
              prefix: str = "", suffix: str = ".csv", recursive: bool = True,
              na_values: Sequence[str] = NA_VALUES) -> DataFrame | None:
    """A2: every file in ``folder`` whose name starts with ``prefix`` and
    ends with ``suffix``, each by its own header, concatenated by name (with
    ``_file``); ``None`` when no file matches.  The listing is one distributed
    file index; the name rule is a glob filter."""
    from salesflow.sources._fs import any_file
    glob = f"{prefix}*{suffix}"
    if not any_file(spark, folder, glob, recursive):
        return None
    return read_files(spark, folder, schema, na_values, pathGlobFilter=glob, recursiveFileLookup=str(recursive).lower())


def read_available(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str,
                   on_empty: str = "error", na_values: Sequence[str] = NA_VALUES
                   ) -> DataFrame | None:
    """A3: read the paths that exist and can be read, each file by its own
    header; skip the others (``unreadable_files`` names them and says why).

    ``on_empty='error'`` raises when no path is left; ``'none'`` returns
    None."""
    from salesflow.sources._fs import exists
    present = [p for p in paths if exists(spark, p)]
    if not present:
        if on_empty == "error":
            raise ValueError(MSG_NOTHING)
        return None
    return read_files(spark, present, schema, na_values, tolerant=True)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str,
                      cols: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    """A5: JSON records -> table keeping ``cols`` (extra fields ignored).
    ``multi_line=True`` reads files that hold one JSON array."""
    df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    return df.select(*cols) if cols else df
