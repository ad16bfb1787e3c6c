"""Configuration frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def ddl_schema(schema: T.StructType | str) -> T.StructType:
    """A DDL string (``"k INT, name STRING"``) as a StructType."""
    if isinstance(schema, T.StructType):
        return schema
    return SparkSession.active().createDataFrame([], schema).schema


def config_df(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str
              ) -> DataFrame:
    """A small configuration table from literal rows.  Its size is
    the length of ``rows``, so joins may broadcast it."""
    return spark.createDataFrame(list(rows), schema)


def parse_config(col: Column | str, schema: T.StructType | str, default: dict | None = None
                 ) -> Column:
    """JSON text -> struct; fields missing or unparsable take the
    ``default`` values (``Variable.get(..., default_var=...)``)."""
    c = F.col(col) if isinstance(col, str) else col
    st = ddl_schema(schema)
    parsed = F.from_json(c, st)
    if not default:
        return parsed
    fields = []
    for f in st.fields:
        v = parsed.getField(f.name)
        if f.name in default:
            v = F.coalesce(v, F.lit(default[f.name]).cast(f.dataType))
        fields.append(v.alias(f.name))
    return F.struct(*fields)
