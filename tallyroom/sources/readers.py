"""Declarative reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.operators.gather import condition


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan. With a schema, a file that lacks one of its columns is an
    error instead of a column of NULLs."""
    df = spark.read.parquet(path)
    if schema is None:
        return df
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def read_entity_link(df: DataFrame, join_key: str, ids: DataFrame, id_column: str, columns: list[str]) -> DataFrame:
    """Rows of a dataset that belong to a set of entities."""
    wanted = ids.select(F.col(id_column).cast("string").alias("__id")).distinct()
    return df.join(wanted, df[join_key].cast("string") == wanted["__id"], "left_semi").select(*columns)


def read_search(df: DataFrame, columns: list[str], order_by: list[str], descending: bool = False,
                limit: int | None = None) -> DataFrame:
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in order_by]
    out = df.select(*columns).orderBy(*order)
    return out.limit(limit) if limit else out


def read_filtered(df: DataFrame, columns: list[str], filters: dict) -> DataFrame:
    """``filters = {combinator: AND | OR, conditions: [{column, op, value}]}``."""
    parts = [{**c, "field": c["column"]} for c in filters["conditions"]]
    key = "all" if filters.get("combinator", "AND").upper() == "AND" else "any"
    return df.where(condition({key: parts})).select(*columns)


def read_param_sql(spark: SparkSession, sql: str, args: dict, **tables: DataFrame) -> DataFrame:
    """SQL with bound parameters (``:name``) over DataFrames (``{name}``)."""
    return spark.sql(sql, args=args, **tables)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a table (an inline array of structs)."""
    fields = [f.split() for f in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(typ).alias(name) for v, (name, typ) in zip(row, fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
