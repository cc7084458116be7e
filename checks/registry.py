"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudloom.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types that mean the same to every SQL engine: text, bigint, double."""
    out = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        out.append(column.alias(field.name))
    return df.select(*out)


def case(name: str, sql: str | None = None):
    """Register a query under ``name``; without ``sql`` only its rows are checked."""
    def register(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(prepare(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return register
