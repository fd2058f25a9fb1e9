"""Registration helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import shared_folder as scratch  # noqa: F401
from registry.analogue_sql import with_tables
from registry.analogues import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Comparable output types: decimals and doubles rounded doubles, integers bigint, dates text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None, digits: int = 4):
    """Register a function of `Tables` under a query name, with its SQL."""

    def wrap(fn):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: tidy(fn(Tables(spark, folder)), digits)
        if sql is not None:
            ORACLE[name] = with_tables(sql, extra)
        return fn

    return wrap


def r(expr: str, name: str, digits: int = 4) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) AS {name}"


def rs(*names: str, digits: int = 4) -> str:
    return ", ".join(r(n, n, digits) for n in names)
