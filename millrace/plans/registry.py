"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain_types(df: DataFrame) -> DataFrame:
    """Result columns as bigint, double, boolean or text.

    Dates and times become ISO text, so results compare the same in any
    client whatever its time zone.
    """
    cols = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            col = col.cast("bigint" if field.dataType.scale == 0 else "double")
        cols.append(col.alias(field.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, folder)`` under ``name`` with its SQL twin, if any."""

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain_types(fn(spark, folder))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap
