"""Sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a parquet path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt over the cores by ``keys`` where it arrives in fewer pieces than there are cores.

    A table in a few files that cannot be split would run everything up to the
    first exchange on a few cores. A table in many pieces stays as it is, so
    this costs nothing where tables are large.
    """
    context = df.sparkSession.sparkContext
    if df.rdd.getNumPartitions() >= context.defaultParallelism:
        return df
    return df.repartition(context.defaultParallelism, *keys)


def csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ";") -> DataFrame:
    """Delimited file with a header; without a schema the types are inferred."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def text_schema(*names: str) -> T.StructType:
    """All-text schema, the safe choice for files with decimal commas."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def ingestion_count(
    df: DataFrame, partition: Mapping[str, str], condition: Column | None = None, out: str = "n"
) -> DataFrame:
    """Rows ingested in one partition (for example year, month and day).

    The partition test compares the raw text columns, so only that partition
    is listed and read.
    """
    part = df
    for col, value in partition.items():
        part = part.filter(F.col(col) == F.lit(value))
    if condition is not None:
        part = part.filter(condition)
    return part.agg(F.count(F.lit(1)).alias(out))


def ingestion_by_day(df: DataFrame, time: str, kind: str, kinds: Sequence[str], out: str = "n") -> DataFrame:
    """Ingested rows per day and event kind in one pass over the source."""
    return (
        df.filter(F.col(kind).isin(list(kinds)))
        .groupBy(F.col(time).cast("date").alias("day"), kind)
        .agg(F.count(F.lit(1)).alias(out))
    )


# The daily ingestion checks: event names counted (None: all) and
# the extra condition on the new image, by feed.
INGESTION_FEEDS = {
    "notification": (["INSERT"], None),
    "timeline": (["INSERT"], "dynamodb.newimage.category.s <> 'VALIDATE_NORMALIZE_ADDRESSES_REQUEST'"),
    "mandate": (["INSERT", "MODIFY"], "dynamodb.newimage.pk.s <> 'DELEGHETRIGGERHELPER'"),
    "user_attributes": (
        None,
        "(dynamodb.newimage.pk.s LIKE 'AB#%' AND (dynamodb.newimage.sk.s LIKE 'LEGAL#%'"
        " OR dynamodb.newimage.sk.s LIKE 'COURTESY#%'))"
        " OR (dynamodb.newimage.pk.s LIKE 'CO#%' AND (dynamodb.newimage.sk.s LIKE 'TOS#%'"
        " OR dynamodb.newimage.sk.s LIKE 'DATAPRIVACY#%'))",
    ),
    "registry": (None, None),
    "asseveration": (None, None),
}


def feed_condition(feed: str) -> Column | None:
    names, extra = INGESTION_FEEDS[feed]
    condition = None if names is None else F.col("eventname").isin(names)
    if extra is None:
        return condition
    return F.expr(extra) if condition is None else condition & F.expr(extra)
