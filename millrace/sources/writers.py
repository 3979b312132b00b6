"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite(df: DataFrame, target: str, partition_by: tuple[str, ...] = (), provider: str | None = None) -> None:
    """Replace a catalog table, or a parquet folder if ``target`` is a path.

    A folder is replaced in one commit by Spark's output committer; never pass
    a folder that ``df`` itself reads from.
    """
    if "/" in target:
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
        return
    writer = df.writeTo(target)
    if provider:
        writer = writer.using(provider)
    if partition_by:
        writer = writer.partitionedBy(*partition_by)
    writer.createOrReplace()


def write_pair(detail: DataFrame, summarise, detail_target: str, summary_target: str) -> None:
    """Write a detail table and the summary computed from it.

    The summary reads the detail that was just written instead of repeating
    its lineage, so nothing is computed twice and nothing has to fit a cache.
    """
    overwrite(detail, detail_target)
    spark = detail.sparkSession
    written = spark.read.parquet(detail_target) if "/" in detail_target else spark.table(detail_target)
    overwrite(summarise(written), summary_target)


def export_csv(df: DataFrame, path: str, sep: str = ";", single_file: bool = False) -> None:
    """Delimited text with a header.

    One file is for small reports only, as a single task then writes it; it is
    fed by a shuffle so that the work before it stays parallel.
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
