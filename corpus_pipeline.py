"""Corpus pipeline: stages over ``documents``, each written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import stages
from millrace.session import scratch_root

#: (name, function): each takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = stages.STAGES

#: No stage sequence of this kind has a SQL twin; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, by way of Parquet in the shared folder."""
    root = f"{scratch_root(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{root}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
