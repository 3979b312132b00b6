"""Session settings and the shared scratch location used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants; cluster-sized values (memory, executors, number of
# shuffle partitions) are left to the deployment.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JIT skips methods above 8000 bytes; beyond that size separate
    # per-operator code is faster than one fused method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults above plus ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def limit_methods(spark: SparkSession) -> None:
    """Hold whole-stage code to what the JIT compiles, in a session that has Spark's own limit."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, DEFAULTS[name])


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application.

    Arrow and pandas operators are imported by name in the workers, which know
    the driver's import path only where they share its machine and folder.
    """
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    folder = os.path.dirname(os.path.abspath(__file__))
    packed = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(packed, "w") as out:
        for base, _, names in os.walk(folder):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    out.write(path, os.path.join("millrace", os.path.relpath(path, folder)))
    context.addPyFile(packed)
    context._millrace_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder: on a cluster such a folder would be
    visible to one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "millrace-scratch")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written files survive the loss of any executor, and a later reader can
    prune columns from them, which an RDD checkpoint cannot.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
