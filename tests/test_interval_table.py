import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators.events import validity_intervals
from millrace.operators.interval_table import IntervalTable
from millrace.session import scratch_root

HOW = dict(time="at", tie=["id"], active="active", start="s", end="e")


def log(spark, n=400, seed=5):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        at = base + dt.timedelta(hours=rnd.randint(0, 500))
        rows.append((i, rnd.choice(["a", "a", "a", *"bcdefgh", None]), at, rnd.choice([1, 1, 0, None]), rnd.choice([None, at - dt.timedelta(hours=2)]), rnd.choice([None, at + dt.timedelta(hours=9)])))
    return spark.createDataFrame(rows, "id int, k string, at timestamp, active int, s timestamp, e timestamp")


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def table(spark, **kw):
    return IntervalTable(spark, f"{scratch_root(spark).rstrip('/')}/interval-test-{uuid.uuid4().hex}", ["k"], **HOW, buckets=4, **kw)


@pytest.mark.parametrize("hot", [None, 20])
def test_extensions_equal_a_full_rebuild(spark, hot):
    df = log(spark)
    kept = table(spark, hot_rows=hot)
    kept.create(df.where("id % 3 = 0"))
    assert rows_of(kept.spans()) == rows_of(validity_intervals(df.where("id % 3 = 0"), ["k"], **HOW))
    kept.extend(df.where("id % 3 = 1 and (k <> 'c' or k is null)"))
    kept.extend(df.where("id % 3 <> 0 or id < 30"))  # some again, some new
    assert rows_of(kept.spans()) == rows_of(validity_intervals(df, ["k"], **HOW))
    assert rows_of(kept.events()) == rows_of(df)


def test_only_touched_buckets_are_written_again(spark):
    df = log(spark)
    kept = table(spark)
    kept.create(df.where("id >= 40"))
    _, before = kept._manifest()
    kept.extend(df.where("id < 40 and k = 'b'"))
    _, after = kept._manifest()
    changed = {b for b in after if after[b] != before.get(b)}
    assert len(changed) == 1 and len(after) > 1
    assert rows_of(kept.spans()) == rows_of(validity_intervals(df.where("id >= 40 or k = 'b'"), ["k"], **HOW))


def test_an_extension_without_manifest_is_not_seen(spark):
    df = log(spark)
    kept = table(spark)
    kept.create(df.where("id < 300"))
    want = rows_of(kept.spans())
    # A run that was lost before its manifest: its generation is there, but nothing names it.
    df.where("id >= 300").withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{kept.path}/events/generation=7")
    assert rows_of(kept.spans()) == want


def test_empty_tables_and_extensions(spark):
    df = log(spark)
    kept = table(spark)
    kept.create(df.limit(0))
    assert kept.spans().collect() == [] and "valid_from" in kept.spans().columns
    kept.extend(df.limit(0))
    kept.extend(df.where("active is null"))  # events without intervals
    assert kept.spans().collect() == []
    kept.extend(df)
    assert rows_of(kept.spans()) == rows_of(validity_intervals(df, ["k"], **HOW))
