"""Validity intervals kept on disk and extended by late change events.

The table holds the change events and the intervals built from them, both dealt
into a fixed number of buckets by key. An extension rebuilds the intervals of
the touched keys only, from their old and new events; other keys' rows of the
same buckets are copied as they are, other buckets are not read. What it writes
is a new generation of the touched buckets. A manifest names the generation of
every bucket; it is written last, so readers see an extension as a whole or not
at all, and a run that is lost and repeated leaves nothing half done.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import presets
from millrace.operators.events import validity_intervals
from millrace.operators.ordered import HOT_ROWS
from millrace.session import materialise


class IntervalTable:
    """Intervals of one change log below ``path``; the names are those of :func:`validity_intervals`.

    ``time`` and ``tie`` tell the events of a key apart: an event that arrives
    again is kept once.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        *,
        time: str,
        tie: Sequence[str],
        active: str,
        start: str | None = None,
        end: str | None = None,
        open_end: str = presets.OPEN_END,
        buckets: int = 64,
        hot_rows: int | None = HOT_ROWS,
    ):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.identity = [*self.keys, time, *tie]
        self.how = dict(time=time, tie=list(tie), active=active, start=start, end=end, open_end=open_end, hot_rows=hot_rows)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")

    def _manifest(self) -> tuple[int, dict[int, int]]:
        """Latest generation, and that of every bucket that has rows (a row per bucket)."""
        rows = self.spark.read.parquet(f"{self.path}/manifest")
        last = rows.agg(F.max("generation")).first()[0]
        return last, {r["bucket"]: r["of"] for r in rows.where(F.col("generation") == last).collect() if r["bucket"] >= 0}

    def _read(self, what: str, buckets: Sequence[int] | None = None) -> DataFrame:
        _, held = self._manifest()
        paths = [f"{self.path}/{what}/generation={of}/bucket={b}" for b, of in sorted(held.items()) if buckets is None or b in buckets]
        schema = self.spark.read.parquet(f"{self.path}/{what}-schema").schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def spans(self) -> DataFrame:
        """The intervals in force, as :func:`validity_intervals` gives them."""
        return self._read("spans")

    def events(self) -> DataFrame:
        """All change events so far, each once."""
        return self._read("events")

    def _write(self, generation: int, held: dict[int, int], events: DataFrame, spans: DataFrame) -> None:
        for what, df in (("events", events), ("spans", spans)):
            # Large buckets are split over tasks, small ones share a file.
            dealt = df.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
            dealt.write.partitionBy("bucket").parquet(f"{self.path}/{what}/generation={generation}")
        written = self._buckets("events", events, generation)
        now = held | {b: generation for b in written}
        # Every bucket with events has a folder of spans too, if an empty one: reading names folders.
        for b in sorted(written - self._buckets("spans", spans, generation)):
            spans.limit(0).write.parquet(f"{self.path}/spans/generation={generation}/bucket={b}")
        rows = [(b, of) for b, of in now.items()] or [(-1, generation)]
        manifest = self.spark.createDataFrame(rows, "bucket int, of int").coalesce(1)
        manifest.write.parquet(f"{self.path}/manifest/generation={generation}")

    def _buckets(self, what: str, df: DataFrame, generation: int) -> set[int]:
        """Buckets that a generation has rows in."""
        schema = T.StructType([*df.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{what}/generation={generation}").select("bucket").distinct()
        return {r["bucket"] for r in rows.collect()}

    def create(self, log: DataFrame) -> None:
        """First generation, from a whole change log. An empty log gives an empty table."""
        events = materialise(log.dropDuplicates(self.identity), "change-events")
        spans = validity_intervals(events, self.keys, **self.how)
        events.limit(0).write.parquet(f"{self.path}/events-schema")
        spans.limit(0).write.parquet(f"{self.path}/spans-schema")
        if events.isEmpty():
            self.spark.createDataFrame([(-1, 0)], "bucket int, of int").coalesce(1).write.parquet(f"{self.path}/manifest/generation=0")
            return
        self._write(0, {}, events, spans)

    def extend(self, late: DataFrame) -> None:
        """Add change events that come later, in whatever order they happened."""
        generation, held = self._manifest()
        columns = self._read("events", []).columns
        late = materialise(late.select(*columns).withColumn("bucket", self._bucket()), "late-events")
        buckets = {r["bucket"] for r in late.select("bucket").distinct().collect()}  # at most one row per bucket
        if not buckets:
            return
        touched = late.select(*[F.col(k).alias(f"__k_{k}") for k in self.keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in self.keys])
        old_events, old_spans = self._read("events", buckets), self._read("spans", buckets)
        ours = old_events.join(touched, same, "left_semi").unionByName(late.drop("bucket")).dropDuplicates(self.identity)
        ours = materialise(ours, "touched-events")
        spans = validity_intervals(ours, self.keys, **self.how)
        self._write(
            generation + 1,
            held,
            old_events.join(touched, same, "left_anti").unionByName(ours),
            old_spans.join(touched, same, "left_anti").unionByName(spans),
        )
