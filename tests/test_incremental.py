"""Run-to-run comparison over two runs."""

from pyspark.sql import functions as F

from millrace.streaming import incremental as inc


def keys(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_snapshot_diff(spark):
    prev = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    curr = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    assert keys(inc.snapshot_diff(prev, curr, ["k"]), "k", "status") == [(1, "left"), (2, "kept"), (3, "new")]
    empty = prev.limit(0)
    assert keys(inc.snapshot_diff(empty, curr, ["k"]), "k", "status") == [(2, "new"), (3, "new")]
    assert keys(inc.snapshot_diff(prev, empty, ["k"]), "k", "status") == [(1, "left"), (2, "left")]


def run(stock, extract, history, when):
    fresh = inc.refresh_stock(stock, extract, key="k", order=["v"], run_time=F.lit(when), first_seen="seen", is_new="is_new")
    gone = inc.append_departed(stock, fresh, history, key="k", order=["v"], run_time=F.lit(when), left_at="left_at", is_new="is_new")
    return fresh, gone


def test_two_runs_keep_first_seen_and_append_once(spark):
    def extract(*ks):
        return spark.createDataFrame([(k, f"v{k}") for k in ks], "k int, v string")

    stock = extract().withColumn("seen", F.lit("")).withColumn("is_new", F.lit(0))
    history = stock.withColumn("left_at", F.lit(""))
    s1, h1 = run(stock, extract(1, 2, 2), history, "day1")
    assert keys(s1, "k", "seen", "is_new") == [(1, "day1", 1), (2, "day1", 1)] and h1.count() == 0
    s2, h2 = run(s1, extract(2, 3), h1, "day2")
    assert keys(s2, "k", "seen", "is_new") == [(2, "day1", 0), (3, "day2", 1)]
    assert keys(h2, "k", "left_at", "is_new") == [(1, "day2", 1)]
    # Key 1 returns and leaves again: its history row stays the first one.
    s3, h3 = run(s2, extract(1, 2), h2, "day3")
    s4, h4 = run(s3, extract(2), h3, "day4")
    assert keys(h4, "k", "left_at", "is_new") == [(1, "day2", 0), (3, "day3", 0)]
    report = inc.history_report(s4.withColumn("g", F.lit(1)), h4.withColumn("g", F.lit(1)), key="k", by=["g"]).first()
    assert (report["presented"], report["resolved"], report["still_open"]) == (3, 2, 1)


def test_new_events_normalise_keys(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "id int, req string, cause string, t string")

    before = frame([(1, "a ", "C01", "2024-01-01 10:00:00")])
    now = frame(
        [(2, "a", "c01 ", "2024-01-01 10:00:00.000"), (3, "a", "C02", "2024-01-01 10:00:00"), (4, " a", "c02", "2024-01-01 10:00:00"), (5, "b", None, None)]
    )
    got = inc.new_events(now, before, texts={"req": False, "cause": True}, time="t", order=["id"])
    assert keys(got, "id") == [(3,), (5,)]


def test_overlay_and_restart(spark):
    items = spark.createDataFrame([("r1",), ("r2",)], "req string")
    grants = spark.createDataFrame([(" r1 ", 1, "old"), ("r1", 2, "new"), ("", 3, "x")], "req string, n int, why string")
    got = inc.overlay_authorisations(items, grants, key="req", order=["n"], cols=["why"])
    assert keys(got.fillna("-"), "req", "authorised", "why") == [("r1", 1, "new"), ("r2", 0, "-")]
    log = spark.createDataFrame([("2024-01-05 09:00:00", "OK"), ("2024-01-08 09:00:00", "KO")], "ended string, state string")
    log = log.withColumn("ended", F.col("ended").cast("timestamp"))
    start = inc.restart_from(log, ended="ended", state="state", done="OK", default=F.lit("2024-01-01").cast("date"))
    assert str(start.first()[0]) == "2024-01-05"
    never = inc.restart_from(log.filter("state = 'KO'"), ended="ended", state="state", done="OK", default=F.lit("2024-01-01").cast("date"))
    assert str(never.first()[0]) == "2024-01-01"


def test_stored_snapshots_are_not_shuffled(spark, tmp_path):
    from millrace.streaming import incremental

    before = spark.createDataFrame([(i % 90, f"a{i % 90}", i) for i in range(200)] + [(None, "x", 0)], "k int, t string, v int")
    now = spark.createDataFrame([(i, f"a{i}", i) for i in range(40, 140)] * 2 + [(None, "x", 0)], "k int, t string, v int")
    keys = ["k", "t"]
    incremental.write_snapshot(before, "kept_before", keys, 4, str(tmp_path / "kept"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = incremental.diff_to_snapshot(now, "kept_before", keys, 4)
        want = incremental.snapshot_diff(before, now, keys)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        plan = got._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount" in plan
        new = incremental.not_in_snapshot(now, "kept_before", keys, 4)
        assert sorted((r["k"] is None, r["k"] or 0) for r in new.collect()) == sorted([(False, k) for k in range(90, 140)] * 2 + [(True, 0)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE kept_before")
