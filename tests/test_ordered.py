"""Hot groups in pieces must give exactly what one window gives."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators import ordered
from millrace.operators.ordered import Running


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(5)
    data = []
    for i in range(1200):
        group = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
        value = None if rnd.random() < 0.1 else rnd.randint(-20, 20)
        data.append((group, rnd.randint(0, 5), i, value))
    return spark.createDataFrame(data, "g string, k int, id int, v int").cache()


def by_key():
    return [F.col("k").asc(), F.col("id").asc()]


def collect(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("group", [["g"], []])
def test_running_values(rows, group):
    outs = {
        "n": Running("count"),
        "s": Running("sum", F.col("v")),
        "hi": Running("max", F.col("v")),
        "lo": Running("min", F.col("v")),
        "prev": Running("last", F.col("v"), exclusive=True),
    }
    want = ordered.running(rows, group, by_key(), outs, hot_rows=None)
    got = ordered.running(rows, group, by_key(), outs, hot_rows=200, piece_rows=60)
    assert collect(got) == collect(want)


@pytest.mark.parametrize("group", [["g"], []])
def test_lag_lead(rows, group):
    kw = dict(lag={"p": "v"}, lead={"n": "id"})
    want = ordered.lag_lead(rows, group, ["k", "id"], **kw, hot_rows=None)
    got = ordered.lag_lead(rows, group, ["k", "id"], **kw, hot_rows=200, piece_rows=50)
    assert collect(got) == collect(want)


@pytest.mark.parametrize("group", [["g"], []])
def test_ranked_share(rows, group):
    kw = dict(measured=F.col("v").isNotNull(), counted=F.col("k") > 0)
    order = [F.col("v").asc(), F.col("id").asc()]
    want = ordered.ranked_share(rows, group, order, **kw, hot_rows=None)
    got = ordered.ranked_share(rows, group, order, **kw, hot_rows=150, piece_rows=40)
    assert collect(got) == collect(want)


def test_share_is_monotone_and_complete(rows):
    got = ordered.ranked_share(rows, ["g"], by_key(), measured=F.col("v").isNotNull(), hot_rows=150, piece_rows=40)
    spec = Window.partitionBy("g").orderBy("rank")
    back = got.filter("rank is not null").withColumn("p", F.lag("share").over(spec))
    assert back.filter("p > share").count() == 0
    assert got.count() == rows.count()


def test_many_hot_groups_use_a_table(spark):
    df = spark.range(3000).select((F.col("id") % 100).alias("g"), F.col("id").cast("int").alias("id"))
    want = ordered.row_number(df, ["g"], [F.col("id").asc()], hot_rows=None)
    got = ordered.row_number(df, ["g"], [F.col("id").asc()], hot_rows=20, piece_rows=100)
    assert collect(got) == collect(want)


def test_top_row(rows):
    want = rows.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(F.col("k").desc(), F.col("id").desc())))
    want = want.filter("rn = 1").drop("rn")
    assert collect(ordered.top_row(rows, ["g"], ["k", "id"])) == collect(want)


@pytest.mark.parametrize("group", [["g"], []])
@pytest.mark.parametrize("hot_rows", [None, 20])
@pytest.mark.parametrize("idle", [None, 2])
def test_quota_flags_equal_ranked_shares(rows, group, hot_rows, idle):
    quotas = {"none": 0.0, "first": 0.001, "half": 0.5, "most": 0.9, "all": 1.0, "over": 1.5}
    data = rows.withColumn("k", F.when(F.col("v") < -15, None).otherwise(F.col("k")))
    order = [F.col("k").asc(), F.col("v").asc_nulls_first(), F.col("id").asc()]
    ranked = ordered.ranked_share(data, group, order, measured=F.col("k").isNotNull(), counted=F.col("v") != 0, hot_rows=None)
    relevant = F.lit(True) if idle is None else F.coalesce(F.col("k") > idle, F.lit(True))
    want = ranked.where(relevant).select(*data.columns, *[F.coalesce(F.col("share") < q, F.lit(False)).alias(n) for n, q in quotas.items()])
    got = ordered.quota_flags(data, group, "k", ["v", "id"], quotas, counted=F.col("v") != 0, idle=idle, hot_rows=hot_rows)
    assert got.columns == [*data.columns, *quotas] and got.count() == data.count()
    assert collect(got.where(relevant)) == collect(want)


def test_quota_flags_of_nothing(rows):
    assert ordered.quota_flags(rows.limit(0), ["g"], "k", ["id"], {"q": 0.5}).collect() == []
    assert ordered.quota_flags(rows.limit(0), [], "k", ["id"], {"q": 0.5}).collect() == []
    assert not any(r["q"] for r in ordered.quota_flags(rows.withColumn("k", F.lit(None).cast("int")), ["g"], "k", ["id"], {"q": 0.5}).collect())


def test_quota_flags_sort_ties_only(rows):
    """Where the quota cuts no value there is no sort; else its input is what the cut value joins."""
    uncut = ordered.quota_flags(rows, ["g"], "k", ["id"], {"q": 0.5}, idle=9)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in uncut and "Sort [" not in uncut
    cut = ordered.quota_flags(rows, ["g"], "k", ["id"], {"q": 0.5})._jdf.queryExecution().executedPlan().toString()
    below = cut[cut.index("Window [") :]
    assert "__edge0" in below and cut.count("Window [") == 1
