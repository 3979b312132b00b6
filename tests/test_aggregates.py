import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import Measure, grouping_sets, level_sets, pivot_with_total

SETS = [["a", "b"], ["b"], ["c"], []]


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(4)
    data = [(rnd.choice(["x", "y", None]), rnd.choice([1, 2, None]), rnd.choice("pq"), rnd.choice([None, -3, 0, 5]), i) for i in range(300)]
    return spark.createDataFrame(data, "a string, b int, c string, v int, i int")


@pytest.fixture(scope="module")
def measures(spark):
    return {"n": Measure("rows"), "some": Measure("count", "v"), "minus": Measure("rows", F.expr("v < 0")), "total": Measure("sum", "v"), "low": Measure("min", "v"), "high": Measure("max", F.expr("v + i"))}


def collect(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("empty", [False, True])
def test_levels_from_the_finest_groups(rows, measures, empty):
    data = rows.limit(0) if empty else rows
    aggs = [m.first().alias(n) for n, m in measures.items()]
    assert collect(level_sets(data, SETS, measures, "level")) == collect(grouping_sets(data, SETS, ["a", "b", "c"], aggs, "level"))


def test_groups_are_expanded_not_rows(rows, measures):
    plan = level_sets(rows, SETS, measures)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    expand = next(i for i, x in enumerate(lines) if "Expand" in x)
    assert any("Exchange" in x for x in lines[expand:]) and plan.count("Expand") == 1


def test_total_row_of_a_pivot(rows):
    got = {r["c"]: (r["one"], r["totale"]) for r in pivot_with_total(rows, "c", "b", {"one": 1}, F.coalesce("v", F.lit(0))).collect()}
    assert got["TOTALE"] == tuple(sum(x) for x in zip(got["p"], got["q"]))
