import random

from pyspark.sql import functions as F

from millrace.operators import events

EVENT = "struct<paperprogrstatus:struct<statuscode:string,statusdatetime:string,clientrequesttimestamp:string,deliveryfailurecause:string,attachments:array<struct<documenttype:string>>>>"


def log(seed=3):
    rnd = random.Random(seed)
    rows = []
    for item in range(40):
        for _ in range(rnd.randint(1, 4)):
            stored = []
            for _ in range(rnd.randint(0, 6)):
                at = f"2024-0{rnd.randint(1, 9)}-1{rnd.randint(0, 9)}T1{rnd.randint(0, 9)}:30" + rnd.choice(["Z", ":05Z", ":05.123Z"])
                docs = rnd.choice([None, [], [("23L",)], [("AR",), ("Plico",)], [("Plico",)]])
                stored.append(((rnd.choice(["CON080", "RECRN001C", "PN998", None]), at, at, rnd.choice([None, "M01", "M05"]), docs),))
            rows.append((f"x~{item}", rnd.choice([stored, stored, None])))
    return rows


def test_collapse_inside_the_array_equals_the_exploded_log(spark):
    df = spark.createDataFrame(log(), f"requestid string, list array<{EVENT}>")
    got = events.collapse_nested(df, "requestid", "list", ["CON080", "PN998"], keep={"cause": "deliveryfailurecause"}, attachments=["23L", "AR"], prefix="x~")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    exploded = events.explode_events(df, "requestid", "list", "x~")
    last = events.last_attachment(exploded, "requestid", ["23L", "AR"])
    at = F.struct("statusdatetime", "deliveryfailurecause")
    want = exploded.groupBy("requestid").agg(
        F.count(F.lit(1)).alias("events"), *[F.count_if(F.col("statuscode") == k).alias(f"{k.lower()}_events") for k in ("CON080", "PN998")],
        *[F.max(F.when(F.col("statuscode") == k, at)).alias(k) for k in ("CON080", "PN998")],
    ).join(last, "requestid", "left")
    expected = {r["requestid"]: (r["events"], r["con080_events"], r["pn998_events"], *[x for k in ("CON080", "PN998") for x in (r[k] or (None, None))], r["documenttype"]) for r in want.collect()}
    found = {r["requestid"]: tuple(r)[1:] for r in got.collect()}
    assert len(found) == 40
    for key, values in found.items():
        assert values == expected.get(key, (0, 0, 0, None, None, None, None, None))
