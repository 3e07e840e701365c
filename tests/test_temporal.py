"""As-of join against a nested loop, also with a key that holds a third of the rows."""

import datetime
import random

from pyspark.sql import functions as F

from cuenca.operators.temporal import asof_join


def brute(rows, states, how):
    out = []
    for r in rows:
        before = [s for s in states if r[0] is not None and r[1] is not None and s[0] == r[0] and s[1] is not None and s[1] <= r[1]]
        best = max(before, key=lambda s: (s[1], s[2] is not None, s[2] or "")) if before else None
        if best:
            out.append((*r, best[2]))
        elif how == "left":
            out.append((*r, None))
    return sorted(out, key=repr)


def data(seed=3, n=900):
    rng = random.Random(seed)
    at = lambda: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=rng.randrange(0, 60 * 24 * 20, 7))
    key = lambda: "hot" if rng.random() < .35 else rng.choice(["a", "b", "c", "late", None])
    rows = [(key(), at() if rng.random() > .03 else None, k) for k in range(n)]
    states = [(key(), at(), rng.choice(["x", "y", "z", None])) for _ in range(120)]
    states = [s for s in states if s[0] != "late"] + [("late", datetime.datetime(2024, 3, 1), "never"), ("hot", None, "no time")]
    states += [("a", rows[5][1], "tie1"), ("a", rows[5][1], "tie2"), ("hot", datetime.datetime(2024, 1, 1), None)]
    return rows, states


def test_equals_nested_loop(spark):
    rows, states = data()
    r = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id int")
    s = spark.createDataFrame(states, "k string, since timestamp_ntz, who string")
    for how in ("inner", "left"):
        for unit in ("day", "hour"):
            got = asof_join(r, s, "k", "ts", "since", ["who"], unit=unit, how=how)
            assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, states, how)


def test_hot_key_is_spread_and_no_row_meets_two_states(spark):
    n = 20_000
    r = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                              F.timestamp_micros(F.col("id") * 60_000_000).alias("ts"))
    s = spark.range(0, n, 50).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 60_000_000).alias("since"),
                                     F.col("id").alias("who"))
    out = asof_join(r, s, "k", "ts", "since", ["who"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k" in plan and "_b" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    hot = out.where("k = 'hot'")
    assert hot.count() == len(range(0, n, 3))
    # 14 days of rows in as many pieces, none above a day
    assert hot.groupBy(F.date_trunc("day", "ts")).count().agg(F.max("count")).first()[0] <= 24 * 60 / 3
    assert out.where(F.col("who") > F.unix_micros("ts") / 60_000_000).count() == 0


def test_empty_sides(spark):
    r = spark.createDataFrame([("a", datetime.datetime(2024, 1, 1), 1)], "k string, ts timestamp_ntz, id int")
    s = spark.createDataFrame([], "k string, since timestamp_ntz, who string")
    assert asof_join(r, s, "k", "ts", "since", ["who"]).count() == 0
    assert asof_join(r, s, "k", "ts", "since", ["who"], how="left").first()["who"] is None
    assert asof_join(r.limit(0), s, "k", "ts", "since", ["who"]).count() == 0
