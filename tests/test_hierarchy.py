"""Trees by pointer jumping: any depth, cycles and orphans reported."""

import random

from pyspark.sql import functions as F

from cuenca.operators.hierarchy import levels, rollup


def test_a_path_of_100000_nodes(spark):
    n = 100_000
    path = spark.range(n).select(F.col("id").alias("n"), F.when(F.col("id") > 0, F.col("id") - 1).alias("p"), F.lit(1).cast("long").alias("v"))
    r = levels(path, "n", "p")
    assert r.where("status <> 'ok' OR root <> 0 OR level <> n").count() == 0 and r.count() == n
    s = rollup(path, "n", "p", ["v"], n - 1)
    assert s.where(F.col("v") != n - F.col("n")).count() == 0 and s.count() == n


def test_cycles_and_orphans_end_and_are_reported(spark):
    # 1 -> 2 -> 3 -> 1, 4 below it, 5 points to itself, 6 misses its parent, 7 below 6, 8 a root, 9 below 8
    rows = [(1, 2), (2, 3), (3, 1), (4, 3), (5, 5), (6, 99), (7, 6), (8, None), (9, 8), (None, 8)]
    r = {x["n"]: (x["root"], x["level"], x["status"]) for x in levels(spark.createDataFrame(rows, "n int, p int"), "n", "p").collect()}
    assert r == {**{k: (None, None, "cycle") for k in (1, 2, 3, 4, 5)}, 6: (None, None, "orphan"), 7: (None, None, "orphan"),
                 8: (8, 0, "ok"), 9: (8, 1, "ok")}
    ring = spark.range(1000).select(F.col("id").alias("n"), ((F.col("id") + 1) % 1000).alias("p"))
    assert levels(ring, "n", "p").where("status = 'cycle'").count() == 1000


def test_random_forest_equals_walking_up(spark):
    rng = random.Random(4)
    parent = {k: (None if k < 4 else rng.choice([rng.randrange(k), k - 1, 0])) for k in range(400)}
    value = {k: rng.choice([None, rng.randrange(10)]) for k in parent}
    nodes = spark.createDataFrame([(k, p, value[k], f"x{k}") for k, p in parent.items()], "n int, p int, v int, name string")

    def up(k):
        while k is not None:
            yield k
            k = parent[k]
    r = levels(nodes, "n", "p").collect()
    assert {x["n"]: (x["root"], x["level"]) for x in r} == {k: ([*up(k)][-1], len([*up(k)]) - 1) for k in parent}
    want = {k: None for k in parent}
    for k, v in value.items():
        for a in up(k) if v is not None else ():
            want[a] = (want[a] or 0) + v
    s = rollup(nodes, "n", "p", ["v"], max(x["level"] for x in r))
    assert s.columns == nodes.columns and {x["n"]: x["v"] for x in s.collect()} == want


def test_empty_tree(spark):
    assert levels(spark.createDataFrame([], "n int, p int"), "n", "p").count() == 0
