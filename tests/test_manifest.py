"""Manifest tables: emptied partitions go, failed runs change nothing, merges
leave untouched files alone, every version has one order."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cuenca.operators import ingest, warehouse as WH
from cuenca.sinks import keyed, manifest as M
from cuenca.sinks.writers import latest_wins, publish_together, read_published, upsert


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(root, "data")) for f in fs if f.endswith(".parquet")}


def day_counts(df):
    return df.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def test_refresh_drops_an_emptied_day(spark, tmp_path):
    root = str(tmp_path / "t")
    days = lambda *d: spark.createDataFrame([(x,) for x in d], "day string")
    WH.refresh_partitions(days("d1", "d2", "d2", "d3"), day_counts, root, "day", days("d1", "d2", "d3"))
    before = files(root)
    WH.refresh_partitions(days("d1", "d1", "d3"), day_counts, root, "day", days("d1", "d2"))
    assert rows(M.read_table(spark, root)) == [("d1", 2), ("d3", 1)]
    # d3 was not in the scope: its file is the one of the first run
    live = {e["values"][0]: e["dir"] for e in M.current(spark, root)["live"]}
    assert set(live) == {"d1", "d3"} and any(live["d3"] in f for f in before) and not any(live["d1"] in f for f in before)
    # the version before stays readable until vacuum
    assert M.vacuum(spark, root, keep=1) == 2
    assert rows(M.read_table(spark, root)) == [("d1", 2), ("d3", 1)]


def test_a_failed_run_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    M.replace_partitions(df, root, ["p"])
    boom = F.udf(lambda v: 1 // (v - 2), "int")
    with pytest.raises(Exception):
        M.replace_partitions(df.repartition(2).withColumn("v", boom("v")), root, ["p"])
    assert rows(M.read_table(spark, root)) == [("a", 1), ("b", 2)]


def test_two_writers_do_not_lose_an_update(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1)], "p string, v int")
    M.replace_partitions(df, root, ["p"])
    base = M.current(spark, root)
    M.replace_partitions(df.withColumn("v", F.lit(2)), root, ["p"])
    with pytest.raises(M.ConcurrentCommit):
        M.replace_partitions(df.withColumn("v", F.lit(3)), root, ["p"], base=base)
    assert rows(M.read_table(spark, root)) == [("a", 2)]


def test_odd_partition_values_and_types(spark, tmp_path):
    root = str(tmp_path / "t")
    data = [("a b/c=%", 1, "x"), (None, 2, "y"), ("ü", None, "z"), ("1", 4, "w")]
    df = spark.createDataFrame(data, "p string, q int, v string")
    M.replace_partitions(df, root, ["p", "q"])
    back = M.read_table(spark, root)
    assert back.columns == df.columns and back.schema["q"].dataType == df.schema["q"].dataType
    assert rows(back) == rows(df)
    M.replace_partitions(df.where("v = 'x'").withColumn("v", F.lit("new")), root, ["p", "q"], replaces=df.where("v <> 'w'"))
    assert rows(M.read_table(spark, root)) == rows(spark.createDataFrame([("a b/c=%", 1, "new"), ("1", 4, "w")], df.schema))
    M.replace_partitions(df.limit(0), root, ["p", "q"], replaces=df)
    assert rows(M.read_table(spark, root)) == []
    with pytest.raises(FileNotFoundError):
        M.read_table(spark, str(tmp_path / "none"))


def test_silver_rerun_without_rows_empties_its_partition(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "silver")
    cols = "customer_id string, customer_name string, city string, country string, created_at string"
    df = spark.createDataFrame([("C1", "n", "c", "co", "2025-01-01")], cols)
    df.write.option("header", True).csv(raw)
    ingest.raw_to_silver(spark, "customers", raw, out, "erp", "2026-01-13")
    ingest.raw_to_silver(spark, "customers", raw, out, "erp", "2026-01-14")
    df.limit(0).write.mode("overwrite").option("header", True).csv(raw)
    ingest.raw_to_silver(spark, "customers", raw, out, "erp", "2026-01-14")
    assert [str(r["dt"]) for r in M.read_table(spark, out).collect()] == ["2026-01-13"]


def test_publish_replaces_the_pointer_in_one_step(spark, tmp_path):
    root = str(tmp_path / "p")
    for v in (1, 2):
        publish_together(spark, {"a": spark.range(v), "b": spark.range(v)}, root)
        assert read_published(spark, root, "a").count() == v == read_published(spark, root, "b").count()
    assert [f for f in os.listdir(root) if "CURRENT" in f and not f.endswith(".crc")] == ["CURRENT"]


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    root = str(tmp_path / "k")
    table = spark.range(500).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("ver"))
    keyed.create(table, root, ["k"], "ver", buckets=16)
    before = files(root)
    delivery = spark.createDataFrame([(7, "new", 2), (8, "too old", 0), (1000, "insert", 1)], "k int, v string, ver int")
    keyed.upsert(root, delivery, ["k"], "ver", buckets=16)
    live = [e["dir"] for e in M.current(spark, root)["live"]]
    kept = {f for f in before if any(d in f for d in live)}
    assert len(live) == 16 and 13 <= len({f.split("bucket=")[1].split("/")[0] for f in kept}) <= 15
    got = {r["k"]: r["v"] for r in keyed.read(spark, root).collect()}
    assert len(got) == 501 and got[7] == "new" and got[8] == "old" and got[1000] == "insert" and got[9] == "old"


VERSIONS = [(1, "a", None), (1, "b", None), (2, "a", None), (2, "z", 3), (2, "y", 3), (3, None, 1), (3, "x", None),
            (None, "n1", 1), (None, "n1", 1), (None, "n2", None), (4, "only", None)]


def plain_latest(data):
    out = [r for r in data if r[0] is None]
    for k in {r[0] for r in data if r[0] is not None}:
        out.append(max((r for r in data if r[0] == k),
                       key=lambda r: (r[2] is not None, r[2] or 0, '{"v":"%s"}' % r[1] if r[1] is not None else "{}")))
    return sorted(out, key=repr)


def test_versions_have_one_order(spark, tmp_path):
    want = plain_latest(VERSIONS)
    for seed in range(3):
        data = random.Random(seed).sample(VERSIONS, len(VERSIONS))
        df = spark.createDataFrame(data, "k int, v string, ver int").repartition(3)
        assert rows(latest_wins(df, ["k"], "ver")) == want
        root = str(tmp_path / f"v{seed}")
        keyed.create(df, root, ["k"], "ver", buckets=4)
        assert rows(keyed.read(spark, root)) == want
    # a key whose versions are all NULL keeps its columns
    one = spark.createDataFrame([(1, "a", None)], "k int, v string, ver int")
    assert rows(latest_wins(one, ["k"], "ver")) == [(1, "a", None)]


def test_upsert_reduces_repeated_keys_and_keeps_rows_without_key(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "t")], "k int, v string")
    s = spark.createDataFrame([(2, "c"), (2, "d"), (2, "d"), (3, "e"), (None, "s"), (None, "s")], "k int, v string")
    assert rows(upsert(t, s, ["k"])) == sorted([(1, "a"), (None, "t"), (2, "d"), (3, "e"), (None, "s"), (None, "s")], key=repr)


def test_changes_with_null_keys_and_numbers(spark, tmp_path):
    t = spark.createDataFrame([(None, "a"), (None, "b"), (1, "x"), (2, "y"), (5, "z")], "k int, v string")
    ch = spark.createDataFrame([(1, "u1", "U", 1), (1, "u2", "U", 1), (2, None, "D", None), (3, "i", "I", None),
                                (3, "u", "U", 0), (None, "lost", "U", 9), (None, None, "D", 9)],
                               "k int, v string, op string, seq int")
    want = sorted([(None, "a"), (None, "b"), (1, "u2"), (3, "u"), (5, "z")], key=repr)
    assert rows(WH.cdc_apply(t, ch, "k")) == want
    root = str(tmp_path / "c")
    keyed.create(t, root, ["k"], buckets=4)
    keyed.apply_changes(root, ch, ["k"], buckets=4)
    assert rows(keyed.read(spark, root)) == want
    keyed.apply_changes(root, ch, ["k"], buckets=4)      # again: nothing new
    assert rows(keyed.read(spark, root)) == want


def test_scd2_null_and_repeated_keys(spark):
    dim = WH.scd2_initial(spark.createDataFrame([(None, "keepme"), (1, "A")], "id int, city string"), "2024-01-01")
    snap = spark.createDataFrame([(1, "B"), (1, "C"), (1, None), (2, "D"), (2, "D")], "id int, city string")
    got = rows(WH.scd2(dim, snap, "id", ["city"], "2024-06-30").select("id", "city", "is_current"))
    assert got == sorted([(None, "keepme", True), (1, "A", False), (1, "C", True), (2, "D", True)], key=repr)
    snap = spark.createDataFrame([(None, "new")], "id int, city string")
    got = rows(WH.scd2(dim, snap, "id", ["city"], "2024-06-30").select("id", "city", "is_current"))
    assert got == sorted([(None, "keepme", False), (None, "new", True), (1, "A", True)], key=repr)


def test_a_hot_key_in_a_delivery(spark, tmp_path):
    root = str(tmp_path / "h")
    keyed.create(spark.range(10).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("ver")), root, ["k"], "ver", buckets=4)
    hot = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id") + 100).alias("k"), F.col("id").alias("ver"))
    keyed.upsert(root, hot, ["k"], "ver", buckets=4)
    got = dict(rows(keyed.read(spark, root)))
    assert got[3] == 5997 and len(got) == 10 + 4000
