"""Window operators under skew: results equal a brute-force computation."""

from pyspark.sql import Window, functions as F

from cuenca.operators import analytics as A


def _skewed(spark, n=6000):
    # key 0 holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
        (F.lit("2024-01-01").cast("timestamp") + F.expr("make_interval(0,0,0,0,0,0, id * 37)"))
        .cast("timestamp_ntz").alias("ts"),
        F.col("id").alias("eid"),
        (F.col("id") % 13).cast("decimal(12,2)").alias("v"))


def test_running_sum_matches_plain_window(spark):
    df = _skewed(spark)
    got = A.running_sum(df, "k", ["ts", "eid"], "v", F.to_date("ts"), out="cum", prev_out="prev")
    w = Window.partitionBy("k").orderBy("ts", "eid")
    exp = df.withColumn("cum", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("prev", F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                       F.lit(0).cast("decimal(22,2)")))
    a = got.select("eid", "cum", "prev").exceptAll(exp.select("eid", "cum", "prev"))
    assert a.count() == 0
    assert got.count() == df.count()


def test_global_sequence_is_dense_and_ordered(spark):
    df = _skewed(spark)
    s = A.global_sequence(df, ["ts", "eid"], "seq", num_partitions=7)
    rows = s.select("seq", "ts", "eid").orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(1, df.count() + 1))
    keys = [(r.ts, r.eid) for r in rows]
    assert keys == sorted(keys)


def test_top_n_keeps_ties_with_rank(spark):
    df = spark.createDataFrame([("a", 10), ("a", 10), ("a", 5), ("b", 1)], "g string, v int")
    out = A.top_n_per_group(df, "g", [F.desc("v")], 1, F.rank, "r")
    assert sorted((r.g, r.v) for r in out.collect()) == [("a", 10), ("a", 10), ("b", 1)]


def test_pct_change_handles_zero_base(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "m int, v double")
    out = {r.m: r.pct_change for r in A.pct_change(df, "m", "v").collect()}
    assert out[1] is None and out[2] is None and out[3] == 100.0


def test_rank_within_matches_window_with_ties(spark):
    df = _skewed(spark).withColumn("val", (F.col("eid") % 50).cast("decimal(12,2)"))
    got = A.rank_within(df, "k", "val", "r", "dr", n_buckets=8)
    w = Window.partitionBy("k").orderBy(F.desc("val"))
    exp = df.withColumn("r", F.rank().over(w)).withColumn("dr", F.dense_rank().over(w))
    assert got.select("eid", "r", "dr").exceptAll(exp.select("eid", "r", "dr")).count() == 0
    assert got.count() == df.count()


def test_previous_within_matches_lag(spark):
    df = _skewed(spark).withColumn("d", F.to_date("ts"))
    got = A.previous_within(df, "k", ["d", "eid"], "d", F.trunc("d", "month"), "prev")
    exp = df.withColumn("prev", F.lag("d").over(Window.partitionBy("k").orderBy("d", "eid")))
    assert got.select("eid", "prev").exceptAll(exp.select("eid", "prev")).count() == 0


def test_percentiles_from_counts_equal_exact_percentile(spark):
    df = _skewed(spark).withColumn("x", (F.col("eid") * 7 % 101).cast("int"))
    got = {r.k: (r.p50, r.p90) for r in
           A.percentiles_from_counts(df, "k", "x", {"p50": 0.5, "p90": 0.9}).collect()}
    exp = {r.k: (r.p50, r.p90) for r in df.groupBy("k").agg(
        F.percentile("x", 0.5).alias("p50"), F.percentile("x", 0.9).alias("p90")).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert abs(got[k][0] - exp[k][0]) < 1e-9 and abs(got[k][1] - exp[k][1]) < 1e-9


def test_bucket_documents_bounded_and_complete(spark):
    from cuenca.operators.documents import bucket_documents
    df = _skewed(spark)
    docs = bucket_documents(df, ["k"], ["ts", "eid"], ["v"], "items", 100, F.date_trunc("hour", "ts"))
    sizes = [r[0] for r in docs.select(F.size("items")).collect()]
    assert max(sizes) <= 100 and sum(sizes) == df.count()
    hot = [e for r in docs.where("k = 0").orderBy("chunk").collect() for e in [x.eid for x in r["items"]]]
    assert hot == sorted(hot) and len(hot) == df.where("k = 0").count()


def _with_nulls(spark):
    """NULL keys, NULL days and NULL values, each among ordinary rows."""
    rows = [(None if i % 5 == 0 else i % 3, None if i % 7 == 0 else f"2024-01-{i % 9 + 1:02d}", i, None if i % 11 == 0 else i % 13)
            for i in range(200)]
    return (spark.createDataFrame(rows, "k int, d string, eid int, v int")
            .withColumn("ts", F.col("d").cast("date")).withColumn("v", F.col("v").cast("decimal(12,2)")))


def test_two_level_windows_keep_null_keys_and_buckets(spark):
    df = _with_nulls(spark)
    w = Window.partitionBy("k").orderBy("ts", "eid")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    got = A.running_sum(df.withColumn("v", F.coalesce("v", F.lit(0).cast("decimal(12,2)"))), "k", ["ts", "eid"], "v", F.col("ts"), out="cum")
    want = df.withColumn("cum", F.sum(F.coalesce("v", F.lit(0).cast("decimal(12,2)"))).over(run))
    assert sorted((r.eid, r.cum) for r in got.collect()) == sorted((r.eid, r.cum) for r in want.collect())
    got = A.previous_within(df, "k", ["ts", "eid"], "ts", F.col("ts"), "prev")
    want = df.withColumn("prev", F.lag("ts").over(w))
    assert sorted((r.eid, str(r.prev)) for r in got.collect()) == sorted((r.eid, str(r.prev)) for r in want.collect())
    got = A.rank_within(df, "k", "v", "rnk", "dense", n_buckets=4)
    by = Window.partitionBy("k").orderBy(F.col("v").desc())
    want = df.withColumn("rnk", F.rank().over(by)).withColumn("dense", F.dense_rank().over(by))
    assert sorted((r.eid, r.rnk, r.dense) for r in got.collect()) == sorted((r.eid, r.rnk, r.dense) for r in want.collect())


def test_bucket_documents_keep_null_rows(spark):
    from cuenca.operators.documents import bucket_documents
    df = _with_nulls(spark)
    docs = bucket_documents(df, ["k"], ["ts", "eid"], ["v"], "items", 7, F.col("ts")).collect()
    assert sum(len(r["items"]) for r in docs) == 200 and max(len(r["items"]) for r in docs) <= 7


def test_exact_percentile_narrows_to_the_value(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(0, 1, 3000), np.repeat(5.0, 900), rng.integers(-3, 3, 600)])
    df = spark.createDataFrame([(float(x),) for x in v] + [(None,)] * 5, "v double")
    for p in (0.0, 0.01, 0.5, 0.77, 0.8, 0.99, 1.0):
        assert abs(A.exact_percentile(df, "v", p, few=50) - np.quantile(v, p)) < 1e-9, p
    assert A.exact_percentile(df.where("v is null"), "v", 0.5) is None


def test_no_single_partition_over_raw_values(spark):
    from cuenca.operators.warehouse import treat_outliers
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 100.0)], "id int, v double")
    capped = treat_outliers(df, "v", 0.5, "cap")
    assert {r.id: r.v_capped for r in capped.collect()} == {1: 5.0, 2: None, 3: 52.5}
    assert {r.id for r in treat_outliers(df, "v", 0.5, "drop").collect()} == {1, 2}
    assert {r.id: r.is_outlier for r in treat_outliers(df, "v", 0.5).collect()} == {1: False, 2: None, 3: True}
    assert "SinglePartition" not in capped._jdf.queryExecution().toString()


def test_money_average_rounds_half_away_from_zero(spark):
    from decimal import ROUND_HALF_UP, Decimal
    import duckdb
    from cuenca.plans.model import avg_money, avg_money_sql
    groups = {1: ["-0.01", "-0.02", "-0.02", "-0.02"], 2: ["0.01", "0.02"], 3: ["-0.01", "-0.02"], 4: ["9999999999.99"] * 3, 5: ["0.00"],
              6: ["1.00", "1.00", "1.01"], 7: [None, "0.05"]}
    rows = [(g, None if x is None else Decimal(x)) for g, xs in groups.items() for x in xs]
    got = {r.g: r.a for r in spark.createDataFrame(rows, "g int, m decimal(12,2)").groupBy("g").agg(avg_money("m").alias("a")).collect()}
    for g, xs in groups.items():
        ds = [Decimal(x) for x in xs if x is not None]
        assert got[g] == float((sum(ds) / len(ds)).quantize(Decimal("0.01"), ROUND_HALF_UP)), g
    con = duckdb.connect()
    con.execute("CREATE TABLE t (g INT, m DECIMAL(12,2))")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    assert dict(con.sql(f"SELECT g, {avg_money_sql('m')} FROM t GROUP BY g").fetchall()) == got


def test_rank_of_a_value_that_holds_a_third_of_the_rows(spark):
    df = spark.range(9000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") * 7 % 1000).alias("v"),
                                  F.col("id").alias("eid"))
    got = A.rank_within(df, "k", "v", "r", "dr", n_buckets=5)
    by = Window.partitionBy("k").orderBy(F.desc("v"))
    want = df.withColumn("r", F.rank().over(by)).withColumn("dr", F.dense_rank().over(by))
    cols = ["k", "v", "eid", "r", "dr"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0 and got.count() == 9000
    # the hot value's rows meet a broadcast table, before any shuffle
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_percentile_reads_its_input_twice(spark):
    import numpy as np
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 100, 20_000), np.repeat(3.25, 11_000), [np.inf, -np.inf]])
    df = spark.createDataFrame([(float(x),) for x in v], "v double").mapInArrow(seen, "v double")
    for p in (0.003, 0.5, 0.63, 0.995):
        for few in (10_000, 5):                     # 5: settled by prefix sums, not by collecting
            reads.value = 0
            assert abs(A.exact_percentile(df, "v", p, few=few) - np.quantile(v, p)) < 1e-9
            assert reads.value == 2 * len(v)


def test_percentile_when_the_sketch_misses(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    real, asked = A._at_ranks, []

    def missed(d, lo, hi, ranks, few):
        asked.append((lo, hi))
        return real(d, 900.0, hi, ranks, few) if lo is not None else real(d, lo, hi, ranks, few)
    monkeypatch.setattr(A, "_at_ranks", missed)
    assert A.exact_percentile(df, "v", 0.5) == 499.5 and asked[-1] == (None, None)
