"""Physical-plan assertions: pushdown, pruning, broadcast of bounded
dimensions, partial aggregation, top-k per group."""

from cuenca.plans.registry import load_all

from conftest import SF_SMALL

REG = load_all()


def _plan(spark, key):
    df = REG[key].build(spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString() + \
        df._jdf.queryExecution().optimizedPlan().toString()


def test_filter_pushed_to_parquet(spark):
    p = _plan(spark, "flt03_half_open_date_range")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_column_pruning(spark):
    p = _plan(spark, "prj01_column_pruning")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in p


def test_nation_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(spark, "joi01_inner_orders_customers")


def test_partial_aggregation_before_shuffle(spark):
    p = _plan(spark, "agg42_reduce_by_key")
    assert "partial_sum" in p


def test_window_group_limit_for_top_k(spark):
    assert "WindowGroupLimit" in _plan(spark, "win02_row_number_first_per_key")


def test_partition_pruning(spark):
    assert "PartitionFilters: [isnotnull(year" in _plan(spark, "snk19_range_partitioned_pruning")


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from pyspark.sql import functions as F

    from cuenca.sinks.writers import write_bucketed
    from cuenca.sources.tables import Tables
    t = Tables(spark, SF_SMALL)
    write_bucketed(t.lineitem, "li_bucketed", ["l_orderkey"], 8, str(tmp_path / "li"))
    write_bucketed(t.orders, "o_bucketed", ["o_orderkey"], 8, str(tmp_path / "o"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("li_bucketed").join(spark.table("o_bucketed"),
                                            F.col("l_orderkey") == F.col("o_orderkey"))
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == t.lineitem.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_level_windows_partition_by_key_and_bucket(spark):
    """Raw rows are windowed per (key, bucket); the one window per key alone
    sees a row per bucket."""
    import re

    from pyspark.sql import functions as F

    from cuenca.operators import analytics as A
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"),
                                  F.col("id").cast("timestamp").alias("ts"))
    for out in (A.rank_within(df, "k", "v", "r"),
                A.running_sum(df, "k", ["ts", "v"], "v", F.to_date("ts")),
                A.previous_within(df, "k", ["ts", "v"], "ts", F.to_date("ts"), "prev")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        specs = re.findall(r"Window \[[^\n]*?\], \[([^\]]*)\], \[", plan)
        assert specs, plan
        alone = [s for s in specs if len(s.split(",")) == 1]
        assert len(specs) > len(alone) <= 1
        below = re.search(r"Window \[[^\n]*?\], \[[^\],]*\], \[[^\n]*\n(.*)", plan, re.S)
        assert not alone or "HashAggregate" in below[1].split("Scan")[0].split("Range")[0]


def test_groups_by_order_get_more_partitions_as_the_lines_grow(spark, monkeypatch):
    from cuenca.plans import model as m
    from cuenca.sources.tables import Tables
    t = Tables(spark, SF_SMALL)
    lines = m.items(t)
    few = m.by_order(t, lines).rdd.getNumPartitions()
    monkeypatch.setattr(m, "ORDER_BYTES", m.table_bytes(spark, SF_SMALL, "lineitem") // 16)
    many = m.by_order(t, lines)
    assert few == int(spark.conf.get("spark.sql.shuffle.partitions")) and many.rdd.getNumPartitions() in (16, 17)
    assert many.exceptAll(lines).isEmpty() and many.count() == lines.count()
