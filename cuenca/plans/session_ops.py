"""Session-level Spark features the course teaches."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import functions as F

from cuenca.plans.registry import query
from cuenca.plans.sources import fresh
from cuenca.session import materialize
from cuenca.sources.tables import Tables


@query("ses01_repartition_vs_coalesce", sql="""
    SELECT 'repartition_by_key' AS layout, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys
    FROM lineitem
    UNION ALL SELECT 'coalesced', count(*), count(DISTINCT l_orderkey) FROM lineitem""")
def _(spark, sf):
    """``repartition(n, key)`` (full shuffle; every key in one partition) vs
    ``coalesce(n)`` (merges partitions, no shuffle). The check: no row lost
    or duplicated, and after the key repartition no key spans partitions."""
    li = Tables(spark, sf).lineitem.select("l_orderkey")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_key = li.repartition(n, "l_orderkey").withColumn("pid", F.spark_partition_id())
    spans = by_key.groupBy("l_orderkey").agg(F.countDistinct("pid").alias("parts"))
    if spans.where(F.col("parts") > 1).limit(1).count():
        raise AssertionError("a key spans several partitions after repartition by key")
    co = li.coalesce(max(1, n // 2)).withColumn("pid", F.spark_partition_id())
    a = by_key.agg(F.lit("repartition_by_key").alias("layout"), F.count(F.lit(1)).alias("n_rows"),
                   F.countDistinct("l_orderkey").alias("n_keys"))
    b = co.agg(F.lit("coalesced").alias("layout"), F.count(F.lit(1)).alias("n_rows"),
               F.countDistinct("l_orderkey").alias("n_keys"))
    return a.unionByName(b)


@query("ses02_cache_and_storage_levels", ctes=("e_items",), sql="""
    SELECT 'first' AS pass, count(*) AS n_rows, CAST(sum(price) AS DECIMAL(38,2)) AS total FROM e_items
    UNION ALL SELECT 'second', count(*), CAST(sum(price) AS DECIMAL(38,2)) FROM e_items""")
def _(spark, sf):
    """A DataFrame reused by two actions is persisted (MEMORY_AND_DISK: spills
    instead of recomputing) and released afterwards; both results are written
    by the executors while it is held."""
    from cuenca.plans import model as m
    i = m.items(Tables(spark, sf)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        passes = [materialize(i.agg(F.lit(name).alias("pass"), F.count(F.lit(1)).alias("n_rows"), m.msum("price").alias("total")))
                  for name in ("first", "second")]
    finally:
        i.unpersist()
    return passes[0].unionByName(passes[1])


@query("ses04_table_statistics", sql="""
    SELECT count(*) AS row_count FROM orders""")
def _(spark, sf):
    """``ANALYZE TABLE … COMPUTE STATISTICS`` on a catalog table; the row
    count the optimizer will use is read back from the catalog."""
    name = f"orders_stats_{uuid.uuid4().hex[:8]}"
    Tables(spark, sf).orders.write.mode("overwrite").option("path", fresh(spark, "ses04")) \
        .saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Statistics")
    return stats.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"))
