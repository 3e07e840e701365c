"""Sinks and table layout. Each query writes with the writer
under test to a fresh folder of the shared scratch location and returns the
re-read data (round trip), so the oracle checks what actually landed."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.plans.sources import fresh, raw_orders_entity
from cuenca.sinks import keyed, manifest as M, writers as W
from cuenca.sources import files as S
from cuenca.sources.tables import Tables


def _tname(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


@query("snk01_parquet_by_day", sql="""
    SELECT event_id, ts, value, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day
    FROM events WHERE ts IS NOT NULL""")
def _(spark, sf):
    path = fresh(spark, "snk01")
    W.write_by_day(Tables(spark, sf).events.select("event_id", "ts", "value"), path, "ts")
    return spark.read.parquet(path)


def land_orders(orders, path: str) -> None:
    """Raw→silver landing partitioned by (source, dt = load date), the live
    partitions named by a manifest. Load 1 writes the orders of every year, one load date a
    year (1998 on 2026-01-14, each year before it a day earlier); load 2 re-runs
    2026-01-14 without P orders and replaces only that partition."""
    o = orders.select("o_orderkey", "o_orderstatus", F.lit("erp").alias("source"),
                      F.date_add(F.lit("2026-01-14").cast("date"), F.year("o_orderdate") - 1998).alias("dt"))
    M.replace_partitions(o, path, ["source", "dt"])
    again = (F.col("source") == "erp") & (F.col("dt") == datetime.date(2026, 1, 14))
    scope = orders.sparkSession.range(1).select(F.lit("erp").alias("source"), F.lit("2026-01-14").cast("date").alias("dt"))
    M.replace_partitions(o.where(again & (F.col("o_orderstatus") != "P")), path, ["source", "dt"], replaces=scope)


@query("snk02_partitioned_rerunnable", sql="""
    SELECT 'erp' AS source, CAST(DATE '2026-01-14' + CAST(year(o_orderdate) - 1998 AS INTEGER) AS DATE) AS dt, count(*) AS n
    FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderstatus <> 'P' GROUP BY 1, 2""")
def _(spark, sf):
    """The landing of ``land_orders``: rows per load date, all of them."""
    path = fresh(spark, "snk02")
    land_orders(Tables(spark, sf).orders, path)
    return M.read_table(spark, path).groupBy("source", "dt").agg(F.count(F.lit(1)).alias("n"))


@query("snk03_parquet_overwrite", ctes=("e_retail",), sql="""
    SELECT producto_id, CAST(sum(CAST(cantidad AS BIGINT)) AS BIGINT) AS total_cantidad
    FROM e_retail GROUP BY 1""")
def _(spark, sf):
    """The deployment job's output: overwrite twice, the last write wins."""
    r = m.retail(Tables(spark, sf))
    out = r.groupBy("producto_id").agg(F.sum(F.col("cantidad").cast("long")).alias("total_cantidad"))
    path = fresh(spark, "snk03")
    out.limit(0).write.mode("overwrite").parquet(path)
    out.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("snk04_single_named_csv", sql="""
    SELECT o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1""")
def _(spark, sf):
    """A small final report as ONE ';' CSV file with a timestamped name."""
    rep = Tables(spark, sf).orders.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("orders"))
    d = fresh(spark, "snk04")
    f = W.write_single_csv(rep, d, "reporte_estados_20260114_000000.csv")
    return S.read_csv(spark, f, schema="status STRING, orders BIGINT", sep=";")


@query("snk05_csv_fixed_column_order", ctes=("e_orders",), sql="""
    SELECT order_id, customer_id, order_total, purchase_date FROM e_orders""")
def _(spark, sf):
    path = fresh(spark, "snk05")
    cols = ["order_id", "customer_id", "order_total", "purchase_date"]
    W.write_csv(m.orders(Tables(spark, sf)), path, columns=cols)
    df = S.read_csv(spark, path, schema="order_id BIGINT, customer_id BIGINT, "
                                       "order_total DECIMAL(12,2), purchase_date DATE")
    S.require_columns(df, cols, "orders_export", exact=True)
    return df


@query("snk06_curated_zone", sql="""
    SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_ts,
           CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders""")
def _(spark, sf):
    """Curated zone: text timestamps → TIMESTAMP, rows with a null id dropped,
    Snappy parquet partitioned by year/month of the date (the partition
    design the workshop settles on)."""
    raw = raw_orders_entity(Tables(spark, sf)).select("order_id", "order_ts")
    cur = (raw.withColumn("order_ts", F.try_to_timestamp("order_ts").cast("timestamp_ntz"))
           .dropna(subset=["order_id"])
           .withColumns({"year": F.year("order_ts"), "month": F.month("order_ts")}))
    path = fresh(spark, "snk06")
    W.write_partitioned(cur, path, ["year", "month"], compression="snappy")
    return spark.read.parquet(path)


@query("snk07_month_partitioned_time_ordered", sql="""
    SELECT event_id, ts, value, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
    FROM events""")
def _(spark, sf):
    path = fresh(spark, "snk07")
    W.write_by_month(Tables(spark, sf).events.select("event_id", "ts", "value"), path, "ts")
    return spark.read.parquet(path)


@query("snk09_replace_table_load", sql="""
    SELECT order_id, customer_id, amount, order_date FROM (
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount,
               CAST(o_orderdate AS DATE) AS order_date FROM orders) WHERE amount > 0""")
def _(spark, sf):
    """Replace-table load of the cleaned sales (``if_exists='replace'``)."""
    from cuenca.operators.ingest import clean_sales
    o = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("order_id"),
                                        F.col("o_custkey").alias("customer_id"),
                                        F.col("o_totalprice").alias("amount"),
                                        F.to_date("o_orderdate").alias("order_date"))
    name = _tname("sales_clean")
    path = fresh(spark, "snk09")
    W.replace_table(o.limit(0), name, path)
    W.replace_table(clean_sales(o, 0, inclusive=False), name, path)
    return spark.table(name)


@query("snk10_key_value_day_items", sql="""
    SELECT 'REGION#' || coalesce(event_type, 'ALL') AS pk, 'DAY#' || strftime(ts, '%Y-%m-%d') AS sk,
           count(*) AS count
    FROM events GROUP BY event_type, CAST(ts AS DATE), strftime(ts, '%Y-%m-%d')""")
def _(spark, sf):
    return W.kv_day_items(Tables(spark, sf).events, "ts", "event_type")


@query("snk11_rows_to_json_documents", sql="""
    SELECT '{"_id":' || CAST(c_custkey AS VARCHAR) || ',"customer_id":' || CAST(c_custkey AS VARCHAR)
           || ',"segment":"' || c_mktsegment || '"}' AS doc
    FROM customer""")
def _(spark, sf):
    """Rows serialised as JSON documents (the batched insert sends these)."""
    c = Tables(spark, sf).customer.select(F.col("c_custkey").alias("customer_id"),
                                          F.col("c_mktsegment").alias("segment"))
    return W.to_json_documents(c, "customer_id")


@query("snk12_upsert_by_key", ctes=("e_orders",), sql="""
    WITH tgt AS (SELECT order_id, status, order_total FROM e_orders WHERE purchase_date < DATE '1999-01-01'),
    src AS (SELECT order_id, 'F' AS status, order_total FROM e_orders WHERE purchase_date >= DATE '1998-01-01')
    SELECT * FROM tgt WHERE order_id NOT IN (SELECT order_id FROM src)
    UNION ALL SELECT * FROM src""")
def _(spark, sf):
    """Merge: the target holds orders up to 1998, the delivery brings orders
    from 1998 on (1998 overlaps, with a new status). Matched keys are
    replaced, new keys inserted; only the buckets they touch are rewritten."""
    o = m.orders(Tables(spark, sf)).select("order_id", "status", "order_total", "purchase_date")
    target = o.where(F.col("purchase_date") < F.lit("1999-01-01").cast("date")).drop("purchase_date")
    source = (o.where(F.col("purchase_date") >= F.lit("1998-01-01").cast("date")).drop("purchase_date")
              .withColumn("status", F.lit("F")))
    path = fresh(spark, "snk12")
    keyed.create(target, path, ["order_id"], buckets=16)
    keyed.upsert(path, source, ["order_id"], buckets=16)
    return keyed.read(spark, path)


@query("snk13_create_table_as_select", ctes=("fact",), sql="""
    SELECT state, category, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM fact GROUP BY 1, 2""")
def _(spark, sf):
    """CTAS into a parquet table at a shared location."""
    f = m.fact_sales(Tables(spark, sf))
    name = _tname("ctas_sales")
    f.createOrReplaceTempView(name + "_src")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{fresh(spark, 'snk13')}' AS "
              f"SELECT state, category, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue "
              f"FROM {name}_src GROUP BY state, category")
    return spark.table(name)


@query("snk14_insert_select_and_values", sql="""
    SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1
    UNION ALL SELECT 'X', 0""")
def _(spark, sf):
    """INSERT INTO … SELECT and INSERT INTO … VALUES into one table."""
    name = _tname("status_counts")
    spark.sql(f"CREATE TABLE {name} (status STRING, n BIGINT) USING parquet "
              f"LOCATION '{fresh(spark, 'snk14')}'")
    Tables(spark, sf).orders.createOrReplaceTempView(name + "_orders")
    spark.sql(f"INSERT INTO {name} SELECT o_orderstatus, count(*) FROM {name}_orders GROUP BY 1")
    spark.sql(f"INSERT INTO {name} VALUES ('X', 0)")
    return spark.table(name)


def refresh_table(spark, name: str, query_df) -> None:
    """Full refresh of an aggregate table: INSERT OVERWRITE from its query."""
    query_df.createOrReplaceTempView(name + "_refresh_src")
    spark.sql(f"INSERT OVERWRITE TABLE {name} SELECT * FROM {name}_refresh_src")


def _daily_revenue(t):
    p = m.payments(t).join(m.orders(t).select("order_id", "purchase_date"), "order_id")
    return p.groupBy(F.col("purchase_date").alias("order_date")).agg(
        m.msum("payment_value").alias("revenue"), F.countDistinct("order_id").alias("orders"))


_DAILY_SQL = """
    SELECT o.purchase_date AS order_date, CAST(sum(p.payment_value) AS DECIMAL(38,2)) AS revenue,
           count(DISTINCT p.order_id) AS orders
    FROM e_payments p JOIN e_orders o ON o.order_id = p.order_id GROUP BY 1"""


@query("snk15_full_refresh_aggregate", ctes=("fact",), sql="""
    SELECT purchase_date AS order_date, CAST(sum(price + freight) AS DECIMAL(38,2)) AS revenue
    FROM fact GROUP BY 1""")
def _(spark, sf):
    """``refresh_daily_revenue``: daily revenue (price + freight by purchase
    date) replaces the content of ``agg_daily_revenue`` (INSERT OVERWRITE).
    The table is created empty, then refreshed."""
    t = Tables(spark, sf)
    name = _tname("agg_daily_revenue")
    spark.sql(f"CREATE TABLE {name} (order_date DATE, revenue DECIMAL(38,2)) "
              f"USING parquet LOCATION '{fresh(spark, 'snk15')}'")
    daily = m.fact_sales(t).groupBy(F.col("purchase_date").alias("order_date")).agg(
        m.msum(F.col("price") + F.col("freight")).alias("revenue"))
    refresh_table(spark, name, daily)
    return spark.table(name)


def refresh_materialized(spark, name: str, query_df, unique_key: list[str], path: str) -> None:
    """Materialised view: the query runs once, into a folder of its own; its
    unique key (the index of the original) is checked there, then the table
    is moved to that folder in one step, so readers see the old or the new rows."""
    version = f"{path}/version={uuid.uuid4().hex}"
    query_df.write.parquet(version)
    dups = spark.read.parquet(version).groupBy(*unique_key).count().where(F.col("count") > 1).limit(1).count()
    if dups:
        raise ValueError(f"materialised view {name}: key {unique_key} is not unique")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=version, source="parquet")


@query("snk16_materialized_view_refresh", ctes=("e_payments", "e_orders"), sql=_DAILY_SQL)
def _(spark, sf):
    t = Tables(spark, sf)
    name = _tname("mv_daily_revenue")
    path = fresh(spark, "snk16")
    refresh_materialized(spark, name, _daily_revenue(t).limit(0), ["order_date"], path)
    refresh_materialized(spark, name, _daily_revenue(t), ["order_date"], path)
    return spark.table(name)


@query("snk17_view", ctes=("e_orders", "e_customers"), sql="""
    SELECT c.state, count(*) AS orders FROM e_orders o JOIN e_customers c USING (customer_id) GROUP BY 1""")
def _(spark, sf):
    """A temporary view queried with SQL (no data is stored)."""
    t = Tables(spark, sf)
    name = _tname("v_orders_state")
    m.orders(t).join(m.customers(t), "customer_id").createOrReplaceTempView(name)
    return spark.sql(f"SELECT state, count(*) AS orders FROM {name} GROUP BY state")


@query("snk18_second_version_latest_wins", sql="""
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status,
           CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS version
    FROM orders""")
def _(spark, sf):
    """The same file delivered twice (v2 changes open orders). Appended, both
    versions stand side by side; the keyed table merges them to the latest
    version per key as they come."""
    o = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("order_id"),
                                        F.col("o_orderstatus").alias("status"))
    v1 = o.withColumn("version", F.lit(1))
    v2 = (o.where(F.col("status") == "O").withColumn("status", F.lit("F"))
          .withColumn("version", F.lit(2)))
    path = fresh(spark, "snk18")
    for delivery in (v1, v2):
        delivery.write.mode("append").parquet(f"{path}/raw")
    keyed.create(v1, f"{path}/table", ["order_id"], "version", buckets=16)
    keyed.upsert(f"{path}/table", v2, ["order_id"], "version", buckets=16)
    return keyed.read(spark, f"{path}/table")


@query("snk19_range_partitioned_pruning", sql="""
    SELECT o_orderkey AS order_id, o_totalprice AS total, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) BETWEEN 3 AND 5""")
def _(spark, sf):
    """Partitioned by (year, month) of the purchase date: the filter on the
    partition columns becomes ``PartitionFilters`` (other months never read)."""
    o = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("order_id"),
                                        F.col("o_totalprice").alias("total"),
                                        F.year("o_orderdate").alias("year"),
                                        F.month("o_orderdate").alias("month"))
    path = fresh(spark, "snk19")
    W.write_partitioned(o, path, ["year", "month"])
    back = spark.read.parquet(path)
    return back.where((F.col("year") == 1998) & F.col("month").between(3, 5))
