"""Sort, limit, pagination and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.sources.tables import Tables


def offset_page(df, order, page: int, size: int):
    """LIMIT size OFFSET page*size over a total order (ties broken by a key).
    Cost grows with the offset; prefer ``keyset_page``."""
    return df.orderBy(*order).offset(page * size).limit(size)


def keyset_page(df, ts_col: str, id_col: str, after_ts, after_id, size: int):
    """Rows strictly after (after_ts, after_id) in (ts, id) order.

    The row-value comparison is expanded to ``ts > a OR (ts = a AND id > b)``
    so the ``ts >= a`` part can be pushed to the scan."""
    a, b = F.lit(after_ts).cast(df.schema[ts_col].dataType), F.lit(after_id)
    cond = (F.col(ts_col) > a) | ((F.col(ts_col) == a) & (F.col(id_col) > b))
    return (df.where((F.col(ts_col) >= a) & cond)
            .orderBy(ts_col, id_col).limit(size))


@query("srt02_offset_pagination", sql="""
    SELECT o_orderkey AS order_id, o_orderdate AS purchase_ts FROM orders
    ORDER BY o_orderdate, o_orderkey LIMIT 20 OFFSET 40""")
def _(spark, sf):
    o = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("order_id"),
                                        F.col("o_orderdate").alias("purchase_ts"))
    return offset_page(o, ["purchase_ts", "order_id"], 2, 20)


@query("srt03_keyset_pagination", sql="""
    SELECT o_orderkey AS order_id, o_orderdate AS purchase_ts FROM orders
    WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-06-01', 5000)
    ORDER BY o_orderdate, o_orderkey LIMIT 20""")
def _(spark, sf):
    o = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("order_id"),
                                        F.col("o_orderdate").alias("purchase_ts"))
    return keyset_page(o, "purchase_ts", "order_id", "1998-06-01 00:00:00", 5000, 20)


@query("srt04_sort_by_take", ctes=("e_retail",), sql="""
    SELECT tienda_id, CAST(sum(cantidad * precio_unitario) AS DECIMAL(38,2)) AS total
    FROM e_retail GROUP BY 1 ORDER BY total DESC, tienda_id LIMIT 5""")
def _(spark, sf):
    """RDD ``sortBy(-v).take(5)`` → ``orderBy(desc).limit(5)`` (top-k, no full sort)."""
    r = m.retail(Tables(spark, sf))
    return (r.groupBy("tienda_id").agg(m.msum(F.col("cantidad") * F.col("precio_unitario"))
                                       .alias("total"))
            .orderBy(F.desc("total"), "tienda_id").limit(5))


@query("srt05_top10_products", ctes=("e_retail",), sql="""
    SELECT producto_id, CAST(sum(cantidad * precio_unitario) AS DECIMAL(38,2)) AS ventas
    FROM e_retail GROUP BY 1 ORDER BY ventas DESC, producto_id LIMIT 10""")
def _(spark, sf):
    r = m.retail(Tables(spark, sf))
    return (r.groupBy("producto_id").agg(m.msum(F.col("cantidad") * F.col("precio_unitario"))
                                         .alias("ventas"))
            .orderBy(F.desc("ventas"), "producto_id").limit(10))


@query("set03_concat_then_reaggregate", sql="""
    WITH f1 AS (SELECT event_type, count(*) AS n, sum(value) AS v FROM events
                WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1),
    f2 AS (SELECT event_type, count(*) AS n, sum(value) AS v FROM events
           WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1)
    SELECT event_type, CAST(sum(n) AS BIGINT) AS n, round(sum(v), 4) AS value
    FROM (SELECT * FROM f1 UNION ALL SELECT * FROM f2) GROUP BY 1""")
def _(spark, sf):
    """Per-file partial aggregates, concatenated, then re-aggregated."""
    e = Tables(spark, sf).events
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    files = [e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)]
    parts = [f.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
             for f in files]
    u = parts[0].unionByName(parts[1])
    return u.groupBy("event_type").agg(F.sum("n").cast("bigint").alias("n"),
                                       F.round(F.sum("v"), 4).alias("value"))


@query("set04_distinct", sql="SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf):
    """RDD ``distinct()`` → DataFrame ``distinct`` (partial dedup per task)."""
    return Tables(spark, sf).events.select("user_id", "event_type").distinct()
