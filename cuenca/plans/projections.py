"""Projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.functions import columns as C
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.sources.tables import Tables


@query("prj01_column_pruning", sql="""
    SELECT o_orderkey AS order_id, o_orderdate AS purchase_ts, o_orderstatus AS status
    FROM orders""")
def _(spark, sf):
    """Narrow projection: the parquet scan reads only these three columns."""
    return Tables(spark, sf).orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("purchase_ts"),
        F.col("o_orderstatus").alias("status"))


@query("prj05_derived_income", ctes=("e_retail",), sql="""
    SELECT transaccion_id, tienda_id, producto_id, cantidad, precio_unitario,
           CAST(cantidad * precio_unitario AS DECIMAL(18,2)) AS ingreso,
           CAST(CAST(cantidad * precio_unitario AS DECIMAL(18,2)) * 1.19 AS DECIMAL(18,4)) AS amount_with_tax
    FROM e_retail""")
def _(spark, sf):
    """Derived income = quantity × unit price, and amount with 19% tax (decimal)."""
    r = m.retail(Tables(spark, sf))
    return (r.select("transaccion_id", "tienda_id", "producto_id", "cantidad", "precio_unitario")
            .withColumn("ingreso", (F.col("cantidad") * F.col("precio_unitario")).cast("decimal(18,2)"))
            .withColumn("amount_with_tax", F.expr("ingreso * 1.19").cast("decimal(18,4)")))


@query("prj06_high_value_flag", ctes=("e_orders",), sql="""
    SELECT order_id, order_total, order_total >= 300000 AS high_value FROM e_orders""")
def _(spark, sf):
    o = m.orders(Tables(spark, sf))
    return o.select("order_id", "order_total",
                    (F.col("order_total") >= 300000).alias("high_value"))


@query("prj09_constant_columns", ctes=("e_orders",), sql="""
    SELECT order_id, status, 'erp' AS source, DATE '2026-01-14' AS dt FROM e_orders""")
def _(spark, sf):
    """Lineage columns ``source`` and ``dt`` added as literals."""
    o = m.orders(Tables(spark, sf))
    return o.select("order_id", "status", F.lit("erp").alias("source"),
                    F.lit("2026-01-14").cast("date").alias("dt"))


@query("prj11_review_label", ctes=("e_reviews",), sql="""
    SELECT review_id, score,
           CASE WHEN score BETWEEN 1 AND 2 THEN 'mala' WHEN score = 3 THEN 'neutral'
                WHEN score BETWEEN 4 AND 5 THEN 'buena' END AS review_label
    FROM e_reviews""")
def _(spark, sf):
    r = m.reviews(Tables(spark, sf))
    return r.select("review_id", "score", C.review_label("score").alias("review_label"))


@query("prj12_delivery_label", ctes=("e_deliveries",), sql="""
    SELECT order_id,
           CASE WHEN delivered_ts IS NULL THEN 'not_delivered'
                WHEN delivered_ts <= estimated_ts THEN 'on_time' ELSE 'late' END AS delivery_status
    FROM e_deliveries""")
def _(spark, sf):
    d = m.deliveries(Tables(spark, sf))
    return d.select("order_id",
                    C.delivery_label("delivered_ts", "estimated_ts").alias("delivery_status"))


@query("prj13_share_of_total", ctes=("fact",), sql="""
    WITH s AS (SELECT state, sum(revenue) AS revenue FROM fact GROUP BY state)
    SELECT state, CAST(revenue AS DECIMAL(38,2)) AS revenue,
           round(CAST(revenue AS DOUBLE) / NULLIF(CAST(sum(revenue) OVER () AS DOUBLE), 0), 6)
               AS revenue_share
    FROM s""")
def _(spark, sf):
    """State share of total revenue with a zero guard (x / NULLIF(total, 0)).

    The grand total is a window over the 25-row aggregate, not over the fact."""
    from pyspark.sql import Window
    f = m.fact_sales(Tables(spark, sf))
    s = f.groupBy("state").agg(F.sum("revenue").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy())
    return s.select("state", F.col("revenue").cast("decimal(38,2)").alias("revenue"),
                    F.round(C.share(F.col("revenue").cast("double"), total.cast("double")), 6)
                    .alias("revenue_share"))


@query("prj14_unknown_label", ctes=("e_orders", "e_payments"), sql="""
    SELECT o.order_id, coalesce(p.payment_type, 'UNKNOWN') AS payment_label
    FROM e_orders o
    LEFT JOIN (SELECT order_id, max(payment_type) AS payment_type FROM e_payments GROUP BY 1) p
      ON p.order_id = o.order_id""")
def _(spark, sf):
    """Orders without payments get the report-layer label 'UNKNOWN'."""
    t = Tables(spark, sf)
    p = m.payments(t).groupBy("order_id").agg(F.max("payment_type").alias("payment_type"))
    return (m.orders(t).select("order_id").join(p, "order_id", "left")
            .select("order_id", C.unknown_if_null("payment_type").alias("payment_label")))


@query("prj15_lookup_translation", ctes=("e_customers",), sql="""
    SELECT c.customer_id, c.state, coalesce(r.r_name, c.state) AS state_region
    FROM e_customers c
    LEFT JOIN nation n ON n.n_name = c.state
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def _(spark, sf):
    """Code → label lookup by broadcast left join (nation name → region name),
    keeping the code when no translation exists."""
    t = Tables(spark, sf)
    look = (m.nation_b(t).join(m.region_b(t), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("state"), F.col("r_name")))
    return (m.customers(t).join(F.broadcast(look), "state", "left")
            .select("customer_id", "state",
                    F.coalesce("r_name", "state").alias("state_region")))


@query("prj16_pseudonymise", sql="""
    SELECT c_custkey AS customer_id, sha256('cuenca-salt' || c_name) AS name_token,
           c_mktsegment AS segment
    FROM customer""")
def _(spark, sf):
    """Salted SHA-256 token replaces the customer name for analytics."""
    c = Tables(spark, sf).customer
    return c.select(F.col("c_custkey").alias("customer_id"),
                    C.pseudonymise("c_name", "cuenca-salt").alias("name_token"),
                    F.col("c_mktsegment").alias("segment"))
