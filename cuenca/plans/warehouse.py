"""Warehouse pipelines."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from cuenca.functions import columns as C
from cuenca.operators import warehouse as WH
from cuenca.operators.analytics import exact_percentile
from cuenca.plans import model as m
from cuenca.plans.joins import dim_tiempo
from cuenca.plans.registry import query
from cuenca.plans.sources import fresh
from cuenca.session import materialize
from cuenca.sinks import keyed
from cuenca.sinks.writers import publish_together, read_published
from cuenca.sources.tables import Tables


@query("pip07_wide_order_item_table", ctes=("e_items", "e_orders", "e_customers", "e_products",
                                             "e_sellers", "e_payments", "e_reviews"), sql="""
    WITH pay AS (SELECT order_id, count(*) AS n_payments, CAST(sum(payment_value) AS DECIMAL(38,2)) AS paid,
                        max(payment_value) AS max_payment FROM e_payments GROUP BY 1),
    rev AS (SELECT customer_id, max(score) AS review_score, max(review_ts) AS review_ts,
                   max(review_kind) AS review_kind FROM e_reviews GROUP BY 1)
    SELECT i.order_id, i.item_id, o.purchase_ts, o.status, c.state, c.segment, p.category, s.seller_state,
           i.price, i.freight, coalesce(pay.n_payments, 0) AS n_payments, pay.paid, pay.max_payment,
           rev.review_score, rev.review_ts, rev.review_kind
    FROM e_items i JOIN e_orders o ON o.order_id = i.order_id
    JOIN e_customers c ON c.customer_id = o.customer_id
    JOIN e_products p ON p.product_id = i.product_id
    JOIN e_sellers s ON s.seller_id = i.seller_id
    LEFT JOIN pay ON pay.order_id = i.order_id
    LEFT JOIN rev ON rev.customer_id = o.customer_id""")
def _(spark, sf):
    """Denormalised order-item table. Reviews are aggregated to the join key
    before the left join, so the item grain is kept; what is at order grain
    (customer, reviews) is attached to the orders first. A line is an item and a
    payment: the lines are read and shuffled by order once, and an order's
    payments are summed over its lines in that partitioning. So the item-grain
    rows are shuffled three times (order, product, seller). As in the course,
    review score, time and kind are each a MAX: one row may mix values of
    different reviews."""
    t = Tables(spark, sf)
    order = Window.partitionBy("order_id")              # the lines of an order
    lines = m.items(t, "payment_value").withColumns({
        "n_payments": F.count(F.lit(1)).over(order), "paid": F.sum("payment_value").over(order).cast("decimal(38,2)"),
        "max_payment": F.max("payment_value").over(order)})
    rev = m.reviews(t).groupBy("customer_id").agg(
        F.max("score").alias("review_score"), F.max("review_ts").alias("review_ts"),
        F.max("review_kind").alias("review_kind"))
    order_grain = (m.orders(t).join(m.customers(t), "customer_id")
                   .join(rev, "customer_id", "left"))
    w = (lines.join(order_grain, "order_id")
         .join(m.products(t), "product_id").join(m.sellers(t), "seller_id"))
    return w.select("order_id", "item_id", "purchase_ts", "status", "state", "segment", "category",
                    "seller_state", "price", "freight",
                    "n_payments", "paid", "max_payment",
                    "review_score", "review_ts", "review_kind")


@query("pip08_raw_stg_dim_fact", sql="""
    WITH stg AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
                        CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
    dim AS (SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_sk
            FROM (SELECT DISTINCT customer_id FROM stg))
    SELECT s.order_id, d.customer_sk, CAST(strftime(s.order_ts, '%Y%m%d') AS INTEGER) AS date_sk, s.amount
    FROM stg s JOIN dim d USING (customer_id)""")
def _(spark, sf):
    """ELT in three stages: raw_ (text) → stg_ (typed) → dim_/fact_ (keys)."""
    from cuenca.operators.ingest import to_silver
    t = Tables(spark, sf)
    raw = t.orders.select(F.col("o_orderkey").cast("string").alias("order_id"),
                          F.col("o_custkey").cast("string").alias("customer_id"),
                          F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("order_ts"),
                          F.col("o_orderstatus").alias("status"),
                          F.col("o_totalprice").cast("string").alias("total_amount"),
                          F.lit("COP").alias("currency"))
    stg = to_silver(raw, "orders").select(
        F.col("order_id").cast("bigint").alias("order_id"),
        F.col("customer_id").cast("bigint").alias("customer_id"), "order_ts",
        F.col("total_amount").alias("amount"))
    dim = WH.with_surrogate_key(stg.select("customer_id").distinct(), "customer_id", "customer_sk")
    fact = WH.lookup_sk(stg, dim, "customer_id", "customer_id", "customer_sk")
    return fact.select("order_id", "customer_sk",
                       F.date_format("order_ts", "yyyyMMdd").cast("int").alias("date_sk"), "amount")


def _customer_snapshots(t):
    """Snapshot v1 (customers with balance < 9000) and v2 (all customers;
    customers with a negative balance moved to the next nation)."""
    moved = (F.col("c_nationkey") + 1) % 25
    v1 = t.customer.where(F.col("c_acctbal") < 9000).join(
        m.nation_b(t), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"))
    n2 = m.nation_b(t).select(F.col("n_nationkey").alias("k2"), F.col("n_name").alias("city2"))
    v2 = (t.customer.withColumn("k2", F.when(F.col("c_acctbal") < 0, moved).otherwise(F.col("c_nationkey")))
          .join(n2, "k2").select(F.col("c_custkey").alias("customer_id"), F.col("city2").alias("city"),
                                 F.col("c_mktsegment").alias("segment")))
    return v1, v2


_SNAP_SQL = """
    v1 AS (SELECT c_custkey AS customer_id, n_name AS city, c_mktsegment AS segment
           FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal < 9000),
    v2 AS (SELECT c_custkey AS customer_id, n.n_name AS city, c_mktsegment AS segment
           FROM customer JOIN nation n
             ON n.n_nationkey = CASE WHEN c_acctbal < 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END)"""


@query("pip09_scd2_customer_dimension", sql=f"""
    WITH {_SNAP_SQL}
    SELECT v1.customer_id, v1.city, v1.segment, DATE '2020-01-01' AS effective_date,
           CASE WHEN v2.city IS DISTINCT FROM v1.city OR v2.segment IS DISTINCT FROM v1.segment
                THEN DATE '2024-06-30' ELSE DATE '9999-12-31' END AS expiration_date,
           NOT (v2.city IS DISTINCT FROM v1.city OR v2.segment IS DISTINCT FROM v1.segment) AS is_current
    FROM v1 JOIN v2 USING (customer_id)
    UNION ALL
    SELECT v2.customer_id, v2.city, v2.segment, DATE '2024-06-30', DATE '9999-12-31', TRUE
    FROM v2 LEFT JOIN v1 USING (customer_id)
    WHERE v1.customer_id IS NULL OR v2.city IS DISTINCT FROM v1.city OR v2.segment IS DISTINCT FROM v1.segment""")
def _(spark, sf):
    """SCD type 2: a changed city closes the current row and opens a new
    version; customers new in the snapshot are opened."""
    v1, v2 = _customer_snapshots(Tables(spark, sf))
    dim = WH.scd2_initial(v1, "2020-01-01")
    return WH.scd2(dim, v2, "customer_id", ["city", "segment"], "2024-06-30")


@query("pip10_scd1_overwrite", sql=f"""
    WITH {_SNAP_SQL}
    SELECT customer_id, city, segment FROM v1 WHERE customer_id NOT IN (SELECT customer_id FROM v2)
    UNION ALL SELECT customer_id, city, segment FROM v2""")
def _(spark, sf):
    """SCD type 1: attributes overwritten by key; the buckets of the keyed
    table that the snapshot touches are rewritten."""
    v1, v2 = _customer_snapshots(Tables(spark, sf))
    path = fresh(spark, "pip10")
    keyed.create(v1, path, ["customer_id"], buckets=16)
    keyed.upsert(path, v2, ["customer_id"], buckets=16)
    return keyed.read(spark, path)


@query("pip11_surrogate_keys_unknown_member", sql="""
    SELECT CAST(row_number() OVER (ORDER BY p_partkey % 2, p_partkey) AS BIGINT) AS product_sk, p_partkey AS product_id,
           p_type AS category FROM part
    UNION ALL SELECT -1, NULL, 'UNKNOWN'""")
def _(spark, sf):
    """Two loads: products of even keys first, then all. The second load keeps
    the keys of the first and numbers the new products after them."""
    p = Tables(spark, sf).part.select(F.col("p_partkey").alias("product_id"),
                                      F.col("p_type").alias("category"))
    first = WH.with_surrogate_key(p.where(F.col("product_id") % 2 == 0), "product_id", "product_sk")
    return WH.with_surrogate_key(p, "product_id", "product_sk",
                                 unknown={"product_id": None, "category": "UNKNOWN"}, existing=first)


@query("pip12_star_schema_fact", ctes=("e_items", "e_orders", "e_customers"), sql="""
    WITH zona AS (SELECT state, row_number() OVER (ORDER BY state) AS zona_sk
                  FROM (SELECT DISTINCT n_name AS state FROM nation))
    SELECT i.order_id, i.item_id, CAST(strftime(o.purchase_date, '%Y%m%d') AS INTEGER) AS date_sk,
           coalesce(z.zona_sk, -1) AS zona_sk, i.product_id, i.price, i.freight
    FROM e_items i JOIN e_orders o ON o.order_id = i.order_id
    JOIN e_customers c ON c.customer_id = o.customer_id LEFT JOIN zona z ON z.state = c.state""")
def _(spark, sf):
    """fact_orders_items at item grain with keys into dim_tiempo (yyyymmdd,
    calendar built by ``sequence``) and dim_zona (surrogate key, -1 unknown)."""
    t = Tables(spark, sf)
    zona = WH.with_surrogate_key(t.nation.select(F.col("n_name").alias("state")).distinct(),
                                 "state", "zona_sk")
    o = m.orders(t)
    tiempo = materialize(dim_tiempo(spark, o, "purchase_date"))   # Spark sees its size
    f = (m.items(t).join(o.select("order_id", "customer_id", "purchase_date"), "order_id")
         .join(m.customers(t).select("customer_id", "state"), "customer_id"))
    f = WH.lookup_sk(f, zona, "state", "state", "zona_sk")
    f = f.join(tiempo.select(F.col("fecha").alias("purchase_date"), "date_sk"), "purchase_date")
    return f.select("order_id", "item_id", "date_sk", "zona_sk", "product_id", "price", "freight")


@query("pip13_order_delivery_fact", ctes=("e_deliveries",), sql="""
    SELECT order_id, purchase_ts, estimated_ts, delivered_ts,
           CAST(date_diff('day', CAST(purchase_ts AS DATE), CAST(delivered_ts AS DATE)) AS INTEGER) AS delivery_days,
           CAST(date_diff('day', CAST(estimated_ts AS DATE), CAST(delivered_ts AS DATE)) AS INTEGER) AS delay_days,
           CASE WHEN delivered_ts IS NULL THEN 'not_delivered'
                WHEN delivered_ts <= estimated_ts THEN 'on_time' ELSE 'late' END AS delivery_status
    FROM e_deliveries""")
def _(spark, sf):
    d = m.deliveries(Tables(spark, sf))
    return d.select("order_id", "purchase_ts", "estimated_ts", "delivered_ts",
                    F.datediff("delivered_ts", "purchase_ts").alias("delivery_days"),
                    F.datediff("delivered_ts", "estimated_ts").alias("delay_days"),
                    C.delivery_label("delivered_ts", "estimated_ts").alias("delivery_status"))


def _cancellations(t):
    """Cancellation requests: urgent orders still pending."""
    return t.orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")) \
        .select(F.col("o_orderkey").alias("order_id"))


@query("pip16_cancellation_batch", ctes=("e_orders", "e_payments"), sql="""
    WITH c AS (SELECT o_orderkey AS order_id FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'),
    o AS (SELECT CASE WHEN order_id IN (SELECT order_id FROM c) THEN 'canceled' ELSE status END AS status
          FROM e_orders),
    p AS (SELECT CASE WHEN order_id IN (SELECT order_id FROM c) THEN 0 ELSE payment_value END AS v FROM e_payments)
    SELECT 'orders' AS output, status AS label, count(*) AS n_rows, CAST(NULL AS DECIMAL(38,2)) AS amount
    FROM o GROUP BY status
    UNION ALL SELECT 'payments', 'total', count(*), CAST(sum(v) AS DECIMAL(38,2)) FROM p
    UNION ALL SELECT 'audit', 'P->canceled', (SELECT count(*) FROM c), NULL""")
def _(spark, sf):
    """Status change, payments zeroed and audit rows derived from one
    cancellations table, published as one unit and read back from it."""
    t = Tables(spark, sf)
    root = fresh(spark, "pip16")
    frames = dict(zip(("orders", "payments", "audit"), WH.cancel_orders(m.orders(t), m.payments(t), _cancellations(t))))
    publish_together(spark, frames, root)
    o, p, a = (read_published(spark, root, n) for n in frames)
    no_amt = F.lit(None).cast("decimal(38,2)")
    s1 = o.groupBy(F.col("status").alias("label")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit("orders").alias("output"), "label", "n_rows", no_amt.alias("amount"))
    s2 = p.agg(F.lit("payments").alias("output"), F.lit("total").alias("label"),
               F.count(F.lit(1)).alias("n_rows"), m.msum("payment_value").alias("amount"))
    s3 = a.agg(F.lit("audit").alias("output"), F.lit("P->canceled").alias("label"),
               F.count(F.lit(1)).alias("n_rows"), no_amt.alias("amount"))
    return s1.unionByName(s2).unionByName(s3)


@query("pip17_change_audit", ctes=("e_reviews",), sql="""
    WITH old AS (SELECT review_id, customer_id, score FROM e_reviews),
    new AS (SELECT review_id, CASE WHEN review_kind = 'error' THEN score % 5 + 1 ELSE score END AS score
            FROM e_reviews)
    SELECT o.review_id, o.customer_id, o.score AS old_score, n.score AS new_score,
           TIMESTAMP '2024-02-01 00:00:00' AS changed_at
    FROM old o JOIN new n USING (review_id) WHERE o.score IS DISTINCT FROM n.score""")
def _(spark, sf):
    """Audit ``old_score → new_score`` between two review snapshots (the
    trigger's effect, computed as a snapshot diff)."""
    r = m.reviews(Tables(spark, sf))
    old = r.select("review_id", "customer_id", "score")
    new = r.select("review_id", F.when(F.col("review_kind") == "error", F.col("score") % 5 + 1)
                   .otherwise(F.col("score")).alias("score"))
    return WH.audit_changes(old, new, "review_id", "score", "2024-02-01 00:00:00",
                            carry=["customer_id"])


@query("pip18_outliers_flag_and_cap", ctes=("e_items",), sql="""
    WITH p AS (SELECT quantile_cont(CAST(price AS DOUBLE), 0.99) AS p99 FROM e_items)
    SELECT order_id, item_id, price, CAST(price AS DOUBLE) > p.p99 AS is_outlier,
           least(CAST(price AS DOUBLE), p.p99) AS price_capped
    FROM e_items, p""")
def _(spark, sf):
    i = m.items(Tables(spark, sf)).select("order_id", "item_id", "price")
    p99 = exact_percentile(i, "price", 0.99)
    return WH.treat_outliers(WH.treat_outliers(i, "price", how="flag", threshold=p99), "price", how="cap", threshold=p99)


@query("pip18_outliers_drop", ctes=("e_items",), sql="""
    WITH p AS (SELECT quantile_cont(CAST(price AS DOUBLE), 0.99) AS p99 FROM e_items)
    SELECT count(*) AS kept FROM e_items, p WHERE CAST(price AS DOUBLE) <= p.p99""")
def _(spark, sf):
    i = m.items(Tables(spark, sf))
    return WH.treat_outliers(i, "price", 0.99, "drop").agg(F.count(F.lit(1)).alias("kept"))


def _change_feed(t):
    """CDC feed over orders: orders of odd keys inserted (seq 1; those of even keys
    are in the table), open orders updated to F (seq 2), low-priority pending
    orders deleted (seq 3)."""
    o = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                        F.col("o_orderpriority").alias("priority"))
    ins = o.where(F.col("order_id") % 2 == 1).select("order_id", "status", F.lit("I").alias("op"), F.lit(1).alias("seq"))
    upd = o.where(F.col("status") == "O").select("order_id", F.lit("F").alias("status"),
                                                 F.lit("U").alias("op"), F.lit(2).alias("seq"))
    dele = o.where((F.col("status") == "P") & (F.col("priority") == "5-LOW")).select(
        "order_id", "status", F.lit("D").alias("op"), F.lit(3).alias("seq"))
    return ins.unionByName(upd).unionByName(dele)


@query("pip19_cdc_apply", sql="""
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status
    FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')""")
def _(spark, sf):
    """Ordered I/U/D changes applied to a filled table (orders of even keys): the
    last change per key wins, untouched rows stay, deleted ones go."""
    t = Tables(spark, sf)
    table = t.orders.where(F.col("o_orderkey") % 2 == 0).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    path = fresh(spark, "pip19")
    keyed.create(table, path, ["order_id"], buckets=16)
    keyed.apply_changes(path, _change_feed(t), ["order_id"], buckets=16)
    return keyed.read(spark, path)


@query("pip20_retention", ctes=("e_orders",), sql="""
    SELECT order_id, purchase_date FROM e_orders
    WHERE purchase_date >= CAST(DATE '2001-08-01' - INTERVAL 18 MONTH AS DATE)""")
def _(spark, sf):
    """Keep 18 months before the reference date (partition-prunable predicate)."""
    o = m.orders(Tables(spark, sf)).select("order_id", "purchase_date")
    return WH.retain(o, "purchase_date", "2001-08-01", months=18)
