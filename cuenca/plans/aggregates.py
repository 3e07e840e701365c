"""Aggregations.

Every grouping here is planned as partial aggregate → hash exchange → final
aggregate, so a key holding a third of the rows costs one partial row per
task before the shuffle. Money totals are exact DECIMAL(38,2); averages and
ratios are rounded doubles.
"""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from cuenca.functions import columns as C
from cuenca.operators import analytics as A
from cuenca.operators import olap
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.session import materialize
from cuenca.sources.tables import Tables


def _avg2(c):
    return m.avg_money(c)


AVG = m.avg_money_sql


def _sales(t):
    return m.retail(t).withColumn("ingreso", F.col("cantidad") * F.col("precio_unitario"))


_INGRESO = "cantidad * precio_unitario"


@query("agg01_sales_by_store", ctes=("e_retail",), sql=f"""
    SELECT tienda_id, CAST(sum({_INGRESO}) AS DECIMAL(38,2)) AS total_ventas
    FROM e_retail GROUP BY tienda_id ORDER BY total_ventas DESC""")
def _(spark, sf):
    s = _sales(Tables(spark, sf))
    return (s.groupBy("tienda_id").agg(m.msum("ingreso").alias("total_ventas"))
            .orderBy(F.desc("total_ventas")))


@query("agg02_sales_by_category", ctes=("e_retail",), sql=f"""
    SELECT categoria, CAST(sum({_INGRESO}) AS DECIMAL(38,2)) AS total_ventas,
           CAST(sum(cantidad) AS BIGINT) AS unidades
    FROM e_retail GROUP BY categoria""")
def _(spark, sf):
    s = _sales(Tables(spark, sf))
    return s.groupBy("categoria").agg(m.msum("ingreso").alias("total_ventas"),
                                      F.sum("cantidad").cast("bigint").alias("unidades"))


@query("agg02_sales_by_payment_method", ctes=("e_retail",), sql=f"""
    SELECT metodo_pago, CAST(sum({_INGRESO}) AS DECIMAL(38,2)) AS total_ventas,
           count(*) AS transacciones
    FROM e_retail GROUP BY metodo_pago""")
def _(spark, sf):
    s = _sales(Tables(spark, sf))
    return s.groupBy("metodo_pago").agg(m.msum("ingreso").alias("total_ventas"),
                                        F.count(F.lit(1)).alias("transacciones"))


@query("agg03_average_ticket_by_store", ctes=("e_retail",), sql=f"""
    SELECT tienda_id, {AVG(_INGRESO)} AS ticket_promedio
    FROM e_retail GROUP BY tienda_id""")
def _(spark, sf):
    s = _sales(Tables(spark, sf))
    return s.groupBy("tienda_id").agg(
        m.avg_money(_INGRESO).alias("ticket_promedio"))


@query("agg04_count_sum_avg_per_customer", ctes=("e_orders",), sql=f"""
    SELECT customer_id, count(*) AS orders, CAST(sum(order_total) AS DECIMAL(38,2)) AS total_spent,
           {AVG('order_total')} AS avg_ticket
    FROM e_orders GROUP BY customer_id""")
def _(spark, sf):
    o = m.orders(Tables(spark, sf))
    return o.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"),
                                        m.msum("order_total").alias("total_spent"),
                                        _avg2("order_total").alias("avg_ticket"))


def word_count(df, text_col: str):
    """Word count: lower-case, split on a single space, count (lowering the
    whole text once equals lowering each word: no space is created).

    Each task pre-counts its words (partial aggregation), so a very frequent
    word ships one row per task, and whole texts are processed."""
    w = df.select(F.explode(F.split(F.lower(F.col(text_col)), " ")).alias("palabra"))
    return w.groupBy("palabra").count()


@query("agg05_word_count", sql="""
    SELECT lower(w) AS palabra, count(*) AS count
    FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1""")
def _(spark, sf):
    return word_count(Tables(spark, sf).documents, "text")


@query("agg06_count_per_product_top20", ctes=("e_items",), sql="""
    SELECT product_id, count(*) AS n_items FROM e_items
    GROUP BY product_id ORDER BY n_items DESC, product_id LIMIT 20""")
def _(spark, sf):
    i = m.items(Tables(spark, sf))
    return (i.groupBy("product_id").agg(F.count(F.lit(1)).alias("n_items"))
            .orderBy(F.desc("n_items"), "product_id").limit(20))


@query("agg07_payments_per_order", ctes=("e_payments",), sql="""
    SELECT order_id, count(*) AS n_payments,
           CAST(sum(payment_value) AS DECIMAL(38,2)) AS total_paid, max(payment_value) AS max_payment
    FROM e_payments GROUP BY order_id""")
def _(spark, sf):
    p = m.payments(Tables(spark, sf))
    return p.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_payments"),
                                     m.msum("payment_value").alias("total_paid"),
                                     F.max("payment_value").alias("max_payment"))


@query("agg08_max_time_and_text", ctes=("e_reviews",), sql="""
    SELECT customer_id, max(review_ts) AS last_review_ts, max(review_kind) AS max_kind,
           max(score) AS max_score
    FROM e_reviews GROUP BY customer_id""")
def _(spark, sf):
    """MAX of a timestamp and of strings, each independent (a row may mix reviews)."""
    r = m.reviews(Tables(spark, sf))
    return r.groupBy("customer_id").agg(F.max("review_ts").alias("last_review_ts"),
                                        F.max("review_kind").alias("max_kind"),
                                        F.max("score").alias("max_score"))


@query("agg10_revenue_per_order_by_category", ctes=("fact",), sql=f"""
    SELECT category, count(DISTINCT order_id) AS orders,
           CAST(sum(price) AS DECIMAL(38,2)) AS revenue,
           {AVG('price', 'count(DISTINCT order_id)')} AS revenue_per_order
    FROM fact GROUP BY category""")
def _(spark, sf):
    """Orders, revenue (sum of item prices) and revenue per order by category."""
    t = Tables(spark, sf)
    f = m.by_order(t, m.fact_sales(t).select("order_id", "category", "price"))
    return f.groupBy("category").agg(
        F.countDistinct("order_id").alias("orders"), m.msum("price").alias("revenue"),
        m.avg_money("price", "count(DISTINCT order_id)").alias("revenue_per_order"))


@query("agg11_avg_ticket_by_state", ctes=("fact",), sql=f"""
    SELECT state, {AVG('order_total')} AS avg_ticket, count(*) AS orders
    FROM (SELECT order_id, state, sum(revenue) AS order_total FROM fact GROUP BY 1, 2)
    GROUP BY state""")
def _(spark, sf):
    """Per-order totals first, then the average per state (two-level aggregate)."""
    f = m.fact_sales(Tables(spark, sf))
    per_order = f.groupBy("order_id", "state").agg(F.sum("revenue").alias("order_total"))
    return per_order.groupBy("state").agg(_avg2("order_total").alias("avg_ticket"),
                                          F.count(F.lit(1)).alias("orders"))


@query("agg12_daily_revenue", ctes=("e_payments", "e_orders"), sql="""
    SELECT o.purchase_date AS order_date, CAST(sum(p.payment_value) AS DECIMAL(38,2)) AS revenue,
           count(DISTINCT p.order_id) AS orders
    FROM e_payments p JOIN e_orders o ON o.order_id = p.order_id GROUP BY 1""")
def _(spark, sf):
    t = Tables(spark, sf)
    p = m.payments(t).join(m.orders(t).select("order_id", "purchase_date"), "order_id")
    return p.groupBy(F.col("purchase_date").alias("order_date")).agg(
        m.msum("payment_value").alias("revenue"), F.countDistinct("order_id").alias("orders"))


@query("agg14_count_filter_pivot_scores", ctes=("e_reviews", "e_customers"), sql="""
    SELECT c.state,
           count(*) FILTER (WHERE score = 1) AS score_1, count(*) FILTER (WHERE score = 2) AS score_2,
           count(*) FILTER (WHERE score = 3) AS score_3, count(*) FILTER (WHERE score = 4) AS score_4,
           count(*) FILTER (WHERE score = 5) AS score_5
    FROM e_reviews r JOIN e_customers c ON c.customer_id = r.customer_id GROUP BY c.state""")
def _(spark, sf):
    t = Tables(spark, sf)
    r = m.reviews(t).join(m.customers(t), "customer_id")
    return r.groupBy("state").agg(*[F.count_if(F.col("score") == k).alias(f"score_{k}")
                                    for k in range(1, 6)])


@query("agg18_rollup_with_grouping", ctes=("fact",), sql="""
    SELECT state, category, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue,
           CAST(grouping(state) AS INTEGER) AS g_state,
           CAST(grouping(category) AS INTEGER) AS g_category
    FROM fact GROUP BY ROLLUP (state, category)""")
def _(spark, sf):
    """ROLLUP(state, category) with GROUPING() markers telling subtotal rows
    from NULL keys."""
    f = m.fact_sales(Tables(spark, sf))
    return f.rollup("state", "category").agg(
        m.msum("revenue").alias("total_revenue"),
        F.grouping("state").cast("int").alias("g_state"),
        F.grouping("category").cast("int").alias("g_category"))


@query("agg19_rollup_year_category", ctes=("fact",), sql="""
    SELECT CAST(year(purchase_date) AS INTEGER) AS year, category,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact GROUP BY ROLLUP (year(purchase_date), category)""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf)).withColumn("year", F.year("purchase_date"))
    return olap.rollup_levels(f, ["year", "category"], {"total_revenue": m.msum("revenue")})


@query("agg20_grouping_sets_level_label", ctes=("e_orders",), sql="""
    SELECT CASE WHEN grouping(year(purchase_date)) = 1 THEN 'TOTAL'
                WHEN grouping(month(purchase_date)) = 1 THEN 'AÑO' ELSE 'AÑO_MES' END AS nivel,
           CAST(year(purchase_date) AS INTEGER) AS year, CAST(month(purchase_date) AS INTEGER) AS month,
           count(*) AS orders, CAST(sum(order_total) AS DECIMAL(38,2)) AS total
    FROM e_orders
    GROUP BY GROUPING SETS ((), (year(purchase_date)), (year(purchase_date), month(purchase_date)))""")
def _(spark, sf):
    """GROUPING SETS ((), (year), (year, month)) in one Expand + one shuffle,
    labelled TOTAL / AÑO / AÑO_MES."""
    o = (m.orders(Tables(spark, sf))
         .withColumns({"year": F.year("purchase_date"), "month": F.month("purchase_date")}))
    g = olap.grouping_sets(o, [[], ["year"], ["year", "month"]],
                           {"orders": F.count(F.lit(1)), "total": m.msum("order_total")},
                           level_col="gid")
    nivel = F.when(F.col("gid") == 3, "TOTAL").when(F.col("gid") == 1, "AÑO").otherwise("AÑO_MES")
    return g.select(nivel.alias("nivel"), "year", "month", "orders", "total")


@query("agg21_grouping_sets_dims", ctes=("fact",), sql="""
    SELECT state, category, payment_type, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue,
           CAST(grouping(state, category, payment_type) AS INTEGER) AS gid
    FROM fact GROUP BY GROUPING SETS ((state), (category), (payment_type), ())""")
def _(spark, sf):
    """State / category / payment type / grand total in one pass. The payment
    type is an order attribute here, so items are not multiplied by payments."""
    f = m.fact_sales(Tables(spark, sf))
    return olap.grouping_sets(f, [["state"], ["category"], ["payment_type"], []],
                              {"total_revenue": m.msum("revenue")}, level_col="gid"
                              ).withColumn("gid", F.col("gid").cast("int"))


@query("agg23_having_duplicates", sql="""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    return (li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def _days():
    return F.datediff(F.col("delivered_ts"), F.col("purchase_ts"))
_DAYS_SQL = "date_diff('day', CAST(purchase_ts AS DATE), CAST(delivered_ts AS DATE))"


@query("agg24_delivery_percentiles", ctes=("e_deliveries", "e_customers"), sql=f"""
    SELECT c.state,
           round(quantile_cont({_DAYS_SQL}, 0.5), 4) AS p50,
           round(quantile_cont({_DAYS_SQL}, 0.9), 4) AS p90,
           round(quantile_cont({_DAYS_SQL}, 0.95), 4) AS p95,
           round(avg({_DAYS_SQL}), 4) AS mean_days,
           round(avg(CASE WHEN delivered_ts > estimated_ts THEN 1.0 ELSE 0.0 END), 4) AS pct_late
    FROM e_deliveries d JOIN e_customers c ON c.customer_id = d.customer_id
    WHERE delivered_ts IS NOT NULL GROUP BY c.state""")
def _(spark, sf):
    """Exact percentiles (linear interpolation, = percentile_cont) of
    delivery days per state. Days have a small domain, so the rows are
    counted per (state, days) first and the percentiles are read from the
    cumulative counts: memory is bounded by the distinct days, not by the
    deliveries of a state (``percentile`` would buffer every value)."""
    t = Tables(spark, sf)
    d = (m.deliveries(t).where(F.col("delivered_ts").isNotNull())
         .join(m.customers(t).select("customer_id", "state"), "customer_id")
         .withColumn("days", _days()))
    # the deliveries are joined and counted once; everything follows from the counts
    n = materialize(d.groupBy("state", "days").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("delivered_ts") > F.col("estimated_ts")).alias("late")))
    pct = A.percentiles_from_counts(n, "state", "days", {"p50": 0.5, "p90": 0.9, "p95": 0.95}, counted="n")
    rest = n.groupBy("state").agg(
        F.round(F.sum(F.col("days") * F.col("n")) / F.sum("n"), 4).alias("mean_days"),
        F.round(F.sum("late") / F.sum("n"), 4).alias("pct_late"))
    return pct.select("state", *[F.round(c, 4).alias(c) for c in ("p50", "p90", "p95")]).join(
        rest, "state")


@query("agg25_p99_and_count_above", ctes=("e_items",), sql="""
    WITH p AS (SELECT quantile_cont(CAST(price AS DOUBLE), 0.99) AS p99 FROM e_items)
    SELECT round(p.p99, 4) AS p99, count(*) FILTER (WHERE CAST(i.price AS DOUBLE) > p.p99) AS n_above
    FROM e_items i CROSS JOIN p GROUP BY p.p99""")
def _(spark, sf):
    """p99 of price, computed once and exactly by narrowing its range, then
    a count above it."""
    i = m.items(Tables(spark, sf)).withColumn("price_d", F.col("price").cast("double"))
    p99 = F.lit(A.exact_percentile(i, "price", 0.99)).cast("double")
    return i.agg(F.round(F.first(p99), 4).alias("p99"),
                 F.count_if(F.col("price_d") > p99).alias("n_above"))


@query("agg26_mean_delay_minutes", ctes=("e_deliveries", "e_orders"), sql="""
    SELECT o.payment_type AS driver,
           round(avg(date_diff('minute', d.estimated_ts, d.delivered_ts)), 2) AS avg_delay_min
    FROM e_deliveries d JOIN e_orders o ON o.order_id = d.order_id
    WHERE d.delivered_ts IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    """Mean delay (actual − scheduled) in minutes per driver (stand-in: the
    order priority)."""
    t = Tables(spark, sf)
    d = (m.deliveries(t).where(F.col("delivered_ts").isNotNull())
         .join(m.orders(t).select("order_id", F.col("payment_type").alias("driver")), "order_id"))
    return d.groupBy("driver").agg(F.round(F.avg(
        F.timestamp_diff("MINUTE", "estimated_ts", "delivered_ts")), 2).alias("avg_delay_min"))


@query("agg27_top_states_share", ctes=("fact",), sql="""
    WITH s AS (SELECT state, sum(revenue) AS revenue FROM fact GROUP BY state)
    SELECT state, CAST(revenue AS DECIMAL(38,2)) AS revenue,
           round(100.0 * CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE), 4) AS pct_total
    FROM s ORDER BY revenue DESC, state LIMIT 10""")
def _(spark, sf):
    """Top 10 and percentage of the grand total (window over the small aggregate)."""
    f = m.fact_sales(Tables(spark, sf))
    s = f.groupBy("state").agg(F.sum("revenue").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy()).cast("double")
    return (s.select("state", F.col("revenue").cast("decimal(38,2)").alias("revenue"),
                     F.round(100.0 * F.col("revenue").cast("double") / total, 4).alias("pct_total"))
            .orderBy(F.desc("revenue"), "state").limit(10))


@query("agg28_avg_ticket_year_status", ctes=("e_orders",), sql=f"""
    SELECT CAST(year(purchase_date) AS INTEGER) AS year, status,
           {AVG('order_total')} AS avg_ticket, count(*) AS orders
    FROM e_orders GROUP BY 1, 2""")
def _(spark, sf):
    o = m.orders(Tables(spark, sf))
    return o.groupBy(F.year("purchase_date").alias("year"), "status").agg(
        _avg2("order_total").alias("avg_ticket"), F.count(F.lit(1)).alias("orders"))


def cohort_table(orders_df, customer_col: str, date_col: str):
    """Orders per (cohort month, months since cohort). The cohort is each
    customer's first purchase month (aggregate, then join back: no window
    over a hot customer)."""
    o = orders_df.withColumn("m", F.trunc(date_col, "month"))
    first = o.groupBy(customer_col).agg(F.min("m").alias("cohort_month"))
    j = o.join(first, customer_col)
    rel = F.months_between("m", "cohort_month").cast("int")
    return j.groupBy("cohort_month", rel.alias("month_number")).agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct(customer_col).alias("customers"))


@query("agg29_cohort_table", ctes=("e_orders",), sql="""
    WITH o AS (SELECT customer_id, CAST(date_trunc('month', purchase_date) AS DATE) AS m FROM e_orders),
    f AS (SELECT customer_id, min(m) AS cohort_month FROM o GROUP BY 1)
    SELECT f.cohort_month, CAST(date_diff('month', f.cohort_month, o.m) AS INTEGER) AS month_number,
           count(*) AS orders, count(DISTINCT o.customer_id) AS customers
    FROM o JOIN f USING (customer_id) GROUP BY 1, 2""")
def _(spark, sf):
    return cohort_table(m.orders(Tables(spark, sf)), "customer_id", "purchase_date")


def _recurrence(t):
    o = m.orders(t)
    per = o.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"),
                                       F.sum("order_total").alias("spent"))
    seg = F.when(F.col("n_orders") >= 3, "recurrente").otherwise("no_recurrente")
    return per.withColumn("segmento", seg)


_REC_SQL = """rec AS (SELECT customer_id, count(*) AS n_orders, sum(order_total) AS spent,
        CASE WHEN count(*) >= 3 THEN 'recurrente' ELSE 'no_recurrente' END AS segmento
    FROM e_orders GROUP BY customer_id)"""


@query("agg30_recurrent_customers", ctes=("e_orders",), sql=f"""
    WITH {_REC_SQL}
    SELECT segmento, count(*) AS customers, CAST(sum(n_orders) AS BIGINT) AS orders,
           CAST(sum(spent) AS DECIMAL(38,2)) AS revenue,
           {AVG('spent', 'sum(n_orders)')} AS avg_ticket
    FROM rec GROUP BY segmento""")
def _(spark, sf):
    """Recurrent (≥3 orders) vs non-recurrent: customers, orders, revenue, ticket."""
    r = _recurrence(Tables(spark, sf))
    return r.groupBy("segmento").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("n_orders").cast("bigint").alias("orders"),
        m.msum("spent").alias("revenue"),
        m.avg_money("spent", "sum(n_orders)").alias("avg_ticket"))


@query("agg30_recurrent_state_distribution", ctes=("e_orders", "e_customers"), sql=f"""
    WITH {_REC_SQL},
    g AS (SELECT segmento, state, count(*) AS customers
          FROM rec JOIN e_customers USING (customer_id) GROUP BY 1, 2)
    SELECT segmento, state, customers,
           round(100.0 * customers / sum(customers) OVER (PARTITION BY segmento), 4) AS pct
    FROM g""")
def _(spark, sf):
    """Share of each state within each recurrence segment (window on the
    small aggregate, partitioned by the two segment values)."""
    t = Tables(spark, sf)
    g = (_recurrence(t).join(m.customers(t).select("customer_id", "state"), "customer_id")
         .groupBy("segmento", "state").agg(F.count(F.lit(1)).alias("customers")))
    tot = F.sum("customers").over(Window.partitionBy("segmento"))
    return g.withColumn("pct", F.round(100.0 * F.col("customers") / tot, 4))


@query("agg31_score_by_delivery_status", ctes=("e_deliveries", "e_reviews"), sql="""
    WITH cs AS (SELECT customer_id, avg(score) AS cust_score FROM e_reviews GROUP BY 1),
    d AS (SELECT customer_id, CASE WHEN delivered_ts IS NULL THEN 'not_delivered'
                 WHEN delivered_ts <= estimated_ts THEN 'on_time' ELSE 'late' END AS delivery_status
          FROM e_deliveries)
    SELECT delivery_status, count(*) AS orders, round(avg(cust_score), 4) AS avg_score
    FROM d JOIN cs USING (customer_id) GROUP BY 1""")
def _(spark, sf):
    """Average review score of customers by delivery outcome of their orders.
    The per-customer score is aggregated before the join (no fan-out)."""
    t = Tables(spark, sf)
    cs = m.reviews(t).groupBy("customer_id").agg(F.avg("score").alias("cust_score"))
    d = m.deliveries(t).select(
        "customer_id", C.delivery_label("delivered_ts", "estimated_ts").alias("delivery_status"))
    return d.join(cs, "customer_id").groupBy("delivery_status").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg("cust_score"), 4).alias("avg_score"))


@query("agg31_worst_categories_late_rate", ctes=("fact", "e_deliveries"), sql="""
    SELECT f.category,
           round(avg(CASE WHEN d.delivered_ts > d.estimated_ts THEN 1.0 ELSE 0.0 END), 6) AS late_rate,
           count(*) AS items
    FROM fact f JOIN e_deliveries d ON d.order_id = f.order_id
    WHERE d.delivered_ts IS NOT NULL
    GROUP BY f.category ORDER BY late_rate DESC, f.category LIMIT 5""")
def _(spark, sf):
    """Five categories with the highest late-delivery rate (documented formula:
    late items / delivered items)."""
    t = Tables(spark, sf)
    d = m.deliveries(t).where(F.col("delivered_ts").isNotNull()).select(
        "order_id", "delivered_ts", "estimated_ts")
    j = m.fact_sales(t).select("order_id", "category").join(d, "order_id")
    late = F.when(F.col("delivered_ts") > F.col("estimated_ts"), 1.0).otherwise(0.0)
    return (j.groupBy("category").agg(F.round(F.avg(late), 6).alias("late_rate"),
                                      F.count(F.lit(1)).alias("items"))
            .orderBy(F.desc("late_rate"), "category").limit(5))


@query("agg31_delivery_days_by_score", ctes=("e_deliveries", "e_reviews"), sql=f"""
    WITH cs AS (SELECT customer_id, arg_max(score, (review_ts, review_id)) AS review_score
                FROM e_reviews GROUP BY 1)
    SELECT cs.review_score, count(*) AS orders, round(avg({_DAYS_SQL}), 4) AS avg_delivery_days
    FROM e_deliveries d JOIN cs USING (customer_id)
    WHERE d.delivered_ts IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    """Average delivery time per review score. A review belongs to a
    customer here, so each customer is reduced to one score (the latest
    review, ``max_by``) before meeting the orders: one partner per order."""
    t = Tables(spark, sf)
    cs = m.reviews(t).groupBy("customer_id").agg(
        F.max_by("score", F.struct("review_ts", "review_id")).alias("review_score"))
    d = m.deliveries(t).where(F.col("delivered_ts").isNotNull()).join(cs, "customer_id")
    return d.groupBy("review_score").agg(F.count(F.lit(1)).alias("orders"),
                                         F.round(F.avg(_days()), 4).alias("avg_delivery_days"))


@query("agg31_worst_categories_composite", ctes=("fact", "e_deliveries", "e_reviews"), sql="""
    WITH cs AS (SELECT customer_id, avg(score) AS cust_score FROM e_reviews GROUP BY 1),
    c AS (SELECT f.category, avg(cs.cust_score) AS avg_score,
                 avg(CASE WHEN d.delivered_ts > d.estimated_ts THEN 1.0 ELSE 0.0 END) AS late_rate
          FROM fact f JOIN e_deliveries d ON d.order_id = f.order_id
          JOIN cs ON cs.customer_id = f.customer_id
          WHERE d.delivered_ts IS NOT NULL GROUP BY 1),
    r AS (SELECT category, avg_score, late_rate,
                 rank() OVER (ORDER BY avg_score) + rank() OVER (ORDER BY late_rate DESC) AS badness
          FROM c)
    SELECT category, round(avg_score, 4) AS avg_score, round(late_rate, 6) AS late_rate,
           CAST(badness AS INTEGER) AS badness
    FROM r ORDER BY badness, category LIMIT 5""")
def _(spark, sf):
    """Five worst categories by a documented composite: rank by low average
    review score + rank by high late-delivery rate (lower sum = worse). The
    per-customer score and the per-order delivery are aggregated before the
    joins; the ranking runs over the per-category aggregate."""
    from pyspark.sql import Window
    t = Tables(spark, sf)
    cs = m.reviews(t).groupBy("customer_id").agg(F.avg("score").alias("cust_score"))
    d = m.deliveries(t).where(F.col("delivered_ts").isNotNull()).select(
        "order_id", "delivered_ts", "estimated_ts")
    j = (m.fact_sales(t).select("order_id", "customer_id", "category").join(d, "order_id")
         .join(cs, "customer_id"))
    late = F.when(F.col("delivered_ts") > F.col("estimated_ts"), 1.0).otherwise(0.0)
    c = j.groupBy("category").agg(F.avg("cust_score").alias("avg_score"), F.avg(late).alias("late_rate"))
    badness = F.rank().over(Window.orderBy("avg_score")) + F.rank().over(Window.orderBy(F.desc("late_rate")))
    return (c.select("category", F.round("avg_score", 4).alias("avg_score"),
                     F.round("late_rate", 6).alias("late_rate"), badness.cast("int").alias("badness"))
            .orderBy("badness", "category").limit(5))


@query("agg32_review_labels_by_state", ctes=("e_reviews", "e_customers"), sql="""
    SELECT c.state, CASE WHEN score BETWEEN 1 AND 2 THEN 'mala' WHEN score = 3 THEN 'neutral'
                         WHEN score BETWEEN 4 AND 5 THEN 'buena' END AS review_label,
           count(*) AS reviews
    FROM e_reviews r JOIN e_customers c ON c.customer_id = r.customer_id GROUP BY 1, 2""")
def _(spark, sf):
    t = Tables(spark, sf)
    r = m.reviews(t).join(m.customers(t), "customer_id")
    return r.groupBy("state", C.review_label("score").alias("review_label")).agg(
        F.count(F.lit(1)).alias("reviews"))


@query("agg33_orders_per_payment_label", ctes=("e_orders", "e_payments"), sql="""
    SELECT coalesce(p.payment_type, 'UNKNOWN') AS payment_label, count(*) AS orders
    FROM e_orders o
    LEFT JOIN (SELECT order_id, max(payment_type) AS payment_type FROM e_payments GROUP BY 1) p
      ON p.order_id = o.order_id
    GROUP BY 1""")
def _(spark, sf):
    t = Tables(spark, sf)
    p = m.payments(t).groupBy("order_id").agg(F.max("payment_type").alias("payment_type"))
    o = m.orders(t).select("order_id").join(p, "order_id", "left")
    return o.groupBy(C.unknown_if_null("payment_type").alias("payment_label")).agg(
        F.count(F.lit(1)).alias("orders"))


def daily_counts(df, time_col: str, region_col: str | None = None):
    """Rows per (day, region); without a region column the region is 'ALL'."""
    region = F.col(region_col) if region_col else F.lit(None).cast("string")
    return df.groupBy(F.to_date(time_col).alias("day"),
                      F.coalesce(region, F.lit("ALL")).alias("region")).agg(
        F.count(F.lit(1)).alias("n"))


@query("agg36_daily_count_by_region", sql="""
    SELECT CAST(ts AS DATE) AS day, coalesce(event_type, 'ALL') AS region, count(*) AS n
    FROM events GROUP BY 1, 2""")
def _(spark, sf):
    return daily_counts(Tables(spark, sf).events, "ts", "event_type")


@query("agg36_daily_count_all", sql="""
    SELECT CAST(ts AS DATE) AS day, 'ALL' AS region, count(*) AS n FROM events GROUP BY 1""")
def _(spark, sf):
    return daily_counts(Tables(spark, sf).events, "ts")


@query("agg37_sales_per_day", ctes=("e_retail",), sql=f"""
    SELECT CAST(ts AS DATE) AS day, CAST(sum({_INGRESO}) AS DECIMAL(38,2)) AS ventas
    FROM e_retail GROUP BY 1""")
def _(spark, sf):
    s = _sales(Tables(spark, sf))
    return s.groupBy(F.to_date("ts").alias("day")).agg(m.msum("ingreso").alias("ventas"))


@query("agg37_quantity_distribution", ctes=("e_retail",), sql="""
    SELECT categoria, cantidad, count(*) AS n FROM e_retail GROUP BY 1, 2""")
def _(spark, sf):
    """Quantity distribution per category as counts by value (exact)."""
    return m.retail(Tables(spark, sf)).groupBy("categoria", "cantidad").agg(
        F.count(F.lit(1)).alias("n"))


@query("agg38_delivery_compliance_by_zone", ctes=("e_deliveries", "e_customers"), sql=f"""
    SELECT c.state AS zona,
           round(avg(CASE WHEN delivered_ts <= estimated_ts THEN 1.0 ELSE 0.0 END), 6) AS on_time_rate,
           round(avg({_DAYS_SQL}), 4) AS avg_days
    FROM e_deliveries d JOIN e_customers c ON c.customer_id = d.customer_id
    WHERE delivered_ts IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    t = Tables(spark, sf)
    d = (m.deliveries(t).where(F.col("delivered_ts").isNotNull())
         .join(m.customers(t).select("customer_id", F.col("state").alias("zona")), "customer_id"))
    ok = F.when(F.col("delivered_ts") <= F.col("estimated_ts"), 1.0).otherwise(0.0)
    return d.groupBy("zona").agg(F.round(F.avg(ok), 6).alias("on_time_rate"),
                                 F.round(F.avg(_days()), 4).alias("avg_days"))


@query("agg39_time_hierarchy_rollup", ctes=("e_orders",), sql="""
    SELECT CAST(year(purchase_date) AS INTEGER) AS year, CAST(quarter(purchase_date) AS INTEGER) AS quarter,
           CAST(month(purchase_date) AS INTEGER) AS month, CAST(day(purchase_date) AS INTEGER) AS day,
           count(*) AS orders, CAST(sum(order_total) AS DECIMAL(38,2)) AS total
    FROM e_orders
    GROUP BY ROLLUP (year(purchase_date), quarter(purchase_date), month(purchase_date), day(purchase_date))""")
def _(spark, sf):
    """Pre-computed time hierarchy year → quarter → month → day."""
    o = m.orders(Tables(spark, sf)).select(
        F.year("purchase_date").alias("year"), F.quarter("purchase_date").alias("quarter"),
        F.month("purchase_date").alias("month"), F.dayofmonth("purchase_date").alias("day"),
        "order_total")
    return olap.rollup_levels(o, ["year", "quarter", "month", "day"],
                              {"orders": F.count(F.lit(1)), "total": m.msum("order_total")})


@query("agg39_geography_rollup", ctes=("e_customers",), sql="""
    SELECT r.r_name AS region, c.state, count(*) AS customers
    FROM e_customers c JOIN nation n ON n.n_name = c.state JOIN region r ON r.r_regionkey = n.n_regionkey
    GROUP BY ROLLUP (r.r_name, c.state)""")
def _(spark, sf):
    t = Tables(spark, sf)
    geo = (m.nation_b(t).join(m.region_b(t), F.col("n_regionkey") == F.col("r_regionkey"))
           .select(F.col("n_name").alias("state"), F.col("r_name").alias("region")))
    c = m.customers(t).join(F.broadcast(geo), "state")
    return olap.rollup_levels(c, ["region", "state"], {"customers": F.count(F.lit(1))})


@query("agg40_rows_per_partition", ctes=("e_orders",), sql="""
    SELECT purchase_date AS dt, count(*) AS n FROM e_orders GROUP BY 1""")
def _(spark, sf):
    """Row count per partition value ``dt``."""
    return m.orders(Tables(spark, sf)).groupBy(F.col("purchase_date").alias("dt")).count() \
        .withColumnRenamed("count", "n")


@query("agg41_reduce_to_scalar", sql="""
    SELECT CAST(sum(o_orderkey + 1) AS BIGINT) AS total FROM orders WHERE o_orderkey % 3 = 0""")
def _(spark, sf):
    """``filter → map → reduce(+)`` as one global aggregate (partial sums per task)."""
    o = Tables(spark, sf).orders
    return o.where(F.col("o_orderkey") % 3 == 0).agg(
        F.sum(F.col("o_orderkey") + 1).cast("bigint").alias("total"))


@query("agg42_reduce_by_key", ctes=("e_items",), sql="""
    SELECT seller_id, CAST(sum(quantity) AS DOUBLE) AS quantity, count(*) AS n FROM e_items GROUP BY 1""")
def _(spark, sf):
    """reduceByKey ≡ groupBy().agg(sum): the plan shows a partial
    HashAggregate before the exchange (map-side combine). The groupByKey form
    (collect every value of a key, then sum) is deliberately not offered: it
    ships whole groups to one task."""
    i = m.items(Tables(spark, sf))
    return i.groupBy("seller_id").agg(F.sum("quantity").alias("quantity"),
                                      F.count(F.lit(1)).alias("n"))


@query("agg43_quantity_per_product_job", ctes=("e_retail",), sql="""
    SELECT producto_id, CAST(sum(CAST(cantidad AS BIGINT)) AS BIGINT) AS total_cantidad
    FROM e_retail GROUP BY 1""")
def _(spark, sf):
    """The deployment lab's job: quantity per ``producto_id`` (long sum)."""
    r = m.retail(Tables(spark, sf))
    return r.groupBy("producto_id").agg(
        F.sum(F.col("cantidad").cast("long")).alias("total_cantidad"))


@query("agg44_customer_features", ctes=("e_orders", "e_deliveries", "fact"), sql=f"""
    WITH o AS (SELECT customer_id, count(*) AS n_orders, CAST(sum(order_total) AS DECIMAL(38,2)) AS spend,
                      max(purchase_date) AS last_purchase FROM e_orders GROUP BY 1),
    d AS (SELECT customer_id, round(avg({_DAYS_SQL}), 4) AS avg_delivery_days,
                 count(*) FILTER (WHERE delivered_ts > estimated_ts) AS late_orders
          FROM e_deliveries WHERE delivered_ts IS NOT NULL GROUP BY 1),
    p AS (SELECT customer_id, count(DISTINCT category) AS n_categories FROM fact GROUP BY 1)
    SELECT o.customer_id, o.n_orders, o.spend, o.last_purchase, d.avg_delivery_days,
           coalesce(d.late_orders, 0) AS late_orders, coalesce(p.n_categories, 0) AS n_categories
    FROM o LEFT JOIN d USING (customer_id) LEFT JOIN p USING (customer_id)""")
def _(spark, sf):
    """Per-customer feature table (use, spend, delay history). Each feature
    group is aggregated to customer grain first; the joins are one-to-one."""
    t = Tables(spark, sf)
    o = m.orders(t).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_orders"), m.msum("order_total").alias("spend"),
        F.max("purchase_date").alias("last_purchase"))
    d = (m.deliveries(t).where(F.col("delivered_ts").isNotNull()).groupBy("customer_id").agg(
        F.round(F.avg(_days()), 4).alias("avg_delivery_days"),
        F.count_if(F.col("delivered_ts") > F.col("estimated_ts")).alias("late_orders")))
    p = m.fact_sales(t).groupBy("customer_id").agg(
        F.countDistinct("category").alias("n_categories"))
    return (o.join(d, "customer_id", "left").join(p, "customer_id", "left")
            .fillna(0, subset=["late_orders", "n_categories"]))


@query("agg45_hourly_time_buckets", sql="""
    SELECT date_trunc('hour', ts) AS bucket, event_type AS region, count(*) AS n,
           round(sum(value), 4) AS demand
    FROM events GROUP BY 1, 2""")
def _(spark, sf):
    """Hourly time-bucket aggregate (the continuous aggregate's content; the
    incremental refresh is ``warehouse.refresh_partitions``)."""
    e = Tables(spark, sf).events
    return e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bucket"),
                     F.col("event_type").alias("region")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("demand"))


def _hourly(df):
    return df.groupBy("day", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bucket"),
                      F.col("event_type").alias("region")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("demand"))


@query("agg45_incremental_refresh", sql="""
    SELECT date_trunc('hour', ts) AS bucket, event_type AS region, count(*) AS n,
           round(sum(value), 4) AS demand, CAST(ts AS DATE) AS day
    FROM events GROUP BY 1, 2, 5""")
def _(spark, sf):
    """Continuous aggregate kept fresh incrementally: the hourly table is
    built from the first half of the month, then the days touched by the
    newly arrived events are recomputed and only those day partitions are
    replaced, in one step. The result equals a full rebuild."""
    from cuenca.operators.warehouse import refresh_partitions
    from cuenca.plans.sources import fresh
    from cuenca.sinks.manifest import read_table
    e = Tables(spark, sf).events.withColumn("day", F.to_date("ts"))
    path = fresh(spark, "agg45")
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    early = e.where(F.col("ts") < cut)
    refresh_partitions(early, _hourly, path, "day", early.select("day").distinct())
    arrived = e.where(F.col("ts") >= cut)
    refresh_partitions(e, _hourly, path, "day", arrived.select("day").distinct())
    return read_table(spark, path).select("bucket", "region", "n", "demand", "day")


@query("agg46_clickstream_counts", sql="""
    SELECT CAST(ts AS DATE) AS day, event_type AS channel,
           CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS campaign, count(*) AS events
    FROM events GROUP BY 1, 2, 3""")
def _(spark, sf):
    """Event counts by day, channel and campaign parsed from the JSON document."""
    e = Tables(spark, sf).events
    campaign = F.get_json_object("props", "$.k").cast("int") % 10
    return e.groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("channel"),
                     campaign.alias("campaign")).agg(F.count(F.lit(1)).alias("events"))


@query("agg47_day_documents", sql="""
    WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, value,
                      (row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1)
                          // 200 AS chunk
               FROM events)
    SELECT user_id, day, CAST(chunk AS INTEGER) AS chunk, count(*) AS n_readings,
           string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS readings,
           round(sum(value), 4) AS total_value
    FROM r GROUP BY 1, 2, 3""")
def _(spark, sf):
    """Day documents holding an array of readings (the bucket pattern): one
    document per (device, day, chunk) with at most 200 readings in time
    order, so a busy device never becomes one unbounded row."""
    from cuenca.operators import documents as D
    e = Tables(spark, sf).events.withColumn("day", F.to_date("ts"))
    docs = D.bucket_documents(e, ["user_id", "day"], ["ts", "event_id"], ["value"], "readings_arr",
                              200, F.date_trunc("hour", "ts"))
    return docs.select(
        "user_id", "day", "chunk", F.size("readings_arr").cast("bigint").alias("n_readings"),
        F.array_join(F.transform("readings_arr", lambda x: x["event_id"].cast("string")), ",")
        .alias("readings"),
        F.round(F.aggregate("readings_arr", F.lit(0.0), lambda acc, x: acc + x["value"]), 4)
        .alias("total_value"))


@query("agg48_high_value_summary", ctes=("e_orders",), sql=f"""
    SELECT count(*) AS orders, {AVG('order_total')} AS avg_ticket
    FROM e_orders WHERE order_total > 100000""")
def _(spark, sf):
    o = m.orders(Tables(spark, sf))
    return o.where(F.col("order_total") > 100000).agg(
        F.count(F.lit(1)).alias("orders"), _avg2("order_total").alias("avg_ticket"))
