"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from cuenca.functions import columns as C
from cuenca.operators import analytics as A
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.session import materialize
from cuenca.sources.tables import Tables


@query("win01_count_over_partition", ctes=("e_items",), sql="""
    SELECT order_id, item_id, product_id, count(*) OVER (PARTITION BY order_id) AS items_in_order
    FROM e_items""")
def _(spark, sf):
    i = m.items(Tables(spark, sf)).select("order_id", "item_id", "product_id")
    return i.withColumn("items_in_order", F.count(F.lit(1)).over(Window.partitionBy("order_id")))


@query("win02_row_number_first_per_key", ctes=("e_reviews",), sql="""
    SELECT customer_id, review_id, review_ts, score FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY review_ts DESC, review_id DESC) AS rn
        FROM e_reviews) WHERE rn = 1""")
def _(spark, sf):
    """Most recent review per customer: ROW_NUMBER() = 1 (WindowGroupLimit)."""
    r = m.reviews(Tables(spark, sf))
    return A.first_per_key(r, "customer_id", [F.desc("review_ts"), F.desc("review_id")]).select(
        "customer_id", "review_id", "review_ts", "score")


@query("win03_share_of_order", ctes=("e_items",), sql="""
    SELECT order_id, item_id, product_id, price,
           sum(price) OVER (PARTITION BY order_id) AS order_total,
           round(CAST(price AS DOUBLE) / NULLIF(CAST(sum(price) OVER (PARTITION BY order_id) AS DOUBLE), 0), 6)
               AS share_of_order
    FROM e_items""")
def _(spark, sf):
    i = m.items(Tables(spark, sf)).select("order_id", "item_id", "product_id", "price")
    tot = F.sum("price").over(Window.partitionBy("order_id")).cast("decimal(38,2)")
    return (i.withColumn("order_total", tot)
            .withColumn("share_of_order", F.round(
                C.share(F.col("price").cast("double"), F.col("order_total").cast("double")), 6)))


def _product_revenue(t):
    f = m.fact_sales(t)
    return f.groupBy("category", "product_id").agg(m.msum("revenue").alias("revenue"))


_PR_SQL = """pr AS (SELECT category, product_id, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue
                FROM fact GROUP BY 1, 2)"""


@query("win04_top3_per_category", ctes=("fact",), sql=f"""
    WITH {_PR_SQL}
    SELECT * FROM (SELECT category, product_id, revenue,
                          CAST(rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS INTEGER) AS rnk
                   FROM pr) WHERE rnk <= 3""")
def _(spark, sf):
    """RANK over the grouped aggregate, top 3 per category."""
    pr = _product_revenue(Tables(spark, sf))
    return A.top_n_per_group(pr, "category", [F.desc("revenue")], 3, F.rank, "rnk")


@query("win05_first_purchase", ctes=("e_orders",), sql="""
    SELECT customer_id, order_id, purchase_ts FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY purchase_ts, order_id) AS rn
        FROM e_orders) WHERE rn = 1""")
def _(spark, sf):
    """First purchase per customer, ties broken by order id."""
    o = m.orders(Tables(spark, sf))
    return A.first_per_key(o, "customer_id", [F.col("purchase_ts"), F.col("order_id")]).select(
        "customer_id", "order_id", "purchase_ts")


@query("win06_rank_and_dense_rank", ctes=("fact",), sql=f"""
    WITH {_PR_SQL}
    SELECT category, product_id, revenue,
           CAST(rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS INTEGER) AS rnk,
           CAST(dense_rank() OVER (PARTITION BY category ORDER BY revenue DESC) AS INTEGER) AS dense_rnk
    FROM pr""")
def _(spark, sf):
    """RANK and DENSE_RANK of products inside their category. A category
    holds a sixth of all products, so the ranks come from prefix sums over
    ranges of the distinct values instead of one window per category."""
    pr = materialize(_product_revenue(Tables(spark, sf)))
    return A.rank_within(pr, "category", "revenue", "rnk", "dense_rnk")


def _monthly(t):
    f = m.fact_sales(t)
    return f.groupBy(F.trunc("purchase_date", "month").alias("month")).agg(
        m.msum("revenue").alias("revenue"))


_MONTHLY_SQL = """mr AS (SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS month,
                         CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue FROM fact GROUP BY 1)"""


@query("win07_running_and_moving_sum", ctes=("fact",), sql=f"""
    WITH {_MONTHLY_SQL}
    SELECT month, revenue,
           CAST(sum(revenue) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                AS DECIMAL(38,2)) AS running_total,
           CAST(sum(revenue) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
                AS DECIMAL(38,2)) AS moving_3m
    FROM mr""")
def _(spark, sf):
    """Monthly revenue with running total and 3-month moving sum. The window
    runs over the monthly aggregate (one row per month), not over the fact."""
    mr = _monthly(Tables(spark, sf))
    w = Window.orderBy("month")
    mr = mr.withColumn("running_total", F.sum("revenue").over(
        w.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(38,2)"))
    return A.moving_sum(mr, "month", "revenue", 3, "moving_3m").withColumn(
        "moving_3m", F.col("moving_3m").cast("decimal(38,2)"))


@query("win08_running_total_per_state", ctes=("fact",), sql="""
    WITH g AS (SELECT state, CAST(date_trunc('month', purchase_date) AS DATE) AS month,
                      sum(revenue) AS revenue FROM fact GROUP BY 1, 2)
    SELECT state, month, CAST(revenue AS DECIMAL(38,2)) AS revenue,
           CAST(sum(revenue) OVER (PARTITION BY state ORDER BY month
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2))
               AS running_total
    FROM g""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf))
    g = f.groupBy("state", F.trunc("purchase_date", "month").alias("month")).agg(
        F.sum("revenue").alias("revenue"))
    w = Window.partitionBy("state").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return g.select("state", "month", F.col("revenue").cast("decimal(38,2)").alias("revenue"),
                    F.sum("revenue").over(w).cast("decimal(38,2)").alias("running_total"))


def _gaps(t):
    """Days since the customer's previous purchase. LAG runs per (customer,
    month) with the previous month's last date as the carry, so a customer
    with a third of all orders is spread over its months."""
    o = m.orders(t).select("customer_id", "order_id", "purchase_date")
    g = A.previous_within(o, "customer_id", ["purchase_date", "order_id"], "purchase_date",
                          F.trunc("purchase_date", "month"), "prev_date")
    return g.withColumn("gap_days", F.datediff("purchase_date", "prev_date")).drop("prev_date")


@query("win09_gap_days_between_purchases", ctes=("e_orders",), sql="""
    WITH g AS (SELECT customer_id, order_id, purchase_date,
                      date_diff('day', lag(purchase_date) OVER (PARTITION BY customer_id
                                                                ORDER BY purchase_date, order_id),
                                purchase_date) AS gap_days
               FROM e_orders)
    SELECT customer_id, order_id, purchase_date, CAST(gap_days AS INTEGER) AS gap_days,
           CASE WHEN gap_days <= 30 THEN 'frecuente' WHEN gap_days <= 90 THEN 'ocasional'
                WHEN gap_days > 90 THEN 'raro' END AS frecuencia
    FROM g""")
def _(spark, sf):
    """LAG gap in days between a customer's purchases + CASE bucket (PRJ10)."""
    g = _gaps(Tables(spark, sf))
    return g.withColumn("frecuencia", C.purchase_gap_bucket("gap_days"))


@query("win10_month_over_month", ctes=("fact",), sql=f"""
    WITH {_MONTHLY_SQL}
    SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS prev_revenue,
           round((CAST(revenue AS DOUBLE) - lag(CAST(revenue AS DOUBLE)) OVER (ORDER BY month)) * 100.0
                 / NULLIF(lag(CAST(revenue AS DOUBLE)) OVER (ORDER BY month), 0), 4) AS pct_change
    FROM mr""")
def _(spark, sf):
    """Monthly revenue, previous month (LAG) and % change; the window runs
    over the monthly aggregate."""
    mr = _monthly(Tables(spark, sf))
    mr = mr.withColumn("prev_revenue", F.lag("revenue").over(Window.orderBy("month")))
    return A.pct_change(mr, "month", "revenue")


@query("win11_seller_ranking_per_year", ctes=("fact",), sql="""
    WITH s AS (SELECT CAST(year(purchase_date) AS INTEGER) AS year, seller_id, sum(revenue) AS revenue
               FROM fact GROUP BY 1, 2),
    r AS (SELECT year, seller_id, revenue,
                 rank() OVER (PARTITION BY year ORDER BY revenue DESC, seller_id) AS rnk,
                 CAST(revenue AS DOUBLE) / sum(CAST(revenue AS DOUBLE)) OVER (PARTITION BY year) AS share,
                 sum(revenue) OVER (PARTITION BY year ORDER BY revenue DESC, seller_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rev,
                 sum(revenue) OVER (PARTITION BY year) AS year_rev
          FROM s)
    SELECT year, seller_id, CAST(revenue AS DECIMAL(38,2)) AS revenue, CAST(rnk AS INTEGER) AS rnk,
           round(share, 6) AS share,
           round(CAST(cum_rev AS DOUBLE) / CAST(year_rev AS DOUBLE), 6) AS cum_share
    FROM r WHERE rnk <= 20""")
def _(spark, sf):
    """Seller rank per year with share and cumulative share, top 20.

    Only the top 20 per year are ranked in a window (partial WindowGroupLimit
    before the shuffle); the year totals are a separate aggregate. The
    running share of a top-20 row only involves rows ranked above it, so it
    is computed over the ≤ 20 kept rows."""
    f = m.fact_sales(Tables(spark, sf))
    s = f.groupBy(F.year("purchase_date").alias("year"), "seller_id").agg(
        F.sum("revenue").alias("revenue"))
    totals = s.groupBy("year").agg(F.sum("revenue").alias("year_rev"))
    order = [F.desc("revenue"), F.col("seller_id")]
    top = A.top_n_per_group(s, "year", order, 20, F.rank, "rnk").join(totals, "year")
    w = Window.partitionBy("year").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return top.select(
        "year", "seller_id", F.col("revenue").cast("decimal(38,2)").alias("revenue"), "rnk",
        F.round(F.col("revenue").cast("double") / F.col("year_rev").cast("double"), 6).alias("share"),
        F.round(F.sum("revenue").over(w).cast("double") / F.col("year_rev").cast("double"), 6)
        .alias("cum_share"))


@query("win12_cumulative_and_lag_per_key", sql="""
    WITH e AS (SELECT user_id, event_id, ts, CAST(value AS DECIMAL(12,2)) AS value FROM events)
    SELECT user_id, event_id, ts, value,
           CAST(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS cum,
           CAST(coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DECIMAL(38,2))
               AS prev_cum
    FROM e""")
def _(spark, sf):
    """Cumulative sum and LAG of the cumulative per key, skew-proof: per-day
    local windows plus per-day offsets (see ``analytics.running_sum``)."""
    e = Tables(spark, sf).events.select("user_id", "event_id", "ts",
                                        m.money("value").alias("value"))
    r = A.running_sum(e, "user_id", ["ts", "event_id"], "value", F.to_date("ts"),
                      out="cum", prev_out="prev_cum")
    return r.select("user_id", "event_id", "ts", "value",
                    F.col("cum").cast("decimal(38,2)").alias("cum"),
                    F.col("prev_cum").cast("decimal(38,2)").alias("prev_cum"))


@query("win13_latest_version_per_key", ctes=("e_orders",), sql="""
    SELECT customer_id, order_id, purchase_ts, status FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY purchase_ts DESC, order_id DESC) AS rn
        FROM e_orders) WHERE rn = 1""")
def _(spark, sf):
    o = m.orders(Tables(spark, sf))
    return A.latest_per_key(o, "customer_id", "purchase_ts", "order_id").select(
        "customer_id", "order_id", "purchase_ts", "status")


@query("win14_global_sequence_id", sql="""
    SELECT event_id, ts, CAST(row_number() OVER (ORDER BY ts, event_id) AS BIGINT) AS seq,
           'EV-' || lpad(CAST(row_number() OVER (ORDER BY ts, event_id) AS VARCHAR), 8, '0') AS ext_id
    FROM events""")
def _(spark, sf):
    """Global zero-padded sequence id without a single-partition window."""
    e = Tables(spark, sf).events.select("event_id", "ts")
    s = A.global_sequence(e, ["ts", "event_id"], "seq")
    return s.withColumn("ext_id", F.concat(F.lit("EV-"), C.zero_pad("seq", 8)))


@query("prj10_purchase_gap_bucket", ctes=("e_orders",), sql="""
    WITH g AS (SELECT date_diff('day', lag(purchase_date) OVER (PARTITION BY customer_id
                                                                ORDER BY purchase_date, order_id),
                                purchase_date) AS gap_days
               FROM e_orders)
    SELECT CASE WHEN gap_days <= 30 THEN 'frecuente' WHEN gap_days <= 90 THEN 'ocasional'
                WHEN gap_days > 90 THEN 'raro' END AS frecuencia, count(*) AS orders
    FROM g GROUP BY 1""")
def _(spark, sf):
    """CASE bucketing of the purchase gap (≤30 frecuente, 31-90 ocasional,
    >90 raro; a first purchase has no gap → NULL bucket)."""
    g = _gaps(Tables(spark, sf))
    return g.groupBy(C.purchase_gap_bucket("gap_days").alias("frecuencia")).agg(
        F.count(F.lit(1)).alias("orders"))
