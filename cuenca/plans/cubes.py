"""OLAP cube operations on the sales fact (SURVEY §2: JOI02, AGG09, the
cube operators and the multi-level groupings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.operators import olap
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.session import materialize
from cuenca.sources.tables import Tables

def rev():
    return {"total_revenue": m.msum("revenue")}


def month(c="purchase_date"):
    return F.trunc(c, "month")


@query("joi02_fact_sales_star", ctes=("fact",), sql="SELECT * FROM fact")
def _(spark, sf):
    """Four-table star join at order-item grain (fact_olist_sales)."""
    return m.fact_sales(Tables(spark, sf))


@query("agg09_distinct_orders_month_category", ctes=("fact",), sql="""
    SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS order_month, category,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue, count(DISTINCT order_id) AS num_orders
    FROM fact GROUP BY 1, 2""")
def _(spark, sf):
    """Monthly revenue and distinct orders per category (aggregation operation)."""
    f = m.fact_sales(Tables(spark, sf))
    return olap.roll_up(f, [month().alias("order_month"), "category"],
                        {"total_revenue": m.msum("revenue"),
                         "num_orders": F.countDistinct("order_id")})


@query("prj03_add_measure", ctes=("fact",), sql="""
    SELECT order_id, item_id, category, revenue,
           revenue * 0.7 AS estimated_cost, revenue - revenue * 0.7 AS estimated_profit
    FROM fact""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf)).select("order_id", "item_id", "category", "revenue")
    f = olap.add_measure(f, "estimated_cost", F.expr("revenue * 0.7"))
    return olap.add_measure(f, "estimated_profit", F.expr("revenue - revenue * 0.7"))


@query("flt07_dice", ctes=("fact",), sql="""
    SELECT order_id, item_id, state, category, revenue FROM fact
    WHERE purchase_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
      AND state IN ('NATION_1', 'NATION_7') AND category = 'PROMO' AND revenue > 100""")
def _(spark, sf):
    """Dice: date BETWEEN + IN list + equality + measure threshold."""
    f = m.fact_sales(Tables(spark, sf))
    return olap.dice(f,
                     F.col("purchase_date").between(F.lit("1997-01-01").cast("date"),
                                                    F.lit("1997-12-31").cast("date")),
                     F.col("state").isin("NATION_1", "NATION_7"),
                     F.col("category") == "PROMO",
                     F.col("revenue") > 100
                     ).select("order_id", "item_id", "state", "category", "revenue")


@query("set02_difference_cube", ctes=("fact",), sql="""
    SELECT order_id, customer_id, purchase_date, revenue FROM fact
    EXCEPT
    SELECT order_id, customer_id, purchase_date, revenue FROM fact WHERE status = 'F'""")
def _(spark, sf):
    """Orders not delivered: all-orders cube EXCEPT (distinct) delivered cube."""
    cols = ["order_id", "customer_id", "purchase_date", "revenue"]
    f = materialize(m.fact_sales(Tables(spark, sf)).select(*cols, "status"))   # the star join runs once
    return olap.difference(f.select(cols), f.where(F.col("status") == "F").select(cols))


@query("joi09_drill_across", ctes=("fact", "e_reviews", "e_customers"), sql="""
    WITH cube_sales AS (
        SELECT state, segment, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
        FROM fact GROUP BY 1, 2),
    cube_reviews AS (
        SELECT c.state, c.segment, round(avg(r.score), 4) AS avg_review_score,
               count(*) AS n_reviews
        FROM e_reviews r JOIN e_customers c ON c.customer_id = r.customer_id
        GROUP BY 1, 2)
    SELECT s.state, s.segment, s.total_revenue, r.avg_review_score, r.n_reviews
    FROM cube_sales s JOIN cube_reviews r ON s.state = r.state AND s.segment = r.segment""")
def _(spark, sf):
    """Drill-across: sales cube and reviews cube joined on the conformed
    customer dimensions (state, segment). Both cubes are aggregated before the
    join, so it is key-unique on each side."""
    t = Tables(spark, sf)
    sales = olap.roll_up(m.fact_sales(t), ["state", "segment"], rev())
    rv = m.reviews(t).join(m.customers(t), "customer_id")
    revs = olap.roll_up(rv, ["state", "segment"],
                        {"avg_review_score": F.round(F.avg("score"), 4),
                         "n_reviews": F.count(F.lit(1))})
    return olap.drill_across(sales, revs, ["state", "segment"])


@query("agg22_drill_down_year", ctes=("fact",), sql="""
    SELECT CAST(year(purchase_date) AS INTEGER) AS year, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact GROUP BY 1""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf))
    return olap.drill_down(f, [F.year("purchase_date").alias("year")], [], rev())[0]


@query("agg22_drill_down_year_month", ctes=("fact",), sql="""
    SELECT CAST(year(purchase_date) AS INTEGER) AS year,
           CAST(month(purchase_date) AS INTEGER) AS month,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact GROUP BY 1, 2""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf))
    return olap.drill_down(f, [F.year("purchase_date").alias("year")],
                           [F.month("purchase_date").alias("month")], rev())[1]


@query("prj04_drop_measure", ctes=("fact",), sql="""
    SELECT state, CAST(date_trunc('month', purchase_date) AS DATE) AS order_month,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact GROUP BY 1, 2""")
def _(spark, sf):
    """Cube with three measures, then drop two. Catalyst prunes the dropped
    sums out of the aggregate, so they cost nothing."""
    f = m.fact_sales(Tables(spark, sf))
    cube = olap.roll_up(f, ["state", month().alias("order_month")],
                        {"sum_price": F.sum("price"), "sum_freight": F.sum("freight"),
                         "total_revenue": m.msum("revenue")})
    return olap.drop_measure(cube, "sum_price", "sum_freight")


@query("agg13_conditional_pivot_status", ctes=("e_orders", "e_customers"), sql="""
    SELECT c.state,
           CAST(sum(CASE WHEN o.status = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS delivered_orders,
           CAST(sum(CASE WHEN o.status = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS shipped_orders,
           CAST(sum(CASE WHEN o.status = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS canceled_orders
    FROM e_orders o JOIN e_customers c ON c.customer_id = o.customer_id
    GROUP BY c.state""")
def _(spark, sf):
    """Manual pivot by order status with SUM(CASE …) (F=delivered, O=shipped, P=canceled)."""
    t = Tables(spark, sf)
    o = m.orders(t).join(m.customers(t), "customer_id")

    def cnt(s):
        return F.sum(F.when(F.col("status") == s, 1).otherwise(0)).cast("bigint")
    return o.groupBy("state").agg(cnt("F").alias("delivered_orders"),
                                  cnt("O").alias("shipped_orders"),
                                  cnt("P").alias("canceled_orders"))


@query("agg15_pivot_clause", ctes=("e_orders", "e_customers"), sql="""
    SELECT * FROM (
        SELECT c.state, o.status FROM e_orders o JOIN e_customers c ON c.customer_id = o.customer_id
    ) PIVOT (count(*) FOR status IN ('F' AS delivered, 'O' AS shipped, 'P' AS canceled))""")
def _(spark, sf):
    """PIVOT clause form: explicit value list (no distinct pre-pass)."""
    t = Tables(spark, sf)
    o = m.orders(t).join(m.customers(t), "customer_id")
    p = olap.pivot(o, ["state"], "status", ["F", "O", "P"], F.count(F.lit(1)), fill=None)
    return p.withColumnsRenamed({"F": "delivered", "O": "shipped", "P": "canceled"})


@query("prj02_rename_measure", ctes=("fact",), sql="""
    SELECT category AS category_name, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_sales
    FROM fact GROUP BY category""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf))
    cube = olap.roll_up(f, ["category"], {"total_revenue": m.msum("revenue")})
    return olap.rename(cube, {"category": "category_name", "total_revenue": "total_sales"})


@query("agg16_rollup_state_month", ctes=("fact",), sql="""
    SELECT state, CAST(date_trunc('month', purchase_date) AS DATE) AS order_month,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact GROUP BY ROLLUP (state, CAST(date_trunc('month', purchase_date) AS DATE))""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf)).withColumn("order_month", month())
    return olap.rollup_levels(f, ["state", "order_month"], rev())


@query("agg17_rollup_year_month_day", ctes=("fact",), sql="""
    SELECT CAST(year(purchase_date) AS INTEGER) AS year,
           CAST(month(purchase_date) AS INTEGER) AS month,
           CAST(day(purchase_date) AS INTEGER) AS day,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact
    GROUP BY ROLLUP (year(purchase_date), month(purchase_date), day(purchase_date))""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf)).select(
        F.year("purchase_date").alias("year"), F.month("purchase_date").alias("month"),
        F.dayofmonth("purchase_date").alias("day"), "revenue")
    return olap.rollup_levels(f, ["year", "month", "day"], rev())


def _in_year(y: int):
    """Half-open date range: unlike ``year(col) = y`` it reaches the scan."""
    d = F.col("purchase_date")
    return (d >= F.lit(f"{y}-01-01").cast("date")) & (d < F.lit(f"{y + 1}-01-01").cast("date"))


@query("flt08_slice_year", ctes=("fact",), sql="""
    SELECT category, state, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact WHERE year(purchase_date) = 1997 GROUP BY category, state""")
def _(spark, sf):
    """Slice: fix year = 1997 and drop the time dimension."""
    f = m.fact_sales(Tables(spark, sf))
    return olap.roll_up(olap.slice_(f, _in_year(1997)),
                        ["category", "state"], rev())


@query("srt01_top_categories", ctes=("fact",), sql="""
    SELECT category, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact GROUP BY category ORDER BY total_revenue DESC, category LIMIT 10""")
def _(spark, sf):
    """Top-k by an aggregate: TakeOrderedAndProject, no global sort."""
    f = m.fact_sales(Tables(spark, sf))
    return olap.sort_members(olap.roll_up(f, ["category"], rev()),
                             F.desc("total_revenue"), "category").limit(10)


@query("set01_union_cubes", ctes=("fact",), sql="""
    SELECT 1997 AS year, category, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact WHERE year(purchase_date) = 1997 GROUP BY category
    UNION ALL
    SELECT 1998 AS year, category, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue
    FROM fact WHERE year(purchase_date) = 1998 GROUP BY category""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf)).where(_in_year(1997) | _in_year(1998))
    years = materialize(olap.roll_up(f.withColumn("year", F.year("purchase_date")), ["year", "category"], rev()))

    def cube(y):
        return years.where(F.col("year") == y).select("year", "category", "total_revenue")
    return olap.union_cubes(cube(1997), cube(1998))
