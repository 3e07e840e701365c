"""Subqueries, CTEs and recursion.

Scalar subqueries use ``DataFrame.scalar()``: Spark runs the one-row
subquery once and inlines its value (no join). Correlated ones use
``Column.outer()``; Catalyst decorrelates them into aggregate + join.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.operators.hierarchy import levels, rollup
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.session import materialize
from cuenca.sources.tables import Tables


def _orders_per_customer(t):
    return m.orders(t).groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"))


@query("sub01_above_average_order_count", ctes=("e_orders",), sql="""
    WITH c AS (SELECT customer_id, count(*) AS n_orders FROM e_orders GROUP BY 1)
    SELECT customer_id, n_orders FROM c WHERE n_orders > (SELECT avg(n_orders) FROM c)""")
def _(spark, sf):
    c = _orders_per_customer(Tables(spark, sf))
    return c.where(F.col("n_orders") > c.select(F.avg("n_orders")).scalar())


@query("sub02_category_above_global_average", ctes=("fact",), sql="""
    WITH c AS (SELECT category, sum(revenue) AS revenue FROM fact GROUP BY 1)
    SELECT category, CAST(revenue AS DECIMAL(38,2)) AS revenue FROM c
    WHERE revenue > (SELECT avg(revenue) FROM c)""")
def _(spark, sf):
    """Categories whose revenue is above the average category revenue
    (scalar subquery over a grouped derived table)."""
    c = m.fact_sales(Tables(spark, sf)).groupBy("category").agg(F.sum("revenue").alias("revenue"))
    return (c.where(F.col("revenue") > c.select(F.avg("revenue")).scalar())
            .select("category", F.col("revenue").cast("decimal(38,2)").alias("revenue")))


def _order_freight(t):
    """Per-order total and freight with the customer's state."""
    i = m.items(t).groupBy("order_id").agg(
        m.msum(F.col("price") + F.col("freight")).alias("order_total"),
        m.msum("freight").alias("freight"))
    return (m.orders(t).select("order_id", "customer_id").join(i, "order_id")
            .join(m.customers(t).select("customer_id", "state"), "customer_id"))


_OF_SQL = """of AS (SELECT o.order_id, o.customer_id, c.state,
                           CAST(sum(i.price + i.freight) AS DECIMAL(38,2)) AS order_total,
                           CAST(sum(i.freight) AS DECIMAL(38,2)) AS freight
                    FROM e_orders o JOIN e_items i ON i.order_id = o.order_id
                    JOIN e_customers c ON c.customer_id = o.customer_id
                    GROUP BY 1, 2, 3)"""


@query("sub03_correlated_state_average", ctes=("e_orders", "e_items", "e_customers"), sql=f"""
    WITH {_OF_SQL}
    SELECT o.order_id, o.state, o.order_total FROM of o
    WHERE o.order_total > (SELECT avg(o2.freight) FROM of o2 WHERE o2.state = o.state)""")
def _(spark, sf):
    """Orders whose total (price + freight) exceeds the average freight of
    their state (correlated scalar subquery; Catalyst rewrites it to
    aggregate + join)."""
    of = materialize(_order_freight(Tables(spark, sf))).alias("o")
    inner = of.alias("o2")
    avg_state = (inner.where(F.col("o2.state") == F.col("o.state").outer())
                 .select(F.avg("o2.freight")).scalar())
    return of.where(F.col("o.order_total") > avg_state).select(
        "o.order_id", "o.state", "o.order_total")


@query("sub04_freight_above_other_orders", ctes=("e_orders", "e_items", "e_customers"), sql=f"""
    WITH {_OF_SQL}
    SELECT o.order_id, o.customer_id, o.freight FROM of o
    WHERE o.freight > (SELECT max(o2.freight) FROM of o2
                       WHERE o2.customer_id = o.customer_id AND o2.order_id <> o.order_id)""")
def _(spark, sf):
    """Freight above the max freight of the same customer's *other* orders.

    The correlated ``<>`` form joins every pair of a customer's orders. The
    rewrite needs only the top-2 per customer: the max of the others is the
    runner-up for the unique top order and the top for everyone else.
    Three aggregates, no pairs."""
    of = materialize(_order_freight(Tables(spark, sf)).select("order_id", "customer_id", "freight"))
    top = of.groupBy("customer_id").agg(F.max("freight").alias("max1"))
    j = of.join(top, "customer_id")
    stats = j.groupBy("customer_id").agg(
        F.count_if(F.col("freight") == F.col("max1")).alias("n_max1"),
        F.max(F.when(F.col("freight") < F.col("max1"), F.col("freight"))).alias("max2"))
    j = j.join(stats, "customer_id")
    others = F.when((F.col("freight") == F.col("max1")) & (F.col("n_max1") == 1),
                    F.col("max2")).otherwise(F.col("max1"))
    return j.where(F.col("freight") > others).select("order_id", "customer_id", "freight")


@query("sub05_join_rewrite_of_correlated", ctes=("e_orders", "e_items", "e_customers"), sql=f"""
    WITH {_OF_SQL}
    SELECT o.order_id, o.state, o.order_total FROM of o
    WHERE o.order_total > (SELECT avg(o2.freight) FROM of o2 WHERE o2.state = o.state)""")
def _(spark, sf):
    """SUB03 written by hand as groupBy + join: same rows."""
    of = materialize(_order_freight(Tables(spark, sf)))
    avg_state = of.groupBy("state").agg(F.avg("freight").alias("avg_freight"))
    return (of.join(avg_state, "state").where(F.col("order_total") > F.col("avg_freight"))
            .select("order_id", "state", "order_total"))


def _order_totals(t):
    return m.fact_sales(t).groupBy("order_id", "customer_id").agg(
        F.sum("revenue").alias("order_total"))


@query("sub06_cte_avg_ticket_top10", ctes=("fact",), sql=f"""
    WITH order_totals AS (SELECT order_id, customer_id, sum(revenue) AS order_total FROM fact GROUP BY 1, 2)
    SELECT customer_id, {m.avg_money_sql('order_total')} AS avg_ticket
    FROM order_totals GROUP BY customer_id ORDER BY avg_ticket DESC, customer_id LIMIT 10""")
def _(spark, sf):
    ot = _order_totals(Tables(spark, sf))
    return (ot.groupBy("customer_id").agg(m.avg_money("order_total").alias("avg_ticket"))
            .orderBy(F.desc("avg_ticket"), "customer_id").limit(10))


@query("sub07_cte_chain", ctes=("fact", "e_reviews"), sql=f"""
    WITH order_totals AS (SELECT order_id, customer_id, sum(revenue) AS order_total FROM fact GROUP BY 1, 2),
    customer_totals AS (SELECT customer_id, count(*) AS orders,
                               {m.avg_money_sql('order_total')} AS avg_ticket
                        FROM order_totals GROUP BY 1),
    order_reviews_agg AS (SELECT customer_id, round(avg(score), 4) AS avg_score, count(*) AS reviews
                          FROM e_reviews GROUP BY 1)
    SELECT t.customer_id, t.orders, t.avg_ticket, r.avg_score, r.reviews
    FROM customer_totals t JOIN order_reviews_agg r USING (customer_id)""")
def _(spark, sf):
    """order_totals + order_reviews_agg, both aggregated to customer grain
    before the join."""
    t = Tables(spark, sf)
    ct = _order_totals(t).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"), m.avg_money("order_total").alias("avg_ticket"))
    ra = m.reviews(t).groupBy("customer_id").agg(F.round(F.avg("score"), 4).alias("avg_score"),
                                                 F.count(F.lit(1)).alias("reviews"))
    return ct.join(ra, "customer_id")


def _order_mart(t):
    f = m.fact_sales(t)
    return f.groupBy("order_id", "state", "purchase_date").agg(F.sum("revenue").alias("total"))


_MART_SQL = """order_mart AS (SELECT order_id, state, purchase_date, sum(revenue) AS total
                             FROM fact GROUP BY 1, 2, 3)"""


@query("sub08_daily_revenue_per_state", ctes=("fact",), sql=f"""
    WITH {_MART_SQL}
    SELECT purchase_date AS day, state, CAST(sum(total) AS DECIMAL(38,2)) AS revenue
    FROM order_mart GROUP BY 1, 2""")
def _(spark, sf):
    mart = _order_mart(Tables(spark, sf))
    return mart.groupBy(F.col("purchase_date").alias("day"), "state").agg(
        m.msum("total").alias("revenue"))


@query("sub08_top3_states", ctes=("fact",), sql=f"""
    WITH {_MART_SQL}
    SELECT state, CAST(sum(total) AS DECIMAL(38,2)) AS revenue FROM order_mart
    GROUP BY state ORDER BY revenue DESC, state LIMIT 3""")
def _(spark, sf):
    mart = _order_mart(Tables(spark, sf))
    return (mart.groupBy("state").agg(m.msum("total").alias("revenue"))
            .orderBy(F.desc("revenue"), "state").limit(3))


@query("sub09_nested_cte", ctes=("fact",), sql="""
    WITH by_cat AS (
        WITH base AS (SELECT category, state, revenue FROM fact WHERE status = 'F')
        SELECT category, state, sum(revenue) AS revenue FROM base GROUP BY 1, 2)
    SELECT category, count(*) AS states, CAST(max(revenue) AS DECIMAL(38,2)) AS best_state_revenue
    FROM by_cat GROUP BY category""")
def _(spark, sf):
    """A CTE defined inside a CTE, through Spark SQL over a DataFrame argument."""
    f = m.fact_sales(Tables(spark, sf))
    return spark.sql("""
        WITH by_cat AS (
            WITH base AS (SELECT category, state, revenue FROM {f} WHERE status = 'F')
            SELECT category, state, sum(revenue) AS revenue FROM base GROUP BY 1, 2)
        SELECT category, count(*) AS states,
               CAST(max(revenue) AS DECIMAL(38,2)) AS best_state_revenue
        FROM by_cat GROUP BY category""", f=f)


def calendar(df, date_col: str, step: str = "1 day", out: str = "day"):
    """All dates (or months) between min and max of ``date_col``.

    Replaces a recursive date CTE: one ``sequence`` over the one-row min/max
    aggregate; the explode yields one row per day (about 365 per year)."""
    b = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {step}"))).alias(out))


@query("sub10_daily_calendar", ctes=("e_orders",), sql="""
    SELECT CAST(d AS DATE) AS day FROM (
        SELECT unnest(generate_series(min(purchase_date), max(purchase_date), INTERVAL 1 DAY)) AS d
        FROM e_orders)""")
def _(spark, sf):
    return calendar(m.orders(Tables(spark, sf)), "purchase_date")


@query("sub11_cohort_grid_complete", ctes=("e_orders",), sql="""
    WITH o AS (SELECT customer_id, CAST(date_trunc('month', purchase_date) AS DATE) AS m FROM e_orders),
    f AS (SELECT customer_id, min(m) AS cohort_month FROM o GROUP BY 1),
    counts AS (SELECT f.cohort_month, CAST(date_diff('month', f.cohort_month, o.m) AS INTEGER) AS month_number,
                      count(DISTINCT o.customer_id) AS customers
               FROM o JOIN f USING (customer_id) GROUP BY 1, 2),
    cohorts AS (SELECT DISTINCT cohort_month FROM f),
    last AS (SELECT max(m) AS last_month FROM o),
    grid AS (SELECT c.cohort_month,
                    CAST(unnest(generate_series(0, date_diff('month', c.cohort_month, l.last_month))) AS INTEGER)
                        AS month_number
             FROM cohorts c, last l)
    SELECT g.cohort_month, g.month_number, coalesce(c.customers, 0) AS customers
    FROM grid g LEFT JOIN counts c USING (cohort_month, month_number)""")
def _(spark, sf):
    """Cohort grid completed with zeros: every cohort × every later month.

    The grid is generated per cohort with ``sequence`` (cohorts are months,
    so the grid is months²/2 rows), then left-joined to the counts."""
    o = m.orders(Tables(spark, sf)).select(
        "customer_id", F.trunc("purchase_date", "month").alias("m"))
    first = o.groupBy("customer_id").agg(F.min("m").alias("cohort_month"))
    rel = F.months_between("m", "cohort_month").cast("int")
    counts = o.join(first, "customer_id").groupBy("cohort_month", rel.alias("month_number")).agg(
        F.countDistinct("customer_id").alias("customers"))
    last = o.select(F.max("m")).scalar()
    grid = first.select("cohort_month").distinct().select(
        "cohort_month",
        F.explode(F.sequence(F.lit(0), F.months_between(last, "cohort_month").cast("int")))
        .alias("month_number"))
    return (grid.join(counts, ["cohort_month", "month_number"], "left")
            .fillna(0, subset=["customers"]))


def category_tree_nodes(t: Tables):
    """dim_product_category stand-in: regions are roots (id 1000+r), nations
    are their children (id n)."""
    roots = t.region.select((F.lit(1000) + F.col("r_regionkey")).alias("category_id"),
                            F.lit(None).cast("int").alias("parent_category_id"),
                            F.col("r_name").alias("category_name"))
    kids = t.nation.select(F.col("n_nationkey").alias("category_id"),
                           (F.lit(1000) + F.col("n_regionkey")).alias("parent_category_id"),
                           F.col("n_name").alias("category_name"))
    return roots.unionByName(kids)


_NODES_SQL = """nodes AS (
        SELECT 1000 + r_regionkey AS category_id, CAST(NULL AS INTEGER) AS parent_category_id,
               r_name AS category_name FROM region
        UNION ALL
        SELECT n_nationkey, 1000 + n_regionkey, n_name FROM nation)"""

_TREE_SQL = f"""WITH RECURSIVE {_NODES_SQL},
    tree AS (
        SELECT category_id, parent_category_id, category_name, 0 AS level, [category_id] AS path
        FROM nodes WHERE parent_category_id IS NULL
        UNION ALL
        SELECT c.category_id, c.parent_category_id, c.category_name, t.level + 1,
               list_append(t.path, c.category_id)
        FROM nodes c JOIN tree t ON c.parent_category_id = t.category_id)"""


def category_tree(t: Tables):
    """The nodes below a root with their level (nodes on a cycle or without a
    way to a root are in no tree, as in the recursive query)."""
    nodes = category_tree_nodes(t)
    found = levels(nodes, "category_id", "parent_category_id").where("status = 'ok'")
    return nodes.join(found.select("category_id", "level"), "category_id")


@query("sub12_recursive_tree_levels", sql=f"""{_TREE_SQL}
    SELECT category_id, parent_category_id, category_name, level FROM tree""")
def _(spark, sf):
    """Levels by pointer jumping instead of one step of recursion per level."""
    return category_tree(Tables(spark, sf)).select("category_id", "parent_category_id", "category_name", "level")


_LEAF_SQL = """leaf AS (SELECT n_nationkey AS category_id, sum(revenue) AS leaf_revenue
                       FROM fact JOIN nation ON n_name = fact.state GROUP BY 1)"""


def _leaf_sales(t: Tables):
    f = m.fact_sales(t)
    return (f.join(m.nation_b(t), F.col("state") == F.col("n_name"))
            .groupBy(F.col("n_nationkey").alias("category_id"))
            .agg(F.sum("revenue").alias("leaf_revenue")))


@query("sub13_recursive_rollup_own", ctes=("fact",), sql=f"""{_TREE_SQL},
    {_LEAF_SQL}
    SELECT t.category_name, t.level, CAST(sum(s.leaf_revenue) AS DECIMAL(38,2)) AS revenue_rollup
    FROM tree t LEFT JOIN leaf s ON t.category_id = s.category_id
    GROUP BY t.category_name, t.level""")
def _(spark, sf):
    """As written in the course: each node sums its *own* sales (roots: NULL)."""
    t = Tables(spark, sf)
    tree = category_tree(t)
    return (tree.join(_leaf_sales(t), "category_id", "left")
            .groupBy("category_name", "level")
            .agg(m.msum("leaf_revenue").alias("revenue_rollup")))


@query("sub13_recursive_rollup_descendants", ctes=("fact",), sql=f"""{_TREE_SQL},
    {_LEAF_SQL},
    anc AS (SELECT category_id, unnest(path) AS ancestor_id FROM tree)
    SELECT t.category_name, t.level, CAST(sum(s.leaf_revenue) AS DECIMAL(38,2)) AS revenue_rollup
    FROM tree t JOIN anc a ON a.ancestor_id = t.category_id
    LEFT JOIN leaf s ON s.category_id = a.category_id
    GROUP BY t.category_name, t.level""")
def _(spark, sf):
    """True roll-up: every node sums the sales of itself and all descendants,
    by doubling reach (``hierarchy.rollup``), not by (node, ancestor) pairs."""
    t = Tables(spark, sf)
    # the star join behind the sales runs once; the rounds read its few rows
    own = materialize(category_tree(t).join(_leaf_sales(t), "category_id", "left"))
    depth = own.agg(F.max("level")).first()[0] or 0
    return (rollup(own, "category_id", "parent_category_id", ["leaf_revenue"], depth)
            .select("category_name", "level", F.col("leaf_revenue").cast("decimal(38,2)").alias("revenue_rollup")))
