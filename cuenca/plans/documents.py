"""Nested documents (Mongo-style orders with embedded items, shipping
address and status history) and the pipelines over them (SURVEY JOI05-06,
PRJ07-08, FUN08-10, AGG34-35, WIN15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.functions import columns as C
from cuenca.operators import documents as D
from cuenca.plans import model as m
from cuenca.plans.filters import _test_user
from cuenca.plans.registry import query
from cuenca.sources.tables import Tables

# Fixed mapping from the order priority to the sales channel; '5-LOW' orders
# have no channel field (the course assumes 'online' when it is missing).
CHANNELS = {"1-URGENT": "app", "2-HIGH": "store", "3-MEDIUM": "online", "4-NOT SPECIFIED": "phone"}


def _channel(col):
    expr = None
    for k, v in CHANNELS.items():
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr


_CHANNEL_SQL = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'app' WHEN '2-HIGH' THEN 'store' "
                "WHEN '3-MEDIUM' THEN 'online' WHEN '4-NOT SPECIFIED' THEN 'phone' END")


def order_documents(t: Tables):
    """orders collection: one document per order with embedded ``items``
    (≤ 7 lines per order), ``shipping_address`` struct, optional
    ``channel`` and a ``status_history`` array."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item_id"),
        F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("int").alias("qty"),
        m.money("l_extendedprice").alias("amount"), F.col("l_shipdate"))
    ship = lines.groupBy("order_id").agg(F.min("l_shipdate").alias("first_ship"),
                                         F.max("l_shipdate").alias("last_ship"))
    geo = (m.nation_b(t).join(m.region_b(t), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("country")))
    cust = t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), "city", "country")
    o = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"),
                        m.money("o_totalprice").alias("total_amount"),
                        _channel(F.col("o_orderpriority")).alias("channel"))
    docs = D.embed_children(o, lines, "order_id", ["item_id", "sku", "qty", "amount"], "items",
                            sort_first="item_id")
    history = F.filter(F.array(
        F.struct(F.lit("created").alias("status"), F.col("created_at").alias("changed_at")),
        F.struct(F.lit("shipped").alias("status"), F.col("first_ship").alias("changed_at")),
        F.struct(F.lit("delivered").alias("status"),
                 F.when(F.col("status") == "F", F.col("last_ship")).alias("changed_at"))),
        lambda h: h["changed_at"].isNotNull())
    return (docs.join(ship, "order_id", "left").join(cust, "customer_id", "left")
            .select("order_id", "customer_id", "status", "created_at", "total_amount", "channel",
                    "items",
                    F.struct("city", "country").alias("shipping_address"),
                    history.alias("status_history")))


@query("prj07_nested_field_projection", sql="""
    SELECT o_orderkey AS order_id, n_name AS city,
           (SELECT list(l_partkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice)
            FROM lineitem WHERE l_orderkey = o_orderkey)[1] AS first_sku
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def _(spark, sf):
    """Dotted paths into the document: ``shipping_address.city``, ``items[0].sku``."""
    d = order_documents(Tables(spark, sf))
    return d.select("order_id", F.col("shipping_address.city").alias("city"),
                    F.try_element_at("items", F.lit(1)).getField("sku").alias("first_sku"))


@query("prj08_embed_struct_on_match", sql="""
    SELECT o_orderkey AS order_id,
           CASE WHEN o_orderstatus = 'F' THEN n_name END AS ship_city,
           CASE WHEN o_orderstatus = 'F' THEN r_name END AS ship_country
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey""")
def _(spark, sf):
    """Embed the address struct only on matching documents (delivered orders)."""
    d = order_documents(Tables(spark, sf))
    addr = F.when(F.col("status") == "F", F.col("shipping_address"))
    return d.select("order_id", addr.alias("a")).select(
        "order_id", F.col("a.city").alias("ship_city"), F.col("a.country").alias("ship_country"))


@query("fun08_unwind_items", sql="""
    SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS sku,
           CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount
    FROM lineitem""")
def _(spark, sf):
    """``$unwind`` of the items array (``explode``: orders without items drop)."""
    d = order_documents(Tables(spark, sf)).select("order_id", "items")
    return D.unwind(d, "items", "it").select("order_id", "it.item_id", "it.sku", "it.qty", "it.amount")


@query("fun08_unwind_outer", sql="""
    SELECT o_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS sku
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def _(spark, sf):
    """``preserveNullAndEmptyArrays``: ``explode_outer`` keeps orders without items."""
    d = order_documents(Tables(spark, sf)).select("order_id", "items")
    return D.unwind(d, "items", "it", outer=True).select(
        "order_id", F.col("it.item_id").alias("item_id"), F.col("it.sku").alias("sku"))


@query("fun09_embed_and_aggregate_array", sql="""
    SELECT o_orderkey AS order_id, count(l_orderkey) AS n_items,
           CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(12,2))), 0) AS DECIMAL(38,2)) AS items_total
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def _(spark, sf):
    """Nested build (items embedded per order) + in-document aggregation with
    the higher-order ``aggregate`` (no re-shuffle)."""
    d = order_documents(Tables(spark, sf))
    total = F.aggregate("items", F.lit(0).cast("decimal(38,2)"),
                        lambda acc, x: (acc + x["amount"]).cast("decimal(38,2)"))
    return d.select("order_id", F.size("items").cast("bigint").alias("n_items"),
                    total.alias("items_total"))


def daily_sales(orders_docs, customers_docs):
    """daily_sales: (date, channel, city) → orders, revenue, average ticket.

    Inner lookup of the customer (orders without one drop), test users out
    with ``$ne: true`` semantics, missing channel → 'online'."""
    j = orders_docs.join(customers_docs, "customer_id")
    j = j.where(C.not_true("test_user"))
    return j.groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("date"),
                     F.coalesce("channel", F.lit("online")).alias("channel"),
                     F.col("shipping_address.city").alias("city")).agg(
        F.count(F.lit(1)).alias("orders"), m.msum("total_amount").alias("revenue"),
        m.avg_money("total_amount").alias("avg_ticket"))


@query("agg34_daily_sales", sql=f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, coalesce({_CHANNEL_SQL}, 'online') AS channel,
           n_name AS city, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue,
           {m.avg_money_sql('CAST(o_totalprice AS DECIMAL(12,2))')} AS avg_ticket
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE NOT ((CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_acctbal < 1000 THEN NULL ELSE FALSE END)
               IS NOT DISTINCT FROM TRUE)
    GROUP BY 1, 2, 3""")
def _(spark, sf):
    t = Tables(spark, sf)
    return daily_sales(order_documents(t), _test_user(t))


@query("agg35_sales_by_city", sql="""
    SELECT n_name AS city, CAST(sum(l_quantity) AS BIGINT) AS qty,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS amount,
           count(DISTINCT o_orderkey) AS n_orders
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def _(spark, sf):
    d = order_documents(Tables(spark, sf))
    total = lambda c, t: F.aggregate(F.transform("items", lambda i: i[c].cast(t)), F.lit(0).cast(t),
                                     lambda a, x: (a + x).cast(t))
    o = d.where(F.size("items") > 0).select(
        F.col("shipping_address.city").alias("city"), total("qty", "bigint").alias("q"),
        total("amount", "decimal(38,2)").alias("a"))      # an order's items stay together
    return o.groupBy("city").agg(F.sum("q").cast("bigint").alias("qty"), m.msum("a").alias("amount"),
                                 F.count(F.lit(1)).alias("n_orders"))


@query("agg35_sku_ranking", sql="""
    SELECT sku, qty, amount, row_number() OVER (ORDER BY amount DESC, sku) AS rnk FROM (
        SELECT l_partkey AS sku, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS qty,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS amount
        FROM lineitem GROUP BY 1)""")
def _(spark, sf):
    """All SKUs ranked by amount. The numbers come from a range-partitioned
    sort plus one offset per partition, so no task holds all SKUs."""
    from cuenca.operators.analytics import global_sequence
    d = order_documents(Tables(spark, sf)).select("items")
    u = D.unwind(d, "items", "it")
    g = (u.groupBy(F.col("it.sku").alias("sku"))
         .agg(F.sum("it.qty").cast("bigint").alias("qty"), m.msum("it.amount").alias("amount")))
    return global_sequence(g, [F.desc("amount"), F.col("sku")], "rnk", expensive_input=True)


@query("win15_status_cycle_times", sql="""
    WITH h AS (
        SELECT o_orderkey AS order_id, 'created' AS status, o_orderdate AS changed_at FROM orders
        UNION ALL
        SELECT l_orderkey, 'shipped', min(l_shipdate) FROM lineitem GROUP BY 1
        UNION ALL
        SELECT o_orderkey, 'delivered', max(l_shipdate) FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT order_id, status, changed_at,
           lead(changed_at) OVER (PARTITION BY order_id ORDER BY changed_at, status) AS next_change,
           date_diff('hour', changed_at, lead(changed_at) OVER (PARTITION BY order_id ORDER BY changed_at, status))
               AS hours_in_status
    FROM h WHERE order_id IN (SELECT o_orderkey FROM orders)""")
def _(spark, sf):
    """Time spent in each status from the embedded ``status_history``
    (explode + LEAD; each window is one order's ≤ 3 changes)."""
    d = order_documents(Tables(spark, sf))
    return D.status_durations(d, "order_id", "status_history")
