"""Course entities expressed over the driver's TPC-H-like tables.

Each entity exists twice, side by side: as a Spark DataFrame builder (what the
queries run) and as a SQL common table expression (what the DuckDB oracle

Scale notes: ``region`` and ``nation`` have a fixed size (5 and 25 rows by the
TPC-H definition), so they are the only tables broadcast explicitly. Every
other side of a join grows with the data and is left to AQE, which broadcasts
from measured runtime sizes under ``autoBroadcastJoinThreshold`` and otherwise
keeps a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cuenca.sources.tables import Tables, table_bytes


def money(c) -> "F.Column":
    """Money is DECIMAL(12,2), never float (exact sums, engine-independent)."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(12,2)")


def msum(c) -> "F.Column":
    """Exact money total; DECIMAL(38,2) holds any total at 100 TB."""
    return F.sum(c).cast("decimal(38,2)")


def avg_money(c: str, denominator: str | None = None) -> "F.Column":
    """Average of a money column rounded to cents, half cents away from zero,
    computed in exact cents: sign · ((2·|Σcents| + n) div 2n) / 100 on
    DECIMAL(38), which no total overflows. Double averages round differently
    in different engines at exact half cents; this does not.
    ``denominator`` replaces count(c) (e.g. ``count(DISTINCT order_id)``)."""
    n = f"CAST({denominator or f'count({c})'} AS DECIMAL(20,0))"
    cents = f"CAST(sum({c}) * 100 AS DECIMAL(36,0))"
    return F.expr(f"CAST(sign({cents}) AS INT) * CAST((abs({cents}) * 2 + {n}) div ({n} * 2) AS DOUBLE) / 100")


def avg_money_sql(c: str, denominator: str | None = None) -> str:
    """Another road to the same figure: whole cents and their remainder."""
    n = denominator or f"count({c})"
    cents = f"CAST(sum({c}) * 100 AS HUGEINT)"
    up = f"CASE WHEN 2 * (abs({cents}) % {n}) >= {n} THEN 1 ELSE 0 END"
    return f"CASE WHEN sum({c}) < 0 THEN -1 ELSE 1 END * CAST(abs({cents}) // {n} + {up} AS DOUBLE) / 100"


def nation_b(t: Tables) -> DataFrame:
    """Nation table, broadcast: 25 rows by definition."""
    return F.broadcast(t.nation)


def region_b(t: Tables) -> DataFrame:
    """Region table, broadcast: 5 rows by definition."""
    return F.broadcast(t.region)


def orders(t: Tables) -> DataFrame:
    """olist_orders: one row per order."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("purchase_ts"),
        F.to_date("o_orderdate").alias("purchase_date"),
        F.col("o_orderpriority").alias("payment_type"),
        money("o_totalprice").alias("order_total"),
    )


def _payment_value():
    """What is paid for a line: its price less the discount."""
    return money(F.round(money("l_extendedprice") * (1 - money("l_discount")), 2)).alias("payment_value")


def items(t: Tables, *more: str) -> DataFrame:
    """olist_order_items: one row per order line; ``more`` names columns that the
    line has in another role (``payment_value``)."""
    other = {"payment_value": _payment_value()}
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("price"),
        money(F.round(money("l_extendedprice") * money("l_tax"), 2)).alias("freight"),
        F.col("l_shipdate").alias("ship_ts"),
        *[other[c] for c in more],
    )


def customers(t: Tables) -> DataFrame:
    """olist_customers with the state taken from the nation name."""
    return (t.customer.join(nation_b(t), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.col("n_name").alias("state"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("c_acctbal").alias("acctbal")))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("retail_price"),
    )


def sellers(t: Tables) -> DataFrame:
    return (t.supplier.join(nation_b(t), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("seller_id"),
                    F.col("s_name").alias("seller_name"),
                    F.col("n_name").alias("seller_state")))


def payments(t: Tables) -> DataFrame:
    """olist_order_payments: several per order; the type is the order's priority."""
    o = t.orders.select("o_orderkey", "o_orderpriority")
    return (t.lineitem.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("payment_sequential"),
                    F.col("o_orderpriority").alias("payment_type"),
                    _payment_value()))


def reviews(t: Tables) -> DataFrame:
    """olist_order_reviews: one event is one review by ``user_id``.

    score = k % 5 + 1 with k from the JSON ``props``.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.col("event_id").alias("review_id"),
        F.col("user_id").alias("customer_id"),
        (k % 5 + 1).alias("score"),
        F.col("ts").alias("review_ts"),
        F.col("event_type").alias("review_kind"),
    )


def fact_sales(t: Tables) -> DataFrame:
    """JOI02 ``fact_olist_sales``: order-item grain star join.

    Join order chosen for shuffle volume: customers (⋈ broadcast nation) are
    attached to orders first, an order-grain join that is ~4x smaller than
    the item grain; then the order-item table meets that on the order key
    (the one large-large join, sort-merge unless AQE sees a small side);
    products come last. The item-grain rows are shuffled twice (order key,
    product key) instead of three times.
    """
    oc = orders(t).join(customers(t), "customer_id")
    return (items(t)
            .join(oc, "order_id")
            .join(products(t), "product_id")
            .select("order_id", "item_id", "customer_id", "product_id", "seller_id",
                    "status", "purchase_ts", "purchase_date", "payment_type",
                    "state", "segment", "category", "brand",
                    "quantity", "price", "freight",
                    (F.col("price") + F.col("freight")).alias("revenue")))


#: bytes of the line table's files for each partition of a grouping by order
ORDER_BYTES = 8 << 20


def by_order(t: Tables, lines: DataFrame) -> DataFrame:
    """``lines`` dealt by order over partitions whose number follows the line
    table's size. A task of a grouping finer than the order (distinct orders by
    something) then holds a bounded number of groups, whatever the input; with
    a fixed number of partitions its hash maps grow with the table."""
    n = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-table_bytes(t.spark, t.sf_dir, "lineitem") // ORDER_BYTES))
    return lines.repartition(n, "order_id")


def deliveries(t: Tables) -> DataFrame:
    """Order delivery facts: delivered = last ship time of a non-P order,
    estimated = purchase + 60 days. Lines are aggregated per order before the
    join (aggregate-then-join: the join is one-to-one, no fan-out)."""
    last_ship = t.lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.max("l_shipdate").alias("last_ship_ts"))
    return (orders(t).join(last_ship, "order_id", "left")
            .select("order_id", "customer_id", "status", "purchase_ts",
                    (F.col("purchase_ts") + F.expr("INTERVAL 60 DAYS")).alias("estimated_ts"),
                    F.when(F.col("status") != "P", F.col("last_ship_ts")).alias("delivered_ts")))


def retail(t: Tables) -> DataFrame:
    """transacciones_retail: one sale line per row (store, product, category,
    quantity, unit price, payment method). Stores are suppliers, the unit
    price is the part's retail price, the method is the line's return flag."""
    p = t.part.select("p_partkey", "p_type", "p_retailprice")
    return (t.lineitem.join(p, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("transaccion_id"),
                    F.col("l_shipdate").alias("ts"),
                    F.col("l_suppkey").alias("tienda_id"),
                    F.col("l_partkey").alias("producto_id"),
                    F.col("p_type").alias("categoria"),
                    F.col("l_quantity").cast("int").alias("cantidad"),
                    money("p_retailprice").alias("precio_unitario"),
                    F.col("l_returnflag").alias("metodo_pago")))


# ---------------------------------------------------------------------------
# SQL twins of the entities above, for the DuckDB oracle.
# ---------------------------------------------------------------------------

CTE = {
    "e_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
               o_orderdate AS purchase_ts, CAST(o_orderdate AS DATE) AS purchase_date,
               o_orderpriority AS payment_type,
               CAST(o_totalprice AS DECIMAL(12,2)) AS order_total
        FROM orders""",
    "e_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_quantity AS quantity,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(12,2)), 2)
                    AS DECIMAL(12,2)) AS freight,
               l_shipdate AS ship_ts
        FROM lineitem""",
    "e_customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS state,
               c_mktsegment AS segment, c_acctbal AS acctbal
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "e_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               p_brand AS brand, p_size AS size, p_retailprice AS retail_price
        FROM part""",
    "e_sellers": """
        SELECT s_suppkey AS seller_id, s_name AS seller_name, n_name AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "e_payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
               o_orderpriority AS payment_type,
               CAST(round(CAST(l_extendedprice AS DECIMAL(12,2))
                          * (1 - CAST(l_discount AS DECIMAL(12,2))), 2) AS DECIMAL(12,2))
                    AS payment_value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "e_reviews": """
        SELECT event_id AS review_id, user_id AS customer_id,
               CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 + 1 AS score,
               ts AS review_ts, event_type AS review_kind
        FROM events""",
    "e_retail": """
        SELECT l_orderkey AS transaccion_id, l_shipdate AS ts, l_suppkey AS tienda_id,
               l_partkey AS producto_id, p_type AS categoria,
               CAST(l_quantity AS INTEGER) AS cantidad,
               CAST(p_retailprice AS DECIMAL(12,2)) AS precio_unitario,
               l_returnflag AS metodo_pago
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "e_deliveries": """
        SELECT o.order_id, o.customer_id, o.status, o.purchase_ts,
               o.purchase_ts + INTERVAL 60 DAY AS estimated_ts,
               CASE WHEN o.status <> 'P' THEN s.last_ship_ts END AS delivered_ts
        FROM e_orders o LEFT JOIN (SELECT l_orderkey AS order_id, max(l_shipdate) AS last_ship_ts
                                   FROM lineitem GROUP BY 1) s ON s.order_id = o.order_id""",
    "fact": """
        SELECT i.order_id, i.item_id, o.customer_id, i.product_id, i.seller_id,
               o.status, o.purchase_ts, o.purchase_date, o.payment_type,
               c.state, c.segment, p.category, p.brand,
               i.quantity, i.price, i.freight, i.price + i.freight AS revenue
        FROM e_items i JOIN e_orders o ON i.order_id = o.order_id
             JOIN e_products p ON i.product_id = p.product_id
             JOIN e_customers c ON o.customer_id = c.customer_id""",
}

# Which CTEs each CTE needs (emitted first).
_DEPS = {"fact": ["e_items", "e_orders", "e_products", "e_customers"],
         "e_deliveries": ["e_orders"]}


def with_ctes(names, body: str) -> str:
    """Prefix ``body`` with the named entity CTEs (and their dependencies)."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return body
    body = body.strip()
    parts = ",\n".join(f"{n} AS ({CTE[n]})" for n in order)
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {parts},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
