"""Data-quality and integrity rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.operators import quality as Q
from cuenca.operators.quality import Rule
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.sources.tables import Tables


@query("dq01_required_columns", sql="""
    SELECT 'not_null_' || c AS rule, 'orders' AS entity, CAST(n AS BIGINT) AS violations FROM (
        SELECT 'order_id' AS c, count(*) FILTER (WHERE o_orderkey IS NULL) AS n FROM orders
        UNION ALL SELECT 'customer_id', count(*) FILTER (WHERE o_custkey IS NULL) FROM orders
        UNION ALL SELECT 'status', count(*) FILTER (WHERE o_orderstatus IS NULL OR trim(o_orderstatus) = '')
                  FROM orders)""")
def _(spark, sf):
    """Required columns null (or empty for text) — one pass for all columns."""
    o = Tables(spark, sf).orders.select(F.col("o_orderkey").alias("order_id"),
                                        F.col("o_custkey").alias("customer_id"),
                                        F.col("o_orderstatus").alias("status"))
    return Q.evaluate(o, "orders", [Rule("not_null_order_id", "not_null", ["order_id"]),
                                    Rule("not_null_customer_id", "not_null", ["customer_id"]),
                                    Rule("not_null_status", "not_null_or_empty", ["status"])])


@query("dq02_duplicate_keys", ctes=("e_payments",), sql="""
    SELECT 'unique_order_payment' AS rule, 'payments' AS entity, count(*) AS violations FROM (
        SELECT order_id, payment_sequential FROM e_payments
        WHERE order_id IS NOT NULL AND payment_sequential IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)""")
def _(spark, sf):
    """Number of key values occurring more than once (NULL keys ignored)."""
    p = m.payments(Tables(spark, sf))
    return Q.evaluate(p, "payments",
                      [Rule("unique_order_payment", "unique", ["order_id", "payment_sequential"])])


@query("dq03_amount_null_or_negative", sql="""
    SELECT 'amount_not_negative' AS rule, 'customers' AS entity,
           count(*) FILTER (WHERE c_acctbal IS NULL OR c_acctbal < 0) AS violations FROM customer""")
def _(spark, sf):
    c = Tables(spark, sf).customer
    return Q.evaluate(c, "customers", [Rule("amount_not_negative", "check",
                                            expr=F.col("c_acctbal").isNotNull() & (F.col("c_acctbal") >= 0))])


_ORDER_RULES_SQL = """
    SELECT 'orders' AS entity, count(*) AS row_count,
           CAST(count(*) FILTER (WHERE o_orderkey IS NULL) + count(*) FILTER (WHERE o_totalprice IS NULL OR o_totalprice < 0)
                + (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL
                                         GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS violations_total,
           CAST((count(*) FILTER (WHERE o_orderkey IS NULL) > 0)::INT
                + (count(*) FILTER (WHERE o_totalprice IS NULL OR o_totalprice < 0) > 0)::INT
                + ((SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL
                                          GROUP BY 1 HAVING count(*) > 1)) > 0)::INT AS BIGINT) AS rules_failed
    FROM orders"""


def order_rules():
    return [Rule("not_null_order_id", "not_null", ["o_orderkey"]),
            Rule("amount_not_negative", "check",
                 expr=F.col("o_totalprice").isNotNull() & (F.col("o_totalprice") >= 0)),
            Rule("unique_order_id", "unique", ["o_orderkey"])]


@query("dq04_quality_report", sql=_ORDER_RULES_SQL)
def _(spark, sf):
    """One-row report (row count, violations, failed rules); ``gate`` writes
    it and raises when violations > 0."""
    return Q.report(Tables(spark, sf).orders, "orders", order_rules())


@query("dq05_null_counts_all_columns", sql="""
    SELECT * FROM (VALUES ('o_orderkey', (SELECT count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders)),
                          ('o_custkey', (SELECT count(*) FILTER (WHERE o_custkey IS NULL) FROM orders)),
                          ('o_orderstatus', (SELECT count(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders)),
                          ('o_totalprice', (SELECT count(*) FILTER (WHERE o_totalprice IS NULL) FROM orders)),
                          ('o_orderdate', (SELECT count(*) FILTER (WHERE o_orderdate IS NULL) FROM orders)),
                          ('o_orderpriority', (SELECT count(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders)))
        AS t(column_name, nulls)""")
def _(spark, sf):
    return Q.null_counts(Tables(spark, sf).orders)


@query("dq06_range_checks", ctes=("e_orders",), sql=f"""
    WITH d AS (SELECT purchase_date, sum(order_total) AS revenue,
                      {m.avg_money_sql('order_total')} AS avg_ticket FROM e_orders GROUP BY 1)
    SELECT 'revenue_not_negative' AS rule, 'daily_sales' AS entity,
           count(*) FILTER (WHERE revenue < 0) AS violations FROM d
    UNION ALL
    SELECT 'avg_ticket_in_range', 'daily_sales',
           count(*) FILTER (WHERE avg_ticket < 0 OR avg_ticket > 300000) FROM d""")
def _(spark, sf):
    """Range rules on an aggregate table: sum < 0, average outside [0, 300000]."""
    o = m.orders(Tables(spark, sf))
    d = o.groupBy("purchase_date").agg(F.sum("order_total").alias("revenue"),
                                       m.avg_money("order_total").alias("avg_ticket"))
    return Q.evaluate(d, "daily_sales", [Rule("revenue_not_negative", "range", ["revenue"], low=0),
                                         Rule("avg_ticket_in_range", "range", ["avg_ticket"],
                                              low=0, high=300000)])


@query("dq07_accepted_values", sql="""
    SELECT 'accepted_priority' AS rule, 'orders' AS entity,
           count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN
                            ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')) AS violations
    FROM orders
    UNION ALL
    SELECT 'accepted_status', 'orders',
           count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) FROM orders""")
def _(spark, sf):
    """Accepted values; NULL counts as not accepted (pandas ``~isin``)."""
    o = Tables(spark, sf).orders
    return Q.evaluate(o, "orders", [
        Rule("accepted_priority", "accepted", ["o_orderpriority"],
             values=["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]),
        Rule("accepted_status", "accepted", ["o_orderstatus"], values=["F", "O"])])


@query("dq08_foreign_keys", sql="""
    SELECT 'fk_items_orders' AS rule, 'order_items' AS entity, count(*) AS violations
    FROM lineitem WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
    UNION ALL
    SELECT 'fk_items_products', 'order_items', count(*)
    FROM lineitem WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
    UNION ALL
    SELECT 'fk_items_sellers', 'order_items', count(*)
    FROM lineitem WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)
    UNION ALL
    SELECT 'fk_orders_customers', 'orders', count(*)
    FROM orders WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
    UNION ALL
    SELECT 'fk_reviews_customers', 'reviews', count(*)
    FROM events WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)""")
def _(spark, sf):
    """Child rows without a parent, all relations at once: every table is read
    once and tags its keys (``quality.foreign_keys``)."""
    t = Tables(spark, sf)
    tables = {n: getattr(t, n) for n in ("lineitem", "orders", "part", "supplier", "customer", "events")}
    return Q.foreign_keys(tables, [
        Q.Relation("fk_items_orders", "order_items", "lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
        Q.Relation("fk_items_products", "order_items", "lineitem", ["l_partkey"], "part", ["p_partkey"]),
        Q.Relation("fk_items_sellers", "order_items", "lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
        Q.Relation("fk_orders_customers", "orders", "orders", ["o_custkey"], "customer", ["c_custkey"]),
        Q.Relation("fk_reviews_customers", "reviews", "events", ["user_id"], "customer", ["c_custkey"])])


@query("dq09_composite_key_unique", sql="""
    SELECT 'pk_order_item' AS rule, 'order_items' AS entity, count(*) AS violations FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem
        WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1)""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    return Q.evaluate(li, "order_items", [Rule("pk_order_item", "unique", ["l_orderkey", "l_linenumber"])])


@query("dq10_check_constraints", sql="""
    SELECT 'payment_positive' AS rule, 'order_items' AS entity,
           count(*) FILTER (WHERE NOT coalesce(l_extendedprice * (1 - l_discount) > 0, FALSE)) AS violations
    FROM lineitem
    UNION ALL SELECT 'price_not_negative', 'order_items',
           count(*) FILTER (WHERE NOT coalesce(l_extendedprice >= 0, FALSE)) FROM lineitem
    UNION ALL SELECT 'size_null_or_positive', 'products',
           count(*) FILTER (WHERE NOT (p_size IS NULL OR p_size > 0)) FROM part
    UNION ALL SELECT 'net_amount_not_negative', 'customers',
           count(*) FILTER (WHERE NOT coalesce(c_acctbal >= 0, FALSE)) FROM customer""")
def _(spark, sf):
    """CHECK-style constraints as rules (Spark refuses CHECK on parquet tables)."""
    t = Tables(spark, sf)
    li = Q.evaluate(t.lineitem, "order_items", [
        Rule("payment_positive", "check", expr=F.col("l_extendedprice") * (1 - F.col("l_discount")) > 0),
        Rule("price_not_negative", "check", expr=F.col("l_extendedprice") >= 0)])
    pr = Q.evaluate(t.part, "products", [
        Rule("size_null_or_positive", "check", expr=F.col("p_size").isNull() | (F.col("p_size") > 0))])
    cu = Q.evaluate(t.customer, "customers", [
        Rule("net_amount_not_negative", "check", expr=F.col("c_acctbal") >= 0)])
    return li.unionByName(pr).unionByName(cu)


@query("dq11_temporal_order", ctes=("e_deliveries",), sql="""
    SELECT 'delivered_after_purchase' AS rule, 'deliveries' AS entity,
           count(*) FILTER (WHERE delivered_ts IS NOT NULL AND delivered_ts < purchase_ts) AS violations
    FROM e_deliveries
    UNION ALL SELECT 'estimate_after_purchase', 'deliveries',
           count(*) FILTER (WHERE estimated_ts < purchase_ts) FROM e_deliveries""")
def _(spark, sf):
    d = m.deliveries(Tables(spark, sf))
    return Q.evaluate(d, "deliveries", [
        Rule("delivered_after_purchase", "check",
             expr=F.col("delivered_ts").isNull() | (F.col("delivered_ts") >= F.col("purchase_ts"))),
        Rule("estimate_after_purchase", "check", expr=F.col("estimated_ts") >= F.col("purchase_ts"))])


@query("dq12_date_format", sql="""
    SELECT 'date_yyyy_mm_dd' AS rule, 'raw_dates' AS entity,
           count(*) FILTER (WHERE TRY_CAST(d AS DATE) IS NULL) AS violations
    FROM (SELECT '2024-' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 14 AS VARCHAR), 2, '0')
                 || '-01' AS d FROM events)""")
def _(spark, sf):
    """Text dates must parse as yyyy-MM-dd (month 00 and 13 do not)."""
    e = Tables(spark, sf).events
    k = F.get_json_object("props", "$.k").cast("int")
    raw = e.select(F.concat(F.lit("2024-"), F.lpad((k % 14).cast("string"), 2, "0"), F.lit("-01"))
                   .alias("d"))
    return Q.evaluate(raw, "raw_dates", [Rule("date_yyyy_mm_dd", "date_format", ["d"])])


# Data contract of the daily sales file (fixed values): exact header, types,
# not-null and unique-per-day rules.
SALES_CONTRACT = {
    "columns": ["order_id", "customer_id", "amount", "order_date"],
    "not_null": ["order_id", "customer_id", "order_date"],
    "unique": ["order_id", "order_date"],
}


def contract_rules(contract: dict) -> list[Rule]:
    rules = [Rule(f"not_null_{c}", "not_null", [c]) for c in contract["not_null"]]
    rules.append(Rule("unique_per_day", "unique", contract["unique"]))
    rules.append(Rule("amount_not_negative", "range", ["amount"], low=0))
    return rules


def check_header(df, contract: dict) -> None:
    if df.columns != contract["columns"]:
        raise ValueError(f"header {df.columns} != contract {contract['columns']}")


@query("dq13_contract_rules", sql="""
    WITH s AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                      CAST(o_totalprice AS DECIMAL(12,2)) AS amount, CAST(o_orderdate AS DATE) AS order_date
               FROM orders)
    SELECT rule, 'daily_sales_file' AS entity, CAST(v AS BIGINT) AS violations FROM (
        SELECT 'not_null_order_id' AS rule, count(*) FILTER (WHERE order_id IS NULL) AS v FROM s
        UNION ALL SELECT 'not_null_customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM s
        UNION ALL SELECT 'not_null_order_date', count(*) FILTER (WHERE order_date IS NULL) FROM s
        UNION ALL SELECT 'amount_not_negative', count(*) FILTER (WHERE amount < 0) FROM s
        UNION ALL SELECT 'unique_per_day', count(*) FROM (SELECT order_id, order_date FROM s
                                                        GROUP BY 1, 2 HAVING count(*) > 1))""")
def _(spark, sf):
    """Contract dict → header check (driver-side, metadata only) + rules."""
    o = Tables(spark, sf).orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        m.money("o_totalprice").alias("amount"), F.to_date("o_orderdate").alias("order_date"))
    check_header(o, SALES_CONTRACT)
    return Q.evaluate(o, "daily_sales_file", contract_rules(SALES_CONTRACT))


@query("dq14_volume_check", sql="""
    SELECT t AS table_name, actual, expected, actual = expected AS ok FROM (
        SELECT 'region' AS t, (SELECT count(*) FROM region) AS actual, CAST(5 AS BIGINT) AS expected
        UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), 25
        UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), 15 * (SELECT count(*) FROM supplier)
        UNION ALL SELECT 'orders', (SELECT count(*) FROM orders), 10 * (SELECT count(*) FROM customer))""")
def _(spark, sf):
    """Counts against expected volumes: fixed sizes (region 5, nation 25) and
    scale-free ratios (customers = 15 × suppliers, orders = 10 × customers)."""
    t = Tables(spark, sf)
    n = {name: getattr(t, name).select(F.count(F.lit(1))).scalar()
         for name in ("region", "nation", "customer", "supplier", "orders")}
    rows = [("region", n["region"], F.lit(5).cast("bigint")),
            ("nation", n["nation"], F.lit(25).cast("bigint")),
            ("customer", n["customer"], 15 * n["supplier"]),
            ("orders", n["orders"], 10 * n["customer"])]
    base = spark.range(1)
    parts = [base.select(F.lit(a).alias("table_name"), b.alias("actual"), c.alias("expected"))
             for a, b, c in rows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("actual") == F.col("expected"))


@query("dq15_quarantine_bad_rows", sql="""
    WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount,
                      user_id FROM events)
    SELECT event_id, concat_ws(',', CASE WHEN amount IS NULL THEN 'amount_not_null' END,
                                    CASE WHEN amount > 400 THEN 'amount_max_400' END) AS reasons
    FROM r WHERE amount IS NULL OR amount > 400""")
def _(spark, sf):
    """Rows failing any rule go to quarantine with the names of the rules."""
    e = Tables(spark, sf).events.select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("amount"), "user_id")
    _, bad = Q.quarantine(e, [Rule("amount_not_null", "not_null", ["amount"]),
                              Rule("amount_max_400", "range", ["amount"], high=400)])
    return bad.select("event_id", F.array_join("reasons", ",").alias("reasons"))


def apply_delete_policy(parent_deleted, children, child_key: str, parent_key: str, policy: str):
    """Effect on children of deleting parents: RESTRICT (children that block),
    CASCADE (children kept), SET NULL (children with the key nulled)."""
    hit = children.join(parent_deleted, children[child_key] == parent_deleted[parent_key], "left_semi")
    if policy == "RESTRICT":
        return hit
    if policy == "CASCADE":
        return children.join(parent_deleted, children[child_key] == parent_deleted[parent_key], "left_anti")
    if policy == "SET NULL":
        flag = parent_deleted.select(F.col(parent_key).alias("_k"), F.lit(True).alias("_del"))
        j = children.join(flag, children[child_key] == F.col("_k"), "left")
        return j.withColumn(child_key, F.when(F.col("_del"), F.lit(None)).otherwise(F.col(child_key))) \
            .drop("_k", "_del")
    raise ValueError(policy)


@query("dq16_delete_policies", sql="""
    WITH d AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    SELECT 'RESTRICT' AS policy, count(*) AS child_rows, count(o_custkey) AS with_key
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM d)
    UNION ALL
    SELECT 'CASCADE', count(*), count(o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM d)
    UNION ALL
    SELECT 'SET NULL', count(*), count(CASE WHEN o_custkey IN (SELECT c_custkey FROM d) THEN NULL ELSE o_custkey END)
    FROM orders""")
def _(spark, sf):
    """Deleting customers with a negative balance under each policy."""
    t = Tables(spark, sf)
    deleted = t.customer.where(F.col("c_acctbal") < 0).select("c_custkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    outs = []
    for pol in ("RESTRICT", "CASCADE", "SET NULL"):
        r = apply_delete_policy(deleted, o, "o_custkey", "c_custkey", pol)
        outs.append(r.agg(F.lit(pol).alias("policy"), F.count(F.lit(1)).alias("child_rows"),
                          F.count("o_custkey").alias("with_key")))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


@query("dq18_deliveries_only_for_open_orders", sql="""
    SELECT 'no_delivery_for_cancelled' AS rule, 'deliveries' AS entity, count(*) AS violations
    FROM orders WHERE o_orderstatus = 'P' AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def _(spark, sf):
    """Cancelled orders (P) must have no shipments: semi join, count must be 0."""
    t = Tables(spark, sf)
    cancelled = t.orders.where(F.col("o_orderstatus") == "P")
    shipped = cancelled.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
    return shipped.agg(F.lit("no_delivery_for_cancelled").alias("rule"),
                       F.lit("deliveries").alias("entity"), F.count(F.lit(1)).alias("violations"))


@query("dq17_reconcile_delivered_file", sql="""
    SELECT 'rows' AS metric, CAST(count(*) AS DECIMAL(38,2)) AS source_value,
           CAST(count(*) AS DECIMAL(38,2)) AS file_value, TRUE AS matches FROM lineitem
    UNION ALL
    SELECT 'amount', CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)),
           CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(38,2)), TRUE FROM lineitem""")
def _(spark, sf):
    """Control totals (rows, amount) of a delivered CSV file against its
    source: one aggregate on each side."""
    from cuenca.plans.sources import fresh
    from cuenca.sinks.writers import write_csv
    from cuenca.sources.files import read_csv
    li = Tables(spark, sf).lineitem.select("l_orderkey", m.money("l_extendedprice").alias("amount"))
    path = fresh(spark, "dq17")
    write_csv(li, path)
    back = read_csv(spark, path, schema="l_orderkey BIGINT, amount DECIMAL(12,2)")

    def totals(df, side):
        return df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).cast("decimal(38,2)").alias("rows"),
                      m.msum("amount").alias("amount"))
    both = totals(li, "src").unionByName(totals(back, "file"))
    j = both.agg(*[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{c}_{s}")
                   for s in ("src", "file") for c in ("rows", "amount")])
    return j.select(F.explode(F.array(
        F.struct(F.lit("rows").alias("metric"), F.col("rows_src").alias("source_value"),
                 F.col("rows_file").alias("file_value")),
        F.struct(F.lit("amount").alias("metric"), F.col("amount_src").alias("source_value"),
                 F.col("amount_file").alias("file_value")))).alias("r")).select(
        "r.*", (F.col("r.source_value") == F.col("r.file_value")).alias("matches"))
