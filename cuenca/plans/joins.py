"""Joins. Sides that grow with the data are never hinted;
AQE picks broadcast from runtime sizes. Fan-out is avoided by aggregating a
side to the join key first."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.operators import analytics as A
from cuenca.operators.temporal import asof_join
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.plans.subqueries import calendar
from cuenca.session import materialize
from cuenca.sources.tables import Tables


@query("joi01_inner_orders_customers", ctes=("e_orders", "e_customers"), sql="""
    SELECT o.order_id, o.customer_id, c.state, o.status
    FROM e_orders o JOIN e_customers c ON c.customer_id = o.customer_id""")
def _(spark, sf):
    t = Tables(spark, sf)
    return (m.orders(t).join(m.customers(t), "customer_id")
            .select("order_id", "customer_id", "state", "status"))


@query("joi03_preaggregated_left_joins", ctes=("e_orders", "e_customers", "e_payments", "e_reviews"), sql="""
    WITH p AS (SELECT order_id, count(*) AS n_payments,
                      CAST(sum(payment_value) AS DECIMAL(38,2)) AS paid FROM e_payments GROUP BY 1),
    r AS (SELECT customer_id, max(score) AS max_score, max(review_ts) AS last_review FROM e_reviews GROUP BY 1)
    SELECT o.order_id, c.state, coalesce(p.n_payments, 0) AS n_payments, p.paid, r.max_score, r.last_review
    FROM e_orders o JOIN e_customers c ON c.customer_id = o.customer_id
    LEFT JOIN p ON p.order_id = o.order_id LEFT JOIN r ON r.customer_id = o.customer_id""")
def _(spark, sf):
    """Inner driver (orders ⋈ customers) plus left joins to sides aggregated
    to the join key first, so no side can multiply the driver's rows."""
    t = Tables(spark, sf)
    p = m.payments(t).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_payments"),
                                              m.msum("payment_value").alias("paid"))
    r = m.reviews(t).groupBy("customer_id").agg(F.max("score").alias("max_score"),
                                                F.max("review_ts").alias("last_review"))
    return (m.orders(t).join(m.customers(t), "customer_id")
            .join(p, "order_id", "left").join(r, "customer_id", "left")
            .select("order_id", "state", F.coalesce("n_payments", F.lit(0)).alias("n_payments"),
                    "paid", "max_score", "last_review"))


@query("joi04_left_join_default_priority", sql="""
    WITH pr AS (SELECT n_nationkey, n_nationkey + 1 AS prioridad FROM nation WHERE n_nationkey < 10)
    SELECT c_custkey AS customer_id, coalesce(pr.prioridad, 9999) AS prioridad
    FROM customer LEFT JOIN pr ON pr.n_nationkey = c_nationkey""")
def _(spark, sf):
    """Left join to a partial priority table; missing priority → 9999."""
    t = Tables(spark, sf)
    pr = (t.nation.where(F.col("n_nationkey") < 10)
          .select("n_nationkey", (F.col("n_nationkey") + 1).alias("prioridad")))
    return (t.customer.join(F.broadcast(pr), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.coalesce("prioridad", F.lit(9999)).alias("prioridad")))


@query("joi05_lookup_as_array", ctes=("e_orders", "e_items"), sql="""
    SELECT o.order_id, count(i.item_id) AS n_items,
           coalesce(string_agg(CAST(i.product_id AS VARCHAR), ',' ORDER BY i.item_id, i.product_id), '')
               AS item_products
    FROM e_orders o LEFT JOIN e_items i ON i.order_id = o.order_id GROUP BY o.order_id""")
def _(spark, sf):
    """Mongo ``$lookup``: each order embeds the array of its lines (empty if
    none). The array is bounded by the lines of one order (≤ 7 by the data
    model); the lines are grouped before the join, so the join is 1:1."""
    t = Tables(spark, sf)
    arr = m.items(t).groupBy("order_id").agg(
        F.sort_array(F.collect_list(F.struct("item_id", "product_id", "quantity", "price")))
        .alias("items"))
    j = m.orders(t).select("order_id").join(arr, "order_id", "left").withColumn(
        "items", F.coalesce("items", F.array()))
    return j.select("order_id", F.size("items").cast("bigint").alias("n_items"),
                    F.array_join(F.transform("items", lambda x: x["product_id"].cast("string")), ",")
                    .alias("item_products"))


@query("joi06_lookup_unwind_inner", ctes=("e_orders", "e_customers"), sql="""
    SELECT o.order_id, o.order_total, c.customer_name, c.state
    FROM e_orders o JOIN e_customers c ON c.customer_id = o.customer_id""")
def _(spark, sf):
    """``$lookup`` + ``$unwind`` is an inner join: orders without a customer drop."""
    t = Tables(spark, sf)
    return (m.orders(t).join(m.customers(t), "customer_id")
            .select("order_id", "order_total", "customer_name", "state"))


def _sensors(t):
    """Sensor feed stand-in: vehicle = user_id, temperature = value / 50."""
    return t.events.select(F.col("user_id").alias("vehiculo"), F.col("ts").alias("timestamp"),
                           F.round(F.col("value") / 50, 2).alias("temperatura"))


def duty_starts(t):
    """(vehiculo, desde, conductor): who takes over a vehicle, and when."""
    return m.deliveries(t).groupBy(F.col("customer_id").alias("vehiculo"), F.col("purchase_ts").alias("desde")).agg(
        F.max_by("status", "order_id").alias("conductor"))


def on_duty(readings, starts, ts: str):
    """Readings with the driver of their time; readings before a vehicle's
    first delivery have none and drop."""
    return asof_join(readings, starts, "vehiculo", ts, "desde", ["conductor"])


@query("joi07_sensor_alert_driver", ctes=("e_deliveries",), sql="""
    WITH drv AS (SELECT customer_id AS vehiculo, purchase_ts, arg_max(status, order_id) AS conductor
                 FROM e_deliveries GROUP BY 1, 2)
    SELECT s.vehiculo, s.temperatura, s.timestamp, d.conductor
    FROM (SELECT user_id AS vehiculo, ts AS timestamp, round(value / 50, 2) AS temperatura FROM events) s
    ASOF JOIN drv d ON d.vehiculo = s.vehiculo AND s.timestamp >= d.purchase_ts
    WHERE s.temperatura > 5""")
def _(spark, sf):
    """Critical readings (temperature > 5) with the driver on duty.

    The course joins sensors × deliveries on the vehicle only, which pairs
    every reading with every delivery of that vehicle. Here a driver is on
    duty from a delivery's start to the next one of the vehicle, so each
    reading has one driver at most: the one of its own time (an as-of join
    without a product per vehicle)."""
    t = Tables(spark, sf)
    s = _sensors(t).where(F.col("temperatura") > 5)
    return on_duty(s, duty_starts(t), "timestamp").select("vehiculo", "temperatura", "timestamp", "conductor")


@query("joi10_anti_join_never_reviewed", sql="""
    SELECT c_custkey AS customer_id FROM customer c
    WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)""")
def _(spark, sf):
    t = Tables(spark, sf)
    return (t.customer.join(t.events, F.col("c_custkey") == F.col("user_id"), "left_anti")
            .select(F.col("c_custkey").alias("customer_id")))


@query("joi11_semi_join_has_five", ctes=("e_reviews",), sql="""
    SELECT c_custkey AS customer_id FROM customer c
    WHERE EXISTS (SELECT 1 FROM e_reviews r WHERE r.customer_id = c.c_custkey AND r.score = 5)""")
def _(spark, sf):
    t = Tables(spark, sf)
    five = m.reviews(t).where(F.col("score") == 5)
    return (t.customer.join(five, F.col("c_custkey") == F.col("customer_id"), "left_semi")
            .select(F.col("c_custkey").alias("customer_id")))


@query("joi12_presence_split", ctes=("e_orders", "e_reviews"), sql="""
    WITH r AS (SELECT DISTINCT review_id AS order_id FROM e_reviews)
    SELECT o.customer_id, count(*) AS orders, count(r.order_id) AS with_review,
           count(*) - count(r.order_id) AS without_review
    FROM e_orders o LEFT JOIN r ON r.order_id = o.order_id
    GROUP BY o.customer_id HAVING count(*) - count(r.order_id) >= 1""")
def _(spark, sf):
    """Orders with / without a review per customer; customers with ≥1 missing.
    A review is the order's of the same number."""
    t = Tables(spark, sf)
    r = m.reviews(t).select(F.col("review_id").alias("order_id")).distinct().withColumn("has", F.lit(1))
    j = m.orders(t).select("order_id", "customer_id").join(r, "order_id", "left")
    g = j.groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"),
                                     F.count("has").alias("with_review"))
    return (g.withColumn("without_review", F.col("orders") - F.col("with_review"))
            .where(F.col("without_review") >= 1))


@query("joi13_calendar_left_join", ctes=("e_orders",), sql="""
    WITH cal AS (SELECT CAST(unnest(generate_series(min(purchase_date), max(purchase_date), INTERVAL 1 DAY))
                             AS DATE) AS day FROM e_orders),
    c AS (SELECT purchase_date AS day, count(*) AS n FROM e_orders GROUP BY 1)
    SELECT cal.day, coalesce(c.n, 0) AS orders FROM cal LEFT JOIN c USING (day)""")
def _(spark, sf):
    """Every calendar day, including days with zero orders."""
    o = m.orders(Tables(spark, sf))
    cnt = o.groupBy(F.col("purchase_date").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return (calendar(o, "purchase_date").join(cnt, "day", "left")
            .fillna(0, subset=["orders"]))


@query("joi14_customers_multiple_sellers", ctes=("fact",), sql="""
    SELECT customer_id, count(DISTINCT seller_id) AS sellers FROM fact
    GROUP BY 1 HAVING count(DISTINCT seller_id) > 1""")
def _(spark, sf):
    f = m.fact_sales(Tables(spark, sf))
    return (f.groupBy("customer_id").agg(F.countDistinct("seller_id").alias("sellers"))
            .where(F.col("sellers") > 1))


@query("joi15_surrogate_key_unknown", ctes=("e_orders",), sql="""
    WITH dim AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS customer_sk
                 FROM customer WHERE c_acctbal >= 0)
    SELECT o.order_id, coalesce(d.customer_sk, -1) AS customer_sk
    FROM e_orders o LEFT JOIN dim d ON d.c_custkey = o.customer_id""")
def _(spark, sf):
    """Fact load looks up the surrogate key; unknown members map to -1.
    Keys are a dense sequence built without a single-partition window."""
    t = Tables(spark, sf)
    dim = A.global_sequence(t.customer.where(F.col("c_acctbal") >= 0).select("c_custkey"),
                            ["c_custkey"], "customer_sk")
    return (m.orders(t).select("order_id", "customer_id")
            .join(dim, F.col("customer_id") == F.col("c_custkey"), "left")
            .select("order_id", F.coalesce("customer_sk", F.lit(-1)).alias("customer_sk")))


def dim_tiempo(spark, df, date_col: str):
    """Date dimension over the span of ``date_col``: key yyyymmdd."""
    cal = calendar(df, date_col, out="fecha")
    return cal.select(
        (F.year("fecha") * 10000 + F.month("fecha") * 100 + F.dayofmonth("fecha")).alias("date_sk"),
        "fecha", F.year("fecha").alias("anio"), F.quarter("fecha").alias("trimestre"),
        F.month("fecha").alias("mes"), F.dayofweek("fecha").alias("dia_semana"))


@query("joi16_role_playing_date_dimension", ctes=("e_deliveries",), sql="""
    WITH d AS (SELECT order_id, CAST(purchase_ts AS DATE) AS purchase_date,
                      CAST(estimated_ts AS DATE) AS promised_date,
                      CAST(delivered_ts AS DATE) AS actual_date FROM e_deliveries),
    span AS (SELECT purchase_date AS x FROM d UNION ALL SELECT promised_date FROM d
             UNION ALL SELECT actual_date FROM d WHERE actual_date IS NOT NULL),
    cal AS (SELECT CAST(x AS DATE) AS fecha FROM (SELECT unnest(generate_series(
                (SELECT min(x) FROM span), (SELECT max(x) FROM span), INTERVAL 1 DAY)) AS x)),
    dim AS (SELECT fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
                   CAST(dayofweek(fecha) + 1 AS INTEGER) AS dia_semana FROM cal)
    SELECT d.order_id, p.anio AS purchase_year, p.mes AS purchase_month,
           e.anio AS promised_year, e.mes AS promised_month, e.dia_semana AS promised_weekday,
           a.anio AS actual_year, a.mes AS actual_month
    FROM d JOIN dim p ON p.fecha = d.purchase_date JOIN dim e ON e.fecha = d.promised_date
    LEFT JOIN dim a ON a.fecha = d.actual_date""")
def _(spark, sf):
    """One date dimension joined under three roles: purchase, promised and
    actual delivery (left join: undelivered orders keep NULLs). The
    deliveries, read by the span and by the joins, and the calendar, read by the
    three roles, are each built once; Spark broadcasts the calendar from its
    measured size."""
    d = materialize(m.deliveries(Tables(spark, sf)).select(
        "order_id", F.to_date("purchase_ts").alias("purchase_date"),
        F.to_date("estimated_ts").alias("promised_date"),
        F.to_date("delivered_ts").alias("actual_date")))
    dates = ("purchase_date", "promised_date", "actual_date")
    ends = d.agg(F.min(F.least(*dates)).alias("lo"), F.max(F.greatest(*dates)).alias("hi"))
    dim = materialize(dim_tiempo(spark, ends.select(F.explode(F.array("lo", "hi")).alias("x")), "x"))

    def role(name, weekday=False):
        cols = [F.col("fecha").alias(f"{name}_date"), F.col("anio").alias(f"{name}_year"),
                F.col("mes").alias(f"{name}_month")]
        if weekday:
            cols.append(F.col("dia_semana").alias(f"{name}_weekday"))
        return dim.select(*cols)
    return (d.join(role("purchase"), "purchase_date").join(role("promised", True), "promised_date")
            .join(role("actual"), "actual_date", "left")
            .select("order_id", "purchase_year", "purchase_month", "promised_year",
                    "promised_month", "promised_weekday", "actual_year", "actual_month"))


@query("joi17_orders_item_counts_first20", ctes=("e_orders", "e_items"), sql="""
    SELECT o.order_id, o.purchase_ts, count(*) AS n_items
    FROM e_orders o JOIN e_items i ON i.order_id = o.order_id
    GROUP BY 1, 2 ORDER BY o.order_id LIMIT 20""")
def _(spark, sf):
    t = Tables(spark, sf)
    cnt = m.items(t).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_items"))
    return (m.orders(t).select("order_id", "purchase_ts").join(cnt, "order_id")
            .orderBy("order_id").limit(20))


@query("joi18_cross_shard_recombine", ctes=("fact",), sql="""
    WITH s1 AS (SELECT category, sum(revenue) AS revenue, count(*) AS n FROM fact
                WHERE state IN ('NATION_0','NATION_1','NATION_2','NATION_3','NATION_4',
                                'NATION_5','NATION_6','NATION_7','NATION_8','NATION_9') GROUP BY 1),
    s2 AS (SELECT category, sum(revenue) AS revenue, count(*) AS n FROM fact
           WHERE state NOT IN ('NATION_0','NATION_1','NATION_2','NATION_3','NATION_4',
                               'NATION_5','NATION_6','NATION_7','NATION_8','NATION_9') GROUP BY 1)
    SELECT category, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue, CAST(sum(n) AS BIGINT) AS items
    FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2) GROUP BY category""")
def _(spark, sf):
    """Data split into shards by a state rule, aggregated per shard, then
    recombined and re-aggregated (partial sums are associative)."""
    f = m.fact_sales(Tables(spark, sf))
    shard_a = [f"NATION_{i}" for i in range(10)]
    in_a = F.col("state").isin(shard_a)
    u = (f.withColumn("shard", in_a).where("shard is not null").groupBy("shard", "category")
         .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("n")))   # one pass for both shards
    return u.groupBy("category").agg(m.msum("revenue").alias("revenue"),
                                     F.sum("n").cast("bigint").alias("items"))


@query("joi19_approximate_name_match", sql="""
    WITH n AS (SELECT c_name, min(c_custkey) AS rep FROM customer GROUP BY 1)
    SELECT a.rep AS id_a, b.rep AS id_b, levenshtein(a.c_name, b.c_name) AS distance
    FROM n a JOIN n b ON a.rep < b.rep WHERE levenshtein(a.c_name, b.c_name) <= 1
    UNION ALL SELECT rep, c_custkey, 0 FROM customer JOIN n USING (c_name) WHERE c_custkey > rep""")
def _(spark, sf):
    """Possible duplicate customers: names within edit distance 1, found by
    deletion-neighbourhood keys + equi join, verified with ``levenshtein``."""
    from cuenca.operators.matching import fuzzy_pairs
    c = Tables(spark, sf).customer.select("c_custkey", "c_name")
    return fuzzy_pairs(c, "c_custkey", "c_name").select(
        "id_a", "id_b", F.col("distance").cast("bigint").alias("distance"))
