"""Filters and predicates. Every predicate here is a plain
Catalyst expression, so comparisons on scan columns appear in the parquet
``PushedFilters``."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.functions import columns as C
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.sources.tables import Tables


@query("flt01_amount_positive", sql="""
    SELECT c_custkey AS customer_id, c_acctbal AS amount FROM customer WHERE c_acctbal > 0""")
def _(spark, sf):
    c = Tables(spark, sf).customer
    return (c.where(F.col("c_acctbal") > 0)
            .select(F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("amount")))


@query("flt01_amount_at_least_50", ctes=("e_payments",), sql="""
    SELECT order_id, payment_sequential, payment_value FROM e_payments
    WHERE payment_value >= 50""")
def _(spark, sf):
    p = m.payments(Tables(spark, sf))
    return (p.where(F.col("payment_value") >= 50)
            .select("order_id", "payment_sequential", "payment_value"))


def _raw_amounts(t: Tables):
    """A text amount column with non-numeric values ('n/a' for errors)."""
    return t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise((F.col("value") - 50).cast("string")).alias("amount_raw"))


@query("flt02_coerce_then_filter", sql="""
    WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a'
                                     ELSE CAST(value - 50 AS VARCHAR) END AS amount_raw
               FROM events)
    SELECT event_id, TRY_CAST(amount_raw AS DOUBLE) AS amount FROM r
    WHERE TRY_CAST(amount_raw AS DOUBLE) >= 0""")
def _(spark, sf):
    """Coerce to a number (bad text → NULL) then keep amount >= 0; NULLs drop."""
    r = _raw_amounts(Tables(spark, sf)).select("event_id",
                                               C.try_number("amount_raw").alias("amount"))
    return r.where(F.col("amount") >= 0)


@query("flt03_half_open_date_range", sql="""
    SELECT o_orderkey AS order_id, o_orderdate AS purchase_ts FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'""")
def _(spark, sf):
    o = Tables(spark, sf).orders
    return (o.where((F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
                    & (F.col("o_orderdate") < F.lit("1997-02-01").cast("timestamp_ntz")))
            .select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("purchase_ts")))


@query("flt04_cast_on_column", sql="""
    SELECT o_orderkey AS order_id FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-03-15'""")
def _(spark, sf):
    """``ts::date = d`` — Catalyst unwraps the cast into a sargable range."""
    o = Tables(spark, sf).orders
    return (o.where(F.to_date("o_orderdate") == F.lit("1997-03-15").cast("date"))
            .select(F.col("o_orderkey").alias("order_id")))


def last_n_days(df, col: str, ref_date: str, n: int):
    """Rows with ``col >= ref_date - n days``; the reference date is a parameter."""
    return df.where(F.col(col) >= F.date_sub(F.lit(ref_date).cast("date"), n))


@query("flt05_last_n_days", sql="""
    SELECT event_id, ts FROM events WHERE ts >= DATE '2024-01-30' - INTERVAL 15 DAY""")
def _(spark, sf):
    e = Tables(spark, sf).events
    return last_n_days(e, "ts", "2024-01-30", 15).select("event_id", "ts")


@query("flt06_status_and_date", sql="""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderdate AS purchase_ts
    FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2000-01-01'""")
def _(spark, sf):
    o = Tables(spark, sf).orders
    return (o.where((F.col("o_orderstatus") == "F")
                    & (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")))
            .select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                    F.col("o_orderdate").alias("purchase_ts")))


@query("flt09_null_checks", ctes=("e_deliveries",), sql="""
    SELECT order_id, status FROM e_deliveries WHERE delivered_ts IS NULL""")
def _(spark, sf):
    """Orders without a delivery time (IS NULL)."""
    d = m.deliveries(Tables(spark, sf))
    return d.where(F.col("delivered_ts").isNull()).select("order_id", "status")


@query("flt09_null_or_empty", sql="""
    WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 4 = 1 THEN NULL WHEN turn % 4 = 2 THEN repeat(' ', conv_id % 3)
                                          ELSE text END AS text, role FROM conversations)
    SELECT conv_id, turn FROM c WHERE text IS NULL OR trim(text) = ''
    UNION ALL
    SELECT conv_id, turn FROM c WHERE role IS NULL OR trim(role) = ''""")
def _(spark, sf):
    """Turns without a text: NULL, empty or blank. The given texts are all
    filled, so some turns are read as if they had come without one."""
    t = F.col("turn") % 4
    c = Tables(spark, sf).conversations.withColumn("text", F.when(t == 1, F.lit(None)).when(
        t == 2, F.repeat(F.lit(" "), (F.col("conv_id") % 3).cast("int"))).otherwise(F.col("text")))
    return (c.where(C.null_or_empty("text")).select("conv_id", "turn")
            .unionByName(c.where(C.null_or_empty("role")).select("conv_id", "turn")))


def _test_user(t: Tables):
    """Customers with a three-valued ``test_user`` flag (true/false/missing)."""
    c = t.customer
    flag = (F.when(F.col("c_acctbal") < 0, F.lit(True))
            .when(F.col("c_acctbal") < 1000, F.lit(None).cast("boolean")).otherwise(F.lit(False)))
    return c.select(F.col("c_custkey").alias("customer_id"), flag.alias("test_user"))


TEST_USER_SQL = """(SELECT c_custkey AS customer_id,
        CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_acctbal < 1000 THEN NULL ELSE FALSE END AS test_user
    FROM customer)"""


@query("flt10_not_true_keeps_nulls", sql=f"""
    SELECT customer_id, test_user FROM {TEST_USER_SQL} u
    WHERE NOT (test_user IS NOT DISTINCT FROM TRUE)""")
def _(spark, sf):
    """Mongo ``$ne: true``: false and missing flags both stay."""
    u = _test_user(Tables(spark, sf))
    return u.where(C.not_true("test_user"))


@query("flt11_threshold", ctes=("e_orders",), sql="""
    SELECT order_id, order_total FROM e_orders WHERE order_total > 200000""")
def _(spark, sf):
    o = m.orders(Tables(spark, sf))
    return o.where(F.col("order_total") > 200000).select("order_id", "order_total")


@query("flt12_not_in_allowed_set", sql="""
    SELECT event_id, event_type FROM events
    WHERE event_type NOT IN ('click', 'view', 'purchase') OR event_type IS NULL""")
def _(spark, sf):
    """Values outside the allowed set; NULL counts as outside (pandas ~isin)."""
    e = Tables(spark, sf).events
    allowed = ["click", "view", "purchase"]
    return (e.where(~F.col("event_type").isin(allowed) | F.col("event_type").isNull())
            .select("event_id", "event_type"))


@query("flt13_parameterised_query", sql="""
    SELECT o_orderkey AS order_id, o_totalprice AS total FROM orders
    WHERE o_orderstatus = 'O' AND o_orderdate >= TIMESTAMP '1999-01-01' AND o_totalprice > 100000""")
def _(spark, sf):
    """Named parameters bound by Spark (no string interpolation → no injection)."""
    o = Tables(spark, sf).orders
    return spark.sql(
        "SELECT o_orderkey AS order_id, o_totalprice AS total FROM {o} "
        "WHERE o_orderstatus = :status AND o_orderdate >= CAST(:start AS TIMESTAMP_NTZ) "
        "AND o_totalprice > :min_total",
        args={"status": "O", "start": "1999-01-01", "min_total": 100000},
        o=o)


@query("flt14_per_key_lookup", sql="""
    SELECT o_orderkey AS order_id, o_orderdate AS purchase_ts, o_totalprice AS total
    FROM orders WHERE o_custkey = 42 ORDER BY o_orderdate DESC""")
def _(spark, sf):
    """One customer's orders, newest first (key predicate pushed to the scan)."""
    o = Tables(spark, sf).orders
    return (o.where(F.col("o_custkey") == 42).orderBy(F.desc("o_orderdate"))
            .select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("purchase_ts"),
                    F.col("o_totalprice").alias("total")))


@query("flt15_filter_map_integers", sql="""
    SELECT o_orderkey + 1 AS value FROM orders WHERE o_orderkey % 3 = 0""")
def _(spark, sf):
    """RDD ``filter(x % 3 == 0).map(x + 1)`` as a DataFrame predicate and projection."""
    o = Tables(spark, sf).orders
    return o.where(F.col("o_orderkey") % 3 == 0).select((F.col("o_orderkey") + 1).alias("value"))
