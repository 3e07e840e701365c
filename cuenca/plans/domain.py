"""Domain pipelines with their own contract (SURVEY §2.13: PIP01-PIP04,
PIP14, PIP15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.operators import ingest as I
from cuenca.operators import quality as Q
from cuenca.plans import model as m
from cuenca.plans.aggregates import daily_counts
from cuenca.plans.documents import daily_sales, order_documents
from cuenca.plans.filters import _test_user
from cuenca.plans.registry import query
from cuenca.plans.sources import fresh, raw_orders_entity
from cuenca.session import materialize
from cuenca.sinks import writers as W
from cuenca.sinks.manifest import read_table
from cuenca.sources import files as S
from cuenca.sources.tables import Tables


def _sales_file(t, text_amount: bool = False):
    """Sales rows (order_id, customer_id, amount, order_date as text) derived
    from the event feed: amount = value − 50, so some amounts are ≤ 0; with
    ``text_amount`` error events carry the non-numeric amount 'n/a'."""
    e = t.events
    amt = (F.col("value") - 50)
    if text_amount:
        amt = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(amt.cast("string"))
    return e.select(F.col("event_id").alias("order_id"), F.col("user_id").alias("customer_id"),
                    amt.alias("amount"), F.date_format("ts", "yyyy-MM-dd").alias("order_date"))


@query("pip01_sales_clean", sql="""
    SELECT event_id AS order_id, user_id AS customer_id, value - 50 AS amount,
           CAST(ts AS DATE) AS order_date
    FROM events WHERE value - 50 > 0""")
def _(spark, sf):
    """read → amount > 0 → date cast → CSV export + replace-table load."""
    t = Tables(spark, sf)
    src = fresh(spark, "pip01_in")
    W.write_csv(_sales_file(t), src)
    sales = S.read_csv(spark, src, schema="order_id BIGINT, customer_id BIGINT, amount DOUBLE, "
                                          "order_date STRING")
    clean = I.clean_sales(sales, 0, inclusive=False)
    out = fresh(spark, "pip01_out")
    W.write_csv(clean, out, columns=["order_id", "customer_id", "amount", "order_date"])
    W.replace_table(clean, "sales_clean_" + out[-8:].replace("-", "_"), fresh(spark, "pip01_tbl"))
    return S.read_csv(spark, out, schema="order_id BIGINT, customer_id BIGINT, amount DOUBLE, "
                                          "order_date DATE")


class EmptyInputError(ValueError):
    pass


def run_daily_etl(spark, input_path: str, output_path: str):
    """Daily sales job: fail on a missing header or an empty file, coerce the
    amount (non-numeric dropped), keep amount >= 0, export with the contract's
    column order."""
    cols = ["order_id", "customer_id", "amount", "order_date"]
    df = S.read_csv(spark, input_path, schema=S.all_string_schema(cols))
    S.require_columns(df, cols, "sales_daily", exact=True)
    if df.limit(1).count() == 0:
        raise EmptyInputError(f"{input_path}: no rows")
    clean = I.clean_sales(df, 0, inclusive=True).withColumn(
        "order_id", F.col("order_id").try_cast("bigint")).withColumn(
        "customer_id", F.col("customer_id").try_cast("bigint"))
    W.write_csv(clean, output_path, columns=cols)
    return clean


@query("pip02_daily_sales_clean", sql="""
    SELECT event_id AS order_id, user_id AS customer_id, value - 50 AS amount, CAST(ts AS DATE) AS order_date
    FROM events WHERE event_type <> 'error' AND value - 50 >= 0""")
def _(spark, sf):
    t = Tables(spark, sf)
    src, out = fresh(spark, "pip02_in"), fresh(spark, "pip02_out")
    W.write_csv(_sales_file(t, text_amount=True), src)
    run_daily_etl(spark, src, out)
    return S.read_csv(spark, out, schema="order_id BIGINT, customer_id BIGINT, amount DOUBLE, "
                                          "order_date DATE")


def raw_customers_entity(t):
    """customers.csv of the raw zone; negative-balance customers carry an
    invalid date ('2025-13-01')."""
    c = t.customer.join(m.nation_b(t), F.col("c_nationkey") == F.col("n_nationkey")).join(
        m.region_b(t), F.col("n_regionkey") == F.col("r_regionkey"))
    created = F.when(F.col("c_acctbal") < 0, F.lit("2025-13-01")).otherwise(
        F.concat(F.lit("2025-"), F.lpad((F.col("c_custkey") % 12 + 1).cast("string"), 2, "0"),
                 F.lit("-"), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0")))
    return c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"),
                    F.col("c_name").alias("customer_name"), F.col("n_name").alias("city"),
                    F.col("r_name").alias("country"), created.alias("created_at"))


def raw_payments_entity(t):
    li = t.lineitem
    return li.select(
        F.concat(F.lit("P"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("payment_id"),
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.col("l_returnflag").alias("payment_method"),
        m.money("l_extendedprice").cast("string").alias("paid_amount"),
        F.lit("COP").alias("currency"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("paid_ts"))


def _land_raw(spark, t):
    base = fresh(spark, "raw")
    paths = {}
    for entity, df in (("customers", raw_customers_entity(t)), ("orders", raw_orders_entity(t)),
                       ("payments", raw_payments_entity(t))):
        paths[entity] = f"{base}/{entity}"
        W.write_csv(df, paths[entity])
    return paths


@query("pip03_raw_to_silver_three_entities", sql="""
    SELECT 'customers' AS entity, 'erp' AS source, DATE '2026-01-14' AS dt, count(*) AS n_rows,
           count(*) FILTER (WHERE c_acctbal < 0) AS n_null_typed FROM customer
    UNION ALL
    SELECT 'orders', 'erp', DATE '2026-01-14', count(*),
           count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW') FROM orders
    UNION ALL
    SELECT 'payments', 'erp', DATE '2026-01-14', count(*), 0 FROM lineitem""")
def _(spark, sf):
    """Three entity jobs run concurrently in one application, each writing
    silver parquet partitioned by (source, dt); the silver tables are read
    back and summarised (rows, values that failed their typed cast)."""
    t = Tables(spark, sf)
    paths = _land_raw(spark, t)
    silver = fresh(spark, "silver")
    jobs = [dict(entity=e, in_path=p, out_path=f"{silver}/{e}", source="erp", dt="2026-01-14")
            for e, p in paths.items()]
    I.run_entities(spark, jobs)
    typed = {"customers": "created_at", "orders": "total_amount", "payments": "paid_amount"}
    parts = []
    for e in paths:
        s = read_table(spark, f"{silver}/{e}")
        parts.append(s.groupBy("source", F.col("dt").cast("date").alias("dt")).agg(
            F.lit(e).alias("entity"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(typed[e]).isNull()).alias("n_null_typed")))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("entity", "source", "dt", "n_rows", "n_null_typed")


@query("pip04_raw_to_silver_quality_report", sql="""
    SELECT * FROM (VALUES
        ('null_or_empty_customer_id', 'customers', 0),
        ('duplicate_customer_id', 'customers', 0),
        ('null_or_empty_order_id', 'orders', 0),
        ('null_or_empty_customer_id', 'orders', 0),
        ('duplicate_order_id', 'orders', 0),
        ('null_or_empty_payment_id', 'payments', 0),
        ('null_or_empty_order_id', 'payments', 0),
        ('paid_amount_null_or_negative', 'payments', 0)) AS t(rule, entity, violations)
    UNION ALL
    SELECT 'total_amount_null_or_negative', 'orders',
           count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW') FROM orders
    UNION ALL
    SELECT 'duplicate_payment_id', 'payments', count(*) FROM (
        SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def _(spark, sf):
    """Quality rules per entity on the typed silver rows (one aggregate pass
    per entity + key checks). The gate (``quality.gate``) raises on these
    violations before anything is written; here the report is returned."""
    t = Tables(spark, sf)
    paths = _land_raw(spark, t)
    out = None
    for e, p in paths.items():
        s = I.to_silver(I.read_raw(spark, e, p), e)
        r = Q.evaluate(s, e, I.entity_rules(e))
        out = r if out is None else out.unionByName(r)
    return out


_ENERGY_REC = "ARRAY<STRUCT<fecha: STRING, region: STRING, valor: DOUBLE>>"


@query("pip14_energy_hourly_load", sql="""
    SELECT CAST(ts AS DATE) AS day, event_type AS region, count(*) AS n
    FROM events GROUP BY 1, 2""")
def _(spark, sf):
    """Payload (records under ``data``) → flattened rows → time column found
    by name → parquet partitioned by year/month/day → rows per day × region."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    e = Tables(spark, sf).events
    rec = F.to_json(F.array(F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("fecha"),
                                     F.col("event_type").alias("region"),
                                     F.col("value").alias("valor"))))
    raw = e.select(F.concat(F.lit('{"data": '), rec, F.lit("}")).alias("body"))
    schema = StructType([StructField("fecha", StringType()), StructField("region", StringType()),
                         StructField("valor", DoubleType())])
    rows = I.load_payload(raw, "body", schema)
    tc = S.find_time_column(rows)
    path = fresh(spark, "pip14")
    W.write_by_day(rows, path, tc)
    back = spark.read.parquet(path)
    return daily_counts(back, tc, "region")


@query("pip15_daily_sales_build_merge_export", sql=f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, coalesce(
               CASE o_orderpriority WHEN '1-URGENT' THEN 'app' WHEN '2-HIGH' THEN 'store'
                    WHEN '3-MEDIUM' THEN 'online' WHEN '4-NOT SPECIFIED' THEN 'phone' END, 'online') AS channel,
           n_name AS city, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE NOT ((CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_acctbal < 1000 THEN NULL ELSE FALSE END)
               IS NOT DISTINCT FROM TRUE)
    GROUP BY 1, 2, 3""")
def _(spark, sf):
    """daily_sales: build, merge into the previous run's table by (date,
    channel, city), check (no negative revenue, unique key), export CSV."""
    t = Tables(spark, sf)
    ds = daily_sales(order_documents(t), _test_user(t)).drop("avg_ticket")
    previous = ds.where(F.col("date") < "1998-01-01").withColumn("orders", F.lit(0).cast("bigint"))
    merged = materialize(W.upsert(previous, ds, ["date", "channel", "city"]))   # read by the check and the export
    rep = Q.evaluate(merged, "daily_sales", [
        Q.Rule("revenue_not_negative", "range", ["revenue"], low=0),
        Q.Rule("unique_day_channel_city", "unique", ["date", "channel", "city"])])
    Q.gate(rep.agg(F.lit("daily_sales").alias("entity"),
                   F.sum("violations").alias("violations_total")))
    out = fresh(spark, "pip15")
    W.write_csv(merged, out, columns=["date", "channel", "city", "orders", "revenue"])
    return S.read_csv(spark, out, schema="date STRING, channel STRING, city STRING, orders BIGINT, "
                                          "revenue DECIMAL(38,2)")


_DAILY_SALES_SQL = f"""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, coalesce(
               CASE o_orderpriority WHEN '1-URGENT' THEN 'app' WHEN '2-HIGH' THEN 'store'
                    WHEN '3-MEDIUM' THEN 'online' WHEN '4-NOT SPECIFIED' THEN 'phone' END, 'online') AS channel,
           n_name AS city, count(*) AS orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue,
           {m.avg_money_sql('CAST(o_totalprice AS DECIMAL(12,2))')} AS avg_ticket
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    WHERE NOT ((CASE WHEN c_acctbal < 0 THEN TRUE WHEN c_acctbal < 1000 THEN NULL ELSE FALSE END)
               IS NOT DISTINCT FROM TRUE)
    GROUP BY 1, 2, 3"""


@query("pip15_daily_sales_checks", sql=f"""
    WITH d AS ({_DAILY_SALES_SQL})
    SELECT 'null_date' AS rule, 'daily_sales' AS entity, count(*) FILTER (WHERE date IS NULL) AS violations FROM d
    UNION ALL SELECT 'null_channel', 'daily_sales', count(*) FILTER (WHERE channel IS NULL) FROM d
    UNION ALL SELECT 'null_city', 'daily_sales', count(*) FILTER (WHERE city IS NULL) FROM d
    UNION ALL SELECT 'revenue_negative', 'daily_sales', count(*) FILTER (WHERE revenue < 0) FROM d
    UNION ALL SELECT 'avg_ticket_out_of_range', 'daily_sales',
                     count(*) FILTER (WHERE avg_ticket < 0 OR avg_ticket > 100000) FROM d
    UNION ALL SELECT 'unexpected_channel', 'daily_sales',
                     count(*) FILTER (WHERE channel IS NULL OR channel NOT IN ('online', 'store')) FROM d""")
def _(spark, sf):
    """The checks run on the built daily_sales table, reported (not fatal):
    NULL dimensions, negative revenue, average ticket outside [0, 100000],
    channel outside the expected list (online, store) — one aggregate pass."""
    t = Tables(spark, sf)
    d = daily_sales(order_documents(t), _test_user(t))
    return Q.evaluate(d, "daily_sales", [
        Q.Rule("null_date", "not_null", ["date"]),
        Q.Rule("null_channel", "not_null", ["channel"]),
        Q.Rule("null_city", "not_null", ["city"]),
        Q.Rule("revenue_negative", "range", ["revenue"], low=0),
        Q.Rule("avg_ticket_out_of_range", "range", ["avg_ticket"], low=0, high=100000),
        Q.Rule("unexpected_channel", "accepted", ["channel"], values=["online", "store"])])
