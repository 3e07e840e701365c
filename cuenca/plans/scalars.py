"""Scalar functions and the UDF surface (§2.12). All are
built-in expressions; the one SQL function is inlined by Catalyst."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.functions import columns as C
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.sources.tables import Tables


@query("fun01_string_functions", sql="""
    SELECT p_partkey AS part_id,
           regexp_replace(trim(CAST(p_partkey AS VARCHAR) || '.0'), '\\.0$', '') AS sku,
           lower(p_name) AS name_lower, split_part(p_name, ' ', 1) AS first_word,
           lpad(CAST(p_size AS VARCHAR), 3, '0') AS size_code, p_brand || '-' || p_type AS label
    FROM part""")
def _(spark, sf):
    """split / lower / regexp_replace('\\.0$') / concat / lpad / casts.
    ``sku`` cleans an id exported by a spreadsheet as '123.0'."""
    p = Tables(spark, sf).part
    raw_id = F.concat(F.col("p_partkey").cast("string"), F.lit(".0"))
    return p.select(F.col("p_partkey").alias("part_id"), C.clean_id(raw_id).alias("sku"),
                    F.lower("p_name").alias("name_lower"),
                    F.split("p_name", " ").getItem(0).alias("first_word"),
                    C.zero_pad("p_size", 3).alias("size_code"),
                    F.concat("p_brand", F.lit("-"), "p_type").alias("label"))


@query("fun02_coalesce_greatest_least_nullif", sql="""
    SELECT l_orderkey AS order_id, l_linenumber AS line,
           greatest(l_quantity, 10.0) AS qty_floor10, least(l_quantity, 40.0) AS qty_cap40,
           nullif(l_discount, 0.0) AS discount_or_null,
           coalesce(nullif(l_tax, 0.0), -1.0) AS tax_or_default
    FROM lineitem""")
def _(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                     F.greatest("l_quantity", F.lit(10.0)).alias("qty_floor10"),
                     F.least("l_quantity", F.lit(40.0)).alias("qty_cap40"),
                     F.nullif("l_discount", F.lit(0.0)).alias("discount_or_null"),
                     F.coalesce(F.nullif("l_tax", F.lit(0.0)), F.lit(-1.0)).alias("tax_or_default"))


@query("fun03_date_functions", sql="""
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS d,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
           CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS mo,
           CAST(day(o_orderdate) AS INTEGER) AS dd,
           CAST(CAST(o_orderdate AS DATE) - INTERVAL 15 DAY AS DATE) AS d_minus_15
    FROM orders""")
def _(spark, sf):
    o = Tables(spark, sf).orders
    d = F.to_date("o_orderdate")
    return o.select(F.col("o_orderkey").alias("order_id"), d.alias("d"),
                    F.trunc(d, "month").alias("month_start"), F.year(d).alias("y"),
                    F.month(d).alias("mo"), F.dayofmonth(d).alias("dd"),
                    F.date_sub(d, 15).alias("d_minus_15"))


@query("fun04_date_differences", ctes=("e_deliveries",), sql="""
    SELECT order_id, date_diff('minute', purchase_ts, delivered_ts) AS minutes,
           CAST(date_diff('day', CAST(purchase_ts AS DATE), CAST(delivered_ts AS DATE)) AS INTEGER) AS days,
           CAST(date_diff('month', CAST(date_trunc('month', purchase_ts) AS DATE),
                          CAST(date_trunc('month', delivered_ts) AS DATE)) AS INTEGER) AS months
    FROM e_deliveries WHERE delivered_ts IS NOT NULL""")
def _(spark, sf):
    """Minutes (timestampdiff), days (datediff), months between month starts."""
    d = m.deliveries(Tables(spark, sf)).where(F.col("delivered_ts").isNotNull())
    return d.select("order_id",
                    F.timestamp_diff("MINUTE", "purchase_ts", "delivered_ts").alias("minutes"),
                    F.datediff("delivered_ts", "purchase_ts").alias("days"),
                    F.months_between(F.trunc(F.to_date("delivered_ts"), "month"),
                                     F.trunc(F.to_date("purchase_ts"), "month")).cast("int")
                    .alias("months"))


@query("fun05_date_format", sql="""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M') AS minute
    FROM events""")
def _(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"),
                    F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"))


def partition_path(ts_col: str) -> F.Column:
    """Hive partition path ``year=YYYY/month=MM/day=DD`` for a timestamp."""
    return F.concat(F.lit("year="), F.year(ts_col).cast("string"),
                    F.lit("/month="), C.zero_pad(F.month(ts_col), 2),
                    F.lit("/day="), C.zero_pad(F.dayofmonth(ts_col), 2))


@query("fun06_partition_path_parts", sql="""
    SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(day(ts) AS INTEGER) AS day,
           'year=' || CAST(year(ts) AS VARCHAR) || '/month=' || lpad(CAST(month(ts) AS VARCHAR), 2, '0')
               || '/day=' || lpad(CAST(day(ts) AS VARCHAR), 2, '0') AS path
    FROM events""")
def _(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"),
                    F.dayofmonth("ts").alias("day"), partition_path("ts").alias("path"))


@query("fun07_try_parse", sql="""
    WITH r AS (SELECT event_id,
                      CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS num_txt,
                      '2024-' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 14 AS VARCHAR), 2, '0')
                          || '-01' AS date_txt
               FROM events)
    SELECT event_id, TRY_CAST(num_txt AS DOUBLE) AS num, TRY_CAST(num_txt AS DECIMAL(18,2)) AS amount,
           TRY_CAST(date_txt AS DATE) AS d, TRY_CAST(date_txt || ' 10:30:00' AS TIMESTAMP) AS ts
    FROM r""")
def _(spark, sf):
    """Parse text to number / decimal(18,2) / date / timestamp; bad text → NULL
    (``try_*``: ANSI mode would otherwise fail the job)."""
    e = Tables(spark, sf).events
    k = F.get_json_object("props", "$.k").cast("int")
    r = e.select("event_id",
                 F.when(F.col("event_type") == "error", F.lit("n/a"))
                 .otherwise(F.col("value").cast("string")).alias("num_txt"),
                 F.concat(F.lit("2024-"), C.zero_pad(k % 14, 2), F.lit("-01")).alias("date_txt"))
    return r.select("event_id", C.try_number("num_txt").alias("num"),
                    F.col("num_txt").try_cast("decimal(18,2)").alias("amount"),
                    C.try_date("date_txt").alias("d"),
                    F.try_to_timestamp(F.concat("date_txt", F.lit(" 10:30:00"))).cast("timestamp_ntz")
                    .alias("ts"))


@query("fun10_json_and_base64", sql="""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           to_base64(encode('{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '"}'))
               AS payload_b64,
           CAST(json_extract_string(
               decode(from_base64(to_base64(encode('{"id":' || CAST(event_id AS VARCHAR) || ',"type":"'
                                                   || event_type || '"}')))), '$.type') AS VARCHAR)
               AS type_roundtrip
    FROM events""")
def _(spark, sf):
    """JSON parse (get_json_object), serialise (to_json), base64 encode and
    decode + re-parse (the stream record round trip)."""
    e = Tables(spark, sf).events
    js = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type")))
    b64 = F.base64(F.encode(js, "UTF-8"))
    back = F.get_json_object(F.decode(F.unbase64(b64), "UTF-8"), "$.type")
    return e.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                    b64.alias("payload_b64"), back.alias("type_roundtrip"))


@query("fun11_decimal_arithmetic", sql="""
    SELECT l_orderkey AS order_id, l_linenumber AS line,
           CAST(l_discount AS DECIMAL(12,2)) * 100 AS discount_pct,
           CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2))), 2)
                AS DECIMAL(12,2)) AS net,
           CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))
                      * (1 + CAST(l_tax AS DECIMAL(12,2))), 2) AS DECIMAL(12,2)) AS gross
    FROM lineitem""")
def _(spark, sf):
    """Money arithmetic in DECIMAL with explicit half-up rounding to cents."""
    li = Tables(spark, sf).lineitem
    price, disc, tax = m.money("l_extendedprice"), m.money("l_discount"), m.money("l_tax")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
                     (disc * 100).cast("decimal(18,2)").alias("discount_pct"),
                     m.money(F.round(price * (1 - disc), 2)).alias("net"),
                     m.money(F.round(price * (1 - disc) * (1 + tax), 2)).alias("gross"))


# --- UDF surface -----------------------------------------------------------

REVIEW_LABEL_FN = """
CREATE OR REPLACE TEMPORARY FUNCTION review_label(score INT)
RETURNS STRING
RETURN CASE WHEN score BETWEEN 1 AND 2 THEN 'mala' WHEN score = 3 THEN 'neutral'
            WHEN score BETWEEN 4 AND 5 THEN 'buena' END"""


def register_sql_functions(spark) -> None:
    """SQL-bodied functions: Catalyst inlines them, so they stay in codegen."""
    spark.sql(REVIEW_LABEL_FN)


@query("udf01_sql_function_review_label", ctes=("e_reviews", "e_customers"), sql="""
    SELECT c.state, CASE WHEN score BETWEEN 1 AND 2 THEN 'mala' WHEN score = 3 THEN 'neutral'
                         WHEN score BETWEEN 4 AND 5 THEN 'buena' END AS label, count(*) AS reviews
    FROM e_reviews r JOIN e_customers c ON c.customer_id = r.customer_id GROUP BY 1, 2""")
def _(spark, sf):
    """A SQL UDF (``CREATE TEMPORARY FUNCTION … RETURN CASE``) used in a query."""
    t = Tables(spark, sf)
    register_sql_functions(spark)
    rv = m.reviews(t).join(m.customers(t), "customer_id")
    return spark.sql("SELECT state, review_label(score) AS label, count(*) AS reviews "
                     "FROM {rv} GROUP BY 1, 2", rv=rv)


def csv_lines(t: Tables):
    """Order lines rendered as CSV text with a header line first (the
    text-file input of the RDD lab)."""
    li = t.lineitem
    body = li.select(F.concat_ws(",", "l_orderkey", "l_linenumber", "l_partkey",
                                 F.col("l_quantity").cast("int"), "l_returnflag",
                                 F.date_format("l_shipdate", "yyyy-MM-dd")).alias("value"))
    header = t.spark.range(1).select(
        F.lit("order_id,line,product_id,qty,flag,ship_date").alias("value"))
    return header.unionByName(body)


def parse_lines(lines, header_prefix: str = "order_id,"):
    """Drop the header and parse each line positionally into typed columns
    (native ``split`` + ``try_cast``; the Python map function is not needed)."""
    p = lines.where(~F.col("value").startswith(header_prefix)).select(
        F.split("value", ",").alias("f"))
    return p.select(F.col("f")[0].try_cast("bigint").alias("order_id"),
                    F.col("f")[1].try_cast("int").alias("line"),
                    F.col("f")[2].try_cast("bigint").alias("product_id"),
                    F.col("f")[3].try_cast("int").alias("qty"),
                    F.col("f")[4].alias("flag"),
                    F.try_to_date(F.col("f")[5]).alias("ship_date"))


@query("udf02_line_parser_native", sql="""
    SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS qty, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem""")
def _(spark, sf):
    return parse_lines(csv_lines(Tables(spark, sf)))


@query("src08_text_lines_positional_parse", sql="""
    SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id,
           CAST(l_quantity AS INTEGER) AS qty, l_returnflag AS flag, CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem""")
def _(spark, sf):
    """Text file → drop header → positional parse: the lines are written as a
    text file and read back with ``spark.read.text``."""
    from cuenca.session import scratch_path
    import uuid
    path = scratch_path(spark, f"lines-{uuid.uuid4().hex}")
    csv_lines(Tables(spark, sf)).write.mode("overwrite").text(path)
    return parse_lines(spark.read.text(path))
