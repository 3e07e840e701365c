"""Sources. Each query writes the source format from the
driver's tables into a fresh folder under the shared scratch location, reads
it back with the operator under test, and returns what was read, so the
oracle compares the round trip with the tables."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from cuenca.operators import documents as D
from cuenca.operators.ingest import to_silver, read_raw
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.session import scratch_path
from cuenca.sinks.writers import write_by_day, write_csv
from cuenca.sources import files as S
from cuenca.sources.tables import Tables


def fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


CUSTOMER_SCHEMA = StructType([StructField("customer_id", LongType()),
                              StructField("name", StringType()),
                              StructField("acctbal", DoubleType()),
                              StructField("segment", StringType())])

_CUST_SQL = """SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS acctbal,
                      c_mktsegment AS segment FROM customer"""


def _customers_flat(t):
    return t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
                             F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))


@query("src01_csv_explicit_schema", sql=_CUST_SQL)
def _(spark, sf):
    path = fresh(spark, "src01")
    write_csv(_customers_flat(Tables(spark, sf)), path)
    return S.read_csv(spark, path, schema=CUSTOMER_SCHEMA)


@query("src02_csv_inferred_schema", sql="""
    SELECT CAST(c_custkey AS BIGINT) AS customer_id, c_name AS name, c_acctbal AS acctbal,
           c_mktsegment AS segment FROM customer""")
def _(spark, sf):
    """Inferred types (an extra pass over the file). Whole numbers are BIGINT,
    whatever their size, so the type stays when ids grow."""
    path = fresh(spark, "src02")
    write_csv(_customers_flat(Tables(spark, sf)), path)
    return S.read_csv(spark, path, infer=True)


def raw_orders_entity(t):
    """orders.csv of the raw zone: text fields, with a non-numeric amount on
    some rows ('n/a' for cancelled low-priority orders)."""
    o = t.orders
    amt = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit("n/a")) \
        .otherwise(F.col("o_totalprice").cast("string"))
    return o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("order_id"),
                    F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("customer_id"),
                    F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("order_ts"),
                    F.col("o_orderstatus").alias("status"), amt.alias("total_amount"),
                    F.lit("COP").alias("currency"))


SILVER_ORDERS_SQL = """
    SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS order_id, 'C' || CAST(o_custkey AS VARCHAR) AS customer_id,
           o_orderdate AS order_ts, o_orderstatus AS status,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
                ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS total_amount,
           'COP' AS currency
    FROM orders"""


@query("src03_csv_all_strings_typed", sql=SILVER_ORDERS_SQL)
def _(spark, sf):
    """All-string PERMISSIVE read, then per-entity ``try_*`` casts: the bad
    amount becomes NULL instead of failing the job."""
    path = fresh(spark, "src03")
    write_csv(raw_orders_entity(Tables(spark, sf)), path)
    return to_silver(read_raw(spark, "orders", path), "orders")


TAXI_SCHEMA = StructType([StructField("VendorID", LongType()),
                          StructField("pickup", TimestampNTZType()),
                          StructField("passenger_count", LongType()),
                          StructField("total_amount", DoubleType())])

_TAXI_SQL = """SELECT o_orderkey AS VendorID, o_orderdate AS pickup, o_custkey AS passenger_count,
                      o_totalprice AS total_amount FROM orders"""


def _taxi(t):
    return t.orders.select(F.col("o_orderkey").alias("VendorID"), F.col("o_orderdate").alias("pickup"),
                           F.col("o_custkey").alias("passenger_count"),
                           F.col("o_totalprice").alias("total_amount"))


@query("src04_csv_pipe_separator", sql=_TAXI_SQL)
def _(spark, sf):
    path = fresh(spark, "src04")
    write_csv(_taxi(Tables(spark, sf)), path, sep="|")
    df = S.read_csv(spark, path, schema=TAXI_SCHEMA, sep="|")
    S.check_separator(df, "taxi", "|")
    return df


@query("src07_delimiter_autodetect", sql=_TAXI_SQL)
def _(spark, sf):
    """A feed switched to '|': the delimiter is classified from the first
    line, the header contract is checked, then the file is read."""
    path = fresh(spark, "src07")
    write_csv(_taxi(Tables(spark, sf)), path, sep="|")
    sep = S.detect_separator(spark, path)
    df = S.read_csv(spark, path, schema=TAXI_SCHEMA, sep=sep)
    S.check_separator(df, "taxi", sep)
    S.require_columns(df, ["VendorID", "pickup", "passenger_count", "total_amount"], "taxi", exact=True)
    return df


DOC_SCHEMA = StructType([StructField("customer_id", LongType()), StructField("name", StringType()),
                         StructField("city", StringType()), StructField("segment", StringType()),
                         StructField("test_user", StringType())])


PER_ARRAY = 5_000        # documents in one array file


@query("src10_json_array_documents", sql="""
    SELECT c_custkey AS customer_id, c_name AS name, n_name AS city, c_mktsegment AS segment,
           CASE WHEN c_acctbal < 0 THEN 'true' END AS test_user
    FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def _(spark, sf):
    """Files that each hold one JSON array of documents (``multiLine``).
    Every ``PER_ARRAY`` consecutive customer ids share a file (``[``, documents
    joined by ``,``, ``]``), so an array is bounded at any table size."""
    t = Tables(spark, sf)
    c = m.customers(t).select("customer_id", F.col("customer_name").alias("name"),
                              F.col("state").alias("city"), "segment",
                              F.when(F.col("acctbal") < 0, F.lit(True)).alias("test_user"))
    docs = c.select(F.to_json(F.struct("*")).alias("d"), F.floor(F.col("customer_id") / PER_ARRAY).alias("b"))
    path = fresh(spark, "src10")
    arr = (docs.groupBy("b").agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("d")), F.lit("]"))
                             .alias("value")))
    arr.write.mode("overwrite").partitionBy("b").text(path)
    out = S.read_json_documents(spark, path, schema=DOC_SCHEMA, multiline=True)
    return out.select(*DOC_SCHEMA.fieldNames())


_PAYLOAD_REC = StructType([StructField("id", LongType()), StructField("fecha", StringType()),
                           StructField("meta", StructType([StructField("region", StringType()),
                                                           StructField("valor", DoubleType())]))])


@query("src11_api_payload_unwrap_flatten", sql="""
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS fecha, event_type AS "meta.region",
           value AS "meta.valor" FROM events""")
def _(spark, sf):
    """API responses with records under ``data``, under ``result`` or as a
    bare list are unwrapped, then nested fields are flattened to dotted
    columns. A payload holds the records of 50 consecutive ids; some have
    an empty ``data`` beside a full ``result``."""
    e = Tables(spark, sf).events
    rec = F.to_json(F.struct(F.col("event_id").alias("id"),
                             F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("fecha"),
                             F.struct(F.col("event_type").alias("region"),
                                      F.col("value").alias("valor")).alias("meta")))
    page = (e.groupBy(F.floor(F.col("event_id") / 50).alias("page"))
            .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list(rec)), F.lit("]")).alias("arr")))
    payload = (F.when(F.col("page") % 4 == 0, F.concat(F.lit('{"data": '), "arr", F.lit("}")))
               .when(F.col("page") % 4 == 1, F.concat(F.lit('{"result": '), "arr", F.lit("}")))
               .when(F.col("page") % 4 == 2, F.concat(F.lit('{"data": [], "result": '), "arr", F.lit("}")))
               .otherwise(F.col("arr")))
    raw = page.select(payload.alias("body"))
    return D.flatten(D.unwrap_payload(raw, "body", _PAYLOAD_REC))


@query("src12_time_column_inference", sql="""
    SELECT ts AS fecha, event_type AS region, value AS valor FROM events""")
def _(spark, sf):
    """The time column is found by name (``ts`` here) and standardised."""
    e = Tables(spark, sf).events.select("event_type", "value", "ts")
    tc = S.find_time_column(e)
    return e.select(F.col(tc).alias("fecha"), F.col("event_type").alias("region"),
                    F.col("value").alias("valor"))


@query("src13_recursive_parquet_tree", sql="""
    SELECT event_id, ts, event_type, value, CAST(year(ts) AS INTEGER) AS year,
           CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events""")
def _(spark, sf):
    """A year/month/day parquet tree read back with partition discovery."""
    path = fresh(spark, "src13")
    write_by_day(Tables(spark, sf).events.select("event_id", "ts", "event_type", "value"), path, "ts")
    return S.read_parquet_tree(spark, path)


LOAD_ORDER = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem"]


@query("src14_bulk_load_dependency_order", sql="""
    SELECT * FROM (VALUES ('region', 1, (SELECT count(*) FROM region)),
                          ('nation', 2, (SELECT count(*) FROM nation)),
                          ('supplier', 3, (SELECT count(*) FROM supplier)),
                          ('customer', 4, (SELECT count(*) FROM customer)),
                          ('part', 5, (SELECT count(*) FROM part)),
                          ('orders', 6, (SELECT count(*) FROM orders)),
                          ('lineitem', 7, (SELECT count(*) FROM lineitem)))
        AS t(table_name, load_step, row_count)""")
def _(spark, sf):
    """Load the tables as CSV in dependency order (parents before children),
    then report the loaded row count per table — one job for all counts."""
    t = Tables(spark, sf)
    base = fresh(spark, "src14")
    parts = []
    for step, name in enumerate(LOAD_ORDER, 1):
        df = getattr(t, name)
        write_csv(df, f"{base}/{name}")
        back = S.read_csv(spark, f"{base}/{name}", schema=df.schema)
        parts.append(back.agg(F.lit(name).alias("table_name"), F.lit(step).alias("load_step"),
                              F.count(F.lit(1)).alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("src15_external_table_partition_repair", sql="""
    SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1""")
def _(spark, sf):
    """Files land under ``dt=`` folders; an external partitioned table over
    them only sees new partitions after ``MSCK REPAIR TABLE``."""
    path = fresh(spark, "src15")
    e = Tables(spark, sf).events.select("event_id", "value", F.to_date("ts").alias("dt"))
    name = "ext_events_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE TABLE {name} (event_id BIGINT, value DOUBLE, dt DATE) "
              f"USING parquet PARTITIONED BY (dt) LOCATION '{path}'")
    e.hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(path)
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("src18_lookup_csv_broadcast", ctes=("e_customers",), sql="""
    SELECT c.customer_id, c.state, r.r_name AS region_name
    FROM e_customers c JOIN nation n ON n.n_name = c.state JOIN region r ON r.r_regionkey = n.n_regionkey""")
def _(spark, sf):
    """A code→label lookup CSV; Spark broadcasts it from its measured size and
    joins by shuffle beyond the threshold."""
    t = Tables(spark, sf)
    look = (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("state"), F.col("r_name").alias("region_name")))
    path = fresh(spark, "src18")
    write_csv(look, path)
    lk = S.read_csv(spark, path, schema="state STRING, region_name STRING")
    return m.customers(t).join(lk, "state").select(
        "customer_id", "state", "region_name")


@query("src19_heterogeneous_monthly_files", sql="""
    SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
           CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status
    FROM orders""")
def _(spark, sf):
    """Monthly files that drift: one uses ``id;monto;fecha`` with decimal
    commas in Latin-1, the other ``order_id,amount,order_date,status``. Both
    are harmonised to one schema."""
    o = Tables(spark, sf).orders
    odd = F.col("o_orderkey") % 2 == 1
    a = o.where(odd).select(F.col("o_orderkey").alias("id"),
                            F.regexp_replace(F.format_number("o_totalprice", 2), ",", "")
                            .alias("_m"), F.to_date("o_orderdate").alias("fecha"),
                            F.col("o_orderstatus").alias("estado"))
    a = a.withColumn("monto", F.regexp_replace("_m", r"\.", ",")).drop("_m")
    b = o.where(~odd).select(F.col("o_orderkey").alias("order_id"),
                             F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
                             F.to_date("o_orderdate").alias("order_date"),
                             F.col("o_orderstatus").alias("status"))
    pa, pb = fresh(spark, "src19a"), fresh(spark, "src19b")
    a.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(pa)
    write_csv(b, pb)
    fa = S.read_csv(spark, pa, sep=";", encoding="ISO-8859-1")
    fb = S.read_csv(spark, pb)
    return S.harmonise([fa, fb],
                       rename={"id": "order_id", "monto": "amount", "fecha": "order_date",
                               "estado": "status"},
                       decimal_comma=["amount"],
                       casts={"order_id": "bigint", "amount": "decimal(18,2)", "order_date": "date"}
                       ).select("order_id", "amount", "order_date", "status")


@query("src05_wrong_separator_guard", sql="""
    SELECT 'taxi' AS dataset, ',' AS sep_tried, '|' AS sep_in_header, TRUE AS rejected,
           CAST(count(*) AS BIGINT) AS rows_after_fix FROM orders""")
def _(spark, sf):
    """A '|' file read with ',' yields one column whose name holds '|': the
    guard rejects it; re-read with the right separator."""
    path = fresh(spark, "src05")
    write_csv(_taxi(Tables(spark, sf)), path, sep="|")
    wrong = S.read_csv(spark, path, sep=",")
    try:
        S.check_separator(wrong, "taxi", ",")
        rejected = False
    except S.InputContractError:
        rejected = True
    fixed = S.read_csv(spark, path, schema=TAXI_SCHEMA, sep="|")
    return fixed.agg(F.lit("taxi").alias("dataset"), F.lit(",").alias("sep_tried"),
                     F.lit("|").alias("sep_in_header"), F.lit(rejected).alias("rejected"),
                     F.count(F.lit(1)).alias("rows_after_fix"))


@query("src06_required_columns_guard", sql="""
    SELECT 'customers' AS dataset, 'segment' AS missing, CAST(count(*) AS BIGINT) AS rows_read FROM customer""")
def _(spark, sf):
    """The header contract: a file lacking a required column is rejected with
    the name of the missing column."""
    path = fresh(spark, "src06")
    write_csv(_customers_flat(Tables(spark, sf)).drop("segment"), path)
    df = S.read_csv(spark, path)
    missing = ""
    try:
        S.require_columns(df, ["customer_id", "name", "acctbal", "segment"], "customers")
    except S.InputContractError as e:
        missing = str(e).split("[")[1].split("]")[0].strip("'")
    return df.agg(F.lit("customers").alias("dataset"), F.lit(missing).alias("missing"),
                  F.count(F.lit(1)).alias("rows_read"))


RELATIONAL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def full_load(t: Tables, base: str) -> None:
    """Full load of the relational tables into ``parquet_<table>`` folders (the
    migration task). The source here is the table files; against a database
    the same loop reads each table with ``files.read_jdbc`` (parallel range
    reads on the key)."""
    for name in RELATIONAL:
        getattr(t, name).write.mode("overwrite").parquet(f"{base}/parquet_{name}")


@query("src16_full_load_to_parquet", sql="""
    SELECT * FROM (VALUES ('parquet_region', (SELECT count(*) FROM region), (SELECT CAST(sum(r_regionkey) AS BIGINT) FROM region)),
                          ('parquet_nation', (SELECT count(*) FROM nation), (SELECT CAST(sum(n_nationkey) AS BIGINT) FROM nation)),
                          ('parquet_customer', (SELECT count(*) FROM customer), (SELECT CAST(sum(c_custkey) AS BIGINT) FROM customer)),
                          ('parquet_supplier', (SELECT count(*) FROM supplier), (SELECT CAST(sum(s_suppkey) AS BIGINT) FROM supplier)),
                          ('parquet_part', (SELECT count(*) FROM part), (SELECT CAST(sum(p_partkey) AS BIGINT) FROM part)),
                          ('parquet_orders', (SELECT count(*) FROM orders), (SELECT CAST(sum(o_orderkey) AS BIGINT) FROM orders)),
                          ('parquet_lineitem', (SELECT count(*) FROM lineitem), (SELECT CAST(sum(l_orderkey) AS BIGINT) FROM lineitem)))
        AS t(target, row_count, key_sum)""")
def _(spark, sf):
    """Rows and key totals of the written copies of all relational tables."""
    base = fresh(spark, "src16")
    full_load(Tables(spark, sf), base)
    copies = [(name, spark.read.parquet(f"{base}/parquet_{name}")) for name in RELATIONAL]
    parts = [c.agg(F.lit(f"parquet_{name}").alias("target"), F.count(F.lit(1)).alias("row_count"),
                   F.sum(c.columns[0]).alias("key_sum")) for name, c in copies]
    return functools.reduce(DataFrame.unionByName, parts)


@query("src09_range_generated_rows", sql="""
    SELECT CAST(k AS BIGINT) AS order_id
    FROM (SELECT unnest(generate_series((SELECT min(o_orderkey) FROM orders),
                                        (SELECT max(o_orderkey) FROM orders))) AS k)
    WHERE k NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, sf):
    """Rows generated in the cluster with ``spark.range`` (no driver-side
    list): every key between the smallest and largest order key, anti-joined
    with the order lines, gives the order keys that have no lines. Only the
    two bounds reach the driver."""
    t = Tables(spark, sf)
    lo, hi = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    keys = spark.range(lo, hi + 1).withColumnRenamed("id", "order_id")
    return keys.join(t.lineitem.select(F.col("l_orderkey").alias("order_id")), "order_id", "left_anti")
