"""Stock balancing on the driver's
tables: stores are regions, SKUs are parts, seasons are return flags; demand
is open lines by the customer's region, stock is closed lines by the
supplier's region, priorities come from the region key."""

from __future__ import annotations

from pyspark.sql import functions as F

from cuenca.operators import balancing as B
from cuenca.plans import model as m
from cuenca.plans.registry import query
from cuenca.sources.tables import Tables

AS_OF = "2001-11-05"
WINDOW_DAYS = 1000
RUN_TS = "20011105_000000"


def silver_inputs(t: Tables):
    geo = (m.nation_b(t).join(m.region_b(t), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "r_name"))
    cust = t.customer.join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("r_name").alias("Sucursal"))
    supp = t.supplier.join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("r_name").alias("Sucursal"))
    li = t.lineitem
    order_store = (t.orders.select("o_orderkey", "o_custkey")
                   .join(cust, F.col("o_custkey") == F.col("c_custkey"))
                   .select("o_orderkey", "Sucursal"))          # order grain first
    ventas = (li.where(F.col("l_linestatus") == "O")
              .join(order_store, F.col("l_orderkey") == F.col("o_orderkey"))
              .select(F.to_date("l_shipdate").alias("Fecha"), "Sucursal",
                      F.col("l_partkey").cast("string").alias(B.SKU),
                      F.col("l_returnflag").alias("Temporada"),
                      F.col("l_quantity").alias("Cantidad Vendida")))
    stock = (li.where(F.col("l_linestatus") == "F")
             .join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
             .groupBy("Sucursal", F.col("l_partkey").cast("string").alias(B.SKU))
             .agg(F.sum("l_quantity").alias("Stock disponible para la venta")))
    prior = t.region.select(F.col("r_name").alias("Sucursal"),
                            F.substring("r_name", 1, 3).alias("codigo_corto"),
                            (F.col("r_regionkey") + 1).alias("prioridad_reposicion"),
                            (5 - F.col("r_regionkey")).alias("prioridad_retiro"))
    return ventas, stock, prior


_INPUTS_SQL = f"""
    ventas AS (
        SELECT CAST(l_shipdate AS DATE) AS fecha, r_name AS sucursal, CAST(l_partkey AS VARCHAR) AS sku,
               l_returnflag AS temporada, l_quantity AS cant
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE l_linestatus = 'O'),
    stock AS (
        SELECT r_name AS sucursal, CAST(l_partkey AS VARCHAR) AS sku, sum(l_quantity) AS stock
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
        JOIN region ON r_regionkey = n_regionkey WHERE l_linestatus = 'F' GROUP BY 1, 2),
    prior AS (SELECT r_name AS sucursal, substr(r_name, 1, 3) AS corto, r_regionkey + 1 AS p_rep,
                     5 - r_regionkey AS p_ret FROM region),
    needs AS (SELECT sucursal, sku, temporada, sum(cant) AS a_reponer FROM ventas
              WHERE fecha >= DATE '{AS_OF}' - INTERVAL {WINDOW_DAYS} DAY
              GROUP BY 1, 2, 3 HAVING sum(cant) > 0),
    n3 AS (SELECT n.*, coalesce(p.p_rep, 9999) AS p_rep, p.corto AS dest_corto,
                  row_number() OVER (PARTITION BY sku ORDER BY coalesce(p.p_rep, 9999), sucursal, temporada)
                      AS need_idx,
                  sum(a_reponer) OVER (PARTITION BY sku ORDER BY coalesce(p.p_rep, 9999), sucursal, temporada
                                       ROWS UNBOUNDED PRECEDING) AS need_cum
           FROM needs n LEFT JOIN prior p USING (sucursal)),
    s3 AS (SELECT s.*, p.corto AS orig_corto,
                  row_number() OVER (PARTITION BY sku ORDER BY coalesce(p.p_ret, 9999), sucursal) AS src_idx,
                  sum(stock) OVER (PARTITION BY sku ORDER BY coalesce(p.p_ret, 9999), sucursal
                                   ROWS UNBOUNDED PRECEDING) AS src_cum
           FROM stock s LEFT JOIN prior p USING (sucursal) WHERE stock > 0),
    pairs AS (SELECT n3.sku, s3.sucursal AS desde, s3.orig_corto, n3.sucursal AS hacia, n3.temporada,
                     n3.dest_corto, need_idx, src_idx,
                     greatest(0, least(src_cum, need_cum) - greatest(src_cum - stock, need_cum - a_reponer))
                         AS cantidad
              FROM s3 JOIN n3 USING (sku))"""


@query("pip05_balancing_interval", sql=f"""
    WITH {_INPUTS_SQL},
    alloc AS (SELECT *, row_number() OVER (ORDER BY sku, desde, hacia, need_idx, src_idx) AS seq
              FROM pairs WHERE cantidad > 0 AND desde <> hacia)
    SELECT temporada AS "NOTA", sku AS "ID interno", hacia AS "HACIA", desde AS "DESDE",
           CAST(cantidad AS INTEGER) AS "CANTIDAD",
           'OT-' || coalesce(orig_corto, 'XXX') || '-' || coalesce(dest_corto, 'YYY') || '-{RUN_TS}-'
               || CASE WHEN length(CAST(seq AS VARCHAR)) >= 4 THEN CAST(seq AS VARCHAR)
                       ELSE lpad(CAST(seq AS VARCHAR), 4, '0') END AS "ID EXT OT",
           seq
    FROM alloc""")
def _(spark, sf):
    """Cumulative-interval matching (the Spark job's formula), self-transfers
    dropped after matching, global sequence ids."""
    v, s, p = silver_inputs(Tables(spark, sf))
    return B.balance(v, s, p, AS_OF, WINDOW_DAYS, mode="interval", run_ts=RUN_TS)


@query("joi08_interval_overlap_join", sql=f"""
    WITH {_INPUTS_SQL}
    SELECT sku AS "ID interno", CAST(src_idx AS INTEGER) AS src_idx, CAST(need_idx AS INTEGER) AS need_idx,
           desde AS "DESDE", hacia AS "HACIA", cantidad AS "CANTIDAD"
    FROM pairs WHERE cantidad > 0""")
def _(spark, sf):
    """Equi key (SKU) + overlap of cumulative ranges, self pairs kept: the
    interval join, computed by a boundary sweep instead of all pairs."""
    v, s, p = silver_inputs(Tables(spark, sf))
    a = B.allocate_interval(B.entries(v, s, p, AS_OF, WINDOW_DAYS), keep_self=True)
    return a.select(B.SKU, "src_idx", "need_idx", "DESDE", "HACIA", "CANTIDAD")


# The greedy rule as a recursive SQL oracle: per SKU, the remaining stock of
# the sources (in priority order) is a list; each step takes the next need
# and fills it from the sources in order, skipping the need's own store:
# take_i = max(0, min(eligible_i, want - sum of eligible before i)).
_GREEDY_SQL = f"""
    WITH RECURSIVE {_INPUTS_SQL},
    n3g AS (SELECT n.sku, n.sucursal, n.temporada, n.a_reponer, p.corto AS dest_corto,
                   row_number() OVER (PARTITION BY n.sku ORDER BY coalesce(p.p_rep, 9999), n.sucursal, n.temporada)
                       AS need_idx
            FROM needs n LEFT JOIN prior p USING (sucursal)),
    sl AS (SELECT s.sku,
                  list(s.sucursal ORDER BY coalesce(p.p_ret, 9999), s.sucursal) AS stores,
                  list(s.stock ORDER BY coalesce(p.p_ret, 9999), s.sucursal) AS stock0,
                  list(p.corto ORDER BY coalesce(p.p_ret, 9999), s.sucursal) AS codes
           FROM stock s LEFT JOIN prior p USING (sucursal) WHERE s.stock > 0 GROUP BY s.sku),
    rec AS (
        SELECT sku, 0 AS k, stock0 AS lft, stores, codes, CAST([] AS DOUBLE[]) AS takes,
               CAST(NULL AS VARCHAR) AS hacia, CAST(NULL AS VARCHAR) AS temporada,
               CAST(NULL AS VARCHAR) AS dest_corto
        FROM sl
        UNION ALL
        SELECT sku, k, list_transform(range(1, len(lft) + 1), lambda i: lft[i] - takes[i]) AS lft,
               stores, codes, takes, hacia, temporada, dest_corto
        FROM (SELECT r.sku, r.k + 1 AS k, r.lft, r.stores, r.codes, n.sucursal AS hacia, n.temporada,
                     n.dest_corto,
                     list_transform(range(1, len(r.lft) + 1), lambda i: greatest(0.0, least(
                         CASE WHEN r.stores[i] = n.sucursal THEN 0.0 ELSE r.lft[i] END,
                         n.a_reponer - coalesce(list_sum(list_transform(range(1, i), lambda j:
                             CASE WHEN r.stores[j] = n.sucursal THEN 0.0 ELSE r.lft[j] END)), 0.0))))
                         AS takes
              FROM rec r JOIN n3g n ON n.sku = r.sku AND n.need_idx = r.k + 1)),
    exploded AS (SELECT sku, k, hacia, temporada, dest_corto, stores, codes, takes,
                        unnest(range(1, len(takes) + 1)) AS i
                 FROM rec WHERE k > 0),
    alloc AS (SELECT sku, CAST(k - 1 AS INTEGER) AS need_rank, CAST(i - 1 AS INTEGER) AS src_rank,
                     temporada, hacia, stores[i] AS desde, dest_corto, codes[i] AS orig_corto,
                     takes[i] AS cantidad
              FROM exploded WHERE takes[i] > 0)"""


@query("udf03_grouped_allocation_per_sku", sql=_GREEDY_SQL + """
    SELECT sku AS "ID interno", need_rank, src_rank, temporada AS "Temporada", hacia AS "HACIA",
           desde AS "DESDE", dest_corto, orig_corto, cantidad AS "CANTIDAD"
    FROM alloc""")
def _(spark, sf):
    """The per-SKU sequential allocation on its own (a fold over each SKU's
    needs); raw allocations before numbering. The oracle replays the same greedy
    rule as a recursive query over a list of remaining stock per SKU."""
    v, s, p = silver_inputs(Tables(spark, sf))
    return B.allocate_greedy(B.entries(v, s, p, AS_OF, WINDOW_DAYS))


@query("pip06_balancing_greedy", sql=_GREEDY_SQL + f""",
    numbered AS (SELECT *, row_number() OVER (ORDER BY sku, need_rank, src_rank) AS seq FROM alloc)
    SELECT temporada AS "NOTA", sku AS "ID interno", hacia AS "HACIA", desde AS "DESDE",
           CAST(cantidad AS INTEGER) AS "CANTIDAD",
           'OT-' || coalesce(orig_corto, 'XXX') || '-' || coalesce(dest_corto, 'YYY') || '-{RUN_TS}-'
               || CASE WHEN length(CAST(seq AS VARCHAR)) >= 4 THEN CAST(seq AS VARCHAR)
                       ELSE lpad(CAST(seq AS VARCHAR), 4, '0') END AS "ID EXT OT",
           seq
    FROM numbered""")
def _(spark, sf):
    """Greedy skip-self allocation (the golden file's rule), sequential per
    SKU. Checked against the course's golden file in tests; the oracle is
    the recursive replay above."""
    v, s, p = silver_inputs(Tables(spark, sf))
    return B.balance(v, s, p, AS_OF, WINDOW_DAYS, mode="greedy", run_ts=RUN_TS)

