"""Stock balancing between stores: transfer orders from stores with stock
to stores with demand, per SKU, by priority.

Demand and supply are one table of ``entries``: (side, sku, store, season, qty,
code, priority), ``side`` being need or source. Two rules work on it:

* ``interval`` — the Spark job's formula: the entries of a side get cumulative
  ranges per SKU in priority order; a transfer is the overlap of a source
  range and a need range; self-transfers are dropped *after* matching.
  The overlaps are found with a sweep over the range boundaries (one sort
  per SKU, linear in its rows) instead of joining every source with every
  need of the SKU.
* ``greedy`` — the golden file's rule: needs in priority order take from
  sources in priority order, *skipping* the own store, until the need or the
  stock runs out. It is sequential inside a SKU, so a SKU's needs are folded
  over the array of its remaining stock (SKUs in parallel; a SKU holds one
  row per store and season after aggregation, so its arrays are bounded).

A quantity that is no number counts as NULL, as in the course's job; such rows
take no part and ``rejects`` counts them. A store without a priorities row has priority 9999 and no short code. Entries
without a store keep their place in the cumulative ranges, as in the formula,
but nothing is shipped to or from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cuenca.functions.columns import clean_id, zero_pad
from cuenca.operators.analytics import global_sequence

SKU = "ID interno"
UNKNOWN_PRIORITY = 9999
SIDES = {"need": "prioridad_reposicion", "source": "prioridad_retiro"}


def _number(col: str):
    """The column as a double; NULL where it is no number."""
    return F.col(col).cast("string").try_cast("double")


def rejects(ventas: DataFrame, stock: DataFrame) -> DataFrame:
    """(input, column, rejected): quantities that are there but are no numbers."""
    out = None
    for name, df, col in (("ventas", ventas, "Cantidad Vendida"), ("stock", stock, "Stock disponible para la venta")):
        bad = df.agg(F.lit(name).alias("input"), F.lit(col).alias("column"),
                     F.count_if(F.col(col).isNotNull() & _number(col).isNull()).alias("rejected"))
        out = bad if out is None else out.unionByName(bad)
    return out


def entries(ventas: DataFrame, stock: DataFrame, prior: DataFrame, as_of: str, window_days: int) -> DataFrame:
    """Demand (sales of the window, per store, SKU and season) and supply (stock
    above zero, per store and SKU) with the priority of their side."""
    sold = _number("Cantidad Vendida")
    recent = F.try_to_date(F.col("Fecha").cast("string")) >= F.date_sub(F.lit(as_of).cast("date"), window_days)
    need = (ventas.where(recent)
            .groupBy(clean_id(SKU).alias("sku"), F.col("Sucursal").alias("store"), F.col("Temporada").alias("season"))
            .agg(F.sum(sold).alias("qty")).withColumn("side", F.lit("need")))
    source = stock.select(clean_id(SKU).alias("sku"), F.col("Sucursal").alias("store"), F.lit(None).cast("string").alias("season"),
                          _number("Stock disponible para la venta").alias("qty"), F.lit("source").alias("side"))
    both = need.unionByName(source).where((F.col("qty") > 0) & (F.length("sku") > 0))
    # one priorities row per store and side; the join is left to Spark's measured sizes
    ranks = prior.select(F.col("Sucursal").alias("store"), F.col("codigo_corto").alias("code"), F.explode(F.create_map(
        *[x for side, c in SIDES.items() for x in (F.lit(side), F.col(c).cast("string").try_cast("int"))])).alias("side", "priority"))
    return (both.join(ranks, ["store", "side"], "left")
            .withColumn("priority", F.coalesce("priority", F.lit(UNKNOWN_PRIORITY))))


def _ranged(rows: DataFrame) -> DataFrame:
    """Rank ``idx`` and cumulative range [lo, hi) of each entry on its side."""
    w = Window.partitionBy("sku", "side").orderBy("priority", "store", "season")
    hi = F.sum("qty").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumns({"idx": F.row_number().over(w), "hi": hi}).withColumn("lo", F.col("hi") - F.col("qty"))


def allocate_interval(rows: DataFrame, keep_self: bool = False) -> DataFrame:
    """Overlap of cumulative ranges, found by a boundary sweep per SKU.

    Every range starts at a boundary; between two boundaries exactly one
    source range and one need range are active: the last ones started. Each
    start carries its entry as ONE struct, so the sweep carries whole
    entries and a NULL attribute stays that entry's. Summing the elementary
    segments per (source, need) equals max(0, min(ends) − max(starts)) for
    every pair, without forming the pairs. The rows are shuffled once, by SKU;
    ranking, sweep and sums all run inside that partitioning."""
    r = _ranged(rows.repartition("sku"))
    entry = F.struct("idx", "store", "season", "code")
    is_source = F.col("side") == "source"
    whole = Window.partitionBy("sku")
    w = whole.orderBy("lo", F.when(is_source, F.col("idx")).asc_nulls_first(), F.when(~is_source, F.col("idx")).asc_nulls_first())
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = whole.orderBy("lo").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    swept = r.withColumns({
        "source": F.last(F.when(is_source, entry), ignorenulls=True).over(upto),
        "need": F.last(F.when(~is_source, entry), ignorenulls=True).over(upto), "next": F.lead("lo").over(w),
        "supply": F.max(F.when(is_source, F.col("hi"))).over(ends), "demand": F.max(F.when(~is_source, F.col("hi"))).over(ends)})
    # the last segment has no next start: ``least`` passes over the NULL
    length = F.least("next", "supply", "demand") - F.col("lo")
    alloc = (swept.where(F.col("source").isNotNull() & F.col("need").isNotNull() & (length > 0))
             .groupBy("sku", "source", "need").agg(F.sum(length).alias("CANTIDAD")))
    out = alloc.select(F.col("sku").alias(SKU), F.col("source.idx").alias("src_idx"), F.col("need.idx").alias("need_idx"),
                       F.col("source.store").alias("DESDE"), F.col("source.code").alias("orig_corto"),
                       F.col("need.store").alias("HACIA"), F.col("need.season").alias("Temporada"),
                       F.col("need.code").alias("dest_corto"), "CANTIDAD")
    return out if keep_self else out.where(F.col("DESDE") != F.col("HACIA"))


def allocate_greedy(rows: DataFrame) -> DataFrame:
    """Greedy skip-self allocation: a fold over a SKU's needs whose state is the
    stock that each source has left; for each need an inner fold over the
    sources carries what is still wanted. Built-in expressions only."""
    entry = F.struct("priority", "store", "season", "qty", "code")
    by_side = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, entry)))  # noqa: E731  NULLs are left out
    skus = rows.where(F.col("store").isNotNull()).groupBy("sku").agg(by_side("need").alias("needs"), by_side("source").alias("sources"))

    def take_from(need, left):
        """What a need takes from each source, in order."""
        offers = F.zip_with("sources", left, lambda s, q: F.when(s.store == need.store, F.lit(0.0)).otherwise(q))
        start = F.struct(need.qty.alias("want"), F.array().cast("array<double>").alias("takes"))

        def step(acc, offer):
            take = F.greatest(F.lit(0.0), F.least(offer, acc.want))
            return F.struct((acc.want - take).alias("want"), F.concat(acc.takes, F.array(take)).alias("takes"))
        return F.aggregate(offers, start, step, lambda acc: acc.takes)

    def fold(acc, need):
        takes = take_from(need, acc.left)
        # ``takes`` is used twice: it goes through a one-element array to be computed once
        return F.element_at(F.transform(F.array(takes), lambda t: F.struct(
            F.zip_with(acc.left, t, lambda q, x: q - x).alias("left"), F.concat(acc.all, F.array(t)).alias("all"))), 1)

    start = F.struct(F.transform("sources", lambda s: s.qty).alias("left"), F.array().cast("array<array<double>>").alias("all"))
    taken = skus.withColumn("takes", F.aggregate("needs", start, fold, lambda acc: acc.all))
    by_need = taken.select("sku", "needs", "sources", F.posexplode("takes").alias("need_rank", "row"))
    each = by_need.select("sku", "sources", "need_rank", F.element_at("needs", F.col("need_rank") + 1).alias("need"),
                          F.posexplode("row").alias("src_rank", "CANTIDAD")).where("CANTIDAD > 0")
    source = F.element_at("sources", F.col("src_rank") + 1)
    return each.select(F.col("sku").alias(SKU), "need_rank", "src_rank", F.col("need.season").alias("Temporada"),
                       F.col("need.store").alias("HACIA"), source.store.alias("DESDE"), F.col("need.code").alias("dest_corto"),
                       source.code.alias("orig_corto"), "CANTIDAD")


def transfer_orders(alloc: DataFrame, run_ts: str, order_cols: list[str]) -> DataFrame:
    """Final file rows with ``ID EXT OT = OT-<orig>-<dest>-<run_ts>-<seq 4>``;
    the sequence is global over ``order_cols`` (no single-partition window)."""
    # the allocation is costly: it is written once before it is sampled and numbered
    seq = global_sequence(alloc, order_cols, "seq", expensive_input=True)
    ext = F.concat(F.lit("OT-"), F.coalesce("orig_corto", F.lit("XXX")), F.lit("-"),
                   F.coalesce("dest_corto", F.lit("YYY")), F.lit("-"), F.lit(run_ts), F.lit("-"),
                   zero_pad("seq", 4))
    return seq.select(F.col("Temporada").alias("NOTA"), SKU, "HACIA", "DESDE",
                      F.col("CANTIDAD").cast("int").alias("CANTIDAD"), ext.alias("ID EXT OT"), "seq")


def balance(ventas: DataFrame, stock: DataFrame, prior: DataFrame, as_of: str,
            window_days: int = 15, mode: str = "greedy", run_ts: str | None = None) -> DataFrame:
    """Transfer orders for the silver inputs (``mode`` = greedy | interval)."""
    run_ts = run_ts or as_of.replace("-", "") + "_000000"
    rows = entries(ventas, stock, prior, as_of, window_days)
    if mode == "greedy":
        return transfer_orders(allocate_greedy(rows), run_ts, [SKU, "need_rank", "src_rank"])
    return transfer_orders(allocate_interval(rows), run_ts, [SKU, "DESDE", "HACIA", "need_idx", "src_idx"])


def balance_files(spark: SparkSession, ventas: str, stock: str, prior: str, out_dir: str, as_of: str,
                  run_ts: str, window_days: int = 15, mode: str = "greedy", sep: str = ",") -> str:
    """The job: three CSV files in, checked for separator and columns, and one
    ``;`` file of transfer orders out, named after the run. Returns its path."""
    from cuenca.sinks.writers import write_single_csv
    from cuenca.sources.files import check_separator, read_csv, require_columns
    frames = []
    for path, name, cols in ((ventas, "ventas", ["Fecha", "Sucursal", SKU, "Temporada", "Cantidad Vendida"]),
                             (stock, "stock", ["Sucursal", SKU, "Stock disponible para la venta"]),
                             (prior, "prioridades", ["Sucursal", "codigo_corto", *SIDES.values()])):
        df = read_csv(spark, path, sep=sep)
        check_separator(df, name, sep)
        require_columns(df, cols, name)
        frames.append(df)
    orders = balance(*frames, as_of, window_days, mode, run_ts)
    return write_single_csv(orders.withColumnRenamed("seq", "_seq"), out_dir, f"ordenes_traslado_netsuite_{run_ts}.csv", order=["_seq"])
