"""Window analytics that stay correct and parallel when one key is huge.

Plain ``Window.partitionBy(key)`` puts every row of a key in one task. The
helpers below use the plain window where the partitions are bounded (small
aggregates, top-k with a partial limit) and a two-level form where a key can
hold a third of the data: running totals, LAG, RANK/DENSE_RANK and global
sequence numbers work per (key, bucket) plus small per-bucket offsets, and
exact percentiles run over (key, value) counts.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cuenca.session import checkpoint_dir, materialize


def _cols(cs) -> list:
    return [cs] if isinstance(cs, (str, Column)) else list(cs)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which NULL keys match NULL keys, so rows with a NULL key
    find their group's offsets as a plain window would."""
    r = right.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in right.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & left[c].eqNullSafe(F.col(f"_on_{c}"))
    return left.join(r, cond, how).drop(*[f"_on_{c}" for c in on])


def top_n_per_group(df: DataFrame, keys, order: Sequence[Column], n: int,
                    rank_fn=F.row_number, rank_col: str = "rn") -> DataFrame:
    """Rows ranked ≤ n per group. Catalyst plans a partial WindowGroupLimit
    before the shuffle, so a hot group ships at most n rows per task."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(rank_col, rank_fn().over(w)).where(F.col(rank_col) <= n)


def first_per_key(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order (ROW_NUMBER() = 1)."""
    return top_n_per_group(df, keys, order, 1).drop("rn")


def latest_per_key(df: DataFrame, keys, ts_col: str, tie: str) -> DataFrame:
    """Latest version of each key (newest ``ts_col``, then highest ``tie``)."""
    return first_per_key(df, keys, [F.desc(ts_col), F.desc(tie)])


def running_sum(df: DataFrame, keys, order: Sequence[str], value: str, bucket: Column,
                out: str = "cum", prev_out: str | None = None) -> DataFrame:
    """Running total of ``value`` per key in ``order``, skew-proof.

    ``bucket`` must be non-decreasing along ``order`` (e.g. the day of the
    timestamp). Level 1: a window per (key, bucket), so one hot key spreads
    over as many tasks as it has buckets. Level 2: per-bucket totals, prefix
    summed per key (one row per bucket), joined back as an offset. Exact for
    DECIMAL/integer values. ``prev_out`` adds the running total before the row
    (LAG of the cumulative column).
    """
    keys = _cols(keys)
    d = df.withColumn("_bkt", bucket)
    w_local = (Window.partitionBy(*keys, "_bkt").orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d.withColumn("_cum_local", F.sum(value).over(w_local))
    totals = d.groupBy(*keys, "_bkt").agg(F.sum(value).alias("_btot"))
    w_off = (Window.partitionBy(*keys).orderBy("_bkt")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_btot").over(w_off),
                                                   F.lit(0).cast(totals.schema["_btot"].dataType)))
    j = join_null_safe(local, offsets.drop("_btot"), keys + ["_bkt"])
    j = j.withColumn(out, F.col("_off") + F.col("_cum_local"))
    if prev_out:
        j = j.withColumn(prev_out, F.col(out) - F.col(value))
    return j.drop("_bkt", "_cum_local", "_off")


def moving_sum(df: DataFrame, order: str, value: str, rows: int, out: str,
               keys=None) -> DataFrame:
    """Sum over the current and the ``rows - 1`` preceding rows."""
    w = Window.orderBy(order) if not keys else Window.partitionBy(*_cols(keys)).orderBy(order)
    return df.withColumn(out, F.sum(value).over(w.rowsBetween(-(rows - 1), 0)))


def gap_days(df: DataFrame, keys, ts_col: str, tie: str, out: str = "gap_days") -> DataFrame:
    """Days since the previous row of the same key (NULL for the first)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(ts_col, tie)
    return df.withColumn(out, F.datediff(F.col(ts_col), F.lag(ts_col).over(w)))


def pct_change(df: DataFrame, order: str, value: str, out: str = "pct_change",
               keys=None, digits: int = 4) -> DataFrame:
    """Period-over-period % change; NULL for the first period and for a zero base."""
    w = Window.orderBy(order) if not keys else Window.partitionBy(*_cols(keys)).orderBy(order)
    prev = F.lag(F.col(value).cast("double")).over(w)
    return df.withColumn(out, F.round(
        F.try_divide((F.col(value).cast("double") - prev) * 100.0, F.nullif(prev, F.lit(0.0))),
        digits))


def global_sequence(df: DataFrame, order: Sequence[str], out: str = "seq",
                    num_partitions: int | None = None, expensive_input: bool = False) -> DataFrame:
    """Dense 1..N sequence over a total order, without a single-partition window.

    The rows are range-partitioned and sorted; ``monotonically_increasing_id``
    numbers rows inside each partition; a per-partition count (one row per
    partition: a proven size bound) is prefix-summed and broadcast as the
    partition offset. The numbered rows are checkpointed once to the shared
    checkpoint folder (reliable checkpoint, lineage cut), so the counts and
    the numbering read the very same (partition, id) values even if an
    executor is lost.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if expensive_input:
        # range partitioning samples its input in a separate job; write an
        # expensive input once so the sample and the shuffle read the table
        df = materialize(df)
    checkpoint_dir(spark)
    s = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (s.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(out, F.col("_off") + local + 1)
            .drop("_pid", "_mid", "_off"))


def join_hot(rows: DataFrame, table: DataFrame, on: Sequence[str], count: str, total: int) -> DataFrame:
    """Inner null-safe join of ``rows`` with ``table``, which has one row per key
    ``on`` and in ``count`` the number of rows that have that key; ``total`` is
    the number of ``rows``.

    Keys that hold more than a quarter of a partition's share of the rows are
    few (four times the partitions at most): those are broadcast, so a hot
    key's rows stay where they are; the others are shuffled, none of them hot."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col(count) * 4 * parts > total
    more = [c for c in table.columns if c not in on]
    right = table.select(*[F.col(c).alias(f"_on_{c}") for c in on], F.struct(*more).alias("_m"), hot.alias("_hot"))
    cond = F.lit(True)
    for c in on:
        cond = cond & rows[c].eqNullSafe(F.col(f"_on_{c}"))
    few = F.broadcast(right.where("_hot"))          # 4 * parts rows at most
    # the rows without a hot key go on to a plain join with the other keys
    found = rows.join(few, cond).select(*[rows[c] for c in rows.columns], "_m.*")
    others = rows.join(few, cond, "left_anti")
    cold = others.join(right.where(~F.col("_hot")), cond).select(*[rows[c] for c in rows.columns], "_m.*")
    return found.unionByName(cold)


def rank_within(df: DataFrame, keys, value: str, out: str = "rnk", dense_out: str | None = None,
                n_buckets: int | None = None) -> DataFrame:
    """RANK (and DENSE_RANK) by ``value`` descending within ``keys``, without
    putting a key, or the rows of one value, in one task.

    The distinct (key, value) pairs are counted (partial aggregation), range-
    partitioned into ``n_buckets`` ranges and prefix-summed inside each; a key that
    spans ranges takes over the sums of its earlier ranges (one row per
    range and key). A value's rank is one more than the rows above it, its dense rank
    one more than the values above it. The ranks are joined to the rows with
    ``join_hot``, so a value that holds a third of the rows is not moved at all."""
    keys = _cols(keys)
    spark = df.sparkSession
    n = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col(value).desc_nulls_last()]
    counts = materialize(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))   # read by the sample and the shuffle
    placed = materialize(counts.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    inside = Window.partitionBy("_part", *keys).orderBy(F.col(value).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({"_above": F.coalesce(F.sum("_n").over(inside), F.lit(0)),
                                "_values": F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0))})
    pieces = placed.groupBy("_part", *keys).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_distinct"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(pieces.select("_part", *keys, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_off"),
                                        F.coalesce(F.sum("_distinct").over(earlier), F.lit(0)).alias("_doff")))
    ranks = join_null_safe(local, offsets, ["_part", *keys]).select(
        *keys, value, F.col("_n").alias("_n"), (F.col("_off") + F.col("_above") + 1).cast("int").alias(out),
        *([(F.col("_doff") + F.col("_values") + 1).cast("int").alias(dense_out)] if dense_out else []))
    total = placed.agg(F.sum("_n")).first()[0] or 0
    return join_hot(df, ranks, [*keys, value], "_n", total).drop("_n")


def previous_within(df: DataFrame, keys, order: Sequence[str], col: str, bucket: Column,
                    out: str) -> DataFrame:
    """LAG(col) within ``keys`` in ``order``, skew-proof. ``bucket`` must be
    non-decreasing along ``order`` and ``col`` must be the first order
    column (e.g. a date). Inside a (key, bucket) window LAG is local; the
    first row of a bucket takes the last value of the key's previous bucket
    (one aggregate row per bucket)."""
    keys = _cols(keys)
    d = df.withColumn("_bkt", bucket)
    w = Window.partitionBy(*keys, "_bkt").orderBy(*order)
    d = d.withColumn("_lag", F.lag(col).over(w))
    last = d.groupBy(*keys, "_bkt").agg(F.max(col).alias("_last"))
    prev = Window.partitionBy(*keys).orderBy("_bkt")
    last = last.select(*keys, "_bkt", F.lag("_last").over(prev).alias("_prev_bucket_last"))
    return (join_null_safe(d, last, keys + ["_bkt"])
            .withColumn(out, F.coalesce("_lag", "_prev_bucket_last"))
            .drop("_bkt", "_lag", "_prev_bucket_last"))


def exact_percentile(df: DataFrame, value: str, p: float, few: int = 10_000, k: int = 1024,
                     error: float = 0.01) -> float | None:
    """Exact PERCENTILE_CONT of a whole column in two reads of ``df``, without
    gathering its values. NULL without values.

    The first read builds a mergeable KLL sketch, whose quantiles a little below
    and above ``p`` (by ``error``, several times the error of a sketch of size ``k``)
    bracket the wanted ranks. The second one counts the values below the bracket
    and each value inside it; these counts settle the ranks exactly. Should the
    bracket miss (a sketch is right with high probability only), the second
    read is made once more without bounds."""
    d = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    at = lambda x: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(min(max(x, 0.0), 1.0))))
    r = (d.agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", F.lit(k)).alias("s"))
         .select("n", at(p - error).alias("lo"), at(p + error).alias("hi")).first())
    if not r["n"]:
        return None
    h = p * (r["n"] - 1)
    low, high = int(h), min(int(h) + 1, r["n"] - 1)
    # 0 and 1 are the extremes themselves in the sketch, too
    lo, hi = (None if p <= error else r["lo"]), (None if p >= 1 - error else r["hi"])
    found = _at_ranks(d, lo, hi, (low, high), few)
    if found is None:
        found = _at_ranks(d, None, None, (low, high), few)
    return found[0] + (found[1] - found[0]) * (h - low)


def _at_ranks(d: DataFrame, lo: float | None, hi: float | None, ranks: Sequence[int], few: int):
    """The values at ``ranks`` (from 0) of the column ``v``; None if they are not
    between ``lo`` and ``hi``."""
    v = F.col("v")
    side = F.when(v < lo, -1) if lo is not None else F.when(F.lit(False), -1)
    side = (side.when(v > hi, 1) if hi is not None else side).otherwise(0)
    counts = materialize(d.groupBy(side.alias("side"), F.when(side == 0, v).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    ends = {x["side"]: x for x in counts.groupBy("side").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("values")).collect()}
    below = ends[-1]["n"] if -1 in ends else 0
    inside = ends.get(0)
    if inside is None or ranks[0] < below or ranks[-1] >= below + inside["n"]:
        return None
    part = counts.where("side = 0")
    if inside["values"] > few:
        # prefix sums over ranges of the counted values; the wanted ranks' rows alone go to the driver
        placed = materialize(part.repartitionByRange("v").withColumn("part", F.spark_partition_id()))
        sums = placed.groupBy("part").agg(F.sum("n").alias("rows"))                      # a row per range
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("off"))
        upto = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ended = placed.join(sums, "part").withColumn("upto", F.sum("n").over(upto) + F.col("off") + below)
        wanted = F.lit(False)
        for r in ranks:
            wanted = wanted | ((F.col("upto") > r) & (F.col("upto") - F.col("n") <= r))
        rows = [(x["v"], x["upto"]) for x in ended.where(wanted).orderBy("v").collect()]  # a row per rank
    else:
        rows, run = [], below
        for x in part.orderBy("v").collect():   # at most ``few`` rows
            run += x["n"]
            rows.append((x["v"], run))
    return [next(v for v, upto in rows if upto > r) for r in ranks]


def percentiles_from_counts(df: DataFrame, keys, value: str, ps: dict, counted: str | None = None) -> DataFrame:
    """Exact PERCENTILE_CONT per key for a value with a bounded domain
    (days, cents): rows are first counted per (key, value) with partial
    aggregation, then the interpolation runs over the distinct values only.
    Memory is bounded by the value domain, not by the rows of a key.
    ``ps`` maps output column → fraction; ``counted`` names a column of
    counts if ``df`` holds such rows already. Needs a key: for a whole
    column use ``exact_percentile``."""
    keys = _cols(keys)
    if not keys:
        raise ValueError("a percentile without keys would gather all values: use exact_percentile")
    one = F.sum(counted) if counted else F.count(F.lit(1))
    c = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(one.alias("_c"))
    w = Window.partitionBy(*keys).orderBy(value)
    c = (c.withColumn("_cum", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys))))
    aggs = []
    for name, p in ps.items():
        h = F.lit(p) * (F.col("_n") - 1)
        lo_i, hi_i = F.floor(h), F.ceil(h)
        aggs += [F.min(F.when(F.col("_cum") > lo_i, F.col(value))).alias(f"_{name}_lo"),
                 F.min(F.when(F.col("_cum") > hi_i, F.col(value))).alias(f"_{name}_hi"),
                 F.first(h - lo_i).alias(f"_{name}_f")]
    g = c.groupBy(*keys).agg(*aggs)
    for name in ps:
        lo, hi, fr = (F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double"),
                      F.col(f"_{name}_f"))
        g = g.withColumn(name, lo + (hi - lo) * fr)
    return g.select(*keys, *ps.keys())
