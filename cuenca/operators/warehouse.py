"""Warehouse operators: slowly changing dimensions, surrogate keys, change
data capture, snapshot audit, retention, outliers, cancellation batches.

Without a table format that supports MERGE, every change is a rewrite:
the new version of a table is computed from (current, changes) with joins
and unions and written to a new location, never over the path being read.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cuenca.operators.analytics import exact_percentile, global_sequence
from cuenca.sinks import keyed, manifest

OPEN_END = "9999-12-31"


def _differs(cols: Sequence[str], a: str = "c", b: str = "n") -> Column:
    """Any tracked column changed (NULL-safe)."""
    conds = [~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def scd2(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], as_of) -> DataFrame:
    """Type-2 dimension update.

    ``dim`` has ``key, tracked…, effective_date, expiration_date, is_current``;
    ``incoming`` is the new snapshot (``key, tracked…``); of a key that it
    repeats, the greatest row by ``tracked`` counts. NULL is a key like any
    other. Result = history rows + current rows unchanged + current rows closed at ``as_of`` + new
    versions opened at ``as_of`` + brand-new keys. One full outer join of the
    current rows with the snapshot; each joined row emits its one or two
    output versions through an array + explode, so the join runs once (no
    MERGE needed)."""
    as_of = F.lit(as_of).cast("date")
    open_end = F.lit(OPEN_END).cast("date")
    history = dim.where(~F.col("is_current"))
    cols = [key] + list(tracked)
    cur = dim.where(F.col("is_current")).withColumn("_there", F.lit(True)).alias("c")
    versions = F.struct(*[F.struct(F.col(c).isNotNull(), F.col(c)) for c in tracked])   # NULL is least
    one = incoming.groupBy(key).agg(F.max_by(F.struct(*tracked), versions).alias("_v")).select(
        key, *[F.col("_v")[c].alias(c) for c in tracked])
    new = one.withColumn("_there", F.lit(True)).alias("n")
    j = cur.join(new, F.col(f"c.{key}").eqNullSafe(F.col(f"n.{key}")), "full_outer")
    has_c, has_n = F.col("c._there").isNotNull(), F.col("n._there").isNotNull()
    changed = has_c & has_n & _differs(tracked)

    def version(side, eff, exp, current):
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols], eff.alias("effective_date"),
                        exp.alias("expiration_date"), current.alias("is_current"))

    keep = F.when(has_c & ~changed, version("c", F.col("c.effective_date"),
                                            F.col("c.expiration_date"), F.col("c.is_current")))
    closed = F.when(changed, version("c", F.col("c.effective_date"), as_of, F.lit(False)))
    opened = F.when(changed | ~has_c, version("n", as_of, open_end, F.lit(True)))
    rows = j.select(F.explode(F.filter(F.array(keep, closed, opened), lambda v: v.isNotNull()))
                    .alias("v")).select("v.*")
    return history.select(rows.columns).unionByName(rows)


def scd2_initial(snapshot: DataFrame, effective) -> DataFrame:
    return snapshot.withColumns({"effective_date": F.lit(effective).cast("date"),
                                 "expiration_date": F.lit(OPEN_END).cast("date"),
                                 "is_current": F.lit(True)})


def with_surrogate_key(dim: DataFrame, natural_key: str, sk: str,
                       unknown: dict | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Surrogate keys in natural-key order (no single-partition window), plus the
    unknown member ``sk = -1`` for late/missing lookups.

    ``existing`` is the dimension's last load (``natural_key``, ``sk``): its
    members keep their keys and new ones are numbered from its highest key
    on, so facts loaded earlier stay right. Without it keys are 1..N."""
    if existing is None:
        out = global_sequence(dim, [natural_key], sk)
    else:
        known = existing.where(F.col(sk) > 0).select(F.col(natural_key).alias("_nk"), sk)
        kept = dim.join(known, F.col(natural_key).eqNullSafe(F.col("_nk"))).drop("_nk")
        top = known.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias("m")).first()["m"]
        new = dim.join(known, F.col(natural_key).eqNullSafe(F.col("_nk")), "left_anti")
        new = global_sequence(new, [natural_key], sk).withColumn(sk, (F.col(sk) + F.lit(top)).cast("long"))
        out = kept.select(*dim.columns, F.col(sk).cast("long").alias(sk)).unionByName(new)
    if unknown is not None:
        spark = dim.sparkSession
        row = spark.range(1).select(
            F.lit(-1).cast("long").alias(sk),
            *[F.lit(unknown.get(c)).cast(dim.schema[c].dataType).alias(c) for c in dim.columns])
        out = out.unionByName(row)
    return out


def lookup_sk(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str) -> DataFrame:
    """Replace a natural key by the dimension's surrogate key; unknown → -1."""
    d = dim.select(F.col(dim_key).alias("_nk"), F.col(sk))
    return (fact.join(d, fact[fact_key] == d["_nk"], "left").drop("_nk")
            .withColumn(sk, F.coalesce(F.col(sk), F.lit(-1).cast("long"))))


def cdc_apply(table: DataFrame, changes: DataFrame, key: str, op_col: str = "op",
              seq_col: str = "seq") -> DataFrame:
    """Apply an ordered change feed (I/U/D) to a table in one aggregation: the
    last change of a key is its row, or its end if it is a D. Stored rows are
    older than any change; changes without a number are older than numbered
    ones; of equal numbers the greater by (op, columns) counts. Rows without a
    key stay as they are, changes without one are left out.
    ``keyed.apply_changes`` does it to a stored table, bucket by bucket."""
    return keyed.apply_last_change(table, changes, [key], op_col, seq_col)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Audit rows ``(key, column, old_value, new_value)`` for every changed
    column between two snapshots (NULL-safe; inserts and deletes included).
    One full outer join; each joined row emits one row per changed column."""
    j = old.alias("a").join(new.alias("b"), F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    k = F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key)
    changes = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")),
                      F.struct(F.lit(c).alias("column"),
                               F.col(f"a.{c}").cast("string").alias("old_value"),
                               F.col(f"b.{c}").cast("string").alias("new_value")))
               for c in cols]
    return j.select(k, F.explode(F.filter(F.array(*changes), lambda x: x.isNotNull())).alias("d")) \
        .select(key, "d.*")


def audit_changes(old: DataFrame, new: DataFrame, key: str, col: str, changed_at,
                  carry: Sequence[str] = ()) -> DataFrame:
    """Audit rows ``(key, carry…, old_<col>, new_<col>, changed_at)`` for the
    rows whose ``col`` changed between two snapshots (NULL-safe) — what an
    update trigger would have logged."""
    j = old.alias("a").join(new.alias("b"), key)
    return j.where(~F.col(f"a.{col}").eqNullSafe(F.col(f"b.{col}"))).select(
        key, *[F.col(f"a.{c}").alias(c) for c in carry], F.col(f"a.{col}").alias(f"old_{col}"),
        F.col(f"b.{col}").alias(f"new_{col}"), F.lit(changed_at).cast("timestamp_ntz").alias("changed_at"))


def retain(df: DataFrame, ts_col: str, ref_date: str, days: int | None = None,
           months: int | None = None) -> DataFrame:
    """Keep rows newer than ``ref_date`` minus the retention period (a
    partition-column predicate prunes whole partitions)."""
    ref = F.lit(ref_date).cast("date")
    cutoff = F.date_sub(ref, days) if days is not None else F.add_months(ref, -int(months))
    return df.where(F.col(ts_col) >= cutoff)


def treat_outliers(df: DataFrame, col: str, p: float = 0.99, how: str = "flag", threshold: float | None = None) -> DataFrame:
    """drop / flag / cap values above the p-th percentile; a NULL is no outlier:
    it is kept, its flag and cap are NULL. The exact percentile is computed
    before the frame is built, unless a ``threshold`` from an earlier call of
    ``exact_percentile`` is given."""
    thr = F.lit(exact_percentile(df, col, p) if threshold is None else threshold).cast("double")
    v = F.col(col).cast("double")
    if how == "drop":
        return df.where(v.isNull() | (v <= thr))
    if how == "flag":
        return df.withColumn("is_outlier", v > thr)
    if how == "cap":
        return df.withColumn(col + "_capped", F.when(v.isNotNull(), F.least(v, thr)))
    raise ValueError(how)


def cancel_orders(orders: DataFrame, payments: DataFrame, cancellations: DataFrame,
                  key: str = "order_id", ts=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The cancellation unit as a batch: (orders with status 'canceled',
    payments zeroed, audit rows). The three outputs are derived from the same
    cancellations table and published together by the caller."""
    c = cancellations.select(key).distinct().withColumn("_cancel", F.lit(True))
    o = orders.join(c, key, "left")
    new_orders = o.withColumn("status", F.when(F.col("_cancel"), F.lit("canceled"))
                              .otherwise(F.col("status"))).drop("_cancel")
    p = payments.join(c, key, "left")
    new_pay = p.withColumn("payment_value", F.when(F.col("_cancel"), F.lit(0).cast(
        payments.schema["payment_value"].dataType)).otherwise(F.col("payment_value"))).drop("_cancel")
    audit = o.where(F.col("_cancel")).select(key, F.col("status").alias("old_status"),
                                             F.lit("canceled").alias("new_status"))
    return new_orders, new_pay, audit


def refresh_partitions(source: DataFrame, aggregate, path: str, partition_col: str,
                       changed: DataFrame) -> None:
    """Incremental refresh of a partitioned aggregate table (the continuous
    aggregate / "delete the day range and reload" of the course): the
    partitions listed in ``changed`` (one column ``partition_col``) are
    recomputed from ``source`` and take the place of the old ones in one step; a
    listed partition without source rows any more is gone. Every other one
    keeps its files. Read it with ``manifest.read_table``."""
    listed = changed.select(partition_col).distinct()
    part = source.join(listed, partition_col, "left_semi")
    manifest.replace_partitions(aggregate(part), path, [partition_col], replaces=listed)
