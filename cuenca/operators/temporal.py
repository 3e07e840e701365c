"""As-of joins: every row with the last state of its key at its time."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _bucket(ts: Column, unit: str) -> Column:
    return F.date_trunc(unit, ts.cast("timestamp"))


def asof_join(rows: DataFrame, states: DataFrame, key: str, ts: str, state_ts: str, values: Sequence[str],
              unit: str = "day", how: str = "inner") -> DataFrame:
    """``rows`` with ``values`` of the last row of ``states`` of the same
    ``key`` whose ``state_ts`` is not after ``ts``.

    No row meets more than one state: rows and states are united and the state
    is carried forward inside each (key, ``unit`` of time), so a key that holds
    a third of the rows is spread over as many tasks as it has time buckets. The
    state at the start of a bucket is the last one of the key's earlier buckets
    (one aggregate row per bucket), joined on the same (key, bucket): the rows
    are shuffled once.

    Two states of one key and time: the greater ``values`` count. A NULL key
    or time has no state; ``how='left'`` keeps such rows, and those before the
    key's first state, with NULL values."""
    if how not in ("inner", "left"):
        raise ValueError(f"how is 'inner' or 'left', not {how!r}")
    known = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    state_type = F.struct(F.col(state_ts).alias("_at"), *values)
    none = F.lit(None).cast(states.select(state_type.alias("s")).schema["s"].dataType)
    left = rows.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.lit(1).alias("_kind"),
                       F.struct(*rows.columns).alias("_row"), none.alias("_state"))
    absent = F.lit(None).cast(left.schema["_row"].dataType)
    right = states.select(F.col(key).alias("_k"), F.col(state_ts).alias("_t"), F.lit(0).alias("_kind"),
                          absent.alias("_row"), state_type.alias("_state"))
    united = left.unionAll(right).where(known).withColumn("_b", _bucket(F.col("_t"), unit))

    # the last state of each bucket, carried into the key's later buckets
    pieces = united.groupBy("_k", "_b").agg(F.max("_state").alias("_last"))
    earlier = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select("_k", "_b", F.max("_last").over(earlier).alias("_before"))

    # states sort before rows of the same time, the greater of equal times last
    so_far = (Window.partitionBy("_k", "_b").orderBy("_t", "_kind", "_state")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = (united.withColumn("_here", F.last("_state", ignorenulls=True).over(so_far))
              .where("_kind = 1").join(carried, ["_k", "_b"])
              .withColumn("_s", F.coalesce("_here", "_before")))
    if how == "inner":
        filled = filled.where(F.col("_s").isNotNull())
    out = filled.select("_row.*", *[F.col("_s")[v].alias(v) for v in values])
    if how == "left":
        lost = left.where(~known).select("_row.*", *[F.lit(None).cast(states.schema[v].dataType).alias(v) for v in values])
        out = out.unionByName(lost)
    return out
