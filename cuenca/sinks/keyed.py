"""Keyed tables: merges that rewrite only the key buckets a delivery touches.

A keyed table is a manifest table (``sinks.manifest``) partitioned by the bucket
of its key's hash. A merge reads the buckets that hold keys of the delivery,
computes their rows anew and publishes them as the next version; all other
buckets keep their files.

Order of versions: a row replaces another of its key if its version is greater;
a NULL version is below all others. Of equal versions a delivered row is newer
than a stored one, and of two delivered ones the greater by its columns, in
order, counts. So every merge has one result, whatever the order of rows.

A NULL in the key names no row: stored and delivered rows with one are all kept,
and a change (``apply_changes``) without a key is left out.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cuenca.sinks import manifest as M

BUCKETS = 64


def version_order(cols: Sequence[str], version_col: str | None, delivered: Column | None = None) -> Column:
    """A never-NULL struct that orders the versions of a key."""
    parts = []
    if version_col is not None:
        parts += [F.col(version_col).isNotNull().alias("_known"), F.col(version_col).alias("_version")]
    if delivered is not None:
        parts.append(delivered.alias("_delivered"))
    # hashes of the text break ties alike everywhere, also for types that have no order
    return F.struct(*parts, *[F.to_json(F.struct(F.col(c).alias("v"))).alias(f"_tie{k}") for k, c in enumerate(cols)])


def has_key(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def latest(rows: DataFrame, keys: Sequence[str], version_col: str | None, delivered: Column | None = None) -> DataFrame:
    """One row per key, its greatest version, and all rows without a key. The
    aggregate is partial, so a key that holds a third of the rows ships one row
    per task."""
    other = [c for c in rows.columns if c not in keys]
    order = version_order(other, version_col, delivered)
    best = (rows.where(has_key(keys)).groupBy(*keys)
            .agg(F.max_by(F.struct(*[F.col(c) for c in other], F.lit(1).alias("_")), order).alias("_r")))
    return (best.select(*keys, *[F.col("_r")[c].alias(c) for c in other])
            .unionByName(rows.where(~has_key(keys))).select(*rows.columns))


def bucket(keys: Sequence[str], columns: Sequence[str], buckets: int) -> Column:
    """A key's bucket; rows without a key, however many, are spread by their other columns."""
    h = F.when(has_key(keys), F.xxhash64(*keys)).otherwise(F.xxhash64(*columns))
    return F.pmod(h, F.lit(buckets)).cast("int").alias("bucket")


def create(df: DataFrame, root: str, keys: Sequence[str], version_col: str | None = None, buckets: int = BUCKETS) -> str:
    """Publish ``df`` as a keyed table of one row per key."""
    one = latest(df, keys, version_col)
    return M.replace_partitions(one.withColumn("bucket", bucket(keys, one.columns, buckets)), root, ["bucket"],
                                base={"version": M.current(df.sparkSession, root)["version"],
                                      "partition_cols": None, "schema": None, "live": []})


def read(spark: SparkSession, root: str) -> DataFrame:
    return M.read_table(spark, root).drop("bucket")


def _rewrite(root: str, delivery: DataFrame, keys: Sequence[str], buckets: int, merged) -> str:
    """Publish ``merged(stored rows, delivered rows)`` of the touched buckets."""
    spark = delivery.sparkSession
    base = M.current(spark, root)
    types = {f["name"]: T.StructField.fromJson(f).dataType for f in (base["schema"] or {"fields": []})["fields"]}
    delivery = delivery.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in delivery.columns])
    names = [c for c in delivery.columns if c in types]    # alike for stored and delivered rows
    delivery = delivery.withColumn("bucket", bucket(keys, names, buckets))
    touched = {str(r[0]) for r in delivery.select("bucket").distinct().collect()}   # ``buckets`` numbers at most
    stored = M.read_table(spark, root, base, keep=lambda e: e["values"][0] in touched)
    rows = merged(stored.drop("bucket"), delivery.drop("bucket"))
    rows = rows.withColumn("bucket", bucket(keys, names, buckets))
    scope = spark.createDataFrame([(int(b),) for b in sorted(touched)], "bucket int")
    return M.replace_partitions(rows, root, ["bucket"], replaces=scope, base=base)


def upsert(root: str, delivery: DataFrame, keys: Sequence[str], version_col: str | None = None,
           buckets: int = BUCKETS) -> str:
    """Merge a delivery: a delivered row replaces the stored one of its key unless
    that one's version is greater; new keys are inserted."""
    def merged(stored, new):
        rows = stored.withColumn("_new", F.lit(False)).unionByName(
            new.withColumn("_new", F.lit(True)), allowMissingColumns=True)
        return _latest_delivered(rows, keys, version_col)
    return _rewrite(root, delivery, keys, buckets, merged)


def _latest_delivered(rows: DataFrame, keys: Sequence[str], version_col: str | None) -> DataFrame:
    out = latest(rows, keys, version_col, F.col("_new"))
    return out.drop("_new")


def apply_changes(root: str, changes: DataFrame, keys: Sequence[str], op_col: str = "op", seq_col: str = "seq",
                  buckets: int = BUCKETS) -> str:
    """Apply a feed of changes (``op_col`` I, U or D; ``seq_col`` their order): the
    last change of a key is its row, or its end if it is a D."""
    def merged(stored, new):
        return apply_last_change(stored, new, keys, op_col, seq_col)
    return _rewrite(root, changes.where(has_key(keys)), keys, buckets, merged)


def apply_last_change(table: DataFrame, changes: DataFrame, keys: Sequence[str], op_col: str, seq_col: str) -> DataFrame:
    """``table`` after ``changes``: stored rows are older than any change."""
    data = list(table.columns)
    rows = (table.select(*data, F.lit("T").alias(op_col), F.lit(None).cast("long").alias(seq_col), F.lit(False).alias("_new"))
            .unionByName(changes.where(has_key(keys)).select(
                *data, op_col, F.col(seq_col).cast("long").alias(seq_col), F.lit(True).alias("_new"))))
    # a change without a number is still newer than the stored row
    other = [c for c in rows.columns if c not in keys]
    order = F.struct(F.col("_new"), version_order(other, seq_col).alias("_v"))
    last = rows.where(has_key(keys)).groupBy(*keys).agg(F.max_by(F.struct(*other), order).alias("_r"))
    last = last.where(F.col("_r")[op_col] != "D").select(*keys, *[F.col("_r")[c].alias(c) for c in data if c not in keys])
    return last.select(*data).unionByName(table.where(~has_key(keys)))
