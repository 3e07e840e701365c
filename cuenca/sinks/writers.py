"""Writers: partitioned parquet lake layouts, CSV exports, catalog tables,
key-value items, JSON documents and upserts.

Every writer is a distributed Spark write; nothing is collected. Partitioned
writes are shuffled on the partition columns with a REBALANCE hint: rows of
one partition value go to few tasks (few files), and AQE splits a value that
holds a large share of the rows (a hot day) across several tasks instead of
one. Dynamic partition overwrite makes a re-run replace only the partitions
it produces.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.sinks import keyed, manifest


def write_by_day(df: DataFrame, path: str, time_col: str, mode: str = "overwrite") -> None:
    """Parquet under ``year=/month=/day=`` of ``time_col``; rows without a
    time are dropped; the partition columns live in the path, not the files."""
    d = (df.where(F.col(time_col).isNotNull())
         .withColumns({"year": F.year(time_col), "month": F.month(time_col),
                       "day": F.dayofmonth(time_col)}))
    (d.hint("rebalance", "year", "month", "day").write.mode(mode)
     .partitionBy("year", "month", "day").parquet(path))


def write_by_month(df: DataFrame, path: str, time_col: str, mode: str = "overwrite") -> None:
    """Month-partitioned, time-ordered table (files sorted by time inside
    each partition, so min/max statistics prune time ranges)."""
    d = df.withColumns({"year": F.year(time_col), "month": F.month(time_col)})
    # partition columns first: that is the order a partitioned write needs, so
    # the writer adds no sort of its own and keeps the time order in each file
    (d.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", time_col).write.mode(mode)
     .partitionBy("year", "month").parquet(path))


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      mode: str = "overwrite", compression: str = "snappy") -> None:
    """Partitioned parquet, re-runnable per partition (dynamic overwrite)."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    (df.hint("rebalance", *partition_cols).write.mode(mode).option("compression", compression)
     .partitionBy(*partition_cols).parquet(path))


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = ",",
              header: bool = True, mode: str = "overwrite") -> None:
    """CSV export with a fixed column order."""
    d = df.select(*columns) if columns else df
    d.write.mode(mode).option("header", header).option("sep", sep).csv(path)


def write_single_csv(df: DataFrame, directory: str, file_name: str, sep: str = ";",
                     order: Sequence[str] = (), max_rows: int = 5_000_000) -> str:
    """One CSV file with a chosen name (the gold transfer-order file), its rows
    in ``order`` (those columns, if not of the file, are left out of it).

    One file is one task's work, so this is for final outputs of a bounded
    size: the frame is written out once, and more than ``max_rows`` rows are
    an error (use ``write_csv``). The part file is renamed with the Hadoop
    FileSystem API."""
    from cuenca.session import materialize
    spark = df.sparkSession
    df = materialize(df)
    if (n := df.count()) > max_rows:
        raise ValueError(f"{file_name}: {n} rows for one file; the limit is {max_rows}")
    staging = directory.rstrip("/") + "/_staging_" + file_name
    one = df.repartition(1)
    one = one.sortWithinPartitions(*order).drop(*[c for c in order if c.startswith("_")]) if order else one
    one.write.mode("overwrite").option("header", True).option("sep", sep).csv(staging)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src_dir = jvm.org.apache.hadoop.fs.Path(staging)
    fs = src_dir.getFileSystem(conf)
    part = [s.getPath() for s in fs.listStatus(src_dir) if s.getPath().getName().startswith("part-")][0]
    target = jvm.org.apache.hadoop.fs.Path(directory.rstrip("/") + "/" + file_name)
    manifest.rename_over(spark, part.toString(), target.toString())
    fs.delete(src_dir, True)
    return directory.rstrip("/") + "/" + file_name


def publish_together(spark: SparkSession, frames: dict[str, DataFrame], root: str) -> str:
    """Publish several tables as one unit: all are written under a new version
    folder first; then the file ``CURRENT`` is replaced, by a rename, to name
    that version. Readers (``read_published``) see all of the old tables or all
    of the new; a job that fails before the rename publishes nothing."""
    version = uuid.uuid4().hex
    root = root.rstrip("/")
    for name, df in frames.items():
        df.write.parquet(f"{root}/version={version}/{name}")
    manifest.put_small(spark, f"{root}/CURRENT", version)
    return version


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the version that ``CURRENT`` names."""
    root = root.rstrip("/")
    version = manifest.read_small(spark, f"{root}/CURRENT")
    return spark.read.parquet(f"{root}/version={version}/{name}")


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace-table load (pandas ``to_sql(if_exists='replace')``)."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def kv_day_items(df: DataFrame, time_col: str, region_col: str | None = None,
                 pk: str = "pk", sk: str = "sk") -> DataFrame:
    """Key-value items ``{pk: 'REGION#r', sk: 'DAY#yyyy-MM-dd', count}`` of
    rows per (day, region); 'ALL' without a region column."""
    region = F.coalesce(F.col(region_col) if region_col else F.lit(None).cast("string"), F.lit("ALL"))
    g = df.groupBy(region.alias("_r"), F.to_date(time_col).alias("_d")).agg(
        F.count(F.lit(1)).alias("count"))
    return g.select(F.concat(F.lit("REGION#"), "_r").alias(pk),
                    F.concat(F.lit("DAY#"), F.date_format("_d", "yyyy-MM-dd")).alias(sk), "count")


def to_json_documents(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Each row as one JSON document (``_id`` from ``id_col``)."""
    cols = [F.col(id_col).alias("_id")] if id_col else []
    return df.select(F.to_json(F.struct(*cols, *[F.col(c) for c in df.columns])).alias("doc"))


def write_documents(docs: DataFrame, sink, batch_size: int = 1000) -> None:
    """Send documents to an external store in batches, per partition, from
    the executors (``sink(list_of_json)`` is the store's bulk-insert call)."""
    def send(rows):
        batch = []
        for r in rows:
            batch.append(r[0])
            if len(batch) >= batch_size:
                sink(batch)
                batch = []
        if batch:
            sink(batch)
    docs.foreachPartition(send)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], version_col: str | None = None) -> DataFrame:
    """Merge by key: source rows replace matching target rows, new keys are
    inserted, other target rows stay (``$merge`` / MERGE without a table
    format). Of repeated keys in the source the latest row counts (see
    ``keyed.version_order``); rows without a key match none and are all kept.
    The caller writes the result to a new location; ``keyed.upsert`` merges
    into a table and rewrites the touched buckets only."""
    one = keyed.latest(source, keys, version_col)
    kept = target.join(one.select(*keys), list(keys), "left_anti")
    return kept.unionByName(one, allowMissingColumns=True)


def latest_wins(df: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """Second delivery of a file appended: keep the newest version of each key
    (one partial aggregate, no sort window). NULL versions are the oldest, equal
    ones are ordered by their columns; rows without a key are all kept."""
    return keyed.latest(df, keys, version_col)


def daily_items(df: DataFrame, time_col: str, region_col: str | None = None) -> DataFrame:
    """Key-value items per (day, region) — see ``kv_day_items``."""
    return kv_day_items(df, time_col, region_col)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str,
                   sort: bool = True) -> None:
    """Save a catalog table bucketed (and sorted) by ``keys`` into ``buckets``
    files per writer. Two tables bucketed the same way on the join key are
    joined without shuffling either side (e.g. order lines and orders on the
    order key, the largest join of the star)."""
    w = df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
