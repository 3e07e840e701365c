"""Partitioned Parquet tables whose live partitions are named by a manifest.

Layout of a table::

    root/data/<p1>=<v>/…/run=<id>/part-*.parquet   a run's files of a partition
    root/manifests/<version>.json                  the live partitions
    root/CURRENT                                   the version that counts

A run writes its files under a new ``run`` folder, then a manifest, then moves
``CURRENT`` in one rename. So a reader sees all of the old table or all of the
new one, a run that fails changes nothing, a partition that a re-run leaves
without rows is gone, and the files of partitions it does not touch stay as
they are. A manifest has one entry per live partition: it is the table's
catalogue, the only thing the driver holds.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"


class ConcurrentCommit(RuntimeError):
    """Another run has published the table since this one read it."""


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _fs(spark: SparkSession, path: str):
    p = _hadoop(spark).Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def rename_over(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file over another in one step; an error if it fails."""
    hadoop = _hadoop(spark)
    fs, src = _fs(spark, source)
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.makeQualified(src).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(src), fs.makeQualified(hadoop.Path(target)), options)


def put_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in one step: it is written beside ``path`` and then
    renamed over it, so a reader finds the old or the new text, never none."""
    folder, name = path.rsplit("/", 1)
    staged = f"{folder}/_{name}.{uuid.uuid4().hex}"
    fs, p = _fs(spark, staged)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename_over(spark, staged, path)


def current(spark: SparkSession, root: str) -> dict:
    """The manifest that ``CURRENT`` names; an empty one for a new table."""
    root = root.rstrip("/")
    version = read_small(spark, f"{root}/CURRENT")
    if version is None:
        return {"version": None, "partition_cols": None, "schema": None, "live": []}
    return json.loads(read_small(spark, f"{root}/manifests/{version}.json"))


def _commit(spark: SparkSession, root: str, base: dict, cols: list[str], schema: T.StructType, live: list[dict]) -> str:
    version = uuid.uuid4().hex
    manifest = {"version": version, "parent": base["version"], "partition_cols": cols,
                "schema": schema.jsonValue(), "live": live}
    put_small(spark, f"{root}/manifests/{version}.json", json.dumps(manifest))
    if read_small(spark, f"{root}/CURRENT") != base["version"]:
        raise ConcurrentCommit(f"{root}: published by another run")
    put_small(spark, f"{root}/CURRENT", version)
    return version


def _written(spark: SparkSession, root: str, cols: Sequence[str], run: str) -> list[dict]:
    """Entries of the partitions that a run has written: their folders."""
    fs, glob = _fs(spark, f"{root}/data/" + "*/" * len(cols) + f"run={run}")
    out = []
    for s in fs.globStatus(glob) or []:
        parts = s.getPath().toString().rsplit("/", len(cols) + 1)[1:]
        out.append({"values": [unquote(p.split("=", 1)[1]) for p in parts[:-1]], "dir": "/".join(parts)})
    return out


def _keys(df: DataFrame, cols: Sequence[str]) -> set[tuple]:
    """Partition values as their folder names have them: one row a partition."""
    rows = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL_VALUE)).alias(c) for c in cols]).distinct()
    return {tuple(NULL_VALUE if v == "" else v for v in r) for r in rows.collect()}


def replace_partitions(df: DataFrame, root: str, cols: Sequence[str], replaces: DataFrame | None = None,
                       base: dict | None = None, compression: str = "snappy") -> str:
    """Publish ``df``, partitioned by ``cols``, as the next version of the table:
    its rows take the place of the partitions named by ``replaces`` (the scope
    of the run, with or without rows now) and of those it holds. Without
    ``replaces`` the scope is what ``df`` holds. Other partitions keep their files."""
    spark, root, cols = df.sparkSession, root.rstrip("/"), list(cols)
    base = base or current(spark, root)
    if base["partition_cols"] not in (None, cols):
        raise ValueError(f"{root} is partitioned by {base['partition_cols']}, not {cols}")
    if "run" in df.columns:
        raise ValueError("a manifest table cannot have a column 'run': its folders do")
    scope = _keys(replaces, cols) if replaces is not None else set()
    run = uuid.uuid4().hex
    (df.withColumn("run", F.lit(run)).hint("rebalance", *cols).write.mode("append").option("compression", compression)
     .partitionBy(*cols, "run").parquet(f"{root}/data"))
    new = _written(spark, root, cols, run)
    scope |= {tuple(e["values"]) for e in new}
    live = [e for e in base["live"] if tuple(e["values"]) not in scope] + new
    return _commit(spark, root, base, cols, df.schema, live)


def read_table(spark: SparkSession, root: str, manifest: dict | None = None,
               keep: Callable[[dict], bool] | None = None) -> DataFrame:
    """The table as one version has it; ``keep`` chooses live entries."""
    root = root.rstrip("/")
    m = manifest or current(spark, root)
    if m["schema"] is None:
        raise FileNotFoundError(f"no table is published at {root}")
    schema = T.StructType.fromJson(m["schema"])
    dirs = [f"{root}/data/{e['dir']}" for e in m["live"] if keep is None or keep(e)]
    if not dirs:
        return spark.createDataFrame([], schema)
    full = T.StructType(schema.fields + [T.StructField("run", T.StringType())])
    return (spark.read.schema(full).option("basePath", f"{root}/data").parquet(*dirs)
            .select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]))


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete the folders of runs that none of the last ``keep`` versions names;
    returns their number. Not while another run is writing."""
    root = root.rstrip("/")
    live, m = set(), current(spark, root)
    cols = m["partition_cols"] or []
    for _ in range(keep):
        live |= {e["dir"] for e in m["live"]}
        if not m.get("parent"):
            break
        m = json.loads(read_small(spark, f"{root}/manifests/{m['parent']}.json"))
    fs, glob = _fs(spark, f"{root}/data/" + "*/" * len(cols) + "run=*")
    n = 0
    for s in fs.globStatus(glob) or []:
        if "/".join(s.getPath().toString().rsplit("/", len(cols) + 1)[1:]) not in live:
            fs.delete(s.getPath(), True)
            n += 1
    return n
