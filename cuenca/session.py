"""Session construction and cluster-level settings.

Everything here is plain Spark configuration: UTC session time zone (the
project treats timestamps as zone-agnostic), dynamic partition overwrite (so a
re-run replaces only the partitions it writes), AQE with skew-join and
partition coalescing, and a checkpoint directory taken from the cluster.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every job relies on. They are safe at any scale: AQE re-plans joins
# from runtime sizes, splits skewed shuffle partitions and coalesces tiny ones.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "cuenca",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the project's settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of CORE_CONF to an existing session."""
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    The cluster names it. Only a local session (tests), whose tasks share the
    driver's disk, gets a folder of its own when it is unset, removed at exit;
    on a cluster that is an error, as every executor would write to its own disk."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cuenca-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for staged tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"


class Scratch:
    """The tables that ``materialize`` has written inside a ``scratch_scope``."""

    def __init__(self):
        self.paths: list[str] = []
        self.kept: set[str] = set()

    def keep_last(self) -> str:
        """Keep the table written last; returns its path."""
        self.kept.add(self.paths[-1])
        return self.paths[-1]


_SCOPE: ContextVar[Scratch | None] = ContextVar("cuenca_scratch", default=None)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, at the end, the tables that ``materialize`` writes inside, but for
    those kept. For a step whose result is itself written: what it
    leaves behind is read by nobody then."""
    scope = Scratch()
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in scope.paths:
            if path not in scope.kept:
                delete_table(spark, path)


def delete_table(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df):
    """Write an intermediate that several branches of a plan consume as a
    parquet table in the shared checkpoint folder and continue from it: the
    expensive upstream (joins, aggregates) runs once, each branch reads only
    its columns, and the lineage is cut, so a lost executor re-reads the
    table instead of recomputing it."""
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"mat-{uuid.uuid4().hex}")
    df.write.parquet(path)
    if scope := _SCOPE.get():
        scope.paths.append(path)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 << 20, shuffle_fraction: float = 0.25,
                 ) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of input.

    Scans split input into ``target_partition_bytes`` pieces. Shuffles start
    with enough partitions for the shuffled share of the input
    (``shuffle_fraction``: projections and partial aggregates shrink it) at
    about ``target_partition_bytes`` each, never fewer than two waves of
    cores; AQE then coalesces small partitions and splits skewed ones. At
    100 TB this starts shuffles at ~100k partitions."""
    slots = max(1, executor_cores * executors)
    parts = -(-int(input_bytes * shuffle_fraction) // target_partition_bytes)
    parts = max(2 * slots, parts)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
