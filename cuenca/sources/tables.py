"""Access to the parquet tables of a scale-factor folder.

``Tables(spark, sf_dir).lineitem`` is a lazy ``spark.read.parquet``; nothing is
read until an action, so column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


_SCHEMAS: dict[str, tuple[int, StructType]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a lazy DataFrame. Inferring a schema reads file footers (a
    small Spark job), so the schema is kept until the path's modification time
    changes; files are listed anew each time, so a rewritten table is read as it is now."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    changed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getModificationTime()
    if _SCHEMAS.get(path, (None,))[0] != changed:
        _SCHEMAS[path] = changed, spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path][1]).parquet(path)


def table_bytes(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Bytes of the table's files."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


class Tables:
    """Attribute access to the tables of one folder: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLE_NAMES:
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


def register_views(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> None:
    """Register every table as a temporary view of the same name (for spark.sql)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
