"""File sources: CSV (explicit / inferred / all-string schema, any
separator), JSON (lines or array files), text lines, recursive parquet,
API payloads, heterogeneous monthly files, plus the input guards."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


class InputContractError(ValueError):
    pass


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",", header: bool = True, infer: bool = False,
             mode: str = "PERMISSIVE", encoding: str = "UTF-8",
             corrupt_col: str | None = None) -> DataFrame:
    """CSV with header. ``schema`` fixes the types (preferred: no inference
    pass); ``infer`` reads the data for them instead, whole numbers being BIGINT
    whatever their size. PERMISSIVE keeps bad rows, optionally with the raw
    line in ``corrupt_col``."""
    r = (spark.read.option("header", header).option("sep", sep).option("mode", mode)
         .option("encoding", encoding))
    if corrupt_col:
        r = r.option("columnNameOfCorruptRecord", corrupt_col)
    if schema is not None:
        if corrupt_col and isinstance(schema, StructType):
            schema = StructType(schema.fields + [StructField(corrupt_col, StringType())])
        r = r.schema(schema)
    elif infer:
        df = r.option("inferSchema", True).csv(path)
        return df.select(*[F.col(f"`{f.name}`").cast("bigint").alias(f.name) if f.dataType == IntegerType() else F.col(f"`{f.name}`")
                           for f in df.schema.fields])
    return r.csv(path)


def all_string_schema(columns: Iterable[str]) -> StructType:
    """Every column as STRING: parse errors are controlled later by try_cast."""
    return StructType([StructField(c, StringType()) for c in columns])


def check_separator(df: DataFrame, dataset: str, sep: str,
                    others: Iterable[str] = (",", ";", "|", "\t")) -> None:
    """A single column whose name contains another separator means the file
    was read with the wrong one: fail with a clear message."""
    if len(df.columns) == 1:
        name = df.columns[0]
        hit = [s for s in others if s != sep and s in name]
        if hit:
            raise InputContractError(
                f"{dataset}: read with sep={sep!r} but the header holds {hit[0]!r}: {name!r}")


def require_columns(df: DataFrame, required: Iterable[str], dataset: str,
                    exact: bool = False) -> None:
    """Missing required columns (or, with ``exact``, any header difference) → error."""
    cols = list(df.columns)
    missing = [c for c in required if c not in cols]
    if missing:
        raise InputContractError(f"{dataset}: missing columns {missing}; found {cols}")
    if exact and cols != list(required):
        raise InputContractError(f"{dataset}: header {cols} != contract {list(required)}")


def detect_separator(spark: SparkSession, path: str,
                     candidates: Iterable[str] = (",", ";", "|", "\t")) -> str:
    """Classify the delimiter of a changed feed from its first line only (one
    line reaches the driver)."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    best = max(candidates, key=lambda s: line.count(s))
    if line.count(best) == 0:
        raise InputContractError(f"{path}: no known separator in first line {line!r}")
    return best


def read_json_documents(spark: SparkSession, path: str, schema: StructType | str | None = None,
                        multiline: bool = False) -> DataFrame:
    """JSON lines (splittable) or, with ``multiline``, files that each hold
    one JSON array of documents (one task per file)."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_parquet_tree(spark: SparkSession, path: str, partitioned: bool = True) -> DataFrame:
    """A directory tree of parquet: Hive ``k=v`` discovery (partition columns
    come back and prune) or, for arbitrary nesting, ``recursiveFileLookup``."""
    if partitioned:
        return spark.read.parquet(path)
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def find_time_column(df: DataFrame,
                     candidates: Iterable[str] = ("fecha", "fechahora", "date", "datetime", "timestamp",
                                                  "ts", "time", "hora")) -> str | None:
    """First column whose lower-cased name is a known time-column name."""
    lower = {c.lower(): c for c in df.columns}
    for c in candidates:
        if c in lower:
            return lower[c]
    return None


def harmonise(frames: Iterable[DataFrame], rename: Mapping[str, str],
              decimal_comma: Iterable[str] = (), casts: Mapping[str, str] | None = None) -> DataFrame:
    """Monthly files with drifting columns → one standard schema.

    Columns are renamed through ``rename`` (case-insensitive), decimal commas
    are normalised in ``decimal_comma`` columns, frames are unioned by name
    (missing columns become NULL), then cast with ``try_cast``."""
    lower_map = {k.lower(): v for k, v in rename.items()}
    out = None
    for df in frames:
        d = df.select(*[F.col(f"`{c}`").alias(lower_map.get(c.lower(), c)) for c in df.columns])
        for c in decimal_comma:
            if c in d.columns:
                s = F.trim(F.col(c).cast("string"))
                # 1.234,56 -> 1234.56: points before a decimal comma group thousands
                d = d.withColumn(c, F.when(s.contains(","), F.replace(F.regexp_replace(s, r"[.\x20]", ""), F.lit(","), F.lit(".")))
                                 .otherwise(s))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    for c, t in (casts or {}).items():
        out = out.withColumn(c, F.col(c).cast("string").try_cast(t))
    return out


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """Parallel relational full load: ``num_partitions`` range queries over
    ``partition_column`` (a numeric key), each read by its own task."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("partitionColumn", partition_column).option("lowerBound", lower)
         .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load()
