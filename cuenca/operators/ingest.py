"""Lakehouse zone jobs: raw CSV → silver parquet per entity, with an
optional quality gate, and the clean-sales jobs.

The raw files are read with every column as STRING and typed with
``try_cast`` / ``try_to_date`` / ``try_to_timestamp``: a bad value becomes
NULL (and is counted by the quality rules) instead of failing the job under
ANSI mode.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.operators import quality as Q
from cuenca.operators.quality import Rule
from cuenca.session import materialize
from cuenca.sinks import manifest
from cuenca.sources.files import all_string_schema, read_csv, require_columns

# Silver types per entity (fixed values of the raw→silver job).
ENTITY_TYPES = {
    "customers": [("customer_id", "string"), ("customer_name", "string"), ("city", "string"),
                  ("country", "string"), ("created_at", "date")],
    "orders": [("order_id", "string"), ("customer_id", "string"), ("order_ts", "timestamp"),
               ("status", "string"), ("total_amount", "decimal(18,2)"), ("currency", "string")],
    "payments": [("payment_id", "string"), ("order_id", "string"), ("payment_method", "string"),
                 ("paid_amount", "decimal(18,2)"), ("currency", "string"), ("paid_ts", "timestamp")],
}

# Quality rules per entity: required columns, unique key, amount rule.
ENTITY_KEYS = {"customers": "customer_id", "orders": "order_id", "payments": "payment_id"}
ENTITY_AMOUNT = {"orders": "total_amount", "payments": "paid_amount"}


def _typed(col: str, t: str):
    c = F.col(col)
    if t == "string":
        return c.cast("string")
    if t == "date":
        return F.try_to_date(c)
    if t == "timestamp":
        return F.try_to_timestamp(c).cast("timestamp_ntz")
    return c.try_cast(t)


def to_silver(raw: DataFrame, entity: str) -> DataFrame:
    """All-string raw rows → typed silver columns of the entity."""
    if entity not in ENTITY_TYPES:
        raise ValueError(f"unknown entity {entity!r}; expected one of {sorted(ENTITY_TYPES)}")
    types = ENTITY_TYPES[entity]
    require_columns(raw, [c for c, _ in types], entity)
    return raw.select(*[_typed(c, t).alias(c) for c, t in types])


def read_raw(spark: SparkSession, entity: str, path: str) -> DataFrame:
    cols = [c for c, _ in ENTITY_TYPES[entity]]
    return read_csv(spark, path, schema=all_string_schema(cols), mode="PERMISSIVE")


def entity_rules(entity: str) -> list[Rule]:
    key = ENTITY_KEYS[entity]
    required = [c for c, _ in ENTITY_TYPES[entity] if c.endswith("_id")]
    rules = [Rule(f"null_or_empty_{c}", "not_null_or_empty", [c]) for c in required]
    rules.append(Rule(f"duplicate_{key}", "unique", [key]))
    amt = ENTITY_AMOUNT.get(entity)
    if amt:
        rules.append(Rule(f"{amt}_null_or_negative", "check",
                          expr=F.col(amt).isNotNull() & (F.col(amt) >= 0)))
    return rules


def raw_to_silver(spark: SparkSession, entity: str, in_path: str, out_path: str,
                  source: str, dt: str, quality_path: str | None = None) -> DataFrame:
    """One entity: read raw, type, add ``source``/``dt``, optionally run the
    quality gate (report written before failing, nothing written on
    failure), then publish it as the (source, dt) partition of the silver table:
    a re-run replaces that partition in one step, also by nothing. Read the
    table with ``manifest.read_table``."""
    silver = to_silver(read_raw(spark, entity, in_path), entity)
    out = silver.withColumns({"source": F.lit(source), "dt": F.lit(dt)})
    scope = spark.range(1).select(F.lit(source).alias("source"), F.lit(dt).alias("dt"))
    if quality_path is None:
        manifest.replace_partitions(out, out_path, ["source", "dt"], replaces=scope)
        return out
    # the raw files are parsed once, into a staged table in the shared folder
    # that the gate's rules and the write read (a lost executor re-reads it)
    out = materialize(out)
    Q.gate(Q.report(out, entity, entity_rules(entity)), quality_path)
    manifest.replace_partitions(out, out_path, ["source", "dt"], replaces=scope)
    return out


def run_entities(spark: SparkSession, jobs: Iterable[dict], parallel: int = 3) -> list:
    """Run several entity jobs concurrently in one application (the state
    machine's parallel branch): each job is its own set of Spark jobs."""
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        futs = [ex.submit(raw_to_silver, spark, **j) for j in jobs]
        return [f.result() for f in futs]


def clean_sales(df: DataFrame, min_amount: float = 0, inclusive: bool = True,
                amount_col: str = "amount", date_col: str = "order_date") -> DataFrame:
    """Sales cleaning. ``inclusive=True``: amount coerced to a number, kept
    when >= min (non-numeric dropped); ``inclusive=False``: kept when > min.
    The date is parsed to DATE; unparsable dates become NULL."""
    amt = F.col(amount_col).cast("string").try_cast("double")
    keep = amt >= min_amount if inclusive else amt > min_amount
    return (df.withColumn(amount_col, amt).where(keep)
            .withColumn(date_col, F.try_to_date(F.col(date_col).cast("string"))))


class EmptyPayloadError(ValueError):
    pass


def load_payload(raw: DataFrame, body_col: str, record_schema, time_col: str | None = None,
                 require_rows: bool = True) -> DataFrame:
    """API payload rows → flat typed rows: unwrap ``data`` / ``result`` /
    bare lists, flatten nested fields to dotted names, find the time column
    by name when not given and parse it (bad values → NULL). A payload with
    no records is an error (``require_rows``; one row is probed)."""
    from cuenca.operators.documents import flatten, unwrap_payload
    from cuenca.sources.files import find_time_column
    rows = flatten(unwrap_payload(raw, body_col, record_schema))
    if require_rows and rows.limit(1).count() == 0:
        raise EmptyPayloadError("the payload holds no records")
    tc = time_col or find_time_column(rows)
    if tc is None:
        raise ValueError(f"no time column among {rows.columns}")
    return rows.withColumn(tc, F.try_to_timestamp(F.col(tc).cast("string")).cast("timestamp_ntz"))
