"""Nested-document operators: embed, unwind, flatten, status cycle times.

Embedding collects children per parent key, so it is only used where the
children of one parent are bounded by the data model (order lines of an
order, status changes of an order). Unbounded one-to-many relations stay
flat (``unwind`` form) and are aggregated instead of collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, StructType


def embed_children(parent: DataFrame, child: DataFrame, key: str, fields: list[str],
                   name: str, sort_first: str | None = None) -> DataFrame:
    """Mongo ``$lookup`` into an array: each parent gets the array of its
    matching children (empty when none). Children are grouped by key before
    the join, so the join is one-to-one."""
    first = [sort_first] if sort_first else []
    arr = child.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(*(first + [f for f in fields if f not in first]))))
        .alias(name))
    return (parent.join(arr, key, "left")
            .withColumn(name, F.coalesce(F.col(name), F.array().cast(arr.schema[name].dataType))))


def bucket_documents(df: DataFrame, keys: list[str], order: list[str], fields: list[str],
                     name: str, max_items: int, time_bucket: Column) -> DataFrame:
    """Bucket pattern: documents of at most ``max_items`` children per key
    (e.g. a sensor-day holding its readings), numbered ``chunk`` 0, 1, …

    The position of each row inside its key comes from the skew-proof
    running count (per key and ``time_bucket``, plus offsets), so no key is
    collected whole: every document is bounded by ``max_items``."""
    from cuenca.operators.analytics import running_sum
    d = df.withColumn("_one", F.lit(1).cast("long"))
    d = running_sum(d, keys, order, "_one", time_bucket, out="_pos")
    d = d.withColumn("chunk", F.floor((F.col("_pos") - 1) / max_items).cast("int"))
    return d.groupBy(*keys, "chunk").agg(
        F.sort_array(F.collect_list(F.struct(*order, *[f for f in fields if f not in order])))
        .alias(name))


def unwind(df: DataFrame, array_col: str, alias: str | None = None, outer: bool = False,
           position: str | None = None) -> DataFrame:
    """Mongo ``$unwind``: one row per element. ``outer`` keeps empty/NULL
    arrays as one row with NULL (``preserveNullAndEmptyArrays``)."""
    alias = alias or array_col
    rest = [c for c in df.columns if c != array_col]
    if position:
        gen = F.posexplode_outer(array_col) if outer else F.posexplode(array_col)
        return df.select(*rest, gen.alias(position, alias))
    gen = F.explode_outer(array_col) if outer else F.explode(array_col)
    return df.select(*rest, gen.alias(alias))


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Recursively flatten struct columns into ``a.b.c`` top-level columns
    (pandas ``json_normalize``). Arrays are left as they are."""
    cols: list[Column] = []

    def walk(path: list[str], dtype):
        if isinstance(dtype, StructType):
            for f in dtype.fields:
                walk(path + [f.name], f.dataType)
        else:
            ref = F.col("`" + path[0] + "`")
            for p in path[1:]:
                ref = ref.getField(p)
            cols.append(ref.alias(sep.join(path)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*cols)


def unwrap_payload(raw: DataFrame, json_col: str, schema) -> DataFrame:
    """API payload → rows: the records sit under ``data``, else under
    ``result`` (also when ``data`` is there but empty), else the payload is a
    bare list. ``schema`` is the record schema. A payload without records
    gives no rows: ``rejected_payloads`` has those."""
    return raw.select(F.explode(_records(json_col, schema)).alias("r")).select("r.*")


def rejected_payloads(raw: DataFrame, json_col: str, schema) -> DataFrame:
    """The payloads that ``unwrap_payload`` finds no records in, as they came."""
    return raw.where(F.size(_records(json_col, schema)) <= 0)


def _records(json_col: str, schema) -> Column:
    rec = ArrayType(schema)
    s = F.col(json_col)
    found = [F.from_json(F.get_json_object(s, "$.data"), rec), F.from_json(F.get_json_object(s, "$.result"), rec),
             F.when(F.ltrim(s).startswith("["), F.from_json(s, rec))]
    return F.coalesce(*[F.when(F.size(f) > 0, f) for f in found], F.array().cast(rec))


def status_durations(df: DataFrame, key: str, history_col: str,
                     status_field: str = "status", ts_field: str = "changed_at") -> DataFrame:
    """Cycle time of each status: time until the next change of the same
    document (LEAD over the unwound history; the window is one document)."""
    u = df.select(key, F.explode(history_col).alias("h")).select(
        key, F.col(f"h.{status_field}").alias("status"), F.col(f"h.{ts_field}").alias("changed_at"))
    w = Window.partitionBy(key).orderBy("changed_at", "status")
    nxt = F.lead("changed_at").over(w)
    return u.withColumn("next_change", nxt).withColumn(
        "hours_in_status", F.timestamp_diff("HOUR", F.col("changed_at"), F.col("next_change")))
