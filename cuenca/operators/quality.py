"""Data-quality rules evaluated as Spark jobs.

A rule yields one ``(rule, entity, violations)`` row. Row-level rules
(nulls, ranges, accepted values, formats, temporal order) are all folded into
ONE aggregate pass over the data (``count_if`` per rule) instead of one
``count()`` job per rule. Key rules (duplicates, foreign keys) are
aggregations/anti-joins of their own and are unioned into the same report.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cuenca.functions.columns import null_or_empty


@dataclass(frozen=True)
class Rule:
    """``kind``: not_null | not_null_or_empty | range | accepted | date_format |
    check (any boolean ``expr`` that must hold) | unique | foreign_key."""
    name: str
    kind: str
    columns: Sequence[str] = ()
    low: float | None = None
    high: float | None = None
    values: Sequence[str] = ()
    expr: Column | None = None
    fmt: str = "yyyy-MM-dd"
    parent: DataFrame | None = field(default=None, compare=False)
    parent_columns: Sequence[str] = ()


def _violation(rule: Rule) -> Column:
    """Boolean column: TRUE when the row violates a row-level rule."""
    cs = [F.col(c) for c in rule.columns]
    if rule.kind == "not_null":
        return F.greatest(*[c.isNull() for c in cs]) if len(cs) > 1 else cs[0].isNull()
    if rule.kind == "not_null_or_empty":
        conds = [null_or_empty(c) for c in rule.columns]
        return F.greatest(*conds) if len(conds) > 1 else conds[0]
    if rule.kind == "range":
        c = cs[0]
        bad = F.lit(False)
        if rule.low is not None:
            bad = bad | (c < rule.low)
        if rule.high is not None:
            bad = bad | (c > rule.high)
        return F.coalesce(bad, F.lit(False))
    if rule.kind == "accepted":
        c = cs[0]
        return c.isNull() | ~c.isin(list(rule.values))
    if rule.kind == "date_format":
        c = cs[0].cast("string")
        return c.isNotNull() & F.try_to_date(c, rule.fmt).isNull()
    if rule.kind == "check":
        return F.coalesce(~rule.expr, F.lit(False))
    raise ValueError(rule.kind)


ROW_KINDS = {"not_null", "not_null_or_empty", "range", "accepted", "date_format", "check"}


def evaluate(df: DataFrame, entity: str, rules: Sequence[Rule],
             row_count_rule: str | None = None) -> DataFrame:
    """Report of ``(rule, entity, violations)`` for every rule.

    Row rules: one pass, one partial aggregate per task (``row_count_rule``
    adds the row count as one more row of the same pass). ``unique``: keys
    with count > 1 (keys with a NULL in any column ignored). ``foreign_key``: child rows whose
    non-NULL key has no parent (left anti join)."""
    parts: list[DataFrame] = []
    row_rules = [r for r in rules if r.kind in ROW_KINDS]
    if row_rules or row_count_rule:
        aggs = [F.count_if(_violation(r)).alias(f"r{i}") for i, r in enumerate(row_rules)]
        names = [r.name for r in row_rules]
        if row_count_rule:
            aggs.append(F.count(F.lit(1)).alias(f"r{len(row_rules)}"))
            names.append(row_count_rule)
        agg = df.agg(*aggs)
        stack = ", ".join(f"'{n}', r{i}" for i, n in enumerate(names))
        parts.append(agg.selectExpr(f"stack({len(names)}, {stack}) AS (rule, violations)"))
    for r in rules:
        if r.kind == "unique":
            keyed = df.dropna(how="any", subset=list(r.columns))
            dup = keyed.groupBy(*r.columns).count().where(F.col("count") > 1)
            parts.append(dup.agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(r.name).alias("rule"), "violations"))
        elif r.kind == "foreign_key":
            child = df.where(F.col(r.columns[0]).isNotNull())
            cond = [child[c] == r.parent[p] for c, p in zip(r.columns, r.parent_columns)]
            orphans = child.join(r.parent, cond, "left_anti")
            parts.append(orphans.agg(F.count(F.lit(1)).alias("violations"))
                         .select(F.lit(r.name).alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("rule", F.lit(entity).alias("entity"),
                      F.col("violations").cast("bigint").alias("violations"))


@dataclass(frozen=True)
class Relation:
    """Rows of ``child`` whose key ``child_columns`` is in no row of ``parent``
    (both names of tables) are violations of the rule ``name``."""

    name: str
    entity: str
    child: str
    child_columns: Sequence[str]
    parent: str
    parent_columns: Sequence[str]


def foreign_keys(tables: dict[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """Report of ``(rule, entity, violations)`` for many relations at once, each
    table read once: a row emits a tagged key for every part it plays, child or
    parent, in any relation; the keys are united, counted per (relation, key)
    with partial aggregation, and a key without a parent's tag is a violation of
    its child rows. Keys with a NULL in any column are ignored. Keys are
    compared as text, so the columns of a relation should have alike types."""
    width = max(len(r.child_columns) for r in relations)
    united = None
    for name, df in tables.items():
        parts = []
        for i, r in enumerate(relations):
            for table, columns, is_parent in ((r.child, r.child_columns, 0), (r.parent, r.parent_columns, 1)):
                if table == name:
                    whole = F.col(columns[0]).isNotNull()
                    for c in columns[1:]:
                        whole = whole & F.col(c).isNotNull()
                    padded = F.array(*[F.col(c).cast("string") for c in columns], *[F.lit("")] * (width - len(columns)))
                    parts.append(F.when(whole, F.struct(F.lit(i).alias("relation"), padded.alias("key"),
                                                        F.lit(is_parent).alias("is_parent"))))
        if not parts:
            continue
        tagged = df.select(F.explode(F.filter(F.array(*parts), lambda p: p.isNotNull())).alias("t")).select("t.*")
        united = tagged if united is None else united.unionByName(tagged)
    keys = united.groupBy("relation", "key").agg(F.bit_or("is_parent").alias("found"), F.count_if(F.col("is_parent") == 0).alias("rows"))
    missing = keys.where("found = 0").groupBy("relation").agg(F.sum("rows").alias("violations"))
    names = united.sparkSession.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("relation"), F.lit(r.name).alias("rule"), F.lit(r.entity).alias("entity"))
        for i, r in enumerate(relations)])).alias("r")).select("r.*")
    return names.join(missing, "relation", "left").select("rule", "entity", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def report(df: DataFrame, entity: str, rules: Sequence[Rule]) -> DataFrame:
    """One-row report: row_count, total violations and the number of failed
    rules (written as JSON before the gate decides; per-rule counts are
    ``evaluate``)."""
    ev = evaluate(df, entity, rules, row_count_rule="__rows__")
    is_rows = F.col("rule") == "__rows__"
    return ev.agg(F.lit(entity).alias("entity"),
                  F.max(F.when(is_rows, F.col("violations"))).alias("row_count"),
                  F.sum(F.when(~is_rows, F.col("violations"))).cast("bigint").alias("violations_total"),
                  F.count_if(~is_rows & (F.col("violations") > 0)).alias("rules_failed"))


class QualityGateError(RuntimeError):
    pass


def gate(report_df: DataFrame, report_path: str | None = None) -> dict:
    """Write the report (if a path is given), then fail on any violation.
    The report is one row per entity; only that row reaches the driver."""
    if report_path:
        report_df.coalesce(1).write.mode("overwrite").json(report_path)
    rows = [r.asDict(recursive=True) for r in report_df.collect()]
    bad = [r for r in rows if (r["violations_total"] or 0) > 0]
    if bad:
        raise QualityGateError(f"quality gate failed: {bad}")
    return {r["entity"]: r for r in rows}


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad); bad rows carry the array of failed rule
    names in ``reasons``. Row-level rules only."""
    row_rules = [r for r in rules if r.kind in ROW_KINDS]
    reasons = F.filter(F.array(*[F.when(_violation(r), F.lit(r.name)) for r in row_rules]),
                       lambda x: x.isNotNull())
    tagged = df.withColumn("reasons", reasons)
    return (tagged.where(F.size("reasons") == 0).drop("reasons"),
            tagged.where(F.size("reasons") > 0))


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of every column in one pass: (column, nulls)."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, nulls)")


def quality_report(df: DataFrame, rules: Sequence[Rule], entity: str = "dataset") -> DataFrame:
    """``report`` with the (df, rules) argument order of the job signature."""
    return report(df, entity, rules)
