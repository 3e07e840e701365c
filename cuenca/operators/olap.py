"""Cube operators over a fact DataFrame.

Every function takes and returns DataFrames and only composes built-in
operators, so Catalyst plans each one as partial aggregate → hash exchange →
final aggregate (map-side combine keeps a hot dimension value cheap: each task
ships one partial row per key, not its rows).

Measures are given as ``{name: Column}`` of aggregate expressions.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def _aggs(measures: Mapping[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in measures.items()]


def roll_up(fact: DataFrame, dims: Iterable[str | Column],
            measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate the fact to the given dimensions (one grouping)."""
    return fact.groupBy(*dims).agg(*_aggs(measures))


def rollup_levels(fact: DataFrame, dims: list[str | Column],
                  measures: Mapping[str, Column], level_col: str | None = None) -> DataFrame:
    """SQL ROLLUP(dims): all prefixes of ``dims`` plus the grand total.

    ``level_col`` adds ``grouping_id()`` so subtotal rows are told apart from
    groups whose key is NULL.
    """
    aggs = _aggs(measures)
    if level_col:
        aggs.append(F.grouping_id().alias(level_col))
    return fact.rollup(*dims).agg(*aggs)


def grouping_sets(fact: DataFrame, sets: list[list[str]], measures: Mapping[str, Column],
                  level_col: str | None = "gid") -> DataFrame:
    """GROUPING SETS. A union of one grouping per set would scan the fact
    once per set; ``groupingSets`` plans one Expand over a single scan and
    aggregates all sets in one shuffle.
    """
    all_dims = []
    for s in sets:
        for d in s:
            if d not in all_dims:
                all_dims.append(d)
    aggs = _aggs(measures)
    if level_col:
        aggs.append(F.grouping_id(*all_dims).alias(level_col))
    return fact.groupingSets([[F.col(d) for d in s] for s in sets],
                             *[F.col(d) for d in all_dims]).agg(*aggs)


def slice_(fact: DataFrame, cond: Column) -> DataFrame:
    """Fix one dimension member (e.g. year = 2017); the caller drops the dim."""
    return fact.where(cond)


def dice(fact: DataFrame, *conds: Column) -> DataFrame:
    """Sub-cube: conjunction of ranges / member lists on several dimensions."""
    out = fact
    for c in conds:
        out = out.where(c)
    return out


def drill_down(fact: DataFrame, coarse: list[str | Column], fine: list[str | Column],
               measures: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The same measures at a coarse and at a finer grain."""
    return roll_up(fact, coarse, measures), roll_up(fact, coarse + fine, measures)


def drill_across(a: DataFrame, b: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join two cubes that were aggregated to the same shared dimensions.

    Both sides are aggregated first, so the join is key-unique on each side
    and never fans out.
    """
    return a.join(b, on, how)


def pivot(fact: DataFrame, rows: list[str], col: str, values: list, measure: Column,
          fill: object = 0) -> DataFrame:
    """Pivot ``col`` into columns. Explicit ``values`` avoid a distinct pass.

    ``fill`` mirrors the SUM(CASE…) form (absent cells are 0); pass ``None``
    for the PIVOT-clause form (absent cells are NULL).
    """
    out = fact.groupBy(*rows).pivot(col, values).agg(measure)
    if fill is not None:
        out = out.fillna(fill, subset=[str(v) for v in values])
    return out


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cube difference with SQL EXCEPT semantics (distinct)."""
    return a.subtract(b)


def union_cubes(*cubes: DataFrame) -> DataFrame:
    """UNION ALL of disjoint cubes with the same columns."""
    out = cubes[0]
    for c in cubes[1:]:
        out = out.unionByName(c)
    return out


def add_measure(cube: DataFrame, name: str, expr: Column) -> DataFrame:
    return cube.withColumn(name, expr)


def drop_measure(cube: DataFrame, *names: str) -> DataFrame:
    return cube.drop(*names)


def rename(cube: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return cube.withColumnsRenamed(dict(mapping))


def sort_members(cube: DataFrame, *order: Column | str) -> DataFrame:
    return cube.orderBy(*order)
