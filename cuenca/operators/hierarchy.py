"""Trees of any depth by pointer jumping.

Every node holds a pointer to an ancestor; in each round it takes over the
pointer of the node it points to, so distances double and a tree of depth d
takes log2(d) joins. No recursion, no path is stored, and a cycle ends the run
instead of running on: a pointer that has gone further than there are nodes
never reaches a root.

Rounds are written to the shared folder, so a lost executor rereads the last
one. A node with very many children is one row on the looked-up side of the
joins; its children's side is what AQE splits.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cuenca.session import materialize


def levels(nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """(node, root, level, status) of every node. ``status`` is ``ok``, ``orphan`` (an
    ancestor is missing) or ``cycle`` (on a cycle or below one); root and level
    are NULL unless it is ok. A node is a root if its parent is NULL. Ids are
    unique; rows with a NULL id are left out."""
    state = nodes.where(F.col(node).isNotNull()).select(
        F.col(node).alias("_id"), F.coalesce(parent, node).alias("_to"), F.col(parent).isNotNull().cast("long").alias("_dist"),
        F.when(F.col(parent).isNull(), "ok").otherwise("open").alias("_status"))
    total, reached = state.count(), 1
    while True:
        there = state.select(F.col("_id").alias("_at"), F.col("_to").alias("_next"), F.col("_dist").alias("_more"),
                             F.col("_status").alias("_found"))
        moving = state.where("_status = 'open'").join(there, F.col("_to") == F.col("_at"), "left").select(
            "_id", F.coalesce("_next", "_to").alias("_to"), (F.col("_dist") + F.coalesce("_more", F.lit(0))).alias("_dist"),
            F.coalesce("_found", F.lit("orphan")).alias("_status"))
        state = materialize(state.where("_status <> 'open'").unionByName(moving))
        reached *= 2
        if reached > total or not state.where("_status = 'open'").limit(1).count():
            break
    ok = F.col("_status") == "ok"
    return state.select(F.col("_id").alias(node), F.when(ok, F.col("_to")).alias("root"),
                        F.when(ok, F.col("_dist")).cast("int").alias("level"),
                        F.when(F.col("_status") == "open", "cycle").otherwise(F.col("_status")).alias("status"))


def rollup(nodes: DataFrame, node: str, parent: str, sums: Sequence[str], depth: int) -> DataFrame:
    """``nodes`` with every column of ``sums`` replaced by its sum over the node and
    all its descendants (NULL if none has a value). ``depth`` is the greatest
    level (``levels``); the nodes must form a forest.

    Round k adds to a node the sums, taken so far, of its descendants exactly
    2**k below, so no (node, ancestor) pairs are formed."""
    other = [c for c in nodes.columns if c not in (node, *sums)]
    state = nodes.select(node, *sums, F.col(parent).alias("_up"))
    reach = 1
    while reach <= depth:
        gained = state.where(F.col("_up").isNotNull()).groupBy(F.col("_up").alias("_at")).agg(
            *[F.sum(c).alias(f"_sum_{c}") for c in sums])
        higher = state.select(F.col(node).alias("_via"), F.col("_up").alias("_next"))
        state = (state.join(gained, F.col(node) == F.col("_at"), "left").join(higher, F.col("_up") == F.col("_via"), "left")
                 .select(node, *[_plus(F.col(c), F.col(f"_sum_{c}")).cast(nodes.schema[c].dataType).alias(c) for c in sums],
                         F.col("_next").alias("_up")))
        reach *= 2
        if reach <= depth:
            state = materialize(state)
    return nodes.select(node, *other).join(state.drop("_up"), node).select(*nodes.columns)


def _plus(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
