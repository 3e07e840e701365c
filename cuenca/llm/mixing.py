"""Mixing sources to target weights by entropy balancing.

Every source has a token target: its weight's share of ``share`` times all
tokens, at most ``cap`` times what the source holds, the excess dealt to the
others by weight. The document rates ``r`` minimise the relative entropy
``sum(r * (log(r / q) - 1))`` to a base rate ``q`` under one token constraint
per source, ``sum(size * r) = target``, and ``r <= cap``. The convex dual has
one multiplier per source and its solution is the exponential tilt
``r = min(cap, q * exp(lambda * size / scale))``. Newton steps, kept inside a
bracket, solve the dual for all sources at once; each step is one aggregate over
(source, size) counts, which are sufficient statistics of the documents, so the
texts are not read again.

Rates become whole copies by error diffusion: documents of a source are taken
in order of falling size, and the running sum of the rates' fractions decides
how many of a (size, spread) cell are rounded up, so the tokens taken differ
from the target by about half of the longest document at most. Which documents
of a cell those are follows the hash of doc_id and text: reruns agree. Sums
inside the steps are whole numbers, so they do not depend on the order of
addition.

A cell is split ``SPREAD`` ways, so a source, size or group of copies that
holds a third of all rows is ranked in ``SPREAD`` tasks. Everything per source
stays a table; the driver sees single numbers only.

Defined results: a null or empty text has size 0 and takes 0 words; a null
source is a source of its own, the last; repeated rows are documents of their
own; a source without words has target 0; an empty table gives no rows. Extra
columns pass through; columns of the operator's own output names are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cuenca.llm.common import WORD, table
from cuenca.operators.analytics import global_sequence
from cuenca.session import materialize

NAME = "op10_entropy_mixing"
SQL = None               # iterative; tested against a plain solution in numpy
WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
SPREAD = 32
STEPS = 60               # more than enough: the bracket halves at least

_OWN = ("size", "source_size", "target", "rate", "copies", "taken")


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size`` (words) and the cell keys ``_src``, ``_spread``."""
    h = F.xxhash64(F.col("doc_id"), F.col("text"))
    return (docs.drop(*_OWN)
            .withColumn("size", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long"))
            .withColumn("_src", F.coalesce(F.concat(F.lit("a"), F.col("source")), F.lit("z")))
            .withColumn("_h", h)
            .withColumn("_spread", F.pmod(h, F.lit(SPREAD))))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(_src, source_size, target) from (_src, source_size): weights dealt in
    order of _src, targets above ``cap`` times the size cut and dealt again."""
    n = F.size(w := F.array(*map(F.lit, weights)))
    src = materialize(global_sequence(sizes, ["_src"], "_i")
                      .select("_src", "source_size",
                              F.element_at(w, (F.pmod(F.col("_i") - 1, n) + 1).cast("int")).cast("long").alias("_w")))
    level = 0.0
    while True:  # the level only rises; it ends when no further source is cut
        cut = F.col("_w") * F.lit(level) > F.col("source_size") * F.lit(cap)
        r = src.agg(F.sum("source_size").alias("all"),
                    F.coalesce(F.sum(F.when(cut, F.col("source_size"))), F.lit(0)).alias("cut"),
                    F.coalesce(F.sum(F.when(~cut, F.col("_w"))), F.lit(0)).alias("w")).first()
        higher = (share * (r["all"] or 0) - cap * r["cut"]) / r["w"] if r["w"] else level
        if higher <= level:
            break
        level = higher
    return src.select("_src", "source_size", F.least(F.col("_w") * F.lit(level), F.col("source_size") * F.lit(cap)).alias("target"))


def tilts(cells: DataFrame, goals: DataFrame, base: float = SHARE, cap: float = CAP) -> DataFrame:
    """(_src, source_size, target, scale, lam): the dual solution of every
    source. ``lam`` is null where the target is all of ``cap`` times the size
    (every rate is ``cap``) or 0."""
    scale = cells.groupBy("_src").agg(
        (F.sum(F.col("size") * F.col("size") * F.col("n")) / F.greatest(F.sum(F.col("size") * F.col("n")), F.lit(1))).alias("scale"))
    state = goals.join(scale, "_src").withColumns({
        "lam": F.when((F.col("target") > 0) & (F.col("target") < F.col("source_size") * F.lit(cap)), F.lit(0.0)),
        "lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double"), "left": F.lit(None).cast("double")})
    state = materialize(state)
    for _ in range(STEPS):
        x = F.col("size") / F.col("scale")
        tilted = F.lit(base) * F.exp(F.least(F.col("lam") * x, F.lit(50.0)))
        words = F.col("size") * F.col("n")
        sums = (cells.join(state.where("lam is not null and (left is null or left > 0.5)").select("_src", "lam", "scale"), "_src")
                .groupBy("_src").agg(
                    (F.sum(F.round(words * F.least(tilted, F.lit(cap)) * 1000).cast("decimal(30,0)")) / 1000).cast("double").alias("_g"),
                    (F.sum(F.round(F.when(tilted < cap, words * tilted * x).otherwise(0.0) * 1000).cast("decimal(30,0)")) / 1000).cast("double").alias("_d")))
        s = state.join(sums, "_src", "left")
        over = F.col("_g") - F.col("target")
        lo = F.when(over < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(over >= 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.greatest(F.lit(-8.0), F.least(F.lit(8.0), over / F.col("_d")))
        inside = (F.col("_d") > 0) & (lo.isNull() | (newton > lo)) & (hi.isNull() | (newton < hi))
        step = (F.when(inside, newton).when(lo.isNull(), hi * 2 - 1).when(hi.isNull(), lo * 2 + 1)
                .otherwise((lo + hi) / 2))
        done = F.abs(over) <= 0.5  # half a word
        state = materialize(s.select(
            "_src", "source_size", "target", "scale",
            F.when(F.col("_g").isNull() | done, F.col("lam")).otherwise(step).alias("lam"),
            F.when(F.col("_g").isNull(), F.col("lo")).otherwise(lo).alias("lo"),
            F.when(F.col("_g").isNull(), F.col("hi")).otherwise(hi).alias("hi"),
            F.coalesce(F.abs(over), F.col("left")).alias("left")))
        if state.where("lam is not null and left > 0.5").isEmpty():
            break
    return state.select("_src", "source_size", "target", "scale", "lam")


def plan(cells: DataFrame, tilt: DataFrame, base: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per cell: the rate, its whole part and how many documents get one more."""
    rate = (F.when(F.col("lam").isNotNull(), F.least(
                F.lit(cap), F.lit(base) * F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(50.0)))))
            .when(F.col("target") > 0, F.lit(cap)).otherwise(F.lit(0.0)))
    w = Window.partitionBy("_src").orderBy(F.desc("size"), "_spread").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum(F.col("n") * (F.col("rate") - F.floor("rate"))).over(w)
    before = F.col("_run") - F.col("n") * (F.col("rate") - F.floor("rate"))
    return (cells.join(tilt, "_src").withColumn("rate", rate).withColumn("_run", run)
            .withColumn("_more", F.least(F.col("n"), F.floor(F.col("_run") + 0.5) - F.floor(before + 0.5)))
            .select("_src", "size", "_spread", "source_size", "target", "rate",
                    F.floor("rate").cast("long").alias("_whole"), "_more"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` (their source's),
    ``rate``, ``copies`` and ``taken`` (copies times size)."""
    rows = sized(docs)
    cells = materialize(rows.groupBy("_src", "size", "_spread").agg(F.count(F.lit(1)).alias("n")))
    goals = targets(cells.groupBy("_src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, cap)
    cell = ["_src", "size", "_spread"]
    decided = materialize(plan(cells, tilts(cells, goals, share, cap), share, cap))
    rank = F.row_number().over(Window.partitionBy(*cell).orderBy("_h", "doc_id"))
    return (rows.withColumn("_rank", rank).join(decided, cell)
            .withColumn("copies", F.col("_whole") + F.when(F.col("_rank") <= F.col("_more"), 1).otherwise(0))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .select(*[c for c in docs.columns if c not in _OWN], *_OWN))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
