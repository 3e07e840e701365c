"""Merkle manifest of a dataset: a tree of digests per source, a tree over the
sources' roots, and a proof per document.

A leaf is the digest of a row's fields. Leaves of a source are numbered in
ascending key order; ``arity`` consecutive nodes become one parent until one
node, the subroot, is left; the subroots, in the byte order of their sources,
become the root in the same way.

Method: sibling-shift self-joins. At every level the head of a run (slot 0)
computes its siblings' indices (``idx XOR 1`` in a binary tree, ``idx + slot``
otherwise) and equijoins the level's nodes on (tree, index); the head's row
then emits the parent. All trees are built at once, and a source that holds a
third of the rows spreads over all tasks, as a run is the unit of every join.
Proofs go down the other way: a run joins its parent's path once and hands it to
its members, so the path of a run, not of a document, is what is shuffled.

Only digests and keys are shuffled; texts are read once, in the scan. Levels
are written to the shared folder, so a lost executor rereads them. The driver
sees single numbers and the root.

Defined results: a null field is ``-``; a null source is a tree of its own, the
first; rows of one key are ordered by their digest, null keys first, so
repeated rows are leaves of their own and reruns agree; a lone leaf is its own
subroot, and a lone subroot the root; an empty table has no rows and no root.
Extra columns are not part of a leaf, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cuenca.llm.common import table
from cuenca.operators.analytics import global_sequence, join_null_safe
from cuenca.session import materialize

NAME = "op11_merkle_manifest"
ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = -1  # the tree over the sources


@dataclass
class Manifest:
    """``members``: (tree, idx, n, member, digest), the leaves; ``runs``: per
    level (tree, parent, left, kids, digest), ``kids`` being the run's nodes;
    ``subroots``: (tree, digest); ``top``: the runs of the tree over them."""

    arity: int
    members: DataFrame
    runs: list[DataFrame]
    subroots: DataFrame
    top: list[DataFrame]
    root: str | None


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row's fields: byte count, colon, value; ``-`` for null."""
    text = [c.cast("string") for c in columns]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


def numbered(leaves: DataFrame) -> DataFrame:
    """(tree, idx, n, member, digest) of ``leaves`` (tree key, key, digest and
    member): position in the tree, the tree's number and size. The range
    partitions are written once; a source's position is its place in the
    partition plus its rows in the partitions before."""
    by = ["_tree", "_key", "digest"]
    rows = materialize(leaves)          # range partitioning samples its input
    rows = materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                       .withColumn("_at", F.monotonically_increasing_id()).drop("_key"))
    part = F.shiftright("_at", 33)
    pieces = rows.groupBy("_tree", part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy("_tree")  # a row per range partition and source
    pieces = materialize(
        pieces.withColumn("n", F.sum("_rows").over(whole))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(
            whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    trees = global_sequence(pieces.select("_tree").distinct(), ["_tree"], "tree").withColumn("tree", F.col("tree") - 1)
    pieces = join_null_safe(pieces, trees, ["_tree"])
    return materialize(
        join_null_safe(rows.withColumn("_part", part), pieces, ["_tree", "_part"])
        .select("tree", (F.col("_before") + F.col("_at") - F.col("_first")).alias("idx"), "n", "member", "digest"))


def parents(nodes: DataFrame, arity: int) -> DataFrame:
    """The runs of one level: slot-zero rows look up their siblings."""
    heads = nodes.where(F.col("idx") % arity == 0)
    found = [c for c in nodes.columns if c not in ("tree", "idx", "n")]
    if arity == 2:
        other = nodes.select("tree", F.col("idx").bitwiseXOR(F.lit(1)).alias("idx"),
                             F.struct(F.lit(1).alias("slot"), *found).alias("_other"))
        runs = (heads.join(other, ["tree", "idx"], "left")
                .select("tree", F.col("idx").alias("_head"), "n",
                        F.array_compact(F.array(F.struct(F.lit(0).alias("slot"), *found), "_other")).alias("kids")))
    else:
        sought = (heads.select("tree", F.col("idx").alias("_head"), "n",
                               F.explode(F.sequence(F.lit(0), F.lit(arity - 1))).alias("slot"))
                  .withColumn("idx", F.col("_head") + F.col("slot")).where("idx < n"))
        runs = (sought.join(nodes.drop("n"), ["tree", "idx"]).groupBy("tree", "_head")
                .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("slot", *found))).alias("kids")))  # arity rows
    return runs.select("tree", F.floor(F.col("_head") / arity).alias("parent"), F.ceil(F.col("n") / arity).alias("left"),
                       "kids", F.sha2(F.array_join(F.transform("kids", lambda k: k.digest), ""), 256).alias("digest"))


def climb(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """(runs of each level, (tree, digest) of the trees' roots)."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots = [], nodes.where("n = 1").select("tree", "digest")
    while most > 1:
        runs = materialize(parents(nodes.where("n > 1"), arity))
        levels.append(runs)
        nodes = runs.select("tree", F.col("parent").alias("idx"), F.col("left").alias("n"), "digest")
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // arity)
    return levels, materialize(roots)


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, by: str = "source", key: str = "doc_id",
          arity: int = ARITY, altered: Column | None = None) -> Manifest:
    """The manifest of ``docs``. ``altered`` is the digest of a row's leaf as it
    is found later, null where it is unchanged; ``verify`` folds that one."""
    member = F.struct(F.col(key).alias("key"), (F.lit(None).cast("string") if altered is None else altered).alias("altered"))
    members = numbered(docs.select(F.col(by).alias("_tree"), F.col(key).alias("_key"), member.alias("member"),
                                   leaf([F.col(f) for f in fields]).alias("digest")))
    runs, subroots = climb(members, arity)
    sources = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"),
                              F.lit(subroots.count()).cast("long").alias("n"), "digest")
    top, root = climb(sources, arity)
    found = root.first()                # one row, or none for an empty table
    return Manifest(arity, members, runs, subroots, top, found and found["digest"])


def nodes(m: Manifest) -> DataFrame:
    """All nodes, to be written as the manifest: (tree, level, idx, digest); the
    tree over the sources has number -1 and its leaves are the subroots."""
    out = m.members.select("tree", F.lit(0).alias("level"), "idx", "digest")
    for k, runs in enumerate(m.runs):
        out = out.unionByName(runs.select("tree", F.lit(k + 1).alias("level"), F.col("parent").alias("idx"), "digest"))
    out = out.unionByName(m.subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), "digest"))
    for k, runs in enumerate(m.top):
        out = out.unionByName(runs.select("tree", F.lit(k + 1).alias("level"), F.col("parent").alias("idx"), "digest"))
    return out


def _members_of(runs: DataFrame, arity: int) -> DataFrame:
    """A row per node of the runs, with its path: its siblings, then the run's path."""
    hashes = F.transform("kids", lambda k: k.digest)
    kid = F.col("kid")
    step = F.struct(F.array_join(F.slice(hashes, F.lit(1), kid.slot), "").alias("before"),
                    F.array_join(F.slice(hashes, kid.slot + 2, F.lit(arity)), "").alias("after"))
    return (runs.select("tree", "parent", "kids", "subroot", "up", F.explode("kids").alias("kid"))
            .select("tree", (F.col("parent") * arity + kid.slot).alias("idx"), "subroot", "kid",
                    F.concat(F.array(step), F.col("up")).alias("up")))


def _nothing() -> Column:
    return F.array().cast("array<struct<before:string,after:string>>")


def descend(levels: list[DataFrame], tops: DataFrame | None, arity: int) -> DataFrame | None:
    """Paths of the lowest level's nodes. ``tops``: (tree, subroot, up), the
    path above each tree's root; None for the tree over the sources, above
    which there is nothing."""
    below = None
    for runs in reversed(levels):
        known = runs.where("left = 1")
        known = known.join(tops, "tree") if tops is not None else known.withColumns({"subroot": F.lit(""), "up": _nothing()})
        if below is not None:
            known = known.unionByName(runs.where("left > 1").join(
                below.select("tree", F.col("idx").alias("parent"), "subroot", "up"), ["tree", "parent"]))
        below = _members_of(known, arity)
    return below


def verify(m: Manifest) -> DataFrame:
    """A row per document: ``doc_id``, ``leaf``, ``subroot``, ``root``,
    ``path`` (siblings before and after, level by level), ``folded_root`` (the
    leaf as found, folded along the path) and ``verified``."""
    start = m.subroots.withColumn("subroot", F.col("digest"))
    lone = start.select(F.col("tree").alias("idx"), "subroot", _nothing().alias("up"))
    sources = descend(m.top, None, m.arity)
    tops = lone if sources is None else sources.select("idx", F.col("kid.digest").alias("subroot"), "up")
    tops = materialize(tops.withColumnRenamed("idx", "tree"))
    alone = m.members.where("n = 1").join(tops, "tree").select("subroot", "up", "member", F.col("digest").alias("leaf"))
    rows = alone
    deep = descend(m.runs, tops, m.arity)
    if deep is not None:
        rows = alone.unionByName(deep.select("subroot", "up", "kid.member", F.col("kid.digest").alias("leaf")))
    folded = F.aggregate("up", F.coalesce("member.altered", "leaf"), lambda h, s: digest(s.before, h, s.after))
    return rows.select(F.col("member.key").alias("doc_id"), "leaf", "subroot", F.lit(m.root).alias("root"),
                       F.col("up").alias("path"), folded.alias("folded_root"),
                       (folded == F.lit(m.root)).alias("verified"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", UPPER, LOWER)
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0,
                     leaf([lowered if f == "text" else F.col(f) for f in FIELDS]))
    rows = verify(build(table(spark, sf_dir, "documents"), altered=altered))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s.before, s.after)), "")
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                       "folded_root", "verified")


_LEAF = " || ".join(f"coalesce(strlen({f}::VARCHAR)::VARCHAR || ':' || {f}::VARCHAR, '-')" for f in FIELDS)
_FOUND = _LEAF.replace("text::VARCHAR", f"translate(text, '{UPPER}', '{LOWER}')::VARCHAR")

SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, sha256({_LEAF}) AS leaf, sha256({_FOUND}) AS lowered,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
             list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
             lambda x, y: xor(x >> 1, (x & 1) * 3988292384)))) AS crc
  FROM documents),
l AS (
  SELECT *, row_number() OVER () AS rid, CASE WHEN crc % 5 = 0 THEN lowered ELSE leaf END AS found,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
         count(*) OVER (PARTITION BY source) AS n FROM d),
tree AS (
  SELECT 0 AS lv, t, i, n, leaf AS h FROM l
  UNION ALL
  SELECT lv + 1, t, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM tree WHERE n > 1 GROUP BY lv, t, i // 16),
sub AS (SELECT t, h, count(*) OVER () AS n FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lv, t AS i, n, h FROM sub
  UNION ALL
  SELECT lv + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM top WHERE n > 1 GROUP BY lv, i // 16),
sib AS (
  SELECT lv, t, i, n, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b
  FROM (SELECT * FROM tree UNION ALL SELECT lv, -1, i, n, h FROM top) WHERE n > 1
  WINDOW w AS (PARTITION BY lv, t, i // 16 ORDER BY i)),
walk AS (
  SELECT rid, 0 AS lv, t, i, found AS cur, '' AS proof FROM l
  UNION ALL
  SELECT rid, lv + 1, t, i // 16, sha256(a || cur || b), proof || a || b FROM walk JOIN sib USING (lv, t, i)),
mid AS (SELECT rid, t, cur, proof FROM walk QUALIFY row_number() OVER (PARTITION BY rid ORDER BY lv DESC) = 1),
walk2 AS (
  SELECT rid, 0 AS lv, -1 AS t, t AS i, cur, proof FROM mid
  UNION ALL
  SELECT rid, lv + 1, t, i // 16, sha256(a || cur || b), proof || a || b FROM walk2 JOIN sib USING (lv, t, i)),
done AS (SELECT rid, cur, proof FROM walk2 QUALIFY row_number() OVER (PARTITION BY rid ORDER BY lv DESC) = 1)
SELECT l.doc_id, l.leaf, sub.h AS subroot, r.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.h AS verified
FROM l JOIN done USING (rid) JOIN sub ON sub.t = l.t, (SELECT h FROM top WHERE n = 1) r
"""
