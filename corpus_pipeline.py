"""The corpus pipeline: quality rules, n-gram Jaccard join, benchmark
decontamination, mixing, token files.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; all but the last return the columns of ``documents``. ``run``
writes each stage's result as Parquet in the shared folder and reads it back,
so a lost executor re-reads a finished stage and never redoes one; a stage's
scratch tables, and the result before, are deleted when its own is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.llm import decontaminate, mixing, ngram_join, quality_llr, token_files
from cuenca.llm.common import table
from cuenca.session import delete_table, materialize, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    scored = quality_llr.score(docs, table(spark, sf_dir, "labels"))
    return scored.where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least doc_id, of each group of near copies."""
    return ngram_join.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, one or two rows each."""
    return (mixing.mix(docs).where("copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select(docs.columns))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' rows, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.encode(docs)


STAGES = [("quality rules", quality_rules), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontaminated), ("mixing sources", mixed),
          ("token-ID output", token_output)]

#: the token-ID stage runs a tokenizer, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        with scratch_scope(spark) as scope:      # a stage's own tables go with it
            docs = materialize(stage(spark, docs, sf_dir))
            here = scope.keep_last()
        if before:                               # the next stage's result is written
            delete_table(spark, before)
        before = here
    return docs
