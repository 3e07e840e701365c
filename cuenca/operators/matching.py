"""Approximate entity matching without comparing every pair.

Two strings within Levenshtein distance k always share a key of their deletion
neighbourhoods (the string and every string with up to k characters removed).
Exploding each distinct name into those keys and equi-joining on the key finds
every candidate pair through a shuffle join; the exact distance is then checked
on the candidates only.

Equal names are one group: its record of the least id stands for it, every other
record is paired with that one only, at distance 0, and names are compared
between representatives. So a name shared by many records gives as many pairs
as records, not their square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def deletion_keys(names: DataFrame, name_col: str, max_dist: int = 1) -> DataFrame:
    """(columns…, _key): the name and each string with up to ``max_dist`` of
    its characters deleted."""
    keyed = names.withColumn("_key", F.col(name_col))
    out = keyed
    for _ in range(max_dist):
        at = F.explode(F.sequence(F.lit(1), F.greatest(F.length("_key"), F.lit(1))))
        keyed = (keyed.withColumn("_i", at)
                 .withColumn("_key", F.concat(F.expr("substring(_key, 1, _i - 1)"), F.expr("substring(_key, _i + 1)")))
                 .drop("_i").distinct())
        out = out.unionByName(keyed)
    return out.distinct()


def fuzzy_pairs(df: DataFrame, id_col: str, name_col: str, max_dist: int = 1) -> DataFrame:
    """(id_a, id_b, distance), id_a < id_b, of records whose names are within
    ``max_dist``; equal names through their representative (see above).
    Records with a NULL name match nothing."""
    rows = df.where(F.col(name_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(name_col).alias("name"))
    reps = rows.groupBy("name").agg(F.min("id").alias("rep"))
    same = (rows.join(reps, "name").where(F.col("id") > F.col("rep"))
            .select(F.col("rep").alias("id_a"), F.col("id").alias("id_b"), F.lit(0).alias("distance")))
    k = deletion_keys(reps, "name", max_dist)
    a = k.select(F.col("rep").alias("id_a"), F.col("name").alias("name_a"), "_key")
    b = k.select(F.col("rep").alias("id_b"), F.col("name").alias("name_b"), "_key")
    near = (a.join(b, "_key").where(F.col("id_a") < F.col("id_b")).select("id_a", "id_b", "name_a", "name_b").distinct()
            .withColumn("distance", F.levenshtein("name_a", "name_b")).where(F.col("distance") <= max_dist))
    return near.select("id_a", "id_b", "distance").unionByName(same)


def same_document(df: DataFrame, id_col: str, document_col: str) -> DataFrame:
    """(id_a, id_b) of records with the same document number once punctuation,
    blanks, case and leading zeros are set aside; the least id of a number is
    paired with each other record of it."""
    number = F.regexp_replace(F.upper(F.regexp_replace(F.col(document_col).cast("string"), "[^0-9A-Za-z]", "")), "^0+", "")
    rows = df.select(F.col(id_col).alias("id"), number.alias("number")).where(F.length("number") > 0)
    reps = rows.groupBy("number").agg(F.min("id").alias("rep"))
    return (rows.join(reps, "number").where(F.col("id") > F.col("rep"))
            .select(F.col("rep").alias("id_a"), F.col("id").alias("id_b")))
