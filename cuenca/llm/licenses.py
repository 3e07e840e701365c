"""License scans with a positional index of rare tokens, in DataFrame functions only.

Templates are short public notices. The index holds, for each template, its
``RARE`` words of highest inverse document frequency (counted over all
documents) and the words of its mandatory key phrases, each with its position.
The rarest word of a template's key phrase is its anchor: a document looks up
the templates whose anchor it holds (no other can be verified in it) with all
licence words it holds, whose number the templates bound. Texts are split into
words once; the frequencies, the base phrases and the licence words' places come
out of that pass as short rows, from which all else follows. Hits of a template are
intersected by relative position: a hit at document position d of the
template's position t votes for the start d - t. A template is found where at
least ``VOTES`` of its rare words agree on a start and every word of a
mandatory phrase stands at its place relative to that start.

Base phrases are found beside it at every place where their words stand
consecutively. ``score`` is 1 for a base phrase, else the largest share of
a found template's rare words that agree, else 0.

Defined results: a null or empty text has no words, no labels, score 0 and null
places; repeated rows are reported each; null ids pass through; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cuenca.llm.common import table
from cuenca.session import materialize

NAME = "op9_license_index"
RARE, VOTES = 6, 0.6
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: fixed values of the contract: phrase and label
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: label, notice, mandatory key phrase
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("gpl", "licensed under the gnu general public license", "gnu general public license"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case, as far as ASCII words can tell. ``lower``
    does that many times faster than ``translate``; beyond ASCII it changes
    letters into letters, except two signs that it turns into ASCII letters."""
    ascii_only = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(text.contains("\u0130") | text.contains("\u212a"), ascii_only).otherwise(F.lower(text))


def short_rows(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """All that the scan needs of the texts, in one pass:
    (doc_id, _h, n_words, _p0.., held, at). ``held`` are the licence words of a
    document; ``at`` their places (at, word), for documents that hold all
    words of some template's mandatory phrase, as no other can have one found."""
    text = F.coalesce("text", F.lit(""))
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, notice, _ in templates for w in notice.split()})])
    tokens = docs.select("doc_id", F.xxhash64(text).alias("_h"), lowered(text).alias("_low")).withColumn(
        "words", F.regexp_extract_all("_low", F.lit(TOKEN), F.lit(0)))
    held = tokens.withColumn("held", F.array_intersect("words", vocabulary.cast("array<string>")))
    whole = F.lit(False)
    for key in sorted({key for _, _, key in templates}):
        whole = whole | _all(F.array_contains("held", w) for w in sorted(set(key.split())))
    at = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word"))),
                  lambda x: F.array_contains("held", x.word))
    return held.select("doc_id", "_h", F.size("words").cast("long").alias("n_words"),
                       *[F.coalesce(_places(p), F.array().cast("array<int>")).alias(f"_p{k}") for k, (p, _) in enumerate(BASE)],
                       "held", F.when(whole, at).alias("at"))


def _places(phrase: str) -> Column:
    """Starts of the phrase's words in ``words``; the text is searched first, so
    only documents that may hold the phrase are walked."""
    ws = phrase.split()
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1),
                  lambda i: _all(F.get("words", i + k) == w for k, w in enumerate(ws)))
    return F.when(F.col("_low").rlike(GAP.join(ws)), F.when(F.size("words") > 0, at))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _templates(spark: SparkSession, templates) -> DataFrame:
    """(t, label, pos, word, must): a row for each word of each notice."""
    rows = []
    for t, (label, notice, key) in enumerate(templates):
        ws, ks = notice.split(), key.split()
        at = next(i for i in range(len(ws)) if ws[i:i + len(ks)] == ks)
        rows += [f"({t}, '{label}', {p}, '{w}', {str(at <= p < at + len(ks)).lower()})" for p, w in enumerate(ws)]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS v(t, label, pos, word, must)")


def index(rows: DataFrame, templates=TEMPLATES) -> DataFrame:
    """The positional index: (t, label, pos, word, must, rare, idf, anchor). Its
    size depends on the templates only."""
    words = _templates(rows.sparkSession, templates)
    df = rows.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n = rows.count()
    idf = F.round(F.ln((F.lit(n) + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0)), 9)
    from pyspark.sql import Window
    by_idf = Window.partitionBy("t").orderBy(F.desc("idf"), "word", "pos")
    return (words.join(F.broadcast(df), "word", "left")     # a row per licence word
            .withColumn("idf", idf).withColumn("rare", F.row_number().over(by_idf) <= RARE)
            .withColumn("anchor", F.first(F.when(F.col("must"), F.col("word")), ignorenulls=True).over(
                by_idf.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .where("rare or must").select("t", "label", "pos", "word", "must", "rare", "idf", "anchor"))


def found(rows: DataFrame, postings: DataFrame) -> DataFrame:
    """(doc_id, _h, labels, score) of the documents in which a template is found."""
    hits = (rows.where(F.col("at").isNotNull()).select("doc_id", "_h", "held", F.inline("at"))
            .join(F.broadcast(postings), "word").where(F.array_contains("held", F.col("anchor"))))
    need = postings.groupBy("t").agg(F.count(F.when(F.col("rare"), 1)).alias("n_rare"), F.count(F.when(F.col("must"), 1)).alias("n_must"))
    # template positions that agree on a start, as a bitmap (notices have under 64 words)
    bit = F.expr("shiftleft(1L, pos)")
    places = lambda c: F.bit_count(F.coalesce(F.bit_or(F.when(F.col(c), bit)), F.lit(0).cast("long")))
    starts = (hits.groupBy("doc_id", "_h", "t", "label", (F.col("at") - F.col("pos")).alias("start"))
              .agg(places("rare").alias("votes"), places("must").alias("musts")))
    return (starts.join(F.broadcast(need), "t")
            .where((F.col("musts") == F.col("n_must")) & (F.col("votes") >= F.lit(VOTES) * F.col("n_rare")))
            .groupBy("doc_id", "_h").agg(F.collect_set("label").alias("labels"), F.max(F.col("votes") / F.col("n_rare")).alias("score")))


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """A row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score. The texts are read once, into a table of short rows."""
    rows = materialize(short_rows(docs, templates))
    places = F.concat(*[F.col(f"_p{k}") for k in range(len(BASE))])
    names = F.filter(F.array(*[F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull())
    base = rows.select("doc_id", "_h", "n_words", F.size(places).cast("long").alias("n_base"),
                       F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
                       names.alias("_base"))
    extra = found(rows, materialize(index(rows, templates))).withColumnsRenamed({"doc_id": "_d", "_h": "_g"})
    both = F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("labels", F.array().cast("array<string>")))))
    return (base.join(extra, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left")
            .select("doc_id", "n_words", "n_base", "first_word", "last_word",
                    F.array_join(F.array_sort("_base"), ",").alias("base_labels"), F.array_join(both, ",").alias("labels"),
                    F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    values = []
    for t, (label, notice, key) in enumerate(TEMPLATES):
        ws, ks = notice.split(), key.split()
        at = next(i for i in range(len(ws)) if ws[i:i + len(ks)] == ks)
        values += [f"({t}, '{label}', {p}, '{w}', {str(at <= p < at + len(ks)).lower()})" for p, w in enumerate(ws)]
    bases = []
    for phrase, label in BASE:
        ws = phrase.split()
        cond = " AND ".join(f"ws[here + {k + 1}] = '{w}'" for k, w in enumerate(ws))
        bases.append(f"SELECT rid, here, '{label}' AS label FROM tok JOIN w USING (rid) WHERE {cond}")
    return f"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TOKEN}') AS ws
  FROM documents),
tok AS (SELECT rid, unnest(range(len(ws))) AS here, unnest(ws) AS word FROM w),
tpl(t, label, pos, word, must) AS (VALUES {', '.join(values)}),
df AS (SELECT word, count(DISTINCT rid) AS df FROM tok WHERE word IN (SELECT word FROM tpl) GROUP BY word),
num AS (SELECT count(*) AS n FROM w),
idf AS (
  SELECT t, label, pos, word, must,
         round(ln((n + 1)::DOUBLE / (coalesce(df, 0) + 1)::DOUBLE), 9) AS idf
  FROM tpl LEFT JOIN df USING (word), num),
idx AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY idf DESC, word, pos) <= {RARE} AS rare FROM idf)
  WHERE rare OR must),
hits AS (SELECT tok.rid, t, label, pos, must, rare, here - pos AS start FROM tok JOIN idx USING (word)),
need AS (SELECT t, count(*) FILTER (rare) AS n_rare, count(*) FILTER (must) AS n_must FROM idx GROUP BY t),
starts AS (
  SELECT rid, t, label, count(DISTINCT pos) FILTER (rare) AS votes, count(DISTINCT pos) FILTER (must) AS musts
  FROM hits GROUP BY rid, t, label, start),
method AS (
  SELECT rid, label, votes::DOUBLE / n_rare AS share FROM starts JOIN need USING (t)
  WHERE musts = n_must AND votes >= {VOTES} * n_rare),
base AS ({' UNION ALL '.join(bases)}),
b AS (
  SELECT rid, count(*) AS n_base, min(here) AS first_word, max(here) AS last_word,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels FROM base GROUP BY rid),
l AS (
  SELECT rid, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
  FROM (SELECT rid, label FROM base UNION ALL SELECT rid, label FROM method) GROUP BY rid),
s AS (SELECT rid, max(share) AS share FROM method GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN b USING (rid) LEFT JOIN l USING (rid) LEFT JOIN s USING (rid)
"""


SQL = _sql()
