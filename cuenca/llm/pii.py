"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base rules find e-mail and IP addresses, card and phone numbers; these spans are
the seed instances. Their contexts induce lexical patterns: the word before
(``L:word``) and the word after (``R:word``). Other identifier-like tokens (with
a digit, ``MIN_LENGTH`` characters or more, outside base spans) and groups of
short ones (``QQ 12 34 56 C``) are candidate instances. On the bipartite graph of
patterns and instances, scores are passed to and fro, as joins and aggregates,
until no score grows by ``SETTLED`` any more (scores never fall, so this ends):

* a pattern's score is the sum of its instances' scores over all places where
  its word occurs in the corpus, identifiers or not, so a common word is a weak
  pattern however many seeds stand beside it; it needs ``SUPPORT`` different
  instances, each of a score of ``ACCEPT`` or more;
* an instance's score is 1 for a seed, else 1 - prod(1 - pattern score) over its
  patterns of a score of ``CONFIDENT`` or more.

Candidates that end with a score of ``ACCEPT`` or more become spans of kind
``context``. Their new patterns count in the next round, so identifiers that no
base rule describes lead to others.

Only documents with an identifier have rows in the graph; the corpus-wide word
counts are one map-side combined aggregate, joined to the graph's words.

Defined results: a null or empty text has no spans; repeated rows are reported
each, while the graph counts equal texts with equal ids once; null ids pass
through; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cuenca.llm.common import table
from cuenca.session import materialize

NAME = "op5_pii_bootstrap"
SQL = None
SUPPORT, CONFIDENT, ACCEPT, MIN_LENGTH, SETTLED = 3, 0.5, 0.6, 5, 0.001
BESIDE = 100             # characters looked at for the word beside; all, if it is longer

# The contract's rules. Possessive quantifiers keep the matches and need no
# stack; a match starts where the last one ended or where a run begins, which
# are the only starts a leftmost search can take.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IDENTIFIER = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
# two to eight pieces of four capitals or digits at most, with spaces between
GROUP = r"(?<!\S)(?=[A-Z ]{0,39}[0-9])[A-Z0-9]{1,4}(?:\x20[A-Z0-9]{1,4}){1,7}(?!\S)"
KINDS = ("email", "ip", "card", "phone", "context")
BYTE = r"0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"

_SPANS = "array<struct<start:int,rank:int,stop:int,value:string>>"


def matches(text: Column, regex: str, rank: int, only_if: Column) -> Column:
    """All matches of a text with their code point positions: the pieces between
    the matches give the starts. Texts that fail ``only_if`` are not searched."""
    found = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    pieces = F.split(text, regex, -1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    step = lambda acc, x: F.struct(
        (acc["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + F.length(x["p"])).alias("start"), F.lit(rank).alias("rank"),
            (acc["at"] + F.length(x["p"]) + F.length(x["m"])).alias("stop"), x["m"].alias("value")))).alias("out"))
    pairs = F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda m, p: F.struct(m.alias("m"), p.alias("p")))
    return F.when(only_if, F.aggregate(pairs, zero, step, lambda acc: acc["out"])).otherwise(F.array().cast(_SPANS))


def _luhn(digits: Column) -> Column:
    ds = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).when(d.cast("int") >= 5, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))
    return F.aggregate(ds, F.lit(0), lambda a, d: a + d) % 10 == 0


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, base, cand): spans of the base rules and other identifiers."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    has = d.withColumn("_digit", F.col("text").rlike("[0-9]"))
    d = has.select(
        "doc_id", "text",
        matches(F.col("text"), EMAIL, 0, F.contains("text", F.lit("@"))).alias("_e"),
        matches(F.col("text"), IP, 1, F.col("_digit") & F.col("text").rlike(r"[0-9]\.[0-9]++\.[0-9]")).alias("_i"),
        matches(F.col("text"), CARD, 2, F.col("_digit")).alias("_c"),
        matches(F.col("text"), PHONE, 3, F.col("_digit") & F.contains("text", F.lit("+"))).alias("_p"),
        matches(F.col("text"), IDENTIFIER, 4, F.col("_digit")).alias("_x"),
        matches(F.col("text"), GROUP, 4, F.col("_digit")).alias("_g"))
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    ip = F.filter("_i", lambda m: m["value"].rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"))
    card = F.filter("_c", lambda m: F.length(digits(m["value"])).between(14, 19) & _luhn(digits(m["value"])))
    phone = F.filter("_p", lambda m: F.length(digits(m["value"])).between(10, 15))
    d = d.select("doc_id", "text", F.array_sort(F.concat("_e", ip, card, phone)).alias("base"), F.concat("_x", "_g").alias("_x"))
    free = F.filter("_x", lambda c: (F.length(c["value"]) >= MIN_LENGTH) & ~F.exists(
        "base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    return d.select("doc_id", "text", "base", free.alias("cand"))


def graph(spans: DataFrame) -> DataFrame:
    """(doc_id, _h, start, stop, seed, value, pattern): an edge for each
    identifier and each word beside it."""
    word = r"[^\x20\x09-\x0D]+"
    rows = (spans.where((F.size("base") > 0) | (F.size("cand") > 0))
            .select("doc_id", F.xxhash64("text").alias("_h"), "text", F.explode(F.concat("base", "cand")).alias("s")))
    left, right = rf"({word})[\x20\x09-\x0D]+$", rf"^[^\x20\x09-\x0D]*[\x20\x09-\x0D]+({word})"
    near = F.substring("text", F.greatest(F.lit(1), F.col("s.start") - BESIDE + 1), F.least(F.lit(BESIDE), F.col("s.start")))
    # a piece that is one long word, or ends inside one, is too short: then the whole text decides
    before = F.when(near.rlike(rf"[\x20\x09-\x0D]{word}[\x20\x09-\x0D]+$") | (F.col("s.start") <= BESIDE), F.regexp_extract(near, left, 1)
                    ).otherwise(F.regexp_extract(F.substring("text", F.lit(1), F.col("s.start")), rf"(?:^|[\x20\x09-\x0D]){left}", 1))
    near = F.substring("text", F.col("s.stop") + 1, F.lit(BESIDE))
    rest = F.substring("text", F.col("s.stop") + 1, F.length("text"))
    after = F.when(near.rlike(rf"{right}[\x20\x09-\x0D]") | (F.length("text") - F.col("s.stop") <= BESIDE), F.regexp_extract(near, right, 1)
                   ).otherwise(F.regexp_extract(rest, right, 1))
    return (rows.select("doc_id", "_h", F.col("s.start").alias("start"), F.col("s.stop").alias("stop"), (F.col("s.rank") < 4).alias("seed"),
                        F.col("s.value").alias("value"),
                        F.explode(F.array(F.concat(F.lit("L:"), F.lower(before)), F.concat(F.lit("R:"), F.lower(after)))).alias("pattern"))
            .where(F.length("pattern") > 2).distinct())


def occurrences(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """(pattern, total): how often each pattern's word occurs in the corpus, for
    patterns with ``SUPPORT`` different instances."""
    wanted = (edges.groupBy("pattern").agg(F.count_distinct("value").alias("n")).where(F.col("n") >= SUPPORT)
              .select("pattern", F.substring("pattern", 3, 1 << 30).alias("word")))
    count = (docs.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+")).alias("word"))
             .groupBy("word").agg(F.count(F.lit(1)).alias("total")))
    return wanted.join(count, "word").select("pattern", "total")


def discovered(docs: DataFrame, spans: DataFrame, rounds: int | None = None) -> DataFrame:
    """(doc_id, _h, start, stop, value, score) of the candidates accepted; after
    ``rounds`` rounds at most, if given."""
    key = ["doc_id", "_h", "start", "stop"]
    edges = materialize(graph(spans))
    totals = materialize(occurrences(docs, edges))
    # patterns with too few instances can never be confident
    edges = materialize(edges.join(totals, "pattern"))
    scores = edges.select(*key, "value", "pattern", "total", "seed", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("score"))
    done, grown = 0, 1.0
    while grown >= SETTLED and (rounds is None or done < rounds):
        patterns = (scores.groupBy("pattern").agg(
            F.round(F.sum("score") / F.max("total"), 9).alias("p"),
            F.count_distinct(F.when(F.col("score") >= ACCEPT, F.col("value"))).alias("n"))
            .where((F.col("n") >= SUPPORT) & (F.col("p") >= CONFIDENT)).select("pattern", F.least("p", F.lit(1.0)).alias("p")))
        linked = (edges.join(patterns, "pattern").groupBy("value")
                  .agg(F.collect_set(F.struct("pattern", "p")).alias("_ps"))
                  .select("value", (1.0 - F.aggregate(F.array_sort("_ps"), F.lit(1.0), lambda a, x: a * (1.0 - x["p"]))).alias("by_pattern")))
        scores = materialize(
            scores.join(linked, "value", "left").select(
                *key, "value", "pattern", "total", "seed", F.col("score").alias("before"),
                F.when(F.col("seed"), 1.0).otherwise(F.coalesce("by_pattern", F.lit(0.0))).alias("score")))
        done += 1
        grown = scores.agg(F.max(F.col("score") - F.col("before"))).first()[0] or 0.0
    return (scores.where((~F.col("seed")) & (F.col("score") >= ACCEPT))
            .groupBy(*key).agg(F.max("value").alias("value"), F.max("score").alias("score")))


def extract(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """(doc_id, text, spans): ``spans`` holds start, rank of the kind, stop and value."""
    spans = base_spans(docs)
    more = (discovered(docs, spans, rounds).groupBy("doc_id", "_h")
            .agg(F.collect_list(F.struct("start", F.lit(4).alias("rank"), "stop", "value")).alias("_more"))
            .withColumnsRenamed({"doc_id": "_d", "_h": "_g"}))
    return (spans.withColumn("_h", F.xxhash64("text"))
            .join(more, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_g")), "left")
            .select("doc_id", "text", "base",
                    F.array_sort(F.concat("base", F.coalesce("_more", F.array().cast(_SPANS)))).alias("spans")))


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
                        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
