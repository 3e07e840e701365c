"""Quality rules: hashed n-gram log-likelihood ratio against the raw corpus.

Word unigrams and bigrams are hashed into ``BUCKETS`` buckets. Two multinomials
over the buckets are counted: the trusted target (the
documents labelled ``quality = 1`` with even doc_id) and the raw corpus
(every document, no sample). A document's score is the sum of its n-grams' log
ratios divided by their number.

The threshold is fixed once per run from labelled documents the target has not
seen (odd doc_id, all of them): ``g`` is the score that all but
``good_loss`` of the good ones reach, ``b`` the best bad score below it, and
the threshold lies half way. A document is kept if it reaches the threshold and
the base rule (50 words or more, at most half of the words in repeated 3-word
windows) holds.

Log ratios are rounded to whole micro-nats and scores to whole micro-nats per
n-gram, so nothing depends on the order of addition and a rerun decides alike.

Defined results: a null text is an empty one; a text without words has no
n-grams and fails the base rule; repeated rows are scored each; rows with null
``doc_id`` are scored but never part of the target; an empty table gives no
rows. Without labels only the base rule decides. Extra columns pass through
``score``; columns of its own output names are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cuenca.llm.common import WordHash, slices, table
from cuenca.session import materialize

NAME = "op4_quality_llr"
BUCKETS = 65536          # 32768 for words, 32749 used of 32768 for word pairs
MICRO = 1_000_000
BITS = 1 << 26           # at most (8 MB) of the filter before the join with labelled doc_ids
STEP = 12                # low bits of a score left out of the first counts of ``nth``
GOOD_LOSS = 0.001        # share of held-out good documents below the threshold

_STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, llr_micro long")
_OWN = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "llr_micro", "llr", "kept"}


class _Words:
    """The words of a batch of documents in one array of hashes; ``first`` and
    ``count`` say which belong to which document."""

    def __init__(self, texts, hashes: WordHash):
        import numpy as np
        words = [b.split() for b in texts]
        self.count = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.hash = hashes.of([w for ws in words for w in ws])
        self.doc = np.repeat(np.arange(len(words)), self.count)

    def grams(self):
        """(document, bucket) of every word, then of every word pair."""
        import numpy as np
        h = (self.hash >> np.uint64(32)).astype(np.int64)
        pair = np.flatnonzero(self.doc[1:] == self.doc[:-1])
        return (np.concatenate([self.doc, self.doc[pair]]),
                np.concatenate([h % 32768, 32768 + (h[pair] * 2654435 + h[pair + 1]) % 32749]))

    def repeated(self):
        """Words of each document inside 3-word windows that it holds twice or more."""
        import numpy as np
        h, doc = self.hash, self.doc
        n = len(self.count)
        if len(h) < 4:
            return np.zeros(n, np.int64)
        at = np.flatnonzero(doc[2:] == doc[:-2])
        a, b, c = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
        w = (h[at] * a + h[at + 1]) * b + h[at + 2]
        w = (w ^ (w >> np.uint64(31))) + doc[at].astype(np.uint64) * c
        order = np.argsort(w, kind="stable")
        s = w[order]
        same = np.zeros(len(s) + 1, bool)
        same[1:-1] = s[1:] == s[:-1]
        start = at[order[same[:-1] | same[1:]]]
        cover = np.zeros(len(h), bool)
        for k in range(3):
            cover[start + k] = True
        return np.bincount(doc[cover], minlength=n)


def _texts(batch, col="text"):
    import pyarrow as pa
    return [b or b"" for b in batch.column(col).cast(pa.binary()).to_pylist()]


def likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of the documents in ``ids`` and a few others: a
    bitmap of hashed ids, 16 bits an id and ``BITS`` at most, decides in the
    scan. An exact join on ``doc_id`` has to follow."""
    bits = 1 << 16
    while bits < min(16 * ids.count(), BITS):
        bits *= 2
    h = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(bits))
    known = (ids.select(h.alias("_h")).groupBy(F.shiftright("_h", 6).alias("_w"))
             .agg(F.expr("bit_or(shiftleft(1L, CAST(_h % 64 AS INT)))").alias("_b")))
    return (docs.select("doc_id", "text", h.alias("_h")).withColumn("_w", F.shiftright("_h", 6))
            .join(F.broadcast(known), "_w").where("bit_get(_b, CAST(_h % 64 AS INT)) = 1").select("doc_id", "text"))


def count_grams(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, raw, target) counts over all ``docs``; ``target`` holds the
    doc_ids of the trusted sample. Each task sends its own sums only: at most
    ``BUCKETS`` rows."""
    flagged = (docs.select(F.lit(False).alias("t"), "text")
               # an inner join: Spark would move a semi join in front of the bitmap
               .unionAll(likely(docs, target).join(target, "doc_id").select(F.lit(True).alias("t"), "text")))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        hashes = WordHash()
        raw, tgt = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in (s for b in batches for s in slices(b)):
            doc, bucket = _Words(_texts(batch), hashes).grams()
            t = batch.column("t").to_numpy(zero_copy_only=False).astype(bool)[doc]
            raw += np.bincount(bucket[~t], minlength=BUCKETS)
            tgt += np.bincount(bucket[t], minlength=BUCKETS)
        at = np.flatnonzero(raw + tgt)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(tgt[at])],
                                         names=["bucket", "raw", "target"])

    return (flagged.mapInArrow(run, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


def log_ratios(counts: DataFrame):
    """Micro-nat log ratios of all buckets (a fixed-size vector) with add-one
    smoothing."""
    import numpy as np
    raw, tgt = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # at most BUCKETS rows
        raw[r["bucket"]], tgt[r["bucket"]] = r["raw"], r["target"]
    ratio = np.log((tgt + 1) * (raw.sum() + BUCKETS) / ((raw + 1) * (tgt.sum() + BUCKETS)))
    return np.rint(ratio * MICRO).astype(np.int64)


def labelled(labels: DataFrame, quality: int, parity: int) -> DataFrame:
    """doc_ids of one label and parity."""
    return (labels.where((F.col("quality") == quality) & (F.pmod("doc_id", F.lit(2)) == parity))
            .select("doc_id").distinct())


def nth(scores: DataFrame, k: int) -> int:
    """The ``k``-th least ``llr_micro``, from 0. Counts by range find the range that
    holds it (a log ratio has under 2**26 micro-nats, so there are few), counts
    by value the value."""
    def narrow(df, key):
        nonlocal k
        for r in sorted(df.groupBy(key.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()):
            if k < r["n"]:
                return r["v"]
            k -= r["n"]

    by_range = F.shiftright("llr_micro", STEP)
    return narrow(scores.where(by_range == narrow(scores, by_range)), F.col("llr_micro"))


def measure(docs: DataFrame, ratios) -> DataFrame:
    """``docs`` with the base statistics and ``llr_micro``: whole micro-nats per
    n-gram (rounded down), 0 without n-grams."""
    schema = T.StructType([f for f in docs.schema.fields if f.name not in _OWN]
                          + T._parse_datatype_string(_STATS).fields)
    through = [f.name for f in docs.schema.fields if f.name not in _OWN]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        hashes, ratio = WordHash(), ratios.value
        symbol = np.zeros(256, np.int64)
        symbol[list(b"#*$%&|<>")] = 1
        char = np.array([0 if 0x80 <= i < 0xC0 or i == 32 or 9 <= i <= 13 else 1 for i in range(256)])
        for batch in (s for b in batches for s in slices(b)):
            texts = _texts(batch)
            words = _Words(texts, hashes)
            n = words.count
            doc, bucket = words.grams()
            grams = np.bincount(doc, minlength=len(n))
            # the partial sums are whole numbers far below 2**53: exact
            total = np.bincount(doc, weights=ratio[bucket], minlength=len(n))
            llr = np.floor(total / np.maximum(grams, 1)).astype(np.int64)
            repeated = words.repeated()
            by_byte = np.array([np.bincount(np.frombuffer(b, np.uint8), minlength=256) for b in texts]
                               ).reshape(-1, 256)
            dup = []
            for b in texts:
                lines = [x for x in b.split(b"\n") if x.strip()]
                dup.append(len(lines) - len(set(lines)))
            out = [n, by_byte @ char, by_byte @ symbol, np.array(dup, np.int64), repeated,
                   (n < 50) | (100 * repeated > 50 * n), llr]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in through] + [pa.array(x) for x in out],
                                             names=[f.name for f in schema.fields])

    return docs.select(*through).mapInArrow(run, schema)


def held_out(labels: DataFrame) -> DataFrame:
    """(doc_id, _q) of the labelled documents that fix the threshold."""
    return (labelled(labels, 1, 1).withColumn("_q", F.lit(1))
            .unionByName(labelled(labels, 0, 1).withColumn("_q", F.lit(0))))


def threshold(measured: DataFrame, labels: DataFrame, good_loss: float = GOOD_LOSS) -> int | None:
    """The least score kept, in micro-nats per n-gram, from measured rows; None
    without held-out good documents. Only numbers are joined with the labels."""
    held = materialize(measured.where(~F.col("base_failed")).select("doc_id", "llr_micro")
                       .join(held_out(labels), "doc_id").select("_q", "llr_micro"))
    good = held.where("_q = 1")
    n = good.count()
    if not n:
        return None
    g = nth(good, int(good_loss * n))
    bad = held.where((F.col("_q") == 0) & (F.col("llr_micro") < g)).agg(F.max("llr_micro")).first()[0]
    return g if bad is None else (g + bad) // 2


def _ratios(docs: DataFrame, labels: DataFrame):
    return docs.sparkSession.sparkContext.broadcast(  # BUCKETS numbers, whatever the input
        log_ratios(count_grams(docs, labelled(labels, 1, 0))))


def _judged(measured: DataFrame, least: int | None) -> DataFrame:
    verdict = F.lit(True) if least is None else F.col("llr_micro") >= F.lit(least)
    return (measured.withColumn("llr", F.col("llr_micro") / MICRO)
            .withColumn("kept", ~F.col("base_failed") & verdict).drop("llr_micro"))


def verdicts(docs: DataFrame, labels: DataFrame, good_loss: float = GOOD_LOSS) -> DataFrame:
    """``doc_id``, base statistics, ``llr`` and ``kept`` of every document, which is
    measured once: the numbers are written, the threshold is taken from
    them and the verdicts are a filter on the same rows."""
    rows = materialize(measure(docs.select("doc_id", "text"), _ratios(docs, labels)).drop("text"))
    return _judged(rows, threshold(rows, labels, good_loss))


def score(docs: DataFrame, labels: DataFrame, good_loss: float = GOOD_LOSS) -> DataFrame:
    """``docs`` with the base statistics, ``llr`` (nats per n-gram) and ``kept``. The
    threshold comes from the labelled documents, measured first, so that the
    texts that pass through are neither written nor shuffled."""
    ratios = _ratios(docs, labels)
    known = measure(likely(docs, held_out(labels).select("doc_id").distinct()), ratios)
    return _judged(measure(docs, ratios), threshold(known, labels, good_loss))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
tgt AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id % 2 = 0),
hw AS (
  SELECT rid, doc_id, list_transform(ws, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT) AS h, ws FROM w),
grams AS (
  SELECT rid, doc_id, unnest(list_concat(
    list_transform(h, lambda x: x % 32768),
    list_transform(range(1, len(h)), lambda i: 32768 + (h[i] * 2654435 + h[i + 1]) % 32749))) AS b
  FROM hw),
cnt AS (
  SELECT b, count(*) AS raw, count(*) FILTER (doc_id IN (SELECT doc_id FROM tgt)) AS t FROM grams GROUP BY b),
tot AS (SELECT sum(raw) AS r, sum(t) AS t FROM cnt),
lr AS (
  SELECT b, CAST(round(ln((cnt.t + 1.0::DOUBLE) * (tot.r + 65536) / ((cnt.raw + 1.0::DOUBLE) * (tot.t + 65536))) * 1000000) AS BIGINT) AS m
  FROM cnt, tot),
sc AS (SELECT rid, sum(m) AS m, count(*) AS n FROM grams JOIN lr USING (b) GROUP BY rid),
win AS (
  SELECT rid, unnest(range(1, len(ws) - 1)) AS i,
         unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS g
  FROM hw WHERE len(ws) >= 3),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win),
cov AS (
  SELECT rid, count(DISTINCT p) AS n_repeat
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep WHERE c > 1) GROUP BY rid),
ln AS (
  SELECT rid, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
st AS (
  SELECT w.rid, w.doc_id, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(ln.dup, 0)::BIGINT AS n_dup_lines, coalesce(cov.n_repeat, 0)::BIGINT AS n_repeat_words,
         coalesce(sc.m, 0) AS m, coalesce(sc.n, 0) AS n
  FROM w LEFT JOIN ln USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN sc USING (rid)),
b AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
         CASE WHEN n = 0 THEN 0 ELSE floor(m::DOUBLE / n) END AS llr FROM st),
held AS (
  SELECT quality, llr FROM b JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE doc_id % 2 = 1) USING (doc_id)
  WHERE NOT base_failed),
g AS (
  SELECT llr AS g FROM (
    SELECT llr, row_number() OVER (ORDER BY llr) AS i, count(*) OVER () AS n FROM held WHERE quality = 1)
  WHERE i = floor(0.001 * n) + 1),
t AS (SELECT g, (SELECT max(llr) FROM held, g WHERE quality = 0 AND llr < g) AS bad FROM g)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND llr >= coalesce((SELECT coalesce(floor((g + bad) / 2), g) FROM t), llr)) AS kept
FROM b
"""
