"""Document fingerprints: context-triggered piecewise hashing.

A rolling hash over the last 8 bytes marks chunk ends: at block size ``2**k``
a byte ends a chunk if its hash is below ``2**(32 - k)``, so the marks of a block
size hold those of all larger ones and one pass serves all. A document's block
size is the least one (from 4) that gives at most 64 chunks. Every chunk, the
rest of the text included, gives one base-64 character of its CRC-32; the
fingerprint is ``block size:characters:characters at the next block size``.

Two fingerprints are compared at equal block sizes, or at the one that both
have if they differ by one step; otherwise they are not alike (0). The likeness is
1 - d / (length + length), d being the edit distance of insertions and deletions
(a substitution is one of either), and 0 unless four characters in a row are
common, which chance gives to few pairs. Equal fingerprints have likeness 1.

``edited`` compares every document with the next one in ascending doc_id and
with its text whose last half is replaced by the head of the next one's text.
The texts are range-partitioned once; a task streams its rows in order and
looks one row ahead. The last row of a range needs the first row of the
next: both are written with their texts, one of each per range, and joined.

Defined results: a null text is an empty one, whose fingerprint is ``4::``;
null doc_ids come first, rows of one doc_id are ordered by a hash of the text;
a single document is its own next one; an empty table gives no rows. Extra
columns are not part of the result, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cuenca.llm.common import byte_table, rolling_marks, slices, table
from cuenca.session import materialize

NAME = "op13_ctph_fingerprints"
SQL = None               # a rolling hash per byte is no SQL; tested against a step-by-step version
LEAST, CHUNKS = 2, 64    # least block size 2**2; chunks of a fingerprint at most
COMMON = 4               # characters in a row that two alike fingerprints share
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def signature(text: bytes, ends) -> str:
    from zlib import crc32
    at = [0, *ends, len(text)]
    return "".join(ALPHABET[crc32(text[a:b]) & 63] for a, b in zip(at, at[1:]) if b > a)


def fingerprints(texts: list[bytes], numbers) -> list[str]:
    import numpy as np
    bound, mix = np.uint32(1 << (32 - LEAST)), np.uint32(0x9E3779B1)
    out = []
    for text, (at, h) in zip(texts, rolling_marks(texts, numbers, 4, lambda h: h * mix < bound)):
        level = 32 - np.frexp((h * mix).astype(np.float64))[1]  # leading zero bits
        inner = at + 1 < len(text)                              # the text's end ends a chunk anyway
        at, level = at[inner] + 1, level[inner]
        marks = np.cumsum(np.bincount(level, minlength=35)[::-1])[::-1]  # marks of a level or above
        k = LEAST + int(np.argmax(marks[LEAST:] < CHUNKS))
        out.append(f"{1 << k}:{signature(text, at[level >= k].tolist())}:{signature(text, at[level > k].tolist())}")
    return out


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    w = min(COMMON, len(a), len(b))
    if {a[k:k + w] for k in range(len(a) - w + 1)}.isdisjoint(b[k:k + w] for k in range(len(b) - w + 1)):
        return 0.0
    # longest common subsequence, a bit per character of ``a``
    full, where = (1 << len(a)) - 1, {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    row = full
    for c in b:
        u = row & where.get(c, 0)
        row = (row + u | row - u) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1 for two fingerprints."""
    if x == y:
        return 1.0
    (i, a, a2), (j, b, b2) = x.split(":"), y.split(":")
    i, j = int(i), int(j)
    if i == j:
        return max(_alike(a, b), _alike(a2, b2))
    return _alike(a2, b) if 2 * i == j else _alike(a, b2) if i == 2 * j else 0.0


def _compare(docs: list[tuple], numbers):
    """Results of consecutive documents (doc_id, text, fingerprint or None); the
    last one serves as the next of the one before. Returns the columns and the
    last one's fingerprint."""
    from hashlib import sha256
    missing = [k for k, d in enumerate(docs) if d[2] is None]
    prints = [d[2] for d in docs]
    edits = [a[1][:len(a[1]) - len(a[1]) // 2] + b[1][:len(a[1]) // 2] for a, b in zip(docs, docs[1:])]
    edits = [e.encode() for e in edits]
    found = fingerprints([docs[k][1].encode() for k in missing] + edits, numbers)
    for k, f in zip(missing, found):
        prints[k] = f
    rows = [(d[0], len(d[1]), sha256(e).hexdigest(), f, g, likeness(f, g), likeness(f, nxt))
            for d, e, f, g, nxt in zip(docs, edits, prints, found[len(missing):], prints[1:])]
    return rows, prints[-1]


def edited(docs: DataFrame) -> DataFrame:
    """A row per document of ``docs`` (doc_id, text): fingerprints of its text and
    its edited text, likeness to the edited text and to the next document."""
    spark = docs.sparkSession
    by = ["doc_id", "_h"]
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
            .repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text"))
    # first and last row of each range keep their text for the rows beyond
    schema = T._parse_datatype_string(f"{_RESULT}, part int, is_first boolean, is_last boolean, text string")
    arrow, arrow_result = to_arrow_schema(schema), to_arrow_schema(T._parse_datatype_string(_RESULT))

    def ranges(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, numbers, kept, first = TaskContext.get().partitionId(), byte_table("ctph"), None, True

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            for piece in slices(batch):
                docs = [(d, t, None) for d, t in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist())]
                docs = [kept, *docs] if kept else docs
                done, last = _compare(docs, numbers)
                kept = (*docs[-1][:2], last)
                if done:
                    yield batch_of([(*r, part, first and k == 0, False, docs[0][1] if first and k == 0 else None)
                                    for k, r in enumerate(done)])
                    first = False
        if kept:
            yield batch_of([(kept[0], len(kept[1]), None, kept[2], None, None, None, part, first, True, kept[1])])

    rows = materialize(rows.mapInArrow(ranges, schema))
    parts = rows.where("is_first").select("part")               # one row per range
    after = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                            F.min("part").over(Window.partitionBy(F.lit(1)))).alias("next_part"))
    heads = rows.where("is_first").select(F.col("part").alias("next_part"), F.col("doc_id").alias("next_id"),
                                          F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))
    borders = (rows.where("is_last").join(after, "part").join(heads, "next_part")
               .select("doc_id", "text", "fingerprint", "next_id", "next_text", "next_print"))

    def across(batches):
        import pyarrow as pa
        numbers = byte_table("ctph")
        for batch in batches:
            for a in batch.to_pylist():
                done, _ = _compare([(a["doc_id"], a["text"], a["fingerprint"]),
                                    (a["next_id"], a["next_text"], a["next_print"])], numbers)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(done[0], arrow_result)], schema=arrow_result)

    return rows.where(~F.col("is_last")).select(arrow_result.names).unionByName(borders.mapInArrow(across, _RESULT))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited(table(spark, sf_dir, "documents"))
