r"""Fill-in-middle transformation: prefix, suffix, middle in training order.

A text of ``n`` units (lines, the newline included) is cut after two numbers of
units drawn from the hash of its ``doc_id``; the three parts are written with
sentinels, suffix first (``spm``) or prefix first (``psm``). Empty texts, texts
that hold a sentinel and those that the rate leaves out stay ``plain``.

Method: content-defined chunk memoization. A rolling hash over the last 32
bytes cuts texts into chunks of about 512 bytes, alike wherever a passage
stands. A chunk's summary (newlines, code points, sentinel inside, its first
and last two bytes) is computed once and remembered under the chunk's whole
content, so a hash never decides; the summaries' boundary bytes tell whether
a sentinel spans two chunks. Sums of the summaries' counts find the chunk a
cut falls into, and only that chunk is searched.

The memory is bounded in bytes: when the young half is full, it becomes the old
one, whose unused chunks are forgotten. It changes nothing but the work.

Defined results: a null text is an empty one, plain with 0 units; a null doc_id
draws from ``seed:`` alone; repeated rows are transformed alike; an empty
table gives no rows. Extra columns pass through; columns of the operator's own
names are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cuenca.llm.common import byte_table, rolling_marks, slices, table

NAME = "op12_fill_in_middle"
SEED, RATE, SPM = 7, 100, 50
SENTINELS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
CHUNK_BITS = 9                     # chunks of 512 bytes on average
LONG = 8192                        # chunks above are not remembered
CACHE = 8 << 20                    # bytes of either half of the memory

_OWN = "n long, form string, prefix_chars long, middle_chars long, output string"
_CONT = bytes(range(0x80, 0xC0))   # continuation bytes of UTF-8


def code_points(b: bytes) -> int:
    return len(b) if b.isascii() else len(b.translate(None, _CONT))


class ChunkCache:
    """chunk content -> (newlines, code points, sentinel inside, first 2 bytes,
    last 2 bytes)."""

    def __init__(self, sentinels: tuple[bytes, ...], limit: int = CACHE):
        self.sentinels, self.limit = sentinels, limit
        self.young, self.old, self.bytes = {}, {}, 0
        self.edge = max(map(len, sentinels)) - 1
        self.hits = self.misses = 0

    def summary(self, chunk: bytes):
        s = self.young.get(chunk)
        if s:
            self.hits += 1
            return s
        s = self.old.get(chunk)
        if s:
            self.hits += 1
        else:
            self.misses += 1
            s = (chunk.count(b"\n"), code_points(chunk), any(x in chunk for x in self.sentinels),
                 chunk[:self.edge], chunk[-self.edge:])
        if len(chunk) <= LONG:
            self.young[chunk] = s
            self.bytes += len(chunk) + 300
            if self.bytes > self.limit:
                self.old, self.young, self.bytes = self.young, {}, 0
        return s


class ChunkedText:
    """A text as chunks with running sums of their counts."""

    def __init__(self, text: bytes, marks, cache: ChunkCache):
        self.text = text
        self.at = [0, *(int(m) + 1 for m in marks)]
        if self.at[-1] != len(text):
            self.at.append(len(text))
        self.lines, self.chars, self.sentinel = [0], [0], False
        before = b""
        for a, b in zip(self.at, self.at[1:]):
            lines, chars, inside, first, last = cache.summary(text[a:b])
            self.lines.append(self.lines[-1] + lines)
            self.chars.append(self.chars[-1] + chars)
            self.sentinel |= inside or any(s in before + first for s in cache.sentinels)
            before = (before + last)[-cache.edge:]
        self.n = self.lines[-1] + (text != b"" and text[-1] != 10)

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code point) after so many units."""
        if units == 0:
            return 0, 0
        if units > self.lines[-1]:              # the last line has no newline
            return len(self.text), self.chars[-1]
        k = bisect_left(self.lines, units) - 1  # the chunk that holds the newline
        chunk = self.text[self.at[k]:self.at[k + 1]]
        rest, p = units - self.lines[k], -1
        if rest > 64:
            p = [m.start() for m in re.finditer(b"\n", chunk)][rest - 1]
        else:
            for _ in range(rest):
                p = chunk.index(b"\n", p + 1)
        return self.at[k] + p + 1, self.chars[k] + code_points(chunk[:p + 1])


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM,
              sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``docs`` (doc_id, text) with ``n``, ``form``, ``prefix_chars``,
    ``middle_chars`` and ``output``; ``rate`` percent are cut, ``spm`` percent
    of those suffix first."""
    own = T._parse_datatype_string(_OWN).fields
    through = [f for f in docs.schema.fields if f.name not in {o.name for o in own}]
    schema = T.StructType(through + own)
    marks_of = tuple(s.encode() for s in sentinels)

    def run(batches):
        import pyarrow as pa
        from hashlib import sha256
        import numpy as np
        cache, numbers = ChunkCache(marks_of), byte_table("chunk")
        bound = np.uint32(1 << (32 - CHUNK_BITS))
        p, s, m = marks_of
        for batch in batches:
            for part in slices(batch):
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                marks = rolling_marks(texts, numbers, 1, lambda h: h < bound)
                rows = []
                for doc_id, text, (at, _) in zip(part.column("doc_id").to_pylist(), texts, marks):
                    t = ChunkedText(text, at, cache)
                    hexes = sha256(b"%d:%s" % (seed, b"" if doc_id is None else str(doc_id).encode())).hexdigest()
                    h1, h2, h3, h4 = (int(hexes[k:k + 8], 16) for k in (0, 8, 16, 24))
                    if not text or t.sentinel or h3 % 100 >= rate:
                        rows.append((t.n, "plain", None, None, text))
                        continue
                    a, b = sorted((h1 % (t.n + 1), h2 % (t.n + 1)))
                    (a, a_chars), (b, b_chars) = t.cut(a), t.cut(b)
                    prefix, middle, suffix = text[:a], text[a:b], text[b:]
                    first = h4 % 100 < spm
                    out = (s, suffix, p, prefix, m, middle) if first else (p, prefix, s, suffix, m, middle)
                    rows.append((t.n, "spm" if first else "psm", a_chars, b_chars - a_chars, b"".join(out)))
                n, form, pre, mid, out = zip(*rows)
                cols = [part.column(f.name) for f in through] + [
                    pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(pre, pa.int64()),
                    pa.array(mid, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def restore(form: Column, output: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text, rebuilt from an output and its form alone."""
    parts = F.split(output, "|".join("\\Q" + s + "\\E" for s in sentinels))  # [nothing, part, part, middle]
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restore(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || x[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || x[9:16])::BIGINT % (len(u) + 1) AS b,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM t),
f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
                 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(u[greatest(a, b) + 1:], '') AS s FROM h)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m
                        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM f
"""
