"""Token-ID output: Parquet files with one list of token ids per document.

File format. One row per document in ascending doc_id order over the files (a
file per range of doc_ids): ``doc_id``, ``part`` (the range's number),
``part_start`` (ids of the range's documents before it), ``n_tokens`` and
``ids``, the ids of the whole text followed by ``end_id``. ``ids`` is dictionary
encoded (a vocabulary of 50,000 packs into 16 bits); doc_id and the offsets are
delta encoded. Row groups and pages have set sizes and Spark's writer adds
column and offset indexes, so a reader that wants some documents, or only the
metadata columns, skips the other pages.

``read_tokens`` turns ``part_start`` into the position in the whole corpus by
adding the totals of the parts before: one number per file.

A document is encoded by the tokenizer; as its pre-tokenizer always cuts before
a single space and around a single newline, equal words are encoded once and
looked up afterwards. Texts with any other white space pattern, or with a
special token's string, are encoded as a whole.

Defined results: a null or empty text has the end id alone; null doc_ids come
first; rows of equal doc_id are ordered by a hash of the text; an empty table
gives no rows. Extra columns are not written unless named in ``keep``; names of
the format's own columns cannot be kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from cuenca.llm.common import arrow_batches, slices, table
from cuenca.session import materialize, scratch_path

NAME = "op6_token_files"
SQL = None               # a tokenizer is no SQL; tested by round trips
ROW_GROUP, PAGE = 32 << 20, 256 << 10
CACHE = 96 << 20         # bytes of the pieces a worker remembers: a bound on memory only
SOME_CHARS = 2_000_000   # bytes of text encoded at a time: a bound on memory only
BATCH = 4096, 4 << 20    # rows and bytes of an Arrow batch

_COLS = "part int, part_start long, n_tokens long, ids array<int>"


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


#: white space other than the space and the newline
ODD = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
ODD_WIDE = ODD + "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
STOPS = ".,;:!?"


class _Pieces(dict):
    """piece -> ids. A piece is a word after a space, or a newline with the word
    that follows it.

    Words of letters, with stops after them or not, are one or two pieces of
    the pre-tokenizer and go to the tokenizer's model directly; anything else
    goes through the whole tokenizer. Results are remembered until they take
    ``CACHE`` bytes; later ones are encoded once a batch."""

    def __init__(self, encoder):
        super().__init__()
        self.encoder, self.stops, self.size = encoder, encoder.known_stops, 0

    def __missing__(self, p: str) -> bytes:
        core = p.rstrip(STOPS)
        line = p[0] == "\n"
        w = core[1:] if line else core
        if not w.isalpha():
            v = self.encoder.newline + self.encoder.whole(p[1:]) if line else self.encoder.whole(" " + p)
        elif len(core) != len(p):
            s = p[len(core):]
            return self[core] + (self.stops.get(s) or self.encoder.stops(s))   # put together anew: the word alone is remembered
        elif line:
            v = self.encoder.newline + self.encoder.letters("", w)
        else:
            v = self.encoder.letters(" ", w)
        if self.size < CACHE:
            self[p] = v
            self.size += (len(p) if p.isascii() else 4 * len(p)) + len(v) + 130   # with the two objects and their entry
        return v


class Encoder:
    """Texts -> token ids."""

    def __init__(self, spec: bytes):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_buffer(spec)
        self.tokenize = self.tok.model.tokenize
        self.newline = self.whole("\n")
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # the byte-level alphabet: printable bytes stand for themselves, the rest for 256 and on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.letter = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.known_stops: dict[str, bytes] = {}
        self.pieces = _Pieces(self)

    def whole(self, text: str) -> bytes:
        """Ids of a text, by the whole tokenizer, as little-endian 32-bit bytes."""
        import numpy as np
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def letters(self, prefix: str, word: str) -> bytes:
        from struct import pack
        if not word.isascii():
            word = "".join(map(self.letter.__getitem__, word.encode()))
        found = self.tokenize(self.letter[32] + word if prefix else word)
        if len(found) == 1:
            return found[0].id.to_bytes(4, "little")
        return pack(f"<{len(found)}I", *[t.id for t in found])

    def stops(self, s: str) -> bytes:
        v = self.known_stops.get(s)
        if v is None:
            v = self.whole(s)
            if len(s) < 9:
                self.known_stops[s] = v
        return v

    def plain(self, text: str) -> bool:
        """Whether only single spaces and newlines stand between words, and no
        special token's string is inside."""
        return not (text == "" or text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text
                    or " \n" in text or "\n " in text
                    or any(c in text for c in (ODD if text.isascii() else ODD_WIDE))
                    or any(s in text for s in self.special))

    def batch(self, texts: list[str], end_id: int):
        """(ids of all texts in a row, each text's followed by ``end_id``; number
        of ids of each text, with the end id)."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        plain = [self.plain(t) for t in texts]
        # a newline joins the word after it; one before each text makes its first word alike
        cut = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") if p else "\n" for t, p in zip(texts, plain)], pa.large_string()), " ")
        words = cut.flatten()
        at = np.diff(cut.offsets.to_numpy())
        first = np.cumsum(at) - at
        start = np.zeros(len(words), bool)
        start[first] = True
        coded = words.dictionary_encode()
        known = [self.pieces[p] if p != "\n" else b"" for p in coded.dictionary.to_numpy(zero_copy_only=False)]
        flat = np.frombuffer(b"".join(known) + bytes(4), "<u4")
        size = np.array([len(b) // 4 for b in known], np.int64)
        begin = np.cumsum(size) - size
        code = coded.indices.to_numpy()
        # the newline before a text is not its own
        skip = start & (size[code] > 0)
        n = size[code] - skip
        begin = begin[code] + skip
        n[first + at - 1] += 1              # a place for the end id after each text's last word
        where = np.repeat(begin - (np.cumsum(n) - n), n)
        where += np.arange(len(where))
        ids = flat[where]
        per = np.add.reduceat(n, first)
        ids[np.cumsum(per) - 1] = end_id
        if all(plain):
            return ids, per
        parts, done, end = [], np.cumsum(per) - per, np.array([end_id], "<u4").tobytes()
        for k, (t, p) in enumerate(zip(texts, plain)):
            parts.append(ids[done[k]:done[k] + per[k]] if p else np.frombuffer((self.whole(t) if t else b"") + end, "<u4"))
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def __call__(self, text: str) -> bytes:
        """Ids of one text, without an end id."""
        return self.batch([text], 0)[0][:-1].tobytes()


def _encoder(spec: bytes) -> Encoder:
    """The Python worker's encoder: its remembered words serve all tasks the worker runs."""
    import sys
    from types import SimpleNamespace
    kept = sys.modules.setdefault("_cuenca_encoder", SimpleNamespace(spec=None, encoder=None))
    if kept.spec != spec:
        kept.spec, kept.encoder = spec, Encoder(spec)
    return kept.encoder


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0,
                 row_group: int = ROW_GROUP, page: int = PAGE, keep: tuple = (),
                 partitions: int | None = None) -> None:
    """Write the token files of ``docs`` (doc_id, text) to ``path``."""
    spark = docs.sparkSession
    with open(tokenizer or tokenizer_file(), "rb") as f:
        spec = spark.sparkContext.broadcast(f.read())  # the vocabulary file
    by = ["doc_id", "_h"]
    rows = docs.select("doc_id", *keep, F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    rows = (rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
            ).sortWithinPartitions(*by).drop("_h")
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text"] + T._parse_datatype_string(_COLS).fields)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part, enc, start = TaskContext.get().partitionId(), _encoder(spec.value), 0
        for batch in (s for b in batches for s in slices(b, SOME_CHARS)):
            ids, n = enc.batch(batch.column("text").to_pylist(), end_id)
            before = start + np.cumsum(n) - n
            start += int(n.sum())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids.view("<i4")))
            cols = [batch.column(c) for c in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array(np.full(len(n), part, np.int32)), pa.array(before), pa.array(n), lists],
                names=[f.name for f in schema.fields])

    writer = rows.mapInArrow(run, schema).write.mode("overwrite").option("compression", "zstd")
    for k, v in {"parquet.block.size": row_group, "parquet.page.size": page, "parquet.writer.version": "PARQUET_2_0",
                 "parquet.dictionary.page.size": 4 << 20, "parquet.enable.dictionary": "false",
                 "parquet.enable.dictionary#ids.list.element": "true"}.items():
        writer = writer.option(k, str(v))
    with arrow_batches(spark, *BATCH):
        writer.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files with ``start``, the position in the whole corpus."""
    rows = spark.read.parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))  # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (rows.join(F.broadcast(parts), "part")
            .withColumn("start", F.col("_off") + F.col("part_start")).drop("_off"))


def digest(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows read back."""
    def run(batches):
        import zlib
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            ids = batch.column("ids")
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<u4")
            at = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (tokens.select("doc_id", "start", "ids")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def encode(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write token files and return their digest, read back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    write_tokens(docs, path, **options)
    with arrow_batches(spark, *BATCH):
        return materialize(digest(read_tokens(spark, path)))   # four numbers a document


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
