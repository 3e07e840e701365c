"""Shared helpers of the llm operators."""

from __future__ import annotations

from contextlib import contextmanager
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession, functions as F

#: ASCII white space, the separator of words in every contract.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of a bounded number of rows: texts can be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int):
    """Arrow batches of so many rows and bytes for the jobs that run inside; the
    session's own settings come back afterwards."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def text_or_empty(df: DataFrame, col: str = "text") -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col).cast("string"), F.lit("")))


class WordHash(dict):
    """word (bytes) -> first 8 bytes of its md5, remembered for the task. The
    memory is emptied when it reaches ``limit`` words: a bound on memory, with
    no effect on results."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, w: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        v = self[w] = md5(w).digest()[:8]
        return v

    def of(self, words: list[bytes]):
        """uint64 hashes of a list of words."""
        import numpy as np
        return np.frombuffer(b"".join(map(self.__getitem__, words)), dtype=">u8").astype(np.uint64)


def slices(batch, chars: int = 1_000_000, col: str = "text"):
    """Slices of an Arrow batch whose texts have about ``chars`` bytes at most
    (one row at least): bounds a task's memory without a session setting."""
    import pyarrow as pa
    import pyarrow.compute as pc
    at = 0
    size = pc.fill_null(pc.binary_length(batch.column(col).cast(pa.binary())), 0).to_pylist()
    while at < batch.num_rows:
        end, total = at, 0
        while end < batch.num_rows and (end == at or total + size[end] <= chars):
            total += size[end]
            end += 1
        yield batch.slice(at, end - at)
        at = end


def byte_table(name: str):
    """256 fixed 32-bit numbers, one per byte; that of byte 0 is 0."""
    import numpy as np
    t = np.frombuffer(b"".join(md5(name.encode() + bytes([b])).digest()[:4] for b in range(256)), "<u4").copy()
    t[0] = 0
    return t


def rolling_hash(data, numbers, shift: int):
    """32-bit rolling hash at every byte of ``data`` (uint8): the byte's number
    plus the hash before shifted left by ``shift``, so it depends on the last
    ``32 / shift`` bytes. Takes log2(32 / shift) passes over the whole array."""
    import numpy as np
    h = numbers[data]
    width = 1
    while width * shift < 32:
        h[width:] += h[:-width] << np.uint32(width * shift)
        width *= 2
    return h


def rolling_marks(texts: list[bytes], numbers, shift: int, least, block: int = 1 << 20):
    """Per text the positions whose rolling hash ``least(hashes)`` marks, and
    their hashes. Zero bytes keep texts apart; ``block`` bytes are hashed at a
    time, a longer text in pieces that overlap by the window."""
    import numpy as np
    gap = 32 // shift
    out = [None] * len(texts)

    def marked(data):
        h = rolling_hash(np.frombuffer(data, np.uint8), numbers, shift)
        at = np.flatnonzero(least(h))
        return at, h[at]

    todo, total = [], 0
    for k, t in enumerate(texts):
        if len(t) > block:
            found = []
            for s in range(0, len(t), block):
                head = max(s - gap, 0)
                at, h = marked(t[head:s + block])
                new = at >= s - head
                found.append((at[new] + head, h[new]))
            out[k] = tuple(np.concatenate(x) for x in zip(*found))
            continue
        todo.append(k)
        total += len(t)
        if total > block or len(todo) > 4096:
            _marks_of(texts, todo, marked, gap, out)
            todo, total = [], 0
    _marks_of(texts, todo, marked, gap, out)
    return out


def _marks_of(texts, todo, marked, gap, out):
    import numpy as np
    if not todo:
        return
    at, h = marked((b"\0" * gap).join(texts[k] for k in todo))
    size = np.array([len(texts[k]) + gap for k in todo])
    end = np.cumsum(size)
    lo = np.searchsorted(at, end - size)
    hi = np.searchsorted(at, end - gap)
    for k, a, b, s in zip(todo, lo, hi, end - size):
        out[k] = at[a:b] - s, h[a:b]
