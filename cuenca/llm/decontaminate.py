"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become tokens (runs of letters and digits, in
lower case). Seeds are the windows of ``MIN_MATCH`` tokens; a document and an
item that share a seed are a candidate pair. Each pair is tiled: matches of a
maximal length are found by Karp-Rabin hashes of growing windows, the longest
non-overlapping ones are marked first, and the search repeats on the unmarked
tokens until no match of ``MIN_MATCH`` tokens is left. Tiles may lie in any
order, so a passage whose sentences were moved is still covered. A pair is a
leak if its tiles cover ``COVERAGE`` of the item's tokens.

The benchmark is the bounded side: its tokens are sent to the tasks in blocks
of at most ``BLOCK_CHARS`` characters, and the documents are read once for each
block, so no size of benchmark is too large. A document is handled alone and in
one pass, without a shuffle; a hot source or group of copies costs its rows.

Items shorter than ``MIN_MATCH`` tokens are matched as one seed of their own
length, so a leak of them is found too.

Defined results: null or empty texts have no tokens and never match; null ids
pass through; equal documents or items give a row each; an empty benchmark or
document table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.llm.common import slices, table

NAME = "op1_string_tiling"
SQL = None               # greedy and iterative; tested against a plain tiling
MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_CHARS = 8 << 20

_SCHEMA = "doc_id long, item_id long, item_tokens long, tiled_tokens long, n_tiles long, coverage double"
_LETTERS = rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def tokens(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, lower case."""
    import re
    return re.findall(_LETTERS, text.lower())


class _Hash(dict):
    """token -> 64-bit hash; ``limit`` bounds memory and changes no result."""

    def __missing__(self, w):
        from hashlib import blake2b
        if len(self) >= 400_000:
            self.clear()
        v = self[w] = blake2b(w, digest_size=8).digest()
        return v

    def of(self, words):
        import numpy as np
        return np.frombuffer(b"".join(map(self.__getitem__, words)), "<u8")


def windows(h, k: int):
    """Karp-Rabin hashes of all windows of ``k`` tokens, by doubling."""
    import numpy as np
    if len(h) < k:
        return h[:0]
    out, size, power = h, 1, 0x9E3779B97F4A7C15      # power: the base to the power of size
    done, width = None, 0
    while True:
        if k & size:
            if done is None:
                done, width = out, size
            else:                       # the windows done so far, then ``size`` more
                n = len(h) - width - size + 1
                done = done[:n] * np.uint64(power) + out[width:width + n]
                width += size
        size *= 2
        if size > k:
            return done
        out = out[:len(out) - size // 2] * np.uint64(power) + out[size // 2:]
        power = power * power % (1 << 64)


def tile(doc, item, min_match: int = MIN_MATCH):
    """Tiles [(item position, document position, length)] of two arrays of
    token hashes: longest first, then by item and document position."""
    import numpy as np
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    min_match = max(1, min(min_match, len(item)))
    tiles = []
    longest = min(len(doc), len(item))
    while longest >= min_match:
        # the greatest window length with a match among free tokens
        lo, hi, found = min_match, longest, None
        while lo <= hi:
            k = (lo + hi) // 2
            got = _common(doc, item, free_d, free_i, k)
            if got is not None:
                lo, found, at = k + 1, got, k
            else:
                hi = k - 1
        if found is None:
            break
        for i, d in _matches(doc, item, free_d, free_i, at, found):
            free_i[i:i + at] = free_d[d:d + at] = False
            tiles.append((i, d, at))
        longest = at
    return tiles


def _common(doc, item, free_d, free_i, k):
    """The free windows of ``k`` tokens, None if no document window equals one of
    the item: (item positions, first and last place of the equal windows among
    the document's, document positions in that order)."""
    import numpy as np

    def free(mask):
        run = np.concatenate([[0], np.cumsum(mask)])
        return np.flatnonzero(run[k:] - run[:-k] == k)

    pi, pd = free(free_i), free(free_d)
    wi, wd = windows(item, k)[pi], windows(doc, k)[pd]
    order = np.argsort(wd, kind="stable")
    wd = wd[order]
    left, right = np.searchsorted(wd, wi, "left"), np.searchsorted(wd, wi, "right")
    there = left < right
    return (pi[there], left[there], right[there], pd[order]) if there.any() else None


def _matches(doc, item, free_d, free_i, k, found):
    """Matches to be marked: for each item window that is still free, in order, the
    first equal document window that is still free. A window that is taken
    stays so, and the places of equal windows are passed once: the work grows
    with the windows, not with the pairs of equal ones."""
    import numpy as np
    passed: dict[int, int] = {}
    pi, left, right, places = found
    for i, a, b in zip(pi.tolist(), left.tolist(), right.tolist()):
        if not free_i[i:i + k].all():
            continue
        x = passed.get(a, a)
        while x < b and not free_d[places[x]:places[x] + k].all():
            x += 1
        passed[a] = x
        # equal hashes of windows are checked token by token
        while x < b:
            d = int(places[x])
            if free_d[d:d + k].all() and np.array_equal(doc[d:d + k], item[i:i + k]):
                yield i, d
                break
            x += 1


def blocks(benchmark: DataFrame, chars: int):
    """The benchmark in lists of (item_id, text) of at most ``chars`` characters
    (one item at least), one list in the driver at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        if block and size + len(r["text"]) > chars:
            yield block
            block, size = [], 0
        block.append((r["item_id"], r["text"].encode()))
        size += len(r["text"])
    if block:
        yield block


class _Finder:
    """The leaks of one block of items in a text."""

    def __init__(self, block, min_match, coverage):
        import numpy as np
        self.min_match, self.coverage, self.hashes = min_match, coverage, _Hash()
        self.ids = [i for i, _ in block]
        self.texts = [t for _, t in block]
        self.items = [self.hashes.of(tokens(t)) for t in self.texts]
        self.seeds = {}                  # by window length, as short items have shorter seeds
        for k in sorted({min(min_match, len(h)) for h in self.items} - {0}):
            w = [(windows(h, k), n) for n, h in enumerate(self.items) if min(min_match, len(h)) == k]
            key = np.concatenate([a for a, _ in w])
            of = np.concatenate([np.full(len(a), n) for a, n in w])
            order = np.argsort(key, kind="stable")
            marks = np.zeros(1 << 24, bool)
            marks[(key >> np.uint64(40)).astype(np.int64)] = True
            self.seeds[k] = key[order], of[order], marks

    def candidates(self, doc) -> set[int]:
        """The items that share a seed with a document."""
        import numpy as np
        near: set[int] = set()
        for k, (key, of, marks) in self.seeds.items():
            if len(doc) < k:
                continue
            w = windows(doc, k)
            w = w[marks[(w >> np.uint64(40)).astype(np.int64)]]
            if len(w):
                a, b = np.searchsorted(key, w, "left"), np.searchsorted(key, w, "right")
                for x, y in set(zip(a[a < b].tolist(), b[a < b].tolist())):
                    near.update(of[x:y].tolist())
        return near

    def __call__(self, text: bytes | None) -> list[tuple]:
        """(item_id, item tokens, tiled tokens, tiles, coverage) of each leak."""
        words = tokens(text) if text else []
        doc = self.hashes.of(words) if words else ()
        rows = []
        for n in sorted(self.candidates(doc)):
            item = self.items[n]
            tiles = tile(doc, item, self.min_match)
            covered = sum(t[2] for t in tiles)
            if covered >= self.coverage * len(item):    # token hashes do not decide: the tokens do
                own = tokens(self.texts[n])
                tiles = [t for t in tiles if own[t[0]:t[0] + t[2]] == words[t[1]:t[1] + t[2]]]
                covered = sum(t[2] for t in tiles)
            if covered >= self.coverage * len(item):
                rows.append((self.ids[n], len(item), covered, len(tiles), covered / len(item)))
        return rows


def leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
          coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each (document, item) pair whose tiles cover ``coverage`` of the item."""
    spark = docs.sparkSession
    out = None
    for b in blocks(benchmark, block_chars):
        more = _leaks(docs, spark.sparkContext.broadcast(b), min_match, coverage)
        out = more if out is None else out.unionByName(more)
    return spark.createDataFrame([], _SCHEMA) if out is None else out


def _leaks(docs, block, min_match, coverage):
    def run(batches):
        import pyarrow as pa
        find = _Finder(block.value, min_match, coverage)
        for batch in (s for b in batches for s in slices(b)):
            rows = [(doc_id, *r) for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                                         batch.column("text").cast(pa.binary()).to_pylist())
                    for r in find(text)]
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in cols[:5]] + [pa.array(list(cols[5]), pa.float64())],
                names=["doc_id", "item_id", "item_tokens", "tiled_tokens", "n_tiles", "coverage"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SCHEMA)


def clean(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
          coverage: float = COVERAGE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without those that leak an item; all columns stay."""
    spark = docs.sparkSession
    for b in blocks(benchmark, block_chars):
        docs = _clean(docs, spark.sparkContext.broadcast(b), min_match, coverage)
    return docs


def _clean(docs, block, min_match, coverage):
    def run(batches):
        import pyarrow as pa
        find = _Finder(block.value, min_match, coverage)
        for batch in (s for b in batches for s in slices(b)):
            yield batch.filter(pa.array([not find(t) for t in batch.column("text").cast(pa.binary()).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
