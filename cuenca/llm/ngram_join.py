"""N-gram Jaccard self-join with Bayesian candidate pruning.

Documents are sets of hashed shingles of ``SHINGLE`` words (a shorter text is
one shingle); a link joins two documents whose sets have a Jaccard similarity
of ``THRESHOLD`` or more.

1. Documents with equal sets form a class of copies, grouped by a 128-bit digest
   of the set; from here on one row stands for a class.
2. Each class has ``HASHES`` MinHash values. Every ``BAND`` of them are a bucket
   key; a pair at the threshold misses all buckets with a chance of 5e-8.
3. Inside a bucket, pairs are compared ``STEP`` MinHash values at a time. With a
   uniform prior the similarity's posterior after m of n equal values is
   Beta(m + 1, n - m + 1); a pair is dropped as soon as the posterior
   probability of reaching the threshold is below ``TOLERANCE``. What is left
   connects classes into candidate clusters.
4. Inside a cluster, the same pruning and then an exact comparison of the sets
   decide each pair. The result has every class's number of links and the
   connected groups of linked classes.

Buckets and clusters are worked on in blocks of ``BLOCK`` classes and pairs of
them, each a task-sized unit, so neither is ever gathered whole and none is
capped; a unit reports link counts and a spanning forest, never its pairs. Two
blocks of a bucket meet only where step 3 has not yet connected their members.
In a cluster all blocks meet, as links are counted. Only
members of candidate clusters are read again for their sets; a bitmap of fixed
size keeps most other texts out of that shuffle.

Defined results: rows with a null doc_id, and texts without words, are classes
of their own without links; repeated rows are copies; an empty table gives no
rows; extra columns are ignored by ``groups`` and pass through ``representatives``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.llm.common import WordHash, small_batches, table
from cuenca.session import materialize

NAME = "op2_bayes_ngram_join"
SQL = None               # MinHash in numpy; tested against all pairs
SHINGLE, THRESHOLD = 5, 0.8
HASHES, BAND, STEP, TOLERANCE = 128, 4, 16, 1e-6
BLOCK = 128


def shingles(words: list[bytes], hashes: WordHash, size: int = SHINGLE):
    """The sorted set of a document's hashed shingles (uint64)."""
    import numpy as np
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    k = min(size, len(h))
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    out = h[:len(h) - k + 1].copy()
    for i in range(1, k):
        out = out * a + h[i:len(h) - k + 1 + i]
    out = (out ^ (out >> np.uint64(29))) * b
    return np.unique(out ^ (out >> np.uint64(32)))


def _family():
    """The constants of the MinHash functions."""
    import numpy as np
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1),
            rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32))


def min_hashes(s, family) -> bytes:
    """``HASHES`` MinHash values of a set, 16 bits each."""
    import numpy as np
    a, b = family
    x = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 2048):
        v = x[k:k + 2048, None] * a
        v += b
        np.minimum(best, v.min(axis=0), out=best)
    return ((best ^ (best >> np.uint32(16))) & np.uint32(0xFFFF)).astype("<u2").tobytes()


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For n values compared: the least number of equal ones with which
    P(similarity >= threshold) is not below the tolerance. Under a uniform prior
    that probability is P(Binomial(n + 1, threshold) <= m)."""
    from math import comb
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, set_key, n_shingles, sig) of every document with words and an id."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from hashlib import blake2b
        hashes, family = WordHash(), _family()
        for batch in batches:
            ids, keys, sizes, sigs = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").cast(pa.binary()).to_pylist()):
                s = shingles(text.split(), hashes)
                if len(s):
                    ids.append(doc_id)
                    keys.append(blake2b(s.tobytes(), digest_size=16).digest())
                    sizes.append(len(s))
                    sigs.append(min_hashes(s, family))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())],
                names=["doc_id", "set_key", "n_shingles", "sig"])

    return (docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null")
            .mapInArrow(run, "doc_id long, set_key binary, n_shingles long, sig binary"))


def _buckets(classes: DataFrame) -> DataFrame:
    """(band, bucket, member) for every band of every class."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        n = HASHES // BAND
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<i8").reshape(-1, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(n, dtype=np.int32), len(sig))), pa.array(sig.ravel()),
                 batch.column("member").take(pa.array(np.repeat(np.arange(len(sig)), n)))],
                names=["band", "bucket", "member"])

    return classes.select("member", "sig").mapInArrow(run, "band int, bucket long, member binary")


def _blocks(rows: DataFrame, keys: list[str], order: list, block: int) -> DataFrame:
    """The rows of each key numbered in ``order`` by blocks (``b``). Keys with one
    row are left out. Rows are numbered while a sorted partition streams by, so a
    key of any size needs no memory."""
    def stream(batches):
        import pyarrow as pa
        last, count, first, here = None, 0, None, None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            at, b, before = [], [], None
            for n, key in enumerate(zip(*[batch.column(k).to_pylist() for k in keys])):
                if key != last:
                    last, count, first = key, 1, t.slice(n, 1)
                    here = n
                    continue
                if count == 1:
                    if first is not None and here is None:
                        before = first       # it came with an earlier batch
                    else:
                        at.append(here)
                        b.append(0)
                at.append(n)
                b.append(count // block)
                count += 1
            here = None
            out = t.take(pa.array(at, pa.int64()))
            if before is not None:
                out = pa.concat_tables([before, out])
                b.insert(0, 0)
            out = out.append_column("b", pa.array(b, pa.int32()))
            yield from out.combine_chunks().to_batches()

    from pyspark.sql import types as T
    out_schema = T.StructType(rows.schema.fields + [T.StructField("b", T.IntegerType())])
    return materialize(rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, out_schema))


def block_pairs(rows: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """The members of each key numbered in blocks, and each member in a row for
    every pair of blocks (``i`` <= ``j``) that its block ``b`` is part of."""
    numbered = _blocks(rows.select(*keys, "member"), keys, ["member"], block)
    many = numbered.where("b > 0").groupBy(*keys).agg((F.max("b") + 1).alias("_m"))
    m = F.coalesce("_m", F.lit(1))
    other = F.explode(F.sequence(F.lit(0), m - 1))
    return (numbered.join(many, keys, "left").select(*keys, "member", "b", other.alias("_o"))
            .select(*keys, "member", "b", F.least("b", "_o").cast("int").alias("i"), F.greatest("b", "_o").cast("int").alias("j")))


def _open_pairs(rows: DataFrame, keys: list[str], block: int) -> DataFrame:
    """(keys, member, root, b, i, j): ``block_pairs`` without the pairs of blocks
    whose members all have one ``root``. Members are numbered by root, so all
    blocks but the first and last of a large root are of that root alone and meet
    only the blocks of others."""
    numbered = _blocks(rows.select(*keys, "root", "member"), keys, ["root", "member"], block)
    spans = numbered.groupBy(*keys, "b").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"))
    size = spans.groupBy(*keys).agg(F.max("b").alias("_last"))
    alone = (spans.where("_lo = _hi").groupBy(*keys, F.col("_lo").alias("_alone"))
             .agg(F.min("b").alias("_from"), F.max("b").alias("_to")))
    spans = spans.withColumn("_alone", F.expr("if(_lo = _hi, _lo, null)")).join(size, keys).join(alone, [*keys, "_alone"], "left")
    none = "cast(array() as array<int>)"
    others = F.expr(f"""if(_from is null, sequence(0, _last), concat(
        if(_from > 0, sequence(0, _from - 1), {none}), if(_to < _last, sequence(_to + 1, _last), {none})))""")
    meets = spans.select(*keys, "b", F.explode(others).alias("_o"))
    return numbered.join(meets, [*keys, "b"]).select(
        *keys, "member", "root", "b", F.least("b", "_o").cast("int").alias("i"), F.greatest("b", "_o").cast("int").alias("j"))


def _units(batches, keys):
    """The rows of each (key, i, j) unit of a sorted stream, as an Arrow table."""
    import pyarrow as pa
    held, last = [], None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        unit = list(zip(*[batch.column(k).to_pylist() for k in [*keys, "i", "j"]]))
        start = 0
        for n in range(len(unit)):
            if unit[n] != last:
                if last is not None:
                    held.append(t.slice(start, n - start))
                    yield pa.concat_tables(held)
                    held = []
                start, last = n, unit[n]
        held.append(t.slice(start))
    if held:
        yield pa.concat_tables(held)


def _pairs(b, i, j):
    """Row numbers of the pairs of a unit: inside one block, or across two."""
    import numpy as np
    if i == j:
        return np.triu_indices(len(b), 1)
    x, y = np.flatnonzero(b == i), np.flatnonzero(b == j)
    return np.repeat(x, len(y)), np.tile(y, len(x))


def prune(sig, x, y, least: dict[int, int]):
    """The pairs (x, y) that no step of the Bayesian comparison drops."""
    import numpy as np
    equal = np.zeros(len(x), np.int16)
    for n in range(0, HASHES, STEP):
        equal += (sig[x, n:n + STEP] == sig[y, n:n + STEP]).sum(axis=1, dtype=np.int16)
        stay = equal >= least[n + STEP]
        if not stay.all():
            x, y, equal = x[stay], y[stay], equal[stay]
    return x, y


def _forest(n, x, y):
    """(member, root) of each of ``n`` rows joined by the pairs to another root."""
    import numpy as np
    lab = np.arange(n)
    while len(x):
        low = np.minimum(lab[x], lab[y])
        new = lab.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = np.minimum(new, new[new])
        if (new == lab).all():
            break
        lab = new
    at = np.flatnonzero(lab != np.arange(n))
    return at, lab[at]


def candidates(classes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """Edges (u, v) that connect classes into candidate clusters: spanning
    forests of the pairs in a common bucket that survive the pruning.

    First every block of a bucket is compared within itself; blocks are drawn
    anew in each band, so large groups of near texts grow together. Pairs across
    the blocks of a bucket are then compared only where the first round has not
    connected them: those between members of one group add no connection."""
    keys = ["band", "bucket"]
    first = _blocks(_buckets(classes), keys, [F.xxhash64("band", "member"), "member"], block)
    found = materialize(_surviving(first.withColumns({"i": F.col("b"), "j": F.col("b")}), classes, keys, threshold, block))
    large = first.where("b > 0").select(*keys).distinct()
    if large.isEmpty():
        return found
    members = (first.join(large, keys, "left_semi").select(*keys, "member").join(components(found), "member", "left")
               .withColumn("root", F.coalesce("root", "member")))
    parted = members.groupBy(*keys).agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi")
    pairs = _open_pairs(members.join(parted, keys, "left_semi"), keys, block)
    return found.unionByName(_surviving(pairs, classes, keys, threshold, block)).distinct()


def _surviving(units: DataFrame, classes: DataFrame, keys: list[str], threshold: float, block: int) -> DataFrame:
    """A spanning forest (u, v) of each unit's pairs that survive the pruning; of
    units with a ``root``, pairs of different roots alone."""
    least = least_matches(threshold)
    again = "root" in units.columns

    def run(batches):
        import numpy as np
        import pyarrow as pa
        us, vs = [], []
        for t in _units(batches, keys):
            band, i, j = (t.column(c)[0].as_py() for c in ("band", "i", "j"))
            x, y = _pairs(t.column("b").to_numpy(), i, j)
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(-1, HASHES)
            whole = sig.view("<u8")
            if again:
                root = pa.array(t.column("root").to_pylist(), pa.binary()).dictionary_encode().indices.to_numpy()
                apart = root[x] != root[y]
                x, y = x[apart], y[apart]
            if again or (i == 0 and len(sig) < block):
                for k in range(band):        # a pair is compared in its first common bucket
                    apart = whole[x, k] != whole[y, k]
                    x, y = x[apart], y[apart]
            x, y = prune(sig, x, y, least)
            if len(x):
                member = t.column("member").to_pylist()
                for a, r in zip(*_forest(len(sig), x, y)):
                    us.append(member[a])
                    vs.append(member[r])
            if len(us) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])
                us, vs = [], []
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])

    cols = [*keys, "i", "j", "b", "member", "sig", *(["root"] if again else [])]
    return (units.join(classes.select("member", "sig"), "member")
            .repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j", "member")
            .select(*cols).mapInArrow(run, "u binary, v binary").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(member, root): connected components by alternating large and small
    stars. Every round is a table in the shared folder; the number of edges
    never grows."""
    def mark(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = mark(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small)
        now = mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("member"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("member"), F.col("v").alias("root")).distinct())


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose doc_id is in ``ids`` (and a few more): a bitmap of 4 million
    bits in 65,536 rows, whatever the input, is broadcast."""
    h = F.xxhash64("doc_id")
    word, bit = F.shiftright(h, 6).bitwiseAND(F.lit(65535)), h.bitwiseAND(F.lit(63)).cast("int")
    bits = (ids.select(word.alias("_w"), F.expr("shiftleft(1L, cast(xxhash64(doc_id) & 63 as int))").alias("_b"))
            .groupBy("_w").agg(F.bit_or("_b").alias("_b")))
    return (docs.withColumn("_w", word).join(F.broadcast(bits), "_w")
            .where(F.bit_get("_b", bit) == 1).drop("_w", "_b"))


def verified(docs: DataFrame, classes: DataFrame, clusters: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows (u, v, links): spanning edges of the true links (links null), and
    counts of documents linked to class ``u`` (v null)."""
    least = least_matches(threshold)
    units = materialize(block_pairs(clusters, ["root"]))
    members = clusters.select("member").join(classes, "member").select("member", "doc_id", "copies", "sig")
    wanted = _only(docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null"), members)

    def sets(batches):
        import pyarrow as pa
        hashes = WordHash()
        for batch in batches:
            s = [shingles(t.split(), hashes).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("member"), batch.column("copies"), batch.column("sig"), pa.array(s, pa.binary())],
                                             names=["member", "copies", "sig", "set"])

    with_sets = (wanted.join(members, "doc_id").select("member", "copies", "sig", "text").dropDuplicates(["member"])
                 .mapInArrow(sets, "member binary, copies long, sig binary, set binary"))
    rows = (units.join(with_sets, "member")
            .repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "member"))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for t in _units(batches, ["root"]):
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            x, y = _pairs(t.column("b").to_numpy(), i, j)
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), "<u2").reshape(-1, HASHES)
            x, y = prune(sig, x, y, least)
            sets = [np.frombuffer(s, "<u8") for s in t.column("set").to_pylist()]
            size = np.array([len(s) for s in sets], np.int64)
            both = _common(sets, x, y)
            link = both >= threshold * (size[x] + size[y] - both) - 1e-9
            x, y = x[link], y[link]
            copies = t.column("copies").to_numpy()
            n = (np.bincount(x, weights=copies[y], minlength=len(sets))
                 + np.bincount(y, weights=copies[x], minlength=len(sets))).astype(np.int64)
            member = t.column("member").to_pylist()
            at, root = _forest(len(sets), x, y)
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([member[k] for k in [*at, *own]], pa.binary()),
                 pa.array([member[k] for k in root] + [None] * len(own), pa.binary()),
                 pa.array([None] * len(at) + n[own].tolist(), pa.int64())], names=["u", "v", "links"])

    return rows.select("root", "i", "j", "b", "member", "copies", "sig", "set").mapInArrow(run, "u binary, v binary, links long")


def _common(sets, x, y):
    """The number of common elements of the pairs (x, y) of sorted sets."""
    import numpy as np
    if len(x) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(x, y)], np.int64)
    # many pairs: a 0/1 matrix of the elements that two sets or more hold, some columns at a time
    value, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = count[column] > 1
    number = np.cumsum(count > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float64)
    wide = 4096
    for k in range(0, int(number[-1]) + 1, wide):
        a, b = np.searchsorted(column, [k, k + wide])
        m = np.zeros((len(sets), wide), np.float32)
        m[row[a:b], column[a:b] - k] = 1
        total += m @ m.T
    return total[x, y].astype(np.int64)


def classes_of(sigs: DataFrame) -> DataFrame:
    """One row per class of copies: member (its key), doc_id (the least), copies, sig."""
    return sigs.groupBy(F.col("set_key").alias("member")).agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"))


def groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row per document: doc_id, class_id (the least doc_id of its connected
    group of links), copy_of (the least doc_id with the same set) and n_links
    (other documents at the threshold or above)."""
    spark = docs.sparkSession
    small_batches(spark)
    sigs = materialize(signatures(docs))
    classes = materialize(classes_of(sigs))
    clusters = materialize(components(candidates(classes, threshold)))
    found = materialize(verified(docs, classes, clusters, threshold))
    root = components(found.where("v is not null").select("u", "v"))
    least = (root.join(classes.select("member", "doc_id"), "member")
             .groupBy("root").agg(F.min("doc_id").alias("class_id")))
    links = found.where("v is null").groupBy(F.col("u").alias("member")).agg(F.sum("links").alias("links"))
    facts = (classes.select("member", "doc_id", "copies")
             .join(root.join(least, "root").select("member", "class_id"), "member", "left")
             .join(links, "member", "left")
             .select("member", F.col("doc_id").alias("copy_of"), F.coalesce("class_id", "doc_id").alias("class_id"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    linked = sigs.select("doc_id", F.col("set_key").alias("member")).join(facts, "member").select("doc_id", "class_id", "copy_of", "n_links")
    alone = (docs.where("doc_id is null or text is null or not text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
             .select(F.col("doc_id").cast("long")).select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(0).cast("long").alias("n_links")))
    return linked.unionByName(alone)


def representatives(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each group: the one with the least doc_id.
    Rows without an id are kept as they are."""
    keep = groups(docs, threshold).where("doc_id = class_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.select(docs.columns).unionByName(docs.where("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
