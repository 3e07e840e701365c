import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cuenca.llm import merkle as K

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(level, arity):
    """(levels, root) of a list of digests."""
    levels = [level]
    while len(levels[-1]) > 1:
        a = levels[-1]
        levels.append([h(*a[k:k + arity]) for k in range(0, len(a), arity)])
    return levels, levels[-1][0]


def steps(levels, i, arity):
    for a in levels[:-1]:
        run = a[i // arity * arity:i // arity * arity + arity]
        yield run[:i % arity], run[i % arity + 1:]
        i //= arity


def plain(rows, arity=16):
    leaf = lambda r: h(*map(field, r))
    lower = str.maketrans(K.UPPER, K.LOWER)
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = climb([leaf(r) for r in groups[s]], arity)
    top, root = climb([trees[s][1] for s in names], arity)
    out = []
    for t, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            found = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                found = (*r[:4], r[4] and r[4].translate(lower))
            cur, proof = leaf(found), ""
            for a, b in [*steps(trees[s][0], i, arity), *steps(top, t, arity)]:
                proof += "".join(a + b)
                cur = h(*a, cur, *b)
            out.append((r[0], leaf(r), trees[s][1], root, h(proof), cur, cur == root))
    return out


def rows_of(n, seed):
    rng = random.Random(seed)
    # one source with a third of the rows, one lone, one of 16 and of 17 rows
    names = ["hot"] * (n // 3) + ["ä", None, "", "b", "Z"] * (n // 8) + ["one"] + ["sixteen"] * 16 + ["seventeen"] * 17
    return [(k, s, rng.choice(["en", None]), rng.choice([k, None]), rng.choice([None, "", "Text Ä %d" % k, "low"])) for k, s in enumerate(names)]


def run(spark, rows, arity=16):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    lowered = F.translate("text", K.UPPER, K.LOWER)
    altered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, K.leaf([lowered if f == "text" else F.col(f) for f in K.FIELDS]))
    m = K.build(docs, arity=arity, altered=altered)
    got = K.verify(m).select("doc_id", "leaf", "subroot", "root",
                             F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s.before, s.after)), ""), 256),
                             "folded_root", "verified")
    return m, [tuple(r) for r in got.collect()]


@pytest.mark.parametrize("arity", [16, 2, 3])
def test_equals_plain_tree(spark, arity):
    rows = rows_of(900 if arity == 16 else 36, arity)
    m, got = run(spark, rows, arity)
    want = plain(rows, arity)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3
    every = K.nodes(m).collect()
    assert max(r["digest"] for r in every if r["tree"] == -1 and r["level"] == len(m.top)) == m.root


def test_ties_nulls_repeated_rows(spark):
    rows = [(None, None, None, None, None)] * 3 + [(5, "s", "en", 1, "A")] * 20 + [(5, "s", "en", 1, "B"), (None, "s", "x", 2, "C")]
    _, got = run(spark, rows)
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def test_one_row_and_empty_table(spark):
    _, got = run(spark, [(1, "s", "en", 1, "A")])
    assert got == plain([(1, "s", "en", 1, "A")]) and got[0][1] == got[0][3]
    docs = spark.createDataFrame([], SCHEMA)
    assert K.verify(K.build(docs)).collect() == []


def test_extra_columns_do_not_count(spark):
    rows = rows_of(40, 3)
    docs = spark.createDataFrame(rows, SCHEMA)
    extra = docs.withColumn("digest", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("idx", F.lit(2)).withColumn("_tree", F.lit(3))
    assert K.build(docs).root == K.build(extra).root
