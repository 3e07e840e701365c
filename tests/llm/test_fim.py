import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from cuenca.llm import fim as K
from cuenca.llm.common import byte_table, rolling_hash


def plain(doc_id, text, rate=100, spm=50, sentinels=("<P>", "<S>", "<M>")):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    x = sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(s in text for s in sentinels) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    P, S, M = sentinels
    out = S + s + P + p + M + m if h4 % 100 < spm else P + p + S + s + M + m
    return (doc_id, n, "spm" if h4 % 100 < spm else "psm", len(p), len(m), out)


def texts(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß日😀<PSM>") for _ in range(rng.randint(1, 8)))
    shared = [" ".join(word() for _ in range(120)) + "\n" for _ in range(4)]
    out = [None, "", "\n", "\n\n\n", "no newline", "one\n", "é", "a<P>b", "<", "<S", "x<M", "\r\n\r\n", "\x00\x00", "a\x85b c\n",
           "y" * 9000, "z\n" * 30_000, "<" * 40_000, ("q" * 511 + "<P>") * 3, "k" * 700 + "\n" + "m" * 700]
    for _ in range(150):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) + rng.choice(["\n", "\n\n", " ", ""]) for _ in range(rng.randint(1, 30))]
        parts += rng.sample(shared, 2)
        rng.shuffle(parts)
        t = "".join(parts)
        out.append(t if rng.random() < .2 else re.sub("<[PSM]>", "", t))
    return out


@pytest.mark.parametrize("rate, spm, sentinels", [(100, 50, ("<P>", "<S>", "<M>")), (60, 10, ("[pre]", "|", "<M>"))])
def test_equals_plain(spark, rate, spm, sentinels):
    rows = [(k if k else None, t) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = K.transform(docs, rate=rate, spm=spm, sentinels=sentinels)
    back = got.withColumn("back", K.restore(F.col("form"), F.col("output"), sentinels)).collect()
    assert {tuple(r)[:1] + tuple(r)[2:7] for r in back} == {plain(d, t, rate, spm, sentinels) for d, t in rows}
    by = {d: t or "" for d, t in rows}
    assert all(r["back"] == by[r["doc_id"]] for r in back)
    assert {r["form"] for r in back} == {"plain", "psm", "spm"}


def test_cuts_at_every_unit_and_a_full_memory():
    for limit in (K.CACHE, 3000):
        cache, numbers = K.ChunkCache((b"<P>", b"<S>", b"<M>"), limit), byte_table("chunk")
        for t in (x or "" for x in texts(5)):
            b = t.encode()
            at = [m for (m, _) in K.rolling_marks([b], numbers, 1, lambda h: h < (1 << 23), block=1000)][0]
            c = K.ChunkedText(b, at, cache)
            units = re.findall(r"[^\n]*\n|[^\n]+", t)
            assert c.n == len(units) and c.sentinel == any(s in t for s in K.SENTINELS)
            for k in {0, 1, 2, len(units) // 2, len(units) - 1, len(units)} & set(range(len(units) + 1)):
                head = "".join(units[:k])
                assert c.cut(k) == (len(head.encode()), len(head))
        assert cache.hits > (100 if limit > 3000 else 20) and len(cache.young) + len(cache.old) <= 3 + 2 * limit // 300


def test_marks_do_not_depend_on_neighbours_or_pieces():
    import numpy as np
    data = [t.encode() for t in texts(2) if t]
    numbers, least = byte_table("chunk"), lambda h: h < (1 << 24)
    alone = []
    for d in data:                       # the plain recurrence
        h, at = 0, []
        for k, c in enumerate(d):
            h = ((h << 1) + int(numbers[c])) & 0xFFFFFFFF
            if h < 1 << 24:
                at.append(k)
        alone.append(at)
    for block in (1 << 20, 100):
        assert [m.tolist() for m, _ in K.rolling_marks(data, numbers, 1, least, block)] == alone
    assert rolling_hash(np.zeros(0, np.uint8), numbers, 1).size == 0


def test_empty_table_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a\nb", 7, "x")], "doc_id long, text string, n int, extra string")
    got = K.transform(docs)
    assert got.columns == ["doc_id", "text", "extra", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert got.first()["n"] == 2
    assert K.transform(docs.limit(0)).count() == 0
